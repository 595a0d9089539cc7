"""Global ranks by a distributed LSD radix sort.

Rows carry a position. A pass takes one digit of the key, the least significant first:
rows are cut by position into shares of equal size, each share counts its digits, the
counts are summed in front of each (digit, share) over digits first and shares second,
and a counting sort inside the share then knows the place of every row in the order by
this digit. The place is the row's position in the next pass. Passes are stable, so
after the most significant digit positions are ranks. Each pass is written to the shared
folder: a lost executor repeats a part of one pass.

Shares hold equally many rows whatever the keys are, so no key is a hot spot; what is
summed in one window are the shares of one digit, or the digits. Bits in which all
keys agree are left out, so the number of passes follows from the spread of the keys.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from codequarry.llm.tables import WorkTables

DIGIT_BITS = 12
SHARE_ROWS = 1 << 15
SHARES = 1 << 12

_SIGN = -1 << 63


class Key(NamedTuple):
    """A long column and its direction; nulls come last either way."""

    name: str
    ascending: bool = True


def _digits(rows: DataFrame, keys: list[Key]) -> list[Column]:
    """Columns of the digits that tell the rows apart, the least significant first."""
    spans = rows.agg(*[f(k.name) for k in keys for f in (F.min, F.max)], *[F.count_if(F.col(k.name).isNull()) for k in keys]).first()
    pieces: list[tuple[Column, int]] = []  # (value of few bits, bits), least significant first
    for i, key in reversed(list(enumerate(keys))):
        low, high = spans[2 * i], spans[2 * i + 1]
        bits = 0 if low is None else 64 if low < 0 <= high else (low ^ high).bit_length()
        # Flipping the sign bit orders signed numbers as unsigned ones.
        plain = F.coalesce(F.col(key.name), F.lit(low or 0)).bitwiseXOR(F.lit(_SIGN))
        if not key.ascending:
            plain = F.bitwise_not(plain)
        for at in range(0, bits, 4):
            n = min(4, bits - at)
            pieces.append((F.shiftrightunsigned(plain, at).bitwiseAND(F.lit((1 << n) - 1).cast("long")), n))
        if spans[2 * len(keys) + i]:
            pieces.append((F.col(key.name).isNull().cast("long"), 1))
    digits, value, held = [], None, 0
    for piece, n in pieces:
        if value is not None and held + n > DIGIT_BITS:
            digits.append(value)
            value, held = None, 0
        shifted = F.shiftleft(piece, held)
        value = shifted if value is None else value + shifted
        held += n
    return digits + ([value] if value is not None else [])


def _offsets(counts: DataFrame) -> DataFrame:
    """(of_share, of_digit, first): the place of the first row of each digit of each share."""
    of_digit = counts.groupBy("digit").agg(F.sum("n").alias("all"))
    below = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_digit.select("digit", F.coalesce(F.sum("all").over(below), F.lit(0)).alias("start"))
    before = Window.partitionBy("digit").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shared = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Digits are at most 2 ** DIGIT_BITS, each a few bytes.
    placed = shared.join(F.broadcast(starts), "digit")
    return placed.select(F.col("share").alias("of_share"), F.col("digit").alias("of_digit"), (F.col("start") + F.col("before")).alias("first"))


def _place(key, rows: pa.Table, offsets: pa.Table) -> pa.Table:
    """The share's rows with their new positions, by one counting sort."""
    rows = rows.sort_by("pos")
    digit = rows["digit"].to_numpy().astype(np.uint16)
    order = np.argsort(digit, kind="stable")  # a counting sort for numbers of 16 bits
    n = np.bincount(digit, minlength=1 << DIGIT_BITS)
    first = np.zeros(1 << DIGIT_BITS, np.int64)
    first[offsets["of_digit"].to_numpy()] = offsets["first"].to_numpy()
    within = np.empty(len(digit), np.int64)
    within[order] = np.arange(len(digit)) - (np.cumsum(n) - n)[digit[order]]
    at = rows.schema.get_field_index("pos")
    return rows.set_column(at, "pos", pa.array(first[digit] + within)).drop_columns(["share", "digit"])


def ranks(rows: DataFrame, keys: list[Key], work: WorkTables, name: str, share_rows: int | None = None) -> DataFrame:
    """``rows`` with their rank, from 1, in the order of ``keys`` (long columns).

    ``rows`` should be few narrow columns, already written. Rows equal in all keys are
    ranked as they are read. No rows give no rows. Columns ``pos``, ``share`` and
    ``digit`` are taken.
    """
    total = rows.count()
    share_rows = share_rows or max(SHARE_ROWS, -(-total // SHARES))
    digits = _digits(rows, keys)
    table = work.write(rows.withColumn("pos", F.monotonically_increasing_id()), f"{name}-0")
    for turn, digit in enumerate(digits or [F.lit(0).cast("long")], 1):
        cut = table.withColumn("share", F.floor(F.col("pos") / F.lit(share_rows))).withColumn("digit", digit)
        offsets = _offsets(cut.groupBy("share", "digit").agg(F.count("*").alias("n")))
        placed = cut.groupBy("share").cogroup(offsets.groupBy("of_share")).applyInArrow(_place, table.schema)
        table = work.write(placed, f"{name}-{turn}")
        work.drop(f"{name}-{turn - 1}")
    return table.withColumn("rank", F.col("pos").cast(T.LongType()) + 1).drop("pos")
