"""Entities → text chunks, and their vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions import text
from codequarry.functions.vectors import norm

HASHED_WIDTH = 384


def _title(kind: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit("# "), text.col(kind), F.lit(": "), text.col(name))


def chunk_text(
    kind: Column | str, name: Column | str, path: Column | str,
    signature: Column | str, docstring: Column | str, content: Column | str,
) -> Column:
    """Labelled lines of an entity, empty ones left out, in one piece."""
    labelled = lambda label, c: F.concat(F.lit(label), text.blank_to_null(c))
    return F.concat_ws(
        "\n",
        _title(kind, name),
        labelled("File: ", path),
        labelled("Signature: ", signature),
        labelled("Docstring: ", docstring),
        text.blank_to_null(content),
    )


def _whole_text() -> Column:
    return chunk_text("entity_type", "name", "file_path", "signature", "docstring", "content")


def _pieces(whole: Column) -> Column:
    """The redacted text in pieces of a chunk's length; joined they are all of it.

    A piece ends behind white space where it has any, so that words stay whole. Redaction
    comes first: a secret across two pieces would not be seen in either.
    """
    n = V.CHUNK_CHARS
    pattern = rf"(?s).{{1,{n}}}\z|.{{0,{n - 1}}}\s|.{{1,{n}}}"
    return text.bound(
        text.redact_secrets(whole),
        lambda c: F.when(F.length(c) <= n, F.array(c)).otherwise(
            F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
        ),
    )


def chunk_count() -> Column:
    """Chunks of an entity with its whole text; redaction at most doubles a text."""
    whole = _whole_text()
    return (
        F.when(F.col("entity_type") == "Import", 0)
        .when(F.length(whole) * 2 <= V.CHUNK_CHARS, 1)
        .otherwise(F.size(_pieces(whole)))
    )


def chunk_rows(entities_df: DataFrame) -> DataFrame:
    """Chunks of entities, repeats included (``repeated`` is carried along).

    A text longer than a chunk gives further ones: the first has the entity's id, the
    others ``id#2``, ``id#3`` and so on; ``entity_id`` and ``part`` name them apart. All
    of it is redacted, so a docstring or signature cannot carry a secret into a chunk.
    """
    whole = _whole_text()
    rows = entities_df.filter(F.col("entity_type") != "Import").withColumn("_whole", whole)
    # The title alone is nearly always long enough; only else is the rest built.
    enough = lambda c: F.length(text.strip(c)) >= V.MIN_CHUNK_CHARS
    rows = rows.filter(enough(_title("entity_type", "name")) | enough("_whole"))
    rows = rows.select("*", F.posexplode(_pieces(F.col("_whole"))).alias("_at", "_piece"))
    numbered = F.concat("id", F.lit("#"), (F.col("_at") + 1).cast("string"))
    return rows.select(
        F.when(F.col("_at") == 0, F.col("id")).otherwise(numbered).alias("id"),
        F.col("id").alias("entity_id"),
        (F.col("_at") + 1).alias("part"),
        "repository_id",
        "file_path",
        F.col("name").alias("entity_name"),
        "entity_type",
        F.col("_piece").alias("content"),
        "line_start",
        "line_end",
        "repeated",
    )


def hashed_vectors(
    df: DataFrame, source: str = "content", out: str = "embedding", width: int = HASHED_WIDTH
) -> DataFrame:
    """Unit vectors of hashed word counts, made in the JVM without a model."""
    from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}_]+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width)
    unit = Normalizer(inputCol="_counts", outputCol="_unit")
    made = df.withColumn("_text", F.coalesce(F.col(source), F.lit("")))
    for step in (words, counts, unit):
        made = step.transform(made)
    made = made.withColumn(out, vector_to_array("_unit", "float32"))
    return made.drop("_text", "_words", "_counts", "_unit")


def model_vectors(
    df: DataFrame, load: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    source: str = "content", out: str = "embedding",
) -> DataFrame:
    """Vectors from a user's model; ``load`` runs once per Python worker task."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            vectors = np.asarray(model(batch.tolist()), dtype=np.float32)
            yield pd.Series(list(vectors), index=batch.index)

    return df.withColumn(out, encode(F.col(source)))


def with_norm(df: DataFrame, vector: str = "embedding", out: str = "norm") -> DataFrame:
    return df.withColumn(out, norm(vector))
