"""Relative paths and file contents as predicates, evaluated in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions.text import bound, col
from codequarry.limits import DEFAULT_LIMITS, Limits


def parts(path: Column | str) -> Column:
    return F.split(col(path), "/", -1)


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)\z", 1)


def suffix(path: Column | str) -> Column:
    """Last dotted ending of the name; none for ``.name`` and ``name.``."""
    return F.regexp_extract(file_name(path), r"(?s).(\.[^.]+)\z", 1)


def stem(path: Column | str) -> Column:
    return F.regexp_replace(file_name(path), r"(?s)(?<=.)\.[^.]+\z", "")


def parent_path(path: Column | str) -> Column:
    return F.regexp_replace(col(path), r"/?[^/]*\z", "")


def in_ignored_directory(path: Column | str) -> Column:
    ignored = F.array(*[F.lit(name) for name in V.IGNORED_DIRECTORIES])
    return F.arrays_overlap(parts(path), ignored)


def ignored_suffix(path: Column | str) -> Column:
    return suffix(path).isin(*V.IGNORED_SUFFIXES)


def generated_or_lock(path: Column | str) -> Column:
    lowered = F.lower(col(path))
    generated = reduce(or_, [lowered.contains(piece) for piece in V.GENERATED_PATH_PARTS])
    name = file_name(path)
    return generated | name.isin(*V.LOCK_FILE_NAMES) | name.endswith(".lock")


def unsafe_path(path: Column | str) -> Column:
    return col(path).contains("..") | col(path).startswith("/")


def nul_ratio(header: Column) -> Column:
    text = header.cast("string")
    without = F.octet_length(F.replace(text, F.lit("\0"), F.lit("")))
    return (F.octet_length(header) - without) / F.octet_length(header)


def is_binary(content: Column | str, header_bytes: int | None = None, strict_header: bool = True) -> Column:
    """Too many NULs, or not UTF-8; empty is text. All bytes count, or the first ``header_bytes``.

    A character cut by the header's end makes a file binary; with
    ``strict_header=False`` such a cut tail is forgiven.
    """

    def judged(whole: Column) -> Column:
        header = whole if header_bytes is None else F.substring(whole, 1, header_bytes)
        valid = F.is_valid_utf8(header.cast("string"))
        if header_bytes is not None and not strict_header:
            tails = [
                F.is_valid_utf8(F.substring(header, 1, header_bytes - n).cast("string"))
                for n in (1, 2, 3)
            ]
            cut = F.octet_length(whole) > header_bytes
            valid = valid | (cut & reduce(or_, tails))
        return (F.octet_length(header) > 0) & ((nul_ratio(header) > V.BINARY_NUL_RATIO) | ~valid)

    # However the content is made, it is made once.
    return bound(col(content), judged)


def text_of(content: Column | str) -> Column:
    """UTF-8 text with bad bytes replaced."""
    return F.make_valid_utf8(col(content).cast("string"))


def skip_reason(
    path: Column | str = "rel_path",
    length: Column | str = "length",
    content: Column | str | None = "content",
    limits: Limits = DEFAULT_LIMITS,
    strict_header: bool = True,
) -> Column:
    """First rule a file breaks, else null. The content is looked at last."""
    reason = F.when(unsafe_path(path), "unsafe path").when(generated_or_lock(path), "generated")
    if limits.file_bytes is not None:
        reason = reason.when(col(length) > limits.file_bytes, "too large")
    reason = reason.when(col(length) == 0, "empty")
    if content is not None:
        reason = reason.when(is_binary(content, limits.binary_header_bytes, strict_header), "binary")
    return reason
