"""Vectors as raw little-endian float32 bytes, for exchange with other stores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.operators.search import vector_widths


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def decode_vector(raw: pa.Array) -> pa.Array:
    """Bytes → vector; null for null and for a length that is no multiple of 4."""
    size = pc.fill_null(pc.binary_length(raw), -1).to_numpy(zero_copy_only=False)
    good = (size >= 0) & (size % 4 == 0)
    kept = raw.filter(pa.array(good)).cast(pa.large_binary())
    # The bytes lie one after the other; they are taken as they are.
    ends = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset:kept.offset + len(kept) + 1] if len(kept) else np.zeros(1, np.int64)
    data = kept.buffers()[2] if len(kept) and kept.buffers()[2] is not None else pa.py_buffer(b"")
    values = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view("<f4") if ends[-1] > ends[0] else np.zeros(0, "<f4")
    return pa.ListArray.from_arrays(_offsets(np.where(good, size // 4, 0)), pa.array(values, pa.float32()), mask=pa.array(~good))


@F.arrow_udf(T.BinaryType())
def encode_vector(vector: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(vector), 0).to_numpy(zero_copy_only=False)
    values = vector.flatten().to_numpy(zero_copy_only=False).astype("<f4")  # a null component is NaN
    real = vector.is_valid().to_numpy(zero_copy_only=False)
    return pa.Array.from_buffers(pa.binary(), len(vector), [
        pa.py_buffer(np.packbits(real, bitorder="little").tobytes()),
        pa.py_buffer(_offsets(np.where(real, sizes * 4, 0)).tobytes()), pa.py_buffer(values.tobytes())])


def import_vectors(df: DataFrame, raw: str = "embedding") -> DataFrame:
    return df.withColumn(raw, decode_vector(F.col(raw)))


def export_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(vector, encode_vector(F.col(vector)))


def mixed_widths(df: DataFrame, by: str = "repository_id", vector: str = "embedding") -> DataFrame:
    """Keys whose vectors do not all have one width."""
    return vector_widths(df, by, vector).filter(~F.coalesce("one_width", F.lit(True)))
