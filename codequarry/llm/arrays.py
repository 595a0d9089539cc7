"""Helpers for Arrow tasks: words as numbers, packed payloads, streamed groups.

Shuffles of many small numbers travel as payloads: one row for each part of the key
space and buffer, holding compressed arrays. ``streamed`` hands the rows of one key
on as they come, so a task holds one key's arrays, never a partition.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

SPACE = " \t\n\x0b\x0c\r"


def lower_ascii(text: pa.Array) -> pa.Array:
    """A-Z lower-cased, everything else as it is."""
    return pc.ascii_lower(text)


def word_codes(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, first word of each text and the end).

    Words are runs of ``[^\\x20\\x09-\\x0D]``; null has none.
    """
    text = pc.fill_null(text.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(text)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values
    if len(flat) == 0:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(len(text) + 1, np.int64)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    # Space at either end of a text splits off an empty word.
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        real = codes != empty
        before = np.concatenate([[0], np.cumsum(real)])
        offsets = before[offsets]
        codes = codes[real]
    else:
        offsets = offsets - offsets[0]
    return words, codes, offsets


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.to_pylist()), np.uint64, len(words))


def hash_of(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of each run of ``size`` consecutive words (none if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(seed))
    odd = np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        total = mix64(total * odd + hashes[k:k + n])
    return total


def segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, … of all segments, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block-wise prefix minima."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:n], out[rest:rest + n])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of like rank lie together."""
    body, head = [], []
    for array in arrays:
        array = np.ascontiguousarray(array)
        head.append(f"{array.dtype.str}:{len(array)}")
        body.append(array.view(np.uint8).reshape(len(array), array.dtype.itemsize).T.tobytes())
    top = ",".join(head).encode()
    return len(top).to_bytes(4, "little") + top + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(data: bytes | pa.Buffer) -> list[np.ndarray]:
    data = memoryview(data)
    size = int.from_bytes(data[:4], "little")
    raw = zstandard.ZstdDecompressor().decompress(data[4 + size:])
    out, at = [], 0
    for spec in bytes(data[4:4 + size]).decode().split(","):
        kind, _, n = spec.partition(":")
        dtype, n = np.dtype(kind), int(n)
        end = at + dtype.itemsize * n
        planes = np.frombuffer(raw, np.uint8, end - at, at).reshape(dtype.itemsize, n)
        # Copied also where a byte is a value: a view would keep all of the payload alive.
        out.append(planes.T.copy(order="C").reshape(-1).view(dtype))
        at = end
    return out


def sliced(batches, most_bytes: int = 4 << 20):
    """The same rows in batches of about ``most_bytes``, so that Python objects of few texts are alive."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, batch.num_rows * most_bytes // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)


def buffered(batches, most_bytes: int = 16 << 20):
    """Arrow batches joined until they hold about ``most_bytes``, as one batch each."""
    held, size = [], 0
    for batch in sliced(batches):
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def streamed(batches, key: str):
    """(key, list of one-key batches) of a stream sorted by ``key``."""
    current, held = None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for start, end in zip(cuts[:-1], cuts[1:]):
            if held and keys[start] != current:
                yield current, held
                held = []
            current = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield current, held


def give_back() -> None:
    """Return freed memory to the machine: Arrow's, and what numpy got from the C library (where that is glibc).

    Python workers live on from task to task, several in one executor, and would keep it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
