"""What the operators of this subpackage share: Arrow row mapping, shared folders, hashes and word shingles."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidflow.sources.scratch import remove, scratch

#: Word bytes: 0-9, a-z (texts are lower-cased in A-Z first) and every byte of a character beyond ASCII.
WORD_BYTES = rb"[0-9a-z\x80-\xff]+"

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors share: below ``spark.checkpoint.dir``."""
    return scratch(spark, name)


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a shared folder and read again: cuts the lineage and survives lost executors."""
    at = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.settled_at = at
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the files of settled tables that nothing will read any more."""
    for df in tables:
        remove(df.sparkSession, df.settled_at)


def doc_crc(doc_id: Column) -> Column:
    """crc32 of a document's id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def map_rows(df: DataFrame, columns: list, f: Callable, schema: str) -> DataFrame:
    """``f`` maps an iterator of record batches of ``columns`` to record batches of ``schema``; other columns play no part."""
    return df.select(*columns).mapInArrow(f, schema)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller slices of the batches, so that Python copies of texts stay few."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def crc_of(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, null as empty, without decoding."""
    column = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text in order; A-Z are lower-cased first."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IS_WORD[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[raw] * _powers(_BASE, len(raw))[: len(raw)], out=total[1:])
    return mix64((total[ends] - total[starts]) * _powers(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))


_PLACE = mix64(np.arange(101, 133, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, in order. A text of fewer words (but one at least) is one run."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total += mix64(words[j : n - size + 1 + j] * _PLACE[j])
    return mix64(total)


def text_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of stretches of texts, about ``most`` bytes each, and where each text begins in them (one more at the end).

    Null is the empty text; a longer text is a stretch of its own.
    """
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data, at = np.frombuffer(column.buffers()[2] or b"", np.uint8), 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def string_hashes(column: pa.Array) -> np.ndarray:
    """A 64-bit hash of each whole string, by its bytes as they are."""
    found = []
    for data, at in text_slices(column):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * _powers(_BASE, len(data))[: len(data)], out=total[1:])
        found.append(mix64((total[at[1:]] - total[at[:-1]]) * _powers(_INVERSE, len(data) + 1)[at[:-1]] + np.diff(at).astype(np.uint64)))
    return np.concatenate(found or [np.zeros(0, np.uint64)])


def words_of_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of ``word_hashes`` for all words of several texts, and where each text's begin (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    raw = _LOWER[data]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _IS_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # words end with their text
    edge |= inside[1:] != inside[:-1]
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[raw] * _powers(_BASE, len(raw))[: len(raw)], out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * _powers(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingles_of_texts(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The hashes of ``shingle_hashes`` for each text, in order."""
    for data, offsets in text_slices(column):
        words, at = words_of_texts(data, offsets)
        every = shingle_hashes(words, size) if len(words) >= size else np.zeros(0, np.uint64)
        for a, z in zip(at.tolist(), at[1:].tolist(), strict=False):
            yield every[a : z - size + 1] if z - a >= size else shingle_hashes(words[a:z], size)
