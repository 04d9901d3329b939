"""Packing of whole documents into windows of a fixed number of tokens, by best-fit decreasing.

Documents are dealt by a hash of their id, their text and the partition they come
from into groups of a bounded amount of text, so that one source, one set of
copies or one repeated row spreads over all groups. Each group is encoded and
packed on its own: a document longer than the window is
first cut into full windows; the rests are placed from the longest to the
shortest, each into the open window with the least room that still holds it. A
segment tree over remaining room (how many open windows have that room) finds
that window in a logarithm of the window size.

Only what a group holds decides the placement, whatever order its rows come in,
so a task that runs again gives the same rows. Null texts are empty documents (the end token alone); repeated
ids are packed as separate documents in the order of their lengths and texts; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm import encoding

WINDOW = 2048
#: Characters of text for each group: what one task holds in memory at a time, on average (a document is never divided, so a longer one makes its group larger).
GROUP_CHARS = 12_000_000

_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")])


class RoomTree:
    """Open windows by remaining room: a segment tree of counts, asked for the least room of at least ``n``."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at, count = room + self.size, self.count
        while at:
            count[at] += 1
            at >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """The tightest open window with room for ``n``, removed from the tree: its room and number."""
        at, count, size = n + self.size, self.count, self.size
        if not count[at]:
            while True:  # climb until a right neighbour holds something
                if at == 1:
                    return None
                if not at & 1 and count[at + 1]:
                    at += 1
                    break
                at >>= 1
            while at < size:
                at *= 2
                if not count[at]:
                    at += 1
        room = at - size
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """For each length (1 to ``window``) its sequence and offset there, and how many sequences there are."""
    tree, sequences, offsets, n = RoomTree(window), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        if (found := tree.take(need)) is None:
            room, sequence = window, n
            n += 1
        else:
            room, sequence = found
        sequences[i], offsets[i] = sequence, window - room
        if room > need:
            tree.add(room - need, sequence)
    return sequences, offsets, n


def cut(lengths: np.ndarray, order: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of documents of these lengths, one document's after another's: document, start, length, sequence, offset.

    Full windows are sequences of their own; the rests, in ``order``, go where they fit best.
    """
    full, rest = lengths // window, lengths % window
    pieces = full + (rest > 0)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
    length = np.minimum(window, lengths[doc] - start)
    sequence, offset = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    whole = length == window
    sequence[whole] = np.arange(whole.sum())
    late = order[rest[order] > 0]
    at = (np.cumsum(pieces) - 1)[late]  # a rest is its document's last piece
    sequences, offsets, _ = best_fit_decreasing(rest[late].tolist(), window)
    sequence[at], offset[at] = whole.sum() + np.array(sequences, np.int64), offsets
    return doc, start, length, sequence, offset


def pack(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, group_chars: int = GROUP_CHARS) -> DataFrame:
    """One row for each piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids (unsigned 32-bit)."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-chars // group_chars))

    def packed(key, table: pa.Table) -> pa.Table:
        group, column = key[0].as_py(), table.column("doc_id").combine_chunks()
        flat, n = encoding.encoder(tokenizer).encode_table(table.column("text"), end_id)
        known, name = np.asarray(column.is_valid()), column.fill_null(0).to_numpy(zero_copy_only=False)
        order, at = np.lexsort((n, name, known)), np.cumsum(n) - n
        if len(name) > 1 and (np.diff(name[order]) == 0).any():  # repeated ids: by what they hold, whatever order they came in
            order = np.array(sorted(range(len(name)), key=lambda i: (known[i], name[i], n[i], flat[at[i] : at[i] + n[i]].tobytes())))
        doc, start, length, sequence, offset = cut(n, order, window)
        places = np.concatenate(([0], 4 * np.cumsum(length))).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(places), pa.py_buffer(flat.astype("<u4"))])
        return pa.Table.from_arrays([column.take(pa.array(doc)), *map(pa.array, (start, length, n[doc], (group << 32) | sequence, offset)), ids], schema=_ARROW)

    # Rows that repeat an id and a text are as many groups' as there are partitions they come from.
    group = F.pmod(F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.spark_partition_id()), F.lit(groups))
    return chosen.withColumn("part", group).groupBy("part").applyInArrow(lambda key, table: packed(key, table), _PIECES)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048: one row for each piece, with the crc32 of its ids."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), encoding.default_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
