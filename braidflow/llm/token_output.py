"""Token ids of whole texts, written as shards of patched frame-of-reference blocks in ascending order of document.

``write`` sorts the documents by range of id, encodes each partition as it
streams by and stores its shards, one a row, in a Parquet folder below the
shared folder; Spark's commit protocol decides which attempt of a task counts.
``read`` gives every document's ids back with the place of its first id in the
whole sequence. Texts: null is empty. Repeated ids: each row is a document, in
the order of a hash of the texts. Null ids come first. An empty table gives no shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm import encoding, pfor
from braidflow.llm.common import batch, pieces, shared_dir

SHARD_IDS = 1 << 20
#: part: which range of document ids; before: ids of that range before this shard.
_SHARD = "part long, before long, docs long, ids long, payload binary"
_SHARD_ARROW = pa.schema([("part", pa.int64()), ("before", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("payload", pa.binary())])
_DOC_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def write(docs: DataFrame, tokenizer: str, at: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, shard_ids: int = SHARD_IDS, percentile: float = pfor.PERCENTILE) -> str:
    """Write the shards of ``docs`` to the folder ``at``; a shard ends once it has ``shard_ids`` ids."""

    def shards(batches):
        coder, part, before = encoding.encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, lengths, parts, held = [], [], [], 0

        def closed():
            raw = pfor.encode_shard(names, np.concatenate(lengths), np.concatenate(parts), percentile)
            return batch(_SHARD_ARROW, part=[part], before=[before], docs=[len(names)], ids=[held], payload=[raw])

        for b in pieces(batches, 4096):
            flat, n = coder.encode_table(b.column(1), end_id)
            ends, own, at = np.cumsum(n), b.column(0).to_pylist(), 0
            while at < len(n):
                done = ends[at - 1] if at else 0
                to = min(len(n), int(np.searchsorted(ends, done + shard_ids - held)) + 1)
                names += own[at:to]
                lengths.append(n[at:to])
                parts.append(flat[done : ends[to - 1]])
                held, at = held + int(ends[to - 1] - done), to
                if held >= shard_ids:
                    yield closed()
                    names, lengths, parts, held, before = [], [], [], 0, before + held
        if names:
            yield closed()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows of one id go by their text's hash and may be divided between tasks, even where the text is one, by where they come from.
    marked = chosen.withColumns({"hash": F.xxhash64("text"), "origin": F.spark_partition_id()})
    ordered = marked.repartitionByRange(F.asc("doc_id"), F.asc("hash"), F.asc("origin")).sortWithinPartitions("doc_id", "hash")
    ordered.select("doc_id", "text").mapInArrow(shards, _SHARD).write.option("compression", "none").parquet(at)
    return at


def read(spark, at: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the folder."""
    shards = spark.read.schema(_SHARD).parquet(at)
    # One row for each partition that wrote, by order of range: as many as that job had tasks.
    totals = shards.groupBy("part").agg(F.sum("ids").alias("n")).orderBy("part").collect()
    bases = np.concatenate(([0], np.cumsum([r.n for r in totals]))).astype(np.int64)[:-1]
    base = dict(zip((r.part for r in totals), bases.tolist(), strict=True))

    def documents(batches):
        for b in batches:
            for part, before, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                shard = pfor.Shard(raw.as_py())
                flat = shard.all_ids().astype("<u4").tobytes()
                first = base[part] + before
                yield batch(_DOC_ARROW, doc_id=shard.doc_ids, start=first + shard.offsets[:-1], n_tokens=shard.lengths, ids=[flat[4 * x : 4 * y] for x, y in zip(shard.offsets[:-1].tolist(), shard.offsets[1:].tolist(), strict=True)])

    return shards.select("part", "before", "payload").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def crc_of_ids(ids: DataFrame) -> DataFrame:
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_token_output(spark, sf_dir: str) -> DataFrame:
    """Every document's ids written and read back: doc_id, start, n_tokens, ids_crc32."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = write(docs, encoding.default_path("word_bpe_49k.json"), shared_dir(spark, "token-shards"))
    return crc_of_ids(read(spark, at))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
