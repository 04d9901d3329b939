"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

The sets are five-word shingles. A short test item has a tiny Jaccard similarity
with a long document that holds it, so documents are searched by windows: items
are partitioned by size, class c holding those of up to 2**c shingles, and for
each class every text is covered by windows of 2**(c+1) shingles, one starting
each 2**c, so that a passage as long as an item lies whole in some window. Within
a class the containment threshold t turns into the Jaccard similarity that a
window of the class's size must have with the class's smallest item,
j = t q / (q + u - t q), and the number of hash functions is the least that finds
such a window with the target probability: each function whose minimum over the
window equals the item's makes a candidate (bands of one row). A window without
any shingle of any item has no minimum in common with one and is left out before
hashing. Candidates are then verified by exact containment of the item's
shingles in the whole text.

Items travel to the executors in blocks of a bounded number of items and characters,
one pass over the documents for each block, so a benchmark of any size is searched whole. Items of
fewer than five words are one shingle of all their words, looked for as a run of
that many words. Items without a word match nothing. Null texts are empty.
Repeated ids: every row is searched, results are distinct. Empty tables give no
rows. Null item or document ids are kept as null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import batch, mix64, pieces, shingle_hashes, text_slices, word_hashes, words_of_texts

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Items sent to the executors at a time, and the characters of their texts.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000

_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("shared", pa.int64()), ("item_shingles", pa.int64())])


def hash_functions(threshold: float, item: int, window: int, recall: float) -> int:
    """How many minima find, with probability ``recall``, a window of up to ``window`` shingles that holds ``threshold`` of ``item``."""
    kept = math.ceil(threshold * item - 1e-9)
    j = kept / (item + window - kept)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - j))) if j < 1 else 1


class Items:
    """A block of items in their size classes, ready to search texts."""

    def __init__(self, items: list[tuple], size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL):
        self.size, self.threshold = size, threshold
        self.items: list[tuple] = []  # id, the words of a shingle, distinct shingles sorted
        for item_id, text in items:
            words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
            if len(words):
                self.items.append((item_id, min(size, len(words)), np.unique(shingle_hashes(words, size))))
        groups: dict[tuple[int, int], list[int]] = {}
        for i, (_, words, own) in enumerate(self.items):
            groups.setdefault((words, max(0, int(len(own) - 1).bit_length())), []).append(i)
        self.classes = []
        for (words, c), members in sorted(groups.items()):
            least = min(len(self.items[i][2]) for i in members)
            k = hash_functions(threshold, least, 2 << c, recall)
            seeds = mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(c))
            every = np.unique(np.concatenate([self.items[i][2] for i in members]))
            minima = [{} for _ in range(k)]
            for i in members:
                for f, m in enumerate(np.min(mix64(self.items[i][2][None, :] ^ seeds[:, None]), axis=1).tolist()):
                    minima[f].setdefault(m, []).append(i)
            filter_bits = np.zeros(1 << 20, bool)
            filter_bits[(every >> np.uint64(44)).astype(np.int64)] = True
            self.classes.append((words, 1 << c, seeds, every, filter_bits, minima))
        self.all: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of all classes with shingles of so many words
        for words, _, _, every, filter_bits, _ in self.classes:
            old, bits = self.all.get(words, (np.zeros(0, np.uint64), np.zeros_like(filter_bits)))
            self.all[words] = np.union1d(old, every), bits | filter_bits

    def column(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item index, its shingles in the text, its shingles) of the items that the texts contain.

        The shingles of many texts are held against the filter at once; only texts with a shingle of an item are searched.
        """
        out, row = [], 0
        for data, offsets in text_slices(texts):
            words, at = words_of_texts(data, offsets)
            near = np.zeros(len(offsets) - 1, bool)
            for size, (every, bits) in self.all.items():
                if len(words) < size:
                    continue
                own = shingle_hashes(words, size)
                maybe = np.flatnonzero(bits[(own >> np.uint64(44)).astype(np.int64)])
                maybe = maybe[np.isin(own[maybe], every)]
                near[np.searchsorted(at, maybe, "right") - 1] = True
            for i in np.flatnonzero(near).tolist():
                out += [(row + i, *x) for x in self.search(words[at[i] : at[i + 1]])]
            row += len(near)
        return out

    def search(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item index, its shingles in the text, its shingles) of the items that a text of these words contains."""
        found, sets = set(), {}
        shingles: dict[int, np.ndarray] = {}
        for size, step, seeds, every, bits, minima in self.classes:
            if len(words) < size:
                continue
            if size not in shingles:
                shingles[size] = shingle_hashes(words, size)
            own = shingles[size]
            maybe = np.flatnonzero(bits[(own >> np.uint64(44)).astype(np.int64)])
            if not len(maybe):
                continue
            maybe = maybe[np.isin(own[maybe], every)]
            for at in np.unique(np.concatenate((maybe // step, np.maximum(maybe // step - 1, 0)))).tolist():
                window = own[at * step : (at + 2) * step]
                for f, m in enumerate(np.min(mix64(window[None, :] ^ seeds[:, None]), axis=1).tolist()):
                    if m in minima[f]:
                        found.update((i, size) for i in minima[f][m])
        out = []
        for i, size in sorted(found):
            if size not in sets:
                sets[size] = np.unique(shingles[size])
            mine = self.items[i][2]
            shared = int(np.isin(mine, sets[size], assume_unique=True).sum())
            if shared >= self.threshold * len(mine) - 1e-9:
                out.append((i, shared, len(mine)))
        return out


def blocks(spark, benchmark: DataFrame, id_col: str, text_col: str, block_items: int, block_chars: int = BLOCK_CHARS):
    """The distinct items in lists of about ``block_items`` and ``block_chars`` at most, one list on the driver at a time."""
    chosen = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    n, chars = chosen.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(-(-n // block_items), -(-chars // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    for p in range(parts):
        yield [tuple(r) for r in chosen.where(part == p).collect()]


def contained(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, shared, item_shingles and containment of each document that holds ``threshold`` of an item's shingles."""
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for some in blocks(spark, benchmark, item_id, item_text, block_items):
        shared = spark.sparkContext.broadcast(Items(some, size, threshold, recall))

        def search(batches, shared=shared):
            items = shared.value
            for b in pieces(batches, 2048):
                names = b.column(0).to_pylist()
                rows = [(names[d], items.items[i][0], n, m) for d, i, n, m in items.column(b.column(1))]
                if rows:
                    yield batch(_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_ARROW.names)})

        found = chosen.mapInArrow(search, "doc_id long, item_id long, shared long, item_shingles long")
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = spark.createDataFrame([], "doc_id long, item_id long, shared long, item_shingles long")
    return out.distinct().withColumn("containment", F.col("shared") / F.col("item_shingles"))


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns, where they are."""
    spark = docs.sparkSession
    for some in blocks(spark, benchmark, item_id, item_text, block_items):
        shared = spark.sparkContext.broadcast(Items(some, size, threshold, recall))

        def kept(batches, shared=shared):
            items = shared.value
            for b in pieces(batches, 2048):
                clean = np.ones(b.num_rows, bool)
                clean[[r[0] for r in items.column(b.column(b.schema.get_field_index(text_col)))]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents that hold a benchmark item go; the others keep all their columns."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """The documents that contain a benchmark item, with the item."""
    return contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every pair at least at the threshold, from all shingles of both tables.
ORACLE_SQL = r"""
with words as (
  select 'd' as kind, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
-- Items of fewer than five words are one run of all their words, looked for among a text's runs of as many.
runs as (
  select id, len(w) as k, w from words where kind = 'i' and len(w) between 1 and 4
  union all select id, 5, w from words where kind = 'i' and len(w) >= 5),
shingles as (
  select distinct 'i' as kind, id, k, array_to_string(w[i:i + k - 1], ' ') as s from (select id, k, w, unnest(range(1, len(w) - k + 2)) as i from runs)
  union all
  select distinct 'd', id, k, array_to_string(w[i:i + k - 1], ' ') from (
    select id, k, w, unnest(range(1, len(w) - k + 2)) as i from words, (select distinct k from runs) where kind = 'd' and len(w) >= k)),
sizes as (select id, count(*) as n from shingles where kind = 'i' group by id)
select d.id as doc_id, i.id as item_id, count(*) as shared, any_value(z.n) as item_shingles,
       count(*)::double / any_value(z.n)::double as containment
from shingles i join shingles d on d.s = i.s and d.k = i.k and d.kind = 'd' join sizes z on z.id = i.id
where i.kind = 'i'
group by d.id, i.id
having count(*) >= 0.8 * any_value(z.n) - 1e-9
"""
