"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact verification decides.

Texts are sets of five-word shingles. Texts with equal sets are one node, and
only the text of its smallest id takes part in the search. Each of ``TREES``
trees gives a node a signature of ``DEPTH`` labels, made of its minima. The forest
is the table of all signatures, sorted by tree and signature, so that a prefix
trie is a run of rows and a node of the trie a run of equal prefixes.

Matching prefixes are shortened step by step from the full depth. All trees are
shortened together until two texts just at the threshold share a prefix in some
tree with the target recall (``prefix_length``). From there each tree is shortened
on its own, place by place: where the next shorter prefix is shared by no more
than ``SPARSE`` texts, it is taken, down to ``SHORTEST`` labels. So prefixes stay
long where texts crowd and become short where they are few, which raises the
recall beyond its target at little cost.

What shares a chosen prefix is a candidate group. Groups of different trees with
the same members count once. Within a group the pairs that share no prefix in an
earlier tree are verified exactly, so each pair of candidates is verified once,
and only pairs that share a prefix are. No pair leaves the task that verifies it:
it returns each text's number of links and a spanning set of links. A group of
more text than one task should hold is cut into blocks, and every two blocks meet
in one task.

Result: one row for each document: doc_id, class_id (the smallest document it is
linked to directly or over others; its own id without links), copy_of (the
smallest document with the same shingles) and n_links (how many other sets of
shingles have a Jaccard similarity of at least the threshold with its own).

A text of fewer than five words is one shingle of all its words. Texts without a
word (null and empty ones too) have no links. A null id gives a row with null
ids and no links. Rows that repeat an id are a row each, by their own text. An
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from braidflow.fields import fresh as fresh_name
from braidflow.fields import quoted
from braidflow.llm.common import batch, forget, mix64, pieces, settled, shingle_hashes, shingles_of_texts, text_bytes, word_hashes
from braidflow.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 10
SHORTEST = 3
RECALL = 0.999
#: Texts that may share a prefix shorter than the recall asks for.
SPARSE = 4
#: Shingles (and 400 for each text) in one block of a candidate group.
BLOCK = 100_000
TEXT_WEIGHT = 400

#: Bytes of a label.
LABEL = 2

_SKETCH = "doc_id long, f1 long, f2 long, n long, sig binary"
_SKETCH_ARROW = pa.schema([("doc_id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("n", pa.int64()), ("sig", pa.binary())])
_LINK_ARROW = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix, at most ``depth``, that texts at the threshold share in one of the trees with the target recall."""
    k = depth
    while k > 1 and 1 - (1 - threshold**k) ** trees < recall:
        k -= 1
    return k


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), size))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of shingles; the first 64 number its node."""
    f1, f2 = mix64(shingles).sum(dtype=np.uint64), mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(f1.view(np.int64)), int(f2.view(np.int64))


class Signer:
    def __init__(self, trees: int, depth: int):
        self.trees, self.depth, n = trees, depth, trees * depth
        draw = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.a, self.b = (draw[:n] | np.uint64(1))[:, None], draw[n:][:, None]

    def sign(self, shingles: np.ndarray) -> bytes:
        """The labels of all trees, one tree's after another's."""
        low = np.full(self.trees * self.depth, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 1024):
            x = self.a * shingles[None, at : at + 1024]
            x += self.b
            np.minimum(low, x.min(1), out=low)
        return (mix64(low) >> np.uint64(64 - 8 * LABEL)).astype(">u2").tobytes()


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, signer: Signer) -> DataFrame:
    """For each row: id, a 128-bit fingerprint of its set of shingles, their number and the signature."""

    def sketch(batches):
        for b in pieces(batches):
            rows = []
            for name, every in zip(b.column(0).to_pylist(), shingles_of_texts(b.column(1), size), strict=True):
                own = np.unique(every)
                rows.append((name, 0, 0, 0, None) if not len(own) or name is None else (name, *fingerprint(own), len(own), signer.sign(own)))
            yield batch(_SKETCH_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_SKETCH_ARROW.names)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(sketch, _SKETCH)


def grow(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """The forest: node, n, tree and signature, sorted by tree and signature over all partitions."""
    rows = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    rows = rows.select("node", "n", "tree", F.col("sig").substr(F.col("tree") * (LABEL * depth) + 1, F.lit(LABEL * depth)).alias("sig"))
    # A prefix that many texts share is divided between partitions by their numbers.
    return rows.repartitionByRange("tree", "sig", "node").sortWithinPartitions("tree", "sig", "node")


def groups_of(forest: DataFrame, longest: int, shortest: int, sparse: int) -> DataFrame:
    """The candidate groups: node, n, tree and group (a number for the tree's prefix), for prefixes that two texts share at least."""
    rows = forest
    for d in range(shortest, longest + 1):  # how many share the prefix of d labels; who is alone at one length is so at longer ones
        prefix = F.col("sig").substr(1, LABEL * d)
        runs = rows.groupBy("tree", prefix.alias("prefix")).agg(F.count("*").alias(f"n{d}"))
        if d == shortest:
            runs = runs.where(F.col(f"n{d}") > 1)
        rows = rows.withColumn("prefix", prefix).join(runs, ["tree", "prefix"]).drop("prefix")
        if d == shortest:
            rows = settled(rows.distinct(), "shared")
    taken = F.lit(longest)
    for d in range(longest - 1, shortest - 1, -1):  # the shortest that only few share
        taken = F.when(F.col(f"n{d}") <= sparse, d).otherwise(taken)
    rows = rows.withColumn("taken", taken)
    members = F.coalesce(*[F.when(F.col("taken") == d, F.col(f"n{d}")) for d in range(shortest, longest + 1)])
    return rows.where(members > 1).select("node", "n", "tree", F.xxhash64("tree", "taken", F.expr(f"substr(sig, 1, {LABEL} * taken)")).alias("group"))


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of the sets reach the threshold, as a symmetric matrix with an empty diagonal."""
    m, sizes = len(sets), np.array([len(s) for s in sets])
    shared = np.zeros((m, m), np.float32)
    if m <= 4:
        for i in range(m):
            for j in range(i):
                if min(sizes[i], sizes[j]) >= threshold * max(sizes[i], sizes[j]) - 1e-9:
                    shared[i, j] = shared[j, i] = np.isin(sets[i], sets[j], assume_unique=True).sum()
    else:
        values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(m), sizes)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        often = count > 8
        rare = (count > 1) & ~often  # few texts each: the pairs are listed, 28 for a shingle at most
        starts = np.cumsum(count) - count
        for c in range(2, 9):
            own = starts[rare & (count == c)]
            if len(own):
                rows = row[own[:, None] + np.arange(c)]
                for i in range(c):
                    for j in range(i):
                        code = np.bincount(rows[:, i] * m + rows[:, j], minlength=m * m).reshape(m, m) if m <= 512 else None
                        if code is not None:
                            shared += code + code.T
                        else:
                            np.add.at(shared, (rows[:, i], rows[:, j]), 1)
                            np.add.at(shared, (rows[:, j], rows[:, i]), 1)
        many = np.flatnonzero(often)
        place = np.full(len(values), -1)
        for at in range(0, len(many), 2048):
            some = many[at : at + 2048]
            place[:] = -1
            place[some] = np.arange(len(some))
            inside = place[column] >= 0
            dense = np.zeros((m, len(some)), np.float32)
            dense[row[inside], place[column[inside]]] = 1
            shared += dense @ dense.T
    both = sizes[:, None] + sizes[None, :]
    out = shared * (1 + threshold) >= threshold * both - 1e-6 * both
    out &= shared.astype(np.float64) / np.maximum(both - shared, 1) >= threshold - 1e-12
    np.fill_diagonal(out, False)
    return out


def spanning(nodes: list[int], near: np.ndarray) -> list[tuple[int, int]]:
    """For each node with a link, the smallest node that it reaches."""
    out, todo = [], np.ones(len(nodes), bool)
    for i in sorted(range(len(nodes)), key=nodes.__getitem__):
        if todo[i] and near[i].any():
            reached = np.zeros(len(nodes), bool)
            edge = reached.copy()
            reached[i] = edge[i] = True
            while edge.any():
                edge = near[edge].any(0) & ~reached
                reached |= edge
            todo &= ~reached
            out += [(nodes[j], nodes[i]) for j in np.flatnonzero(reached).tolist() if j != i]
    return out


def links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, shortest: int = SHORTEST, sparse: int = SPARSE, block: int = BLOCK) -> DataFrame:
    """The join: doc_id, class_id, copy_of, n_links for every row of ``docs``."""
    return _joined(docs, id_col, text_col, size, threshold, trees, depth, recall, shortest, sparse, block).select("doc_id", "class_id", "copy_of", "n_links")


def _joined(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, trees: int, depth: int, recall: float, shortest: int, sparse: int, block: int) -> DataFrame:
    """The join's rows with the fingerprints of their texts and a number of their classes."""
    longest = prefix_length(threshold, trees, depth, recall)
    shortest = min(shortest, longest)
    base = settled(sketches(docs, id_col, text_col, size, Signer(trees, depth)), "sketches")
    usable = base.where("n > 0")
    heads = settled(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("first"), F.max("n").alias("n")), "heads")
    signed = usable.select("f1", "f2", F.col("doc_id").alias("first"), "sig").join(heads, ["f1", "f2", "first"])
    forest = settled(grow(signed.select(F.col("f1").alias("node"), "n", "sig"), trees, depth), "forest")
    members = settled(groups_of(forest, longest, shortest, sparse), "members")

    # Groups of the same texts in several trees: the first tree's stands for all.
    found = members.groupBy("tree", "group").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.col("n") + TEXT_WEIGHT).alias("weight"))
    kept = found.groupBy("m", "x").agg(F.min(F.struct("tree", "group", "weight")).alias("one")).select("one.tree", "one.group", F.ceil(F.col("one.weight") / block).alias("blocks"))
    placed = members.join(kept, ["tree", "group"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("node", "tree", "group", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    # Each node's groups in all trees, no more than there are trees, tell which pairs have met before.
    every = members.groupBy("node").agg(F.map_from_entries(F.collect_set(F.struct("tree", "group"))).alias("groups"))
    texts = docs.select(F.col(id_col).cast("long").alias("first"), F.col(text_col).cast("string").alias("text"))
    wanted = every.join(heads.select(F.col("f1").alias("node"), "first"), "node")
    whole = settled(texts.join(wanted, "first").select("node", F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.coalesce(F.col("groups")[t], F.lit(0).cast("long"))).alias("groups"), "text"), "texts")
    rows = whole.join(cells, "node").repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "node")

    def verify(batches):
        held: list[tuple[int, int, np.ndarray, list[int]]] = []
        cell = None

        def closed():
            nodes, side, sets, met = (list(c) for c in zip(*held, strict=True))
            met, side = np.array(met, np.int64), np.array(side)
            fresh = np.ones((len(nodes), len(nodes)), bool)
            for t in range(cell[3]):  # pairs that an earlier tree has together
                fresh &= (met[:, t, None] != met[None, :, t]) | (met[:, t, None] == 0)
            if cell[1] != cell[2]:
                fresh &= side[:, None] != side[None, :]
            np.fill_diagonal(fresh, False)
            some = np.flatnonzero(fresh.any(1))
            if len(some) < 2:
                return None
            near = similar([sets[k] for k in some], threshold) & fresh[np.ix_(some, some)]
            nodes = [nodes[k] for k in some]
            out = [(n, None, int(c)) for n, c in zip(nodes, near.sum(1), strict=True) if c] + [(a, b, 0) for a, b in spanning(nodes, near)]
            return batch(_LINK_ARROW, node=[x[0] for x in out], other=[x[1] for x in out], links=[x[2] for x in out])

        for b in pieces(batches):
            c = [b.column(k).to_pylist() for k in ("group", "i", "j", "tree", "own", "node", "groups")]
            for group, i, j, tree, own, node, groups, text in zip(*c, text_bytes(b.column("text")), strict=True):
                if cell != (group, i, j, tree):
                    if held and (out := closed()) is not None:
                        yield out
                    held, cell = [], (group, i, j, tree)
                if held and held[-1][0] == node:
                    continue  # a repeated row
                own_set = shingle_set(text, size)
                if len(own_set) and fingerprint(own_set)[0] == node:  # else another text of the same id
                    held.append((node, own, own_set, groups))
        if held and (out := closed()) is not None:
            yield out

    verified = settled(rows.select("group", "i", "j", "tree", "own", "node", "groups", "text").mapInArrow(verify, "node long, other long, links long"), "links")
    forget(forest, members, whole)
    counts = verified.where("other is null").groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(verified.where("other is not null").select("node", "other"), "node", "other")
    firsts = classes.join(heads.select(F.col("f1").alias("node"), "first"), "node")
    least = firsts.groupBy("component").agg(F.min("first").alias("class_id"))
    linked = classes.join(least, "component").select(F.col("node").alias("f1"), "class_id", "component").join(counts.withColumnRenamed("node", "f1"), "f1")
    known = heads.join(linked, "f1", "left").select("f1", "f2", F.col("first").alias("copy_of"), F.coalesce("class_id", "first").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "f1").alias("component"))
    with_words = usable.select("doc_id", "f1", "f2").join(known, ["f1", "f2"]).select("doc_id", "class_id", "copy_of", "n_links", "f1", "f2", "component")
    return with_words.unionAll(base.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"), *[F.lit(None).cast("long").alias(c) for c in ("f1", "f2", "component")]))


def drop_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: of each class one document stays, that with the smallest id; all columns are kept.

    Rows that repeat an id go and stay each by its own text, and of equal ones that would stay one does. Rows without a
    word and rows without an id stay.
    """
    found = settled(_joined(docs, "doc_id", "text", SHINGLE, THRESHOLD, TREES, DEPTH, RECALL, SHORTEST, SPARSE, BLOCK).where("f1 is not null"), "classes")
    several = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    gone = found.where("doc_id != class_id").select("doc_id").unionAll(several).distinct()
    alone = docs.join(gone.withColumnRenamed("doc_id", (name := fresh_name("gone", docs.columns))), F.expr(f"cast(doc_id as long) = {name}"), "left_anti")
    if several.isEmpty():
        return alone
    f1, f2, schema = fresh_name("f1", docs.columns), fresh_name("f2", docs.columns), docs.schema
    again = docs.join(several.withColumnRenamed("doc_id", name), F.expr(f"cast(doc_id as long) = {name}"), "left_semi")

    def told(batches):
        for b in pieces(batches):
            prints = [fingerprint(x) if len(x := shingle_set(t)) else (None, None) for t in text_bytes(b.column("text"))]
            yield b.append_column(f1, pa.array([x for x, _ in prints], pa.int64())).append_column(f2, pa.array([x for _, x in prints], pa.int64()))

    rows = again.mapInArrow(told, StructType([*schema.fields, StructField(f1, LongType()), StructField(f2, LongType())]))
    least = found.where("doc_id = class_id").groupBy("component").agg(F.min(F.struct("f1", "f2", "class_id")).alias("one")).select(F.col("one.f1").alias(f1), F.col("one.f2").alias(f2), F.col("one.class_id").alias(name))
    stay = rows.join(least, [f1, f2]).where(F.expr(f"cast(doc_id as long) = {name}")).dropDuplicates([f1, f2])
    return alone.unionAll(stay.select(*[F.col(quoted(c)) for c in docs.columns])).unionAll(rows.where(F.col(f1).isNull()).select(*[F.col(quoted(c)) for c in docs.columns]))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its number of links."""
    return links(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) >= 1)),
sets as (select doc_id, count(*) as n, md5(string_agg(s, '|' order by s)) as h from shingles group by doc_id),
heads as (select h, min(doc_id) as node, any_value(n) as n from sets group by h),
own as (select k.node, k.n, s.s from shingles s join heads k on k.node = s.doc_id),
pairs as (
  select a.node as a, b.node as b from own a join own b on a.s = b.s and a.node != b.node
  group by a.node, b.node, a.n, b.n having count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach(node, least) as (
  select node, node from heads
  union
  select p.b, r.least from reach r join pairs p on p.a = r.node),
classes as (select node, min(least) as class_id from reach group by node),
counts as (select a as node, count(*) as n_links from pairs group by a)
select d.doc_id, coalesce(c.class_id, d.doc_id) as class_id, coalesce(k.node, d.doc_id) as copy_of, coalesce(l.n_links, 0) as n_links
from documents d left join sets s on s.doc_id = d.doc_id left join heads k on k.h = s.h
left join classes c on c.node = k.node left join counts l on l.node = k.node
"""
