"""Exact top-k search by inner product over a vector-approximation file.

Components become integers, ``floor(scale * x)``. Every dimension is cut into
``2**bits`` cells of equal width between its smallest and largest value. The file
holds the cell numbers of each different vector, ``bits`` bits a component, in
blocks; exact vectors stay where they are. The search goes in three steps:

1. query blocks and file blocks meet, each pair in a task of bounded size. The
   middle of a vector's cells gives an estimate of the score, and half the cell
   widths times the query's components bound its error. Of a block, those vectors
   of a query are kept whose upper bound reaches the block's kth lower bound;
2. over all blocks, those are kept whose upper bound reaches the kth lower bound;
3. only their exact vectors are read, by a join, and looked at in order of their
   upper bound until no remaining bound reaches the kth best score.

The result is exact, whatever the data. Equal vectors are one in the file, with
their ``k + 1`` smallest ids (no query can have use for more), so that a vector
that very many rows share is one candidate.

Vectors that are null, empty of components, or hold a null or non-finite
component take no part, neither as query nor as candidate; nor do null ids. A
query's candidates are the vectors of its own length; others have no product with
it. A query's own row is every row with its id; an id with several vectors asks
with the smallest of them. Ties go to the smaller id; rows that repeat an id each
count. Fewer than k candidates give fewer rows. An empty table gives no rows.
Components or scores that do not fit in 64 bits raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidflow.llm.common import batch, settled

BITS = 6
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 65_536
#: Exact vectors looked at together for one query.
STEP = 16

_EXACT_ARROW = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("exact", pa.binary())])
_FILE_ARROW = pa.schema([("block", pa.int64()), ("size", pa.int32()), ("first", pa.int64()), ("hash", pa.int64()), ("only", pa.int64()), ("codes", pa.binary())])
_BOUND_ARROW = pa.schema([("query_id", pa.int64()), ("first", pa.int64()), ("hash", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id and v (integer components) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.col(id_col).isNotNull() & (F.size(x) > 0) & ~F.coalesce(F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True))
    return vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


class Cells:
    """The cells of the dimensions of vectors of one length."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int):
        self.low, self.bits, self.last = low.astype(float), bits, (1 << bits) - 1
        self.width = np.maximum(1.0, np.ceil((high.astype(float) - self.low + 1) / (1 << bits)))

    def pack(self, v: np.ndarray) -> list[bytes]:
        """The cell numbers of each vector, ``bits`` bits a component."""
        codes = np.clip((v - self.low) // self.width, 0, self.last).astype(np.uint32)
        each = (codes[:, :, None] >> np.arange(self.bits, dtype=np.uint32)) & 1
        return [x.tobytes() for x in np.packbits(each.reshape(len(v), -1).astype(np.uint8), axis=1)]

    def unpack(self, raw: list[bytes]) -> np.ndarray:
        each = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1, count=self.bits * len(self.low))
        return each.reshape(len(raw), len(self.low), self.bits) @ (1 << np.arange(self.bits)).astype(np.float64)

    def bounds(self, queries: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and vector a middle of the score, and for each query how far the score may be from it."""
        q = queries.astype(np.float64)
        middle = (q * self.width) @ codes.T + (q @ (self.low + (self.width - 1) / 2))[:, None]
        # The last term is for the rounding of the bounds themselves.
        return middle, np.abs(q) @ ((self.width - 1) / 2) + 1e-9 * (np.abs(q) @ (np.abs(self.low) + self.width * (1 << self.bits))) + 1e-6


def exact_best(query: np.ndarray, query_id: int, candidates: list[tuple[float, bytes, list]], kind: type, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows. ``candidates``: upper bound, exact vector, and (id, rows) of those that have it."""
    candidates = sorted(candidates, key=lambda c: -c[0])
    best: list[tuple[int, int]] = []
    for at in range(0, len(candidates), STEP):
        if len(best) >= k and candidates[at][0] < -best[k - 1][0]:
            break
        some = candidates[at : at + STEP]
        v = np.frombuffer(b"".join(c[1] for c in some), kind).reshape(len(some), -1)
        # Integer products stay in 64 bits or are made of Python's own integers.
        whole = float(np.abs(query.astype(float)).max()) * float(np.abs(v.astype(float)).max()) * len(query) < 2**62
        scores = v.astype(np.int64 if whole else object) @ (query if whole else query.astype(object))
        best = sorted(best + [(-int(s), i) for s, c in zip(scores, some, strict=True) for i, n in c[2] if i != query_id for _ in range(n)])[:k]
    return [(-s, i) for s, i in best]


def search(vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, bits: int = BITS, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best other rows. ``is_query`` is a condition on ``id``."""
    rows = settled(integers(vectors, id_col, vector_col, scale), "vectors")
    # A row for each length and place in it, and one for each length: as many as the vectors are long.
    ends: dict[int, list] = {}
    for r in rows.select(F.size("v").alias("size"), F.posexplode("v").alias("at", "x")).groupBy("size", "at").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("size", "at").collect():
        ends.setdefault(r.size, []).append((r.low, r.high))
    cells = {n: Cells(np.array([a for a, _ in x]), np.array([z for _, z in x]), bits) for n, x in ends.items()}
    most = max((max(abs(a), abs(z)) for x in ends.values() for a, z in x), default=0)
    kind = next(t for t in (np.int16, np.int32, np.int64) if t is np.int64 or most < np.iinfo(t).max)
    n, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    left, right = max(1, -(-asked // query_block)), max(1, -(-n // candidate_block))

    def narrow(batches):
        for b in batches:
            v = b.column("v")
            flat, at = v.flatten().to_numpy(zero_copy_only=False).astype(kind), v.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(at)
            yield batch(_EXACT_ARROW, id=b.column("id"), size=at, exact=[flat[z - m : z].tobytes() for z, m in zip(ends.tolist(), at.tolist(), strict=True)])

    exact = rows.mapInArrow(narrow, "id long, size int, exact binary")
    ranked = exact.groupBy("size", "exact", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("rows"))
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy("size", "exact").orderBy("id"))).where(F.col("place") <= k + 1)
    alike = ranked.groupBy("size", "exact").agg(F.min("id").alias("first"), F.sort_array(F.collect_list(F.struct("id", "rows"))).alias("ids"))
    different = settled(alike.withColumn("hash", F.xxhash64("exact")), "different")

    def approximate(batches):
        for b in batches:
            sizes, raw = b.column("size").to_numpy(), b.column("exact").to_pylist()
            codes: list = [None] * len(raw)
            for m in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == m)
                for i, c in zip(at, cells[m].pack(np.frombuffer(b"".join(raw[i] for i in at), kind).reshape(len(at), m)), strict=True):
                    codes[i] = c
            yield batch(_FILE_ARROW, **{c: b.column(c) for c in _FILE_ARROW.names[:-1]}, codes=codes)

    only = F.when(F.size("ids") == 1, F.col("first"))  # the one id that has this vector, which is then no candidate for itself
    blocked = different.select(F.pmod(F.xxhash64("first", "hash"), F.lit(right)).alias("block"), "size", "first", "hash", only.alias("only"), "exact")
    file = settled(blocked.mapInArrow(approximate, "block long, size int, first long, hash long, only long, codes binary"), "va-file")

    queries = settled(rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")), "queries")
    given = queries.select(F.size("v").alias("qs"), F.pmod(F.xxhash64("id"), F.lit(left)).alias("qb"), F.col("id").alias("q_id"), F.col("v").alias("q"))
    given = given.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(right - 1).cast("long"))))
    scanned = file.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(left - 1).cast("long"))))

    def meet(key, one: pa.Table, two: pa.Table) -> pa.Table:
        out = {c: [np.zeros(0, t)] for c, t in zip(_BOUND_ARROW.names, (np.int64,) * 3 + (float,) * 2, strict=True)}
        if one.num_rows and two.num_rows:
            own, m = cells[key[0].as_py()], key[0].as_py()
            q = np.array(one.column("q").to_pylist(), np.int64).reshape(one.num_rows, m)
            ids, first, told = one.column("q_id").to_numpy(), two.column("first").to_numpy(), two.column("hash").to_numpy()
            alone = two.column("only").fill_null(0).to_numpy()
            single = two.column("only").is_valid().to_numpy()
            codes = own.unpack(two.column("codes").to_pylist())
            for at in range(0, len(q), 128):
                middle, radius = own.bounds(q[at : at + 128], codes)
                middle[(alone[None, :] == ids[at : at + 128, None]) & single[None, :]] = -np.inf
                if middle.shape[1] > k:  # the kth lower bound is the kth middle less the radius
                    kth = np.partition(middle, middle.shape[1] - k, axis=1)[:, -k]
                else:
                    kth = np.full(len(middle), -np.inf)
                i, j = np.nonzero((middle + radius[:, None] >= (kth - radius)[:, None]) & np.isfinite(middle))
                for c, x in zip(_BOUND_ARROW.names, (ids[at + i], first[j], told[j], middle[i, j] - radius[i], middle[i, j] + radius[i]), strict=True):
                    out[c].append(x)
        return pa.Table.from_batches([batch(_BOUND_ARROW, **{c: np.concatenate(x) for c, x in out.items()})])

    bounds = given.groupBy("qs", "qb", "cb").cogroup(scanned.groupBy("size", "qb", "block")).applyInArrow(lambda key, one, two: meet(key, one, two), "query_id long, first long, hash long, lower double, upper double")
    bounds = bounds.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("lower"))))
    least = F.max(F.when(F.col("nth") == k, F.col("lower"))).over(Window.partitionBy("query_id"))
    certain = bounds.withColumn("least", least).where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    read = certain.join(different, ["first", "hash"]).select("query_id", "upper", "exact", "ids")

    def decide(one: pa.Table, two: pa.Table) -> pa.Table:
        found = []
        for name, q in zip(one.column("id").to_pylist(), one.column("v").to_pylist(), strict=True):
            some = [(u, x, [(e["id"], e["rows"]) for e in ids]) for u, x, ids in zip(*(two.column(c).to_pylist() for c in ("upper", "exact", "ids")), strict=True)]
            found += [(name, n, i, s) for n, (s, i) in enumerate(exact_best(np.array(q, np.int64), name, some, kind, k), 1)]
        return pa.Table.from_batches([batch(_FOUND_ARROW, **{c: [r[j] for r in found] for j, c in enumerate(_FOUND_ARROW.names)})])

    return queries.groupBy("id").cogroup(read.groupBy("query_id")).applyInArrow(decide, "query_id long, rank int, vec_id long, score long")


def op6_topk_search(spark, sf_dir: str) -> DataFrame:
    """The five best other rows of every row whose id is divisible by 50."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, 5)


ORACLE_SQL = """
with e as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from e q join e c on q.vec_id != c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""
