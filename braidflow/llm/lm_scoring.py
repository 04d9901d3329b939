"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation, over counts of the whole corpus.

Tokens are runs of bytes other than white space, with A-Z lower-cased, and one
end token for each text. The work goes through blocks of texts:

1. every task codes its texts in blocks of at most ``BLOCK_TOKENS`` tokens
   against the block's own dictionary, so that only a block's distinct tokens,
   not the tokens of its texts, are shuffled to be counted; they are dealt by hash to
   ``CELLS`` cells, and a block's tokens of one cell travel as one row;
2. the counts of all tokens over all training texts are summed cell by cell, and each
   block gets back the counts of its own tokens;
3. the ``CLASSES`` most frequent tokens are classes of their own. All others are
   dealt by hash to S x S slots in S further classes, S the cube root of their
   number, so that a slot has about S tokens however large the corpus is; within
   its slot a token is a leaf;
4. texts are dealt by hash into shards of about ``SHARD_TOKENS`` tokens; each shard
   trains a copy of classes and contexts, and the copies are averaged by number of
   tokens (``ROUNDS`` times, after a first round over one shard in ``WARM``);
5. all places where a token of one of the S classes stands meet, in replicas of
   about ``CLASS_PLACES`` places told by a hash of the text. Each replica trains
   vectors for the class's slots and for every single token in them, the contexts
   being those of step 4, and scores the places it holds;
6. scoring multiplies contexts with all output vectors of a class's level, so every
   probability is normalised exactly by matrix products: over the classes, over
   the slots of a class and over the tokens of a slot.

The model: the vector predicted from the two tokens before, ``Q[a] A + Q[b] B``,
times an output vector, plus its bias. As context a frequent token has a vector of
its own and any other that of its slot. Noise words are drawn from the training
frequencies, ``NOISE`` for each mini-batch. A token that no training text holds is
leaf 0 of its slot, which counts as one occurrence.

What is learnt is ordered by its content before it is shuffled, so scores do not
depend on how the rows were dealt to tasks, but for rounding.

Null texts are empty: the end token alone. Repeated ids: a row for each. Without
any training text all counts are 0 and the one class has probability 1. An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import batch, doc_crc, forget, mix64, pieces, settled, string_hashes

BLOCK_TOKENS = 4_000_000
BLOCK_BYTES = 64 << 20
#: Parts of the dictionary, told by the first bits of a token's hash; a task holds one cell of all blocks at a time.
CELL_BITS = 10
CELLS = 1 << CELL_BITS
#: Tokens whose places are sorted by class at a time.
PLACES_TOKENS = 1_000_000
CLASSES = 255
WIDTH = 24
NOISE = 64
ROUNDS = 1
#: Tokens of a shard of the training texts, on average, that one copy of the classes and contexts is trained on.
SHARD_TOKENS = 2_500_000
#: One in so many shards gives the parameters that the first round starts from.
WARM = 8
#: Places of a class, on average, that one replica of it is trained on and scores.
CLASS_PLACES = 2_000_000
MINI_BATCH = 2048
#: Stands for the end of a text; no word can hold it.
END = b"\n"

_CODED = "block long, doc_id long, hash long, train boolean, ids binary, tokens long, cell int, words binary"
_CODED_ARROW = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("train", pa.bool_()), ("ids", pa.binary()), ("tokens", pa.int64()), ("cell", pa.int32()), ("words", pa.binary())])
_CLASSED = "block long, doc int, doc_id long, hash long, train boolean, n_tokens long, n_known long, base_score double, codes binary, leaves binary"
_CLASSED_ARROW = pa.schema([("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("codes", pa.binary()), ("leaves", pa.binary())])


_PRESS, _UNPRESS = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def press(raw: bytes) -> bytes:
    return _PRESS.compress(raw)


def unpress(raw: bytes) -> bytes:
    return _UNPRESS.decompress(raw)


def packed(x: np.ndarray) -> bytes:
    """32-bit values, all their first bytes before all their second ones, compressed."""
    return _PRESS.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNPRESS.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def words_packed(tokens: pa.Array, local: np.ndarray, n: np.ndarray) -> bytes:
    """Tokens, their numbers in their block's dictionary and their training counts, compressed."""
    offsets = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
    data = tokens.buffers()[2]
    head = np.concatenate(([len(tokens)], np.diff(offsets), local, n)).astype("<i8").tobytes()
    return _PRESS.compress(head + (data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data else b""))


def words_unpacked(raws: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of several packs as a dictionary of the distinct ones, their numbers, their counts, and how many each pack has."""
    held: tuple[list, ...] = ([], [], [], [])
    for raw in raws:
        raw = _UNPRESS.decompress(raw)
        k = int(np.frombuffer(raw, "<i8", 1)[0])
        for j in range(3):
            held[j].append(np.frombuffer(raw, "<i8", k, 8 + 8 * j * k))
        held[3].append(raw[8 + 24 * k :])
    lengths, local, n = (np.concatenate(x) for x in held[:3])
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    tokens = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(held[3]))])
    return tokens.dictionary_encode(), local, n, np.array([len(x) for x in held[0]])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words of the texts one after another, each word's length, and how many words each text has."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = _LOWER[np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]  # words end with their text
    starts = np.flatnonzero(begins)
    before = np.cumsum(inside)
    at = before[starts] - 1
    return data[inside], np.diff(np.append(at, int(before[-1]) if len(before) else 0)), np.diff(np.searchsorted(starts, offsets))


def coded(docs: DataFrame, train: Column, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Rows of texts (ids in their block's dictionary, packed) and rows of dictionaries (a block's tokens of one cell, packed)."""

    def code(batches):
        part, seq, names, hashes, trains, held, size, raw = TaskContext.get().partitionId(), 0, [], [], [], [], 0, 0

        def closed():
            block = (part << 32) | seq
            data, lengths, per = (np.concatenate([x[k] for x in held]) for k in range(3))
            places = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            own = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
            ends = np.cumsum(per + 1)
            ids = np.full(len(lengths) + len(per), len(own.dictionary), np.uint32)  # the end of a text comes after the words
            word = np.ones(len(ids), bool)
            word[ends - 1] = False
            ids[word] = own.indices.to_numpy()
            counts = np.bincount(ids[np.repeat(np.array(trains, bool), per + 1)], minlength=len(own.dictionary) + 1)
            none = [None] * len(names)
            yield batch(_CODED_ARROW, block=[block] * len(names), doc_id=names, hash=hashes, train=trains, ids=[press(ids[a:z].tobytes()) for a, z in zip((ends - per - 1).tolist(), ends.tolist(), strict=True)], tokens=per + 1, cell=none, words=none)
            words = pa.concat_arrays([own.dictionary.cast(pa.large_binary()), pa.array([END], pa.large_binary())])
            cell = (string_hashes(words) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            order = by_key(cell, CELLS)
            words, cell, counts = words.take(pa.array(order)), cell[order], counts[order]
            starts = _starts(cell)
            packs = [words_packed(words.slice(a, z - a), order[a:z], counts[a:z]) for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True)]
            none = [None] * len(packs)
            yield batch(_CODED_ARROW, block=[block] * len(packs), doc_id=none, hash=none, train=none, ids=none, tokens=none, cell=cell[starts], words=packs)

        for b in pieces(batches, 256):
            names += b.column("doc_id").to_pylist()
            hashes += b.column("hash").to_pylist()
            trains += b.column("train").to_pylist()
            held.append(words_of(b.column("text")))
            size, raw = size + len(held[-1][1]) + b.num_rows, raw + len(held[-1][0])
            if size >= block_tokens or raw >= BLOCK_BYTES:
                yield from closed()
                names, hashes, trains, held, size, raw, seq = [], [], [], [], 0, 0, seq + 1
        if names:
            yield from closed()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), train.alias("train"), F.col(text_col).cast("string").alias("text"))
    return chosen.withColumn("hash", F.xxhash64("doc_id", "text")).mapInArrow(code, _CODED)


_COUNTED = pa.schema([("token", pa.binary()), ("c", pa.int64()), ("total", pa.int64()), ("types", pa.int64())])


def counted(words: DataFrame, most: int) -> DataFrame:
    """For each cell a row with the sum of its tokens' training counts and how many tokens have any, and its ``most`` frequent tokens."""

    def count(table: pa.Table) -> pa.Table:
        tokens, _, n, _ = words_unpacked(table.column("words").to_pylist())
        c = np.bincount(tokens.indices.to_numpy(), n, len(tokens.dictionary)).astype(np.int64)
        known = np.flatnonzero(c)
        if len(known) > most:
            known = known[c[known] >= -np.partition(-c[known], most - 1)[most - 1]]
        some = pa.table({"token": tokens.dictionary.take(pa.array(known)), "c": c[known]}).sort_by([("c", "descending"), ("token", "ascending")]).slice(0, most)
        return pa.Table.from_batches([batch(_COUNTED, token=[None, *some.column("token").to_pylist()], c=[None, *some.column("c").to_pylist()], total=[int(c.sum()), *[None] * len(some)], types=[int((c > 0).sum()), *[None] * len(some)])])

    return words.groupBy("cell").applyInArrow(count, "token binary, c long, total long, types long")


_TYPES = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("local", pa.binary()), ("code", pa.binary()), ("leaf", pa.binary()), ("c", pa.binary()), ("total", pa.int64())])


def cells_joined(slots: int) -> int:
    """How many cells, a power of two, share slots, so that there is one at least for each group of cells."""
    k = 1
    while k < CELLS and CELLS // k > slots:
        k *= 2
    return k


def numbered(words: DataFrame, top: list[bytes], parts: int) -> DataFrame:
    """For each block its tokens' numbers, codes, leaves and counts, and for each of the ``parts`` classes (rows without a block) slot, leaf and count of its tokens.

    Each group of cells has slots of its own, to which a token is dealt by the last bits of its hash.
    """
    slots = parts * parts
    joined = cells_joined(slots)
    groups = CELLS // joined

    def number(key, table: pa.Table) -> pa.Table:
        tokens, local, n, sizes = words_unpacked(table.column("words").to_pylist())
        at, every = tokens.indices.to_numpy(), tokens.dictionary
        c = np.bincount(at, n, len(every)).astype(np.int64)
        told = string_hashes(every)
        low, high = (int(key[0].as_py()) * slots // groups, (int(key[0].as_py()) + 1) * slots // groups)
        slot = low + ((told & np.uint64(0xFFFFFFFF)) * np.uint64(high - low) >> np.uint64(32)).astype(np.int64)
        cls = pc.index_in(every, value_set=pa.array(top, pa.large_binary())).fill_null(-1).to_numpy()
        member = np.flatnonzero((cls < 0) & (c > 0))
        member = member[np.lexsort((told[member], slot[member]))]
        starts = _starts(slot[member])
        leaf = np.zeros(len(every), np.int64)  # 0: tokens that no training text holds
        leaf[member] = np.arange(len(member)) - np.repeat(starts, np.diff(starts, append=len(member))) + 1
        code, rows, a = np.where(cls < 0, slot + len(top), cls), [], 0
        for block, size in zip(table.column("block").to_pylist(), sizes.tolist(), strict=True):
            of = at[a : a + size]
            rows.append((block, None, packed(local[a : a + size]), packed(code[of]), packed(leaf[of]), press(c[of].tobytes()), None))
            a += size
        part = slot[member] // parts
        edges = _starts(part)
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(part)], strict=False):
            of = member[a:z]
            rows.append((None, int(part[a]), packed(slot[of] % parts), None, packed(leaf[of]), press(c[of].tobytes()), int(c[of].sum())))
        return pa.Table.from_batches([batch(_TYPES, **{k: [r[j] for r in rows] for j, k in enumerate(_TYPES.names)})])

    schema = "block long, part int, local binary, code binary, leaf binary, c binary, total long"
    return words.select("block", "words", F.floor(F.col("cell") / joined).alias("cells")).groupBy("cells").applyInArrow(lambda key, table: number(key, table), schema)


def _every(column: pa.ChunkedArray, of=unpacked) -> np.ndarray:
    return np.concatenate([of(x) for x in column.to_pylist()] or [np.zeros(0, np.uint32)])


def _longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(unpress(raw), np.int64)


def classed(texts: DataFrame, words: DataFrame, total: int, distinct: int, top: int) -> DataFrame:
    """For each text the base score, the codes of its tokens (class or, after the ``top`` classes, slot) and the leaves of those in slots."""

    def join(key, left: pa.Table, right: pa.Table) -> pa.Table:
        local = _every(right.column("local"))
        count, code, leaf = (np.zeros(len(local), t) for t in (np.int64, np.uint32, np.uint32))
        count[local], code[local], leaf[local] = _every(right.column("c"), _longs), _every(right.column("code")), _every(right.column("leaf"))
        base, inside, known = np.log10((count + 1) / (total + distinct + 1)), code >= top, count > 0
        rows = []
        for doc, (name, told, train, raw) in enumerate(zip(*(left.column(k).to_pylist() for k in ("doc_id", "hash", "train", "ids")), strict=True)):
            ids = np.frombuffer(unpress(raw), np.uint32)
            rows.append((key[0].as_py(), doc, name, told, train, len(ids), int(np.count_nonzero(known[ids])), float(base[ids].sum()), packed(code[ids]), packed(leaf[ids[inside[ids]]])))
        return pa.Table.from_batches([batch(_CLASSED_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_CLASSED_ARROW.names)})])

    named = words.select(F.col("block").alias("of"), "local", "c", "code", "leaf")
    return texts.groupBy("block").cogroup(named.groupBy("of")).applyInArrow(lambda key, left, right: join(key, left, right), _CLASSED)


class Model:
    """Parameters: input vectors (frequent tokens, slots and a start mark), two context matrices, output vectors with their biases as last component.

    The last ``parts`` of the classes whose ``shares`` are given have ``parts`` slots each; without any, inputs are classes.
    """

    NAMES = ("inp", "ab", "out")

    def __init__(self, shares: np.ndarray, width: int = WIDTH, seed: int = 7, parts: int = 0):
        rng, n = np.random.default_rng(seed), len(shares)
        self.noise, self.parts, self.top = shares, parts, n - parts
        self.of = np.concatenate((np.arange(self.top), self.top + np.repeat(np.arange(parts), parts)))  # the class of each code
        self.inp = rng.normal(0, 0.1, (len(self.of) + 1, width)).astype(np.float32)
        self.ab = (np.tile(np.eye(width), (2, 1)) * 0.5 + rng.normal(0, 0.05, (2 * width, width))).astype(np.float32)  # A above B
        self.out = np.column_stack((rng.normal(0, 0.1, (n, width)), np.log(shares))).astype(np.float32)

    def halves(self) -> tuple[np.ndarray, np.ndarray]:
        """What a code adds to the predicted vector as the token two places before, and as the one before."""
        return self.inp @ self.ab[: self.inp.shape[1]], self.inp @ self.ab[self.inp.shape[1] :]

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            x = getattr(self, k)
            setattr(self, k, flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size

    def log_probabilities(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Natural logarithms for classes ``w`` after ``x`` and then ``y``, normalised over all classes."""
        place, pairs = pd.factorize(x.astype(np.int64) * len(self.inp) + y)
        first, second = with_biases(*self.halves())
        r = predicted(first, second, pairs // len(self.inp), pairs % len(self.inp))
        norm = log_norms(r, self.out)
        result = np.empty(len(w), np.float64)
        for at in range(0, len(w), 1 << 16):
            p, c = place[at : at + (1 << 16)], w[at : at + (1 << 16)]
            result[at : at + (1 << 16)] = np.einsum("ij,ij->i", r.take(p, axis=0), self.out.take(c, axis=0)) - norm[p]
        return result


def with_biases(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Halves whose sums end with 1, which meets the bias of an output vector."""
    return np.column_stack((first, np.ones(len(first), np.float32))), np.column_stack((second, np.zeros(len(second), np.float32)))


def predicted(first: np.ndarray, second: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    r = first.take(x, axis=0)
    r += second.take(y, axis=0)
    return r


def log_norms(r: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The logarithm of the sum of exp(r out) over all output vectors, for each row of ``r``; both have the bias's component."""
    norm, turned, ones = np.empty(len(r), np.float32), out.T.copy(), np.ones(len(out), np.float32)
    rows = max(256, 200_000 // len(out))
    held = np.empty((min(rows, len(r)), len(out)), np.float32)
    longest = [np.sqrt(np.einsum("ij,ij->i", v[:, :-1], v[:, :-1]).max(initial=0)) for v in (r, out)]
    low = longest[0] * longest[1] + out[:, -1].max() <= 60  # no product can be larger
    for at in range(0, len(r), rows):
        some = r[at : at + rows]
        z = np.matmul(some, turned, out=held[: len(some)])
        if low or z.max() <= 60:
            norm[at : at + rows] = np.log(np.exp(z, out=z) @ ones + np.float32(1e-35))
        else:
            top = z.max(1)
            z -= top[:, None]
            norm[at : at + rows] = np.log(np.exp(z, out=z) @ ones) + top
    return norm


def by_key(keys: np.ndarray, n: int) -> np.ndarray:
    """The stable order of keys below ``n``: 16 bits at a time, which are sorted by counting."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    for bits in range(16, max(n - 1, 0).bit_length(), 16):
        order = order[np.argsort((keys[order] >> bits).astype(np.uint16), kind="stable")]
    return order


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each key begins among sorted ones."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new)


def sums_by_key(keys: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur, all below ``n``, and the sum of each one's rows of ``values``."""
    order = by_key(keys, n)
    keys = keys[order]
    first = _starts(keys)
    sums = values.take(order[first], axis=0)
    size = np.diff(first, append=len(keys))
    many = np.flatnonzero(size > 1)  # most keys stand once, and their rows are the sums
    if len(many):
        size = size[many]
        starts = np.cumsum(size) - size
        rows = order[np.repeat(first[many] - starts, size) + np.arange(size.sum())]
        sums[many] = np.add.reduceat(values.take(rows, axis=0), starts, axis=0)
    return keys[first], sums


def gradients(r: np.ndarray, w: np.ndarray, out: np.ndarray, drawn: np.ndarray, log_noise: np.ndarray, contexts: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The gradients of noise-contrastive estimation, as steep as in batches of 64: of all output vectors and, if wanted, of each context.

    ``r`` are the contexts, ending with 1, and ``w`` their targets, which are sorted.
    """
    own, noise = out.take(w, axis=0), out.take(drawn, axis=0)
    eg = (probabilities(log_noise[w] - np.einsum("ij,ij->i", r, own)) - 1) * np.float32(1 / 64)
    # 1 / (1 + exp(z)) is (tanh(z / 2) - 1) / -2
    half = noise * np.float32(-0.5)
    half[:, -1] += log_noise[drawn] * np.float32(0.5)
    eb = r @ half.T
    np.tanh(eb, out=eb)
    eb -= 1
    grad, first = np.zeros_like(out), _starts(w)
    grad[w[first]] = np.add.reduceat(eg[:, None] * r, first, axis=0)
    np.add.at(grad, drawn, (r.T @ eb).T * np.float32(-0.5 / 64))
    if not contexts:
        return grad, None
    of = eb @ (noise[:, :-1] * np.float32(-0.5 / 64))
    of += own[:, :-1] * eg[:, None]
    return grad, of


def descend(values: np.ndarray, sums: np.ndarray, g: np.ndarray, rate: float, at: np.ndarray | None = None) -> None:
    """A step of AdaGrad, in the rows ``at`` or all of them."""
    own = sums if at is None else sums.take(at, axis=0)
    own += g * g
    step = np.sqrt(own)
    np.divide(g, step, out=step)
    step *= np.float32(rate)
    if at is None:
        values -= step
    else:
        sums[at] = own
        values[at] = values.take(at, axis=0) - step


class Trainer:
    """Noise-contrastive estimation by mini-batches, with AdaGrad."""

    def __init__(self, model: Model, noise: int = NOISE, rate: float = 0.08, seed: int = 1):
        self.m, self.k, self.rate, self.rng = model, noise, rate, np.random.default_rng(seed)
        self.sums = {k: np.full_like(getattr(model, k), 0.1) for k in Model.NAMES}
        self.cumulative = np.cumsum(model.noise)
        self.log_noise = np.log(noise * model.noise).astype(np.float32)

    def step(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        m, n, width = self.m, len(w), self.m.inp.shape[1]
        order = by_key(w, len(m.out))
        w, both = w[order], np.stack((x[order], y[order]), 1)
        q = m.inp.take(both, axis=0).reshape(n, 2 * width)
        r = np.ones((n, width + 1), np.float32)
        np.matmul(q, m.ab, out=r[:, :-1])
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.k) * self.cumulative[-1]), len(m.noise) - 1)
        grad, dr = gradients(r, w, m.out, drawn, self.log_noise, True)
        used, grads = sums_by_key(both.ravel(), (dr @ m.ab.T).reshape(2 * n, width), len(m.inp))
        ab = q.T @ dr
        descend(m.inp, self.sums["inp"], grads, self.rate, used)
        descend(m.ab, self.sums["ab"], ab, self.rate)
        descend(m.out, self.sums["out"], grad, self.rate)


def probabilities(z: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(z)), in the array's own memory."""
    with np.errstate(over="ignore"):
        np.exp(z, out=z)
    z += 1
    return np.reciprocal(z, out=z)


def contexts(texts: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two classes before each token, the start mark before the first, and the tokens' classes."""
    w = np.concatenate(texts)
    first = np.cumsum([0] + [len(t) for t in texts[:-1]])
    y = np.empty_like(w)
    y[1:], y[first] = w[:-1], start
    x = np.empty_like(w)
    x[1:], x[first] = y[:-1], start
    return x, y, w


def trained(texts: DataFrame, model: Model, shards: int, of: int = 1, rate: float = 0.08) -> None:
    """One round over the shards whose number is a multiple of ``of``: each trains a copy of the model, and the copies are averaged by tokens seen.

    A shard's texts are told by a hash of what they are, and what a copy is trained on is ordered by its content, so the
    result does not depend on how the rows were dealt or ordered.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("flat", pa.binary())])

    def local(key, table: pa.Table) -> pa.Table:
        own = Model(shared.value.noise, shared.value.inp.shape[1], parts=shared.value.parts)
        own.load(shared.value.flat())
        seen = _epoch(Trainer(own, rate=rate), [unpacked(v.as_py()) for v in table.column("codes")])
        return pa.table({"shard": [key[0].as_py()], "n": [seen], "flat": pa.array([(own.flat() * np.float32(seen)).tobytes()], pa.binary())}, schema=schema)

    def added(key, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["shard"])
        return pa.table({"shard": [key[0].as_py()], "n": [sum(r["n"] for r in rows)], "flat": pa.array([_sum_of(r["flat"] for r in rows).tobytes()], pa.binary())}, schema=schema)

    wanted = F.col("train") & (F.col("shard") % of == 0)
    dealt = texts.withColumn("shard", F.pmod("hash", F.lit(shards))).where(wanted).select("shard", "codes")
    parts = settled(dealt.groupBy("shard").applyInArrow(lambda key, table: local(key, table), "shard long, n long, flat binary"), "parameters")
    while parts.count() > 16:  # sums of 16 at a time, so that the driver gets 16 rows at most
        # A batch of copies is as much as a task of sums holds.
        sums = parts.withColumn("shard", F.floor(F.col("shard") / (16 * of))).groupBy("shard").applyInArrow(lambda key, table: added(key, table), "shard long, n long, flat binary")
        before, parts, of = parts, settled(sums, "parameters"), 1
        forget(before)
    rows = sorted(tuple(r) for r in parts.collect())
    forget(parts)
    if rows:
        model.load((_sum_of(r[2] for r in rows).astype(np.float64) / sum(r[1] for r in rows)).astype(np.float32))


def _sum_of(flats) -> np.ndarray:
    total = None
    for x in flats:
        x = np.frombuffer(x if isinstance(x, bytes | bytearray) else x.as_py(), np.float32)
        total = x.astype(np.float64) if total is None else total + x
    return total.astype(np.float32)


def _epoch(trainer: Trainer, texts: list[np.ndarray]) -> int:
    x, y, w = contexts(texts, len(trainer.m.of))
    texts.clear()
    w = trainer.m.of.astype(np.uint32)[w]
    order = shuffled(trainer.rng, x, y, w)
    x, y, w = x[order], y[order], w[order]
    for at in range(0, len(w), MINI_BATCH):
        some = slice(at, at + MINI_BATCH)
        trainer.step(x[some], y[some], w[some])
    return len(w)


def shuffled(rng: np.random.Generator, *columns: np.ndarray) -> np.ndarray:
    """A random order of the rows that is the same whatever order they come in: they are sorted by content, where equal rows are alike, before they are shuffled."""
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = mix64(key * np.uint64(0xD1342543DE82EF95) + c.astype(np.uint64))
    return np.argsort(key)[rng.permutation(len(key))]


_SCORED_ARROW = pa.schema([("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORED = "block long, doc int, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
_PLACES_ARROW = pa.schema([("part", pa.int32()), ("replica", pa.int32()), ("block", pa.int64()), *((k, pa.binary()) for k in ("x", "y", "slot", "leaf", "doc"))])
_SUMS_ARROW = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary())])


def scores(texts: DataFrame, model: Model) -> DataFrame:
    """The texts' scores over the classes."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        own = shared.value

        def closed(rows, held):
            x, y, w = contexts(held, len(own.of))
            p = np.concatenate(([0.0], np.cumsum(own.log_probabilities(x, y, own.of[w]) / np.log(10))))
            ends = np.cumsum([len(t) for t in held])
            total = np.diff(np.concatenate(([0.0], p[ends])))
            return batch(_SCORED_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_SCORED_ARROW.names[:-1])}, score=total)

        rows, held, size = [], [], 0
        for b in pieces(batches):
            columns = [b.column(k).to_pylist() for k in (*_SCORED_ARROW.names[:-1], "codes")]
            for *row, raw in zip(*columns, strict=True):
                rows.append(row)
                held.append(unpacked(raw))
                size += len(held[-1])
                if size >= 1_000_000:
                    yield closed(rows, held)
                    rows, held, size = [], [], 0
        if rows:
            yield closed(rows, held)

    return texts.select(*_SCORED_ARROW.names[:-1], "codes").mapInArrow(scored, _SCORED)


def places(texts: DataFrame, top: int, parts: int, replicas: int) -> DataFrame:
    """Where tokens in slots stand: their contexts, slots, leaves and texts (twice the number, and 1 in training texts), by class, replica and block."""

    def found(batches):
        def closed(block, held, leaves, docs, hashes):
            x, y, w = contexts(held, top + parts * parts)
            long = [len(t) for t in held]
            doc, copy = np.repeat(np.array(docs, np.uint32), long), np.repeat(np.array(hashes, np.int64) // 64 % replicas, long)
            inside = w >= top
            slot, leaf = w[inside] - np.uint32(top), np.concatenate(leaves)
            own = (slot // parts).astype(np.int64) * replicas + copy[inside]
            order = by_key(own, parts * replicas)
            columns = [c[order] for c in (x[inside], y[inside], slot % parts, leaf, doc[inside])]
            own = own[order]
            starts = _starts(own)
            rows = [[packed(c[a:z]) for c in columns] for a, z in zip(starts, [*starts, len(own)][1:], strict=True)]
            return batch(_PLACES_ARROW, part=own[starts] // replicas, replica=own[starts] % replicas, block=[block] * len(rows), **{k: [r[j] for r in rows] for j, k in enumerate(_PLACES_ARROW.names[3:])})

        at, held, leaves, docs, hashes, size = None, [], [], [], [], 0
        for b in pieces(batches):
            for block, doc, told, train, codes, leaf in zip(*[b.column(k).to_pylist() for k in ("block", "doc", "hash", "train", "codes", "leaves")], strict=True):
                if held and (block != at or 2 * doc < docs[-1] or size >= PLACES_TOKENS):  # a row's texts ascend
                    yield closed(at, held, leaves, docs, hashes)
                    held, leaves, docs, hashes, size = [], [], [], [], 0
                at = block
                held.append(unpacked(codes))
                leaves.append(unpacked(leaf))
                docs.append(2 * doc + train)
                hashes.append(told)
                size += len(held[-1])
        if held:
            yield closed(at, held, leaves, docs, hashes)

    return texts.select("block", "doc", "hash", "train", "codes", "leaves").mapInArrow(found, "part int, replica int, block long, x binary, y binary, slot binary, leaf binary, doc binary")


class Level:
    """Output vectors of the slots of a class or the tokens of a slot, from 0 (the counts alone), under contexts that stay as they are."""

    def __init__(self, counts: np.ndarray, width: int):
        self.shares = counts / counts.sum()
        self.out = np.column_stack((np.zeros((len(counts), width)), np.log(self.shares))).astype(np.float32)

    def train(self, r, w: np.ndarray, rng, noise: int, size: int, rate: float = 0.08) -> None:
        """One pass of noise-contrastive estimation over the places in their order; ``r`` gives the contexts at some of them."""
        if len(self.out) < 2:
            return
        sums, cumulative, log_noise = np.full_like(self.out, 0.1), np.cumsum(self.shares), np.log(noise * self.shares).astype(np.float32)
        for at in range(0, len(w), size):
            order = at + by_key(w[at : at + size], len(self.out))
            drawn = np.minimum(np.searchsorted(cumulative, rng.random(noise) * cumulative[-1]), len(cumulative) - 1)
            descend(self.out, sums, gradients(r(order), w[order], self.out, drawn, log_noise, False)[0], rate)

    def log_probabilities(self, r: np.ndarray, w: np.ndarray) -> np.ndarray:
        if len(self.out) < 2:
            return np.zeros(len(w), np.float32)
        p = log_norms(r, self.out)
        np.negative(p, out=p)
        for at in range(0, len(w), 1 << 16):
            p[at : at + (1 << 16)] += np.einsum("ij,ij->i", r[at : at + (1 << 16)], self.out.take(w[at : at + (1 << 16)], axis=0))
        return p


def within(first: np.ndarray, second: np.ndarray, x, y, slot, leaf, train, members: tuple[np.ndarray, np.ndarray, np.ndarray], parts: int, seed: int) -> np.ndarray:
    """Natural logarithms, at every place, of the slot in its class and the token in its slot, learnt where ``train`` holds.

    ``members``: slot, leaf and count of the class's tokens.
    """
    rng, width = np.random.default_rng(seed), first.shape[1]
    first, second = with_biases(first, second)
    order = shuffled(rng, x, y, slot, leaf, train)
    order = order[by_key(slot[order], parts)]  # by slot, and within one the same however the places came
    x, y, slot, leaf, train = x[order], y[order], slot[order], leaf[order], train[order]
    of, number, count = members
    whole = Level(np.bincount(of, count, parts) + 1.0, width)
    taught = rng.permutation(np.flatnonzero(train))
    tx, ty = x[taught], y[taught]
    whole.train(lambda some: predicted(first, second, tx[some], ty[some]), slot[taught], rng, NOISE, MINI_BATCH)
    p = np.empty(len(slot))
    by = np.argsort(of, kind="stable")
    of, number, count = of[by], number[by], count[by]
    edge, known = np.searchsorted(slot, np.arange(parts + 1)), np.searchsorted(of, np.arange(parts + 1))
    at = 0
    while at < parts:
        end = max(at + 1, int(np.searchsorted(edge, edge[at] + (1 << 16), "right")) - 1)
        some = slice(edge[at], edge[end])
        every = predicted(first, second, x[some], y[some])
        p[some] = whole.log_probabilities(every, slot[some])
        for j in range(at, end):
            if edge[j] == edge[j + 1]:
                continue
            some, own = slice(edge[j], edge[j + 1]), slice(known[j], known[j + 1])
            counts = np.ones(own.stop - own.start + 1)  # leaf 0: tokens that no training text holds
            counts[number[own]] += count[own]
            tokens_of, r, w = Level(counts, width), every[edge[j] - edge[at] : edge[j + 1] - edge[at]], leaf[some]
            here = np.flatnonzero(train[some])
            tokens_of.train(lambda i, r=r, here=here: r.take(here[i], axis=0), w[here], rng, 32, 1024)
            p[some] += tokens_of.log_probabilities(r, w)
        at = end
    out = np.empty(len(p))
    out[order] = p
    return out


def slot_scores(found: DataFrame, members: DataFrame, model: Model, replicas: int) -> DataFrame:
    """For each block the sums over its texts of the log10 probabilities of slots and leaves; a replica of a class in one task."""
    shared = found.sparkSession.sparkContext.broadcast(model.halves())
    parts = model.parts

    def fit(key, left: pa.Table, right: pa.Table) -> pa.Table:
        first, second = shared.value
        blocks = left.column("block").to_pylist()
        x, y, slot, leaf = (_every(left.column(k)) for k in _PLACES_ARROW.names[3:-1])
        docs = [unpacked(v) for v in left.column("doc").to_pylist()]
        doc = np.concatenate(docs or [np.zeros(0, np.uint32)])
        known = tuple(_every(right.column(k), of).astype(np.int64) for k, of in (("local", unpacked), ("leaf", unpacked), ("c", _longs)))
        known = tuple(k[np.lexsort(known[1::-1])] for k in known)
        seed = 0 if key[0].as_py() is None else (key[0].as_py() + 1) * replicas + key[1].as_py()
        p = within(first, second, x, y, slot, leaf, doc % 2 == 1, known, parts, seed) / np.log(10)
        rows, at = [], 0
        for block, some in zip(blocks, docs, strict=True):
            some = some // 2  # ascending
            starts = _starts(some)
            rows.append((block, packed(np.diff(some[starts], prepend=np.uint32(0))), np.add.reduceat(p[at : at + len(some)], starts).astype("<f4").tobytes()))
            at += len(some)
        return pa.Table.from_batches([batch(_SUMS_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_SUMS_ARROW.names)})])

    each = members.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))))
    return found.groupBy("part", "replica").cogroup(each.groupBy("part", "replica")).applyInArrow(lambda key, left, right: fit(key, left, right), "block long, docs binary, sums binary")


def together(scored: DataFrame, sums: DataFrame) -> DataFrame:
    """The texts with the scores of their classes and of what is within them."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        doc = left.column("doc").to_numpy()
        total = np.zeros(int(doc.max(initial=-1)) + 1)
        for docs, part in sorted(zip(right.column("docs").to_pylist(), right.column("sums").to_pylist(), strict=True)):
            total[np.cumsum(unpacked(docs))] += np.frombuffer(part, "<f4")
        return left.set_column(left.schema.get_field_index("score"), "score", pa.array(left.column("score").to_numpy() + total[doc]))

    return scored.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(join, _SCORED)


def parts_for(types: int) -> int:
    """The least S whose S x S slots hold S of so many tokens each."""
    n = max(1, round(types ** (1 / 3)))
    return n if n**3 >= types else n + 1


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, classes: int = CLASSES, width: int = WIDTH, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS, class_places: int = CLASS_PLACES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) of every row; ``train`` says which rows teach."""
    if classes < 1:
        raise ValueError("there must be classes")
    blocks = settled(coded(docs, F.coalesce(train, F.lit(False)), id_col, text_col, block_tokens), "blocks")
    words = blocks.where("cell is not null").select("block", "cell", "words")
    counts = settled(counted(words, classes), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    top = counts.where("token is not null").orderBy(F.desc("c"), "token").limit(classes).collect()
    forget(counts)
    parts = parts_for(distinct - len(top))
    own = settled(numbered(words, [bytes(r.token) for r in top], parts), "types")
    members = own.where("block is null").select("part", "local", "leaf", "c", "total")
    texts = settled(classed(blocks.where("cell is null").select("block", "doc_id", "hash", "train", "ids"), own.where("block is not null"), total, distinct, len(top)), "classes")
    forget(blocks)
    shares = np.ones(len(top) + parts)
    shares[: len(top)] = [r.c for r in top]
    for r in members.groupBy("part").agg(F.sum("total").alias("c")).collect():  # fewer than the cube root of the tokens
        shares[len(top) + r.part] += r.c
    # A class stands in so many replicas that one task's places are bounded, its own and those of texts that do not teach.
    stand = texts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0] - sum(r.c for r in top)
    replicas = max(1, -(-stand // (parts * class_places)))
    model = Model(shares / shares.sum(), width, parts=parts)
    shards = max(1, -(-total // shard_tokens))
    if shards >= 2 * WARM:  # copies that start alike can be averaged
        trained(texts, model, shards, WARM)
    for i in range(rounds):
        trained(texts, model, shards, rate=0.08 / (1 + i))
    result = settled(together(scores(texts, model), slot_scores(places(texts, len(top), parts, replicas), members, model, replicas)), "scores")
    forget(texts, own)
    return result.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of those whose crc32(doc_id) mod 7 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, doc_crc(F.col("doc_id")) % 7 != 2)
