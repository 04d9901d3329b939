"""Patched frame-of-reference blocks for token ids, and the shard format built of them.

A block holds ``BLOCK`` unsigned 32-bit ids: their minimum is subtracted, what
is left is packed at the width that a given percentile of them needs, and the
rest, the exceptions, stand in a list of (position, value). All numbers are
little-endian. A shard is

    magic "BFPF", version u32, block size u32, documents u64, ids u64, blocks u64,
    per document: doc_id i64, flag u8 (1: the id is null), length u64,
    per block: its start in the body u64 (one more at the end),
    body: per block minimum u32, width u8, exceptions u16, packed words,
          then per exception its position u16 and its full difference u32.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 128
PERCENTILE = 95.0
_HEAD = struct.Struct("<4sIIQQQ")
_MAGIC = b"BFPF"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``values`` (blocks, size) below 2**width, as rows of 64-bit words."""
    lanes, size = np.ascontiguousarray(values.T.astype(np.uint64)), values.shape[1]
    out = np.zeros((-(-size * width // 64), len(values)), np.uint64)
    for j in range(size):
        word, at = divmod(j * width, 64)
        out[word] |= lanes[j] << np.uint64(at)
        if at + width > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - at)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int, size: int) -> np.ndarray:
    lanes = np.ascontiguousarray(words.T)
    out = np.zeros((size, words.shape[0]), np.uint64)
    keep = np.uint64((1 << width) - 1)
    for j in range(size if width else 0):
        word, at = divmod(j * width, 64)
        x = lanes[word] >> np.uint64(at)
        if at + width > 64:
            x = x | (lanes[word + 1] << np.uint64(64 - at))
        out[j] = x & keep
    return out.T


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The body for ``ids`` and the starts of its blocks (one more at the end). The last block repeats its last id."""
    n = len(ids)
    if not n:
        return b"", np.zeros(1, np.uint64)
    blocks = -(-n // block)
    padded = np.empty(blocks * block, np.uint32)
    padded[:n], padded[n:] = ids, ids[-1]
    rows = padded.reshape(blocks, block)
    low = rows.min(1)
    rest = rows - low[:, None]
    kept = min(block - 1, max(0, int(np.ceil(block * percentile / 100)) - 1))
    wide = np.partition(rest, kept, axis=1)[:, kept]
    width = np.frexp(wide.astype(np.float64))[1].astype(np.uint8)  # bits of each
    odd = rest >> np.minimum(width, 31)[:, None] > 0
    odd[width == 32] = False
    extra = odd.sum(1)
    sizes = 7 + 8 * (-(-block * width.astype(np.int64) // 64)) + 6 * extra
    starts = np.zeros(blocks + 1, np.uint64)
    np.cumsum(sizes, out=starts[1:])
    body = np.zeros(int(starts[-1]), np.uint8)
    at = starts[:-1].astype(np.int64)
    body[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    body[at + 4] = width
    body[at[:, None] + np.arange(5, 7)] = extra.astype("<u2").view(np.uint8).reshape(-1, 2)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = _pack(np.where(odd[own], np.uint32(0), rest[own]), int(w)).view(np.uint8)
            body[(at[own] + 7)[:, None] + np.arange(packed.shape[1])] = packed
    if extra.any():
        row, place = np.nonzero(odd)
        first = np.repeat(np.cumsum(extra) - extra, extra)
        here = at[row] + sizes[row] - 6 * extra[row] + 6 * (np.arange(len(row)) - first)
        body[here[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        body[here[:, None] + np.arange(2, 6)] = rest[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return body.tobytes(), starts


def decode_blocks(body: bytes | np.ndarray, starts: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The first ``n`` ids of the blocks that begin at ``starts``."""
    if not n:
        return np.zeros(0, np.uint32)
    body = np.frombuffer(body, np.uint8) if isinstance(body, (bytes, memoryview)) else body
    at = starts[:-1].astype(np.int64)
    low = body[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width = body[at + 4]
    extra = body[at[:, None] + np.arange(5, 7)].copy().view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(at), block), np.uint32)
    for w in np.unique(width):
        own, words = np.flatnonzero(width == w), -(-block * int(w) // 64)
        if w:
            packed = body[(at[own] + 7)[:, None] + np.arange(8 * words)].copy().view("<u8")
            out[own] = _unpack(packed, int(w), block)
    if extra.any():
        row = np.repeat(np.arange(len(at)), extra)
        first = np.repeat(np.cumsum(extra) - extra, extra)
        here = starts[1:].astype(np.int64)[row] - 6 * extra[row] + 6 * (np.arange(len(row)) - first)
        place = body[here[:, None] + np.arange(2)].copy().view("<u2").ravel()
        out[row, place] = body[here[:, None] + np.arange(2, 6)].copy().view("<u4").ravel()
    return (out + low[:, None]).ravel()[:n]


def encode_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    body, starts = encode_blocks(ids, percentile)
    known = np.array([x is not None for x in doc_ids], bool)
    head = _HEAD.pack(_MAGIC, 1, BLOCK, len(doc_ids), len(ids), len(starts) - 1)
    names = np.array([x or 0 for x in doc_ids], "<i8")
    return b"".join((head, names.tobytes(), (~known).astype(np.uint8).tobytes(), np.asarray(lengths, "<u8").tobytes(), starts.astype("<u8").tobytes(), body))


class Shard:
    """Reads one shard; ``ids(i)`` decodes only the blocks that hold document i."""

    def __init__(self, raw: bytes):
        magic, version, self.block, docs, self.n, blocks = _HEAD.unpack_from(raw)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a shard of token ids")
        at = _HEAD.size
        names = np.frombuffer(raw, "<i8", docs, at)
        null = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [None if x else int(n) for n, x in zip(names, null, strict=True)]
        self.lengths = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths))).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", blocks + 1, at + 17 * docs)
        self.body = np.frombuffer(raw, np.uint8, offset=at + 17 * docs + 8 * (blocks + 1))

    def all_ids(self) -> np.ndarray:
        return decode_blocks(self.body, self.starts, self.n, self.block)

    def ids(self, i: int) -> np.ndarray:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        if a == b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block, -(-b // self.block)
        got = decode_blocks(self.body, self.starts[first : last + 1], (last - first) * self.block, self.block)
        return got[a - first * self.block : b - first * self.block]
