"""Whole texts to token ids with the tokenizers library, each distinct word encoded once.

A tokenizer that first cuts texts at white space gives the same ids for a text
as for its words one by one. ``WordEncoder`` uses that on columns: it cuts the
bytes of many texts at once where the cut provably does not change the ids, has
Arrow find the distinct words, looks up or learns those only, and puts the ids
together with numpy. Words seen before are kept in a bounded cache; unseen ones
go through the library: words of
letters through its model alone, most others in one call. Texts that spell out a
special token and tokenizers of any other build go through the library whole.

Where texts are cut (both kinds of tokenizers end a word there):

- at a space or newline (around it, as a newline is a word of its own), for a
  tokenizer that keeps white space only where the characters on both sides are
  known to be no white space;
- before a sign of ASCII after a letter or digit.

Null is the empty text, which has no ids.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Stands between words that are encoded together; words that hold it are encoded one by one.
_MARK = "\x01"
#: Bytes of text that are cut and looked up at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def default_path(name: str) -> str:
    """A file of the installed public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _kind(path: str) -> str:
    """How this tokenizer cuts texts: before single spaces, at spaces, or neither for sure."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if norm == {} and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return "before spaces"
    steps, cuts = [x.get("type") for x in norm.get("normalizers", [])], pre.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and cuts[0].get("type") == "Split" and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert") and r"[^\s\p{L}\p{N}]+" in cuts[0]["pattern"].get("Regex", ""):
        return "at spaces"
    return "whole"


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, z in ranges:
        out[a : z + 1] = True
    return out


_SEEN = _table((0x21, 0x7E))  # ASCII other than white space and controls
_TWO = _table((0xC3, 0xDF))  # first bytes of two-byte characters, none of them white space
_BEGINS = _table((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF4))  # first bytes of characters none of which is white space
_ALNUM = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_SIGN = _SEEN & ~_ALNUM
_LATIN = _table((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))  # after C3: the letters of U+00C0 to U+00FF

# Words of letters of ASCII and U+00C0 to U+00FF alone: both kinds of tokenizers hand them to their model whole.
_LETTERS = re.compile(rb" ?(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")
# Others that may stand between marks.
_BETWEEN = re.compile(rb"[^\x00-\x20\xc2\xe1-\xe3]+\Z")


def _characters() -> list[str]:
    """How a byte-level vocabulary writes each byte: printable characters of Latin-1 as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordEncoder:
    """``encode(column)`` gives the ids of all texts and where each text's begin; no special tokens are added."""

    def __init__(self, path: str, cached_words: int = 600_000, slice_bytes: int = SLICE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.most, self.slice_bytes = Tokenizer.from_file(path), _kind(path), cached_words, slice_bytes
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)).encode(), re.IGNORECASE) if added else None
        self.hint = os.path.commonprefix(added).encode()
        self.mark = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.kind != "whole":
            mark = self._library([_MARK])[0]
            self.kind = self.kind if len(mark) == 1 else "whole"
            self.mark[mark] = True
        self.characters = dict(enumerate(_characters()))
        self._forget()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # --- the cache: a number for each word, and by number the place of its ids and how many batches held it ---

    def _forget(self) -> None:
        """Start the cache anew with the words that several batches held, at most half of what it may hold."""
        old = getattr(self, "number", {})
        kept = [(w, n) for w, n in old.items() if self.uses[n] > 1][: self.most // 2]
        numbers = np.array([n for _, n in kept], np.int64)
        flat = [self.flat[self.start[n] : self.start[n] + self.length[n]] for n in numbers]
        self.number = {w: i for i, (w, _) in enumerate(kept)}
        self.uses = np.ones(len(kept), np.int32)
        self.length = np.array([len(x) for x in flat], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        """The ids of unseen words: letters by the library's model alone, most others in one call on all of them."""
        plain, others, alone = [], [], []
        for w in words:
            (plain if _LETTERS.match(w) else others if _BETWEEN.match(w) else alone).append(w)
        if plain:
            text = b"\n".join(plain)
            text = text.decode().replace(" ", "").lower().encode() if self.kind == "at spaces" else text
            model = self.tokenizer.model.tokenize
            found = [[t.id for t in model(w)] for w in text.decode("latin-1").translate(self.characters).split(self.characters[10])]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self._keep(plain, np.fromiter(itertools.chain.from_iterable(found), np.uint32, lengths.sum()), np.cumsum(lengths) - lengths, lengths)
        if others:  # around each mark stands a newline, an id of its own where white space counts
            ids, wide = self._library([b"\n\x01\n".join(others).decode("utf-8", "replace")])[0], self.kind != "at spaces"
            marks = np.flatnonzero(self.mark[ids])
            starts, ends = np.concatenate(([0], marks + 1 + wide)), np.concatenate((marks - wide, [len(ids)]))
            if len(starts) == len(others):
                self._keep(others, ids, starts, ends - starts)
            else:  # a word that holds a mark
                alone += others
        for at in range(0, len(alone), 1000):
            some = alone[at : at + 1000]
            ids = self._library([w.decode("utf-8", "replace") for w in some])
            lengths = np.array([len(x) for x in ids], np.int64)
            self._keep(some, np.concatenate(ids), np.cumsum(lengths) - lengths, lengths)

    def _keep(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words)), strict=True))
        self.start = np.concatenate((self.start, len(self.flat) + starts))
        self.length = np.concatenate((self.length, lengths))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int32)))
        self.flat = np.concatenate((self.flat, ids))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The cache's numbers of distinct words, unseen ones learnt."""
        found = list(map(self.number.get, words))
        unseen = [w for w, n in zip(words, found, strict=True) if n is None]
        if unseen:
            if len(self.number) + len(unseen) > self.most:
                self._forget()
                found = list(map(self.number.get, words))
                unseen = [w for w, n in zip(words, found, strict=True) if n is None]
            self._learn(unseen)
            rest = map(self.number.__getitem__, unseen)
            found = [next(rest) if n is None else n for n in found]
        numbers = np.array(found, np.int64)
        self.uses[numbers] += 1
        return numbers

    # --- texts ---

    def _slices(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The bytes of a stretch of texts and where each text begins in them (one more at the end)."""
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        column = column.fill_null(b"") if column.null_count else column
        if not len(column):
            return
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + self.slice_bytes, "right")) - 1)
            yield data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end

    def _spelled_out(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts hold a special token."""
        if self.kind == "whole":
            return np.diff(offsets) > 0
        late = np.zeros(len(offsets) - 1, bool)
        raw = data.tobytes() if self.special is not None else b""
        if raw and self.hint in raw:
            for m in self.special.finditer(raw):
                late[np.searchsorted(offsets, m.start(), "right") - 1] = True
        return late

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, made alike where the tokenizer does so too, and the places where words begin."""
        cut = np.zeros(len(data) + 1, bool)
        n = len(data)
        if self.kind == "at spaces":
            data = np.where(data == 10, np.uint8(32), data)
            # Lower case as the tokenizer makes it: where no character beyond U+00FF stands, character by character.
            far = np.flatnonzero(data >= 0xC4)
            upper = (data >= 65) & (data <= 90)
            after = np.flatnonzero(data == 0xC3) + 1
            upper[after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]] = True
            if len(far):
                for i in np.flatnonzero(np.diff(np.searchsorted(far, offsets))):
                    upper[offsets[i] : offsets[i + 1]] = False
            data[upper] += 32
            cut[:-1] = data == 32
        else:
            at = np.flatnonzero((data == 32) | (data == 10))
            at = at[(at > 0) & (at < n - 1)]
            before, ahead = data[at - 1], data[at + 1]
            good = (_SEEN[before] | (before >= 0x80) & (at > 1) & _TWO[data[at - 2]]) & _BEGINS[ahead]
            at = at[good]
            cut[at] = True
            cut[at[data[at] == 10] + 1] = True
        at = np.flatnonzero(_SIGN[data])
        at = at[at > 0]
        before = data[at - 1]
        cut[at[_ALNUM[before] | _LATIN[before] & (at > 1) & (data[at - 2] == 0xC3)]] = True
        cut[offsets] = True
        cut[-1] = False
        return data, np.flatnonzero(cut)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        late = self._spelled_out(data, offsets)
        flat, lengths = np.zeros(0, np.uint32), np.zeros(len(late), np.int64)
        if len(data) and not late.all():
            same, starts = self._cuts(data, offsets)
            places = pa.py_buffer(np.append(starts, len(same)).astype(np.int32))
            words = pa.Array.from_buffers(pa.binary(), len(starts), [None, places, pa.py_buffer(same)]).dictionary_encode()
            number = self._numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
            n = self.length[number]
            ends = np.cumsum(n)
            flat = self.flat[np.repeat(self.start[number] - (ends - n), n) + np.arange(ends[-1])]
            lengths = np.diff(np.concatenate(([0], ends))[np.searchsorted(starts, offsets)])
        if late.any():
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for i in np.flatnonzero(late).tolist():
                parts[i] = self._library([data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")])[0]
            flat, lengths = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return flat, lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (one more at the end)."""
        found = [self._slice(*x) for x in self._slices(column)]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate(([0], np.cumsum(np.concatenate([n for _, n in found]))))

    def encode_table(self, column: pa.ChunkedArray | pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end_id``, and how many each text has with it."""
        chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
        found = [self.encode(c) for c in chunks]
        flat = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint32)])
        n = np.concatenate([np.diff(at) for _, at in found] or [np.zeros(0, np.int64)])
        out = np.full(len(flat) + len(n), end_id, np.uint32)
        own = np.ones(len(out), bool)
        own[np.cumsum(n + 1) - 1] = False
        out[own] = flat
        return out, n + 1

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        flat, at = self.encode(pa.array(texts, pa.large_string()))
        return [flat[a:z].astype("<u4").tobytes() for a, z in zip(at, at[1:], strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per process and file, shared by the tasks that run in it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
