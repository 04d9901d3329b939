"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier decides.

Every text is read once, whole. Strict patterns give the base spans, which always
stay; looser patterns give further candidates, among them what the strict
patterns found and dropped. Five labelers vote on each candidate (personal, not,
or no vote): the strict pattern, check digits, gazetteers, the words before the
span, and its shape. Votes and a few span features form a small code; counts of
the codes over all candidates are all that EM needs, so they are summed on the
executors and only the distinct codes, fewer than ``MAX_CODES`` by construction,
reach the driver. EM estimates how often each labeler's vote is right, at least
more often than not, and the share of personal spans of each kind.

The span classifier sees what no labeler does: the characters of the span by
their kinds, the signs around it and the words after it. It is a logistic
regression on these and the two labelers that test (pattern, check digits), fitted
to EM's posteriors on at most ``SAMPLE`` different
candidates, those of the smallest hashes, weighed by how often they occur. It
decides on all candidates and may overrule the votes; base spans always stay.

Null texts are empty; an empty text has no spans. Repeated ids: a row for each.
An empty table gives no rows. All patterns run in time linear in the text.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import batch, pieces, settled

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "name", "secret", "ssn")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape")
_FEATURES = (3, 3, 3)  # length, what stands before, what stands after
MAX_CODES = len(KINDS) * 3 ** len(LABELERS) * 27
NOT, PERSONAL, NONE = 2, 1, 0
#: Different candidates that the classifier is fitted on, at most.
SAMPLE = 20_000
#: Buckets of the classifier's features of characters and context.
BUCKETS = 1 << 13

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match that starts inside a run of digits fails or succeeds as the whole run does, so only whole runs are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![0-9A-Za-z])")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}){1,8}")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key)[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?([A-Za-z0-9_/+-]{16,})")
_DIGIT = re.compile("[0-9]")

#: Gazetteers: top-level domains, calling codes, given names.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io de fr es it nl uk us ca au ch at be pl se no dk fi pt cz jp cn in br mx ru eu example test".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 420 421".split())
GIVEN_NAMES = frozenset("James Mary Robert Patricia Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen Christopher Lisa Daniel Nancy Matthew Margaret Anthony Sandra Andrew Steven Kimberly Kenneth Emily Joshua Michelle Kevin Amanda Brian Melissa George Deborah Stephanie Rebecca Sharon Laura Cynthia Hans Klaus Jürgen Wolfgang Sabine Petra Monika Ursula Pierre François Nathalie Isabelle Juan José Carmen Dolores Francisco Antonio".split())
_NAME = re.compile(r"(?<!\w)([A-ZÀ-Þ][a-zß-ÿ]+) ([A-ZÀ-Þ][a-zß-ÿ]{2,30})(?!\w)")
# What _NAME takes for a given name: a capital and small letters after no word character.
_LETTERS = re.compile(r"(?<!\w)[A-ZÀ-Þ][a-zß-ÿ]+")

#: Words before a span that speak for its kind, or against it.
CUES = {
    "email": ("mail", "contact", "write to", "reach"), "ip": ("ip", "host", "server", "addr"), "card": ("card", "visa", "mastercard", "payment", "paid with"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp"), "iban": ("iban", "account", "bank"), "name": ("name", "mr", "mrs", "ms", "dr", "dear", "contact"),
    "secret": ("token", "secret", "password", "key"), "ssn": ("ssn", "social security"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "page", "section", "chapter", "part no", "model", "ratio")


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost matches of the address pattern, from one sign to the next, so that no run is scanned twice."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > free and text[left - 1] in _LOCAL:
            left -= 1
        free = max(free, at + 1) if left == at else free
        if left < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((left, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ip_holds(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_holds(s: str) -> bool:
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def _phone_holds(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def _iban_holds(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans by kind and start, and the matches that failed their test."""
    good, failed = [("email", a, b) for a, b in (emails(text) if "@" in text else ())], []
    if _DIGIT.search(text):
        for kind, pattern, holds in (("ip", _IP, _ip_holds), ("card", _CARD, _card_holds), ("phone", _PHONE, _phone_holds)):
            if kind == "phone" and "+" not in text:
                continue
            for m in pattern.finditer(text):
                (good if holds(m[0]) else failed).append((kind, m.start(), m.end()))
    return good, failed


def _vote(kind: str, s: str, before: str, after: str, strict: bool | None) -> int:
    """The code of one candidate. strict: it is a base span (True), failed as one (False), or neither (None)."""
    votes = [PERSONAL if strict else NOT if strict is False else NONE]
    if kind == "card":
        votes.append(PERSONAL if luhn(_digits(s)) else NOT)
    elif kind == "iban":
        votes.append(PERSONAL if _iban_holds(s) else NOT)
    elif kind == "ip":
        votes.append(PERSONAL if _ip_holds(s) and not re.search(r"(?:^|\.)0[0-9]", s) else NOT)
    elif kind == "ssn":
        votes.append(NOT if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else PERSONAL)
    else:
        votes.append(NONE)
    if kind == "email":
        votes.append(PERSONAL if s.rpartition(".")[2].rstrip(")]").lower() in TOP_DOMAINS else NONE)
    elif kind == "phone" and s[0] == "+":
        d = _digits(s)
        votes.append(PERSONAL if any(d[:n] in CALLING_CODES for n in (1, 2, 3)) else NOT)
    elif kind == "name":
        votes.append(PERSONAL if s.split()[0] in GIVEN_NAMES else NOT)
    else:
        votes.append(NONE)
    said = before.lower()
    cue = max((said.rfind(c) for c in CUES[kind]), default=-1)
    against = max((said.rfind(c) for c in AGAINST), default=-1)
    votes.append(NONE if cue < 0 and against < 0 else PERSONAL if cue >= against else NOT)
    left, right = before[-1:], after[:1]
    joined = left.isalnum() or right.isalnum() or left in "_/\\" and left != "" or right in "_/\\" and right != ""
    votes.append(NOT if joined else PERSONAL if strict is None and kind in ("secret", "iban") else NONE)
    size = len(s)
    side = lambda c: 0 if not c or c.isspace() else 1 if c.isalnum() else 2
    code = KINDS.index(kind)
    for v in votes:
        code = 3 * code + v
    for v in (0 if size < 12 else 1 if size < 24 else 2, side(left), side(right)):
        code = 3 * code + v
    return code


_KINDS_OF = str.maketrans({**{chr(c): "0" for c in range(48, 58)}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}, "\x1f": " "})
_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_SIDE_WORD = re.compile(r"[A-Za-z]{1,12}")


def mark(text: str, a: int, b: int) -> str:
    """What the classifier sees of a span beside its code: its characters' kinds, longer runs cut to four, the signs around it
    and the words after it (those before it are a labeler's evidence)."""
    shape = _RUN.sub(r"\1\1\1\1", text[a : min(b, a + 200)].translate(_KINDS_OF))[:40]
    following = [w.lower() for w in _SIDE_WORD.findall(text[b : b + 30])[:2]] + ["", ""]
    return "\x1f".join((shape, text[max(0, a - 1) : a].translate(_KINDS_OF), text[b : b + 1].translate(_KINDS_OF), *following[:2]))


def _features(mark: str) -> list[int]:
    """The buckets of a mark: runs of one to three of the shape's characters, and each part of what is around it."""
    shape, *around = mark.split("\x1f")
    shape = f"<{shape}>"
    grams = {shape[i : i + n] for n in (1, 2, 3) for i in range(len(shape) - n + 1)}
    return sorted({zlib.crc32(g.encode()) % BUCKETS for g in grams} | {zlib.crc32(f"{i}={x}".encode()) % BUCKETS for i, x in enumerate(around)})


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, int]]]:
    """Base spans, and every candidate with its code (base spans and failed ones among them)."""
    good, failed = base_spans(text)
    found = [(k, a, b, True) for k, a, b in good] + [(k, a, b, False) for k, a, b in failed if k != "card" or b - a >= 12]
    taken = sorted((a, b) for _, a, b in good)
    free = lambda a, b: all(y <= a or b <= x for x, y in taken)
    more = []
    if "[at]" in text or "(at)" in text:
        more += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        more += [("phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
        more += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
        more += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text)]
    if "=" in text or ":" in text:
        more += [("secret", m.start(1), m.end(1)) for m in _SECRET.finditer(text)]
    if not GIVEN_NAMES.isdisjoint(_LETTERS.findall(text)):
        more += [("name", m.start(), m.end()) for m in _NAME.finditer(text) if m[1] in GIVEN_NAMES]
    if len(taken) > 64 and more:  # many spans: look up neighbours only
        ends = np.maximum.accumulate([b for _, b in taken])
        starts = [a for a, _ in taken]
        free = lambda a, b: (i := int(np.searchsorted(starts, b))) == 0 or ends[i - 1] <= a
    found += [(k, a, b, None) for k, a, b in more if free(a, b)]
    return good, [(k, a, b, _vote(k, text[a:b], text[max(0, a - 40) : a], text[b : b + 1], strict)) for k, a, b, strict in found]


def parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """kind, votes and features of each code."""
    digits, rest = [], codes.copy()
    for _ in range(len(LABELERS) + len(_FEATURES)):
        digits.append(rest % 3)
        rest = rest // 3
    digits = np.array(digits[::-1]).T.reshape(len(codes), -1)
    return rest, digits[:, : len(LABELERS)], digits[:, len(LABELERS) :]


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """EM over the counted codes: each code's probability of being personal, and how often each labeler's vote is right.

    A labeler that does not vote says nothing. That a vote is right more often than wrong is given, which tells the two
    classes apart; each kind has its own share of personal spans, which starts even.
    """
    kind, votes, _ = parts(codes)
    right = np.full(len(LABELERS), 0.8)
    sign = np.where(votes == PERSONAL, 1.0, np.where(votes == NOT, -1.0, 0.0))
    share = np.full(len(KINDS), 0.5)
    p = np.full(len(codes), 0.5)
    for _ in range(rounds):
        weight = np.log(right / (1 - right))
        p = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share))[kind] + sign @ weight, -50, 50)))
        for j in range(len(LABELERS)):
            agree = (counts * np.where(sign[:, j] > 0, p, 1 - p))[sign[:, j] != 0].sum()
            right[j] = np.clip((agree + 8) / (counts[sign[:, j] != 0].sum() + 10), 0.55, 0.99)
        share = np.array([((counts * p)[kind == k].sum() + 2) / (counts[kind == k].sum() + 4) for k in range(len(KINDS))])
    return p, right


class Classifier:
    """The probability that a span is personal, from its code and its mark."""

    def __init__(self, known: np.ndarray, buckets: np.ndarray):
        self.known, self.buckets = known, buckets  # weights of kinds, votes and code features; weights of the mark's buckets
        self._seen: dict[tuple[int, str], float] = {}

    def __getstate__(self):
        return self.known, self.buckets

    def __setstate__(self, state):
        self.__init__(*state)

    def probability(self, code: int, mark: str) -> float:
        if (code, mark) not in self._seen:
            if len(self._seen) > 50_000:
                self._seen.clear()
            z = float(_known(np.array([code]))[0] @ self.known) + float(self.buckets[_features(mark)].sum())
            self._seen[code, mark] = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
        return self._seen[code, mark]

    def accepts(self, code: int, mark: str) -> bool:
        return self.probability(code, mark) >= 0.5


def _known(codes: np.ndarray) -> np.ndarray:
    """Kind, the votes of the two labelers that test (the others' evidence is kept from the classifier, else it would repeat them) and length."""
    kind, votes, features = parts(codes)
    return np.concatenate([np.eye(len(KINDS))[kind]] + [np.eye(3)[c] for c in np.concatenate((votes[:, :2], features), 1).T], axis=1)


def train(codes: np.ndarray, counts: np.ndarray, sample: list[tuple[int, str, int]], rounds: int = 300) -> Classifier:
    """The classifier for ``codes`` as often as ``counts`` says over all candidates, fitted on a sample of (code, mark, count)."""
    width = len(KINDS) + 3 * (2 + len(_FEATURES))
    w = np.zeros(width + BUCKETS)
    if len(codes) and sample:
        posterior, _ = reliabilities(codes, counts)
        own = np.array([x[0] for x in sample], np.int64)
        target, weight = posterior[np.searchsorted(codes, own)], np.sqrt(np.array([x[2] for x in sample], float))
        weight /= weight.sum()
        known, features = _known(own), [_features(x[1]) for x in sample]
        row, bucket = np.repeat(np.arange(len(own)), [len(f) for f in features]), np.concatenate(features).astype(np.int64)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, rounds + 1):
            z = known @ w[:width] + np.bincount(row, w[width:][bucket], len(own))
            wrong = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target)
            grad = np.concatenate((known.T @ wrong, np.bincount(bucket, wrong[row], BUCKETS))) + 1e-4 * w
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Classifier(w[:width].astype(np.float32), w[width:].astype(np.float32))


_FOUND = "doc_id long, base array<string>, kinds array<int>, starts array<long>, ends array<long>, codes array<int>, marks array<string>"
_FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("kinds", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())), ("marks", pa.list_(pa.string()))])


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans (kind:start:end) and coded candidates of every row."""

    def found(batches):
        for b in pieces(batches):
            rows = []
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                good, every = candidates(text or "")
                rows.append((name, [f"{k}:{a}:{e}" for k, a, e in good], [KINDS.index(x[0]) for x in every], [x[1] for x in every], [x[2] for x in every], [x[3] for x in every], [mark(text, x[1], x[2]) for x in every]))
            yield batch(_FOUND_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_FOUND_ARROW.names)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(found, _FOUND)


def learnt(found: DataFrame, sample: int = SAMPLE) -> Classifier:
    """The classifier learnt from the codes of all rows of ``found`` and a sample of their marks."""
    rows = found.select(F.explode("codes").alias("code")).groupBy("code").count().orderBy("code").collect()  # fewer than MAX_CODES
    codes, counts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float)
    each = found.select(F.explode(F.arrays_zip("codes", "marks")).alias("x")).groupBy(F.col("x.codes").alias("code"), F.col("x.marks").alias("mark")).agg(F.count("*").alias("n"))
    some = each.orderBy(F.xxhash64("code", "mark"), "code", "mark").limit(sample).collect()
    return train(codes, counts, [tuple(r) for r in some])


def merged(base: list[tuple[str, int, int]], every: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    """All spans by kind and start: the base ones, and accepted candidates that overlap none of them and no candidate taken before."""
    out, have = list(base), set(base)
    taken = sorted((a, e) for _, a, e in base)
    starts, ends = [a for a, _ in taken], list(itertools.accumulate((e for _, e in taken), max))
    free = 0
    for kind, a, e, good in sorted(every, key=lambda x: (x[1], -x[2])):
        if good and a >= free and (kind, a, e) not in have and ((i := bisect.bisect_left(starts, e)) == 0 or ends[i - 1] <= a):
            out.append((kind, a, e))
            free = max(free, e)
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


_SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("spans", pa.list_(pa.string()))])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (each kind:start:end in code points, end exclusive) of every row."""
    found = settled(extract(docs, id_col, text_col), "candidates")
    model = learnt(found)

    def decide(batches):
        for b in batches:
            spans = []
            for r in b.to_pylist():
                base = [(k, int(a), int(e)) for k, a, e in (x.split(":") for x in r["base"])]
                every = [(KINDS[k], a, e, model.accepts(c, m)) for k, a, e, c, m in zip(r["kinds"], r["starts"], r["ends"], r["codes"], r["marks"], strict=True)]
                spans.append([f"{k}:{a}:{e}" for k, a, e in merged(base, every)])
            yield batch(_SPANS_ARROW, doc_id=b.column("doc_id"), base=b.column("base"), spans=spans)

    return found.mapInArrow(decide, "doc_id long, base array<string>, spans array<string>")


def redact(text: str, model: Classifier) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first and longest."""
    good, every = candidates(text)
    own = merged(good, [(k, a, e, model.accepts(c, mark(text, a, e))) for k, a, e, c in every])
    out, at = [], 0
    for kind, a, e in sorted(own, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: personal data in every text is replaced; n_chars, where there is one, follows the text.

    Null texts stay null, empty ones empty; rows that repeat an id are each rewritten; all columns are kept.
    """
    model = learnt(settled(extract(docs).where(F.size("codes") > 0).select("codes", "marks"), "candidates"))
    schema = docs.schema
    n_chars = "n_chars" in docs.columns

    def rewritten(batches):
        for b in pieces(batches):
            text = [None if t is None else redact(t, model) for t in b.column("text").to_pylist()]
            b = b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(text, b.schema.field("text").type))
            if n_chars:
                field = b.schema.field("n_chars")
                b = b.set_column(b.schema.get_field_index("n_chars"), field, pa.array([None if t is None else len(t) for t in text], pa.int64()).cast(field.type))
            yield b

    return docs.mapInArrow(rewritten, schema)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, for every document."""
    found = spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    number = lambda kind: F.size(F.filter("base", lambda x: x.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, BASE_KINDS), F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans"))


def digest(base: list[str]) -> str:
    return hashlib.sha256(",".join(base).encode()).hexdigest()
