"""License scans: an exact set-similarity join between licence templates and every block of every text.

The blocks for a template of m words are windows of ``2 m`` words, one starting
each ``m``: a passage as long as the template lies whole in some window, and
windows cover the whole text. A block meets a template if it
holds at least the threshold of the template's distinct words.

The join is a prefix join. Words of templates are ordered by how many documents
hold them, rarest first, counted over all documents. A block that shares
``o = ceil(t |T|)`` words with template T shares one of the first ``|T| - o + 1``
of them (prefix filter); it must have ``o`` template words at all (length
filter); and a block whose first common word with T stands at place i can share
at most ``|T| - i`` (positional filter). What passes is counted exactly, so every
block above the threshold is found.

Base labels are found as runs of words. The score is 1 with a base label, else
the highest containment found, else 0.

Null texts are empty and have no labels. Repeated ids: a row for each. An empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import WORD_BYTES, batch, pieces, text_bytes

THRESHOLD = 0.8

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label and wording of common notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the terms of the gnu lesser general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike international license"),
    ("cc0", "dedicated to the public domain under the creative commons zero waiver"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_WORDS = re.compile(WORD_BYTES)
_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()), ("blocks", pa.list_(pa.string()))])
_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, blocks array<string>"


def template_words(templates) -> list[tuple[str, list[bytes]]]:
    """Label and words of each template; only the words in it count, each once."""
    return [(label, _WORDS.findall(text.encode().lower())) for label, text in templates]


def document_frequencies(docs: DataFrame, text_col: str, words: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each of ``words`` stands, over all documents. ``words`` are the templates' own, a bounded set."""

    def counted(batches):
        seen: Counter = Counter()
        for b in pieces(batches, 2048):
            for text in text_bytes(b.column(0)):
                seen.update(words.intersection(_WORDS.findall(text.lower())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows}


class Join:
    """The index of templates: their words in the global order, and their prefixes."""

    def __init__(self, templates, frequencies: dict[bytes, int], threshold: float = THRESHOLD):
        own = template_words(templates)
        self.steps = [len(w) for _, w in own]
        self.templates = []
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for label, words in own:
            ordered = sorted(set(words), key=lambda w: (frequencies.get(w, 0), w))
            least = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            t = len(self.templates)
            self.templates.append((label, ordered, least, frozenset(ordered)))
            for i in range(len(ordered) - least + 1):
                self.prefixes.setdefault(ordered[i], []).append((t, i))
        self.words = frozenset(w for _, ordered, _, _ in self.templates for w in ordered)
        self.starters = frozenset(self.prefixes)
        self.least = min(x[2] for x in self.templates)

    def matches(self, present: frozenset[bytes]) -> list[tuple[int, int]]:
        """(template, common words) for the template words present in a block."""
        if len(present) < self.least:
            return []
        first: dict[int, int] = {}
        for w in present & self.starters:
            for t, i in self.prefixes[w]:
                first[t] = min(i, first.get(t, i))
        out = []
        for t, i in first.items():
            _, ordered, least, own = self.templates[t]
            if len(present) >= least and len(ordered) - i >= least:
                common = len(present & own)
                if common >= least:
                    out.append((t, common))
        return out

    def scan(self, words: list[bytes]) -> dict[int, tuple[float, int]]:
        """For each template met by a block: the best containment and the first such block's first word."""
        present = self.words.intersection(words)
        if not (possible := self.matches(present)):
            return {}
        wanted = frozenset().union(*(self.templates[t][3] for t, _ in possible))
        places = [(i, w) for i, w in enumerate(words) if w in wanted]
        best: dict[int, tuple[float, int]] = {}
        for t in sorted({t for t, _ in possible}):
            _, ordered, least, own = self.templates[t]
            step, by = self.steps[t], {}
            for i, w in places:
                if w in own:
                    by.setdefault(i // step, set()).add(w)
            rare = ordered[: len(ordered) - least + 1]
            for k in sorted({max(0, x - d) for x in by for d in (0, 1)}):
                inside = by.get(k, set()) | by.get(k + 1, set())
                i = next((i for i, w in enumerate(rare) if w in inside), None)
                if len(inside) >= least and i is not None and len(ordered) - i >= least:
                    share = len(inside) / len(ordered)
                    if share > best.get(t, (0.0, 0))[0]:
                        best[t] = (share, k * step)
        return best


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document. ``blocks``: label@first word of the block=containment, for each template met."""
    words = frozenset(w for _, own in template_words(templates) for w in own)
    index = docs.sparkSession.sparkContext.broadcast(Join(templates, document_frequencies(docs, text_col, words), threshold))
    runs = [(re.compile(rb"(?<![0-9a-z\x80-\xff])(?=" + _GAP.join(map(re.escape, p.encode().split())) + rb"(?![0-9a-z\x80-\xff]))"), p.encode().split()[0], label) for p, label in phrases.items()]

    def scanned(batches):
        join = index.value
        for b in pieces(batches):
            rows = []
            for name, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), strict=True):
                text = text.lower()
                own = _WORDS.findall(text)
                places, base = [], set()
                for pattern, start, label in runs:
                    if start in text:
                        at, n = 0, 0
                        for m in pattern.finditer(text):
                            n += len(_WORDS.findall(text, at, m.start()))
                            at = m.start()
                            places.append(n)
                            base.add(label)
                best = join.scan(own)
                labels = base | {join.templates[t][0] for t in best}
                score = 1.0 if base else max((x[0] for x in best.values()), default=0.0)
                rows.append((name, len(own), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), score, sorted(f"{join.templates[t][0]}@{at}={share:.4f}" for t, (share, at) in best.items())))
            yield batch(_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_ARROW.names)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scanned, _SCHEMA)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
