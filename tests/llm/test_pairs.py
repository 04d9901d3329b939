"""The Jaccard join, decontamination and components against plain versions."""

import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidflow.llm import decontamination as dc
from braidflow.llm import jaccard_join as jj
from braidflow.llm import registry
from braidflow.llm.common import shingle_hashes, shingles_of_texts, word_hashes
from braidflow.llm.components import components
from tests.llm.conftest import ROWS, WORDS, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    import re

    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + min(size, len(w))]) for i in range(max(1, len(w) - size + 1))} if w else set()


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="abAB1é .,\n", max_size=30)), max_size=6))
def test_texts_are_hashed_together_as_alone(texts):
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    alone = [shingle_hashes(word_hashes((t or "").encode()), 3).tolist() for t in texts]
    assert [x.tolist() for x in shingles_of_texts(column, 3)] == alone


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="abAB1é .,\n", max_size=30), min_size=2, max_size=2))
def test_hashes_are_of_words(texts):
    a, b = (word_hashes(t.encode()) for t in texts)
    assert [x == y for x in a for y in b] == [x == y for x in words(texts[0]) for y in words(texts[1])]
    a, b = (set(shingle_hashes(word_hashes(t.encode()), 5).tolist()) for t in texts)
    assert len(a) == len(shingles(texts[0])) and len(a & b) == len(shingles(texts[0]) & shingles(texts[1]))


def brute_links(rows, threshold=0.8):
    sets = {}
    for doc, text, *_ in rows:
        sets.setdefault(doc, frozenset(shingles(text)))
    heads = {}
    for doc in sorted(d for d in sets if d is not None and sets[d]):
        heads.setdefault(sets[doc], doc)
    near = {h: set() for h in heads.values()}
    for a, x in heads.items():
        for b, y in heads.items():
            if x != y and len(a & b) >= threshold * len(a | b) - 1e-9:
                near[x].add(y)
    cls = {}
    for h in sorted(near):
        if h not in cls:
            todo = [h]
            while todo:
                n = todo.pop()
                if n not in cls:
                    cls[n] = h
                    todo += near[n]
    out = []
    for doc, text, *_ in rows:
        s = frozenset(shingles(text))
        h = heads.get(s)
        out.append((doc, doc, doc, 0) if not s or doc is None else (doc, cls[h], h, len(near[h])))
    return sorted(out, key=str)


def test_links_of_odd_rows(clashing, odd_rows, nothing):
    rows = [r for r in odd_rows if r[0] != 40]  # one id with two texts: below
    got = sorted(map(tuple, jj.links(clashing.where("doc_id is null or doc_id != 40")).collect()), key=str)
    want = [(d, None, None, 0) if d is None else (d, *x) for d, *x in brute_links(rows)]
    assert got == sorted(want, key=str)
    assert jj.links(nothing).count() == 0
    assert jj.links(clashing).count() == len(odd_rows)


@pytest.mark.parametrize("block", [jj.BLOCK, 3000])
def test_large_group_of_near_copies(spark, block):
    rng = random.Random(2)
    base = prose(rng, 150).split(" ")
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + str(i)
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(rng, 150)) for i in range(20)] + [(200 + i, rows[0][1]) for i in range(30)]
    got = jj.links(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute_links(rows)


def test_similar_counts_exactly():
    rng = np.random.default_rng(0)
    for m, low in ((3, 30), (12, 30), (40, 60), (700, 40)):
        sets = [np.unique(rng.integers(0, 60, rng.integers(low, 80)).astype(np.uint64)) for _ in range(m)]
        have = np.zeros((m, 60))
        for i, x in enumerate(sets):
            have[i, x.astype(int)] = 1
        shared, sizes = have @ have.T, have.sum(1)
        want = shared >= 0.6 * (sizes[:, None] + sizes - shared) - 1e-9
        np.fill_diagonal(want, False)
        got = jj.similar(sets, 0.6)
        assert (got == got.T).all() and (got == want).all() and (m < 12 or want.any())


def test_forest_prefix_reaches_its_recall():
    k = jj.prefix_length(0.8, jj.TREES, jj.DEPTH, jj.RECALL)
    assert jj.SHORTEST < k < jj.DEPTH and 1 - (1 - 0.8**k) ** jj.TREES >= jj.RECALL > 1 - (1 - 0.8 ** (k + 1)) ** jj.TREES
    assert jj.prefix_length(0.8, 1, 12, 0.999) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(20)] + [(200, 200 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_containment(spark, clashing, odd_rows, nothing):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate((3, 4, 5, 9, 17, 40, 90))] + [(50, None), (51, ""), (52, "?!"), (None, prose(rng, 20)), (53, items_text := prose(rng, 33)), (54, items_text)]
    long = prose(rng, 5000).split(" ")
    docs = [(900, " ".join(long))]
    for i, (_, text) in enumerate(items):
        if text:
            at = rng.randrange(len(long))
            docs.append((1000 + i, " ".join([*long[:at], text.upper(), *long[at:]])))
            cut = text.split(" ")
            docs.append((2000 + i, " ".join([*long[:at], *cut[: len(cut) // 2], *long[at:]])))
    docs += [(None, items[6][1]), (3000, None), (3001, ""), (1000, docs[1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    want = set()
    for d, t in docs:
        for i, x in items:
            need = shingles(x)
            n = min(5, len(words(x)))
            if need and len(shared := need & shingles(t, n)) >= 0.8 * len(need) - 1e-9 and len(words(t)) >= n:
                want.add((d, i, len(shared), len(need)))
    for block in (dc.BLOCK_ITEMS, 4):
        got = dc.contained(rows, benchmark, block_items=block)
        assert {tuple(r)[:4] for r in got.collect()} == want
        dirty = {w[0] for w in want}
        assert sorted(str(r.doc_id) for r in dc.clean(rows, benchmark, block_items=block).collect()) == sorted(str(d) for d, _ in docs if d not in dirty)
    assert dc.contained(nothing, benchmark).count() == 0
    odd_items = spark.createDataFrame([(1, odd_rows[5][1]), (2, odd_rows[0][1]), (3, "no such words in any of them")], "item_id long, text string")
    held = {(r[0], 1) for r in odd_rows if len(shingles(odd_rows[5][1]) & shingles(r[1])) >= 0.8 * len(shingles(odd_rows[5][1]))}
    held |= {(r[0], 2) for r in odd_rows if words(odd_rows[0][1])[0] in words(r[1])}
    assert {(r.doc_id, r.item_id) for r in dc.contained(clashing, odd_items).collect()} == held and len(held) > 5
    assert dc.clean(clashing, odd_items).columns == clashing.columns
    assert dc.contained(rows, benchmark.where("false")).count() == 0 and dc.clean(rows, benchmark.where("false")).count() == len(docs)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, small, name):
    con = duckdb.connect()
    for f in os.listdir(small):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, small)
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.select(", ".join(columns)).fetchall(), key=str)


def test_one_of_each_class_stays(spark):
    rng = random.Random(6)
    a, b, c = prose(rng, 90), prose(rng, 90), prose(rng, 90)
    rows = [(1, a, "w"), (2, a, "x"), (2, b, "y"), (3, b + " more", "z"), (3, b + " more", "z"), (4, c, "u"), (4, c, "v"), (5, "", "e"), (5, "", "e"), (None, a, "n"), (6, a, "q"), (7, None, "r")]
    got = jj.drop_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, f1 string"), "").collect()
    want = {(1, a): 1, (2, b): 1, (4, c): 1, (5, ""): 2, (None, a): 1, (7, None): 1}
    found = {}
    for r in got:
        found[r.doc_id, r.text] = found.get((r.doc_id, r.text), 0) + 1
    assert found == want


def test_links_of_an_id_with_two_texts(spark):
    rng = random.Random(16)
    a, b = prose(rng, 120), prose(rng, 120)
    rows = [(40, a), (40, b), (50, a + " more"), (60, b + " else"), (70, prose(rng, 50))]
    got = jj.links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(40, 40, 40, 1), (40, 40, 40, 1), (50, 40, 50, 1), (60, 40, 60, 1), (70, 70, 70, 0)]


def test_recall_over_the_small_table(spark, small):
    rows = duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall()
    want = {d: n for d, _, _, n in brute_links(rows)}
    found = {r.doc_id: r.n_links for r in jj.links(spark.read.parquet(f"{small}/documents.parquet"), sparse=1).collect()}
    assert sum(min(found[d], n) for d, n in want.items()) >= 0.99 * sum(want.values())


def test_prefixes_shorten_where_few_share_them(spark):
    rng = random.Random(12)
    one = prose(rng, 200).split(" ")
    apart = [*one[:100], *prose(rng, 100).split(" ")]  # less alike than the threshold, and alone together
    crowd = [" ".join(prose(random.Random(99), 150).split(" ")[:-1] + [f"w{i}"]) for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(apart)), *((100 + i, t) for i, t in enumerate(crowd))], "doc_id long, text string")
    signed = jj.sketches(docs, "doc_id", "text", 5, jj.Signer(jj.TREES, jj.DEPTH)).selectExpr("f1 as node", "n", "sig", "doc_id")
    forest = jj.grow(signed, jj.TREES, jj.DEPTH)
    names = {r.node: r.doc_id for r in signed.collect()}
    groups = {}
    for r in jj.groups_of(forest, 6, 1, 4).collect():
        groups.setdefault((r.tree, r.group), set()).add(names[r.node])
    assert {1, 2} in groups.values()  # found by prefixes far shorter than six labels
    assert all(len(g) > 1 for g in groups.values()) and any(len(g) > 4 for g in groups.values())


def test_rows_schema():
    assert ROWS.startswith("doc_id long, text string")
