"""WARC archives, exact search and the pipeline."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from braidflow.llm import decontamination, encoding, jaccard_join, pii, toxicity, warc
from braidflow.llm import topk_search as ts
from braidflow.llm.common import shared_dir
from tests.llm.conftest import prose
from tests.llm.test_encoding_and_blocks import brute, check_packing
from tests.llm.test_pairs import brute_links, shingles, words
from tests.llm.test_texts import labelled

PAGES = [
    (5, "http://www.a.example:80/x?q=1", "<p>one</p>"), (3, "http://b.a.example/", "<p>one</p>"), (9, "https://c.example:8443/ü", "<p>Ü\r\n\r\n</p>"),
    (11, None, None), (12, "", ""), (13, "not a url\r\nX-Evil: 1", "z" * 200_000), (14, "http://c.example/", "<p>one</p>"), (None, "http://n.example/", "<p>one</p>"),
    (None, "http://n.example/2", "alone"), (18, "http://tab.example/a\tb\u2028", "tab"), (15, "http://[bad/", "q"), (15, "http://[bad/", "q"), (16, "http://same.example/", "1"), (17, "http://same.example/", "2"),
]


def expected(least=0):
    out = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        first = min(ids) if len(raw) >= least and ids else page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "response", None) if page == first else (page, len(raw), digest, "revisit", first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").select("*", *[F.lit(0).alias(c) for c in ("payload", "sha", "salt", "first", "n", "key")])
    archives, index = shared_dir(spark, "w"), shared_dir(spark, "i")
    captures = warc.write_archives(pages.repartition(3), archives, least_bytes=least, file_bytes=1000)
    directory = warc.write_index(captures, index, block_lines=2)
    rows = warc.read_archives(directory, index, archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(least)
    bodies = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None and r.page_id is not None}
    assert all(bodies[p] == (h or "").encode() for p, _, h in PAGES if p in bodies) and len(bodies) >= 6
    by_url = warc.Index(directory, index, archives)
    assert sorted(r["page_id"] for r in by_url.lookup("http://same.example/")) == [16, 17]
    assert [r["page_id"] for r in by_url.lookup("http://b.a.example/")] == [3] and by_url.lookup("http://missing.example/") == []
    for url in {u or "" for _, u, _ in PAGES}:  # with line ends and other signs that no header can hold
        assert sorted(str(r["page_id"]) for r in by_url.lookup(url)) == sorted(str(p) for p, u, _ in PAGES if (u or "") == url)
    found = warc.lookup_all(pages.unionAll(pages), directory, index, archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(least)
    assert sorted(r.url for r in found) == sorted(u or "" for _, u, _ in PAGES)
    one = spark.createDataFrame([("http://same.example/",), ("http://missing.example/",), (None,)], "url string")
    assert sorted(str(r.page_id) for r in warc.lookup_all(one, directory, index, archives).collect()) == ["11", "12", "16", "17"]


def test_record_ids_are_unique(spark):
    import gzip

    pages = spark.createDataFrame([(None, "u", "a"), (None, "u", "a"), (1, "u", "b"), (1, "u", "b"), (1, "v", "c")], "page_id long, url string, html string")
    archives = shared_dir(spark, "w")
    warc.write_archives(pages, archives).count()
    system, folder = warc.store(archives)
    raw = b"".join(gzip.decompress(system.open_input_stream(f.path, compression=None).read()) for f in system.get_file_info(warc.fs.FileSelector(folder)) if f.is_file)
    ids = [x for x in raw.split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
    assert len(set(ids)) == len(ids) == 5


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    archives, index = shared_dir(spark, "w"), shared_dir(spark, "i")
    directory = warc.write_index(warc.write_archives(empty, archives), index)
    assert warc.read_archives(directory, index, archives).count() == 0
    assert warc.lookup_all(empty, directory, index, archives).count() == 0 and warc.Index(directory, index, archives).lookup("x") == []


def test_keys_and_damage():
    assert warc.url_key("http://WWW.a.Example:80/P?q") == "example,a)/P?q" and warc.url_key("https://a.example:444") == "example,a:444)/"
    raw = warc.record(1, "http://a/", b"abc", warc.base32_sha1(b"abc"))
    assert warc.parse(raw)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"abc", b"abd"))


def brute_top(rows, queries, k):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in sound if i in queries}:
        for own in [min(v for i, v in sound if i == q)]:
            scored = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in sound if i != q and len(v) == len(own))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("bits", "scale"), [(8, 1.0), (2, 1.0), (8, 1e6)])
def test_search_is_exact(spark, bits, scale):
    rng = np.random.default_rng(bits)
    rows = [(i, [float(x) for x in rng.normal(size=12) * scale]) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(50, rows[50][1]), (51, rows[51][1]), (51, rows[51][1]), (100, [0.5] * 12), (150, rows[3][1])]  # ids that stand twice
    rows += [(3000 + i, [1.0 + i, 2.0]) for i in range(4)] + [(3050, [1.0])]  # other lengths
    rows += [(2000, None), (2001, []), (2002, [None] * 12), (2003, [math.nan] * 12), (2004, [math.inf] * 12), (2005, [0.0] * 12), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("id", "v", "block", "rank", "score")])
    want = brute_top(rows, set(range(0, 3100, 50)), 5)
    for blocks in ((2048, 65536), (4, 50)):
        got = ts.search(df, F.col("id") % 50 == 0, 5, bits=bits, query_block=blocks[0], candidate_block=blocks[1])
        assert sorted(map(tuple, got.collect())) == want


def test_few_or_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    search = lambda rows: sorted(map(tuple, ts.search(spark.createDataFrame(rows, schema), F.col("id") % 50 == 0, 5).collect()))
    assert search([]) == [] and search([(0, [1.0])]) == [] and search([(1, [1.0])]) == []
    assert search([(0, [1.0, -0.001]), (3, [0.5, 0.5])]) == [(0, 1, 3, 256 * 128 - 128)]


# --- pipeline ---


@pytest.fixture(scope="module")
def stage_input(spark, odd_rows, small):
    rng = random.Random(9)
    item = duckdb.sql(f"select text from '{small}/benchmark.parquet' order by item_id").fetchall()[0][0]
    rows = list(odd_rows)
    near = prose(rng, 100)
    rows += [(300, near, "en", "s", 1), (301, near + " more", "en", "s", 1), (302, near, "en", "s", 1), (303, prose(rng, 60) + " " + item + " " + prose(rng, 60), "en", "s", 1)]
    rows += [(304, "what a vexgorul vexgorista vexgorenof vexgoraan " + prose(rng, 40), "en", "s", 1), (305, prose(rng, 50) + " ip 10.1.2.3 mail a@b.example", "en", "s", 1)]
    return rows + [(10_000 + d, t, "en", "s", 1) for d, t, _ in labelled(400)]


def test_stages_have_the_dealt_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "pii", "packing"]


def test_pipeline_against_a_plain_version(spark, stage_input, small, tmp_path):
    from tests.llm.conftest import ROWS

    spark.createDataFrame(stage_input, ROWS).unionByName(spark.read.parquet(f"{small}/documents.parquet").selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10_000 + d, y) for d, _, y in labelled(400)] + [(100_000 + d, 0) for d in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = list(map(tuple, docs.collect()))
    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scorer = toxicity.Scorer(model)
    want = [r for r in rows if scorer([r[1]])[0] < 0.5]
    assert 304 not in {r[0] for r in want} and len(want) >= len(rows) - 101
    first = {d: c for d, c, *_ in brute_links([r for r in want if r[0] != 40])}
    want = [r for n, r in enumerate(want) if first.get(r[0], r[0]) == r[0] and not any(r[:2] == x[:2] and r[0] is not None and words(r[1]) for x in want[:n])]
    items = [shingles(t) for (t,) in duckdb.sql(f"select text from '{small}/benchmark.parquet'").fetchall()]
    want = [r for r in want if not any(len(s & shingles(r[1])) >= 0.8 * len(s) for s in items)]
    every = Counter((c, pii.mark(r[1], a, b)) for r in want for _, a, b, c in pii.candidates(r[1] or "")[1])
    codes, places = np.unique([c for c, _ in every], return_inverse=True)
    model = pii.train(codes, np.bincount(places, list(every.values())), [(c, m, n) for (c, m), n in sorted(every.items())])
    coder = encoding.encoder(encoding.default_path("byte_bpe_50k.json"))
    ids = {}
    for r in want:
        ids.setdefault(r[0], []).append(brute(coder, None if r[1] is None else pii.redact(r[1], model)))
    check_packing(list(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())), ids)
    assert 303 not in ids and 301 not in ids and 302 not in ids and 300 in ids and 305 in ids


def test_stages_keep_columns_and_bear_empty_tables(spark, clashing, nothing, small):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (clashing, nothing):
            out = stage(spark, docs, small)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, small).count() == 0


def test_redaction_stage_rewrites_texts(spark, small):
    docs = spark.createDataFrame([(1, "me a@b.example", 99), (2, None, 5), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, pii.redact_documents(spark, docs, small).collect()))
    assert got == [(1, "me [EMAIL]", 10), (2, None, None), (3, "clean", 5)]


def test_crc_is_that_of_zlib():
    assert zlib.crc32(b"7") % 7 == zlib.crc32(str(7).encode()) % 7 and decontamination.SHINGLE == jaccard_join.SHINGLE == 5
