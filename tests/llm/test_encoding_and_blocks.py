import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from braidflow.llm import encoding, packing, pfor, token_output
from braidflow.llm.common import shared_dir

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PARTS = st.sampled_from(["###", "x's", "(a", "Å", "J", "\u030c", "\u0301", "\u212a", "\u2028", "\u3000", "“", "½", "a,b", "1.5", "é.", "×,", "a", "the", " the", "'s", "É", "é", "ß", "Σ", "İ", " ", "  ", "\n", "\n\n", "\t", "\r\n", ",", ".", "..", "!?", "_", "1", "23", " ", "\x1c", "\x01", "\0", "<|endoftext|>", "<|", "你", "\U0001f600"])


@pytest.fixture(scope="module", params=FILES)
def coder(request):
    return encoding.WordEncoder(encoding.default_path(request.param), cached_words=50, slice_bytes=40)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(PARTS, max_size=25).map("".join), max_size=4))
def test_words_encode_as_whole_texts(coder, texts):
    want = [np.array(coder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert coder.ids(texts) == want


def test_null_is_empty(coder):
    assert coder.ids([None, ""]) == [b"", b""]


@settings(max_examples=150, deadline=None)
@given(
    ids=st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=700),
    percentile=st.sampled_from([1.0, 50.0, 95.0, 100.0]),
)
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    body, starts = pfor.encode_blocks(ids, percentile)
    assert (pfor.decode_blocks(body, starts, len(ids)) == ids).all()


def test_shard_reads_single_documents():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 127, 128, 129, 1000, 0, 3])
    ids = np.minimum(rng.zipf(1.3, lengths.sum()), 2**31).astype(np.uint32)
    shard = pfor.Shard(pfor.encode_shard([None, *range(7)], lengths, ids))
    assert shard.doc_ids == [None, *range(7)]
    for i, (a, b) in enumerate(zip(shard.offsets, shard.offsets[1:], strict=False)):
        assert (shard.ids(i) == ids[a:b]).all()
    with pytest.raises(ValueError):
        pfor.Shard(b"no" * 100)


def test_outliers_do_not_widen_a_block():
    ids = np.arange(128, dtype=np.uint32) % 16
    ids[5] = 4_000_000_000
    assert len(pfor.encode_blocks(ids)[0]) < 128


def brute(coder, text):
    return [*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_output_and_reading_back(spark, odd, odd_rows, nothing):
    path = encoding.default_path("word_bpe_49k.json")
    coder = encoding.encoder(path)
    at = token_output.write(odd, path, shared_dir(spark, "t"), shard_ids=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_output.read(spark, at).collect())
    want = sorted((x for x in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[1] for g in got] == [w[0] for w in want]
    assert [g[0] for g in got] == np.concatenate(([0], np.cumsum([g[2] for g in got])))[:-1].tolist()
    bytes_of = lambda t: np.array(brute(coder, t), "<u4").tobytes()
    assert sorted((str(g[1]), g[3]) for g in got) == sorted((str(w[0]), bytes_of(w[1])) for w in want)
    assert token_output.read(spark, token_output.write(nothing, path, shared_dir(spark, "t"))).count() == 0


def test_op8(spark, small):
    import duckdb

    coder = encoding.encoder(encoding.default_path("word_bpe_49k.json"))
    got = token_output.op8_token_output(spark, small).orderBy("doc_id").collect()
    at = 0
    for r, (doc, text) in zip(got, duckdb.sql(f"select doc_id, text from '{small}/documents.parquet' order by 1").fetchall(), strict=True):
        ids = np.array(brute(coder, text), "<u4")
        assert tuple(r) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def check_packing(rows, want, window=2048):
    """rows: (doc_id, start, length, ids_crc32 or ids, doc_tokens, sequence_id, offset); want: id to a list of id lists."""
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
        sequences.setdefault(r[5], []).append((r[6], r[2]))
    for places in sequences.values():
        places.sort()
        assert [p for p, _ in places] == np.concatenate(([0], np.cumsum([n for _, n in places])))[:-1].tolist()
        assert sum(n for _, n in places) <= window
    assert set(by) == set(want)
    for doc, texts in want.items():
        crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
        pieces = sorted((r[4], r[1], r[2], r[3]) for r in by[doc])
        starts = [0] if len(texts) == 1 else None
        expected = sorted((len(t), a, min(window, len(t) - a), crc(t[a : a + window])) for t in texts for a in range(0, len(t), window))
        assert pieces == expected and (starts is None or pieces[0][1] == 0)
    return sum(window - sum(n for _, n in p) for p in sequences.values()) / (window * len(sequences))


def test_packing_of_odd_rows(spark, odd, odd_rows, nothing):
    path = encoding.default_path("byte_bpe_50k.json")
    coder = encoding.encoder(path)
    want = {}
    for r in odd_rows:
        want.setdefault(r[0], []).append(brute(coder, r[1]))
    rows = [(r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens, r.sequence_id, r.offset) for r in packing.pack(odd, path, group_chars=100_000).collect()]
    check_packing(rows, want)
    assert packing.pack(nothing, path).count() == 0


def test_op5(spark, small):
    import duckdb

    coder = encoding.encoder(encoding.default_path("byte_bpe_50k.json"))
    want = {d: [brute(coder, t)] for d, t in duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall()}
    assert check_packing(list(map(tuple, packing.op5_packing(spark, small).collect())), want) < 0.02


def test_repeated_rows_and_clashing_names(spark, clashing, odd_rows):
    byte, word = (encoding.default_path(f) for f in FILES)
    docs = clashing.select("*", *[F.lit("x").alias(c) for c in ("hash", "origin", "doc_tokens", "length", "offset", "ids", "before", "payload")]).unionAll(clashing.select("*", *[F.lit("x")] * 8))
    want = {}
    for r in odd_rows * 2:
        want.setdefault(r[0], []).append(brute(encoding.encoder(byte), r[1]))
    check_packing([(r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens, r.sequence_id, r.offset) for r in packing.pack(docs, byte, group_chars=50_000).collect()], want)
    check_packing(list(map(tuple, corpus_pipeline.packed(spark, docs, "").collect())), want)
    got = sorted((r.start, str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in token_output.read(spark, token_output.write(docs, word, shared_dir(spark, "t"))).collect())
    assert [g[0] for g in got] == np.concatenate(([0], np.cumsum([g[2] for g in got])))[:-1].tolist()
    ids = lambda t: np.array(brute(encoding.encoder(word), t), "<u4").tobytes()
    assert sorted(g[1::2] for g in got) == sorted((str(r[0]), ids(r[1])) for r in odd_rows * 2)


def test_a_repeated_row_is_many_groups(spark):
    docs = spark.createDataFrame([(7, "the same text again and again")] * 4000, "doc_id long, text string").repartition(8)
    rows = packing.pack(docs, encoding.default_path(FILES[0]), group_chars=10_000).groupBy((F.col("sequence_id") / (1 << 32)).cast("long")).count().collect()
    assert sum(r["count"] for r in rows) == 4000 and len(rows) > 3


def test_starts_of_repeated_ids_do_not_depend_on_the_order(spark):
    path, rows = encoding.default_path(FILES[1]), [(5, f"text number {i} {'x ' * (i % 7)}") for i in range(60)] + [(4, "a"), (6, "b")]
    found = []
    for n in (1, 5):
        docs = spark.createDataFrame(rows[::-1] if n == 1 else rows, "doc_id long, text string").repartition(n)
        found.append(sorted((r.start, r.doc_id, bytes(r.ids)) for r in token_output.read(spark, token_output.write(docs, path, shared_dir(spark, "t"))).collect()))
    assert found[0] == found[1]


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_decreasing_is_the_plain_rule(lengths):
    sequences, offsets, n = packing.best_fit_decreasing(lengths, 16)
    rooms, load = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [r for r in rooms if r >= lengths[i]]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - lengths[i])
        else:
            rooms.append(16 - lengths[i])
        assert offsets[i] == load.get(sequences[i], 0)
        load[sequences[i]] = offsets[i] + lengths[i]
    assert n == len(rooms) and sorted(16 - v for v in load.values()) == sorted(rooms)
