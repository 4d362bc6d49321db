"""Quality rules, packing, archives and the pipeline against plain versions."""

import hashlib
import math
import random
import re
import struct
import zlib
from base64 import b32encode
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__  # noqa: F401  (fills the registry)
import corpus_pipeline
from tunetables.llm import packing, quality, warc
from tunetables.plans.registry import ORACLES, QUERIES

from test_pairs import plain_components, plain_removal, shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)


def test_measures_equal_plain_counts(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a", "b ", "a a ", "\n", "é ", "|", "#", "\x0b", "😀 ", "c\n", " ", " \n"]) for _ in range(rng.randint(0, 200))))
            for i in range(200)]
    rows += [(200, None), (201, ""), (202, "one two three four five " * 400), (202, "x"), (None, "a b c d e f g h i j")]
    df = spark.createDataFrame([(d, t, None, 0) for d, t in rows], "doc_id long, text string, lang string, stratum int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge_quality(df, labels).collect())
    assert got == Counter((d, *plain_counts(t)) for d, t in rows)
    assert quality.judge_quality(df.limit(0), labels).count() == 0
    assert quality.kept_documents(df, labels.limit(0)).filter("doc_id is null").count() == 1


def test_binomial_tail(spark):
    cases = [(x, n) for n in (1, 5, 19, 20, 21, 100, 3000, 200_000) for x in {0, n // 300, int(n * 0.009)} if x < n * 0.01]
    df = spark.createDataFrame(cases, "x long, n long").withColumn("p", quality.binomial_tail(F.col("x"), F.col("n"), 0.01))
    for r in df.collect():
        want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(k + 1) - math.lgamma(r.n - k + 1) + k * math.log(0.01) + (r.n - k) * math.log(0.99)) for k in range(r.x + 1))
        assert r.p == pytest.approx(want, rel=1e-7)


def test_cutoffs_hold_their_risk(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        bad = i % 3 == 0
        text = " ".join(f"w{rng.randint(0, 10**6)}" + ("###" if bad else "#" * (rng.random() < 0.02)) for _ in range(30))
        rows.append((i, text, "a" if i < 2900 else "b", 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    out = {r.doc_id: r for r in quality.judge_quality(df, df.select("doc_id", "quality")).collect()}
    assert sum(not out[i].kept for i, _, s, q in rows if q and s == "a") <= 0.01 * 1933
    assert all(not out[i].kept for i, _, s, q in rows if not q and s == "a")
    # the other stratum has too few labels for any guarantee
    assert all(out[i].kept for i, _, s, _ in rows if s == "b")


def test_quality_sql(spark, sf):
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    rel = db.sql(ORACLES["op8_quality_rules"])
    got = Counter(tuple(r[c] for c in rel.columns) for r in QUERIES["op8_quality_rules"](spark, sf).collect())
    assert got == Counter(rel.fetchall())


def plain_best_fit(lengths, capacity):
    """One piece at a time, by the same score."""
    size, weight = np.array([capacity.tokens, capacity.documents, capacity.attention], float), np.array(capacity.weights)
    bins = []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n])
        best = None
        for k, room in enumerate(bins):
            if (room >= need).all():
                score = (((room - need) / size) ** 2) @ weight if capacity.score == "norm" else -((room / size) * (need / size)) @ weight
                if best is None or score < best[0] - 1e-15:
                    best = (score, k)
        if best is None:
            bins.append(np.maximum(size.astype(int) - need, 0))
        else:
            bins[best[1]] = bins[best[1]] - need
    return len(bins)


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.integers(1, 40), max_size=60), st.sampled_from(["norm", "dot"]), st.sampled_from([(40, 40, 1600), (40, 3, 1600), (40, 40, 500), (40, 5, 300)])
)
def test_plan_fits_every_capacity(lengths, score, limits):
    capacity = packing.Capacity(*limits, score=score)
    counts = Counter(lengths)
    plan = packing.plan_packing(counts, capacity)
    bins = defaultdict(list)
    for n, c in counts.items():
        sequence, offset = plan.place(np.full(c, n), np.arange(c))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            bins[s].append((o, n))
    for own in bins.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 40
        assert len(own) <= limits[1]
        assert len(own) == 1 or sum(n * n for _, n in own) <= limits[2]
    if score == "norm" and limits == (40, 40, 1600):
        assert len(bins) <= plain_best_fit(lengths, capacity) + 1


@pytest.mark.parametrize("numbered", [200_000, 7])
def test_packing_is_a_whole_partition_of_the_ids(spark, sf, monkeypatch, numbered):
    monkeypatch.setattr(packing, "NUMBERED", numbered)
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(120).unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-2, ""), (None, "a b"), (-3, "word " * 5000)], "doc_id long, text string")
    ).withColumn("length", F.lit("x"))
    rows = packing.pack_documents(docs, path, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            cut = ids[s : s + 2048]
            want[(r.doc_id, k, s, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut)), tuple(cut))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 2048
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 2048) + 1
    built = packing.sequences(packing.pack_documents(docs, path, with_ids=True)).collect()
    assert sum(len(r.ids) for r in built) == total and max(len(r.ids) for r in built) <= 2048
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def sha(payload):
    return b32encode(hashlib.sha1(payload).digest()).decode()


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "x€" * 400_000
    rows = [(1, "http://a/\r\nb", "<a>"), (2, None, "<a>"), (3, "u", None), (4, "", ""), (5, "http://b", big), (6, "http://c", big), (0, "x", "\r\n\r\nWARC/1.1"), (None, "z", "z"),
            *[(i, f"http://s/{i}", f"<html>page {i} " + "lorem ipsum " * (i % 50)) for i in range(100, 200)]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    folder = str(tmp_path / "warc")
    got = {r.page_id: r for r in warc.round_trip(df, folder, payloads=True).collect()}
    first = {}
    for i, u, h in sorted((r for r in rows if r[0] is not None)):
        payload = (h or "").encode()
        refers = first.setdefault(payload, i)
        r = got.pop(i)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), sha(payload))
        assert (r.record_type, r.refers_to) == (("response", None) if refers == i else ("revisit", refers))
        assert r.payload is None if refers != i else bytes(r.payload) == payload
        assert r.url == (u and u.replace("\r\n", "%0D%0A"))
    assert not got
    assert warc.round_trip(df.limit(0)).count() == 0
    least = {r.page_id: r.record_type for r in warc.round_trip(df, least=10).collect()}
    assert least[2] == least[4] == "response" and least[6] == "revisit"


def test_repeated_page_ids_are_one_page(spark):
    df = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (2, "v", "b"), (2, "v", "c")], "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_digest) for r in warc.round_trip(df).collect())
    assert got == [(1, sha(b"a")), (2, min(sha(b"b"), sha(b"c")))]


def test_every_page_row_has_a_record(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "v", "b"), (2, "v", "c"), (2, None, "c"), (0, "w", "d"), (None, "x", "c"), (None, "x", "e"), (None, "x", "e"), (None, None, None)]
    rows += [(3, "y", "f")] * 5
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 9):
        got = warc.round_trip(df, str(tmp_path / f"warc{least}"), least, payloads=True, every_row=True).collect()
        assert Counter((r.page_id, r.url, r.payload_digest) for r in got) == Counter((i, u, sha((h or "").encode())) for i, u, h in rows)
        first = {}
        for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
            first.setdefault(sha((h or "").encode()), i)
        for d, own in first.items():
            met = [r for r in got if r.payload_digest == d]
            assert all((r.payload is not None) == (r.record_type == "response") for r in met)
            held = [r for r in met if r.record_type == "response"]
            assert len(held) == (len(met) if least else 1)
            assert least or held[0].page_id == own and all(r.refers_to == own for r in met if r is not held[0])
    names = []
    for p in (tmp_path / "warc0").glob("*.warc.zst"):
        with p.open("rb") as f:
            names += [re.search(rb"WARC-Record-ID: (\S+)", x)[1] for x in warc._frames(f.read)]
    assert len(names) == len(set(names)) == len(rows)


def test_op10_gives_every_row_back(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "b"), (None, "v", "b")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op10_warc_round_trip"](spark, str(tmp_path)).collect())
    assert got == Counter([(1, sha(b"a"), "response", None), (1, sha(b"b"), "response", None), (None, sha(b"b"), "revisit", 1)])


def test_archives_are_checked(tmp_path):
    samples = [(f"<html>{i} " + "common words in every page " * 20).encode() for i in range(400)]
    dictionary = warc.train(samples)
    assert dictionary is not None and warc.train([]) is None
    archive = warc.Archive(str(tmp_path), dictionary)
    for i, s in enumerate(samples):
        archive.add(warc.record(i, "u", s, sha(s), len(s), None))
    name = archive.close()
    raw = (tmp_path / name).read_bytes()
    assert struct.unpack("<I", raw[:4])[0] == 0x184D2A5D

    def frames(data):
        at = [0]

        def read(n):
            at[0] += n
            return data[at[0] - n : at[0]]

        return list(warc._frames(read))

    assert [warc.parse(f)["payload"] for f in frames(raw)] == samples
    size = 8 + struct.unpack("<I", raw[4:8])[0]
    with pytest.raises(warc.WarcError):
        frames(raw[size:])  # without its dictionary
    with pytest.raises(warc.WarcError):
        frames(raw[:-5])
    good = warc.record(1, "u", b"abc", sha(b"abc"), 3, None)
    assert warc.parse(good)["payload_digest"] == sha(b"abc")
    for bad in (good[:-1], good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Date", b"X-Date"),
                good.replace(b"response\r\nWARC-R", b"other\r\nWARC-R"), good.replace(b"<urn:page:1>", b"1")):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
    assert zstandard.get_frame_parameters(raw[size:]).dict_id == dictionary.dict_id()


def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out.append(docs)
    return out


def test_pipeline_equals_plain_stages(spark, sf):
    """Each stage against a plain version on its own input."""
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    out = stages(spark, sf)
    assert [f.columns for f in out[:-1]] == [corpus_pipeline.COLUMNS] * 4

    texts = [{r.doc_id: r.text for r in f.collect()} for f in out[:-1]]
    judged = {r.doc_id: r.kept for r in QUERIES["op8_quality_rules"](spark, sf).collect()}
    assert texts[0] == {d: t for d, t in given.items() if judged[d]}

    _, root, _ = plain_components(texts[0], 5, 80)
    assert texts[1] == {d: t for d, t in texts[0].items() if root[d] == d}

    ids = sorted(texts[1])
    for d, want in zip(ids, plain_removal([texts[1][d] for d in ids], corpus_pipeline.REPEAT_BYTES)):
        cut = len(texts[1][d].encode()) - len(texts[2][d].encode())
        assert want[1] - 6 * max(1, want[2]) <= cut <= want[1]
    assert {r.doc_id: r.n_chars for r in out[2].collect()} == {d: len(t) for d, t in texts[2].items()}

    sets = [s for s in (shingle_set(t, 5) for t in bench) if s]
    dirty = {d for d, t in texts[2].items() if any(100 * len(s & shingle_set(t, 5)) >= 80 * len(s) for s in sets)}
    assert dirty and texts[3] == {d: t for d, t in texts[2].items() if d not in dirty}
    assert {r.doc_id for r in out[4].collect()} == set(texts[3])
    assert QUERIES["pipeline"](spark, sf).count() == out[4].count()


def test_passages_of_short_words_are_cut(spark):
    passage = " ".join("abcdefgh"[i * i * i % 7] for i in range(51))
    rows = [(1, f"left {passage} here", "en", "s", 0), (2, f"right {passage} there", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_bytes(spark, docs, "").collect()}
    assert got == {1: ("left  here", 10), 2: ("right  there", 12)}


def test_stages_survive_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, text + " x", "en", "s", 5), (2, None, "en", "s", 0), (3, "", None, None, 0), (4, "a " * 50_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    for some in (docs.withColumns({"id": F.lit(1), "_row": F.lit(2), "uid": F.lit(3)}), docs.limit(0)):
        frame = some
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path)).cache()
            if name == "quality":
                assert Counter(r.doc_id for r in frame.collect()) == (Counter({1: 2, None: 1}) if some is not docs and frame.count() else Counter())
        frame.count()
