"""Near duplicates, benchmark search, repeated bytes against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import tunetables.llm.queries  # noqa: F401  (fills the registry)
from tunetables.llm import decontaminate, neardup, suffixes, tables
from tunetables.plans.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def roots(nodes, links):
    head = {n: n for n in nodes}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_components(texts, size, percent):
    sets = {d: shingle_set(t, size) for d, t in texts.items()}
    ids = sorted(d for d in sets if sets[d])
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, roots(sets, links), links


def family(rng, n, words, edits):
    """A base text and copies of it, each with a few words changed."""
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"z{rng.randint(0, 5000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [400, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(11)
    texts = [t for n, words, edits in ((40, 120, 6), (25, 60, 4), (5, 30, 1), (30, 200, 14)) for t in family(rng, n, words, edits)]
    texts += ["one two", "One TWO", "one", None, "", " \n ", *texts[:5]]
    rng.shuffle(texts)
    by_id = dict(enumerate(texts))
    sets, want, links = plain_components(by_id, 3, 85)
    assert 50 < len(links)
    df = spark.createDataFrame([(d, t, 1) for d, t in by_id.items()], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in neardup.near_duplicates(df, neardup.Plan(3, 85, 6)).collect()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_near_duplicates_table_cases(spark):
    plan = neardup.Plan(3, 85, 6)
    df = spark.createDataFrame([(5, "a b c d"), (5, "x y z u"), (3, "x y z u"), (9, "a b c d"), (None, "a b c d"), (7, None), (7, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df, plan).collect())
    assert got == Counter({(5, 3, False): 2, (3, 3, True): 1, (9, 3, False): 1, (None, None, True): 1, (7, 7, True): 2})
    assert neardup.near_duplicates(df.limit(0), plan).count() == 0


def test_posterior_cuts_keep_true_pairs():
    plan = neardup.Plan(3, 85, 6)
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (4000, plan.hashes), dtype=np.uint16)
    for similar, least in ((0.87, 0.999), (0.4, 0.0)):
        b = np.where(rng.random(a.shape) < similar, a, a ^ 1)
        share = len(neardup.survivors(a, b, neardup.cuts(85, plan.hashes, plan.miss))) / len(a)
        assert share >= least and (similar > 0.5 or share < 0.001)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 230)] + [(230, 7), (7, 5), (9, 9)] + [
        tuple(rng.sample(range(300, 360), 2)) for _ in range(40)
    ]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in tables.components(df).collect()}
    want = roots({n for x in links for n in x}, links)
    assert {n: got.get(n, n) for n in want} == want
    assert tables.components(df.limit(0)).count() == 0


def test_join_keeps_hot_and_null_keys(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "k long, id long")
    )
    right = spark.range(4500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = tables.join_unique(left, right, ["k"])
    assert got.count() == 4500 and got.agg(F.sum("v")).first()[0] == left.join(right, "k").agg(F.sum("v")).first()[0]


def test_contained_items_equal_brute_force(spark):
    rng = random.Random(8)
    items = [" ".join(f"i{rng.randint(0, 900)}" for _ in range(n)) for n in (6, 9, 17, 30, 60, 120, 4, 5)] + [None, "", "a b"]
    items.append(items[2])
    docs = []
    for _ in range(150):
        w = [f"d{rng.randint(0, 900)}" for _ in range(rng.randint(0, 300))]
        for t in rng.sample([t for t in items if t], 2):
            part = t.split()
            if rng.random() < 0.6:
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append(" ".join(w))
    items += [items[3].upper().replace(" ", "  "), "这是一个很短的测试", "天气", "alpha beta gamma"]
    docs += ["a b", "A B", None, "", docs[0], "x a b y " * 3, "a c b", "前面这是一个很短的测试后面", "今天天气好 and alpha\nBETA gamma too", "alpha beta"]

    def apart(text):
        return re.sub("([\u4e00-\u9fff])", r" \1 ", text or "")

    want = set()
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            s = shingle_set(apart(item), 5)
            own = shingle_set(apart(text), min(5, len(apart(item).split())))
            if s and 100 * len(s & own) >= 80 * len(s):
                want.add((d, i, len(s), len(s & own)))
    pairs = {x[:2] for x in want}
    assert {(d, 11) for d, i in pairs if i == 2} | {(d, 12) for d, i in pairs if i == 3} <= pairs
    assert {(155, 10), (157, 13), (158, 14), (158, 15)} <= pairs and not {(156, 10), (159, 15)} & pairs
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame([*enumerate(items), (None, items[0])], "item_id long, text string")
    for more_passes in (False, True):
        with pytest.MonkeyPatch.context() as m:
            if more_passes:
                m.setattr(decontaminate, "PASS", 40)
            got = [(r.doc_id, r.item_id, r.n_item, r.n_found) for r in decontaminate.contained_items(df, bench).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert decontaminate.contained_items(df, bench.limit(0)).count() == 0
    assert decontaminate.contained_items(df.limit(0), bench).count() == 0
    members = {(r.item_id, r.class_id) for r in decontaminate.item_classes(bench, 5, "item_id", "text").collect()}
    assert (11, 2) in members and (12, 3) in members
    named = decontaminate.contained_items(df, bench.withColumn("item_id", F.concat(F.lit("i"), "item_id")), least_words=5)
    assert {(r.doc_id, r.item_id) for r in named.collect()} == {(d, f"i{i}") for d, i in pairs if i not in (6, 10, 14, 15)}


def test_signatures_of_large_disjoint_sets_differ(spark):
    texts = [(k, " ".join(f"{k}w{i}" for i in range(20_000))) for k in range(2)]
    plan = neardup.Plan(3, 85, 6)
    a, b = (np.frombuffer(r.sig, "<u2") for r in neardup.sketch(spark.createDataFrame(texts, "doc_id long, text string"), plan, "doc_id", "text").collect())
    assert (a == b).mean() < 0.02


def plain_removal(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shared_texts(rng):
    passages = ["".join(rng.choice("abcé ") for _ in range(rng.randint(60, 400))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choice("abcdefgh é\n") for _ in range(rng.randint(0, 150)))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            a = rng.randint(0, 40)
            parts += [p[a:], "".join(rng.choice("xyz") for _ in range(rng.randint(0, 30)))]
        texts.append("".join(parts))
    return texts + [texts[0], None, "", "q" * 700, "ab" * 300, "ab" * 301, "é" * 200]


@pytest.mark.parametrize("runs,batches", [(20_000, 3), (1, 5)])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, runs, batches):
    monkeypatch.setattr(suffixes, "RUNS", runs)
    texts = shared_texts(random.Random(runs))
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_removed int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df, 120, batches).collect()}
    want = dict(enumerate(plain_removal(texts, 120)))
    assert got == want and sum(w[1] for w in want.values()) > 1000


def test_repeated_bytes_table_cases(spark):
    long = "".join(random.Random(2).choice("abcdef") for _ in range(300))
    df = spark.createDataFrame([(1, long), (1, long), (None, "x" + long), (2, None)], "doc_id long, text string")
    tables = spark.catalog.listTables()
    got = Counter((r.doc_id, r.n_removed) for r in suffixes.remove_repeats(df, 120).collect())
    assert got == Counter({(1, 300): 2, (None, 300): 1, (2, 0): 1})
    assert spark.catalog.listTables() == tables
    assert suffixes.remove_repeats(df.limit(0), 120).count() == 0


def test_cut_texts_keep_whole_characters_and_columns(spark):
    shared = "é" * 3 + "".join(random.Random(2).choice("abcdefé") for _ in range(200)) + "é" * 3
    df = spark.createDataFrame([(1, "à" + shared + "1", "p", 9), (2, "è" + shared + "2", "q", 9), (3, None, None, None)], "doc_id long, text string, uid string, n long")
    rows = {r.doc_id: r for r in suffixes.cut_texts(df, 120, 2).collect()}
    cut = suffixes.remove_repeats(df, 120, 2, whole=True)
    assert {r.doc_id: (r.text, r.kept and len(r.kept)) for r in cut.collect()} == {1: ("à1", 3), 2: ("è2", 3), 3: (None, None)}
    # the second bytes of à and è differ, so only whole characters of the shared part go
    assert {d: (r.text, r.uid, r.n) for d, r in rows.items()} == {1: ("à1", "p", 9), 2: ("è2", "q", 9), 3: (None, None, None)}


def test_repeats_of_many_short_words_are_cut(spark):
    rng = random.Random(9)
    some = [" ".join(rng.choice("abcdefgé") for _ in range(n)) for n in (51, 50, 80)]
    texts = [f"{i}left{k} {p} right{i}{k}" for i in range(2) for k, p in enumerate(some)]
    texts += ["only " + " ".join(rng.choice("hijk") for _ in range(90)), "z\t" * 60, "y " * 51, some[0].replace(" ", "\n"), None, "", *["p q " * 30] * 2]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(len(texts) - 1, texts[-1], 0)], "doc_id long, text string, n long")

    def plain(text):
        raw = (text or "").encode()
        return raw, [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]

    given = [(i, *plain(t)) for i, t in [*enumerate(texts), (len(texts) - 1, texts[-1])]]
    seen = Counter(raw[w[k][0] : w[k + 50][1]] for _, raw, w in given for k in range(len(w) - 50))
    want = Counter()
    for i, raw, w in given:
        gone = {b for k in range(len(w) - 50) if seen[raw[w[k][0] : w[k + 50][1]]] > 1 for b in range(w[k][0], w[k + 50][1])}
        want[i, bytes(x for b, x in enumerate(raw) if b not in gone).decode() if texts[i] is not None else None] += 1
    cut = Counter((r.doc_id, r.text) for r in suffixes.cut_texts(df, 250, 2, words=51).collect())
    assert cut == want and ((0, "0left0  right00") in cut) and ((1, texts[1]) in cut) and ((7, "\t") in cut)


def test_op6_cuts_passages_of_400_bytes_and_no_shorter_ones(spark, tmp_path):
    rng = random.Random(6)
    long, short = (" ".join("".join(rng.choice("abcdefgh") for _ in range(n)) for _ in range(51)) for n in (8, 5))
    assert len(short) < 400 < len(long)
    texts = [f"{i}é{''.join(rng.choice('pqrs ') for _ in range(300))}{gap}{p}{gap}{k}{i}" for k, p in enumerate((long, short)) for i, gap in ((1, "\n"), (2, " "))]
    spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op6_repeated_bytes"](spark, str(tmp_path)).collect()}
    got = {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in rows.items()}
    assert got == dict(enumerate(plain_removal([*texts, None], 400)))
    assert [rows[i].n_removed for i in range(5)] == [len(long)] * 2 + [0] * 3
    assert [rows[i].text for i in range(5)] == [t.replace(long, "") for t in texts] + [None]


def test_window_anchors_are_the_least_of_each_window(monkeypatch):
    rng = np.random.default_rng(1)
    for mask in (suffixes._MASK, np.uint64(63)):
        monkeypatch.setattr(suffixes, "_MASK", mask)
        grams = rng.integers(0, 1 << 62, 500, dtype=np.uint64) & ~mask
        grams[100:140] = grams[100]
        got = suffixes.window_anchors(grams, 17)
        assert got.tolist() == [i + int(np.argmin(grams[i : i + 17])) for i in range(500 - 16)]


def test_levels_merge_geometrically(spark):
    texts = spark.createDataFrame([(i, "".join(random.Random(i).choice("abcdefgh") for _ in range(500))) for i in range(40)], "uid long, text string")
    every = suffixes.suffixes(texts, 120)
    one = suffixes.Family(spark)
    for i in range(6):
        one.add(every.filter(F.col("uid") % 6 == i))
    assert [n for n, _ in one.levels] == [4, 1, 1]
