"""Leaves of JSON documents and similar texts against plain loops."""

import json
import random
from difflib import SequenceMatcher
from itertools import combinations

from pyspark.sql import functions as F

from tunetables.operators import matching as G
from tunetables.operators import similar as S
from tunetables.operators.leaves import json_leaves


def plain_leaves(v, path=(), idx=0):
    """(path, idx, text) of the leaves, fields of an object by their keys."""
    if isinstance(v, dict):
        return [x for k in sorted(v) for x in plain_leaves(v[k], (*path, k))]
    if isinstance(v, list) and v:
        mixed = any(isinstance(x, (dict, list)) for x in v)
        return [x for i, e in enumerate(v) for x in plain_leaves(e, path, 0 if mixed else i)]
    text = "" if v == [] else None if v is None else v if isinstance(v, str) else json.dumps(v)
    return [(path, idx, text)]


def random_document(rng, depth):
    kind = rng.randrange(7 if depth else 4)
    if kind < 4:
        return [rng.randint(-9, 9), rng.choice(["", "é", 'a"b', "x y"]), None, rng.random() < 0.5][kind]
    if kind < 6:
        return {rng.choice(["a", "b c", "é", "k.1", "z"]): random_document(rng, depth - 1) for _ in range(rng.randint(0, 3))}
    return [random_document(rng, depth - 1) for _ in range(rng.randint(0, 3))]


def test_leaves_equal_a_plain_walk(spark):
    rng = random.Random(5)
    docs = [random_document(rng, rng.randint(0, 9)) for _ in range(200)] + [{"a": [[[[[[[{"b": [1, 2]}]]]]]]]}]
    rows = [(i, json.dumps(d, ensure_ascii=False), "x") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pos int, text string, key string")
    got = {}
    for r in sorted(json_leaves(df, ["pos"]).collect(), key=lambda r: (r.pos, r["at"])):
        got.setdefault(r.pos, []).append((tuple(r.path), r.idx, r.text))
    want = {i: plain_leaves(d) for i, d in enumerate(docs)}
    assert {i: sorted(x, key=str) for i, x in got.items()} == {i: sorted(x, key=str) for i, x in want.items() if x}


def test_leaves_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "{"), (4, "{} {}"), (5, "7"), (5, "7"), (6, "[]"), (7, "{}"), (None, '{"a":1}')]
    df = spark.createDataFrame(rows, "value int, text string")
    got = sorted((r.value or 0, r.place, r.kind, r.text) for r in json_leaves(df, ["value"]).collect())
    assert got == [(0, "$.a", "number", "1"), (5, "$", "number", "7"), (5, "$", "number", "7"), (6, "$", "list", "")]
    assert json_leaves(df.limit(0), ["value"]).count() == 0


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "w"])
    return "".join(out)


def test_similar_values_equal_brute_force(spark):
    for least, seed in ((0.95, 1), (0.85, 2), (0.8, 4), (0.7, 3)):
        rng = random.Random(seed)
        bases = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 60))) for _ in range(25)]
        texts = [edited(rng, b, rng.randint(0, 6)) for b in bases for _ in range(5)] + ["a", "b", "", "", "abc", "ac", bases[0], bases[0]]
        df = spark.createDataFrame([(t,) for t in [*texts, None]], "line string")
        got = {(r.value, r.other): (r.copies, r.other_copies, round(r.similarity, 9)) for r in S.similar_values(df, "line", least).collect()}
        want = {}
        for a, b in combinations(sorted(set(texts)), 2):
            score = SequenceMatcher(None, a, b).ratio()
            if score >= least:
                want[a, b] = texts.count(a), texts.count(b), round(score, 9)
        assert got == want and len(want) > 10


def test_few_pairs_are_compared(spark):
    rng = random.Random(4)
    texts = {"".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randint(30, 60))) for _ in range(600)}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert S.candidates(df, 0.95).count() < len(texts) ** 2 / 20


def plain_matches(rows, least):
    """Pairs of each group in the greedy order, the similarity taken from the lesser text."""
    out = []
    for group in {r[0] for r in rows}:
        sides = {s: sorted((i, t) for g, side, i, t in rows if g == group and side == s and t is not None and i is not None) for s in ("gold", "pred")}
        found = []
        for a, (i, t) in enumerate(sides["gold"]):
            for b, (j, u) in enumerate(sides["pred"]):
                score = SequenceMatcher(None, min(t, u), max(t, u)).ratio()
                if score >= least:
                    found.append((-score, i, t, j, u, a, b))
        gone = set()
        for s, i, _, j, _, a, b in sorted(found):
            if (0, a) not in gone and (1, b) not in gone:
                gone |= {(0, a), (1, b)}
                out.append((group, i, j, round(-s, 9)))
    return sorted(out, key=str)


def test_greedy_matches_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", 7)
    counts = []
    inner = G.match_classes
    monkeypatch.setattr(G, "match_classes", lambda *a: counts.append(inner(*a)) or counts[-1])
    rng = random.Random(8)
    words = ["aaaaaaaaaa", "aaaaaaaaab", "aaaaaaaabb", "baaaaaaaab", "aaaaaaaaba"] + ["".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(6)]
    rows = [(rng.choice(["hot", "hot", "x", "y", None]), rng.choice(["gold", "pred"]), i // 2, edited(rng, rng.choice(words), rng.randint(0, 1))) for i in range(260)]
    rows += [("hot", "gold", 500 + i, words[0]) for i in range(90)] + [("hot", "pred", 500 + i, words[2]) for i in range(60)]
    rows += [("x", "gold", None, "q"), ("x", "pred", 3, None), ("x", "other", 3, words[0]), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "group string, side string, index long, text string").withColumn("key", F.lit("z"))
    got = sorted(((r.group, r.gold, r.prediction, round(r.similarity, 9)) for r in G.greedy_matches(df, 0.8).collect()), key=str)
    assert got == plain_matches(rows, 0.8)
    assert len({x[3] for x in got}) > 2 and counts[0][1] < len([x for x in got if x[3] < 1]) / 2
    assert G.greedy_matches(df.limit(0), 0.8).count() == 0
