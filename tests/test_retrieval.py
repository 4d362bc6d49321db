import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunetables.config import HitOptions, NdcgOptions, Stage
from tunetables.operators import retrieval as R
from tunetables.operators import rewards as W
from tunetables.plans import retrieval as plans


def vectors(spark, n, name, vec, seed, copies=0, text=False):
    rng = np.random.default_rng(seed)
    mat = np.round(rng.normal(size=(n, 8)), 2).astype(np.float32)
    mat[:copies] = mat[0]
    rows = [(f"i{i:03d}" if text else i, [float(x) for x in v]) for i, v in enumerate(mat)]
    kind = "string" if text else "int"
    return spark.createDataFrame(rows, f"{name} {kind}, {vec} array<float>"), rows


def brute(queries, items, k):
    out, longest = {}, max(np.linalg.norm(np.float64(np.float32(w))) for _, w in items)
    for q, v in queries:
        most = np.linalg.norm(np.float64(np.float32(v))) * longest or 1.0
        scores = [(-round(float(np.dot(np.float64(np.float32(v)), np.float64(np.float32(w)))) / most, 7), i) for i, w in items]
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("options", [{}, {"small_query_bytes": 0}, {"small_query_bytes": 0, "item_block": 20, "query_block": 7},
                                     {"small_query_bytes": 0, "cell_rows": 9, "item_block": 13, "query_block": 4}])
@pytest.mark.parametrize("copies,text", [(0, False), (60, True)])
def test_knn(spark, options, copies, text):
    q, qr = vectors(spark, 30, "qid", "vector", 1)
    i, ir = vectors(spark, 90, "item_id", "embedding", 2, copies, text)
    got = {}
    for r in R.knn(q, i, 7, **options).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.item_id)
    assert got == brute(qr, ir, 7)


def test_cells_prune_and_stay_exact(spark):
    """Clustered vectors: far fewer pairs than all, same answer."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 10
    mat = np.float32(centres[np.arange(600) % 12] + rng.normal(size=(600, 8)) * 0.1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(mat)]
    items = spark.createDataFrame(rows, "item_id int, embedding array<float>")
    queries = spark.createDataFrame(rows[:40], "qid int, vector array<float>")
    got = {}
    for r in R.knn(queries, items, 5, small_query_bytes=0, cell_rows=20).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.item_id)
    assert got == brute(rows[:40], rows, 5)


@pytest.mark.parametrize("options", [{}, {"small_query_bytes": 0}, {"small_query_bytes": 0, "cell_rows": 4}])
@pytest.mark.parametrize("size", [1e-5, 1.0, 1e6])
def test_ranking_does_not_depend_on_the_norm(spark, options, size):
    q = spark.createDataFrame([(1, [1e-4 * size, 0.0]), (2, [0.0, 0.0])], "qid int, vector array<double>")
    i = spark.createDataFrame([(n, [1e-5 * size * n, 0.0]) for n in range(1, 21)], "item_id int, embedding array<double>")
    got = R.knn(q, i, 3, **options).orderBy("qid", "rank").collect()
    assert [r.item_id for r in got] == [20, 19, 18, 1, 2, 3]
    assert got[0].score == pytest.approx(2e-8 * size * size)


@pytest.mark.parametrize("options", [{}, {"small_query_bytes": 0}, {"small_query_bytes": 0, "cell_rows": 9}])
def test_a_query_leaves_the_search_as_one_row(spark, options):
    q, qr = vectors(spark, 30, "qid", "vector", 1)
    i, ir = vectors(spark, 90, "item_id", "embedding", 2)
    got = [(r.qid, r.item_id) for r in R.knn_lists(q, i, 7, **options).collect()]
    assert len(got) == 30 and dict(got) == brute(qr, ir, 7)


def test_cells_are_left_out_where_they_spare_nothing(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 10
    near = np.float32(centres[np.arange(600) % 12] + rng.normal(size=(600, 8)) * 0.1)
    even = np.float32(rng.normal(size=(600, 64)))
    spare = []
    for mat in (near, even):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mat)], "item_id int, embedding array<float>")
        spare.append(R._cells_spare(df.toDF("qid", "vector"), df, 5, 30, *mat.shape))
    assert spare == [True, False]


@pytest.mark.parametrize("n", [8, 300, 1000])
def test_the_bar_of_a_chunk_lets_few_items_pass(n):
    """Whatever lets k items pass loses none; copies and items that are no numbers count as such."""
    share = np.random.default_rng(n).normal(size=(20, n)).astype(np.float32)
    share[:, n // 2 :: 7] = 1.5
    share[3, 0] = np.nan
    best = R._Best(np.ones((1, 2)), 7, 1.0)
    passed = (share >= best._reached(share)[:, None]).sum(axis=1)
    assert (passed >= 7).all() and (passed <= max(20, 2 + (share >= 1.5).sum(axis=1).max())).all()


@pytest.mark.parametrize("twice", [False, True])
def test_ranked_candidates_of_repeated_ids(spark, tmp_path, twice):
    """Rows that come twice meet each other's labels; both are ranked, written or not."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(np.float32(rng.normal(size=(20, 4))))]
    kind = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame(rows + rows[:6] * twice, kind).write.parquet(str(tmp_path / "embeddings.parquet"))
    queries = plans._queries(spark, str(tmp_path)).where("k < 4")
    got = [sorted(plans._ranked(spark, str(tmp_path), queries, 5, written=w).collect(), key=str) for w in (False, True)]
    assert got[0] == got[1]
    want = []
    for r in queries.collect():
        for version in R.VERSIONS:
            order = [i for i in brute([(0, r[version])], [(i, v) for i, v, _ in rows + rows[:6] * twice], 7)[0] if i not in (r.k, r.rid)]
            alike = [(i, i % 3 == r.k % 3) for i in order]
            want.append((r.k, version, tuple(alike[:5])))
    if not twice:
        ranks = {}
        for r in sorted(got[0], key=lambda r: r["rank"]):
            ranks.setdefault((r.k, r.version), []).append((r.item_id, r.relevant))
        assert ranks == {(k, v): list(x) for k, v, x in want}
    assert {r["rank"] for r in got[0]} == {1, 2, 3, 4, 5}


def test_few_items(spark):
    q, _ = vectors(spark, 3, "qid", "vector", 1)
    i, _ = vectors(spark, 2, "item_id", "embedding", 2)
    assert R.knn(q, i, 5).count() == R.knn(q, i, 5, small_query_bytes=0).count() == 6
    assert R.knn(q.limit(0), i, 5).count() == 0
    with pytest.raises(ValueError):
        R.knn(q, i, 0)


def reward(spark, pairs, opt):
    df = spark.createDataFrame(pairs, "o int, r int")
    return [x[0] for x in df.select(R.hit_reward(F.col("o"), F.col("r"), opt)).collect()]


def test_hit_reward(spark):
    opt = HitOptions(top_k=20, stages=(Stage(10, 0.1, 0.2), Stage(5, 0.3, 0.4)))
    log = lambda o, r: (math.log(o) - math.log(r)) / math.log(21)
    got = reward(spark, [(0, 1), (1, 0), (7, 7), (12, 9), (4, 6), (3, 2)], opt)
    want = [1.0, -1.0, 0.1, log(12, 9) + 0.1, log(4, 6) + 0.1 - 0.4, log(3, 2) + 0.3]
    assert got == pytest.approx(want)
    margin = HitOptions(top_k=20, rank_margin=2, shaping_weight=0.5, stages=(Stage(1, 0.0, 0.0),))
    assert reward(spark, [(6, 4), (9, 3)], margin) == pytest.approx([0.0, 0.5 * log(9, 3)])
    for bad in ((Stage(5, 0, 0), Stage(10, 0, 0)), (Stage(5, 0.2, 0), Stage(4, 0.1, 0)), (Stage(50, 0, 0),), ()):
        with pytest.raises(ValueError):
            HitOptions(top_k=20, stages=bad)


def test_ndcg(spark):
    # key 1: relevant at ranks 2 (original) and 1, 2 (rewritten), three relevant in all
    ranked = [(1, "original", 1, False), (1, "original", 2, True), (1, "original", 3, False), (1, "rewritten", 1, True), (1, "rewritten", 2, True), (1, "rewritten", 3, False)]
    ranked = spark.createDataFrame(ranked, "k int, version string, rank int, relevant boolean")
    totals = spark.createDataFrame([(1, 3), (2, 0)], "k int, num_relevant int")
    opt = NdcgOptions(top_ks=(1, 3), weighting_mode="small_k")
    w = [1 / (1 + 3**-0.5), 3**-0.5 / (1 + 3**-0.5)]
    ideal = 1 + 1 / math.log2(3) + 0.5
    old, new = [0.0, (1 / math.log2(3)) / ideal], [1.0, (1 + 1 / math.log2(3)) / ideal]
    want = sum(x * (n - o) / (1 - o + 1e-8) for x, o, n in zip(w, old, new))
    got = {r.k: r.ndcg_reward for r in R.ndcg_rewards(ranked, totals, "k", opt).collect()}
    assert got[1] == pytest.approx(want) and got[2] is None
    absolute = NdcgOptions(top_ks=(1, 3), weighting_mode="small_k", reward_mode="absolute")
    got = {r.k: r.ndcg_reward for r in R.ndcg_rewards(ranked, totals, "k", absolute).collect()}
    assert got[1] == pytest.approx(sum(x * n for x, n in zip(w, new)))
    for bad in ({"top_ks": (3, 1)}, {"reward_mode": "x"}, {"top_k": 2}, {"epsilon": 0.0}, {"top_ks": ()}):
        with pytest.raises(ValueError):
            NdcgOptions(**bad)


def test_cache(spark):
    opt = NdcgOptions(top_ks=(1, 3))
    rows = [(1, {"1": 0.5, "3": 0.5}, [1.0]), (2, {"1": 0.5}, [1.0]), (3, {"1": 0.5, "3": float("nan")}, [1.0]), (4, None, [1.0])]
    df = spark.createDataFrame(rows, "k int, cache map<string,double>, original array<double>")
    left = R.searched_versions(df, opt, "original", "cache").orderBy("k").collect()
    assert [r.original is None for r in left] == [True, False, False, False]
    assert R.searched_versions(df, NdcgOptions(reward_mode="absolute"), "original").where("original is not null").count() == 0


def test_relevance_table(spark):
    ranked = spark.createDataFrame([(1, "original", "a", 1), (1, "original", "b", 2), (1, "rewritten", "b", 1)], "k int, version string, item string, rank int")
    rel = spark.createDataFrame([(1, "b"), (1, "b"), (1, "c")], "k int, item string")
    marked = R.mark_relevant(ranked, rel, "k", "item")
    assert tuple(R.hit_locations(marked, "k").first()) == (1, 2, 1)
    assert R.relevant_counts(rel, "k", "item").first().num_relevant == 2


def test_scorers_follow_the_null_rules(spark):
    rows = [(1, "a_retrieval", "q", "['x', ['y']]"), (2, "math", "q", "['x']"), (3, "retrieval", "", "['x']"), (4, "retrieval", "q", ""), (5, "retrieval", "q", "[]"),
            (6, "retrieval", "q", "plain"), (7, "retrieval", "q", "['x']"), (8, None, "q", "x")]
    df = spark.createDataFrame(rows, "id int, category string, query string, truth string")
    ranked = spark.createDataFrame(
        [(k, v, c, r) for k in range(1, 7) for v in R.VERSIONS for r, c in enumerate(["n", "y", "plain"] if v == "original" else ["y", "n", "plain"], 1)],
        "id int, version string, candidate string, rank int",
    )
    opt = HitOptions(top_k=10, stages=(Stage(1, 0.2, 0.2),))
    hit = {r.id: r.retrieval_hit_reward for r in R.score_retrieval_hit(df, ranked, opt).collect()}
    assert hit[1] == pytest.approx(math.log(2) / math.log(11) + 0.2)
    assert [hit[k] for k in (2, 3, 4, 8)] == [None] * 4
    assert [hit[k] for k in (5, 6, 7)] == [0.0] * 3  # double misses, and an unchanged hit
    ndcg = {r.id: r.retrieval_ndcg_reward for r in R.score_retrieval_ndcg(df, ranked, NdcgOptions(top_ks=(1,), reward_mode="absolute")).collect()}
    assert [ndcg[k] for k in (2, 3, 4, 5, 8)] == [None] * 5
    assert (ndcg[1], ndcg[6], ndcg[7]) == (1.0, 0.0, 0.0)


def test_all_rewards_can_be_built_and_read_messages(spark):
    ranked = spark.createDataFrame([(1, "original", "x", 1), (1, "rewritten", "x", 1)], "id int, version string, candidate string, rank int")
    runs = spark.createDataFrame([("print(1)", "success", "1")], "snippet string, status string, stdout string")
    extra = {"retrieval_hit": {"ranked": ranked}, "retrieval_ndcg": {"ranked": ranked}, "code_execution": {"executions": runs}}
    names = ["think_format", "answer_format", "match", "code_execution", "rouge", "equation", "retrieval_hit", "retrieval_ndcg", "kv", "grounding_bbox", "grounding_selection"]
    rewards = [W.build_reward(n, 2.0, **extra.get(n, {})) for n in names]
    texts = spark.createDataFrame(
        [(1, "math", "answer: 4", "4", "q", "x", 4.0, [4])], "id int, category string, completion string, solution string, query string, truth string, target double, numbers array<int>"
    )
    chats = texts.withColumn("completion", F.array(F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content"))))
    got = [W.score_all(df, rewards).select(*[f"`{r.name}`" for r in rewards]).first() for df in (texts, chats)]
    assert got[0] == got[1] and len(got[0]) == 11 and got[0]["match_reward"] == 2.0


def test_hot_snippets_are_split(spark):
    block = "```python\nprint(1)\n```"
    df = spark.range(300).select("id", F.lit("code").alias("category"), F.when(F.col("id") % 10 < 9, block).otherwise("none").alias("completion"), F.lit(block).alias("solution"))
    runs = spark.createDataFrame([("print(1)", "success", "1")], "snippet string, status string, stdout string")
    got = W.score_code(df, runs).groupBy("code_execution_reward").count().collect()
    assert sorted(map(tuple, got)) == [(-0.0, 30), (1.0, 270)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 9}])
def test_a_query_is_sent_to_one_task_only(spark, monkeypatch, options):
    """Neither cells nor blocks multiply the rows of the queries."""
    q, qr = vectors(spark, 40, "qid", "vector", 1)
    i, ir = vectors(spark, 90, "item_id", "embedding", 2, 5)
    sent, product = [], R._product
    monkeypatch.setattr(R, "_product", lambda left, *rest, **more: sent.append(left.count()) or product(left, *rest, **more))
    got = {}
    for r in R.knn(q, i, 7, small_query_bytes=0, query_block=10, item_block=10, **options).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.item_id)
    assert got == brute(qr, ir, 7) and sent and set(sent) == {40}


def test_best_items_are_kept_over_many_chunks():
    rng = np.random.default_rng(3)
    q, m = (np.round(rng.normal(size=(n, 4)), 1) for n in (9, 700))
    longest = np.linalg.norm(m, axis=1).max()
    best = R._Best(q, 6, longest)
    best.limit = 60
    for a in range(0, 700, 5):
        best.add(np.arange(a, min(a + 5, 700)), np.zeros(5, bool), m[a : a + 5], (m[a : a + 5] / longest).astype(np.float32))
    row, _, ids, *_ = best.found()
    want = brute(list(enumerate(q)), list(enumerate(m)), 6)
    places = lambda x, w: np.round(q[x] @ m[w].T / (np.linalg.norm(q[x]) * longest), 7).tolist()
    assert {x: places(x, ids[row == x]) for x in range(9)} == {x: places(x, want[x]) for x in range(9)}


def test_repeated_queries_are_one(spark):
    q, _ = vectors(spark, 3, "qid", "vector", 1)
    i, _ = vectors(spark, 20, "item_id", "embedding", 2)
    for options in ({"item_block": 5}, {"cell_rows": 4}):
        found = R.knn(q.unionAll(q), i.unionAll(i), 4, small_query_bytes=0, **options).groupBy("qid").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items")).collect()
        assert [(r.n, r["items"]) for r in found] == [(4, 1)] * 3
