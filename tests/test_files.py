import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tunetables.operators import report as P
from tunetables.operators import shape as S
from tunetables.operators import turns as U
from tunetables.plans import fixtures as X
from tunetables.sources import files as A
from tunetables.streaming import files as L


def test_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"p,""q""\nr"\n2,\n')
    (tmp_path / "a.tsv").write_text("x\ty\n3\tz\n")
    (tmp_path / "a.jsonl").write_text('{"x": 4, "w": "u"}\n')
    (tmp_path / "a.json").write_text('[{"x": 5, "y": "v"},\n {"x": 6, "y": null}]')
    specs = [A.FileSpec(str(tmp_path / f"a.{f}"), f) for f in ("csv", "tsv", "jsonl", "json")]
    rows = A.read_files(spark, specs).orderBy("x").collect()
    assert [(r.x, r.y, r.w) for r in rows] == [
        (1, 'p,"q"\nr', None), (2, None, None), (3, "z", None), (4, None, "u"), (5, "v", None), (6, None, None),
    ]
    assert A.read_test(spark, specs[:1]).orderBy("x").collect()[1].y == "_"
    with pytest.raises(ValueError):
        A.read_file(spark, "x", "xlsx")


def test_first_mode(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a bigint")
    out = A.union([a, b], "first")
    assert out.dtypes == [("a", "int"), ("b", "string")] and out.count() == 2
    with pytest.raises(ValueError):
        A.union([a, a.withColumn("c", F.lit(1))], "first")


def test_write_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None), (2, 'q"', [1])], "i int, t string, a array<int>").repartition(2)
    path = str(tmp_path / "out")
    A.write_results(df, path, "records")
    found = [r for f in Path(path).glob("part*") for r in json.loads(f.read_text())]
    assert sorted(found, key=lambda r: r["i"]) == [{"i": 1, "t": "é", "a": None}, {"i": 2, "t": 'q"', "a": [1]}]
    assert A.read_file(spark, path, "json").count() == 2
    A.write_results(df, path + "2", "lines")
    assert A.read_file(spark, path + "2", "jsonl").count() == 2


def test_inputs():
    base = {"name": "d", "format": "parquet", "root": "/r"}
    assert A.DatasetInput(**base, subdir="s").specs()[0].path == "/r/s/d.parquet"
    assert A.DatasetInput(**base, path="x/../d.parquet").specs()[0].path == "/r/d.parquet"
    with pytest.raises(ValueError):
        A.DatasetInput(**base, path="other.parquet").specs()
    assert A.DatasetInput(**base, path="other.parquet", allow_other_names=True).specs()[0].path == "/r/other.parquet"
    with pytest.raises(ValueError):
        A.DatasetInput(**base, path="a", paths=("b",)).specs()
    with pytest.raises(ValueError):
        A.DatasetInput(**base, files=(A.FileSpec("d.parquet", "parquet", 1.0),), allow_weight=False).specs()
    with pytest.raises(ValueError):
        A.FileSpec("p", "csv", 0)


def test_modes():
    p, c = A.FileSpec("p", "parquet"), A.FileSpec("c", "csv")
    assert A.input_modes([p], None) == ("single_file", "sampled_from_train", True)
    assert A.input_modes([p, p], [p]) == ("multi_file", "external_single_file", False)
    assert A.input_modes([p, c], [p, c]) == ("multi_format", "external_multi_format", False)
    assert A.input_modes([p], [p, p], streaming=True) == ("streaming_single_file", "streaming_external_multi_file", False)
    assert A.input_modes([p], None, use_validation=False, resampling=True) == ("weighted_resampled", "disabled", False)


def test_validation(spark, sf):
    assert A.read_validation(spark, None) is None
    with pytest.raises(ValueError):
        A.read_validation(spark, [A.FileSpec("p", "csv", 1.0)])
    with pytest.raises(ValueError):
        L.check_stream_options(None, True, 5, False)
    with pytest.raises(ValueError):
        L.check_stream_options(None, False, 0, False)
    counts = A.file_counts(A.read_file(spark, f"{sf}/region.parquet", "parquet")).collect()
    assert [r.rows for r in counts] == [5]


def test_weighted_files(spark, sf):
    specs = [A.FileSpec(f"{sf}/labels.parquet", "parquet", 1.0), A.FileSpec(f"{sf}/documents.parquet", "parquet", 3.0)]
    assert A.read_weighted(spark, specs, "doc_id", 1, target_size=40).count() == 40
    with pytest.raises(ValueError):
        A.read_weighted(spark, [A.FileSpec("p", "csv")], "k", 1)


def test_shapes(spark):
    df = spark.createDataFrame([(1, "q", " a ", float("nan"), None)], "k int, data string, target string, f double, s string")
    assert S.fill_missing(df, stringify=True).first() == ("1", "q", " a ", "_", "_")
    assert S.fill_missing(df).first().s == "_"
    sft = S.to_sft(df.withColumn("data", S._text_part(F.col("data"))), "data", "target", multimodal=True).first().messages[1]
    assert sft.role == "assistant" and sft.content[0].text == "a"
    pref = S.to_preference(df, "data", "target", "s").first()
    assert pref.prompt[0].role == "user" and pref.chosen[0].content == " a "
    with pytest.raises(ValueError):
        S.standardise_columns(df, {"zz": "prompt"})
    assert S.drop_inputs(df, ["data"]).columns == ["k", "target", "f", "s"]
    assert S.keep_columns(df.withColumn("image", F.lit("i")), ["k"]).columns == ["k", "image"]
    one = spark.createDataFrame([([("user", "x")],)], f"messages array<{S.MESSAGE}>")
    popped = S.to_test_conversation(one).first()
    assert popped.prompt == [] and popped.label == "x"
    cleaned = spark.createDataFrame([((None, [(1, None)]),)], "v struct<a:string,b:array<struct<c:int,d:int>>>")
    assert cleaned.select(S.drop_null_fields(F.col("v"))).first()[0] == '{"b":[{"c":1}]}'


def test_turn_prefixes(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y"])], "k int, c array<string>, g array<string>")
    rows = S.expand_turn_prefixes(df, "c", "g").orderBy("turn").collect()
    assert [[tuple(m) for m in r.prompt] for r in rows] == [
        [("user", "a")], [("user", "a"), ("assistant", "x"), ("user", "b")],
    ]


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_running_total(spark, span):
    rows = [(k, t, k + t) for k in range(3) for t in range(20)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r.k, r.t): r.s for r in U.running_total(df, "k", "t", F.col("v"), "s", span).collect()}
    assert got == {(k, t): sum(k + u for u in range(t + 1)) for k, t, _ in rows}


def test_running_total_of_repeated_positions(spark):
    rows = [("big", i // 100, i, 1) for i in range(1000)] + [("small", 0, i, 1) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int")
    out = U.running_total(df, "k", "t", F.col("v"), "s", span=3, buckets=4).collect()
    assert sorted(r.s for r in out if r.k == "big") == list(range(1, 1001))
    assert all(100 * r.t < r.s <= 100 * (r.t + 1) for r in out if r.k == "big")
    assert sorted(r.s for r in out if r.k == "small") == list(range(1, 10))


def test_leading_turns(spark):
    rows = [(n, t % (n - 1) if n == 9 else t, f"{t:04}", 5) for n in (1, 9, 12, 1000) for t in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, x string, n int")
    got = Counter(r.k for r in U.leading_turns(df, "k", ["t", "x"], F.col("n"), 52, least=4).collect())
    assert got == {1: 1, 9: 9, 12: 11, 1000: 11}
    starts = [r.start for r in U.leading_turns(df, "k", ["t", "x"], F.col("n"), 52).where("k = 1000").orderBy("t").collect()]
    assert starts == list(range(0, 55, 5))


def test_replay(spark):
    rows = [(k, t, 10, 5, f"g{t}") for k, n in ((1, 5), (2, 1), (3, 1000)) for t in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, u int, n int, g string")
    for least in (1, 15):
        out = U.replay_turns(df, "k", ["t"], F.col("u"), F.col("n"), "g", max_length=41, prompt_overhead=1, least=least)
        got = [(r.k, r.t, r.prompt_length, r.g) for r in out.orderBy("k", "t").collect()]
        first = [(0, 11, "g0"), (1, 26, "g1"), (2, 41, U.OVERLONG)]
        assert got == [(1, *x) for x in first] + [(2, 0, 11, "g0")] + [(3, *x) for x in first]


def test_replay_has_no_join_and_one_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 0, id) as k", "id as t", "'g' as g")
    out = U.replay_turns(df, "k", ["t"], F.lit(10), F.lit(5), "g", max_length=100, least=15)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan
    assert Counter(r.k for r in out.collect())[0] == 7


def test_pop_last_turn(spark):
    rows = [(n, t, f"r{t % 2}", f"t{t}") for n in (1, 9, 12, 1000) for t in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, role string, text string")
    prompts, labels = U.pop_last_turn(df, "k", ["t", "role", "text"])
    assert {(r.k, r.text) for r in labels.collect()} == {(n, f"t{n - 1}") for n in (1, 9, 12, 1000)}
    assert Counter(r.k for r in prompts.collect()) == {9: 8, 12: 11, 1000: 999}


def test_token_rows_of_long_conversations(spark, tmp_path):
    rows = [(n, t, "user", f"a{t} b") for n in (1, 9, 12, 1000) for t in range(n)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    size = {r.conv_id: r.n for r in X.token_rows(spark, str(tmp_path), 58).selectExpr("conv_id", "size(ids) as n").collect()}
    assert size == {1: 5, 9: 45, 12: 58, 1000: 58}
    whole = {r.conv_id: r.ids for r in X.token_rows(spark, str(tmp_path), 6000).collect()}
    ends = {r.conv_id: r.ids for r in X.token_rows(spark, str(tmp_path), 58, "keep_end").collect()}
    assert {k: v[-58:] for k, v in whole.items()} == ends and len(whole[1000]) == 5000


def test_reports(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, None), ("b", 0.5, 1.0)], "g string, x double, y double")
    got = {(r.g, r.reward): (r.coverage, r.mean) for r in P.reward_metrics(df, ["x", "y"], ["g"]).collect()}
    assert got == {("a", "x"): (0.5, 1.0), ("a", "y"): (0.0, None), ("b", "x"): (1.0, 0.5), ("b", "y"): (1.0, 1.0)}
    assert P.reward_metrics(df.where("g = 'z'"), ["x"]).count() == 0
    names = [r.name for r in P.metric_lines(P.reward_metrics(df, ["y"])).collect()]
    assert names == ["y/coverage", "y/mean"]


def test_stream_grouped_report(spark, sf, tmp_path):
    """The report over a stream equals the batch one."""
    schema = "conv_id bigint, turn bigint, role string, text string"
    shape = lambda d: d.withColumn("x", F.length("text").cast("double"))
    rows = L.shaped_stream(spark, [A.FileSpec(f"{sf}/conversations.parquet", "parquet")], schema, shape)
    batch = shape(spark.read.parquet(f"{sf}/conversations.parquet"))
    key = lambda m: sorted(tuple(r) for r in P.reward_metrics(m, ["x"], ["role"]).collect())
    assert key(rows) == key(batch)
