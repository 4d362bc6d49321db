import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunetables.operators import batches as B
from tunetables.operators import mixture as M


def frame(spark, n, parts=3):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(parts)


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 600])
def test_sample_exact_counts(spark, n):
    got = M.sample_exact(frame(spark, 500), n, "k", 3).select("k").collect()
    assert len({r.k for r in got}) == len(got) == min(n, 500)


def test_sample_ignores_partitions(spark):
    runs = [{r.k for r in M.sample_exact(frame(spark, 300, p), 50, "k", 3).collect()} for p in (1, 4, 9)]
    assert runs[0] == runs[1] == runs[2]
    assert runs[0] != {r.k for r in M.sample_exact(frame(spark, 300), 50, "k", 4).collect()}


def test_sample_of_nothing(spark):
    assert M.sample_exact(frame(spark, 0), 5, "k", 1).count() == 0


def test_hash_index_is_dense(spark):
    got = sorted(r.idx for r in M.hash_index(frame(spark, 1000), "k", 1).collect())
    assert got == list(range(1000))


def test_ordered_index(spark):
    df = frame(spark, 500).withColumn("half", F.col("k") % 2)
    rows = sorted(M.ordered_index(df, F.desc("half"), "k").collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(500))
    assert [r.k for r in rows] == [*range(1, 500, 2), *range(0, 500, 2)]


@pytest.mark.parametrize("n", [1, 39, 50, 80, 99])
def test_sample_with_null_and_repeated_keys(spark, n):
    half = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    assert M.sample_exact(half, n, "k", 3).count() == n  # 50 null keys, rows equal in both columns
    few = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    got = [r.id for r in M.sample_exact(few, n, "k", 3).collect()]
    assert len(set(got)) == len(got) == n
    again = few.repartition(7)
    assert {r.id for r in M.sample_exact(again, n, "k", 3).collect()} == set(got)


def test_split_with_null_and_equal_keys(spark):
    df = spark.range(90).select(F.when(F.col("id") > 60, F.lit(None)).otherwise(F.lit("x")).alias("k"))
    for ratio, held in ((0.0, 0), (0.1, 9), (0.5, 45), (1.0, 90)):
        flagged = M.with_split_flag(df, "k", ratio, 1)
        assert flagged.count() == 90 and flagged.where("is_val").count() == held
    train, val = M.train_val_split(df, "k", 0.3, 1)
    assert (train.count(), val.count()) == (63, 27)


def test_index_and_batches_keep_rows_without_keys(spark):
    df = spark.range(100).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), "id")
    rows = M.hash_index(df, "k", 1).collect()
    assert sorted(r.idx for r in rows) == list(range(100)) and len({r.id for r in rows}) == 100
    assert B.assign_batches(df, 8, "k").groupBy("batch_id").count().where("count = 8").count() == 12
    assert M.sample_exact_with_replacement(df, 300, "k", 2).count() == 300


def test_replacement(spark):
    df = frame(spark, 20)
    got = M.sample_exact_with_replacement(df, 200, "k", 9)
    assert got.columns == df.columns
    keys = [r.k for r in got.collect()]
    assert len(keys) == 200 and len(set(keys)) > 10


def counts(spark, lengths, weights, **options):
    rows = [(i, float(w), n) for i, (n, w) in enumerate(zip(lengths, weights))]
    t = spark.createDataFrame(rows, "source_index int, weight double, length bigint")
    return [r.n for r in sorted(M.mixture_counts(t, **options).collect())]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(50, 400), st.integers(1, 9)), min_size=1, max_size=4), st.integers(40, 90))
def test_mixture_sums_to_target(spark, sources, target):
    lengths, weights = zip(*sources)
    got = counts(spark, lengths, weights, replacement=True, target_size=target)
    total = sum(weights)
    assert sum(got) == target
    assert all(abs(n - target * w / total) < 1 for n, w in zip(got, weights))


def test_mixture_default_targets(spark):
    assert counts(spark, [100, 30], [1, 1]) == [30, 30]
    assert sum(counts(spark, [100, 30], [1, 1], replacement=True)) == 130
    assert counts(spark, [10, 10, 10], [1, 1, 1], target_size=10) == [4, 3, 3]  # ties: lower index first


def test_mixture_errors(spark):
    for lengths, options in (([0, 5], {"replacement": True}), ([5, 5], {"target_size": 20}), ([5, 5], {"target_size": 1})):
        with pytest.raises(Exception):
            counts(spark, lengths, [1, 1], **options)
    with pytest.raises(ValueError):
        counts(spark, [5], [1], target_size=0)


def test_split(spark):
    df = frame(spark, 101)
    train, val = M.train_val_split(df, "k", 0.1, 5)
    a, b = {r.k for r in train.collect()}, {r.k for r in val.collect()}
    assert len(b) == 11 and not a & b and len(a | b) == 101
    loose, val2 = M.train_val_split(df, "k", 0.1, 5, strict=False)
    assert loose.count() == 101 and {r.k for r in val2.collect()} == b


def test_vocabulary(spark):
    new = spark.createDataFrame([(f"{chr(0xAC00 + i)}",) for i in range(300)] + [("abc",)], "token string")
    base = spark.createDataFrame([(chr(0xAC00),)], "token string")
    got = sorted(r.token for r in M.vocabulary_additions(new, base).collect())
    assert got == [chr(0xAC00 + i) for i in range(1, 257)]
    exact = M.vocabulary_additions(new.limit(300), base, multiple=13).count()
    assert exact == 299
    assert M.vocabulary_additions(new.limit(20), base).count() == 0


def test_select_and_largest(spark):
    df = frame(spark, 30)
    idx = spark.createDataFrame([(3,), (3,), (29,), (99,)], "idx int")
    assert sorted(r.k for r in M.select_indices(df, ["k"], idx).collect()) == [3, 29]
    nested = spark.createDataFrame(
        [(1, "ab", [1, 2], {"x": "yz"}, None), (2, None, [300], {}, ("q",))],
        "k int, s string, a array<int>, m map<string,string>, t struct<u:string>",
    )
    sizes = {r.k: r.z for r in nested.select("k", M.payload_size(nested).alias("z")).collect()}
    assert sizes == {1: 1 + 2 + 2 + 2, 2: 1 + 3 + 1}
    top = M.largest_rows(df, 2, F.length("v"), F.lit(0), "k").collect()
    assert [r.k for r in top] == [29, 28]


def test_weighted_mixture(spark):
    sources = [M.Source(frame(spark, 100), 3.0), M.Source(frame(spark, 100).withColumn("extra", F.lit(1)), 1.0)]
    out = M.weighted_mixture(sources, "k", 1, target_size=40)
    assert {r.extra: r.n for r in out.groupBy("extra").agg(F.count("*").alias("n")).collect()} == {None: 30, 1: 10}
    with pytest.raises(ValueError):
        M.weighted_mixture([M.Source(frame(spark, 5), 0.0)], "k", 1)


def test_equal_rows_split_and_number_exactly(spark):
    same = spark.range(9000, numPartitions=4).select(F.lit("k").alias("key"), F.lit(1).alias("v"))
    df = same.unionByName(spark.range(1000).select(F.col("id").cast("string").alias("key"), F.col("id").cast("int").alias("v")))
    flagged = M.with_split_flag(df, "key", 0.5, 3)
    plan = flagged._jdf.queryExecution().toString()
    assert "row_number" not in plan and flagged.where("is_val").count() == 5000 and flagged.count() == 10_000
    at = M.hash_index(df, "key", 3)
    assert sorted(r.idx for r in at.select("idx").collect()) == list(range(10_000))
