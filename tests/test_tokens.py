import random

import pytest
from pyspark.sql import functions as F

from tunetables.functions import images as G
from tunetables.functions import tokens as K
from tunetables.operators import batches as B


def one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def starts_of(ids, pattern):
    return [i for i in range(len(ids) - len(pattern) + 1) if ids[i : i + len(pattern)] == pattern]


def test_masks_against_loops(spark):
    rng = random.Random(3)
    start, end, rows = [1, 2], [3], []
    for i in range(200):
        ids = [rng.randint(1, 5) for _ in range(rng.randint(0, 25))]
        on = [int(rng.random() < 0.9) for _ in ids]
        labels, at, ends = [-100] * len(ids), 0, starts_of(ids, end)
        for s in starts_of(ids, start):
            while at < len(ends) and ends[at] <= s:
                at += 1
            stop = ends[at] if at < len(ends) else len(ids)
            at += 1
            for j in range(s + 2, stop):
                labels[j] = ids[j]
        labels = [x if a else -100 for x, a in zip(labels, on)]
        rows.append((i, ids, on, labels))
    df = spark.createDataFrame(rows, "i int, ids array<int>, attn array<int>, want array<int>")
    c = F.col
    df = df.withColumns({"s": K.find_pattern(c("ids"), start), "e": K.find_pattern(c("ids"), end)})
    df = df.withColumn("spans", K.response_spans(c("s"), c("e"), 2))
    df = df.withColumn("labels", K.label_mask(c("ids"), c("spans"), c("attn")))
    df = df.withColumn("report", K.label_mask_report(c("ids"), c("labels"), c("s"), c("e"), c("spans"), 20, c("attn")))
    for r in df.collect():
        assert r.s == starts_of(r.ids, start) and r.e == starts_of(r.ids, end)
        assert r.labels == r.want, r.ids
        assert r.report.prompt_label_leaks == r.report.target_label_mismatches == r.report.padding_label_leaks == 0
        assert r.report.assistant_label_tokens == sum(x != -100 for x in r.want)
        cut = bool(r.s) and not any(e > r.s[-1] for e in r.e) and sum(r.attn) >= 20
        assert r.report.truncated_assistant == cut


def test_overlapping_pattern(spark):
    got = one(spark, "a array<int>", ([7, 7, 7],), K.find_pattern(F.col("a"), [7, 7]), K.find_pattern(F.col("a"), [1] * 9))
    assert got[0] == [0, 1] and got[1] == []
    with pytest.raises(ValueError):
        K.find_pattern(F.col("a"), [])


def test_strict_mode(spark):
    report = F.struct(F.array(F.lit("bad.")).alias("errors"))
    with pytest.raises(Exception, match="bad"):
        spark.range(1).select(K.require_clean(report, F.lit(1))).collect()


def test_truncate_pad_unpad(spark):
    a = F.col("a")
    got = one(spark, "a array<int>", ([1, 2, 3],), K.truncate_tokens(a, 2), K.truncate_tokens(a, 2, "keep_end"), K.truncate_tokens(a, 9, "keep_end"),
              K.pad_fixed(a, 5, 0), K.pad_fixed(a, 2, 0), K.unpad(K.pad_fixed(a, 5, 0), F.array(*map(F.lit, [1, 1, 1, 0, 0]))))
    assert list(got) == [[1, 2], [2, 3], [1, 2, 3], [1, 2, 3, 0, 0], [1, 2], [1, 2, 3]]
    with pytest.raises(ValueError):
        K.truncate_tokens(a, 2, "middle")
    with pytest.raises(ValueError):
        K.round_up(a, 0)


def test_terminated(spark):
    rows = [([], False), ([1, 9], True), ([9, 1], False), ([5, 6], True), ([6], False)]
    df = spark.createDataFrame(rows, "ids array<int>, want boolean")
    t = K.is_terminated(F.col("ids"), [9], [[5, 6]])
    short = K.is_terminated(F.col("ids"), [9], [[5, 6]], infer_short=True, max_length=2)
    got = df.select("want", t.alias("t"), short.alias("s"), K.mask_truncated(F.col("ids"), t).alias("m")).collect()
    assert all(r.t == r.want for r in got)
    assert [r.s for r in got] == [True, True, False, True, True]
    assert [r.m for r in got] == [[], [1, 9], [0, 0], [5, 6], [0]]
    m = B.termination_metrics(df.where("want = false"), t, "ids").first()
    assert tuple(m) == (1.0, 0.0, 0.0, 0.0)


def test_batches(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.sequence(F.lit(1), (F.col("id") % 7 + 1).cast("int")).alias("input_ids"))
    df = df.withColumns({"labels": F.col("input_ids"), "attention_mask": F.transform("input_ids", lambda x: F.lit(1))})
    for order in (None, [F.size("input_ids"), "k"]):
        out = B.pad_batch(B.assign_batches(df, 8, "k", order), B.sequence_fills(99), multiple=4).collect()
        sizes = {}
        for r in out:
            sizes.setdefault(r.batch_id, []).append((len(r.input_ids), len(r.labels), len(r.attention_mask), sum(r.attention_mask)))
        assert sorted(map(len, sizes.values())) == [2] + [8] * 6
        for group in sizes.values():
            want = -(-max(n for *_, n in group) // 4) * 4
            assert {x[:3] for x in group} == {(want,) * 3}
    assert all(x == 99 for r in out for x in r.input_ids[sum(r.attention_mask):])


def test_images(spark):
    opt = G.ImageOptions(root="/r")
    table = [
        ("a.png", "path", "/r/a.png"), (" b/../c.JPG ", "path", "/r/c.JPG"), ("/x//y/./z", "path", "/x/y/z"), ("http://h/a.png", "url", "http://h/a.png"),
        ("data:image/png;base64,xx", "data", "data:image/png;base64,xx"), ("aGVsbG8=", "base64", "aGVsbG8="), ("", "base64", ""), ("../../up.gif", "path", "/up.gif"),
        (".png", "base64", ".png"), ("a\\b", "path", "/r/a\\b"), ("x base64,yy/z", "base64", "x base64,yy/z"), ("a.txt", "base64", "a.txt"),
    ]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(table)], "i int, v string, kind string, want string")
    got = df.select("*", G.image_kind(F.col("v")).alias("k"), G.classify_image(F.col("v"), opt).alias("c")).orderBy("i").collect()
    assert [(r.v, r.k, r.c) for r in got] == table
    strict = G.ImageOptions(root="/r", convert=False)
    with pytest.raises(Exception, match="unsupported image extension"):
        spark.createDataFrame([("a.tif",)], "v string").select(G.checked_image(F.col("v"), strict)).collect()
    sizes = spark.createDataFrame([(100, 50), (4000, 1), (1, 100000)], "w int, h int").select(G.target_size(F.col("w"), F.col("h"), 1000).alias("t")).collect()
    assert [tuple(r.t) for r in sizes] == [(44, 22), (2000, 1), (1, 10000)]
    assert spark.range(1).select(G.target_size(F.lit(10), F.lit(10), 100)).first()[0] is None


def test_nested_payload(spark):
    schema = "m array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>"
    df = spark.createDataFrame([([("user", [("image", None, "a.png"), ("text", "t", "b.png")]), ("user", [])],)], schema)
    clean = G.normalise_payload(F.col("m"), df.schema["m"].dataType, G.ImageOptions(root="/r"))
    df = df.withColumn("m", clean)
    r = df.select("m", G.collect_turn_images(F.col("m")).alias("i"), F.transform("m", lambda m: G.is_content_parts(m["content"])).alias("p")).first()
    assert r.m[0].content[0].image == "/r/a.png" and r.m[0].content[1].image == "b.png"
    assert r.i == ["/r/a.png"] and r.p == [True, False]
