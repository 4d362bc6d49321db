"""Token-array and image-reference queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.functions import images as G
from tunetables.functions import tokens as K
from tunetables.operators import batches as B
from tunetables.operators.turns import running_total
from tunetables.plans import fixtures as X
from tunetables.plans.registry import query, r6, text_of

MAX, FIXED, PAD, BATCH, SEED = X.MAX_TOKENS, 288, 0, 16, 5
KEY = ["conv_id"]

_JOIN = "list_aggregate({0}, 'string_agg', ' ')"


def _text(sql: str) -> str:
    return f"coalesce({_JOIN.format(sql)}, '')"


def _find(ids: str, pattern: list[int]) -> str:
    n = len(pattern)
    return f"list_filter(range(0, len({ids}) - {n - 1}), lambda i: {ids}[i + 1:i + {n}] = {pattern})"


_MASK_SQL = f"""
with {X.TOKENS_SQL},
cut as (select conv_id, ids[1:{MAX}] as ids from toks),
pat as (select *, {_find("ids", X.START)} as starts, {_find("ids", X.END)} as ends from cut),
sp as (select *, list_transform(starts, lambda s: {{'f': s + {len(X.START)},
    't': coalesce(list_min(list_filter(ends, lambda e: e > s)), {2**31})}}) as spans from pat),
lab as (select *, list_transform(range(0, len(ids)), lambda i: case when len(list_filter(spans, lambda s: i >= s.f and i < s.t)) > 0
    then ids[i + 1] else -100 end) as labels from sp)"""


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Truncated ids with pattern positions, spans and labels."""
    ids = F.col("ids")
    df = X.token_rows(spark, sf, MAX).withColumns({"starts": K.find_pattern(ids, X.START), "ends": K.find_pattern(ids, X.END)})
    df = df.withColumn("spans", K.response_spans(F.col("starts"), F.col("ends"), len(X.START)))
    return df.withColumn("labels", K.label_mask(ids, F.col("spans")))


@query(f"""with {X.TOKENS_SQL}
select conv_id, {_text("ids[1:64]")} as head, {_text("ids[greatest(len(ids) - 64, 0) + 1:]")} as tail from toks""")
def truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    head = X.token_rows(spark, sf, 64).select(*KEY, text_of("ids").alias("head"))
    return head.join(X.token_rows(spark, sf, 64, "keep_end").select(*KEY, text_of("ids").alias("tail")), KEY)


@query(f"""with {X.TOKENS_SQL},
placed as (select *, (sum(len(ids)) over (partition by conv_id order by turn, role, text) - len(ids))::bigint as before from turns),
pat as (select *, list_transform({_find("ids", X.START)}, lambda i: i + before) as starts, list_transform({_find("ids", X.END)}, lambda i: i + before) as ends from placed),
sp as (select *, list_transform(starts, lambda s: (s + {len(X.START)}) || '-' || coalesce(list_min(list_filter(ends, lambda e: e > s))::varchar, 'end')) as spans from pat)
select conv_id, turn, {_text("starts")} as starts, {_text("ends")} as ends, {_text("spans")} as spans from sp""")
def find_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """Positions within whole conversations: a pattern lies within one turn, whose
    own place is a running total."""
    ids = F.col("ids")
    df = X.turn_tokens(spark, sf).select("conv_id", "turn", "ids", F.size(ids).cast("bigint").alias("n"))
    df = running_total(df, "conv_id", "turn", F.col("n"), "upto").withColumn("before", F.col("upto") - F.col("n"))
    df = df.withColumns({"starts": K.find_pattern(ids, X.START), "ends": K.find_pattern(ids, X.END)})
    df = df.withColumn("spans", K.response_spans(F.col("starts"), F.col("ends"), len(X.START)))
    moved = lambda c: text_of(F.transform(c, lambda i: i + F.col("before")))
    place = lambda i: (i + F.col("before")).cast("string")
    spans = F.transform("spans", lambda s: F.concat_ws("-", place(s["from"]), F.coalesce(place(s["to"]), F.lit("end"))))
    return df.select("conv_id", "turn", moved("starts").alias("starts"), moved("ends").alias("ends"), text_of(spans).alias("spans"))


@query(f"""{_MASK_SQL} select conv_id, {_text("labels")} as labels from lab""")
def label_mask(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(spark, sf).select(*KEY, text_of("labels").alias("labels"))


# labels are spoilt on purpose in every third conversation, so that the audit has work
_SPOILT_SQL = f"""{_MASK_SQL},
bad as (select *, list_transform(range(0, len(ids)), lambda i: case when conv_id % 3 = 0 and i % 50 = 0 then 7 else labels[i + 1] end) as spoilt,
  list_transform(range(0, len(ids)), lambda i: case when i >= len(ids) - conv_id % 4 then 0 else 1 end) as attn from lab),
want as (select *, list_transform(range(0, len(ids)), lambda i: case when attn[i + 1] <> 0 and len(list_filter(spans, lambda s: i >= s.f and i < s.t)) > 0
    then 1 else 0 end) as want from bad),
n as (select conv_id, len(starts) as response_start_count, len(ends) as response_end_count,
    len(list_filter(spoilt, lambda x: x <> -100)) as active,
    len(list_filter(range(1, len(ids) + 1), lambda i: spoilt[i] <> -100 and want[i] = 0)) as leaks,
    len(list_filter(range(1, len(ids) + 1), lambda i: spoilt[i] <> -100 and attn[i] = 0)) as padded,
    len(list_filter(range(1, len(ids) + 1), lambda i: want[i] = 1 and spoilt[i] <> ids[i])) as wrong,
    len(starts) > 0 and len(list_filter(ends, lambda e: e > starts[len(starts)])) = 0
      and coalesce(list_sum(attn), 0) >= {MAX} - 3 as truncated from want),
rep as (select *, concat_ws('|',
    case when response_start_count = 0 then 'response_start_template was not found.' end,
    case when active < 1 then 'assistant label token count is below 1.' end,
    case when leaks > 0 then 'prompt label leak count=' || leaks || '.' end,
    case when padded > 0 then 'padding label leak count=' || padded || '.' end,
    case when wrong > 0 then 'target label mismatch count=' || wrong || '.' end) as errors from n)"""


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    df = _rows(spark, sf)
    spoil = lambda x, i: F.when((F.col("conv_id") % 3 == 0) & (i % 50 == 0), F.lit(7)).otherwise(x)
    on = lambda x, i: F.when(i >= F.size("ids") - F.col("conv_id") % 4, F.lit(0)).otherwise(F.lit(1))
    df = df.withColumns({"labels": F.transform("labels", spoil), "attention": F.transform("ids", on)})
    report = K.label_mask_report(
        F.col("ids"), F.col("labels"), F.col("starts"), F.col("ends"), F.col("spans"), MAX - 3, F.col("attention")
    )
    return df.withColumn("report", report)


@query(f"""{_SPOILT_SQL}
select conv_id, active as assistant_label_tokens, response_start_count, response_end_count, leaks as prompt_label_leaks,
  padded as padding_label_leaks, wrong as target_label_mismatches, truncated as truncated_assistant, errors from rep""")
def label_mask_report(spark: SparkSession, sf: str) -> DataFrame:
    df = _audited(spark, sf).select(*KEY, "report.*")
    counts = [c for c, t in df.dtypes if t == "int"]
    return df.withColumns({c: F.col(c).cast("bigint") for c in counts}).withColumn("errors", F.array_join("errors", "|"))


@query(f"""{_SPOILT_SQL}
select conv_id % 10 as source, count(*) as num_samples, sum(case when errors = '' then 0 else len(string_split(errors, '|')) end)::bigint as num_errors,
  count(*) filter (truncated) as truncated_assistant, sum(active)::bigint as assistant_label_tokens, sum(leaks)::bigint as prompt_label_leaks,
  sum(padded)::bigint as padding_label_leaks, sum(wrong)::bigint as target_label_mismatches from rep group by all""")
def label_mask_batch_report(spark: SparkSession, sf: str) -> DataFrame:
    df = _audited(spark, sf).withColumn("source", F.col("conv_id") % 10)
    return B.label_mask_batch_report(df, "report", ["source"])


@query(f"""{_SPOILT_SQL},
l as (select unnest(string_split(errors, '|')) as error from rep where errors <> '')
select error, count(*) as rows from l group by error""")
def label_mask_errors(spark: SparkSession, sf: str) -> DataFrame:
    return B.label_mask_errors(_audited(spark, sf), "report", [])


@query(f"""{_MASK_SQL},
ix as (select *, (row_number() over (order by md5('{SEED}:' || conv_id), conv_id) - 1) // {BATCH} as batch_id from lab),
ln as (select *, (max(len(ids)) over (partition by batch_id) + 7) // 8 * 8 as n from ix)
select conv_id, batch_id::bigint as batch_id, {_text(f"list_resize(ids, n, {PAD})")} as input_ids, {_text("list_resize(labels, n, -100)")} as labels,
  {_text("list_resize(list_transform(ids, lambda x: 1), n, 0)")} as attention_mask from ln""")
def pad_batches(spark: SparkSession, sf: str) -> DataFrame:
    df = _rows(spark, sf).select(*KEY, F.col("ids").alias("input_ids"), "labels")
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    df = B.assign_batches(df, BATCH, "conv_id", seed=SEED)
    df = B.pad_batch(df, B.sequence_fills(PAD), multiple=8)
    return df.select(*KEY, "batch_id", *[text_of(c).alias(c) for c in ("input_ids", "labels", "attention_mask")])


@query(f"""with {X.TOKENS_SQL},
ix as (select *, (row_number() over (order by len(ids), conv_id) - 1) // {BATCH} as batch_id from toks)
select conv_id, batch_id::bigint as batch_id, len(ids) as n from ix""")
def batches_by_length(spark: SparkSession, sf: str) -> DataFrame:
    df = X.turn_tokens(spark, sf).groupBy("conv_id").agg(F.sum(F.size("ids")).cast("bigint").alias("n"))
    return B.assign_batches(df, BATCH, "conv_id", order=["n", "conv_id"])


@query(f"""with {X.TOKENS_SQL}, cut as (select conv_id, ids[1:{FIXED}] as ids from toks)
select conv_id, {_text(f"list_resize(ids, {FIXED}, {PAD})")} as padded, {_text("ids")} as back from cut""")
def pad_fixed(spark: SparkSession, sf: str) -> DataFrame:
    df = X.token_rows(spark, sf, FIXED)
    mask = K.pad_fixed(F.transform("ids", lambda x: F.lit(1)), FIXED, 0)
    df = df.withColumns({"padded": K.pad_fixed(F.col("ids"), FIXED, PAD), "mask": mask})
    back = K.unpad(F.col("padded"), F.col("mask"))
    return df.select(*KEY, text_of("padded").alias("padded"), text_of(back).alias("back"))


# a completion is one turn's words; every fourth lacks the end mark, every fifth ends in another way
_LAST = [X.code_of("stop"), X.code_of("")]
SHORT = 40
_DONE_SQL = f"""with words as (select conv_id, turn, string_split(role || ' ' || text ||
    case when turn % 4 = 3 then '' when turn % 5 = 4 then ' stop ' else ' <|im_end|>' end, ' ') as w from conversations),
done as (select *, list_transform(w, lambda x: ('0x' || substr(md5(x), 1, 6))::INT) as ids from words),
ends as (select *, ids[len(ids)] = {X.END[0]} or ids[len(ids) - 1:] = {_LAST} as ended,
  list_transform(range(0, len(ids)), lambda i: (i % 2)::INT) as tools from done)"""


def _ended(spark: SparkSession, sf: str) -> DataFrame:
    tail = F.when(F.col("turn") % 4 == 3, "").when(F.col("turn") % 5 == 4, " stop ").otherwise(" <|im_end|>")
    said = F.concat("role", F.lit(" "), "text", tail)
    df = X.table(spark, sf, "conversations").select("conv_id", "turn", K.word_codes(said).alias("ids"))
    tools = F.transform("ids", lambda x, i: (i % 2).cast("int"))
    return df.withColumns({"tools": tools, "ended": K.is_terminated(F.col("ids"), X.END, [_LAST])})


@query(_DONE_SQL + f"""
select conv_id, turn, ended, case when ended then coalesce(list_sum(tools), 0)::bigint else 0 end as kept, ended or len(ids) < {SHORT} as short from ends""")
def terminated_rows(spark: SparkSession, sf: str) -> DataFrame:
    kept = F.aggregate(K.mask_truncated(F.col("tools"), F.col("ended")), F.lit(0), lambda a, x: a + x)
    short = K.is_terminated(F.col("ids"), X.END, [_LAST], infer_short=True, max_length=SHORT)
    return _ended(spark, sf).select("conv_id", "turn", "ended", kept.cast("bigint").alias("kept"), short.alias("short"))


@query(_DONE_SQL + """, n as (select conv_id % 10 as source, ended, coalesce(list_sum(tools), 0) as len from ends)
select source, round(avg(case when ended then 0.0 else 1.0 end), 6) as clipped_ratio, round(coalesce(avg(len) filter (ended), 0), 6) as mean_terminated_length,
  coalesce(min(len) filter (ended), 0)::double as min_terminated_length, coalesce(max(len) filter (ended), 0)::double as max_terminated_length
from n group by source""")
def termination_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = _ended(spark, sf).withColumn("source", F.col("conv_id") % 10)
    m = B.termination_metrics(df, F.col("ended"), "ids", "tools", ["source"])
    return m.select("source", *[r6(c).alias(c) for c in m.columns if c != "source"])


# -------------------------------------------------------------------- images
_ROOT = G.ImageOptions(root="/data/pics")


@query(f"""
with fx as ({X.IMAGE})
select k, ['url', 'path', 'path', 'data', 'base64'][k % 5 + 1] as kind,
  case k % 5 when 1 then '/data/pics/' || image else image end as source,
  k % 5 = 2 as unsupported from fx""")
def image_sources(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("image")
    source = G.classify_image(c, _ROOT)
    bad = (G.image_kind(c) == "path") & G.unsupported_extension(source, _ROOT)
    return X.frame(spark, sf, X.IMAGE).select("k", G.image_kind(c).alias("kind"), source.alias("source"), bad.alias("unsupported"))


@query(f"""
with fx as ({X.IMAGE}), t as (select k, width, height, width::double * height as n from fx)
select k, case when n > 500000 then greatest(1, floor(width * sqrt(500000 / n)))::bigint end as width,
  case when n > 500000 then greatest(1, floor(height * sqrt(500000 / n)))::bigint end as height from t""")
def image_target_size(spark: SparkSession, sf: str) -> DataFrame:
    to = G.target_size(F.col("width"), F.col("height"), 500_000)
    return X.frame(spark, sf, X.IMAGE).select("k", to.alias("t")).select("k", "t.width", "t.height")


@query(f"""
with fx as ({X.IMAGE}),
r as (select *, case k % 5 when 1 then '/data/pics/' || image else image end as source, k % 3 as n from fx)
select k, true as is_parts, n::int as n_images, case when n = 1 then source end as image,
  case when n = 2 then source || ' ' || '/data/pics/x/' || k || '.gif' end as images from r""")
def image_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Content parts with none, one or two images: normalised, collected, and
    packed as a prompt payload."""
    part = lambda kind, text, image: F.struct(kind.alias("type"), text.alias("text"), image.alias("image"))
    none = F.lit(None).cast("string")
    other = F.concat(F.lit("x/y/../"), F.col("k").cast("string"), F.lit(".gif"))
    parts = F.array(
        part(F.lit("text"), F.col("url"), none),
        part(F.when(F.col("k") % 3 >= 1, "image").otherwise("text"), none, F.col("image")),
        part(F.when(F.col("k") % 3 == 2, "image").otherwise("text"), none, other),
    )
    df = X.frame(spark, sf, X.IMAGE).withColumn("parts", parts)
    clean = G.normalise_payload(F.col("parts"), df.schema["parts"].dataType, _ROOT)
    df = df.select("k", G.is_content_parts(F.col("parts")).alias("is_parts"), G.collect_images(clean).alias("found"), "url")
    pay = G.prompt_payload(F.col("url"), F.col("found"))
    df = df.select("k", "is_parts", F.size("found").alias("n_images"), pay.alias("p"))
    return df.select("k", "is_parts", "n_images", "p.image", text_of("p.images").alias("images"))


@query(f"""
with fx as ({X.IMAGE})
select k, case when k % 4 = 0 then image when k % 5 = 1 then '/data/pics/' || image else image end as path, k % 4 = 0 as held from fx""")
def image_structs(spark: SparkSession, sf: str) -> DataFrame:
    """Images as (bytes, path) structs: the path is resolved unless there are bytes."""
    raw = F.when(F.col("k") % 4 == 0, F.lit("aGk=").cast("binary"))
    df = X.frame(spark, sf, X.IMAGE).withColumn("row", F.struct(F.struct(raw.alias("bytes"), F.col("image").alias("path")).alias("image")))
    clean = G.normalise_payload(F.col("row"), df.schema["row"].dataType, _ROOT)
    return df.select("k", clean["image"]["path"].alias("path"), clean["image"]["bytes"].isNotNull().alias("held"))
