"""Reading, mixing, splitting and shaping queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.operators import mixture as M
from tunetables.operators import shape as S
from tunetables.operators.staging import stage_path
from tunetables.operators.turns import leading_turns, pop_last_turn, replay_turns
from tunetables.plans import fixtures as X
from tunetables.plans.registry import query
from tunetables.sources import files as A
from tunetables.streaming.files import shaped_stream, step_rows

WEIGHTS = {"de": 0.1, "en": 0.4, "es": 0.2, "fr": 0.3}  # by source position
SEED = 11


def _said(messages: str, alias: str):
    """Messages as text: role=content, one after the other."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias(alias)


# ------------------------------------------------------------------ sources
@query("""
select c_custkey as id, c_name as name, c_acctbal as acctbal, c_mktsegment as segment, null::varchar as priority, 'parquet' as fmt from customer
union all select c_custkey, c_name, c_acctbal, c_mktsegment, null, 'csv' from customer
union all select o_orderkey, null, null, null, o_orderpriority, 'jsonl' from orders
union all select o_orderkey, null, null, null, o_orderpriority, 'tsv' from orders
union all select s_suppkey, s_name, s_acctbal, null, null, 'json' from supplier""")
def multi_format_union(spark: SparkSession, sf: str) -> DataFrame:
    """All five formats written out, read back and joined by column name."""
    t = lambda n: X.table(spark, sf, n)
    c = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")
    )
    o = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    s = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    specs = []
    for fmt, df in (("parquet", c), ("csv", c), ("jsonl", o), ("tsv", o), ("json", s)):
        path = stage_path(spark, f"union-{fmt}")
        df = df.withColumn("fmt", F.lit(fmt))
        if fmt == "json":
            A.write_results(df, path, "records")
        elif fmt == "jsonl":
            A.write_results(df, path, "lines")
        elif fmt == "parquet":
            df.write.parquet(path)
        else:
            df.write.options(sep="\t" if fmt == "tsv" else ",", header=True, quote='"', escape='"').csv(path)
        specs.append(A.FileSpec(path, fmt))
    out = A.read_files(spark, specs, "outer")
    return out.select(F.col("id").cast("bigint").alias("id"), "name", "acctbal", "segment", "priority", "fmt")


@query("""
select 'train' as split, 'weighted_resampled' as mode, 'parquet' as format, count(*) as rows, true as from_train_split, 'documents' as file from documents
union all select 'train', 'weighted_resampled', 'parquet', count(*), true, 'benchmark' from benchmark
union all select 'validation', 'sampled_from_train', null, null, true, null""")
def input_summary(spark: SparkSession, sf: str) -> DataFrame:
    specs = [A.FileSpec(f"{sf}/{n}.parquet", "parquet", w) for n, w in (("documents", 0.8), ("benchmark", 0.2))]
    s = A.input_summary(spark, specs, None, resampling=True)
    file = F.nullif(F.regexp_extract("path", r"([^/]*)\.parquet$", 1), F.lit(""))
    return s.select("split", "mode", "format", "rows", "from_train_split", file.alias("file"))


@query(f"""
select conv_id, turn, 'user=' || text as prompt from conversations""")
def stream_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt shape over a file stream, run to its end."""
    schema = "conv_id bigint, turn bigint, role string, text string"
    specs = [A.FileSpec(f"{sf}/conversations.parquet", "parquet")]
    rows = shaped_stream(spark, specs, schema, lambda df: S.to_prompt(df, "text", ["conv_id", "turn"]))
    return rows.select("conv_id", "turn", _said("prompt", "prompt"))


@query(f"""
select count(*)::bigint as rows, bool_and(prompt like 'user=%') as shaped from (select 'user=' || text as prompt from conversations limit {4 * 8 * 2})""")
def stream_step_limit(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that ends after four steps of eight rows on two workers."""
    schema = "conv_id bigint, turn bigint, role string, text string"
    specs = [A.FileSpec(f"{sf}/conversations.parquet", "parquet")]
    rows = shaped_stream(spark, specs, schema, lambda df: S.to_prompt(df, "text", ["conv_id", "turn"]), step_rows(4, 8, workers=2))
    said = rows.select(_said("prompt", "prompt"))
    return said.agg(F.count("*").alias("rows"), F.bool_and(F.col("prompt").startswith("user=")).alias("shaped"))


@query("""
select 'test' as split, doc_id as id, text, source from documents union all by name select 'test' as split, item_id as id, text, '_' as source from benchmark
union all by name select 'validation' as split, item_id as id, text, '-' as source from benchmark""")
def validation_and_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit validation files unweighted; test files with missing text filled."""
    bench, docs = A.FileSpec(f"{sf}/benchmark.parquet", "parquet"), A.FileSpec(f"{sf}/documents.parquet", "parquet")
    test = A.read_test(spark, [docs, bench]).select(F.lit("test").alias("split"), F.coalesce("doc_id", "item_id").alias("id"), "text", "source")
    val = A.read_validation(spark, [bench])
    return test.unionByName(val.select(F.lit("validation").alias("split"), F.col("item_id").alias("id"), "text", F.lit("-").alias("source")))


@query("""
select vec_id, label, round(list_dot_product(embedding::double[], embedding::double[]), 4) as square from embeddings""")
def item_table(spark: SparkSession, sf: str) -> DataFrame:
    items = A.read_items(spark, A.FileSpec(f"{sf}/embeddings.parquet", "parquet"), ["vec_id", "label", "embedding"])
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return items.select("vec_id", "label", F.round(square, 4).alias("square"))


# ----------------------------------------------------------------- sampling
def _counts_sql(target: str) -> str:
    weights = ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())
    return f"""
lens as (select w.lang, row_number() over (order by w.lang) - 1 as source_index, w.weight::double as weight,
    (select count(*) from documents d where d.lang = w.lang) as length
  from (values {weights}) w(lang, weight)),
sh as (select *, weight / sum(weight) over () as share from lens),
tg as (select *, {target} as target from sh),
rw as (select *, target * share as raw, floor(target * share)::bigint as whole from tg),
rk as (select *, target - sum(whole) over () as open, row_number() over (order by raw - whole desc, source_index) as place from rw),
counts as (select source_index, lang, weight, length, whole + case when place <= open then 1 else 0 end as n from rk)"""


TARGET_EXACT = "min(floor(length / share)) over ()::bigint"
TARGET_REPEAT = "sum(length) over ()::bigint"


def _sources(spark: SparkSession, sf: str) -> list[M.Source]:
    d = X.table(spark, sf, "documents")
    return [M.Source(d.where(F.col("lang") == lang), w) for lang, w in WEIGHTS.items()]


@query(f"""with {_counts_sql(TARGET_EXACT)} select source_index, weight, length, n::bigint as n from counts""")
def mixture_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = X.table(spark, sf, "documents")
    langs = F.create_map(*[F.lit(x) for i, k in enumerate(WEIGHTS) for x in (k, i)])
    weights = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    lengths = d.groupBy("lang").agg(F.count("*").alias("length")).select(
        langs[F.col("lang")].cast("bigint").alias("source_index"), weights[F.col("lang")].alias("weight"), "length"
    )
    return M.mixture_counts(lengths)


@query(f"""
with {_counts_sql(TARGET_EXACT)},
t as (select d.doc_id, d.lang, n, row_number() over (partition by d.lang order by md5(({SEED} + source_index) || ':' || d.doc_id), d.doc_id::varchar) as rn
  from documents d join counts c on c.lang = d.lang)
select doc_id, lang from t where rn <= n""")
def weighted_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return M.weighted_mixture(_sources(spark, sf), "doc_id", SEED).select("doc_id", "lang")


@query(f"""
with {_counts_sql(TARGET_REPEAT)},
t as (select d.doc_id, d.lang, row_number() over (partition by d.lang order by md5(({SEED} + source_index) || ':' || d.doc_id), d.doc_id::varchar) - 1 as idx
  from documents d join counts c on c.lang = d.lang),
dr as (select lang, length, ({SEED} + source_index) as seed, unnest(range(0, n::bigint)) as i from counts),
dx as (select lang, ('0x' || substr(md5(seed || ':' || i), 1, 15))::bigint % length as idx from dr)
select t.doc_id, t.lang from dx join t on t.lang = dx.lang and t.idx = dx.idx""")
def weighted_mixture_replacement(spark: SparkSession, sf: str) -> DataFrame:
    return M.weighted_mixture(_sources(spark, sf), "doc_id", SEED, replacement=True).select("doc_id", "lang")


_SPLIT = f"""
with t as (select *, row_number() over (order by md5('{SEED}:' || o_orderkey), o_orderkey::varchar) as rn from orders),
s as (select o_orderkey, case when rn <= ceil((select count(*) from orders) * 0.1::double) then 'val' else 'train' end as split from t)"""


@query(_SPLIT + "select o_orderkey, split from s")
def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    flagged = M.with_split_flag(X.table(spark, sf, "orders"), "o_orderkey", 0.1, SEED)
    return flagged.select("o_orderkey", F.when(F.col("is_val"), "val").otherwise("train").alias("split"))


@query(_SPLIT + "select count(*) as train_rows, count(*) filter (split = 'val') as shared from s")
def holdout_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Rows a loose split shares between its two sides."""
    flagged = M.with_split_flag(X.table(spark, sf, "orders"), "o_orderkey", 0.1, SEED)
    return flagged.agg(F.count("*").alias("train_rows"), F.count_if("is_val").alias("shared"))


@query(f"""
select doc_id, lang from documents order by md5('{SEED}:' || doc_id), doc_id::varchar limit 100""")
def sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    return M.sample_exact(X.table(spark, sf, "documents"), 100, "doc_id", SEED).select("doc_id", "lang")


@query(f"""
with k as (select l_orderkey, count(*) as n, md5('{SEED}:' || l_orderkey) || ':' || l_orderkey as t from lineitem group by l_orderkey),
c as (select *, sum(n) over (order by t) - n as before from k)
select l_orderkey, least(n, 5000 - before)::bigint as rows from c where before < 5000""")
def sample_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """An exact sample by a key that many rows share: whole keys, and part of one."""
    rows = M.sample_exact(X.table(spark, sf, "lineitem"), 5000, "l_orderkey", SEED)
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("rows"))


_LABELLED = "select d.doc_id, l.doc_id as labelled, d.source from documents d left join labels l on d.doc_id = l.doc_id"


@query(f"""
with x as ({_LABELLED}),
k as (select labelled, count(*) as n, md5('{SEED}:' || coalesce(labelled::varchar, '')) || ':' || coalesce(labelled::varchar, '') as t from x group by labelled),
c as (select *, sum(n) over (order by t) - n as before, (select count(*) from x) // 2 as wanted from k)
select labelled, least(n, wanted - before)::bigint as rows from c where before < wanted""")
def sample_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """An exact half of rows that mostly have no key."""
    x = X.frame(spark, sf, _LABELLED)
    rows = M.sample_exact(x, X.table(spark, sf, "documents").count() // 2, "labelled", SEED)
    return rows.groupBy("labelled").agg(F.count("*").alias("rows"))


@query("""
with t as (select doc_id, length(text) + length(lang) + length(source) + length(doc_id::varchar) + length(n_chars::varchar) as score,
  length(text) as sequence_length from documents)
select doc_id, score::bigint as score, sequence_length::bigint as sequence_length from t
order by score desc, sequence_length desc, doc_id desc limit 64""")
def largest_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = X.table(spark, sf, "documents")
    top = M.largest_rows(d, 16 * 4, M.payload_size(d), F.length("text"), "doc_id")
    return top.select("doc_id", F.col("score").cast("bigint").alias("score"), F.col("sequence_length").cast("bigint").alias("sequence_length"))


@query("""
with p as (select *, row_number() over (order by quality, doc_id) - 1 as idx from labels),
w as (select distinct d.doc_id as idx from documents d)
select p.doc_id, p.quality, p.toxic from p join w on w.idx = p.idx""")
def select_indices(spark: SparkSession, sf: str) -> DataFrame:
    """Labels in (quality, doc_id) order, at the positions named by document ids."""
    wanted = X.table(spark, sf, "documents").select(F.col("doc_id").alias("idx"))
    return M.select_indices(X.table(spark, sf, "labels"), ["quality", "doc_id"], wanted).select("doc_id", "quality", "toxic")


@query("""
with w as (select distinct lang, unnest(string_split(text, ' ')) as token from documents),
a as (select distinct token from w where lang <> 'en' and regexp_matches(token, '[à-ÿ]')
  and token not in (select token from w where lang = 'en')),
r as (select token, row_number() over (order by token) as rn, (select count(*) from a) as n from a)
select token from r where rn <= n // 128 * 128""")
def vocabulary_additions(spark: SparkSession, sf: str) -> DataFrame:
    words = X.table(spark, sf, "documents").select("lang", F.explode(F.split("text", " ", -1)).alias("token"))
    new, base = words.where("lang <> 'en'"), words.where("lang = 'en'")
    return M.vocabulary_additions(new, base, script=F.col("token").rlike("[à-ÿ]"))


@query("""
with w as (select distinct lang, unnest(string_split(text, ' ')) || case when doc_id % 3 = 0 then '한' when doc_id % 3 = 1 then 'ㄱ' else '' end as token
  from documents),
a as (select distinct token from w where lang = 'fr' and regexp_matches(token, '[가-힣ㄱ-ㅎㅏ-ㅣ]') and token not in (select token from w where lang = 'en')),
r as (select token, row_number() over (order by token) as rn, (select count(*) from a) as n from a)
select token from r where rn <= n // 128 * 128""")
def vocabulary_hangul(spark: SparkSession, sf: str) -> DataFrame:
    """Additions of the default script."""
    mark = F.when(F.col("doc_id") % 3 == 0, "한").when(F.col("doc_id") % 3 == 1, "ㄱ").otherwise("")
    words = X.table(spark, sf, "documents").select("lang", F.explode(F.split("text", " ", -1)).alias("word"), mark.alias("mark"))
    words = words.select("lang", F.concat("word", "mark").alias("token"))
    return M.vocabulary_additions(words.where("lang = 'fr'"), words.where("lang = 'en'"))


# ----------------------------------------------------------------- cleaning
@query(f"""
with fx as ({X.FEEDBACK})
select k, regexp_replace(input, '^\\s+|\\s+$', '', 'g') as input, coalesce(label::varchar, '_') as label, k::varchar as same,
  '{{"k":' || k || case when label is null then '' else ',"label":' || label end || '}}' as kept from fx""")
def fill_strip_project(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, X.FEEDBACK)
    df = df.withColumn("kept", S.drop_null_fields(F.struct("k", "label"))).drop("response")
    df = S.strip_column(df, "input").withColumn("same", F.col("k"))
    filled = S.fill_missing(df.drop("k"), stringify=True)
    return filled.withColumn("k", F.col("same").cast("bigint")).select("k", "input", "label", "same", "kept")


# ------------------------------------------------------------------ shaping
@query(f"""
with fx as ({X.FEEDBACK})
select k, 'user=' || input || '|assistant=' || regexp_replace(response, '^\\s+|\\s+$', '', 'g') as messages, 'on' as thinking from fx""")
def sft_messages(spark: SparkSession, sf: str) -> DataFrame:
    df = S.to_sft(X.frame(spark, sf, X.FEEDBACK).drop("label"), "input", "response")
    df = S.with_constant_struct(df, "chat_template_kwargs", {"thinking": "on"})
    return df.select("k", _said("messages", "messages"), F.col("chat_template_kwargs.thinking").alias("thinking"))


@query(f"""
with fx as ({X.PREFERENCE})
select k, 'user=' || input as prompt, 'assistant=' || chosen as chosen, 'assistant=' || rejected as rejected, n_chars from fx""")
def preference_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = S.standardise_columns(X.frame(spark, sf, X.PREFERENCE), {"chosen": "better", "rejected": "worse"})
    df = S.to_preference(df, "input", "better", "worse")
    return df.select("k", _said("prompt", "prompt"), _said("chosen", "chosen"), _said("rejected", "rejected"), "n_chars")


@query(f"""
with fx as ({X.FEEDBACK})
select k, 'user=' || input as prompt, 'assistant=' || response as completion, label from fx""")
def feedback_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = S.to_feedback(X.frame(spark, sf, X.FEEDBACK), "input", "response", "label")
    return df.select("k", _said("prompt", "prompt"), _said("completion", "completion"), "label")


@query(f"""
with fx as ({X.FEEDBACK}) select k, 'user=' || input || '|assistant=' || response as messages from fx""")
def teacher_messages(spark: SparkSession, sf: str) -> DataFrame:
    df = S.to_teacher_messages(X.frame(spark, sf, X.FEEDBACK), "input", "response")
    return S.keep_columns(df, ["k", "messages"]).select("k", _said("messages", "messages"))


@query(f"""
with fx as ({X.FEEDBACK}) select k, 'user=' || input as prompt, label from fx""")
def prompt_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = S.to_prompt(S.drop_inputs(X.frame(spark, sf, X.FEEDBACK), ["response"]), "input")
    return df.select("k", _said("prompt", "prompt"), "label")


@query("""
select conv_id, turn, role || '=' || text as said,
  row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as is_label from conversations""")
def test_label_pop(spark: SparkSession, sf: str) -> DataFrame:
    """The last turn of whole conversations is the label, the others the prompt."""
    prompts, labels = pop_last_turn(X.table(spark, sf, "conversations"), "conv_id", X.TURN)
    rows = prompts.withColumn("is_label", F.lit(False)).unionByName(labels.withColumn("is_label", F.lit(True)))
    return rows.select("conv_id", "turn", F.concat_ws("=", "role", "text").alias("said"), "is_label")


@query(f"""
with fx as ({X.FEEDBACK}) select k, 'user=' || input as prompt, regexp_replace(response, '^\\s+|\\s+$', '', 'g') as label from fx""")
def test_prompts(spark: SparkSession, sf: str) -> DataFrame:
    df = S.to_test_prompt(X.frame(spark, sf, X.FEEDBACK), "input", "response")
    return df.select("k", _said("prompt", "prompt"), "label")


_CHARS = 4000


@query(f"""
with pieces as (select *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as piece from conversations),
placed as (select *, sum(length(piece)) over (partition by conv_id order by turn, role, text) - length(piece) as start from pieces)
select conv_id, left(string_agg(piece, '' order by start), {_CHARS}) || '<|im_start|>assistant' || chr(10) as text
from placed where start < {_CHARS} group by conv_id""")
def render_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations rendered up to a length in characters."""
    turns = X.table(spark, sf, "conversations").withColumn("piece", S.render_turn(F.col("role"), F.col("text")))
    kept = leading_turns(turns, "conv_id", X.TURN, F.length("piece"), _CHARS, least=24)
    said = F.array_sort(F.collect_list(F.struct("start", F.left("piece", F.lit(_CHARS)).alias("piece"))))
    chats = kept.groupBy("conv_id").agg(said.alias("said"))
    text = F.left(F.array_join(F.transform("said", lambda x: x["piece"]), ""), F.lit(_CHARS))
    return chats.select("conv_id", F.concat(text, F.lit(S.generation_prompt())).alias("text"))


_LIMIT = 1500
_REPLAY_SQL = f"""
with t as (select *, length(text) + 20 as u, length(role) + 25 as g from conversations),
r as (select *, sum(u + g) over (partition by conv_id order by turn, role, text) - g + 22 as prompt_length from t),
s as (select *, lag(prompt_length) over (partition by conv_id order by turn, role, text) as before from r),
kept as (select * from s where before is null or before < {_LIMIT})"""


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    t = X.table(spark, sf, "conversations").withColumn("generation", F.col("role"))
    return replay_turns(
        t, "conv_id", X.TURN, F.length("text") + 20, F.length("role") + 25, "generation", _LIMIT, prompt_overhead=22, least=45
    )


@query(f"""{_REPLAY_SQL}
select conv_id, turn, prompt_length::bigint as prompt_length,
  case when prompt_length >= {_LIMIT} then 'MODEL_MAX_LENGTH_EXCEEDED' else role end as generation from kept""")
def overlong_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversations in long form, cut where the prompt stops fitting."""
    return _replayed(spark, sf).select("conv_id", "turn", F.col("prompt_length").cast("bigint").alias("prompt_length"), "generation")


@query(f"""{_REPLAY_SQL},
fits as (select *, row_number() over (partition by conv_id order by turn, role, text) - 1 as nth from kept where prompt_length < {_LIMIT}),
pairs as (select a.conv_id, a.nth, a.text, string_agg('user=' || b.text || '|assistant=' || b.role || '|', '' order by b.nth) as before
  from fits a left join fits b on a.conv_id = b.conv_id and b.nth < a.nth group by all)
select conv_id, nth as turn, coalesce(before, '') || 'user=' || text as prompt from pairs""")
def turn_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Every prompt that fits, spelled out: the limit on its length bounds the row."""
    fits = _replayed(spark, sf).where(F.col("prompt_length") < _LIMIT)
    said = F.array_sort(F.collect_list(F.struct("prompt_length", "text", "generation")))
    listed = fits.groupBy("conv_id").agg(said.alias("said")).select(
        "conv_id", F.transform("said", lambda m: m["text"]).alias("contents"), F.transform("said", lambda m: m["generation"]).alias("generations")
    )
    rows = S.expand_turn_prefixes(listed, "contents", "generations")
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), _said("prompt", "prompt"))
