"""Text, JSON and grounding scorers over derived completions; reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.config import CodeOptions, Extraction, MatchOptions, RougeOptions, SelectionOptions
from tunetables.functions import jsonx
from tunetables.functions import text as T
from tunetables.operators import bbox as B
from tunetables.operators import report as P
from tunetables.operators import rewards as R
from tunetables.operators.kv import score_kv, value_similarity
from tunetables.operators.selection import score_selection, selection_quality
from tunetables.operators.staging import spread
from tunetables.plans import fixtures as X
from tunetables.plans.registry import query, r6

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _strip(sql: str) -> str:
    return STRIP.format(sql)


def _extract_sql(c: str) -> str:
    """Answer extraction with default options, in DuckDB."""
    patterns = [
        r"(?s)###\s*Start\s*\n(.*?)\n?###\s*End",
        "(?si)<solution>(.*?)</solution>",
        "(?si)<answer>(.*?)</answer>",
        r"(?s)###\s*Start\s*\n(.*)$",
        "(?si)<solution>(.*)$",
        "(?si)<answer>(.*)$",
        r"(?si)</think>\s*(.*?)\s*(?:<|im_end|>|$)",
    ]
    cases = "\n".join(f"when regexp_matches({c}, '{p}') then " + _strip(f"regexp_extract({c}, '{p}', 1)") for p in patterns)
    return f"case {cases} else {c} end"


_SAID = _strip(r"string_split_regex(x, '(?i)answer\s*(?:is\s*:?|:)\s*')[-1]")
_CLEAN = (
    r"replace(regexp_replace(regexp_replace(regexp_replace(said, '^[\s:=\-()\[\]{}|>]+', ''), "
    r"'[\s:=\-()\[\]{}|<]+$', ''), '\\boxed\{([^{}]*)\}', '\1', 'g'), '\', '')"
)


def _normal(c: str) -> str:
    return _strip(rf"regexp_replace(lower({c}), '[\s.,;:!?''\"]+', ' ', 'g')")


def _choice(c: str) -> str:
    whole = rf"regexp_extract({c}, '^[\s:=\-(\[{{]*([A-Ea-e])[)\]}}\s.,;:!?]*$', 1)"
    return rf"upper(coalesce(nullif({whole}, ''), regexp_extract({c}, '\b([A-Ea-e])\b', 1)))"


def _number(c: str) -> str:
    n = rf"regexp_extract({c}, '-?\d+(?:\.\d+)?', 0)"
    return f"case when contains({n}, '.') or {n} = '' then {n} else cast(cast({n} as bigint) as varchar) end"


MATCH_SQL = f"""
with fx as ({X.MATCH}),
e as (select *, {_extract_sql("completion")} as x from fx),
s as (select *, {_SAID} as said from e),
c as (select *, {_strip(_CLEAN)} as clean from s),
scored as (select k, category, case when category not in ('math', 'choice') or solution = '' then null
  when said = solution or clean = solution or {_normal("clean")} = {_normal("solution")}
    or ({_choice("clean")} <> '' and {_choice("clean")} = {_choice("solution")})
    or ({_number("clean")} <> '' and {_number("clean")} = {_number("solution")}) then 1.0::double
  else -0.25::double end as match_reward from c)
"""

PENALTY = MatchOptions(incorrect_penalty=0.25)


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return R.score_match(X.frame(spark, sf, X.MATCH), PENALTY)


@query(MATCH_SQL + """
select category, 'match_reward' as reward, count(*) as rows, round(count(match_reward) / count(*), 6) as coverage,
  round(avg(match_reward), 6) as mean from scored group by category""")
def match_reward_by_category(spark: SparkSession, sf: str) -> DataFrame:
    m = P.reward_metrics(_matched(spark, sf), ["match_reward"], ["category"])
    return m.select("category", "reward", "rows", r6("coverage").alias("coverage"), r6("mean").alias("mean"))


@query(MATCH_SQL + "select k, match_reward from scored")
def match_reward(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).select("k", "match_reward")


@query(MATCH_SQL + "select k, match_reward from scored")
def match_reward_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The same over completions that are message arrays."""
    said = F.array(F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content")))
    df = X.frame(spark, sf, X.MATCH).withColumn("completion", said)
    scored = R.score_all(df, [R.build_reward("match", 1.0, opt=PENALTY), R.build_reward("think_format", 0.5)])
    return scored.select("k", F.col(f"`{PENALTY.name}`").alias("match_reward"))


@query(f"""
with fx as ({X.MATCH}), e as (select *, {_extract_sql("completion")} as x from fx),
s as (select *, {_SAID} as said from e)
select k, x as answer, said, {_strip(_CLEAN)} as clean, {_normal("x")} as normal, {_choice("solution")} as choice,
  {_number("said")} as number from s""")
def extract_answer(spark: SparkSession, sf: str) -> DataFrame:
    x = T.extract_answer(F.col("completion"))
    df = X.frame(spark, sf, X.MATCH).withColumn("answer", x).withColumn("said", T.split_on_keywords(F.col("answer")))
    return df.select(
        "k",
        "answer",
        "said",
        T.strip_wrappers(F.col("said")).alias("clean"),
        T.normalise_text(F.col("answer")).alias("normal"),
        T.extract_choice(F.col("solution")).alias("choice"),
        T.extract_number(F.col("said")).alias("number"),
    )


@query(f"""
with fx as (select conv_id, turn, '<|turn>model ' || chr(10) || '<|channel>thought ' || role || '<channel|>' ||
  '<|channel>final ' || text || '<turn|>' || role as g from conversations)
select conv_id, turn, {_strip("split_part(split_part(split_part(regexp_replace(regexp_replace(regexp_replace("
  + _strip("g") + r", '(?si)<\|channel>thought\b.*?<channel\|>', '', 'g'), '(?i)^\s*<\|turn>model\s*', ''), "
  + r"'(?i)^\s*<\|channel>[A-Za-z0-9_\-]+\s*', ''), '<turn|>', 1), '<eos>', 1), '<|tool_response|>', 1)")} as said
from fx""")
def normalise_channels(spark: SparkSession, sf: str) -> DataFrame:
    t = X.table(spark, sf, "conversations")
    g = F.concat(
        F.lit("<|turn>model \n<|channel>thought "), "role", F.lit("<channel|><|channel>final "), "text", F.lit("<turn|>"), "role"
    )
    return t.select("conv_id", "turn", T.normalise_gemma4(g).alias("said"))


@query(f"""
with fx as ({X.TAGGED})
select k, turn,
  case when len(string_split(completion, '<think>')) > 1 and contains(string_split(completion, '<think>')[-1], '</think>')
    then 1.0::double else 0.0::double end as think,
  case when len(string_split(completion, '<answer>')) > 1 and contains(string_split(completion, '<answer>')[-1], '</answer>')
    then 1.0::double else 0.0::double end as answer,
  regexp_extract(completion, '(?si)<answer>(.*?)</answer>', 1) as tagged
from fx""")
def format_rewards(spark: SparkSession, sf: str) -> DataFrame:
    ext, c = Extraction(is_answer_tag=True), F.col("completion")
    return X.frame(spark, sf, X.TAGGED).select(
        "k",
        "turn",
        R.think_format(c, ext).alias("think"),
        R.answer_format(c, ext).alias("answer"),
        T.extract_answer(c, ext).alias("tagged"),
    )


@query(f"""
with fx as ({X.CODE}), ex as ({X.EXECUTIONS}),
b as (select *, {_strip("regexp_extract(completion, '(?s)```python(.*?)```', 1)")} as a,
  {_strip("regexp_extract(solution, '(?s)```python(.*?)```', 1)")} as s from fx)
select b.k, case when category <> 'code' then null when coalesce(ea.status, '') <> 'success' then -0.5::double
  when coalesce(es.status, '') <> 'success' then null when ea.stdout = es.stdout then 1.0::double else 0.25::double end as code_reward
from b left join ex ea on ea.snippet = b.a left join ex es on es.snippet = b.s""")
def code_output_reward(spark: SparkSession, sf: str) -> DataFrame:
    opt = CodeOptions(wrong_output_penalty=0.25, non_executable_penalty=0.5)
    runs = X.frame(spark, sf, X.EXECUTIONS)
    return R.score_code(X.frame(spark, sf, X.CODE), runs, opt, output="code_reward").select("k", "code_reward")


def _rouge_sql(gram: str) -> str:
    """Shared n-grams, counted once per distinct one of the short side."""
    return f"""
with fx as ({X.ROUGE}),
w as (select k, regexp_extract_all(lower(completion), '[a-z0-9]+') as c, regexp_extract_all(lower(solution), '[a-z0-9]+') as s from fx),
g as (select k, {gram.format(t="c")} as a, {gram.format(t="s")} as b from w),
o as (select k, len(a) as na, len(b) as nb,
  coalesce(list_sum(list_transform(list_distinct(b), lambda x: least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))))), 0) as o from g)
select k, case when o = 0 then 0.0::double else round(2 * (o / na) * (o / nb) / (o / na + o / nb), 6) end as rouge from o"""


def _rouge(kind: str, stem: bool):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        scored = R.score_rouge(X.frame(spark, sf, X.ROUGE, heavy=True), RougeOptions(kind, stem), output="rouge")
        return scored.select("k", r6("rouge").alias("rouge"))

    return run


query(_rouge_sql("{t}"), "rouge1")(_rouge("1", False))
query(_rouge_sql("list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1])"), "rouge2")(_rouge("2", False))
# one row of the table of longest common subsequences per word of the completion
@query(f"""
with p as ({X.ROUGE_SHORT}),
w as (select k, s, regexp_extract_all(lower(completion), '[a-z0-9]+') as a, regexp_extract_all(lower(solution), '[a-z0-9]+') as b from p),
l as (select *, list_reduce(list_transform(a, lambda x: {{'x': x, 'm': [0]}}),
    lambda acc, e: {{'x': '', 'm': list_transform(range(1, len(b) + 2), lambda j: list_max(list_transform(range(1, j + 1),
      lambda i: case when i = 1 then 0 when b[i - 1] = e.x then acc.m[i - 1] + 1 else acc.m[i] end)))}},
    {{'x': '', 'm': list_transform(range(0, len(b) + 1), lambda i: 0)}}).m[len(b) + 1] as o from w)
select k, s, case when coalesce(o, 0) = 0 then 0.0::double else round(2 * (o / len(a)) * (o / len(b)) / (o / len(a) + o / len(b)), 6) end as rouge from l""")
def rouge_l_short(spark: SparkSession, sf: str) -> DataFrame:
    scored = R.score_rouge(X.frame(spark, sf, X.ROUGE_SHORT), RougeOptions("l", False), output="rouge")
    return scored.select("k", "s", r6("rouge").alias("rouge"))


query(None, "rouge1_stemmed")(_rouge("1", True))
query(None, "rouge_l")(_rouge("l", False))
query(None, "rouge_l_stemmed")(_rouge("l", True))


# the value is read off the text, for the forms that the texts have
_NUMBER = r"(\d+)"
_FORMS = [
    (rf"{_NUMBER}\*\({_NUMBER}\+{_NUMBER}\)\*{_NUMBER}", "p[1] * (p[2] + p[3]) * p[4]"),
    (rf"{_NUMBER}\*\({_NUMBER}-{_NUMBER}\)\+{_NUMBER}", "p[1] * (p[2] - p[3]) + p[4]"),
    (rf"{_NUMBER}\*\(\({_NUMBER}\+{_NUMBER}\)\)/{_NUMBER}", "p[1] * (p[2] + p[3]) / p[4]"),
    (rf"{_NUMBER}\*\({_NUMBER}\*\*{_NUMBER}\)-{_NUMBER}", "p[1] * power(p[2], p[3]) - p[4]"),
    (rf"{_NUMBER} - {_NUMBER} \* {_NUMBER}/{_NUMBER}", "p[1] - p[2] * p[3] / p[4]"),
]


@query(f"""
with fx as ({X.EQUATION}),
said as (select *, regexp_replace(regexp_replace(completion, '^the answer is: ', ''), '^[(]+', '') as e from fx),
n as (select *, list_transform(regexp_extract_all(e, '\\d+'), lambda d: d::double) as p from said),
v as (select *, case {" ".join(f"when regexp_full_match(e, '{form}') then {value}" for form, value in _FORMS)} end as value from n)
select k, line, completion, target::bigint as target,
  case when list_sort(p) = list_sort([a, b, c, 2]::double[]) and abs(value - target) < 1e-5 then 1.0::double else 0.0::double end as equation_reward from v""")
def equation_reward(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, X.EQUATION).withColumn("numbers", F.array("a", "b", "c", F.lit(2)))
    scored = R.score_equation(df)
    return scored.select("k", "line", "completion", F.col("target").cast("bigint").alias("target"), "equation_reward")


# ------------------------------------------------------------------- JSON
@query("""
select event_id, '/k' as path, 0::bigint as idx, json_extract_string(props, '$.k') as text, len(props) as length from events""")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    df = X.table(spark, sf, "events").select(
        "event_id",
        F.explode(jsonx.flatten(F.col("props"))).alias("leaf"),
        jsonx.canonical_length(F.col("props")).cast("bigint").alias("length"),
    )
    return df.select(
        "event_id",
        F.replace("leaf.path", F.lit(jsonx.SEP), F.lit("/")).alias("path"),
        F.col("leaf.idx").cast("bigint").alias("idx"),
        F.col("leaf.text").alias("text"),
        "length",
    )


@query(f"""
with fx as ({X.TABLE}),
r as (select k, line, solution, unnest(range(json_array_length(solution, '$.tables."0".rows')::bigint))::int as idx from fx),
c as (select k, line, idx, json_extract(solution, '$.tables."0".rows[' || idx || ']') as row from r),
f as (select *, unnest(json_keys(row)) as name from c)
select k, line, idx, '/0/' || name as path, json_extract_string(row, '$."' || name || '"') as text from f""")
def json_flatten_tables(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, X.TABLE, heavy=True)
    tables = F.get_json_object("solution", "$.tables")
    df = df.select("k", "line", F.explode(jsonx.flatten(tables, "tables")).alias("leaf"))
    return df.select(
        "k",
        "line",
        F.col("leaf.idx").alias("idx"),
        F.replace("leaf.path", F.lit(jsonx.SEP), F.lit("/")).alias("path"),
        F.col("leaf.text").alias("text"),
    )


@query(f"""
with fx as ({X.KV}), s as (select k, completion, strpos(completion, '<stop>') as pos from fx)
select k, case when pos > 0 then substr(completion, 1, pos - 1) end as doc,
  case when pos > 0 then {_strip("substr(completion, pos + 6)")} end as trailing,
  case when k % 6 = 2 then completion end as whole,
  case when k % 6 = 5 then null when pos > 0 then substr(completion, 1, pos - 1) else completion end as lenient from s""")
def split_stop(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, X.KV, heavy=True)
    c = F.col("completion")
    compact = lambda x: F.replace(F.replace(x, F.lit(": "), F.lit(":")), F.lit(", "), F.lit(","))
    cut = jsonx.split_stop(c, "<stop>")
    df = df.select(
        "k", cut.alias("cut"), jsonx.parse_json_strict(c).alias("whole"), jsonx.parse_json_lenient(c).alias("lenient")
    )
    return df.select(
        "k", "cut.json", "cut.trailing", compact(F.col("whole")).alias("whole"), compact(F.col("lenient")).alias("lenient")
    ).withColumnRenamed("json", "doc")


@query(f"""
with fx as ({X.KV})
select k, 'kv' as solution_root, case when starts_with(completion, '{{"kv":{{') and ends_with(split_part(completion, '<stop>', 1), '}}}}')
  then 'kv' when starts_with(completion, '{{"tables":{{') then 'tables' end as root, starts_with(completion, '{{"kv"') and ends_with(completion, '}}}}') as whole from fx""")
def json_roots(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, X.KV, heavy=True)
    c = F.col("completion")
    return df.select(
        "k",
        jsonx.root_of(F.col("solution"), "<stop>").alias("solution_root"),
        jsonx.root_of(c, "<stop>").alias("root"),
        jsonx.alias_value(c, ["none", "kv"]).isNotNull().alias("whole"),
    )


@query(f"""
with fx as ({X.RESULTS}),
d as (select *, split_part(completion, '<stop>', 1) as doc, row_number() over () as row_id from fx),
e as (select *, unnest(range(json_array_length(doc, '$.results')::bigint)) as i from d),
t as (select *, json_extract(doc, '$.results[' || i || ']') as item from e),
u as (select *, json_type(item, '$.target_id') in ('VARCHAR', 'BIGINT', 'UBIGINT') and json_type(item, '$.text') = 'VARCHAR' as valid,
  json_extract_string(item, '$.target_id') as target, json_extract_string(item, '$.text') as text from t)
select k, line, p, s, (count(distinct target) filter (valid))::int as n, (count(*) filter (not valid))::int as invalid,
  (count(*) filter (valid) - count(distinct target) filter (valid))::int as repeats,
  arg_min(target || '=' || text, i) filter (valid) as first from u group by row_id, k, line, p, s""")
def results_items(spark: SparkSession, sf: str) -> DataFrame:
    listed = F.get_json_object(F.split("completion", "<stop>")[0], "$.results")
    df = X.frame(spark, sf, X.RESULTS, heavy=True).withColumn("r", jsonx.results_facts(listed))
    first = F.get("r.items", F.lit(0))
    return df.select(
        "k", "line", "p", "s", F.size("r.items").alias("n"), "r.invalid", "r.repeats", F.concat_ws("=", first["target_id"], first["text"]).alias("first")
    )


@query(f"""
with fx as ({X.KV}),
j as (select k, k % 6 as v, solution, completion, case when k % 6 = 5 then null else split_part(completion, '<stop>', 1) end as doc from fx),
p as (select *, [json_extract_string(solution, '$.kv.' || f) for f in ['id', 'status', 'priority']] as g,
  [json_extract_string(doc, '$.kv.' || f) for f in ['id', 'status', 'priority']] as a from j),
q as (select *, len([x for x in a if x is not null]) as na,
  list_sum([case when a[i] = g[i] then 1.0 when lower(a[i]) = lower(g[i]) then 0.5 else 0.0 end for i in [1, 2, 3]]) as m from p)
select k, case when doc is null then 0.0::double when na = 0 then 0.0::double
  else round(least(2 * m / (na + 3), case when (3 - na) / 3.0 > 0.2 then 0.6 else 1.0 end,
    case when not contains(completion, '<stop>') then 0.6 when split_part(completion, '<stop>', 2) <> '' then 0.2 else 1.0 end), 6)::double
  end as kv_reward from q""")
def kv_reward(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_kv(X.frame(spark, sf, X.KV, heavy=True))
    return scored.select("k", r6("kv_reward").alias("kv_reward"))


# exact, a row missing, a column named otherwise, a null cell, a row repeated;
# hits by row and by cell out of n answer leaves and four solution leaves
@query(f"""
with fx as ({X.TABLE}),
m as (select *, [4, 2, 4, 3, 4][v + 1] as rows_hit, [4, 2, 3, 3, 4][v + 1] as cells_hit, [4, 2, 6, 4, 6][v + 1] as n,
  [1.0, 0.6, 0.5, 1.0, 0.6][v + 1] as cap from fx)
select k, line, p, round(least(0.4 * 2 * rows_hit / (n + 4) + 0.6 * 2 * cells_hit / (n + 4), cap), 6)::double as kv_reward from m""")
def kv_table_reward(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_kv(X.frame(spark, sf, X.TABLE, heavy=True))
    return scored.select("k", "line", "p", r6("kv_reward").alias("kv_reward"))


# two of two, two of two with a repeat, one of two, one invalid item, swapped
@query(f"""
with fx as ({X.RESULTS}),
p as (select *, case v when 2 then 1 else 2 end as n from fx)
select k, line, p, round(least(2.0 * n / (n + 2), case v when 1 then 0.6 when 2 then 0.6 when 3 then 0.2 else 1.0 end), 6)::double as kv_reward
from p""")
def kv_results_reward(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_kv(X.frame(spark, sf, X.RESULTS, heavy=True))
    return scored.select("k", "line", "p", r6("kv_reward").alias("kv_reward"))


@query("""
select c_custkey, case c_custkey % 4 when 0 then 1.0::double when 1 then 0.5::double when 2 then 0.5::double else 0.0::double end as similarity,
  c_custkey % 4 = 2 and true as punct from customer""")
def value_similarities(spark: SparkSession, sf: str) -> DataFrame:
    gold = F.concat(F.col("c_name"), F.lit(" 1,5"))
    pred = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat(gold, F.lit(" ")))
        .when(F.col("c_custkey") % 4 == 1, F.upper(gold))
        .when(F.col("c_custkey") % 4 == 2, F.concat("c_name", F.lit(" 1.5")))
        .otherwise(F.lit(""))
    )
    df = X.table(spark, sf, "customer").select("c_custkey", gold.alias("g"), pred.alias("p"))
    mismatch = T.numeric_punct_mismatch(F.col("p"), F.col("g"))
    return df.select("c_custkey", value_similarity(F.col("p"), F.col("g")).alias("similarity"), mismatch.alias("punct"))


@query(f"""
with c as (select doc_id, regexp_replace({_strip("text")}, '[“”"''`]', '', 'g') as t from documents),
d as (select doc_id, lower(trim(regexp_replace(t, '\\s+', ' ', 'g'), '.,;:!?()[]{{}}')) as clean from c)
select doc_id, clean, regexp_replace(clean, '[^\\p{{L}}\\p{{N}}_%]+', '', 'g') as coarse from d""")
def text_normal_forms(spark: SparkSession, sf: str) -> DataFrame:
    return spread(X.table(spark, sf, "documents")).select(
        "doc_id", jsonx.clean_text(F.col("text")).alias("clean"), jsonx.coarse_normalise(F.col("text")).alias("coarse")
    )


# a plain text, nested lists in either quotes, numbers, repeated items, an empty list
_TRUTH = """
select doc_id, case doc_id % 5 when 0 then source
  when 1 then concat('[', chr(39), lang, chr(39), ', [', chr(39), source, chr(39), ', ', chr(39), lang, chr(39), ']]')
  when 2 then concat('["', source, '", ', cast(n_chars as varchar(20)), ', [[', cast(doc_id as varchar(20)), '], "', lang, '"]]')
  when 3 then '[]' else concat('[', cast(doc_id % 7 as varchar(20)), ', ', cast(doc_id % 2 as varchar(20)), ', ', cast(doc_id % 7 as varchar(20)), ']') end as text
from documents
"""


@query(f"""
with fx as ({_TRUTH}),
w as (select doc_id, case when starts_with(text, '[') then list_distinct(regexp_extract_all(text, '[A-Za-z0-9]+')) else [text] end as c from fx)
select doc_id, coalesce(array_to_string(list_sort(c), '|'), '') as candidates, len(c)::int as n from w""")
def ground_truth_lists(spark: SparkSession, sf: str) -> DataFrame:
    df = X.frame(spark, sf, _TRUTH).select("doc_id", jsonx.string_list(F.col("text")).alias("c"))
    return df.select("doc_id", F.array_join(F.array_sort("c"), "|").alias("candidates"), F.size("c").alias("n"))


# -------------------------------------------------------------- grounding
@query(f"""
with fx as ({X.BBOX}),
b as (select k, k % 8 = 7 as absent, k % 2 = 0 as same_page, k % 40 as d, s from fx),
i as (select *, case when same_page then (100 - d) / 100.0 end as iou from b)
select k, case when absent then 1.0::double
  else round(least(1.0, greatest(0.0, 0.2 + case when same_page then 0.2 + 0.5 * iou + case when iou >= 0.5 then 0.3 else 0 end
    + case when iou >= 0.7 then 0.2 else 0 end + 0.1 else 0 end)), 6)::double end as bbox_reward from i""")
def bbox_reward(spark: SparkSession, sf: str) -> DataFrame:
    scored = B.score_bbox(X.frame(spark, sf, X.BBOX, heavy=True), output="bbox_reward")
    return scored.select("k", r6("bbox_reward").alias("bbox_reward"))


def _box_sql(a: str, b: str) -> str:
    """Intersection over union of two boxes of one page."""
    shared = " * ".join(f"greatest(0, least({a}[{hi}], {b}[{hi}]) - greatest({a}[{lo}], {b}[{lo}]))" for lo, hi in ((1, 3), (2, 4)))
    area = lambda c: f"({c}[3] - {c}[1]) * ({c}[4] - {c}[2])"
    return f"({shared}) / ({area(a)} + {area(b)} - {shared})"


@query(f"""
with fx as ({X.BBOX_HARD}),
j as (select k, json_extract(solution, '$.positive_occurrences[0].bbox')::double[] as g, json_extract(solution, '$.hard_negative_evidence[0].bbox')::double[] as h,
  json_extract(solution, '$.hard_negative_evidence[0].page')::int as hard_page, json_extract(completion, '$.evidence_occurrences[0].bbox')::double[] as p from fx),
i as (select *, {_box_sql("g", "p")} as iou, case when hard_page = 1 then {_box_sql("h", "p")} else 0 end as hard from j)
select k, round(least(1.0, greatest(0.0, 0.4 + 0.5 * iou + case when iou >= 0.5 then 0.3 else 0 end + case when iou >= 0.7 then 0.2 else 0 end
  + case when (p[1] + p[3]) / 2 between g[1] and g[3] then 0.1 else 0 end - case when hard >= 0.5 then 0.3 else 0 end)), 6)::double as bbox_reward from i""")
def bbox_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    scored = B.score_bbox(X.frame(spark, sf, X.BBOX_HARD), output="bbox_reward")
    return scored.select("k", r6("bbox_reward").alias("bbox_reward"))


# unit squares of two pages, shifted against each other by the line's numbers
_BOXES = """
select l_orderkey as k, l_linenumber as line, l_partkey % 60 as dx, l_suppkey % 60 as dy, 1 + l_linenumber % 2 as page from lineitem"""


@query(f"""
with fx as ({_BOXES}), o as (select *, greatest(0, 100 - dx) * greatest(0, 100 - dy) as shared from fx)
select k, line, dx, dy, round(shared / (20000 - shared), 6)::double as iou, 0.01::double as area, dx <= 50 and dy <= 50 as centred,
  page = 1 and shared / (20000 - shared) >= 0.5 as overlaps from o""")
def box_geometry(spark: SparkSession, sf: str) -> DataFrame:
    def box(x, y, page):
        sides = {"x1": x, "y1": y, "x2": x + 100, "y2": y + 100}
        return F.struct(page.cast("bigint").alias("page"), *[v.cast("double").alias(n) for n, v in sides.items()])

    df = X.frame(spark, sf, _BOXES)
    df = df.withColumns({"a": box(F.lit(0), F.lit(0), F.lit(1)), "b": box(F.col("dx"), F.col("dy"), F.col("page"))})
    a, b = F.col("a"), F.col("b")
    return df.select(
        "k", "line", "dx", "dy", r6(B.iou(a, b)).alias("iou"), B.area(b).alias("area"),
        (B.center_inside(b, a) & B.center_inside(a, b)).alias("centred"), B.overlaps(F.array(a), F.array(b), 0.5).alias("overlaps"),
    )


@query(f"""
with fx as ({X.EVIDENCE}),
q as (select *, case v when 0 then 1.0 when 1 then (0.6 * 2.0 / 3) / 1.2 / 2
    when 2 then ((0.6 * 0.5 - 0.3) / 1.2 + 1) / 2 when 3 then 0.5 else 0.0 end as quality,
  case v when 3 then 0.1 else 0.2 end as base from fx)
select k, line, a, c, case when v = 5 then 0.0::double when v = 4 then 0.1::double
  else round(greatest(0.0, base + (1 - base) * quality - case when v = 2 then 0.3 else 0.0 end), 6)::double end as evidence_reward from q""")
def evidence_reward(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_selection(X.frame(spark, sf, X.EVIDENCE, heavy=True), output="evidence_reward")
    return scored.select("k", "line", "a", "c", r6("evidence_reward").alias("evidence_reward"))


@query(f"""
with fx as ({X.SELECTION}),
s as (select k, target_id, gold_id as id, 1 as g, 0 as p from fx union all select k, target_id, pred_id, 0, 1 from fx),
i as (select k, target_id, id, max(g) as g, sum(p) as p from s where id is not null group by all),
t as (select k, target_id, sum(g) as ng, count(*) filter (p > 0) as np, sum(case when p > 0 then g else 0 end) as nc, max(p) as most
  from i group by all),
q as (select k, case when most > 1 then 0.0 when nc = ng and nc = np then 1.0
  else least(1.0, greatest(0.0, (0.6 * 2.0 * nc / (np + ng) - case when np > nc then 0.3 else 0 end
    - case when np > ng then 0.2 else 0 end) / 1.2)) end as q from t)
select k, count(*) as targets, round(avg(q), 6) as quality from q group by k""")
def evidence_quality(spark: SparkSession, sf: str) -> DataFrame:
    q = selection_quality(X.frame(spark, sf, X.SELECTION), "k", "target_id", "gold_id", "pred_id")
    return q.select("k", "targets", r6("quality").alias("quality"))


_HARD = {"hard_target_min_gold_ids": 2, "hard_target_weight": 3.0}


def _quality_sql(total: str) -> str:
    return f"""
with fx as ({X.SELECTION_GROUPED}),
s as (select k, target_id, gold_id as id, 1 as g, 0 as p from fx union all select k, target_id, pred_id, 0, 1 from fx),
i as (select k, target_id, id, max(g) as g, sum(p) as p from s where id is not null group by all),
t as (select k, target_id, sum(g) as ng, count(*) filter (p > 0) as np, sum(case when p > 0 then g else 0 end) as nc, max(p) as most
  from i group by all),
q as (select k, case when ng >= {_HARD["hard_target_min_gold_ids"]} then {_HARD["hard_target_weight"]} else 1.0 end as w,
  case when most > 1 then 0.0 when nc = ng and nc = np then 1.0
  else least(1.0, greatest(0.0, (0.6 * 2.0 * nc / (np + ng) - case when np > nc then 0.3 else 0 end
    - case when np > ng then 0.2 else 0 end) / 1.2)) end as q from t)
select k, count(*) as targets, round({total}, 6) as quality from q group by k"""


def _quality(aggregation: str):
    opt = SelectionOptions(target_quality_aggregation=aggregation, **_HARD)

    def run(spark: SparkSession, sf: str) -> DataFrame:
        q = selection_quality(X.frame(spark, sf, X.SELECTION_GROUPED), "k", "target_id", "gold_id", "pred_id", opt)
        return q.select("k", "targets", r6("quality").alias("quality"))

    return run


query(_quality_sql("min(q)"), "evidence_quality_min")(_quality("min"))
query(_quality_sql("sum(q * w) / sum(w)"), "evidence_quality_hard_weighted")(_quality("hard_weighted_mean"))


# ---------------------------------------------------------------- reports
def _scored(spark: SparkSession, sf: str):
    names = [R.build_reward("match", 2.0, opt=PENALTY), R.build_reward("think_format", 0.5), R.build_reward("kv", 0.0)]
    return R.score_all(X.frame(spark, sf, X.MATCH), names), [r.name for r in R.active(names)]


_ALL_SQL = MATCH_SQL + """,
paired as (select s.k, s.category, fx.completion, 2.0 * s.match_reward as match_reward_neg0p25,
  case when contains(fx.completion, '<think>') then 0.5::double else 0.0::double end as think_format_reward
  from scored s join fx on fx.k = s.k)
"""


@query(_ALL_SQL + """, long as (
select category, 'match_reward_neg0p25' as reward, match_reward_neg0p25 as value from paired
union all select category, 'think_format_reward', think_format_reward from paired)
select category, reward || '/coverage' as name, round(count(value) / count(*), 6) as value from long group by category, reward
union all select category, reward || '/mean', round(avg(value), 6) from long group by category, reward having count(value) > 0""")
def reward_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored, names = _scored(spark, sf)
    lines = P.metric_lines(P.reward_metrics(scored, names, ["category"]), ["category"])
    return lines.select("category", "name", r6("value").alias("value"))


@query(_ALL_SQL + """
select k, 7 as step, category as prompt, completion, match_reward_neg0p25, think_format_reward,
  '{"k":' || k || ',"category":"' || category || '"}' as extra, 0.0::double as advantage from paired""")
def completion_log(spark: SparkSession, sf: str) -> DataFrame:
    scored, names = _scored(spark, sf)
    scored = scored.withColumns({"extra": F.struct("k", "category"), "advantage": F.lit(0.0)})
    return P.stringify_nested(P.completion_log(scored, "k", 7, names, prompt="category", extras=["extra"]))


@query(_ALL_SQL + "select k, match_reward_neg0p25, think_format_reward from paired")
def pivot_rewards(spark: SparkSession, sf: str) -> DataFrame:
    """Long score table and back: one column per reward again."""
    scored, names = _scored(spark, sf)
    return P.pivot_rewards(R.to_long(scored, ["k"], names), "k", names)
