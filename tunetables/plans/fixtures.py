"""Inputs of the registered queries, derived from the given tables.

Each text is one SQL statement that runs unchanged on Spark and DuckDB. None of
them groups rows into lists; conversations are joined only as far as a length limit.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.functions import tokens as K
from tunetables.operators import shape as S
from tunetables.operators.staging import spread
from tunetables.operators.turns import leading_turns

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

MATCH = """
with b as (
  select o_orderkey as k, o_orderkey % 7 as v,
    case when o_orderkey % 3 = 0 then 'choice' when o_orderkey % 3 = 1 then 'math' else 'rouge' end as category,
    case when o_orderkey % 3 = 0 then substr('ABCDE', cast(1 + o_orderkey % 5 as int), 1)
         else cast(o_orderkey % 97 as varchar(20)) end as solution
  from orders)
select k, category, solution,
  case v when 0 then concat('The answer is: ', solution)
         when 1 then concat('<think>step</think> ', chr(92), 'boxed{', solution, '}')
         when 2 then concat('<solution>', solution, '</solution>')
         when 3 then concat('### Start', chr(10), solution, chr(10), '### End')
         when 4 then concat('(', solution, ')')
         when 5 then 'The answer is Z9'
         else '' end as completion
from b
"""

CODE = """
select o_orderkey as k, case when o_orderkey % 5 = 4 then 'math' else 'code' end as category,
  case when o_orderkey % 4 = 0 then 'no block here'
       else concat('```python', chr(10), 'print(', cast(o_orderkey % 11 as varchar(20)), ')', chr(10), '```') end as completion,
  concat('```python', chr(10), 'print(', cast(o_orderkey % 13 as varchar(20)), ')', chr(10), '```') as solution
from orders
"""

EXECUTIONS = """
select distinct concat('print(', cast(o_orderkey % 13 as varchar(20)), ')') as snippet,
  case when o_orderkey % 13 = 7 then 'error' when o_orderkey % 13 = 9 then 'timeout' else 'success' end as status,
  cast(o_orderkey % 13 as varchar(20)) as stdout
from orders
"""

KV = """
select o_orderkey as k, 'single_kv' as category,
  concat('{"kv":{"id":"', cast(o_orderkey as varchar(20)), '","status":"', o_orderstatus, '","priority":"', o_orderpriority, '"}}') as solution,
  case o_orderkey % 6
    when 0 then concat('{"kv":{"id":"', cast(o_orderkey as varchar(20)), '","status":"', o_orderstatus, '","priority":"', o_orderpriority, '"}}<stop>')
    when 1 then concat('{"kv":{"id":"', cast(o_orderkey as varchar(20)), '","status":"', o_orderstatus, '"}}<stop>')
    when 2 then concat('{"kv":{"id":"', cast(o_orderkey as varchar(20)), '","status":"', o_orderstatus, '","priority":"', o_orderpriority, '"}}')
    when 3 then concat('{"tables":{"id":"', cast(o_orderkey as varchar(20)), '"}}<stop>')
    when 4 then concat('{"kv":{"id":"', cast(o_orderkey as varchar(20)), '","status":"', lower(o_orderstatus), '","priority":"', o_orderpriority, '"}}<stop> tail')
    else '{"kv":{"id":' end as completion
from orders
"""

# two table rows per line; the answer is exact, lacks a row, names a column
# otherwise, leaves a cell null, or repeats a row
TABLE = """
with b as (
  select l_orderkey as k, l_linenumber as line, l_partkey as p, l_suppkey as s, cast(l_quantity as int) as q,
    (l_orderkey + l_linenumber) % 5 as v from lineitem),
r as (
  select *, concat('{"part":"p', cast(p as varchar(20)), '","qty":', cast(q as varchar(20)), '}') as r1,
    concat('{"part":"s', cast(s as varchar(20)), '","qty":', cast(q + 100 as varchar(20)), '}') as r2 from b)
select k, line, p, s, q, v, 'table_kv' as category,
  concat('{"tables":{"0":{"rows":[', r1, ',', r2, ']}}}') as solution,
  concat('{"tables":{"0":{"rows":[', case v when 0 then concat(r1, ',', r2) when 1 then r1
      when 2 then concat('{"item":"p', cast(p as varchar(20)), '","qty":', cast(q as varchar(20)), '},', r2)
      when 3 then concat('{"part":"p', cast(p as varchar(20)), '","qty":null},', r2)
      else concat(r1, ',', r2, ',', r2) end, ']}}}<stop>') as completion
from r
"""

# two results per line; the answer is exact, repeats a target, leaves one out,
# holds an invalid item, or swaps the order
RESULTS = """
with b as (
  select l_orderkey as k, l_linenumber as line, l_partkey as p, l_suppkey as s,
    (l_orderkey + l_linenumber) % 5 as v from lineitem),
r as (
  select *, concat('{"target_id":"a","text":"part ', cast(p as varchar(20)), '"}') as r1,
    concat('{"target_id":2,"text":"supplier ', cast(s as varchar(20)), '"}') as r2 from b)
select k, line, p, s, v, 'results_kv' as category,
  concat('{"results":[', r1, ',', r2, ']}') as solution,
  concat('{"results":[', case v when 0 then concat(r1, ',', r2) when 1 then concat(r1, ',', r2, ',', r1)
      when 2 then r1 when 3 then concat(r1, ',{"target_id":true,"text":"x"},', r2)
      else concat(r2, ',', r1) end, ']}<stop>') as completion
from r
"""

BBOX = """
select p_partkey as k, 'bbox' as category, p_size as s,
  concat('{"grounding_status":"', case when p_partkey % 8 = 7 then 'not_found' else 'found' end,
         '","positive_occurrences":[{"page":1,"bbox":[', cast(p_size as varchar(20)), ',10,', cast(p_size + 100 as varchar(20)), ',60]}]}') as solution,
  concat('{"field_path":"a.b","grounding_status":"', case when p_partkey % 8 = 7 then 'missing' else 'found' end,
         '","evidence_occurrences":[', case when p_partkey % 8 = 7 then '' else concat('{"page":', cast(1 + p_partkey % 2 as varchar(20)), ',"bbox":[', cast(p_size + p_partkey % 40 as varchar(20)), ',10,', cast(p_size + 100 as varchar(20)), ',60]}') end, ']}') as completion
from part
"""

# a found box, and a box near it that must not be chosen; the answer slides from
# the one to the other
BBOX_HARD = """
with b as (select p_partkey as k, p_size as s, p_size + p_partkey % 16 * 9 as x from part),
t as (select *, cast(s as varchar(20)) as a1, cast(s + 100 as varchar(20)) as a2, cast(s + 150 as varchar(20)) as h1, cast(s + 250 as varchar(20)) as h2,
  cast(x as varchar(20)) as x1, cast(x + 100 as varchar(20)) as x2 from b)
select k, 'bbox' as category,
  concat('{"grounding_status":"found","positive_occurrences":[{"page":1,"bbox":[', a1, ',10,', a2, ',60]}],',
    '"hard_negative_evidence":[{"page":', case when k % 5 = 0 then '2' else '1' end, ',"bbox":[', h1, ',10,', h2, ',60]}]}') as solution,
  concat('{"field_path":"a.b","grounding_status":"found","evidence_occurrences":[{"page":1,"bbox":[', x1, ',10,', x2, ',60]}]}') as completion
from t
"""

# two targets per line: t1 with two gold ids, t2 with one
EVIDENCE = """
with b as (
  select l_orderkey as k, l_linenumber as line, l_partkey % 10 as a, l_suppkey % 10 as c,
    (l_orderkey + l_linenumber) % 6 as v from lineitem)
select k, line, a, c, v, 'doc_evidence' as category,
  concat('{"grounding":[{"target_id":"t1","selected_ids":[', cast(a as varchar(20)), ',', cast(a + 10 as varchar(20)),
    ']},{"target_id":"t2","selected_ids":[', cast(c as varchar(20)), ']}]}') as solution,
  case v
    when 0 then concat('{"grounding":{"t1":[', cast(a + 10 as varchar(20)), ',', cast(a as varchar(20)), '],"t2":"', cast(c as varchar(20)), '"}}')
    when 1 then concat('{"grounding":[{"target_id":"t1","selected_ids":[', cast(a as varchar(20)), ']}]}')
    when 2 then concat('{"grounding":{"t1":[', cast(a as varchar(20)), ',', cast(c + 20 as varchar(20)), '],"t2":[', cast(c as varchar(20)), '],"t3":[1]}}')
    when 3 then concat('{"grounding":{"t1":[', cast(a as varchar(20)), ',', cast(a as varchar(20)), '],"t2":[', cast(c as varchar(20)), ']}}')
    when 4 then '{"other":1}'
    else 'no json' end as completion
from b
"""

SELECTION = """
select l_orderkey as k, concat('t', cast(l_linenumber as varchar(20))) as target_id,
  l_partkey % 10 as gold_id, case when l_quantity > 25 then l_partkey % 10 else l_suppkey % 10 end as pred_id
from lineitem
"""

# the same with up to three ids on a target
SELECTION_GROUPED = """
select l_orderkey as k, concat('t', cast(l_linenumber % 3 as varchar(20))) as target_id,
  l_partkey % 10 as gold_id, case when l_quantity > 25 then l_partkey % 10 else l_suppkey % 10 end as pred_id
from lineitem
"""

# one expression per line over three numbers and a 2; the answer comes to the
# target, misses it, is a fraction, leaves a number out, or begins with a bracket,
# which is trimmed
EQUATION = """
with b as (
  select l_orderkey as k, l_linenumber as line, cast(l_quantity as int) as a, cast(l_linenumber as int) as b, cast(1 + l_suppkey % 9 as int) as c,
    (l_orderkey + l_linenumber) % 7 as v from lineitem),
t as (select *, cast(a as varchar(20)) as x, cast(b as varchar(20)) as y, cast(c as varchar(20)) as z from b)
select k, line, a, b, c, 'equation' as category,
  case v when 0 then concat('2*(', x, '+', y, ')*', z) when 1 then concat(x, '*(', y, '-', z, ')+2') when 2 then concat('2*((', x, '+', y, '))/', z)
    when 3 then concat('2*(', z, '**', y, ')-', x) when 4 then concat(x, '+', y, '*2') when 5 then concat('the answer is: ', x, ' - ', y, ' * ', z, '/2')
    else concat('(', x, '+', y, ')*', z, '*2') end as completion,
  case v when 1 then a * (b - c) + 2 + line % 2 when 2 then 2 * (a + b) when 3 then 2 * cast(power(c, b) as bigint) - a when 4 then a + b * 2
    when 5 then a - cast(floor(b * c / 2.0) as bigint) else 2 * (a + b) * c end as target
from t
"""

FEEDBACK = """
select d.doc_id as k, d.source as input, d.text as response, l.quality as label
from documents d left join labels l on d.doc_id = l.doc_id
"""

TAGGED = """
select conv_id as k, turn,
  case turn % 4 when 0 then concat('<think>', role, '</think><answer>', role, '</answer>')
    when 1 then concat('<think>a<think>', role, '</think>')
    when 2 then concat('<answer>', role) else role end as completion
from conversations
"""

IMAGE = """
select page_id as k, url, case page_id % 5 when 0 then url when 1 then concat('img/', cast(page_id as varchar(20)), '.png')
  when 2 then concat('/abs/', cast(page_id as varchar(20)), '.TIFF') when 3 then 'data:image/png;base64,aGVsbG8=' else 'aGVsbG8=' end as image,
  100 + page_id * 37 % 4000 as width, 100 + page_id * 53 % 3000 as height
from pages
"""

ROUGE = """
select d.doc_id as k, 'rouge' as category, d.text as completion, b.text as solution
from documents d join benchmark b on b.item_id = d.doc_id % (select count(*) from benchmark)
"""

# short texts against short texts, for rules that SQL can only step through
ROUGE_SHORT = """
select a.item_id as k, n.s, 'rouge' as category, a.text as completion, b.text as solution
from benchmark a join (select 1 as s union all select 2 union all select 3 union all select 4 union all select 5) n on true
join benchmark b on b.item_id = (a.item_id + n.s) % (select count(*) from benchmark)
"""

# preference pairs: the other answer is the language and source of the text
PREFERENCE = """
select doc_id as k, source as input, text as chosen, concat(lang, ': ', source) as rejected, n_chars from documents
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, sql: str, heavy: bool = False) -> DataFrame:
    """Run a fixture text over the tables it names; ``heavy`` work per row
    follows."""
    for name in TABLES:
        named = rf"\b(from|join) {name}\b"
        if re.search(named, sql):  # under names of their own: a user's views stay as they are
            table(spark, sf_dir, name).createOrReplaceTempView(f"tunetables_{name}")
            sql = re.sub(named, rf"\1 tunetables_{name}", sql)
    return spread(spark.sql(sql)) if heavy else spark.sql(sql)


#: tokens of a training row; a conversation beyond them is truncated
MAX_TOKENS = 2048
#: markers that stay words of their own when the text is split on spaces
WORD_MARKS = S.ChatMarkers(head="<|im_start|> {role} ", tail=" <|im_end|>")
#: words that the markers, the role and an empty text are
LEAST_WORDS = 4
TURN = ["turn", "role", "text"]


def turn_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, text, ids): word codes of each rendered turn."""
    text = S.render_turn(F.col("role"), F.col("text"), WORD_MARKS)
    return table(spark, sf_dir, "conversations").withColumn("ids", K.word_codes(text))


def token_rows(spark: SparkSession, sf_dir: str, max_length: int = MAX_TOKENS, mode: str = "keep_start") -> DataFrame:
    """(conv_id, ids): whole conversations, truncated to ``max_length``. Only the
    turns that reach into the kept end are collected."""
    last = mode == "keep_end"
    turns = turn_tokens(spark, sf_dir)
    order = [F.col(c).desc() if last else F.col(c) for c in TURN]
    kept = leading_turns(turns, "conv_id", order, F.size("ids"), max_length, LEAST_WORDS)
    fits = K.truncate_tokens(F.col("ids"), max_length, mode)
    place = F.negative("start") if last else F.col("start")
    listed = kept.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), fits.alias("ids")))).alias("turns"))
    ids = F.flatten(F.transform("turns", lambda t: t["ids"]))
    return listed.select("conv_id", K.truncate_tokens(ids, max_length, mode).alias("ids"))


#: the same in DuckDB, as the leading part of a WITH list
TOKENS_SQL = """
turns as (select *, list_transform(string_split('<|im_start|> ' || role || ' ' || text || ' <|im_end|>', ' '),
    lambda x: ('0x' || substr(md5(x), 1, 6))::INT) as ids from conversations),
toks as (select conv_id, flatten(list(ids order by turn, role, text)) as ids from turns group by conv_id)"""


def code_of(word: str) -> int:
    """Word code of a fixed word, as ``word_codes`` gives it."""
    return int(hashlib.md5(word.encode()).hexdigest()[:6], 16)


START = [code_of("<|im_start|>"), code_of("assistant")]
END = [code_of("<|im_end|>")]
