"""Queries over the leaves of JSON documents and over similar texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.operators.leaves import json_leaves
from tunetables.operators.matching import greedy_matches
from tunetables.operators.similar import similar_values
from tunetables.plans import fixtures as X
from tunetables.plans.registry import query

_NESTED_SQL = (
    """'{"conv":' || conv_id || ',"the turn":{"n":' || turn || ',"open":null,"sure":true},"lines":' || """
    """coalesce(to_json(string_split(text, chr(10)))::varchar, 'null') || ',"parts":[{"role":' || to_json([role])::varchar || ',"tags":[]},[[],[' || turn || """
    """']]],"none":{},"a":{"b":{"c":{"d":{"e":[' || turn || ',' || conv_id || ']}}}}}'"""
)


@query(f"""
with docs as (
  select 'event ' || event_id as doc, props as text from events
  union all select conv_id || ' ' || turn, {_NESTED_SQL} from conversations)
select doc, t.fullkey as place,
  case t.type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'ARRAY' then 'list' else 'number' end as kind,
  case t.type when 'NULL' then null when 'ARRAY' then '' else json_extract_string(t.value, '$') end as text
from docs, json_tree(docs.text) t where t.type <> 'OBJECT' and (t.type <> 'ARRAY' or t.value::varchar = '[]')""")
def json_document_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves of the events' properties and of documents made from conversations."""
    events = X.table(spark, sf, "events").select(F.concat(F.lit("event "), "event_id").alias("doc"), F.col("props").alias("text"))
    lines = F.coalesce(F.to_json(F.split("text", "\n")), F.lit("null"))
    nested = F.format_string(
        '{"conv":%d,"the turn":{"n":%d,"open":null,"sure":true},"lines":%s,"parts":[{"role":%s,"tags":[]},[[],[%d]]],"none":{},'
        '"a":{"b":{"c":{"d":{"e":[%d,%d]}}}}}',
        "conv_id", "turn", lines, F.to_json(F.array("role")), "turn", "turn", "conv_id",
    )
    made = X.table(spark, sf, "conversations").select(F.concat("conv_id", F.lit(" "), "turn").alias("doc"), nested.alias("text"))
    return json_leaves(events.unionByName(made), ["doc"]).select("doc", "place", "kind", "text")


@query()
def similar_part_names(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of different part names whose characters match to 0.8, with how often each occurs."""
    found = similar_values(X.table(spark, sf, "part"), "p_name", 0.8)
    return found.withColumn("similarity", F.round("similarity", 6))


@query()
def greedy_part_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of odd and even keys matched one to one by their names, within brands and
    one group that holds a third of all parts."""
    key = F.col("p_partkey")
    parts = X.table(spark, sf, "part").select(
        F.when(key % 3 == 0, "mixed").otherwise(F.col("p_brand")).alias("group"),
        F.when(key % 2 == 0, "gold").otherwise("pred").alias("side"), key.alias("index"), F.col("p_name").alias("text"),
    )
    return greedy_matches(parts, 0.8).withColumn("similarity", F.round("similarity", 6))
