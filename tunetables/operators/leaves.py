"""The leaves of JSON documents as a relation: one row per leaf, whatever the depth.

A document is a VARIANT. Its containers are exploded side by side with what is a leaf
already, a few levels in one plan without a shuffle; rows that are still open are
written and exploded again until none is left. Depth costs rounds, width costs rows,
and no task holds more than a row's own document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise

#: levels that one plan explodes before open rows are looked for
LEVELS = 4
_PLAIN_KEY = r"^[A-Za-z_][A-Za-z0-9_]*$"


def as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_container(v: Column) -> Column:
    return as_list(v).isNotNull() | as_object(v).isNotNull()


def _is_open(v: Column) -> Column:
    return F.coalesce(F.size(as_list(v)) > 0, F.lit(False)) | F.coalesce(F.size(as_object(v)) > 0, F.lit(False))


def _level(rows: DataFrame) -> DataFrame:
    """Containers replaced by what they hold; other rows pass. A list that holds
    any container gives its values no index."""
    spark, given = rows.sparkSession, [c for c in rows.columns if not c.startswith("_")]
    mixed = F.coalesce(F.exists(as_list(F.col("_v")), is_container), F.lit(False))
    held = rows.withColumn("_mixed", mixed).lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
    inside, named = F.col("pos").isNotNull(), F.col("key").isNotNull()
    step = F.when(F.col("key").rlike(_PLAIN_KEY), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit('."'), "key", F.lit('"')))
    return held.select(
        *given,
        F.when(named, F.concat("_path", F.array("key"))).otherwise(F.col("_path")).alias("_path"),
        F.when(inside, F.concat("_at", F.array("pos"))).otherwise(F.col("_at")).alias("_at"),
        F.when(named, F.concat("_place", step)).when(inside, F.concat("_place", F.lit("["), "pos", F.lit("]"))).otherwise(F.col("_place")).alias("_place"),
        F.when(~inside, F.col("_idx")).when(named | F.col("_mixed"), F.lit(0)).otherwise(F.col("pos")).alias("_idx"),
        F.when(inside, F.col("value")).otherwise(F.col("_v")).alias("_v"),
    )


def json_leaves(df: DataFrame, ids: list[str], text: str = "text", levels: int = LEVELS) -> DataFrame:
    """(ids, path, idx, at, place, kind, text) of every leaf of the documents in a text column.

    ``path`` lists the keys that lead to a leaf and ``idx`` its number in a list of
    scalars; lists that hold any container are walked without a number. ``at`` has the
    position at every level and sorts leaves, fields of an object by their keys;
    ``place`` is a JSON path. An empty list is one leaf with '' as text, an empty
    object none, a JSON null a leaf without text; strings come without quotes, numbers
    as VARIANT spells them. Null texts, and texts that are no single document or
    repeat a key in an object, have no leaves. Rows that repeat their ids are documents
    of their own. Names of ``ids`` may be any but must not start with '_'."""
    if not ids or any(c.startswith("_") for c in ids):
        raise ValueError("id columns are needed, with names that do not start with '_'")
    own = [f"id{i}" for i in range(len(ids))]  # the explosion has columns of its own
    start = df.select(
        *[F.col(c).alias(o) for c, o in zip(ids, own, strict=True)],
        F.array().cast("array<string>").alias("_path"), F.array().cast("array<int>").alias("_at"), F.lit("$").alias("_place"),
        F.lit(0).alias("_idx"), F.try_parse_json(F.col(text)).alias("_v"),
    )
    rows, found = start.filter("_v is not null"), []
    while True:
        rows = reduce(lambda r, _: _level(r), range(levels), rows)
        rows = materialise(rows.withColumn("_open", _is_open(F.col("_v"))), "leaves")
        found.append(rows.filter("not _open").drop("_open"))
        rows = rows.filter("_open").drop("_open")
        if rows.isEmpty():
            break
    every = reduce(DataFrame.unionByName, found)
    v = F.col("_v")
    kind = (
        F.when(F.is_variant_null(v), "null").when(as_list(v).isNotNull(), "list").when(as_object(v).isNotNull(), "object")
        .when(F.schema_of_variant(v) == "STRING", "string").when(F.schema_of_variant(v) == "BOOLEAN", "boolean").otherwise("number")
    )
    value = F.when(F.col("kind") == "list", "").when(F.col("kind") != "null", F.try_variant_get(v, "$", "string"))
    return every.withColumn("kind", kind).filter("kind <> 'object'").select(
        *[F.col(o).alias(c) for c, o in zip(ids, own, strict=True)],
        F.col("_path").alias("path"), F.col("_idx").alias("idx"), F.col("_at").alias("at"), F.col("_place").alias("place"), "kind", value.alias("text"),
    )
