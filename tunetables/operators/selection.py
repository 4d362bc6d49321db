"""Evidence-selection score over JSON documents (in-row) and over long id
tables (grouped sums, no list is ever collected)."""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.config import Extraction, SelectionOptions
from tunetables.functions import jsonx
from tunetables.functions import text as T

#: rows read at once
_SLICE = 500
_ITEM = pa.struct(
    [
        ("target", pa.string()),  # null when missing or not text/int
        ("n", pa.int32()),  # how-many-th item of this target
        ("ids", pa.list_(pa.string())),  # distinct ids, null when any is no id
        ("repeated", pa.bool_()),
    ]
)
_ITEM_DDL = "struct<target:string,n:int,ids:array<string>,repeated:boolean>"
_ROW = pa.struct(
    [
        ("label_ok", pa.bool_()),
        ("gold", pa.list_(_ITEM)),
        ("parsed", pa.bool_()),
        ("is_object", pa.bool_()),
        ("pred", pa.list_(_ITEM)),
    ]
)
_ROW_DDL = f"struct<label_ok:boolean,gold:array<{_ITEM_DDL}>,parsed:boolean,is_object:boolean,pred:array<{_ITEM_DDL}>>"


def _id(value) -> str | None:
    """Ids as canonical digits, so 7, '7' and ' 007 ' are one id."""
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, str) and value.strip().isdigit():
        try:
            return str(int(value.strip()))
        except ValueError:  # digit-like signs such as superscripts
            return None
    return None


def items(payload, keys: dict) -> list[dict] | None:
    """Items of a list of objects or of a compact target -> ids object; null
    for any other form."""
    listed = jsonx.get_alias(payload, keys["items"])
    if isinstance(listed, dict):
        if any(not k.strip() for k in listed):
            return None
        listed = [{keys["target_id"][0]: k, keys["selected_ids"][0]: v} for k, v in listed.items()]
    if not isinstance(listed, list) or not all(isinstance(x, dict) for x in listed):
        return None
    seen: Counter = Counter()
    out = []
    for item in listed:
        target = jsonx.get_alias(item, keys["target_id"])
        target = str(target).strip() if isinstance(target, (str, int)) and not isinstance(target, bool) else ""
        seen[target] += 1
        ids = jsonx.get_alias(item, keys["selected_ids"])
        ids = [_id(v) for v in (ids if isinstance(ids, list) else [ids])]
        valid = None not in ids
        distinct = list(dict.fromkeys(ids)) if valid else None
        out.append(
            {
                "target": target or None,
                "n": seen[target],
                "ids": distinct,
                "repeated": valid and len(distinct) != len(ids),
            }
        )
    return out


def _item_lists(lists: list[list[dict] | None]) -> pa.Array:
    """Item lists as one flat struct column with offsets."""
    flat = [(x["target"], x["n"], x["ids"], x["repeated"]) for listed in lists for x in listed or ()]
    ends = list(accumulate((len(x or ()) for x in lists), initial=0))
    missing = pa.array([x is None for x in lists], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), jsonx.struct_array(flat, _ITEM), type=pa.list_(_ITEM), mask=missing)


def read_documents(answer: Column, solution: Column, opt: SelectionOptions) -> Column:
    def label_of(text: str | None) -> tuple:
        label = jsonx.loads_lenient(text)
        return isinstance(label, dict), items(label, opt.schema_keys)

    def value_of(text: str) -> tuple:
        value = jsonx.loads_lenient(text)
        return value is not None, isinstance(value, dict), items(value, opt.schema_keys)

    @F.arrow_udf(_ROW_DDL)
    def run(a: pa.Array, s: pa.Array) -> pa.Array:
        # few objects live at once, which the collector walks
        slices = range(0, max(1, len(a)), _SLICE)
        return pa.concat_arrays([part(a.slice(at, _SLICE), s.slice(at, _SLICE)) for at in slices])

    def part(a: pa.Array, s: pa.Array) -> pa.Array:
        labels: dict = {}  # the completions of one prompt share a solution
        rows = []
        for text, gold_text in zip(a.to_pylist(), s.to_pylist()):
            if text is None:
                rows.append((None,) * 5)
                continue
            if gold_text not in labels:
                labels[gold_text] = label_of(gold_text)
            rows.append((*labels[gold_text], *value_of(text)))
        columns = list(zip(*rows)) if rows else [()] * 5
        arrays = [_item_lists(list(c)) if pa.types.is_list(f.type) else pa.array(c, f.type) for f, c in zip(_ROW, columns)]
        return pa.StructArray.from_arrays(arrays, fields=list(_ROW), mask=pa.array([r[0] is None for r in rows], pa.bool_()))

    return run(answer, solution)


def _clip01(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def quality_of_counts(n_pred: Column, n_gold: Column, n_common: Column, opt: SelectionOptions) -> Column:
    """Quality of one target from its three distinct-id counts."""
    n_pred, n_gold, n_common = (c.cast("double") for c in (n_pred, n_gold, n_common))
    equal = (n_common == n_gold) & (n_common == n_pred)
    best = float(opt.exact_match_reward + opt.partial_match_weight)
    if best <= 0:
        return F.when(equal, 1.0).otherwise(0.0)
    extra, missing = n_pred - n_common, n_gold - n_common
    f1 = F.coalesce(F.try_divide(2.0 * n_common, n_pred + n_gold), F.lit(0.0))
    score = (
        opt.partial_match_weight * f1
        + F.when(extra > 0, float(opt.wrong_selection_penalty)).otherwise(0.0)
        + F.when(n_pred > n_gold, float(opt.over_selection_penalty)).otherwise(0.0)
    )
    multi = opt.multi_fragment_partial_match_cap
    cap = (
        F.when(n_gold == 1, min(opt.partial_match_cap, opt.single_id_partial_cap))
        .when(n_gold == 0, min(opt.partial_match_cap, opt.short_multi_id_partial_cap))
        .when(n_gold <= 4, min(opt.partial_match_cap, opt.short_multi_id_partial_cap, multi))
        .when(n_gold <= 8, min(opt.partial_match_cap, opt.long_multi_id_partial_cap, multi))
        .otherwise(min(opt.partial_match_cap, opt.very_long_multi_id_partial_cap, multi))
    )
    q = F.least(_clip01(score / best), cap)
    wrong_place = (n_pred > 0) & (n_gold > 0) & (F.try_divide(n_common, n_gold) <= opt.wrong_occurrence_overlap_threshold)
    lowered = F.when(F.coalesce(wrong_place, F.lit(False)), F.least(q, F.lit(float(opt.wrong_occurrence_cap)))).otherwise(q)
    q = F.when(missing > 0, lowered + opt.missing_gold_id_penalty * missing).otherwise(q)
    over = F.least(q, F.lit(float(opt.over_selection_cap))) + opt.extra_selected_id_penalty * extra
    q = _clip01(F.when(extra > 0, over).otherwise(q))
    return F.when(equal, 1.0).otherwise(q)


def item_quality(pred: Column, gold: Column, opt: SelectionOptions) -> Column:
    """Quality of one gold item against the item predicted for its target
    (null item: 0; invalid or repeated ids: 0)."""
    ids, gold_ids = F.coalesce(pred["ids"], F.array().cast("array<string>")), gold["ids"]
    counted = quality_of_counts(F.size(ids), F.size(gold_ids), F.size(F.array_intersect(ids, gold_ids)), opt)
    return F.when(pred["ids"].isNull() | pred["repeated"], 0.0).otherwise(counted)


def hard_weight(n_gold: Column, opt: SelectionOptions) -> Column:
    return F.when(n_gold >= opt.hard_target_min_gold_ids, float(opt.hard_target_weight)).otherwise(1.0)


def score_selection(
    df: DataFrame,
    opt: SelectionOptions = SelectionOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str = "grounding_selection_reward",
) -> DataFrame:
    applies = T.has_category_token(F.col(category), opt.category_token) & F.col(solution).isNotNull()
    answer = F.when(applies, T.extract_answer(T.content(df, completion), ext))
    df = df.withColumn("_doc", read_documents(answer, F.col(solution), opt))
    d = F.col("_doc")

    def first(listed: Column) -> Column:
        return F.filter(listed, lambda x: x["target"].isNotNull() & (x["n"] == 1))

    def strays(listed: Column) -> Column:
        return F.size(listed) - F.size(first(listed))

    df = df.withColumns(
        {
            "_gold": first(d["gold"]),
            "_gold_ok": (strays(d["gold"]) == 0)
            & F.forall(d["gold"], lambda x: x["ids"].isNotNull() & ~x["repeated"] & (F.size(x["ids"]) > 0)),
            "_pred": first(d["pred"]),
            "_strays": strays(d["pred"]),
        }
    )
    gold, pred = F.col("_gold"), F.col("_pred")
    by_target = F.map_from_entries(F.transform(pred, lambda x: F.struct(x["target"], x)))
    scored = F.transform(
        gold,
        lambda g: F.struct(
            item_quality(F.try_element_at(by_target, g["target"]), g, opt).alias("q"),
            hard_weight(F.size(g["ids"]), opt).alias("w"),
        ),
    )
    df = df.withColumn("_scored", scored)
    s = F.col("_scored")

    def total(field) -> Column:
        return F.aggregate(s, F.lit(0.0), lambda a, x: a + field(x))

    if opt.target_quality_aggregation == "min":
        mean = F.array_min(F.transform(s, lambda x: x["q"]))
    elif opt.target_quality_aggregation == "mean":
        mean = F.try_divide(total(lambda x: x["q"]), F.size(s).cast("double"))
    else:
        weight = total(lambda x: x["w"])
        mean = F.when(weight > 0, F.try_divide(total(lambda x: x["q"] * x["w"]), weight)).otherwise(0.0)
    empty = F.when(F.size(pred) == 0, 1.0).otherwise(0.0)
    targets = lambda c: F.transform(c, lambda x: x["target"])
    df = df.withColumns(
        {
            "_quality": F.when(F.size(gold) == 0, empty).otherwise(mean),
            "_extra": F.size(F.array_except(targets(pred), targets(gold))),
            "_schema": (F.col("_strays") == 0) & F.forall(pred, lambda x: x["ids"].isNotNull() & ~x["repeated"]),
            "_any": F.exists(pred, lambda x: F.coalesce(F.size(x["ids"]), F.lit(0)) > 0),
        }
    )
    low, high = F.lit(float(opt.min_reward)), F.lit(float(opt.max_reward))

    def clip(c: Column) -> Column:
        return F.least(high, F.greatest(low, c))

    base = F.lit(float(opt.format_reward)) + F.when(F.col("_schema"), float(opt.schema_reward)).otherwise(0.0)
    r = base + F.greatest(F.lit(0.0), high - base) * F.col("_quality")
    capped = F.least(r, F.lit(float(opt.schema_only_reward_cap)))
    capped = F.when(F.col("_any"), capped).otherwise(F.least(capped, F.lit(float(opt.empty_selection_reward_cap))))
    r = F.when(F.col("_quality") > 0, r).otherwise(capped)
    r = F.when(
        F.col("_extra") > 0,
        F.least(r + opt.wrong_selection_penalty * F.col("_extra"), F.lit(float(opt.extra_target_reward_cap))),
    ).otherwise(r)
    r = r + opt.wrong_selection_penalty * F.col("_strays")
    r = F.when(F.col("_schema"), r).otherwise(F.least(r, F.lit(float(opt.invalid_schema_reward_cap))))
    value = (
        F.when(d.isNull() | ~d["label_ok"] | d["gold"].isNull() | ~F.col("_gold_ok"), F.lit(None).cast("double"))
        .when(~d["parsed"] | ~d["is_object"], 0.0)
        .when(d["pred"].isNull(), clip(F.lit(float(opt.format_reward))))
        .otherwise(clip(r))
    )
    extra = ["_doc", "_gold", "_gold_ok", "_pred", "_strays", "_scored", "_quality", "_extra", "_schema", "_any"]
    return df.withColumn(output, value).drop(*extra)


def selection_quality(
    ids: DataFrame, key: str, target: str, gold: str, pred: str, opt: SelectionOptions = SelectionOptions()
) -> DataFrame:
    """Row quality from a long table with one gold id and one predicted id per
    line (either may be null).

    Every step is a grouped sum or max with a map-side part, so a key holding a
    large share of the rows costs no more than its number of distinct ids.
    Repeated predicted ids make a target 0, as in the document form; repeated
    gold ids count once.
    """
    sides = ids.select(
        key,
        target,
        F.explode(
            F.array(
                F.struct(F.col(gold).alias("id"), F.lit(1).alias("g"), F.lit(0).alias("p")),
                F.struct(F.col(pred).alias("id"), F.lit(0).alias("g"), F.lit(1).alias("p")),
            )
        ).alias("s"),
    ).where("s.id is not null")
    per_id = sides.groupBy(key, target, "s.id").agg(F.max("s.g").alias("g"), F.sum("s.p").alias("p"))
    per_target = per_id.groupBy(key, target).agg(
        F.sum("g").alias("n_gold"),
        F.count_if(F.col("p") > 0).alias("n_pred"),
        F.sum(F.when(F.col("p") > 0, F.col("g")).otherwise(0)).alias("n_common"),
        F.max("p").alias("most"),
    )
    q = F.when(F.col("most") > 1, 0.0).otherwise(
        quality_of_counts(F.col("n_pred"), F.col("n_gold"), F.col("n_common"), opt)
    )
    q = F.when(F.col("n_pred") == 0, 0.0).otherwise(q)
    w = hard_weight(F.col("n_gold"), opt)
    per_target = per_target.where("n_gold > 0").select(key, q.alias("q"), w.alias("w"))
    total = {
        "mean": F.avg("q"),
        "min": F.min("q"),
        "hard_weighted_mean": F.try_divide(F.sum(F.col("q") * F.col("w")), F.sum("w")),
    }[opt.target_quality_aggregation]
    return per_target.groupBy(key).agg(F.count("*").alias("targets"), total.alias("quality"))
