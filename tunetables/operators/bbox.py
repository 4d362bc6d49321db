"""Bounding-box grounding score: one Arrow pass reads both JSON texts of a row
into box arrays, the geometry is Column arithmetic over them, no shuffle."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.config import BBoxOptions, Extraction
from tunetables.functions import jsonx
from tunetables.functions import text as T

BOX = pa.struct(
    [
        ("page", pa.int64()),
        *[(side, pa.float64()) for side in ("x1", "y1", "x2", "y2")],
        ("coord", pa.string()),
    ]
)
BOX_DDL = "struct<page:bigint,x1:double,y1:double,x2:double,y2:double,coord:string>"
_ROW = pa.struct(
    [
        ("label_ok", pa.bool_()),
        ("label_status", pa.string()),
        ("label_coord", pa.string()),
        ("gold", pa.list_(BOX)),
        ("hard", pa.list_(BOX)),
        ("parsed", pa.bool_()),
        ("form_ok", pa.bool_()),
        ("status", pa.string()),
        ("pred", pa.list_(BOX)),
    ]
)
_ROW_DDL = (
    f"struct<label_ok:boolean,label_status:string,label_coord:string,gold:array<{BOX_DDL}>,"
    f"hard:array<{BOX_DDL}>,parsed:boolean,form_ok:boolean,status:string,pred:array<{BOX_DDL}>>"
)


def _number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def _box(page, bbox, coord) -> dict | None:
    if not isinstance(bbox, list) or len(bbox) != 4 or not all(map(_number, bbox)):
        return None
    if not isinstance(page, int) or isinstance(page, bool) or abs(page) >= 2**63:
        return None
    x1, y1, x2, y2 = map(float, bbox)
    if not (x2 > x1 and y2 > y1):
        return None
    return {"page": page, "x1": x1, "y1": y1, "x2": x2, "y2": y2, "coord": coord if isinstance(coord, str) else None}


def occurrence_boxes(occurrences, keys: dict) -> list[dict]:
    """Per occurrence the valid fragment boxes, else its envelope box."""
    boxes = []
    for item in occurrences if isinstance(occurrences, list) else ():
        get = lambda obj, key: jsonx.get_alias(obj, keys[key])
        page, parts = get(item, "page"), get(item, "fragments")
        found = [
            _box(page, get(p, "bbox"), get(p, "coord_system")) for p in (parts if isinstance(parts, list) else ())
        ]
        found = [b for b in found if b] or [_box(page, get(item, "envelope_bbox"), get(item, "coord_system"))]
        boxes += [b for b in found if b]
    return boxes


def status_of(value, values: dict) -> str | None:
    if not isinstance(value, str):
        return None
    value = value.strip().lower()
    return next((s for s, names in values.items() if value in [n.strip().lower() for n in names]), None)


def read_documents(answer: Column, solution: Column, opt: BBoxOptions) -> Column:
    keys = opt.schema_keys

    def row(text: str | None, gold_text: str | None) -> dict | None:
        if text is None:
            return None
        label, value = jsonx.loads_lenient(gold_text), jsonx.loads_lenient(text)
        get = lambda obj, key: jsonx.get_alias(obj, keys[key])
        label_coord = get(label, "coord_system")
        hard = get(label, "hard_negative_evidence")
        hard = [_box(get(h, "page"), get(h, "bbox"), label_coord) for h in (hard if isinstance(hard, list) else ())]
        occurrences = get(value, "prediction_occurrences")
        status = status_of(get(value, "grounding_status"), opt.status_values)
        return {
            "label_ok": isinstance(label, dict),
            "label_status": status_of(get(label, "grounding_status"), opt.status_values),
            "label_coord": label_coord if isinstance(label_coord, str) else None,
            "gold": occurrence_boxes(get(label, "label_occurrences"), keys),
            "hard": [h for h in hard if h],
            "parsed": value is not None,
            "form_ok": isinstance(get(value, "field_path"), str) and status is not None and isinstance(occurrences, list),
            "status": status,
            "pred": occurrence_boxes(occurrences, keys),
        }

    @F.arrow_udf(_ROW_DDL)
    def run(a: pa.Array, s: pa.Array) -> pa.Array:
        return pa.array([row(x, y) for x, y in zip(a.to_pylist(), s.to_pylist())], _ROW)

    return run(answer, solution)


# ---------------------------------------------------------------- geometry
def area(b: Column) -> Column:
    """Area as a share of the 1000 x 1000 page."""
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) / 1e6


def iou(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)
    width = F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    height = F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    shared = width * height / 1e6
    union = area(a) + area(b) - shared
    return F.when((shared <= 0) | (union <= 0), 0.0).otherwise(F.try_divide(shared, union))


def center_inside(inner: Column, outer: Column) -> Column:
    x, y = (inner["x1"] + inner["x2"]) / 2, (inner["y1"] + inner["y2"]) / 2
    return x.between(outer["x1"], outer["x2"]) & y.between(outer["y1"], outer["y2"])


def best_match(pred: Column, gold: Column) -> Column:
    """struct(iou, centred) of the best same-page pair, the first pair on ties
    (prediction order, then gold order); null when no page is shared."""
    start = F.lit(None).cast("struct<iou:double,centred:boolean>")

    def over_gold(acc: Column, p: Column, g: Column) -> Column:
        pair = F.struct(iou(p, g).alias("iou"), center_inside(p, g).alias("centred"))
        better = (p["page"] == g["page"]) & (acc.isNull() | (pair["iou"] > acc["iou"]))
        return F.when(better, pair).otherwise(acc)

    return F.aggregate(pred, start, lambda acc, p: F.aggregate(gold, acc, lambda a, g: over_gold(a, p, g)))


def overlaps(boxes: Column, others: Column, at_least: float) -> Column:
    """Some box of ``boxes`` reaches the IoU with one of ``others`` on its page."""
    return F.exists(boxes, lambda b: touches(b, others, at_least))


def touches(b: Column, others: Column, at_least: float) -> Column:
    return F.exists(others, lambda o: (b["page"] == o["page"]) & (iou(b, o) >= at_least))


def score_bbox(
    df: DataFrame,
    opt: BBoxOptions = BBoxOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str = "grounding_bbox_reward",
) -> DataFrame:
    applies = T.has_category_token(F.col(category), opt.category_token) & F.col(solution).isNotNull()
    answer = F.when(applies, T.extract_answer(T.content(df, completion), ext))
    df = df.withColumn("_doc", read_documents(answer, F.col(solution), opt))
    d = F.col("_doc")
    pred, gold = d["pred"], d["gold"]
    same_system = d["label_coord"].isNull() | F.forall(pred, lambda b: b["coord"].eqNullSafe(d["label_coord"]))
    found = d["label_status"].eqNullSafe(F.lit("found"))
    hard = F.when(
        found, F.filter(d["hard"], lambda h: ~touches(h, gold, opt.positive_duplicate_iou_threshold))
    ).otherwise(d["hard"])
    df = df.withColumns(
        {
            "_schema": d["form_ok"] & same_system,
            "_match": best_match(pred, gold),
            "_large": F.exists(pred, lambda b: area(b) > opt.large_box_area_threshold),
            "_hard": overlaps(pred, hard, opt.hard_negative_iou_threshold),
            "_found": found,
        }
    )

    def points(condition: Column, value: float) -> Column:
        return F.when(condition, F.lit(float(value))).otherwise(F.lit(0.0))

    m, schema = F.col("_match"), F.col("_schema")
    penalties = points(F.col("_large"), opt.large_box_penalty) + points(F.col("_hard"), opt.hard_negative_overlap_penalty)
    positive = (
        F.lit(float(opt.format_reward))
        + points(schema & (F.size(pred) > 0), opt.schema_reward)
        + points(m.isNotNull(), opt.page_reward)
        + F.coalesce(opt.iou_weight * m["iou"], F.lit(0.0))
        + points(m["iou"] >= opt.iou_05_threshold, opt.iou_05_bonus)
        + points(m["iou"] >= opt.iou_07_threshold, opt.iou_07_bonus)
        + points(m["centred"], opt.center_in_gt_bonus)
        + penalties
    )
    negative = F.lit(float(opt.format_reward)) + points(schema, opt.schema_reward) + penalties
    withheld = schema & (d["status"] != "found") & (F.size(pred) == 0)

    def clip(c: Column) -> Column:
        return F.least(F.lit(float(opt.max_reward)), F.greatest(F.lit(float(opt.min_reward)), c))

    value = (
        F.when(d.isNull() | ~d["label_ok"], F.lit(None).cast("double"))
        .when(F.col("_found") & (F.size(gold) == 0), F.lit(None).cast("double"))
        .when(~d["parsed"], 0.0)
        .when(F.col("_found"), clip(positive))
        .when(withheld, float(opt.max_reward))
        .otherwise(clip(negative))
    )
    return df.withColumn(output, value).drop("_doc", "_schema", "_match", "_large", "_hard", "_found")
