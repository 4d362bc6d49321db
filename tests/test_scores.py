"""JSON scorers against plain restatements of their rules on random documents."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tunetables.config import BBoxOptions, CodeOptions, KVOptions, RougeOptions, SelectionOptions
from tunetables.functions import jsonx
from tunetables.functions.arithmetic import evaluate
from tunetables.functions.overlap import lcs_length, rouge_f, stem
from tunetables.operators import rewards as R
from tunetables.operators.bbox import score_bbox
from tunetables.operators.kv import score_kv, similarity
from tunetables.operators.selection import score_selection

WORDS = ["Alpha", "alpha", "al pha", "beta", "1,000", "1.000", "1000", "", " ", None, 12, 12.5, True, "한글", "ＦＵＬＬ", "full"]


def run(spark, score, rows, column, **options):
    df = spark.createDataFrame(rows, "i int, category string, solution string, completion string").repartition(3)
    return {r["i"]: r[column] for r in score(df, **options).collect()}


def near(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


# ------------------------------------------------------------------- kv
def sim(p, g, o):
    if (p is None) != (g is None):
        return o.empty_value_mismatch_cap
    p, g = ("" if v is None else str(v) for v in (p, g))
    if p.strip() == g.strip():
        return 1.0
    if not p.strip() or not g.strip():
        return 0.0
    if jsonx.clean(p) == jsonx.clean(g):
        return min(o.normalized_match_cap, o.non_exact_value_cap)
    if jsonx.coarse(p) == jsonx.coarse(g):
        marks = [{t[k] for k in range(1, len(t) - 1) if t[k] in ",.:" and t[k - 1].isdigit() and t[k + 1].isdigit()} for t in (p, g)]
        both = all(any(ch.isdigit() for ch in t) for t in (p, g))
        caps = [o.coarse_match_cap, o.non_exact_value_cap] + ([o.numeric_punctuation_mismatch_cap] if both and marks[0] != marks[1] else [])
        return min(caps)
    return min(SequenceMatcher(a=jsonx.clean(p), b=jsonx.clean(g)).ratio(), o.non_exact_value_cap)


def f1(pred, gold, same, o):
    if not pred or not gold:
        return 1.0 if not pred and not gold else 0.0
    pairs = [(sim(p[2], g[2], o), i, j) for i, g in enumerate(gold) for j, p in enumerate(pred) if same(p, g)]
    pairs = sorted((x for x in pairs if x[0] >= o.threshold), key=lambda x: (-x[0], x[1], x[2]))
    total, n, seen_g, seen_p = 0.0, 0, set(), set()
    for s, i, j in pairs:
        if i not in seen_g and j not in seen_p:
            seen_g.add(i), seen_p.add(j)
            total, n = total + s, n + 1
    hit = total if o.use_weighted_fuzzy_f1 else n
    return 2 * hit / (len(pred) + len(gold))


def leaves(node, path=()):
    if isinstance(node, dict):
        return [x for k, v in node.items() for x in leaves(v, path + (k,))]
    if isinstance(node, list):
        if any(isinstance(v, (dict, list)) for v in node):
            return [x for v in node for x in leaves(v, path)]
        return [(path, i, v) for i, v in enumerate(node)] or [(path, 0, "")]
    return [(path, 0, node)]


def repeated(pred, gold):
    count = lambda xs: {v: [jsonx.coarse("" if x[2] is None else str(x[2])) for x in xs].count(v) for v in {jsonx.coarse("" if x[2] is None else str(x[2])) for x in xs} if v}
    p, g = count(pred), count(gold)
    return any(n > max(g.get(v, 0), 1) for v, n in p.items())


def balance(p, g, o):
    cap = 1.0
    if g and (p - g) / g > o.extra_leaf_ratio_threshold:
        cap = min(cap, o.extra_leaf_cap)
    if g and (g - p) / g > o.missing_leaf_ratio_threshold:
        cap = min(cap, o.missing_leaf_cap)
    return cap


def order(keys):
    try:
        return sorted(keys, key=int)
    except ValueError:
        return sorted(keys)


def rows_of(table):
    rows = table.get("rows", []) if isinstance(table, dict) else []
    if isinstance(rows, dict):
        rows = [rows[k] for k in order(rows)]
    return rows if isinstance(rows, list) else []


def columns_of(rows):
    out = []
    for r in rows:
        if isinstance(r, dict):
            out += [k for k in order(r) if k not in out]
    return out


def cells(tables):
    out = []
    for name in order(tables) if isinstance(tables, dict) else []:
        rows = rows_of(tables[name])
        for i, r in enumerate(rows):
            out += [((name, c), i, r.get(c, "") if isinstance(r, dict) else "") for c in columns_of(rows)]
        out += [] if rows else [((name,), 0, "")]
    return out


def table_caps(p, g, o):
    cap = 1.0
    if set(p) != set(g):
        cap = min(cap, o.table_name_mismatch_cap)
    for t in set(p) & set(g):
        a, b = rows_of(p[t]), rows_of(g[t])
        if set(columns_of(a)) != set(columns_of(b)):
            cap = min(cap, o.table_column_mismatch_cap)
        if len(a) != len(b):
            cap = min(cap, o.table_row_count_mismatch_cap)
        sign = lambda rows: [tuple((k, jsonx.coarse(str(r[k]))) for k in order(r)) for r in rows if isinstance(r, dict)]
        if any(sign(a).count(s) > max(sign(b).count(s), 1) for s in sign(a)):
            cap = min(cap, o.duplicate_table_row_cap)
    return cap


def expected_kv(pred, gold, root, o, fmt=1.0):
    p = pred.get(root) if isinstance(pred, dict) else None
    g = gold[root]
    ok = isinstance(pred, dict) and not set(pred) - {root, *o.allowed_sibling_keys} and isinstance(p, dict)
    caps = [fmt, 1.0 if ok else o.root_mismatch_cap]
    size = lambda v: len(json.dumps(v, ensure_ascii=False, sort_keys=True))
    if size(p) / max(size(g), 1) > o.max_serialized_length_ratio:
        caps.append(o.length_ratio_cap)
    if leaves(g) and len(leaves(p)) / len(leaves(g)) > o.max_leaf_count_ratio:
        caps.append(o.leaf_count_ratio_cap)
    flat = leaves if root == "kv" else cells
    a, b = flat(p), flat(g)
    caps.append(balance(len(a), len(b), o))
    if root == "kv":
        content = o.kv_value_weight * f1(a, b, lambda x, y: True, o) + o.kv_path_weight * f1(a, b, lambda x, y: x[0] == y[0], o)
        if len({x[:2] for x in a}) < len(a):
            caps.append(o.duplicate_path_cap)
        if repeated(a, b):
            caps.append(o.duplicate_value_cap)
        tops = [{x[0][0] for x in xs if x[0]} for xs in (a, b)]
        if all(tops) and not tops[0] & tops[1]:
            caps.append(o.kv_top_level_path_mismatch_cap)
    else:
        content = o.table_value_weight * f1(a, b, lambda x, y: x[1] == y[1], o)
        content += o.table_structure_weight * f1(a, b, lambda x, y: x[:2] == y[:2], o)
        if isinstance(p, dict):
            caps.append(table_caps(p, g, o))
            if repeated(a, b):
                caps.append(o.duplicate_value_cap)
    return min(1.0, max(0.0, min(content, *caps)))


def random_tree(rng, depth=0):
    pick = rng.random()
    if depth < 3 and pick < 0.45:
        return {rng.choice("abcd"): random_tree(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    if depth < 3 and pick < 0.6:
        return [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice(WORDS)


def random_tables(rng):
    def row():
        return {rng.choice(["x", "y", "10", "9"]): rng.choice(WORDS) for _ in range(rng.randint(0, 3))} if rng.random() < 0.9 else "odd"

    def table():
        rows = [row() for _ in range(rng.randint(0, 3))]
        rows = {str(rng.randint(0, 20)): r for r in rows} if rng.random() < 0.3 else rows
        return {"rows": rows} if rng.random() < 0.95 else 5

    return {rng.choice(["0", "1", "t"]): table() for _ in range(rng.randint(0, 3))}


@pytest.mark.parametrize("root", ["kv", "tables"])
@pytest.mark.parametrize(
    "opt",
    [
        KVOptions(),
        KVOptions(use_weighted_fuzzy_f1=False, score_threshold=0.7, non_exact_value_cap=0.9, normalized_match_cap=0.85, coarse_match_cap=0.8, numeric_punctuation_mismatch_cap=0.6),
        KVOptions(non_exact_value_cap=1.0, normalized_match_cap=1.0, empty_value_mismatch_cap=0.6, weighted_fuzzy_match_threshold=0.3),
    ],
)
def test_kv_random(spark, root, opt):
    rng = random.Random(root + str(opt.use_weighted_fuzzy_f1))
    make = (lambda: {rng.choice("abc"): random_tree(rng, 1) for _ in range(rng.randint(0, 4))}) if root == "kv" else (lambda: random_tables(rng))
    rows, want = [], {}
    for i in range(150):
        gold = {root: make()}
        pred = json.loads(json.dumps(gold)) if rng.random() < 0.3 else {root: make()}
        if rng.random() < 0.1:
            pred = rng.choice([[1], {root: 3}, {"other": 1, root: pred[root]}, {**pred, "grounding": []}])
        rows.append((i, f"x_{opt.category_token}", json.dumps(gold), json.dumps(pred, ensure_ascii=False) + "<stop>"))
        want[i] = expected_kv(pred, gold, root, opt)
    got = run(spark, score_kv, rows, "kv_reward", opt=opt)
    bad = [(rows[i][2:], got[i], want[i]) for i in want if not near(got[i], want[i])]
    assert not bad, bad[:2]


def test_kv_forms(spark):
    gold = '{"kv":{"a":"x"}}'
    cases = [
        ("kv", gold, gold + "<stop>", 1.0),
        ("kv", gold, gold, 0.6),
        ("kv", gold, gold + "<stop>t<stop>", 0.2),  # the last stop's prefix does not parse, the first's does
        ("kv", gold, gold + "<stop> tail", 0.2),
        ("kv", gold, "```json\n" + gold + "\n```<stop>", 1.0),
        ("kv", gold, "bad <stop>", 0.0),
        ("kv", gold, "null", 0.0),
        ("kv", "no json", gold, None),
        ("kv", '{"z":1}', gold, None),
        ("kv", gold + "<stop>", gold + "<stop>", 1.0),
        ("other", gold, gold, None),
        ("kv", "", gold, None),
        ("kv", None, gold, None),
        ("kv", gold, None, 0.0),
        ("kv", '{"kv":{"a":1,"a":2}}', '{"kv":{"a":2}}<stop>', 1.0),  # the last of repeated keys counts
        ("kv", '{"results":[{"target_id":1,"text":"a"},{"target_id":"2","text":null}]}', '{"results":[{"target_id":"1","text":"a"},{"target_id":2}]}<stop>', 1.0),
        ("kv", '{"results":[{"target_id":1,"text":"a"}]}', '{"results":{}}<stop>', 0.0),
    ]
    got = run(spark, score_kv, [(i, *c[:3]) for i, c in enumerate(cases)], "kv_reward")
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]


def test_kv_long_document(spark):
    """Thousands of leaves in one row stay linear while they match."""
    doc = {"kv": {f"k{i}": [f"value {i}", i] for i in range(4000)}}
    text = json.dumps(doc)
    assert run(spark, score_kv, [(0, "kv", text, text + "<stop>")], "kv_reward") == {0: 1.0}


def test_similarity_floor_loses_nothing():
    rng, opt = random.Random(4), KVOptions(non_exact_value_cap=0.9)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(1, 8))).strip() for _ in range(2))
        full = similarity(a, b, opt)
        cut = similarity(a, b, opt, 0.6)
        assert cut == full if full >= 0.6 else cut < 0.6


def test_flatten(spark):
    df = spark.createDataFrame([('{"a":{"b":[1,true,null]},"c":[],"d":{},"":[{"x":1.50},2]}',)], "c string")
    got = [tuple(x) for x in df.select(jsonx.flatten(F.col("c"))).first()[0]]
    s = jsonx.SEP
    assert got == [
        (f"{s}a{s}b", 0, "1"), (f"{s}a{s}b", 1, "True"), (f"{s}a{s}b", 2, None), (f"{s}c", 0, ""), (f"{s}{s}x", 0, "1.5"), (f"{s}", 0, "2"),
    ]
    assert [x[2] for x in jsonx.flatten_tables({"10": {}, "9": {"rows": {"2": {"b": 1}, "1": {"a": 2}}}})] == [2, "", "", 1, ""]
    deep = "[" * 900 + "]" * 900
    assert jsonx.count_leaves(json.loads(deep)) == len(list(jsonx.flatten_kv(json.loads(deep)))) == 1


# ------------------------------------------------------------------ boxes
def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    size = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    return w * h / (size(a) + size(b) - w * h)


def expected_bbox(pred, label, o):
    gold, found = label["positive_occurrences"], label["grounding_status"] == "found"
    mine = pred["evidence_occurrences"]
    hard = [x for x in label["hard_negative_evidence"]]
    if found and not gold:
        return None
    schema = pred["grounding_status"] in ("found", "missing") and "field_path" in pred
    if "coord_system" in label:
        schema = schema and all(x.get("coord_system") == label["coord_system"] for x in mine)
    score = o.format_reward
    if found:
        score += o.schema_reward if schema and mine else 0
        pairs = [(overlap(p["bbox"], g["bbox"]), p["bbox"], g["bbox"]) for p in mine for g in gold if p["page"] == g["page"]]
        if pairs:
            best = pairs[0]
            for x in pairs:
                best = x if x[0] > best[0] else best
            score += o.page_reward + o.iou_weight * best[0]
            score += (o.iou_05_bonus if best[0] >= o.iou_05_threshold else 0) + (o.iou_07_bonus if best[0] >= o.iou_07_threshold else 0)
            (a, b, c, d), g = best[1:]
            if g[0] <= (a + c) / 2 <= g[2] and g[1] <= (b + d) / 2 <= g[3]:
                score += o.center_in_gt_bonus
        hard = [h for h in hard if not any(h["page"] == g["page"] and overlap(h["bbox"], g["bbox"]) >= o.positive_duplicate_iou_threshold for g in gold)]
    else:
        score += o.schema_reward if schema else 0
        if schema and pred["grounding_status"] != "found" and not mine:
            return o.max_reward
    if any((x["bbox"][2] - x["bbox"][0]) * (x["bbox"][3] - x["bbox"][1]) / 1e6 > o.large_box_area_threshold for x in mine):
        score += o.large_box_penalty
    if any(p["page"] == h["page"] and overlap(p["bbox"], h["bbox"]) >= o.hard_negative_iou_threshold for p in mine for h in hard):
        score += o.hard_negative_overlap_penalty
    return min(o.max_reward, max(o.min_reward, score))


def test_bbox_random(spark):
    rng, opt = random.Random(8), BBoxOptions()

    def boxes(n, system):
        out = []
        for _ in range(rng.randint(0, n)):
            x, y = rng.choice([0, 10, 100]), rng.choice([0, 20])
            b = {"page": rng.randint(1, 2), "bbox": [x, y, x + rng.choice([50, 100, 900]), y + rng.choice([50, 60, 700])]}
            if system and rng.random() < 0.8:
                b["coord_system"] = system
            out.append(b)
        return out

    rows, want = [], {}
    for i in range(250):
        system = rng.choice([None, "norm"])
        label = {"grounding_status": rng.choice(["found", "found", "absent"]), "positive_occurrences": boxes(3, system), "hard_negative_evidence": boxes(2, None)}
        if system:
            label["coord_system"] = system
        if rng.random() < 0.3:
            label["hard_negative_evidence"] += label["positive_occurrences"][:1]
        pred = {"grounding_status": rng.choice(["found", "missing", "odd"]), "evidence_occurrences": boxes(3, system)}
        if rng.random() < 0.8:
            pred["field_path"] = "a"
        rows.append((i, "bbox", json.dumps(label), json.dumps(pred)))
        want[i] = expected_bbox(pred, label, opt)
    got = run(spark, score_bbox, rows, "grounding_bbox_reward")
    bad = [(rows[i][2:], got[i], want[i]) for i in want if not near(got[i], want[i])]
    assert not bad, bad[:2]


def test_bbox_forms(spark):
    box = '{"page":1,"bbox":[0,0,100,100]}'
    label = f'{{"grounding_status":" Found ","occurrences":[{box}]}}'
    good = f'{{"field_path":"a","grounding_status":"found","occurrences":[{{"page":1,"fragments":[{{"bbox":[0,0,100,100]}},{{"bbox":[1]}}]}}]}}'
    cases = [
        ("bbox", label, good, 1.0),
        ("bbox", label, "text " + good + " text", 1.0),
        ("bbox", label, "none", 0.0),
        ("bbox", label, "[1]", 0.1),
        ("bbox", label, f'{{"occurrences":[{{"page":true,"bbox":[0,0,100,100]}}]}}', 0.1),
        ("bbox", label, '{"occurrences":[{"page":1,"fragments":[],"bbox":[0,0,100,100]}]}', 1.0),
        ("bbox", '{"grounding_status":"found"}', good, None),
        ("bbox", "none", good, None),
        ("text", label, good, None),
    ]
    got = run(spark, score_bbox, [(i, *c[:3]) for i, c in enumerate(cases)], "grounding_bbox_reward")
    assert [None if got[i] is None else round(got[i], 9) for i in range(len(cases))] == [c[3] for c in cases]


# -------------------------------------------------------------- selection
def expected_selection(pred, gold, o):
    """pred: list of (target, ids or None when invalid), gold: dict."""
    first, invalid = {}, 0
    for target, ids in pred:
        if target is None or target in first:
            invalid += 1
        else:
            first[target] = ids
    schema = not invalid and all(ids is not None and len(set(ids)) == len(ids) for ids in first.values())
    base = o.format_reward + (o.schema_reward if schema else 0)
    parts = []
    for target, g in gold.items():
        ids, g, w = first.get(target), set(g), o.hard_target_weight if len(g) >= o.hard_target_min_gold_ids else 1.0
        if ids is None or len(set(ids)) != len(ids):
            parts.append((0.0, w))
            continue
        p = set(ids)
        if p == g:
            parts.append((1.0, w))
            continue
        tp, extra, missing = len(p & g), len(p - g), len(g - p)
        s = o.partial_match_weight * (2 * tp / (len(p) + len(g)))
        s += (o.wrong_selection_penalty if extra else 0) + (o.over_selection_penalty if len(p) > len(g) else 0)
        q = min(1.0, max(0.0, s / (o.exact_match_reward + o.partial_match_weight)))
        by_size = o.single_id_partial_cap if len(g) == 1 else o.short_multi_id_partial_cap if len(g) <= 4 else o.long_multi_id_partial_cap if len(g) <= 8 else o.very_long_multi_id_partial_cap
        q = min(q, o.partial_match_cap, by_size, o.multi_fragment_partial_match_cap if len(g) > 1 else 1.0)
        if missing:
            if p and tp / len(g) <= o.wrong_occurrence_overlap_threshold:
                q = min(q, o.wrong_occurrence_cap)
            q += o.missing_gold_id_penalty * missing
        if extra:
            q = min(q, o.over_selection_cap) + o.extra_selected_id_penalty * extra
        parts.append((min(1.0, max(0.0, q)), w))
    if not gold:
        quality = 1.0 if not first else 0.0
    elif o.target_quality_aggregation == "min":
        quality = min(q for q, _ in parts)
    elif o.target_quality_aggregation == "mean":
        quality = sum(q for q, _ in parts) / len(parts)
    else:
        quality = sum(q * w for q, w in parts) / sum(w for _, w in parts)
    r = base + max(0.0, o.max_reward - base) * quality
    if quality <= 0:
        r = min(r, o.schema_only_reward_cap)
        if not any(first.values()):
            r = min(r, o.empty_selection_reward_cap)
    extra = len(set(first) - set(gold))
    if extra:
        r = min(r + o.wrong_selection_penalty * extra, o.extra_target_reward_cap)
    r += o.wrong_selection_penalty * invalid
    r = r if schema else min(r, o.invalid_schema_reward_cap)
    return min(o.max_reward, max(o.min_reward, r))


@pytest.mark.parametrize(
    "opt",
    [
        SelectionOptions(),
        SelectionOptions(target_quality_aggregation="min", missing_gold_id_penalty=-0.05, extra_selected_id_penalty=-0.02, over_selection_cap=0.7, schema_only_reward_cap=0.15, empty_selection_reward_cap=0.05),
        SelectionOptions(
            target_quality_aggregation="hard_weighted_mean", hard_target_weight=3.0, hard_target_min_gold_ids=2, single_id_partial_cap=0.1, short_multi_id_partial_cap=0.3, multi_fragment_partial_match_cap=0.25, long_multi_id_partial_cap=0.2,
            wrong_occurrence_cap=0.1, wrong_occurrence_overlap_threshold=0.4, invalid_schema_reward_cap=0.5, extra_target_reward_cap=0.6,
        ),
    ],
)
def test_selection_random(spark, opt):
    rng = random.Random(opt.target_quality_aggregation)
    rows, want = [], {}
    for i in range(250):
        gold = {t: rng.sample(range(12), rng.choice([1, 2, 3, 6, 10])) for t in rng.sample(["a", "b", "c"], rng.randint(0, 3))}
        pred = []
        for _ in range(rng.randint(0, 4)):
            target = rng.choice(["a", "b", "c", "z", None])
            ids = list(gold.get(target, [1])) if rng.random() < 0.5 else [rng.randrange(12) for _ in range(rng.randint(0, 4))]
            pred.append((target, None if rng.random() < 0.1 else ids))
        items = [{"target_id": t, "selected_ids": [str(v) for v in ids] if ids is not None else "x y"} for t, ids in pred]
        text = json.dumps({"grounding": items})
        rows.append((i, "evidence", json.dumps({"grounding": gold}), text))
        want[i] = expected_selection(pred, gold, opt)
    got = run(spark, score_selection, rows, "grounding_selection_reward", opt=opt)
    bad = [(rows[i][2:], got[i], want[i]) for i in want if not near(got[i], want[i])]
    assert not bad, bad[:2]


def test_selection_forms(spark):
    gold = '{"grounding":{"a":[1,2],"b":3}}'
    cases = [
        (gold, '{"grounding":[{"target_id":"a","selected_candidate_ids":["2"," 01 "]},{"target_id":"b","selected_ids":3}]}', 1.0),
        (gold, "[]", 0.0),
        (gold, "none", 0.0),
        (gold, '{"grounding":[1]}', 0.1),
        (gold, '{"grounding":{" ":[1]}}', 0.1),
        ('{"grounding":{"a":[1,1]}}', gold, None),
        ('{"grounding":{"a":[]}}', gold, None),
        ('{"grounding":[{"target_id":true,"selected_ids":[1]}]}', gold, None),
        ('{"grounding":{}}', '{"grounding":{}}', 1.0),
    ]
    got = run(spark, score_selection, [(i, "evidence", *c[:2]) for i, c in enumerate(cases)], "grounding_selection_reward")
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


# --------------------------------------------------------------- the rest
def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert lcs_length(a, b) == slow_lcs(a, b)


def test_stems():
    # pairs from the published algorithm description, and its common extensions
    pairs = """caresses caress ponies poni ties tie cats cat agreed agre plastered plaster bled bled motoring motor sing sing
    conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
    filing file happy happi sky sky relational relat conditional condit valenci valenc digitizer digit conformabli conform
    radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper
    feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
    triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
    allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit replacement replac
    adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular
    homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
    dying die news news spied spi died die enjoy enjoy""".split()
    wrong = [(w, stem(w), s) for w, s in zip(pairs[::2], pairs[1::2]) if stem(w) != s]
    assert not wrong


def test_rouge(spark):
    assert rouge_f("the cat sat", "the cat", "1", False) == pytest.approx(0.8)
    assert rouge_f("the cat sat", "cat the", "2", False) == 0.0
    assert rouge_f("a b c d", "a c d b", "l", False) == pytest.approx(0.75)
    assert rouge_f("running dogs", "Run dog", "l", True) == 1.0
    assert rouge_f("", "x", "1", True) == rouge_f("x", "", "l", True) == 0.0
    df = spark.createDataFrame([("rouge", "b", "answer: b"), ("math", "b", "b"), ("rouge", "", "b")], "category string, solution string, completion string")
    assert [r.rouge_l_reward for r in R.score_rouge(df).collect()] == [1.0, None, None]
    with pytest.raises(ValueError):
        RougeOptions("3")


def test_equation(spark):
    assert [evaluate(t) for t in ("1+2*3", "-(4)/8", "7//2", "2**3", "1/0", "007", "2(3)", "9**9**9", "", "a")] == [7, -0.5, 3, 8] + [None] * 6
    sizes = {"(3-2)**9999": 1, "2**5000/2**4999": 2, "(1-2)**(9**99)": -1, "0**(9**9**9)": 0, "9**9**9/9**9**9": 1, "9**9**9//3**(2*9**9)": 1, "9**9**9-9**9**9+4": 4,
             "2**300000//2**299990": 1024, "3**400000-3**400000": 0, "2**(0-5000)": 0.0, "10**400": None, "1.5*2**5000": None, "0**(0-1)": None, "9**9**9**9": None}
    assert {t: evaluate(t) for t in sizes} == sizes
    cancelled = {"2**300000-(2**300000-1)": 1, "(2**300000+5)-2**300000": 5, "2**521000-2**520479": None, "(2**300000-1)//2**300000": 0, "(0-2**300000)//2**600000": -1,
                 "(2**300000*3+2)//2**300000": 3, "(1-2)**(3**400000)": -1, "(1-2)**(2**400000)": 1, "(9**9**9+7)-(9**9**9-2**90)": 7 + 2**90}
    assert {t: evaluate(t) for t in cancelled} == cancelled
    rows = [("2*(3+4)*1", 14.0, [1, 2, 3, 4], 1.0), ("(3+4)*2", 14.0, [2, 3, 4], 0.0), ("3+4", 7.0, [3, 3], 0.0), ("3+4 = 7", 7.0, [3, 4], 0.0), ("answer: 4+3", 7.0, [3, 4], 1.0), ("3+4", 8.0, [3, 4], 0.0), ("3+4", None, [3, 4], None)]
    df = spark.createDataFrame([("equation", *r) for r in rows], "category string, completion string, target double, numbers array<int>, want double")
    assert [(r.equation_reward, r.want) for r in R.score_equation(df).collect()] == [(r[3], r[3]) for r in rows]


def test_code(spark):
    block = lambda s: f"```python\n{s}\n```"
    runs = spark.createDataFrame([("a", "success", "1\n"), ("b", "success", "1"), ("c", "success", "2"), ("d", "timeout", "")], "snippet string, status string, stdout string")
    rows = [("code", block("a"), block("b"), 1.0), ("code", block("a"), block("c"), 0.4), ("code", block("d"), block("a"), -0.3), ("code", "x", block("a"), -0.3),
            ("code", block("a"), "x", None), ("code", block("a"), block("d"), None), ("code", block("zz"), block("a"), -0.3), ("math", block("a"), block("a"), None), ("code", block("a"), "", None)]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, category string, completion string, solution string")
    got = {r.i: r.code_execution_reward for r in R.score_code(df, runs, CodeOptions(0.1, 0.3)).collect()}
    assert [got[i] for i in range(len(rows))] == [r[3] for r in rows]


def test_options_are_checked():
    for build in (
        lambda: KVOptions(coarse_match_cap=1.5), lambda: KVOptions(kv_value_weight=0.9), lambda: KVOptions(max_leaf_count_ratio=0), lambda: KVOptions(allowed_sibling_keys="x"),
        lambda: SelectionOptions(target_quality_aggregation="max"), lambda: BBoxOptions(schema_keys={"page": ()}), lambda: BBoxOptions(status_values={"found": ("",)}),
    ):
        with pytest.raises(ValueError):
            build()


def test_long_texts_are_not_remembered():
    """Whole documents would fill a worker's memory; values repeat."""
    jsonx._clean_memo.cache_clear(), jsonx._coarse_memo.cache_clear()
    assert [jsonx.coarse(t * 100) for t in ("A, b ", "한 “Ａ” ")] == ["ab" * 100, "한a" * 100]
    assert jsonx._clean_memo.cache_info().currsize == jsonx._coarse_memo.cache_info().currsize == 0
    assert [jsonx.clean(t) for t in ("Ab9", "a_B", "", " x. ", "٣")] == ["ab9", "a_b", "", "x", "٣"]


def test_stems_are_taken_of_words_that_may_match_only(monkeypatch):
    import random

    from tunetables.functions import overlap

    rng = random.Random(4)
    parts = "a e i o y b l s t z ing ed ies eed ational logi alli ness ss".split()
    made = {"".join(rng.choices(parts, k=rng.randint(2, 5))) for _ in range(5000)}
    assert all((s := overlap.stem(w))[:2] == w[:2] or s == w[0] for w in made if len(w) > 3 and w not in overlap.IRREGULAR)
    for kind in ("1", "l"):
        for _ in range(50):
            a, b = (" ".join(rng.sample(sorted(made), 40)) for _ in range(2))
            b += " " + " ".join(a.split()[::3]) + " die a"
            x, y = overlap.words(a, True), overlap.words(b, True)
            shared = overlap.lcs_length(x, y) if kind == "l" else sum(min(x.count(w), y.count(w)) for w in set(x))
            assert overlap.rouge_f(a, b, kind, True) == pytest.approx(2 * shared / (len(x) + len(y)))
    taken, stem = [], overlap.stem
    monkeypatch.setattr(overlap, "stem", lambda w: taken.append(w) or stem(w))
    assert overlap.rouge_f("walking zebras jumped over quiet rivers", "walked there", "l", True) == pytest.approx(2 / 8)
    assert "zebras" not in taken and "walking" in taken


def test_facts_hold_what_the_caps_read_only(spark):
    """Of coarse values and table rows the repeats, and nothing for other roots."""
    from tunetables.operators.kv import _FACTS, _facts

    names = [f.name for f in _FACTS]
    rows = [{"a": "X", "b": 1}, {"a": "x.", "b": "1"}, {"b": 2, "a": None}]
    table = dict(zip(names, _facts({"tables": {"t": {"rows": rows}}}, "tables")))
    assert table["coarse"] == ["2 x", "2 1"] and [s["n"] for s in table["signatures"]] == [2] and table["n"] == table["n_leaves"] == 6
    results = dict(zip(names, _facts({"results": [{"target_id": 1, "text": "same"}, {"target_id": 2, "text": "same"}]}, "results")))
    assert results["coarse"] == results["loose"] == results["tops"] == [] and len(results["placed"]) == 2


def test_documents_are_read_in_slices(spark, monkeypatch):
    from tunetables.operators import kv, selection

    monkeypatch.setattr(kv, "_SLICE", 3), monkeypatch.setattr(selection, "_SLICE", 3)
    answers = ['{"kv":{"a":"%d"}}<stop>' % (i % 4) if i % 5 else None for i in range(10)]
    df = spark.createDataFrame([(i, "kv", t, '{"kv":{"a":"1"}}') for i, t in enumerate(answers)], "id int, category string, completion string, solution string")
    got = {r.id: r.kv_reward for r in kv.score_kv(df.coalesce(1)).collect()}
    assert got == {i: 0.0 if not i % 5 else float(i % 4 == 1) for i in range(10)}
    label = '{"grounding":[{"target_id":"t","selected_ids":[1]}]}'
    df = spark.createDataFrame([(i, "doc_evidence" if i % 4 else "math", '{"grounding":{"t":[%d]}}' % (i % 2), label) for i in range(10)], "id int, category string, completion string, solution string")
    got = {r.id: r.grounding_selection_reward for r in selection.score_selection(df.coalesce(1)).collect()}
    assert [i for i, v in got.items() if v is None] == [0, 4, 8] and {got[i] for i in (1, 3, 5, 7, 9)} == {1.0}


def test_kv_is_one_pass_that_is_compiled(spark, tmp_path, capsys):
    """Documents go to Python once and come back as numbers; the JVM's part stays below
    8,000 bytes a method, beyond which HotSpot interprets it row after row."""
    import re

    from tunetables.operators.kv import _PAIR
    from tunetables.plans.scoring import kv_table_reward

    assert not any(f.type.num_fields for f in _PAIR)
    lines = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"
    spark.createDataFrame([(i, 1, i + 7, i % 3, 5.0) for i in range(10)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    scored = kv_table_reward(spark, str(tmp_path))
    scored.explain("codegen")
    plan = capsys.readouterr().out
    assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", plan))
    scored.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    want = {0: 1.0, 1: 0.6, 2: 0.5, 3: 0.75, 4: 0.6}  # exact, a row missing, a column named otherwise, a null, a row repeated
    assert {r.k: r.kv_reward for r in scored.collect()} == {i: want[(i + 1) % 5] for i in range(10)}


def test_tables_compared_by_cell_and_by_facts():
    """Both ways give one result, whatever the tables hold."""
    from tunetables.operators import kv

    rng, met, bounded = random.Random(11), 0, 0
    values = [*WORDS, None, "None", "none", "!!", "", 7, 7.0, True, [1], {}, "\u200b", "a b c d", "a b c e"]

    def changed(node):
        if isinstance(node, dict):
            return {k: changed(v) for k, v in node.items() if rng.random() < 0.95}
        if isinstance(node, list):
            return [changed(v) for v in node] + [v for v in node if rng.random() < 0.1]
        return rng.choice(values) if rng.random() < 0.3 else node

    for options in ({}, {"max_serialized_length_ratio": 0.9, "max_leaf_count_ratio": 0.8}, {"non_exact_value_cap": 0.9, "weighted_fuzzy_match_threshold": 0.2}, {"use_weighted_fuzzy_f1": False, "score_threshold": 0.4}):
        opt = KVOptions(**options)
        for _ in range(400):
            gold = {"tables": random_tables(rng)}
            text = json.dumps(gold, ensure_ascii=rng.random() < 0.5)
            pred = rng.choice([gold, changed(gold), changed(gold), {"tables": random_tables(rng)}])
            head = text if pred is gold else json.dumps(pred, ensure_ascii=rng.random() < 0.5)
            if not isinstance(pred.get("tables"), dict):
                continue
            made = [kv._Gold(text, opt) for _ in range(2)]
            cells = kv._compare_tables(pred["tables"], head, made[0], True, head == text, opt)
            facts = kv._compare(pred, head, made[1], True, head == text, opt)
            assert kv.Compared(*cells) == kv.Compared(*facts), (head, text, options)
            met += 0 < kv.Compared(*cells).placed < len(head)
            length, leaves = made[0].least()
            assert length <= jsonx.json_length(gold["tables"]) and leaves <= jsonx.count_leaves(gold["tables"])
            bounded += length > 0
    assert met > 500 and bounded > 500


def test_texts_left_over_are_the_last_ones():
    from tunetables.operators.kv import _unmatched

    rng = random.Random(2)
    for size in (6, 40):
        for _ in range(200):
            pred, gold = ([rng.choice(["a", "b", None, "", "c"]) for _ in range(rng.randint(0, size))] for _ in range(2))
            left, rest = _unmatched(pred, gold)
            for mine, others, over in ((pred, gold, left), (gold, pred, rest)):
                want = [t for k, t in enumerate(mine) if mine[: k + 1].count(t) > others.count(t)]
                assert over == want


def test_text_bounds_hold():
    rng = random.Random(5)
    values = [0, -0, 10**40, 1e15, 1e-7, 0.5, 2.0, True, None, "", "é", "\u200b", 'q"', "b\\", "\n\x01", "a,b:c", [], {}, float("inf")]

    def tree(depth=0):
        kind = rng.random()
        if depth < 3 and kind < 0.4:
            return {rng.choice("abcé"): tree(depth + 1) for _ in range(rng.randint(0, 3))}
        return [tree(depth + 1) for _ in range(rng.randint(0, 3))] if depth < 3 and kind < 0.7 else rng.choice(values)

    bounded = 0
    for _ in range(1000):
        node = tree()
        for written in ({}, {"ensure_ascii": False}, {"separators": (",", ":")}, {"indent": 2}):
            text = json.dumps(node, **written)
            length, leaves = jsonx.text_bounds(text)
            assert jsonx.json_length(json.loads(text)) <= length and jsonx.count_leaves(json.loads(text)) <= leaves
            bounded += length < float("inf")
    assert bounded > 1000 and jsonx.text_bounds('{"a":1e15}')[0] == float("inf")


def test_documents_read_at_once_are_those_of_the_readings():
    """What closes like a document is read whole first; the rest goes the slow way."""
    for text in ['{"a":1}', ' {"a":1}', '{"a":1} x}', "[1]", "[1]]", "1]", "null", "{}", '{"a":1}\u3000', "\ufeff{}", '```json\n{"a":1}\n```', 'see {"a":1}', "", "}", "[" * 10**5 + "]" * 10**5]:
        for loads, readings in ((jsonx.loads_strict, jsonx.strict_readings), (jsonx.loads_lenient, jsonx.lenient_readings)):
            want = None
            for stretch in readings(text):
                try:
                    want = json.loads(stretch)
                except (ValueError, RecursionError):
                    continue
                if want is not None:
                    break
            assert loads(text) == want, text[:20]
