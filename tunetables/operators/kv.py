"""Key-value, table and result-list extraction scores.

Rows are independent, so nothing here shuffles: one Arrow pass reads the two
JSON texts of a row and sends back counts, matched similarities and what the
caps ask for, a few numbers whatever the documents hold; caps and scores are
Column expressions over them. Equal texts pair off by their counts (linear in
the leaves), and only leaves left over on *both* sides are compared.
"""

from __future__ import annotations

import gc
import re
from collections import defaultdict, namedtuple
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from difflib import SequenceMatcher
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.config import Extraction, KVOptions
from tunetables.functions import jsonx
from tunetables.functions import text as T

#: rows read at once
_SLICE = 500
_STRINGS = pa.list_(pa.string())
_FACTS = pa.struct(
    [
        ("is_object", pa.bool_()),
        ("keys", _STRINGS),
        ("root_ok", pa.bool_()),
        ("n_leaves", pa.int32()),  # by the walk the length rule counts with
        ("n", pa.int32()),  # leaves to match
        ("loose", _STRINGS),  # match keys without and
        ("placed", _STRINGS),  # with the path, see leaf_keys
        ("coarse", _STRINGS),  # occurrence number and coarse text, from the second occurrence on
        ("tops", _STRINGS),
        ("places_repeat", pa.bool_()),
        ("invalid", pa.int32()),
        ("repeats", pa.int32()),
        (
            "tables",
            pa.list_(pa.struct([("name", pa.string()), ("columns", _STRINGS), ("rows", pa.int32())])),
        ),
        ("signatures", pa.list_(pa.struct([("name", pa.string()), ("row", pa.string()), ("n", pa.int32())]))),
    ]
)
Facts = namedtuple("Facts", [f.name for f in _FACTS])
#: both documents of a row, compared
_PAIR = pa.struct(
    [
        ("parsed", pa.bool_()),
        ("cut", pa.bool_()),
        ("trailing", pa.string()),
        ("root", pa.string()),
        ("fits", pa.bool_()),  # an object of allowed keys, the root of its kind
        ("longer", pa.bool_()),  # than the length ratio allows
        ("more", pa.bool_()),  # leaves, by the walk that the length rule counts with
        ("n_pred", pa.int32()),  # leaves to match
        ("n_gold", pa.int32()),
        ("loose", pa.float64()),  # matched without and
        ("placed", pa.float64()),  # with the path
        ("values_repeat", pa.bool_()),
        ("places_repeat", pa.bool_()),
        ("apart", pa.bool_()),  # no top level step in common
        ("invalid", pa.bool_()),
        ("names_differ", pa.bool_()),
        ("columns_differ", pa.bool_()),
        ("row_counts_differ", pa.bool_()),
        ("rows_repeat", pa.bool_()),
    ]
)
_DDL = {pa.bool_(): "boolean", pa.string(): "string", pa.int32(): "int", pa.float64(): "double"}
_PAIR_DDL = f"struct<{','.join(f'{f.name}:{_DDL[f.type]}' for f in _PAIR)}>"
#: its fields beyond the head, which tells how the answer was read
Compared = namedtuple("Compared", [f.name for f in _PAIR][4:], defaults=(None,) * (_PAIR.num_fields - 4))
_BLANK = Compared()


def leaf_keys(leaves: list[tuple[str, str | None]]) -> list[str]:
    """One string per (place, text): kind (T text, N null) with its occurrence
    number, length of the place, place, text. Numbered like this, a multiset
    intersection is a plain set operation on strings, which hashes."""
    seen: dict[tuple, int] = {}
    out = []
    for leaf in leaves:
        n = seen[leaf] = seen.get(leaf, 0) + 1
        where, text = leaf
        out.append(f"N{n} {len(where)} {where}" if text is None else f"T{n} {len(where)} {where}{text}")
    return out


def _read_key(key: str) -> tuple[str, str | None]:
    head, length, rest = key.split(" ", 2)
    return rest[: int(length)], None if head[0] == "N" else rest[int(length) :]


def _facts(value: Any, root: str) -> Facts:
    node = value.get(root) if isinstance(value, dict) else None
    invalid, repeats, shapes, signatures = 0, 0, None, None
    if root == "results":
        leaves, invalid, repeats = jsonx.flatten_results(node)
    elif root == "tables":
        read = jsonx.read_tables(node)
        leaves = list(jsonx.table_leaves(read))
        shapes, signatures = jsonx.table_facts(read)
    else:
        leaves = list(jsonx.flatten_kv(node))
    is_object, is_table = isinstance(value, dict), root == "tables"
    texts = [None if v is None else str(v).strip() for _, _, v in leaves]
    # what the caps of the other roots read is left empty
    loose, rough, tops, repeat = [], [], [], False
    if is_table:
        index = [f"{jsonx.SEP}{i}" for _, i, _ in leaves]
        places = {path: jsonx.place(path) for path in {path for path, _, _ in leaves}}
        placed = leaf_keys([(places[path] + i, t) for (path, _, _), i, t in zip(leaves, index, texts)])
        loose = leaf_keys(list(zip(index, texts)))
    else:
        places = [jsonx.place(path) for path, _, _ in leaves]
        placed = leaf_keys(list(zip(places, texts)))
        if root == "kv":
            loose = leaf_keys([("", t) for t in texts])
            tops = list({path[0] for path, _, _ in leaves if path})
            repeat = len({(p, i) for p, (_, i, _) in zip(places, leaves)}) < len(leaves)
    if root != "results":
        seen: dict[str, int] = {}
        for text in texts:
            form = jsonx.coarse(text) if text else ""
            if form:
                n = seen[form] = seen.get(form, 0) + 1
                if n > 1:
                    rough.append(f"{n} {form}")
    return Facts(
        is_object,
        list(value) if is_object else [],
        isinstance(node, list if root == "results" else dict),
        jsonx.count_leaves(node) if is_table else len(leaves),
        len(leaves),
        loose,
        placed,
        rough,
        tops,
        repeat,
        invalid,
        repeats,
        shapes,
        signatures,
    )


class _Gold:
    """A solution, read as far as its comparisons need it."""

    __slots__ = ("text", "value", "root", "node", "grid", "_least", "_length", "_leaves", "_facts", "_repeats")

    def __init__(self, text: str | None, opt: KVOptions):
        self.text, self.value = text, jsonx.solution_value(text, opt.required_stop_token)
        self.root = jsonx.root_name(self.value)
        self._least = self._length = self._leaves = self._facts = self._repeats = None
        if self.root:
            self.node = self.value[self.root]
        if self.root == "tables":
            self.grid = jsonx.grid(self.node)

    def least(self) -> tuple[int, int]:
        self._least = self._least or jsonx.least_sizes(self.text, self.grid)
        return self._least

    def longest(self, opt: KVOptions) -> float:
        """Length beyond which an answer is too long, and the same of leaves."""
        if self._length is None:
            self._length = opt.max_serialized_length_ratio * max(jsonx.json_length(self.node), 1)
        return self._length

    def most_leaves(self, opt: KVOptions) -> float:
        if self._leaves is None:
            self._leaves = opt.max_leaf_count_ratio * jsonx.count_leaves(self.node)
        return self._leaves

    def facts(self) -> Facts:
        self._facts = self._facts or _facts(self.value, self.root)
        return self._facts

    def repeats(self) -> tuple[dict[str, int], set[tuple]]:
        """How often each coarse form occurs, and signatures of rows that repeat."""
        if self._repeats is None:
            forms, rows = jsonx.grid_forms(self.grid)
            self._repeats = _counts(forms), _signatures(self.node, self.node) if rows else set()
        return self._repeats


def _counts(items: Iterable) -> dict:
    out: dict = {}
    for item in items:
        out[item] = out.get(item, 0) + 1
    return out


def _signatures(tables: dict, names: Iterable[str]) -> set[tuple]:
    """Of the rows that repeat one before them, in the tables of these names."""
    listed = [s for name in tables if name in names for s in jsonx.repeated_rows(name, jsonx.table_rows(tables[name]))]
    return {(s["name"], s["row"], s["n"]) for s in listed}


def _compare(value: Any, head: str, gold: _Gold, known: bool, same: bool, opt: KVOptions) -> tuple:
    """The fields of ``Compared``, from the facts of both documents."""
    g, root = gold.facts(), gold.root
    p = g if same else _facts(value, root)
    both = root == "tables" and p.root_ok and g.root_ok
    node = value.get(root) if isinstance(value, dict) else None
    return (
        known and p.root_ok,
        _longer(node, head, gold.longest(opt)),
        0 < opt.max_leaf_count_ratio * g.n_leaves < p.n_leaves,
        p.n,
        g.n,
        matched(p.loose, g.loose, opt),
        matched(p.placed, g.placed, opt),
        (both or root == "kv") and not set(p.coarse) <= set(g.coarse),
        p.places_repeat or p.repeats + g.repeats > 0,
        bool(p.tops and g.tops) and set(p.tops).isdisjoint(g.tops),
        p.invalid + g.invalid > 0,
        *(_table_faults(p, g) if both else (False,) * 4),
    )


def _longer(node: Any, head: str, longest: float) -> bool:
    """A missing node counts as a null."""
    return (node is None or jsonx.text_bounds(head)[0] > longest) and jsonx.json_length(node) > longest


def _table_faults(p: Facts, g: Facts) -> tuple[bool, bool, bool, bool]:
    mine, theirs = ({t["name"]: t for t in f.tables} for f in (p, g))
    shared = [(t, theirs[name]) for name, t in mine.items() if name in theirs]
    again, known = ({(s["name"], s["row"], s["n"]) for s in f.signatures if s["name"] in theirs} for f in (p, g))
    return (
        mine.keys() != theirs.keys(),
        any(a["columns"] != b["columns"] for a, b in shared),
        any(a["rows"] != b["rows"] for a, b in shared),
        not again <= known,
    )


def _compare_tables(tables: dict, head: str, gold: _Gold, known: bool, same: bool, opt: KVOptions) -> tuple:
    """The same for two objects of tables, cell by cell: a place has one leaf a side,
    so leaves need no keys. What cannot change the result is not worked out."""
    g = gold.grid
    if same and opt.max_serialized_length_ratio >= 1 and opt.max_leaf_count_ratio >= 1:
        return (known, False, False, g.n, g.n, float(g.n), float(g.n), *(False,) * 8)
    p = jsonx.grid(tables)
    placed, columns_differ, row_counts_differ = _met_cells(p, g, opt)
    forms, rows_repeat = jsonx.grid_forms(p)
    values_repeat = len(set(forms)) < len(forms)
    if values_repeat:
        wanted = gold.repeats()[0]
        values_repeat = any(n > max(wanted.get(form, 0), 1) for form, n in _counts(forms).items())
    if rows_repeat:
        again = _signatures(tables, g.tables)
        rows_repeat = bool(again) and not again <= gold.repeats()[1]
    length, leaves = jsonx.text_bounds(head)
    least_length, least_leaves = gold.least()
    longer = length > opt.max_serialized_length_ratio * least_length
    more = leaves > opt.max_leaf_count_ratio * least_leaves
    return (
        known,
        longer and _longer(tables, head, gold.longest(opt)),
        more and 0 < gold.most_leaves(opt) < jsonx.count_leaves(tables),
        p.n,
        g.n,
        _met_lines(p.lines, g.lines, opt),
        placed,
        values_repeat,
        False,
        False,
        False,
        p.tables.keys() != g.tables.keys(),
        columns_differ,
        row_counts_differ,
        rows_repeat,
    )


@contextmanager
def _no_collection() -> Iterator[None]:
    """Documents hold no cycles: the collector would walk them for nothing."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def read_documents(answer: Column, solution: Column, opt: KVOptions) -> Column:
    """Both documents of a row in one Arrow pass; null answers are passed over."""
    stop = opt.required_stop_token
    loads = jsonx.loads_strict if opt.strict_json else jsonx.loads_lenient
    exact = _exact_first(opt)
    allowed = {root: {root, *opt.allowed_sibling_keys} for root in ("kv", "tables", "results")}

    def row(text: str | None, gold_text: str | None, golds: dict) -> tuple | None:
        if text is None:
            return None
        gold = golds.get(gold_text)
        if gold is None:  # the completions of one prompt share it
            gold = golds[gold_text] = _Gold(gold_text, opt)
        text = text.strip()
        cut = jsonx.split_at_stop(text, stop, loads)
        value, head, trailing = cut or (loads(text), text, "")
        rest, root = _BLANK, gold.root
        if value is not None and root is not None:
            known = isinstance(value, dict) and value.keys() <= allowed[root]
            same = opt.strict_json and head == gold_text
            tables = value.get("tables") if root == "tables" and isinstance(value, dict) else None
            if exact and isinstance(tables, dict):
                rest = _compare_tables(tables, head, gold, known, same, opt)
            else:
                rest = _compare(value, head, gold, known, same, opt)
        elif root == "results":  # faults of the solution count without an answer
            g = gold.facts()
            rest = Compared(places_repeat=g.repeats > 0, invalid=g.invalid > 0)
        return (value is not None, cut is not None, trailing, root, *rest)

    @F.arrow_udf(_PAIR_DDL)
    def run(a: pa.Array, s: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(1, len(a)), _SLICE):  # few objects live at once
            golds: dict = {}
            pairs = zip(a.slice(at, _SLICE).to_pylist(), s.slice(at, _SLICE).to_pylist())
            with _no_collection():
                parts.append(jsonx.struct_array([row(x, y, golds) for x, y in pairs], _PAIR))
        return pa.concat_arrays(parts)

    return run(answer, solution)


# ------------------------------------------------------------------ caps
def format_cap(answer: Column, parsed: Column, cut: Column, trailing: Column, opt: KVOptions) -> Column:
    return (
        F.when(cut & (trailing == ""), 1.0)
        .when(cut & trailing.contains(opt.required_stop_token), opt.middle_or_multiple_stop_cap)
        .when(cut, opt.trailing_text_cap)
        .when(parsed | ~answer.contains(opt.required_stop_token), opt.missing_stop_cap)
        .otherwise(opt.middle_or_multiple_stop_cap)
    )


def _cap(condition: Column, cap: float) -> Column:
    return F.when(condition, F.lit(float(cap))).otherwise(F.lit(1.0))


def length_cap(doc: Column, opt: KVOptions) -> Column:
    return F.least(_cap(doc["longer"], opt.length_ratio_cap), _cap(doc["more"], opt.leaf_count_ratio_cap))


def leaf_balance_cap(doc: Column, opt: KVOptions) -> Column:
    p, g = doc["n_pred"].cast("double"), doc["n_gold"].cast("double")
    extra = (g > 0) & (F.try_divide(p - g, g) > opt.extra_leaf_ratio_threshold)
    missing = (g > 0) & (F.try_divide(g - p, g) > opt.missing_leaf_ratio_threshold)
    return F.least(
        _cap(extra, opt.extra_leaf_cap),
        _cap(missing, opt.missing_leaf_cap),
    )


def kv_structure_cap(doc: Column, opt: KVOptions) -> Column:
    return F.least(
        _cap(doc["places_repeat"], opt.duplicate_path_cap),
        _cap(doc["values_repeat"], opt.duplicate_value_cap),
        _cap(doc["apart"], opt.kv_top_level_path_mismatch_cap),
    )


def table_structure_cap(doc: Column, opt: KVOptions) -> Column:
    return F.least(
        _cap(doc["names_differ"], opt.table_name_mismatch_cap),
        _cap(doc["columns_differ"], opt.table_column_mismatch_cap),
        _cap(doc["row_counts_differ"], opt.table_row_count_mismatch_cap),
        _cap(doc["rows_repeat"], opt.duplicate_table_row_cap),
        _cap(doc["values_repeat"], opt.duplicate_value_cap),
    )


def results_structure_cap(doc: Column, opt: KVOptions) -> Column:
    return F.least(
        _cap(doc["invalid"], opt.root_mismatch_cap),
        _cap(doc["places_repeat"], opt.duplicate_path_cap),
    )


# ------------------------------------------------------------ similarity
def similarity(pred: str | None, gold: str | None, opt: KVOptions, floor: float = 0.0) -> float:
    """Value similarity; a result below ``floor`` may be returned as 0."""
    if (pred is None) != (gold is None):
        return opt.empty_value_mismatch_cap
    if pred == gold:
        return 1.0
    if not pred or not gold:
        return 0.0
    a, b = jsonx.clean(pred), jsonx.clean(gold)
    if a == b:
        return min(opt.normalized_match_cap, opt.non_exact_value_cap)
    if jsonx.coarse(pred) == jsonx.coarse(gold):
        cap = min(opt.coarse_match_cap, opt.non_exact_value_cap)
        return min(cap, opt.numeric_punctuation_mismatch_cap) if _punctuation_differs(pred, gold) else cap
    matcher = SequenceMatcher(a=a, b=b)
    # both quick ratios are upper bounds of the ratio, so this loses nothing
    if min(matcher.real_quick_ratio(), opt.non_exact_value_cap) < floor or matcher.quick_ratio() < floor:
        return 0.0
    return min(matcher.ratio(), opt.non_exact_value_cap)


def _punctuation_differs(a: str, b: str) -> bool:
    marks = [set(re.findall(r"(?<=\d)[,.:](?=\d)", t)) for t in (a, b)]
    return all(re.search(r"\d", t) for t in (a, b)) and marks[0] != marks[1]


def value_similarity(pred: Column, gold: Column, opt: KVOptions = KVOptions()) -> Column:
    @F.arrow_udf("double")
    def run(p: pa.Array, g: pa.Array) -> pa.Array:
        pairs = zip(p.to_pylist(), g.to_pylist())
        out = [similarity(*(None if t is None else t.strip() for t in pair), opt) for pair in pairs]
        return pa.array(out, pa.float64())

    return run(pred, gold)


def _exact_first(opt: KVOptions) -> bool:
    """Equal texts score 1 and nothing else can: they pair off before anything is compared."""
    return opt.non_exact_value_cap < 1.0 and opt.empty_value_mismatch_cap < 1.0


def _pair_off(pred: list[str | None], gold: list[str | None], opt: KVOptions) -> list[float]:
    """Similarities of the pairs of one place: best pairs first, then gold order, then
    prediction order; one to one."""
    found = []
    for i, text in enumerate(gold):
        for j, other in enumerate(pred):
            s = similarity(other, text, opt, opt.threshold)
            if s >= opt.threshold:
                found.append((-s, i, j))
    taken, used_gold, used_pred = [], set(), set()
    for s, i, j in sorted(found):
        if i not in used_gold and j not in used_pred:
            used_gold.add(i)
            used_pred.add(j)
            taken.append(-s)
    return taken


def _total(hits: int, taken: list[float], opt: KVOptions) -> float:
    """Equal pairs and similar ones; the greatest first, so that the sum does not turn
    on the order of the places."""
    if not (taken and opt.use_weighted_fuzzy_f1):
        return float(hits + len(taken))
    total = 0.0
    for s in sorted(taken, reverse=True):
        total += s
    return hits + total


def matched(pred_keys: list[str], gold_keys: list[str], opt: KVOptions) -> float:
    """Greedy one-to-one matches of two lists of leaf keys; equal leaves have equal
    keys, as these are numbered."""
    if not (pred_keys and gold_keys):
        return 0.0
    hits = 0
    if _exact_first(opt):
        if pred_keys == gold_keys:
            return float(len(gold_keys))
        mine, theirs = set(pred_keys), set(gold_keys)
        hits = len(mine & theirs)
        pred_keys = [k for k in pred_keys if k not in theirs]
        gold_keys = [k for k in gold_keys if k not in mine]
    taken: list[float] = []
    if pred_keys and gold_keys:
        by_place: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        for side, keys in enumerate((pred_keys, gold_keys)):
            for where, text in map(_read_key, keys):
                by_place[where][side].append(text)
        for pred, gold in by_place.values():
            taken += _pair_off(pred, gold, opt)
    return _total(hits, taken, opt)


def _unmatched(pred: list[str | None], gold: list[str | None]) -> tuple[list, list]:
    """Occurrences of each text beyond those on the other side."""
    if len(gold) < 16:
        rest, left = gold.copy(), []
        for text in pred:
            if text in rest:
                rest.remove(text)
            else:
                left.append(text)
        return left, rest
    counts, left = _counts(gold), []
    for text in pred:
        if counts.get(text, 0) > 0:
            counts[text] -= 1
        else:
            left.append(text)
    rest = []
    if len(gold) + len(left) > len(pred):  # the last ones, as many as were not counted off
        for text in reversed(gold):
            if counts[text] > 0:
                counts[text] -= 1
                rest.append(text)
    return left, rest[::-1]


def _met_lines(pred: list[list], gold: list[list], opt: KVOptions) -> float:
    """Matches of texts of one row number."""
    hits, taken = 0, []
    for p, g in zip(pred, gold):
        if p == g:
            hits += len(p)
            continue
        left, missed = _unmatched(p, g)
        hits += len(p) - len(left)
        if left and missed:
            taken += _pair_off(left, missed, opt)
    return _total(hits, taken, opt)


def _met_cells(p: jsonx.Grid, g: jsonx.Grid, opt: KVOptions) -> tuple[float, bool, bool]:
    """Matches of texts of one cell; whether columns, and numbers of rows, of tables of
    one name differ."""
    hits, taken, columns_differ, row_counts_differ = 0, [], False, False
    for name, (columns, rows) in p.tables.items():
        if name not in g.tables:
            continue
        gold_columns, gold_rows = g.tables[name]
        if len(rows) != len(gold_rows):
            row_counts_differ = True
        elif not rows:
            hits += 1  # a table without rows is one leaf
        if columns != gold_columns:
            columns_differ = columns_differ or set(columns) != set(gold_columns)
            at = {c: k for k, c in enumerate(gold_columns)}
            mine, theirs = [j for j, c in enumerate(columns) if c in at], [at[c] for c in columns if c in at]
            rows, gold_rows = [[row[j] for j in mine] for row in rows], [[row[k] for k in theirs] for row in gold_rows]
        for cells, wanted in zip(rows, gold_rows):
            if cells == wanted:
                hits += len(cells)
                continue
            for text, other in zip(cells, wanted):
                if text == other:
                    hits += 1
                elif (s := similarity(text, other, opt, opt.threshold)) >= opt.threshold:
                    taken.append(s)
    return _total(hits, taken, opt), columns_differ, row_counts_differ


def fuzzy_f1(matches: Column, n_pred: Column, n_gold: Column) -> Column:
    """2pr/(p+r) with p = m/|pred| and r = m/|gold|."""
    f1 = F.try_divide(2.0 * matches, (n_pred + n_gold).cast("double"))
    return (
        F.when((n_pred == 0) & (n_gold == 0), 1.0)
        .when((n_pred == 0) | (n_gold == 0), 0.0)
        .otherwise(f1)
    )


def clip01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def content_score(doc: Column, opt: KVOptions) -> Column:
    """Key-value: values alone and values at their paths. Tables: values by row
    and by cell. Results: texts by target only."""
    root = doc["root"]
    loose, placed = (fuzzy_f1(doc[f], doc["n_pred"], doc["n_gold"]) for f in ("loose", "placed"))
    loose_weight = F.when(root == "kv", opt.kv_value_weight).when(root == "tables", opt.table_value_weight).otherwise(0.0)
    placed_weight = F.when(root == "kv", opt.kv_path_weight).when(root == "tables", opt.table_structure_weight).otherwise(1.0)
    return clip01(loose_weight * loose + placed_weight * placed)


def structure_cap(doc: Column, opt: KVOptions) -> Column:
    root = doc["root"]
    of_root = (
        F.when(root == "kv", kv_structure_cap(doc, opt))
        .when(root == "tables", table_structure_cap(doc, opt))
        .otherwise(results_structure_cap(doc, opt))
    )
    return F.when(root.isNotNull(), F.least(leaf_balance_cap(doc, opt), of_root))


def score_kv(
    df: DataFrame,
    opt: KVOptions = KVOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str = "kv_reward",
    keep_parts: bool = False,
) -> DataFrame:
    """min(content, format, root, length and structure caps), clipped to [0, 1];
    null for other categories, blank or unreadable solutions."""
    applies = T.has_category_token(F.col(category), opt.category_token) & (F.col(solution) != "")
    # columns of their own, as the next step names them many times: methods of over 8,000 bytes are not compiled
    said, stop = F.col("_said"), opt.required_stop_token
    df = df.withColumn("_said", F.when(applies, F.coalesce(T.content(df, completion), F.lit(""))).otherwise(""))
    df = df.withColumn("_said", F.when(T.may_hold_answer(said, ext), T.extract_answer(said, ext)).otherwise(said))
    # the texts are stripped when they are read
    whole = said if stop == stop.strip() else T.strip(said)
    answer = F.when(T.may_hold_keywords(said), T.split_on_keywords(said)).otherwise(whole)
    df = df.withColumn("_answer", F.when(applies, answer)).drop("_said")
    df = df.withColumn("_doc", read_documents(F.col("_answer"), F.col(solution), opt))
    doc = F.col("_doc")
    df = df.withColumns(
        {
            "_content": content_score(doc, opt),
            "_format_cap": format_cap(F.col("_answer"), doc["parsed"], doc["cut"], doc["trailing"], opt),
            "_root_cap": _cap(~doc["fits"], opt.root_mismatch_cap),
            "_length_cap": length_cap(doc, opt),
            "_structure_cap": structure_cap(doc, opt),
        }
    )
    unit = F.least("_content", "_format_cap", "_root_cap", "_length_cap", "_structure_cap")
    value = (
        F.when(F.col("_answer").isNull(), F.lit(None).cast("double"))
        .when(~doc["parsed"], F.lit(float(opt.invalid_json_reward)))
        .when(doc["root"].isNotNull(), clip01(unit))
    )
    df = df.withColumn(output, value)
    parts = ["_content", "_format_cap", "_root_cap", "_length_cap", "_structure_cap"]
    return df.drop("_answer", "_doc") if keep_parts else df.drop("_answer", "_doc", *parts)
