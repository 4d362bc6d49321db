"""JSON documents to typed columns.

Spark's JSON functions accept trailing text and reject repeated keys, while the
scoring rules turn on "is this whole text one JSON document". So the text is
read by ``json`` in Arrow batches, once per document, and comes out as flat
typed arrays; everything after that is Column expressions.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x1f"
#: rows read at once
_SLICE = 500
# How fenced objects are told.
_FENCED_WHOLE = re.compile(r"```(?:json)?\s*(\{.*\})\s*```", re.DOTALL | re.IGNORECASE)
_FENCED_FIRST = re.compile(r"```(?:json)?\s*(\{.*?\})\s*```", re.DOTALL | re.IGNORECASE)

#: the stretches of a text that may be its document, the best first
Readings = Callable[[str], Iterator[str]]


# ---------------------------------------------------------------- parsing
def strict_readings(text: str) -> Iterator[str]:
    """The whole text, or the whole text as one fenced object."""
    yield text.strip()
    yield from (m[1] for m in [_FENCED_WHOLE.fullmatch(text.strip())] if m)


def lenient_readings(text: str) -> Iterator[str]:
    """The whole text, the first fenced object, first '{' to last '}'."""
    yield text
    yield from (m[1] for m in [_FENCED_FIRST.search(text)] if m)
    opened, closed = text.partition("{"), text.rpartition("}")
    if opened[1] and closed[1] and len(opened[0]) < len(closed[0]):
        yield text[len(opened[0]) : len(closed[0]) + 1]


_READ = json.JSONDecoder().raw_decode


def document(text: str | None, readings: Readings) -> Any:
    """The value of the first reading that is a JSON document other than null."""
    if text and text[-1] in "}]":  # mostly the whole text is the document, and the first reading in either order
        try:
            value, end = _READ(text)
        except (ValueError, RecursionError):
            end = -1
        if end == len(text):
            return value
    for stretch in readings(text) if text is not None else ():
        try:
            value = json.loads(stretch)
        except (ValueError, RecursionError):
            continue
        if value is not None:
            return value
    return None


def loads_strict(text: str | None) -> Any:
    return document(text, strict_readings)


def loads_lenient(text: str | None) -> Any:
    return document(text, lenient_readings)


def split_at_stop(text: str, stop: str, loads) -> tuple[Any, str, str] | None:
    """(value, document text, trailing text) at the last stop token that has a
    document before it. Tokens are peeled off the end; what follows the one that
    is left is trailing text, further tokens included."""
    tail: list[str] = []
    while stop in text:
        text, _, after = text.rpartition(stop)
        tail.insert(0, after)
        head = text.rstrip()
        value = loads(head)
        if value is not None:
            return value, head, stop.join(tail).strip()
    return None


def _text_udf(fn):
    @F.arrow_udf("string")
    def run(c: pa.Array) -> pa.Array:
        # texts may be long: few of them are Python objects at once
        slices = (c.slice(at, _SLICE).to_pylist() for at in range(0, max(1, len(c)), _SLICE))
        return pa.concat_arrays([pa.array([fn(v) for v in part], pa.string()) for part in slices])

    return run


def _dump(value: Any) -> str | None:
    return None if value is None else json.dumps(value, ensure_ascii=False)


def parse_json_strict(c: Column) -> Column:
    """Normalised JSON text, null when the text is not one document."""
    return _text_udf(lambda t: _dump(loads_strict(t)))(c)


def parse_json_lenient(c: Column) -> Column:
    return _text_udf(lambda t: _dump(loads_lenient(t)))(c)


def solution_value(text: str | None, stop: str) -> Any:
    """A solution is strict JSON, with or without a stop token after it."""
    cut = None if text is None else split_at_stop(text.strip(), stop, loads_strict)
    return value if (value := loads_strict(text)) is not None else cut and cut[0]


def split_stop(c: Column, stop: str, strict: bool = True) -> Column:
    """struct(json, trailing), null when no stop token ends a document."""
    out = pa.struct([("json", pa.string()), ("trailing", pa.string())])
    loads = loads_strict if strict else loads_lenient

    @F.arrow_udf("struct<json:string,trailing:string>")
    def run(c: pa.Array) -> pa.Array:
        cuts = (split_at_stop(t.strip(), stop, loads) if t is not None else None for t in c.to_pylist())
        return pa.array([x and {"json": x[1], "trailing": x[2]} for x in cuts], out)

    return run(c)


def canonical_length(c: Column) -> Column:
    """Length of the document written with sorted keys and ', ' / ': '."""

    @F.arrow_udf("int")
    def run(c: pa.Array) -> pa.Array:
        values = (loads_strict(t) for t in c.to_pylist())
        return pa.array([None if v is None else json_length(v) for v in values], pa.int32())

    return run(c)


_WRITER = json.JSONEncoder(ensure_ascii=False, check_circular=False)


def json_length(value: Any) -> int:
    """Length as JSON text; the order of keys does not change it."""
    return len(_WRITER.encode(value))


_FRACTION = re.compile(r"[0-9][.eE]")


def text_bounds(text: str) -> tuple[float, int]:
    """No value read from the text has a greater ``json_length`` or more leaves:
    strings and integers are never written longer than they were, separators get one
    space each (numbers with a fraction or an exponent have no bound here), and
    a comma parts two leaves."""
    commas = text.count(",")
    return math.inf if _FRACTION.search(text) else len(text) + commas + text.count(":"), commas + 1


def string_list(c: Column) -> Column:
    """List text (JSON or single-quoted) as distinct flattened strings; text
    that is no list is its own only item."""

    @F.arrow_udf("array<string>")
    def run(c: pa.Array) -> pa.Array:
        from ast import literal_eval

        def flat(v: Any):
            if isinstance(v, list):
                for x in v:
                    yield from flat(x)
            else:
                yield str(v)

        out = []
        for text in c.to_pylist():
            if text is None:
                out.append(None)
                continue
            try:
                value = literal_eval(text)
            except (ValueError, SyntaxError):
                value = text
            out.append(list(dict.fromkeys(flat(value))))
        return pa.array(out, pa.list_(pa.string()))

    return run(c)


# ------------------------------------------------------- text normal forms
_QUOTES = str.maketrans("", "", "“”\"'`")
_SPACES = re.compile(r"\s+")
_ROUGH = re.compile(r"[^\w가-힣%]+")


#: longest text whose normal forms are remembered: values repeat, whole documents do not
MEMO_CHARS = 256


def _clean(text: str) -> str:
    if text.isascii():
        if text.isalnum():
            return text.lower()
    else:
        text = unicodedata.normalize("NFKC", text)
    text = _SPACES.sub(" ", text.strip().translate(_QUOTES))
    return text.strip(".,;:!?()[]{}").lower()


def _coarse(text: str) -> str:
    return _ROUGH.sub("", clean(text))


_clean_memo, _coarse_memo = (lru_cache(maxsize=1 << 15)(f) for f in (_clean, _coarse))


def clean(text: str) -> str:
    return _clean_memo(text) if len(text) <= MEMO_CHARS else _clean(text)


def coarse(text: str) -> str:
    if text.isascii() and text.isalnum():  # nothing to drop
        return text.lower()
    return _coarse_memo(text) if len(text) <= MEMO_CHARS else _coarse(text)


def clean_text(c: Column) -> Column:
    return _text_udf(lambda t: None if t is None else clean(t))(c)


def coarse_normalise(c: Column) -> Column:
    return _text_udf(lambda t: None if t is None else coarse(t))(c)


# -------------------------------------------------------------- flattening
def flatten_kv(node: Any):
    """(path, index, value) leaves in document order. Lists of scalars are
    indexed; lists holding any container are walked without an index; an empty
    list is one '' leaf and an empty object none."""
    open_nodes = [iter([((), node)])]
    while open_nodes:
        path, value = next(open_nodes[-1], (None, None))
        if path is None:
            open_nodes.pop()
        elif isinstance(value, dict):
            open_nodes.append(iter([((*path, str(k)), v) for k, v in value.items()]))
        elif isinstance(value, list) and any(isinstance(x, (dict, list)) for x in value):
            open_nodes.append(iter([(path, v) for v in value]))
        elif isinstance(value, list):
            yield from ((path, i, x) for i, x in enumerate(value or [""]))
        else:
            yield path, 0, value


_CONTAINERS = frozenset((dict, list))


def count_leaves(node: Any) -> int:
    """Number of leaves ``flatten_kv`` gives."""
    todo, n = [node], 0
    while todo:
        value = todo.pop()
        if isinstance(value, dict):
            if _CONTAINERS.isdisjoint(map(type, value.values())):
                n += len(value)
            else:
                todo += value.values()
        elif isinstance(value, list):
            if _CONTAINERS.isdisjoint(map(type, value)):
                n += max(len(value), 1)
            else:
                todo += value
        else:
            n += 1
    return n


@lru_cache(maxsize=1 << 12)
def _ordered(keys: tuple[str, ...]) -> tuple[str, ...]:
    try:
        return tuple(sorted(keys, key=int))
    except ValueError:
        return tuple(sorted(keys))


def _key_order(mapping: dict) -> tuple[str, ...]:
    """Numeric order when every key reads as an integer, else text order.
    Rows of a table share their keys, so orders are memoised."""
    return _ordered(tuple(mapping))


def table_rows(table: Any) -> list:
    rows = table.get("rows", []) if isinstance(table, dict) else []
    if isinstance(rows, dict):
        return [rows[k] for k in _key_order(rows)]
    return rows if isinstance(rows, list) else []


def _columns(rows: list) -> list[str]:
    kinds = dict.fromkeys([tuple(row) for row in rows if isinstance(row, dict)])
    if len(kinds) == 1:  # the keys of all rows, mostly
        return list(_ordered(*kinds))
    return list(dict.fromkeys([k for keys in kinds for k in _ordered(keys)]))


def read_tables(tables: Any) -> dict[str, tuple[list, list[str]]]:
    """Rows and columns of every table, in the order of the names."""
    names = _key_order(tables) if isinstance(tables, dict) else ()
    rows = {name: table_rows(tables[name]) for name in names}
    return {name: (listed, _columns(listed)) for name, listed in rows.items()}


def flatten_tables(tables: Any):
    """Cell leaves ((table, column), row, value); a table without rows is one
    leaf under its name, a missing cell is ''."""
    yield from table_leaves(read_tables(tables))


def table_leaves(read: dict[str, tuple[list, list[str]]]):
    for name, (rows, columns) in read.items():
        paths = [(name, column) for column in columns]
        for i, row in enumerate(rows):
            get = row.get if isinstance(row, dict) else {}.get
            for path in paths:
                yield path, i, get(path[1], "")
        if not rows:
            yield (name,), 0, ""


class Grid(NamedTuple):
    tables: dict[str, tuple[list[str], list[list[str | None]]]]  # columns, texts of the rows' cells
    lines: list[list[str | None]]  # the texts of each row number, over all tables
    n: int  # leaves, as ``table_leaves`` gives them
    objects: int  # rows that are objects
    held: int  # and the cells that they hold


def grid(tables: dict) -> Grid:
    """The texts of ``flatten_tables``, by place."""
    out, parts, n, objects, held = {}, [], 0, 0, 0
    for name in _key_order(tables):
        rows = table_rows(tables[name])
        columns = _columns(rows)
        texts = []
        for row in rows:
            if isinstance(row, dict):
                objects += 1
                held += len(row)
                cells = map(row.get, columns) if len(row) == len(columns) else [row.get(c, "") for c in columns]
            else:
                cells = [""] * len(columns)
            texts.append([v.strip() if type(v) is str else v if v is None else str(v) for v in cells])
        out[name] = columns, texts
        parts.append(texts or [[""]])
        n += len(texts) * len(columns) if texts else 1
    if len(parts) == 1:
        return Grid(out, parts[0], n, objects, held)
    lines: list[list[str | None]] = [[] for _ in range(max(map(len, parts), default=0))]
    for part in parts:
        for line, cells in zip(lines, part):
            line += cells
    return Grid(out, lines, n, objects, held)


def least_sizes(text: str, cells: Grid) -> tuple[int, int]:
    """Bounds from below of ``json_length`` and ``count_leaves`` of the tables read from
    the text; 0 where its brackets leave containers in cells possible."""
    tables = [t for t in cells.tables.values() if t[1]]
    if text.count("{") + text.count("[") != 2 + 2 * len(tables) + cells.objects:
        return 0, 0
    chars = sum([len(t) for _, rows in tables for row in rows for t in row if t])
    # beside its value a cell has its key in quotes, a colon and a space, and a comma and a space or the braces
    return chars + cells.held * (6 + min([len(c) for columns, _ in tables for c in columns], default=0)), cells.held


def grid_forms(cells: Grid) -> tuple[list[str], bool]:
    """Coarse forms of the texts that have one; whether two rows of a table have the
    same, a null read as a word, without which none repeats another."""
    forms: list[str] = []
    alike = False
    for _, rows in cells.tables.values():
        seen = set()
        for row in rows:
            own = [t.lower() if t.isalnum() and t.isascii() else coarse(t) for t in row if t]
            if "" in own:
                own = [form for form in own if form]
            forms += own
            if None in row:
                own = [form for t in row if (form := "none" if t is None else coarse(t))]
            seen.add(tuple(own))
        alike = alike or len(seen) < len(rows)
    return forms, alike


def flatten_results(results: Any):
    """Leaves ((target_id,), 0, text), number of invalid items, of repeats."""
    if not isinstance(results, list):
        return [], 1, 0
    found: dict[str, str] = {}
    invalid = repeats = 0
    for item in results:
        target = item.get("target_id") if isinstance(item, dict) else None
        text = item.get("text") if isinstance(item, dict) else None
        target = str(target).strip() if isinstance(target, (str, int)) and not isinstance(target, bool) else ""
        if not target or isinstance(text, (bool, dict, list)):
            invalid += 1
        elif target in found:
            repeats += 1
        else:
            found[target] = "" if text is None else str(text)
    return [((t,), 0, v) for t, v in found.items()], invalid, repeats


LEAF = pa.struct([("path", pa.string()), ("idx", pa.int32()), ("text", pa.string())])
LEAF_DDL = "struct<path:string,idx:int,text:string>"


def place(path: tuple[str, ...]) -> str:
    """Path as text; SEP leads every step, so () and ('',) differ."""
    return SEP + SEP.join(path) if path else ""


def leaf_text(value: Any) -> str | None:
    """Stripped text of a scalar; null for JSON null."""
    return None if value is None else str(value).strip()


def flatten(c: Column, shape: str = "kv") -> Column:
    """Leaf array of a JSON text column; ``shape`` is kv, tables or results."""
    walk = {"kv": flatten_kv, "tables": flatten_tables, "results": lambda v: flatten_results(v)[0]}[shape]

    @F.arrow_udf(f"array<{LEAF_DDL}>")
    def run(c: pa.Array) -> pa.Array:
        values = (loads_strict(t) for t in c.to_pylist())
        rows = (
            None if v is None else [{"path": place(p), "idx": i, "text": leaf_text(x)} for p, i, x in walk(v)]
            for v in values
        )
        return pa.array(list(rows), pa.list_(LEAF))

    return run(c)


def repeated_rows(name: str, rows: list) -> list[dict]:
    """Per object row that repeats one before it a signature with its occurrence number."""
    signatures = []
    seen: dict[tuple, int] = {}
    for row in rows if len(rows) > 1 else ():
        if isinstance(row, dict):
            order = _key_order(row)
            key = (order, tuple([coarse(str(row[k])) for k in order]))
            n = seen[key] = seen.get(key, 0) + 1
            if n > 1:
                signatures.append({"name": name, "row": repr(key), "n": n})
    return signatures


def table_facts(read: dict[str, tuple[list, list[str]]]) -> tuple[list[dict], list[dict]]:
    """Per table its sorted columns and row count, and signatures of the rows that repeat."""
    shapes, signatures = [], []
    for name, (rows, columns) in read.items():
        shapes.append({"name": name, "columns": sorted(columns), "rows": len(rows)})
        signatures += repeated_rows(name, rows)
    return shapes, signatures


def struct_array(rows: list[tuple | None], kind: pa.StructType) -> pa.Array:
    """Rows of field values to a struct column, built field by field (a list of
    dicts takes several times as long)."""
    blank = (None,) * kind.num_fields
    fields = []
    for f, values in zip(kind, zip(*(blank if r is None else r for r in rows)) if rows else [()] * kind.num_fields):
        nested = pa.types.is_struct(f.type)
        fields.append(struct_array(list(values), f.type) if nested else pa.array(values, f.type))
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.StructArray.from_arrays(fields, fields=list(kind), mask=missing)


def root_name(value: Any) -> str | None:
    if not isinstance(value, dict):
        return None
    for name, kind in (("kv", dict), ("tables", dict), ("results", list)):
        if isinstance(value.get(name), kind):
            return name
    return None


def get_alias(payload: Any, names: tuple[str, ...]) -> Any:
    """Value of the first name that is present."""
    if not isinstance(payload, dict):
        return None
    for n in names:
        if n in payload:
            return payload[n]
    return None


def root_of(c: Column, stop: str) -> Column:
    """kv, tables or results of a document that may end in a stop token."""
    return _text_udf(lambda t: root_name(solution_value(t, stop)))(c)


def alias_value(c: Column, names: list[str]) -> Column:
    """JSON text of the first field present, 'null' for a null field, null
    when none is."""

    def first(text: str | None) -> str | None:
        value = loads_strict(text)
        hit = next((n for n in names if isinstance(value, dict) and n in value), None)
        return None if hit is None else json.dumps(value[hit], ensure_ascii=False)

    return _text_udf(first)(c)


def results_facts(c: Column) -> Column:
    """struct(items, invalid, repeats) of a result-list text; of repeated
    targets the first item stays."""
    item = pa.struct([("target_id", pa.string()), ("text", pa.string())])
    out = pa.struct([("items", pa.list_(item)), ("invalid", pa.int32()), ("repeats", pa.int32())])

    @F.arrow_udf("struct<items:array<struct<target_id:string,text:string>>,invalid:int,repeats:int>")
    def run(c: pa.Array) -> pa.Array:
        rows = []
        for text in c.to_pylist():
            leaves, invalid, repeats = flatten_results(loads_strict(text))
            found = [{"target_id": path[0], "text": value} for path, _, value in leaves]
            rows.append(None if text is None else (found, invalid, repeats))
        return struct_array(rows, out)

    return run(c)
