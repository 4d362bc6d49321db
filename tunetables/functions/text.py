r"""Answer extraction and text normalisation, as Column expressions.

Java's ``\s``, ``\w`` and ``\b`` are ASCII unless ``(?U)`` is given, and its
``(?i)`` needs ``(?u)``; the patterns below carry these flags so that results
are those of Unicode-aware matching.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tunetables.config import Extraction

#: Unicode white space plus the four separator control characters.
WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{WS}+|{WS}+\z", "")


def completion_text(c: Column, is_messages: bool) -> Column:
    """Text itself, or the ``content`` of the first message; else an error."""
    if not is_messages:
        return c
    return F.when(F.size(c) > 0, F.get(c, F.lit(0))["content"]).otherwise(
        F.raise_error(F.lit("completion holds no message"))
    )


def content(df: DataFrame, name: str) -> Column:
    """A completion column as text, whether it holds texts or message arrays."""
    return completion_text(F.col(name), isinstance(df.schema[name].dataType, ArrayType))


def _tag(tag: str, ext: Extraction) -> str:
    # Quoted for Java; unescaped tags are inserted as patterns on purpose.
    return "\\Q" + tag + "\\E" if ext.escape_tags else tag


def normalise_gemma4(c: Column) -> Column:
    """Drop thought channels and leading markers, cut at the stop tokens."""
    # Markers of this extraction profile.
    c = F.regexp_replace(strip(c), r"(?siuU)<\|channel\>thought\b.*?<channel\|>", "")
    c = F.regexp_replace(c, rf"(?iuU)\A{WS}*<\|turn\>model{WS}*", "")
    c = F.regexp_replace(c, rf"(?iuU)\A{WS}*<\|channel\>[A-Za-z0-9_\-]+{WS}*", "")
    for stop in ("<turn|>", "<eos>", "<|tool_response|>"):
        c = F.substring_index(c, stop, 1)
    return strip(c)


def extract_answer(c: Column, ext: Extraction = Extraction()) -> Column:
    """The answer part of a completion. Presence is tested with ``rlike``:
    an empty capture is a valid hit, which ``regexp_extract`` cannot tell
    from no match."""
    c = F.coalesce(c, F.lit(""))
    if ext.extraction_profile == "gemma4":
        c = normalise_gemma4(c)
    if ext.is_answer_tag:
        pattern = f"(?siu){_tag(ext.answer_start_token, ext)}(.*?){_tag(ext.answer_end_token, ext)}"
        return strip(F.regexp_extract(c, pattern, 1))
    # Plain searches first: most texts hold no delimiter, and a pattern costs
    # several times as much over a long text.
    hashes, opens = c.contains("###"), c.contains("<")
    thought = opens if ext.think_end_token.startswith("<") else F.lit(True)
    # Answer delimiters, in order of precedence.
    patterns = [
        (hashes, rf"(?sU)###{WS}*Start{WS}*\n(.*?)\n?###{WS}*End"),
        (opens, r"(?siu)<solution>(.*?)</solution>"),
        (opens, r"(?siu)<answer>(.*?)</answer>"),
        (hashes, rf"(?sU)###{WS}*Start{WS}*\n(.*)\z"),
        (opens, r"(?siu)<solution>(.*)\z"),
        (opens, r"(?siu)<answer>(.*)\z"),
        (thought, rf"(?siuU){_tag(ext.think_end_token, ext)}{WS}*(.*?){WS}*(?:{_tag(ext.eos_token, ext)}|$)"),
    ]
    out = F
    for guard, p in patterns:
        out = out.when(guard & c.rlike(p), strip(F.regexp_extract(c, p, 1)))
    return out.otherwise(c)


def may_hold_answer(c: Column, ext: Extraction = Extraction()) -> Column:
    """False where ``extract_answer`` gives the text as it is: one search for the
    beginnings of its patterns, where they all begin with fixed texts."""
    tag = ext.think_end_token
    fixed = tag.startswith("<") and "\\E" not in tag and (ext.escape_tags or tag.strip("</>").isalnum())
    if ext.extraction_profile == "gemma4" or ext.is_answer_tag or not fixed:
        return F.lit(True)
    return c.contains("###") | (c.contains("<") & c.rlike(rf"(?iuU)<(?:solution>|answer>|\Q{tag[1:]}\E)"))


def split_on_keywords(c: Column) -> Column:
    """Text after the last 'answer is' / 'answer:'."""
    parts = F.split(F.coalesce(c, F.lit("")), rf"(?iuU)answer{WS}*(?:is{WS}*:?|:){WS}*", -1)
    return strip(F.element_at(parts, -1))


def may_hold_keywords(c: Column) -> Column:
    """False where ``split_on_keywords`` only strips the text."""
    return c.rlike("(?iuU)answer")


def _unwrap(c: Column) -> Column:
    c = F.regexp_replace(c, r"\\boxed\{([^{}]*)\}", "$1")
    return F.regexp_replace(c, r"\\text\{([^{}]*)\}", "$1")


def strip_wrappers(c: Column) -> Column:
    r"""Trim brackets and ``$``, unwrap ``\boxed{}`` / ``\text{}`` to a fixed
    point, drop TeX delimiters and backslashes, squeeze white space.

    The fixed point is a fold over as many steps as there are wrappers, which
    is exact at any nesting depth and is no step at all for plain text; once a
    step changes nothing the rest only pass the value on.
    """
    c = strip(F.coalesce(c, F.lit("")))
    c = F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f:=\-()\[\]{}|>]+", "")
    c = F.regexp_replace(c, r"(?U)[\s\x1c-\x1f:=\-()\[\]{}|<]+\z", "")
    c = F.regexp_replace(c, r"\A\$+|\$+\z", "")
    wrappers = F.regexp_count(c, F.lit(r"\\(?:boxed|text)\{"))
    steps = F.when(wrappers > 0, F.sequence(F.lit(1), wrappers)).otherwise(F.array().cast("array<int>"))

    def step(acc: Column, _: Column) -> Column:
        after = _unwrap(acc["t"])
        return F.when(acc["done"], acc).otherwise(
            F.struct(after.alias("t"), (after == acc["t"]).alias("done"))
        )

    c = F.aggregate(steps, F.struct(c.alias("t"), F.lit(False).alias("done")), step, lambda a: a["t"])
    c = F.regexp_replace(c, r"\\[()\[\]]", "")
    c = F.replace(c, F.lit("\\"), F.lit(""))
    return strip(F.regexp_replace(c, rf"(?U){WS}+", " "))


def normalise_text(c: Column) -> Column:
    c = strip(F.lower(c))
    return strip(F.regexp_replace(c, r"""(?U)[\s\x1c-\x1f.,;:!?'"]+""", " "))


def has_category_token(category: Column, token: str) -> Column:
    token = token.lower().strip()
    if token == "":
        return F.lit(False)
    return F.coalesce(F.array_contains(F.split(F.lower(category), "_"), token), F.lit(False))


def extract_choice(c: Column) -> Column:
    """A-E when the whole text is one wrapped letter, else the first standalone one."""
    whole = F.regexp_extract(c, r"(?U)\A[\s\x1c-\x1f:=\-(\[{]*([A-Ea-e])[)\]}\s\x1c-\x1f.,;:!?]*\z", 1)
    first = F.regexp_extract(c, r"(?U)\b([A-Ea-e])\b", 1)
    return F.upper(F.coalesce(F.nullif(whole, F.lit("")), first))


def extract_number(c: Column) -> Column:
    """First signed number; integers lose leading zeros."""
    n = F.regexp_extract(c, r"(?U)-?\d+(?:\.\d+)?", 0)
    return F.when(n.contains("."), n).otherwise(F.regexp_replace(n, r"(?U)\A(-?)0+(?=\d)", "$1"))


def extract_python_block(c: Column) -> Column:
    """First fenced python block, '' when there is none."""
    return strip(F.regexp_extract(F.coalesce(c, F.lit("")), rf"(?sU)```python{WS}*(.*?){WS}*```", 1))


def contains_hangul(c: Column) -> Column:
    # Hangul syllables, Jamo and compatibility Jamo.
    return c.rlike("[\uac00-\ud7a3\u1100-\u11ff\u3130-\u318f]")


def numeric_punct_mismatch(a: Column, b: Column) -> Column:
    """Both hold digits and their sets of , . : between digits differ."""

    def marks(c: Column) -> Column:
        found = F.regexp_extract_all(c, F.lit(r"(?U)(?<=\d)[,.:](?=\d)"), F.lit(0))
        return F.array_sort(F.array_distinct(found))

    return a.rlike(r"(?U)\d") & b.rlike(r"(?U)\d") & (marks(a) != marks(b))


def query_instruction(instruction: str, query: Column) -> Column:
    """Prefix a retrieval query for the embedding step."""
    return F.concat(F.lit(f"Instruct: {instruction}\nQuery:"), query)

