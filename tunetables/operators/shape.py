"""Row shaping per training method and column cleaning. Projections only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetables.functions.text import strip

MESSAGE = "struct<role:string,content:string>"


# ------------------------------------------------------------ cleaning
def fill_missing(df: DataFrame, value: str = "_", stringify: bool = False) -> DataFrame:
    """Null text becomes ``value``. ``stringify`` does the same to numbers and
    other atomic columns, as text, and takes NaN as missing."""
    if stringify:
        def filled(f: T.StructField) -> Column:
            c = F.col(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
                return c
            missing = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.isNull()
            return F.when(missing, F.lit(value)).otherwise(c.cast("string")).alias(f.name)

        return df.select(*map(filled, df.schema.fields))
    return df.na.fill(value)


def strip_column(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, strip(F.col(name)))


def drop_null_fields(value: Column) -> Column:
    """Nested value as JSON text without its null fields (``parse_json`` of it
    is the cleaned value)."""
    return F.to_json(value, {"ignoreNullFields": "true"})


def standardise_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Configured names to the trainer's names; a missing column is an error."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a != b})


def keep_columns(df: DataFrame, names: list[str], images: tuple[str, ...] = ("image", "images")) -> DataFrame:
    return df.select(*[c for c in df.columns if c in names or c in images])


def to_distillation(df: DataFrame, data: str, images: tuple[str, ...] = ("image", "images")) -> DataFrame:
    """``prompt`` = user turn; of the other columns only images stay."""
    return df.select(F.array(message("user", F.col(data))).alias("prompt"), *[c for c in images if c in df.columns])


def drop_inputs(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def with_constant_struct(df: DataFrame, name: str, fields: dict) -> DataFrame:
    if df.isStreaming:
        raise ValueError(f"{name} cannot be set on a stream")
    return df.withColumn(name, F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]))


def project_turns(messages: Column, role: str = "role", content: str = "content") -> Column:
    return F.transform(messages, lambda m: F.struct(m[role].alias("role"), m[content].alias("content")))


# ------------------------------------------------------------- shaping
def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _text_part(c: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), F.lit(None).cast("string").alias("image")))


def to_sft(
    df: DataFrame, data: str, target: str, assistant: str = "assistant", multimodal: bool = False
) -> DataFrame:
    """``messages`` = user turn, assistant turn with the stripped target; a
    multimodal target is wrapped as one text part."""
    label = strip(F.col(target))
    label = _text_part(label) if multimodal else label
    return df.withColumn("messages", F.array(message("user", F.col(data)), message(assistant, label))).drop(
        *({data, target} - {"messages"})
    )


def to_prompt(df: DataFrame, data: str, keep: list[str] | None = None) -> DataFrame:
    """``prompt`` = user turn; ``keep`` limits the other columns that survive."""
    out = df.withColumn("prompt", F.array(message("user", F.col(data))))
    return out.select("prompt", *keep) if keep is not None else out.drop(*({data} - {"prompt"}))


def to_preference(df: DataFrame, data: str, chosen: str, rejected: str, assistant: str = "assistant") -> DataFrame:
    shaped = {
        "prompt": F.array(message("user", F.col(data))),
        "chosen": F.array(message(assistant, F.col(chosen))),
        "rejected": F.array(message(assistant, F.col(rejected))),
    }
    return df.withColumns(shaped).drop(*({data, chosen, rejected} - set(shaped)))


def to_feedback(df: DataFrame, data: str, target: str, label: str, assistant: str = "assistant") -> DataFrame:
    shaped = {
        "prompt": F.array(message("user", F.col(data))),
        "completion": F.array(message(assistant, F.col(target))),
        "label": F.col(label),
    }
    return df.withColumns(shaped).drop(*({data, target, label} - set(shaped)))


def to_teacher_messages(df: DataFrame, data: str, target: str, assistant: str = "assistant") -> DataFrame:
    turns = F.array(message("user", F.col(data)), message(assistant, F.col(target)))
    return df.withColumn("messages", turns).drop(*({data, target} - {"messages"}))


def to_test_conversation(df: DataFrame, messages: str = "messages") -> DataFrame:
    """The last turn's content is the label, the turns before it the prompt."""
    m = project_turns(F.col(messages))
    return df.withColumns(
        {"prompt": F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))), "label": F.try_element_at(m, F.lit(-1))["content"]}
    ).drop(*({messages} - {"prompt", "label"}))


def to_test_prompt(df: DataFrame, data: str, target: str) -> DataFrame:
    return df.withColumns(
        {"prompt": F.array(message("user", F.col(data))), "label": strip(F.col(target))}
    ).drop(*({data, target} - {"prompt", "label"}))


@dataclass(frozen=True)
class ChatMarkers:
    """Text around each turn; ``{role}`` stands for the turn's role."""

    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"


def render_turn(role: Column, content: Column, marks: ChatMarkers = ChatMarkers()) -> Column:
    before, _, after = marks.head.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after), content, F.lit(marks.tail))


def generation_prompt(marks: ChatMarkers = ChatMarkers(), assistant: str = "assistant") -> str:
    return marks.head.replace("{role}", assistant)


def render_chat(messages: Column, add_generation_prompt: bool = False, marks: ChatMarkers = ChatMarkers()) -> Column:
    turns = F.transform(messages, lambda m: render_turn(m["role"], m["content"], marks))
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(generation_prompt(marks))) if add_generation_prompt else text


def expand_turn_prefixes(
    df: DataFrame, contents: str, generations: str, assistant: str = "assistant"
) -> DataFrame:
    """One row per user turn of a row's array: its prompt is the turns before,
    each with its recorded generation, and the turn itself."""
    c, g = F.col(contents), F.col(generations)

    def pair(i: Column) -> Column:
        return F.array(message("user", F.get(c, i)), message(assistant, F.get(g, i)))

    said = F.flatten(F.transform(F.sequence(F.lit(0), F.size(c) - 1), pair))
    rows = df.withColumn("_said", F.when(F.size(c) > 0, said))
    rows = rows.select("*", F.posexplode(c).alias("turn", "_content"))
    prompt = F.slice(F.col("_said"), F.lit(1), F.col("turn") * 2 + 1)
    return rows.withColumn("prompt", prompt).drop("_said", "_content")
