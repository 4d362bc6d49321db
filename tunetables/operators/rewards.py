"""Text scorers and the set of active rewards.

A scorer adds one nullable double to the rows; null means "does not apply".
Rewards with weight <= 0 never enter the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.config import (
    BBoxOptions,
    CodeOptions,
    Extraction,
    HitOptions,
    KVOptions,
    MatchOptions,
    NdcgOptions,
    RougeOptions,
    SelectionOptions,
)
from tunetables.functions import text as T
from tunetables.functions.arithmetic import expression_value
from tunetables.functions.overlap import rouge
from tunetables.operators.bbox import score_bbox
from tunetables.operators.kv import score_kv
from tunetables.operators.retrieval import score_retrieval_hit, score_retrieval_ndcg
from tunetables.operators.selection import score_selection


def _null() -> Column:
    return F.lit(None).cast("double")


def _loss(penalty: float) -> Column:
    return F.lit(0.0 - penalty)


# ------------------------------------------------------------------ format
def has_block(c: Column, start: str, end: str, escape: bool = False) -> Column:
    """A start tag with no later start tag, then an end tag."""
    if escape:
        start, end = (f"\\Q{t}\\E" for t in (start, end))
    return F.coalesce(c, F.lit("")).rlike(f"(?s){start}(?!.*{start})(.*?){end}")


def think_format(c: Column, ext: Extraction = Extraction(), enabled: bool = True) -> Column:
    if not enabled:
        return _null()
    return F.when(has_block(c, ext.think_start_token, ext.think_end_token, ext.escape_tags), 1.0).otherwise(0.0)


def answer_format(c: Column, ext: Extraction) -> Column:
    if not ext.is_answer_tag:
        return _null()
    return F.when(has_block(c, ext.answer_start_token, ext.answer_end_token, ext.escape_tags), 1.0).otherwise(0.0)


# ------------------------------------------------------------------- match
def score_match(
    df: DataFrame,
    opt: MatchOptions = MatchOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str = "match_reward",
) -> DataFrame:
    """Equal as written, unwrapped, normalised, as choice letter or as number.
    Staged columns keep each text form computed once."""
    sol = F.col(solution)
    applies = F.col(category).isin("math", "choice") & (sol != "")
    df = df.withColumn("_said", F.when(applies, T.split_on_keywords(T.extract_answer(T.content(df, completion), ext))))
    df = df.withColumn("_clean", F.when(F.col("_said").isNotNull(), T.strip_wrappers(F.col("_said"))))
    said, clean = F.col("_said"), F.col("_clean")

    def same(form) -> Column:
        return (form(clean) != "") & (form(clean) == form(sol))

    hit = (
        (said == sol)
        | (clean == sol)
        | (T.normalise_text(clean) == T.normalise_text(sol))
        | same(T.extract_choice)
        | same(T.extract_number)
    )
    value = F.when(said.isNull(), _null()).when(hit, 1.0).otherwise(_loss(opt.incorrect_penalty))
    return df.withColumn(output, value).drop("_said", "_clean")


# -------------------------------------------------------------------- code
def score_code(
    df: DataFrame,
    executions: DataFrame,
    opt: CodeOptions = CodeOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str = "code_execution_reward",
    salts: int = 64,
) -> DataFrame:
    """Output of the answer's snippet against that of the solution's, from a
    table (snippet, status, stdout) of recorded runs. A snippet without a
    record counts as not run.

    Joins go by snippet hash and one of ``salts`` salts of the row, so that many
    rows with one snippet, or with none, are spread over tasks; the recorded runs,
    one per distinct snippet, are repeated for each salt.
    """
    done = executions.select(
        F.md5(T.strip(F.col("snippet"))).alias("_h"), F.struct("status", T.strip(F.col("stdout")).alias("out")).alias("run")
    )
    done = done.groupBy("_h").agg(F.min("run").alias("run"))
    applies = (F.col(category) == "code") & (F.col(solution) != "")
    answer = T.split_on_keywords(T.extract_answer(T.content(df, completion), ext))
    df = df.withColumns(
        {
            "_a": F.when(applies, T.extract_python_block(answer)),
            "_s": F.when(applies, T.extract_python_block(F.col(solution))),
        }
    )
    # a snippet may stand in a third of all rows: its key is split over as many
    # salts as the rows of a snippet call for, and the recorded runs are repeated
    salt = F.pmod(F.xxhash64(*df.columns[:8]), F.lit(salts)).cast("int")
    copies = done.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    df = df.withColumn("_salt", salt)
    for side in ("_a", "_s"):
        key = F.when(F.col(side) != "", F.md5(F.col(side))).otherwise(F.lit("none"))
        runs = copies.select("_salt", F.col("_h").alias(f"{side}_key"), F.col("run").alias(f"{side}_run"))
        df = df.withColumn(f"{side}_key", key).join(runs, [f"{side}_key", "_salt"], "left")

    def ran(side: str) -> Column:
        return (F.col(side) != "") & F.coalesce(F.col(f"{side}_run.status") == "success", F.lit(False))

    value = (
        F.when(F.col("_a").isNull(), _null())
        .when(~ran("_a"), _loss(opt.non_executable_penalty))
        .when(~ran("_s"), _null())
        .when(F.col("_a_run.out") == F.col("_s_run.out"), 1.0)
        .otherwise(F.lit(0.5 - opt.wrong_output_penalty))
    )
    return df.withColumn(output, value).drop("_a", "_s", "_a_key", "_s_key", "_a_run", "_s_run", "_salt")


# ------------------------------------------------------------------- rouge
def score_rouge(
    df: DataFrame,
    opt: RougeOptions = RougeOptions(),
    ext: Extraction = Extraction(),
    completion: str = "completion",
    solution: str = "solution",
    category: str = "category",
    output: str | None = None,
) -> DataFrame:
    applies = (F.col(category) == "rouge") & (F.col(solution) != "")
    said = T.strip_wrappers(T.split_on_keywords(T.extract_answer(T.content(df, completion), ext)))
    return df.withColumn(output or opt.name, rouge(F.when(applies, said), F.col(solution), opt.type, opt.stem))


# ---------------------------------------------------------------- equation
def score_equation(
    df: DataFrame,
    ext: Extraction = Extraction(),
    completion: str = "completion",
    target: str = "target",
    numbers: str = "numbers",
    category: str = "category",
    output: str = "equation_reward",
) -> DataFrame:
    """1 when the expression uses the given numbers once each, holds only
    arithmetic and comes to the target; else 0. Only expressions that pass the
    first two tests are evaluated."""
    applies = (F.col(category) == "equation") & F.col(target).isNotNull()
    said = T.strip_wrappers(T.split_on_keywords(T.extract_answer(T.content(df, completion), ext)))
    df = df.withColumn("_said", F.when(applies, said))
    runs = F.transform(F.regexp_extract_all("_said", F.lit(r"\d+"), F.lit(0)), lambda d: d.try_cast("decimal(38,0)"))
    given = F.transform(F.col(numbers), lambda n: n.cast("decimal(38,0)"))
    usable = (F.array_sort(runs) == F.array_sort(given)) & F.col("_said").rlike(r"(?U)\A[\d+\-*/().\s]+\z")
    df = df.withColumn("_value", expression_value(F.when(usable, F.col("_said"))))
    near = F.abs(F.col("_value") - F.col(target).cast("double")) < 1e-5
    value = F.when(F.col("_said").isNull(), _null()).when(near, 1.0).otherwise(0.0)
    return df.withColumn(output, value).drop("_said", "_value")


# -------------------------------------------------------------- the active set
@dataclass(frozen=True)
class Reward:
    """``score(df, column)`` adds the unweighted column to the rows."""

    name: str
    weight: float
    score: Callable[[DataFrame, str], DataFrame]


def column_reward(name: str, weight: float, value: Callable[[DataFrame], Column]) -> Reward:
    """A reward that is one expression over the row."""
    return Reward(name, weight, lambda df, out: df.withColumn(out, value(df)))


def joined_reward(name: str, weight: float, scores: DataFrame, key: str, value: str) -> Reward:
    """A reward computed elsewhere (retrieval), joined back by row key."""

    def add(df: DataFrame, out: str) -> DataFrame:
        return df.join(scores.select(key, F.col(value).alias(out)), key, "left")

    return Reward(name, weight, add)


_registry: dict[str, Callable[..., Reward]] = {}


def register_reward(name: str, build: Callable[..., Reward]) -> None:
    """Make a user-defined reward available by name; ``build(weight, **options)``."""
    if name in _registry:
        raise ValueError(f"reward {name} is already registered")
    _registry[name] = build


def build_reward(name: str, weight: float, **options) -> Reward:
    if name not in _registry:
        raise ValueError(f"unknown reward {name}; known: {sorted(_registry)}")
    return _registry[name](weight, **options)


def _register_builtin() -> None:
    ext = Extraction()

    def think(weight, ext=ext, enabled=True, completion="completion"):
        return column_reward("think_format_reward", weight, lambda df: think_format(T.content(df, completion), ext, enabled))

    def answer(weight, ext=ext, completion="completion"):
        return column_reward("answer_format_reward", weight, lambda df: answer_format(T.content(df, completion), ext))

    def of(scorer, options):
        def build(weight, opt=None, ext=ext, **columns):
            opt = opt or options()
            return Reward(opt.name, weight, lambda df, out: scorer(df, opt, ext, output=out, **columns))

        return build

    def code(weight, executions, opt=None, ext=ext, **columns):
        opt = opt or CodeOptions()
        return Reward(opt.name, weight, lambda df, out: score_code(df, executions, opt, ext, output=out, **columns))

    def equation(weight, ext=ext, **columns):
        return Reward("equation_reward", weight, lambda df, out: score_equation(df, ext, output=out, **columns))

    def retrieval(scorer, options):
        def build(weight, ranked, opt=None, **columns):
            opt = opt or options()
            return Reward(opt.name, weight, lambda df, out: scorer(df, ranked, opt, output=out, **columns))

        return build

    register_reward("think_format", think)
    register_reward("answer_format", answer)
    register_reward("match", of(score_match, MatchOptions))
    register_reward("code_execution", code)
    register_reward("rouge", of(score_rouge, RougeOptions))
    register_reward("equation", equation)
    register_reward("retrieval_hit", retrieval(score_retrieval_hit, HitOptions))
    register_reward("retrieval_ndcg", retrieval(score_retrieval_ndcg, NdcgOptions))
    register_reward("kv", of(score_kv, KVOptions))
    register_reward("grounding_bbox", of(score_bbox, BBoxOptions))
    register_reward("grounding_selection", of(score_selection, SelectionOptions))


_register_builtin()


def apply_weight(value: Column, weight: float) -> Column:
    return value * F.lit(float(weight))


def active(rewards: list[Reward]) -> list[Reward]:
    return [r for r in rewards if r.weight > 0]


def score_all(df: DataFrame, rewards: list[Reward]) -> DataFrame:
    """Wide result: one weighted column per active reward, under its name."""
    for r in active(rewards):
        df = r.score(df, r.name)
        df = df.withColumn(r.name, apply_weight(F.col(f"`{r.name}`"), r.weight))
    return df


def to_long(scored: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """(key, reward, value) with one line per row and reward."""
    cells = F.array(*[F.struct(F.lit(n).alias("reward"), F.col(f"`{n}`").alias("value")) for n in names])
    return scored.select(*key, F.inline(cells))

