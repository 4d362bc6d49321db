"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets a few measures, each larger for worse text. For each stratum and
rule a fixed grid of cutoffs is walked from the loosest to the tightest. A cutoff
is certified if, were its true rate of rejecting good documents above ``risk``,
so few rejections among the labelled good ones would have a binomial probability
of at most the test's level. The walk stops at the first cutoff that fails, so the
grid needs no correction; strata and rules share ``error`` by Bonferroni. With
probability ``1 - error`` no rule rejects more than ``risk`` of any stratum's good
documents. Without enough labels nothing is certified, and nothing is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A measure's column and its cutoffs, loosest first; rejects above the cutoff."""

    name: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbol_share", (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05)),
    Rule("duplicate_line_share", (0.8, 0.6, 0.5, 0.4, 0.3)),
    Rule("repeat_share", (0.8, 0.6, 0.4, 0.3, 0.25, 0.2)),
    Rule("shout_share", (0.9, 0.8, 0.7, 0.6, 0.5)),
)


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more, each once."""
    n = F.size(words)
    at = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        # windows and places, sorted: an equal neighbour marks a repeat; then the places in order
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(p: Column) -> Column:
            same = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        def total(places: Column) -> Column:
            steps = F.transform(places, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return _with(_with(pairs, repeats), total)

    def any_repeat(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))

    return _with(windows, any_repeat)


def _with(value: Column, then) -> Column:
    """``then(value)`` with the value computed once: a one-element array's transform."""
    return F.get(F.transform(F.array(value), then), 0)


def measures(df: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(id, row, stratum, the counts, the measures) of every text; null text has no words.
    The text is split once and never leaves its row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    letters = F.regexp_replace("text", GAP, "")
    words = words_in(F.col("text"))
    out = base.select(
        "id", "row", "stratum",
        _with(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(letters).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _with(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("l"),
        (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("capitals"),
    ).select(
        "id", "row", "stratum", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.d").alias("n_dup_lines"),
        F.col("w.r").alias("n_repeat_words"), F.col("l.n").alias("n_lines"), "capitals",
    )

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return out.withColumns({
        "symbol_share": share("n_symbols", "word_chars"), "duplicate_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "shout_share": share("capitals", "word_chars"),
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    })


def log_choose(n: Column, k: Column) -> Column:
    def lg(x: Column) -> Column:  # log x!, Stirling's series above 20
        series = x * F.log(x) - x + 0.5 * F.log(2 * F.lit(3.141592653589793) * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
        return F.when(x <= 20, F.log(F.factorial(F.least(x, F.lit(20)).cast("int")).cast("double"))).otherwise(series)

    return lg(n) - lg(k) - lg(n - k)


def binomial_tail(x: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= x) to double precision, for x < n p: the largest term is
    the last, and each one before is smaller by k (1 - p) / ((n - k + 1) p). Terms
    more than 40 standard deviations below the last cannot change a double."""
    top = log_choose(n.cast("double"), x.cast("double")) + x * F.log(F.lit(p)) + (n - x) * F.log1p(F.lit(-p))
    depth = F.least(x, (F.lit(100) + 40 * F.sqrt(n * p)).cast("long"))
    back = F.when(depth > 0, F.sequence(F.lit(0).cast("long"), depth - 1)).otherwise(F.array().cast("array<long>"))
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        k = x - i
        term = s["term"] * k * (1 - p) / ((n - k + 1) * p)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    return F.exp(top + F.log(F.aggregate(back, state, step, lambda s: s["sum"])))


def certified_cutoffs(measured: DataFrame, good: DataFrame, rules: tuple[Rule, ...], risk: float, error: float) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected) of every cutoff that is certified and is
    the tightest of its walk. ``good`` holds the ids of the labelled good documents;
    documents that fail the base rules take no part."""
    held = measured.filter(~F.col("base_failed")).join(good.select("id").distinct(), "id", "left_semi")
    sums = [F.sum((F.col(r.name) > c).cast("long")).alias(f"{r.name}_{i}") for r in rules for i, c in enumerate(r.cutoffs)]
    counts = materialise(held.groupBy("stratum").agg(F.count("*").alias("n"), *sums), "good-counts")
    level = error / (len(rules) * max(1, counts.count()))
    cells = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("nth"), F.lit(float(c)).alias("cutoff"), F.col(f"{r.name}_{i}").alias("rejected"))
        for r in rules for i, c in enumerate(r.cutoffs)
    ]
    tests = counts.select("stratum", "n", F.explode(F.array(*cells)).alias("c")).select("stratum", "n", "c.*")
    tested = tests.withColumn(
        "passed", (F.col("rejected") < F.col("n") * risk) & (binomial_tail(F.col("rejected"), F.col("n"), risk) <= level)
    )
    # walked from the loosest: the first failure ends it
    walked = tested.groupBy("stratum", "rule").agg(
        F.coalesce(F.min(F.when(~F.col("passed"), F.col("nth"))), F.lit(1 << 30)).alias("stop"),
        F.collect_list(F.struct("nth", "cutoff", "n", "rejected")).alias("cells"),
    )
    best = F.array_max(F.filter("cells", lambda c: c["nth"] < F.col("stop")))
    return walked.withColumn("b", best).filter("b is not null").select("stratum", "rule", "b.cutoff", "b.n", "b.rejected")


def judge_quality(
    df: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = 0.01, error: float = 0.05,
    id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, rules_failed) for each row of ``df``.

    ``labels`` has the id and ``quality`` (1 is good; null is no label); several
    labels of one id count as good if all are 1. Null text has no words and fails
    the base rules; a null stratum is one of its own; rows without an id are judged
    but never learned from. Other columns are not read; empty tables give no rows
    or no thresholds."""
    return _judged(df, labels, rules, risk, error, id_col, text_col, stratum_col).withColumnRenamed("id", id_col).drop("row")


def kept_documents(
    df: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = 0.01, error: float = 0.05,
    id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
) -> DataFrame:
    """The rows of ``df`` that ``judge_quality`` keeps, with all their columns.
    Rows are met by a hash of id and text, so that a null id is no loss."""
    rows = _judged(df, labels, rules, risk, error, id_col, text_col, stratum_col).filter("kept").select(F.col("row").alias("_row")).distinct()
    return df.join(rows, F.xxhash64(F.col(id_col), F.col(text_col)) == F.col("_row"), "left_semi")


def _judged(
    df: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], risk: float, error: float, id_col: str, text_col: str, stratum_col: str
) -> DataFrame:
    measured = materialise(measures(df, id_col, text_col, stratum_col), "measures")
    good = labels.filter(F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("q")).filter("q = 1")
    cutoffs = materialise(certified_cutoffs(measured, good, rules, risk, error), "cutoffs")
    per_rule = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"_{r.name}") for r in rules])
    failed = [F.when(F.col(r.name) > F.col(f"_{r.name}"), F.lit(r.name)) for r in rules]
    # a row for a stratum: as many as the column has values, a checked handful
    side = F.broadcast(per_rule) if cutoffs.count() <= 10_000 else per_rule
    judged = measured.join(side, "stratum", "left").withColumn("rules_failed", F.array_compact(F.array(*failed)))
    return judged.select(
        "id", "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("rules_failed") == 0)).alias("kept"), "rules_failed",
    )
