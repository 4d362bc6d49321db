"""Exact sampling, splits and row selection.

Order comes from ``md5(seed:key)``, then the key, then a hash of the whole row, so
a sample depends on the seed and the rows alone, never on partitioning. Keys may
repeat or be null. Picking the n first rows of that order needs no global sort: a
histogram over the first four hex digits (65,536 buckets) names the bucket where
the cut falls, the counts of that bucket's keys name the key, and only if the cut
falls among the rows of one key are these cut in the same way by their own hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetables.functions.text import contains_hangul
from tunetables.operators.staging import materialise

BUCKET_DIGITS = 4  # 16**4 histogram rows at most


def order_token(key: str | Column, seed: int) -> Column:
    """Sort string of a row: hash first, key as tie break. Null counts as empty."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text)), F.lit(":"), text)


def row_token(df: DataFrame) -> Column:
    """Sort string among rows of one key: a hash of all columns but maps."""
    named = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.md5(F.hex(F.xxhash64(*named)))


def _bucket(token: Column) -> Column:
    return F.substring(token, 1, BUCKET_DIGITS)


def _histogram(tokens: DataFrame) -> DataFrame:
    """(bucket, n, before): at most 65,536 rows, so the window is bounded."""
    per = tokens.groupBy(_bucket(F.col("t")).alias("bucket")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    return per.withColumn("before", running - F.col("n"))


@dataclass(frozen=True)
class Cut:
    """Where the first n rows end: after key token ``key``; or, if ``row`` is set,
    within that key after row token ``row``; or, if ``equal`` is set, after so many
    of the rows with that token, which are equal in every column."""

    key: str
    row: str | None = None
    equal: int | None = None


def _cut_among(tokens: DataFrame, n: int) -> tuple[str, int, int]:
    """(token, rows with it, how many of them count) of the n-th of the column ``t``,
    for 1 <= n <= rows: the histogram, and the counts of the tokens in one bucket."""
    bucket = _bucket(F.col("t"))
    left = n
    for r in sorted(tokens.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()):
        if left <= r.n:
            break
        left -= r.n
    counts = tokens.where(bucket == r.b).groupBy("t").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.orderBy("t").rowsBetween(W.unboundedPreceding, W.currentRow))
    edge = counts.withColumn("upto", upto).where((F.col("upto") >= left) & (F.col("upto") - F.col("n") < left)).first()
    return edge.t, edge.n, left - (edge.upto - edge.n)


def find_cut(df: DataFrame, n: int, key: str, seed: int) -> Cut:
    """The cut after n rows of the order, for 1 <= n <= rows."""
    token = order_token(key, seed)
    t, many, wanted = _cut_among(df.select(token.alias("t")), n)
    if wanted == many:
        return Cut(t)
    row, many, wanted = _cut_among(df.where(token == t).select(row_token(df).alias("t")), wanted)
    return Cut(t, row) if wanted == many else Cut(t, row, wanted)


def _before(df: DataFrame, cut: Cut, key: str, seed: int) -> Column:
    """Whether a row lies before the cut; of rows equal at the cut, none."""
    token, row = order_token(key, seed), row_token(df)
    if cut.row is None:
        return token <= cut.key
    within = row < cut.row if cut.equal is not None else row <= cut.row
    return (token < cut.key) | ((token == cut.key) & within)


def _at(df: DataFrame, cut: Cut, key: str, seed: int) -> Column:
    return (order_token(key, seed) == cut.key) & (row_token(df) == cut.row)


def sample_exact(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly n rows (all, when there are fewer), no repeats. Keys may repeat or
    be null; rows equal in every column are interchangeable. The cut is found by
    small jobs when this is called."""
    total = df.count()
    if n >= total:
        return df
    if n <= 0:
        return df.where(F.lit(False))
    cut = find_cut(df, n, key, seed)
    out = df.where(_before(df, cut, key, seed))
    return out if cut.equal is None else out.unionByName(df.where(_at(df, cut, key, seed)).limit(cut.equal))


def hash_index(df: DataFrame, key: str, seed: int, name: str = "idx") -> DataFrame:
    """Dense 0-based index in hash order. Keys may repeat or be null: the rows of a key
    follow in the order of their own hashes, and rows equal in every column, which are
    interchangeable, in that of a salt. So no key and no row is too frequent for the
    ranges of the sort."""
    rows = df.withColumn("_t", order_token(key, seed)).withColumn("_r", row_token(df)).withColumn("_s", F.xxhash64(F.monotonically_increasing_id()))
    return ordered_index(rows, "_t", "_r", "_s", name=name).drop("_t", "_r", "_s")


def ordered_index(df: DataFrame, *order: str | Column, name: str = "idx") -> DataFrame:
    """Dense 0-based index in a stated total order.

    A range-partitioned sort is written once (its partition bounds come from a
    sample, so a second run could cut elsewhere), then the row counts of its
    partitions give the offsets.
    """
    return numbered(df.orderBy(*order), name)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Dense 0-based index in the order the rows come in: they are written once, and
    the row counts of the partitions give the offsets."""
    at = materialise(df.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    per = at.groupBy(part.alias("_p")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow))
    offsets = per.select("_p", (running - F.col("n")).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = at.withColumn("_p", part).join(F.broadcast(offsets), "_p")  # one row per partition
    return rows.withColumn(name, F.col("_before") + within).drop("_p", "_before", "_at")


def draw_index(seed: int, draw: str | Column, total: Column) -> Column:
    """Index of one draw with replacement: 60 hash bits modulo the row count."""
    text = F.concat(F.lit(f"{seed}:"), (F.col(draw) if isinstance(draw, str) else draw).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), total)


def sample_exact_with_replacement(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """n independent draws; a row drawn m times comes out m times."""
    total = df.agg(F.count("*")).scalar()
    draws = df.sparkSession.range(n).select(draw_index(seed, "id", total).alias("idx"))
    times = draws.groupBy("idx").agg(F.count("*").cast("int").alias("_times"))
    picked = hash_index(df, key, seed).join(times, "idx")
    copies = F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")
    return picked.select("*", copies).drop("idx", "_times", "_copy")


def mixture_counts(
    sources: DataFrame, replacement: bool = False, target_size: int | None = None
) -> DataFrame:
    """Rows to take per source, from (source_index, weight, length).

    The table has one row per configured source, so its windows are bounded.
    """
    every = W.partitionBy(F.lit(0))
    if target_size is not None and target_size <= 0:
        raise ValueError("target_size must be positive")
    if target_size is not None:
        target = F.lit(target_size).cast("bigint")
    elif replacement:
        target = F.sum("length").over(every).cast("bigint")
    else:
        target = F.min(F.floor(F.col("length") / F.col("share"))).over(every).cast("bigint")
    share = F.col("weight").cast("double") / F.sum(F.col("weight").cast("double")).over(every)
    t = sources.withColumn("share", share).withColumn("target", target)
    t = t.withColumn("raw", F.col("target") * F.col("share")).withColumn("whole", F.floor("raw"))
    t = t.withColumn("open", F.col("target") - F.sum("whole").over(every))
    by_rest = W.partitionBy(F.lit(0)).orderBy((F.col("raw") - F.col("whole")).desc(), "source_index")
    extra = F.when(F.row_number().over(by_rest) <= F.col("open"), 1).otherwise(0)
    t = t.withColumn("n", F.col("whole") + extra)
    problem = (
        F.when(F.col("length") <= 0, "a source holds no rows")
        .when(F.col("n") <= 0, "every source must give at least one row")
        .when(
            F.lit(not replacement) & (F.col("n") > F.col("length")),
            "the target needs replacement or must be smaller",
        )
    )
    n = F.when(problem.isNotNull(), F.raise_error(problem).cast("bigint")).otherwise(F.col("n"))
    return t.select("source_index", "weight", "length", n.cast("bigint").alias("n"))


@dataclass(frozen=True)
class Source:
    df: DataFrame
    weight: float


def weighted_mixture(
    sources: list[Source], key: str, seed: int, replacement: bool = False, target_size: int | None = None
) -> DataFrame:
    """Exact counts per source, then one exact sample per source with seed
    ``seed + position``, in union. Counting is one job over all sources; its
    result is one number per configured source."""
    if not sources or any(s.weight is None or s.weight <= 0 for s in sources):
        raise ValueError("every source needs a positive weight")
    spark = sources[0].df.sparkSession
    lengths = None
    for i, s in enumerate(sources):
        one = s.df.agg(F.count("*").alias("length")).select(
            F.lit(i).alias("source_index"), F.lit(float(s.weight)).alias("weight"), "length"
        )
        lengths = one if lengths is None else lengths.unionByName(one)
    counts = {r.source_index: r.n for r in mixture_counts(lengths, replacement, target_size).collect()}
    take = sample_exact_with_replacement if replacement else sample_exact
    out = None
    for i, s in enumerate(sources):
        part = take(s.df, counts[i], key, seed + i)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], "a int")


def with_split_flag(df: DataFrame, key: str, ratio: float, seed: int, name: str = "is_val") -> DataFrame:
    """Rows flagged as held out: exactly ceil(rows * ratio) of them, in one scan
    once the cut is known."""
    total = df.count()
    n = math.ceil(total * float(ratio))
    if n <= 0 or n >= total:
        return df.withColumn(name, F.lit(n > 0))
    cut = find_cut(df, n, key, seed)
    flagged = df.withColumn(name, _before(df, cut, key, seed))
    if cut.equal is None:
        return flagged
    # rows that are equal in every column: so many of them on either side
    tied = _at(df, cut, key, seed)
    edge = numbered(df.where(tied), "_nth").withColumn(name, F.col("_nth") < cut.equal).drop("_nth")
    return flagged.where(~tied).unionByName(edge)


def train_val_split(
    df: DataFrame, key: str, ratio: float, seed: int, strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Shuffled hold-out. Without ``strict`` the training side keeps every row
    and overlaps the validation side."""
    flagged = with_split_flag(df, key, ratio, seed, "_val")
    train = flagged.where(~F.col("_val")).drop("_val") if strict else df
    return train, flagged.where("_val").drop("_val")


def select_indices(df: DataFrame, order: list[str], indices: DataFrame, column: str = "idx") -> DataFrame:
    """Rows at the given 0-based positions of the stated order, which must tell the
    rows apart. Only the order columns are sorted and numbered."""
    wanted = indices.select(F.col(column).cast("bigint").alias("idx")).distinct()
    keys = ordered_index(df.select(*order), *order).join(wanted, "idx", "left_semi").select(*[F.col(c).alias(f"_{c}") for c in order])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
    return df.join(keys, same, "left_semi")


def payload_size(df: DataFrame) -> Column:
    """Characters of text, elements of arrays and maps, digits of the rest."""

    def of(c: Column, t) -> Column:
        kind = t.typeName()
        if kind in ("string", "binary"):
            return F.length(c)
        if kind == "struct":
            return sum((F.coalesce(of(c[f.name], f.dataType), F.lit(0)) for f in t.fields), F.lit(0))
        if kind == "array":
            return F.aggregate(c, F.lit(0), lambda a, x: a + F.coalesce(of(x, t.elementType), F.lit(0)))
        if kind == "map":
            return of(F.map_values(c), T.ArrayType(t.valueType))
        return F.length(c.cast("string"))

    return sum((F.coalesce(of(F.col(f.name), f.dataType), F.lit(0)) for f in df.schema.fields), F.lit(0))


def largest_rows(df: DataFrame, k: int, score: Column, length: Column, index: str) -> DataFrame:
    """The k heaviest rows; k is a batch size times accumulation steps, so a
    top-k per partition and one merge."""
    if k <= 0:
        raise ValueError("k must be positive")
    ranked = df.withColumns({"score": score, "sequence_length": length})
    return ranked.orderBy(F.desc("score"), F.desc("sequence_length"), F.desc(index)).limit(k)


def vocabulary_additions(
    new: DataFrame, base: DataFrame, token: str = "token", multiple: int = 128, script: Column | None = None
) -> DataFrame:
    """Tokens of one script that the base lacks, cut to a multiple.

    The additions are a vocabulary, far smaller than the text it comes from, so
    they are written once. The cut drops fewer than ``multiple`` tokens from the
    end of the order: only that tail is ever sorted, the rest is one filter.
    """
    wanted = new.where(contains_hangul(F.col(token)) if script is None else script).select(token).distinct()
    added = materialise(wanted.join(base.select(token).distinct(), token, "left_anti"), "additions")
    n = added.agg(F.count("*")).scalar()
    tail = added.orderBy(F.desc(token)).limit(multiple - 1)
    place = F.row_number().over(W.orderBy(F.desc(token)))
    first_dropped = tail.select(token, place.alias("_p")).where(F.col("_p") == F.pmod(n, F.lit(multiple)))
    cut = first_dropped.select(token).scalar()
    return added.where(F.coalesce(F.col(token) < cut, F.lit(True)))
