"""URL rules by a cascade of Bloom filters, in DataFrame functions only.

A rule is a host with an optional path prefix. A url asks for a few keys: its
host's last labels, joined with the beginnings of its path, at the lengths that
the rules have. Level 0 encodes the listed keys; level 1 the corpus's other keys
that level 0 lets through; level 2 the listed keys that level 1 lets through;
and so on until nothing passes wrongly. Over the corpus's keys membership is then
exact, and a url is judged by bit tests alone, without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bits of a filter for a key, and the bits a key sets
BITS, PROBES = 10, 4


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _AZ, _az), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Level:
    """A Bloom filter as words of 63 bits, held as a literal, and its place in the cascade."""

    bits: int
    words: tuple[int, ...]
    nth: int

    def passes(self, key: Column) -> Column:
        words = F.array(*[F.lit(w).cast("long") for w in self.words])
        return reduce(lambda a, b: a & b, (self._bit(words, position(key, i, self.bits, self.nth)) for i in range(PROBES)))

    @staticmethod
    def _bit(words: Column, at: Column) -> Column:
        word = F.get(words, F.floor(at / 63).cast("int"))
        return F.getbit(word, (at % 63).cast("int")) == 1


def position(key: Column, probe: int, bits: int, nth: int) -> Column:
    """A bit of a key in the cascade's nth level. Levels hash apart: keys that look
    alike in one of them would else do so in every other of as many bits."""
    return F.pmod(F.xxhash64(key, F.lit(nth * PROBES + probe)), F.lit(bits).cast("long"))


def build_level(keys: DataFrame, n: int, nth: int) -> Level:
    """The filter of a table of n keys: its set bits are grouped into words by
    Spark; the driver holds ``BITS`` bits for a key of the rules or of their few
    false positives, never the corpus's keys."""
    bits = max(64, BITS * n)
    at = keys.select(F.explode(F.array(*[position(F.col("key"), i, bits, nth) for i in range(PROBES)])).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 63).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 63 as int))")).alias("value")
    )
    held = {r["word"]: r["value"] for r in words.collect()}
    return Level(bits, tuple(held.get(i, 0) for i in range(math.ceil(bits / 63))), nth)


def build_cascade(listed: DataFrame, universe: DataFrame, label: str = "cascade") -> list[Level]:
    """Levels that tell listed keys from all other keys of the universe (one
    column, ``key``, each). The universe is scanned once; later levels see only
    what the one before let through. Null keys count for nothing."""
    listed = materialise(listed.select("key").dropna().distinct(), label)
    n = listed.count()
    if not n:
        return []
    levels = [build_level(listed, n, 0)]
    inside = listed
    passed = universe.filter(levels[0].passes(F.col("key"))).select("key").distinct()
    outside = materialise(passed.join(listed, "key", "left_anti"), label)
    for turn in range(1, 64):
        wrong = outside if turn % 2 else inside
        n = wrong.count()
        if not n:
            return levels
        levels.append(build_level(wrong, n, turn))
        kept = materialise((inside if turn % 2 else outside).filter(levels[-1].passes(F.col("key"))), label)
        inside, outside = (kept, outside) if turn % 2 else (inside, kept)
    raise RuntimeError("keys that hash alike in every level")  # 64 levels of false positives do not happen


def member(levels: list[Level], key: Column) -> Column:
    """Whether the key is listed: the first level that it fails tells, by its
    number's parity; a key that passes all of an odd number of levels is listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        answer = F.when(levels[i].passes(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def candidate_keys(host: Column, path: Column, rules: list[str]) -> list[Column]:
    """The rule strings that could fit, for every pair of label count and path
    length that some rule has; null where the url is too short for it."""
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in map(split_rule, rules)})
    labels = F.split(host, r"\.")
    return [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= m),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, m)),
        )
        for n, m in shapes
    ]


def judge_urls(df: DataFrame, allow: list[str], block: list[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of ``df``; other columns are
    not read. The longest fitting rule decides; without one the url is in no list
    and is allowed. A null url, or one without ``://``, has an empty host and path.
    A rule that is in both lists blocks. Rules are short lists on the driver; a
    rule without a slash fits every path."""
    spark: SparkSession = df.sparkSession
    both = [*allow, *block]
    found = df.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = candidate_keys(F.col("host"), F.col("path"), both)
    if not keys:
        return found.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    universe = found.select(F.explode(F.array_distinct(F.array(*keys))).alias("key")).dropna()

    def cascade(rules: list[str]) -> list[Level]:
        rows = [("".join(split_rule(r)),) for r in rules]
        return build_cascade(spark.createDataFrame(rows, "key string"), universe)

    allowed, blocked = cascade(allow), cascade(block)
    asked = F.transform(
        F.filter(F.array(*keys), lambda k: k.isNotNull()),
        lambda k: F.struct(F.length(k).alias("n"), member(blocked, k).alias("block"), member(allowed, k).alias("allow"), k.alias("key")),
    )
    best = F.array_max(F.filter(asked, lambda s: s["block"] | s["allow"]))
    return found.withColumn("_best", best).select(
        id_col, "host", "path", F.col("_best.key").alias("rule"),
        F.when(F.col("_best.block"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )
