"""One-to-one matches of similar texts within groups, best pairs first.

The greedy order takes the pair with the highest similarity, then the lowest gold
index, then the lowest prediction index, and removes both ends. A pair that is the
first of all pairs at both of its ends will be taken whatever else is, so all such
pairs are taken in one round of joins, until no pair is left. A group of any size is
spread over many tasks.

Equal texts of one group and side are a class. Pairs are kept between classes, and a
round takes as many copies of a class at once as go before those of any class that
ties with it, so copies are never paired all with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunetables.operators.similar import similar_values
from tunetables.operators.staging import materialise

#: indices that are ranked by one task, and ranks that are listed in one row
BLOCK = 10_000


def class_key() -> Column:
    """128 bits that stand for a text in a group, null group included."""
    return F.unhex(F.md5(F.to_json(F.struct("group", "text"))))


def ranked_members(rows: DataFrame) -> DataFrame:
    """(key, side, index, rank): members of each class, numbered from 0 by index. A
    class may be most of the table: it is ranked block by block."""
    cell = ["key", "side", "block"]
    placed = materialise(rows.select("key", "side", "index", F.floor(F.col("index") / BLOCK).alias("block")), "places")
    before = F.sum("n").over(W.partitionBy("key", "side").orderBy("block")) - F.col("n")
    # equal rows (index included) share a block however many they are: numbered as one, then listed
    counted = placed.groupBy(*cell, "index").agg(F.count("*").alias("copies"))
    totals = materialise(counted.groupBy(*cell).agg(F.sum("copies").alias("n")), "totals").withColumn("before", before)
    within = F.sum("copies").over(W.partitionBy(*cell).orderBy("index")) - F.col("copies")
    first = counted.withColumn("within", within).join(totals.select(*cell, "before"), cell)
    return listed(first, "copies").select("key", "side", "index", (F.col("before") + F.col("within") + F.col("k")).alias("rank"))


def listed(df: DataFrame, n: str) -> DataFrame:
    """Each row as often as ``n`` says, with ``k`` from 0; in two steps, so that no row
    holds a long list."""
    blocks = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / BLOCK))).alias("_b"))
    return blocks.select("*", F.explode(F.sequence(F.col("_b") * BLOCK, F.least(F.col(n), (F.col("_b") + 1) * BLOCK) - 1)).alias("k")).drop("_b")


def similar_classes(classes: DataFrame, least: float) -> DataFrame:
    """(g, p, similarity): classes of one group and different sides whose texts are
    similar but not equal."""
    pairs = materialise(similar_values(classes, "text", least).select("value", "other", "similarity"), "similar-classes")
    one = classes.select(F.col("text").alias("value"), "group", F.col("side").alias("s1"), F.col("key").alias("k1"))
    two = classes.select(F.col("text").alias("other"), F.col("group").alias("g2"), F.col("side").alias("s2"), F.col("key").alias("k2"))
    met = pairs.join(one, "value").join(two, "other").filter(F.col("group").eqNullSafe(F.col("g2")) & (F.col("s1") != F.col("s2")))
    gold = F.col("s1") == "gold"
    return met.select(F.when(gold, F.col("k1")).otherwise(F.col("k2")).alias("g"), F.when(gold, F.col("k2")).otherwise(F.col("k1")).alias("p"), "similarity")


def _bound(chosen: DataFrame, end: str, other: str, members: DataFrame) -> DataFrame:
    """(end, n): how many copies of the class at ``end`` go before the first of the
    classes that tie with it at ``other``."""
    tied = chosen.filter(F.col(f"{other}_tie").isNotNull()).select(F.col(end).alias("key"), f"{end}_text", f"{end}_taken", f"{other}_tie")
    here = members.join(tied, "key").filter(
        (F.col("rank") >= F.col(f"{end}_taken")) & (F.struct(F.col("index"), F.col(f"{end}_text")) < F.col(f"{other}_tie"))
    )
    return here.groupBy(F.col("key").alias(end)).agg(F.count("*").alias(f"{end}_free"))


def match_classes(edges: DataFrame, classes: DataFrame, members: DataFrame) -> tuple[list[DataFrame], int]:
    """Rounds over (g, p, similarity) and classes (key, text, n, taken): the runs
    (g, g_from, p, p_from, n, similarity) that each took, and how many there were."""
    taken: list[DataFrame] = []
    edges = materialise(edges, "edges")
    while edges.head(1):
        ends = edges.select(F.col("g").alias("key")).unionByName(edges.select(F.col("p").alias("key"))).distinct()
        heads = materialise(
            classes.join(ends, "key", "left_semi").join(members.withColumnRenamed("rank", "taken"), ["key", "taken"]).select(
                "key", "text", "n", "taken", F.struct("index", "text").alias("head")
            ), "heads"
        )

        def end(name: str, heads=heads) -> DataFrame:
            return heads.select(*(F.col(c).alias(name if c == "key" else f"{name}_{c}") for c in heads.columns))

        live = materialise(edges.join(end("g"), "g").join(end("p"), "p").withColumn("by", F.negative("similarity")), "live")
        at_g = live.groupBy("g").agg(F.min(F.struct("by", "p_head")).alias("g_best"))
        at_p = live.groupBy("p").agg(F.min(F.struct("by", "g_head")).alias("p_best"))
        judged = materialise(live.join(at_g, "g").join(at_p, "p"), "judged")
        g_tie = judged.filter("by = g_best.by and p_head <> g_best.p_head").groupBy("g").agg(F.min("p_head").alias("g_tie"))
        p_tie = judged.filter("by = p_best.by and g_head <> p_best.g_head").groupBy("p").agg(F.min("g_head").alias("p_tie"))
        firsts = judged.filter("by = g_best.by and p_head = g_best.p_head and by = p_best.by and g_head = p_best.g_head")
        chosen = materialise(firsts.join(g_tie, "g", "left").join(p_tie, "p", "left"), "chosen")
        # at g other predictions tie: those of p before their heads may be taken; and the other way round
        free = chosen.join(_bound(chosen, "p", "g", members), "p", "left").join(_bound(chosen, "g", "p", members), "g", "left")
        left_g, left_p = F.col("g_n") - F.col("g_taken"), F.col("p_n") - F.col("p_taken")
        run = free.select(
            "g", F.col("g_taken").alias("g_from"), "p", F.col("p_taken").alias("p_from"),
            F.least(left_g, left_p, "g_free", "p_free").alias("n"), "similarity",
        )
        run = materialise(run, "runs")
        taken.append(run)
        used = run.select(F.col("g").alias("key"), F.col("n").alias("more")).unionByName(run.select(F.col("p").alias("key"), F.col("n").alias("more")))
        classes = materialise(classes.join(used, "key", "left").select("key", "text", "n", (F.col("taken") + F.coalesce("more", F.lit(0))).alias("taken")), "classes")
        gone = classes.filter("taken = n").select("key")
        edges = materialise(
            edges.join(gone.withColumnRenamed("key", "g"), "g", "left_anti").join(gone.withColumnRenamed("key", "p"), "p", "left_anti"), "edges"
        )
    return taken, len(taken)


def greedy_matches(df: DataFrame, least: float = 0.95) -> DataFrame:
    """(group, gold, prediction, similarity): pairs of indices that the greedy order
    matches, of a table (group, side, index, text); side is ``gold`` or ``pred``.

    Equal texts match with 1, the kth copy with the kth. Others match from ``least``
    on (0.7 at least). Null is a group, but no text, index or side; other sides and
    columns are not read. An index may repeat: of texts at one index the lesser
    goes first. Empty tables give no rows."""
    rows = df.select("group", "side", F.col("index").cast("long").alias("index"), "text")
    rows = materialise(rows.filter("text is not null and index is not null and side in ('gold', 'pred')").withColumn("key", class_key()), "matching")
    members = materialise(ranked_members(rows), "members")
    classes = materialise(rows.groupBy("key", "side").agg(F.first("group").alias("group"), F.first("text").alias("text"), F.count("*").alias("n")), "sides")
    golds, preds = (classes.filter(F.col("side") == s).select("key", F.col("n").alias(f"n_{s}")) for s in ("gold", "pred"))
    equal = materialise(golds.join(preds, "key").select("key", F.least("n_gold", "n_pred").alias("taken")), "equal")
    rest = materialise(
        classes.join(equal, "key", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).filter("taken < n"), "rest"
    )
    # what equal texts leave of a class is on one side only, so the key tells it
    left = members.join(rest.select("key", "side"), ["key", "side"], "left_semi").drop("side")
    runs, _ = match_classes(similar_classes(rest, least), rest.select("key", "text", "n", "taken"), materialise(left, "left"))
    exact = equal.select(F.col("key").alias("g"), F.lit(0).cast("long").alias("g_from"), F.col("key").alias("p"), F.lit(0).cast("long").alias("p_from"),
                         F.col("taken").alias("n"), F.lit(1.0).alias("similarity"))
    for r in runs:
        exact = exact.unionByName(r)
    pairs = materialise(listed(exact, "n").select("g", (F.col("g_from") + F.col("k")).alias("g_rank"), "p", (F.col("p_from") + F.col("k")).alias("p_rank"), "similarity"), "pairs")

    def side(name: str, key: str, index: str) -> DataFrame:
        return members.filter(F.col("side") == name).select(F.col("key").alias(key), F.col("rank").alias(f"{key}_rank"), F.col("index").alias(index))

    groups = classes.filter("side = 'gold'").select(F.col("key").alias("g"), "group")
    return pairs.join(side("gold", "g", "gold"), ["g", "g_rank"]).join(side("pred", "p", "prediction"), ["p", "p_rank"]).join(groups, "g").select(
        "group", "gold", "prediction", "similarity"
    )
