"""Vector-retrieval queries: every vector is a query."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunetables.config import HitOptions, NdcgOptions
from tunetables.operators import retrieval as R
from tunetables.operators.staging import materialise
from tunetables.plans import fixtures as X
from tunetables.plans.registry import query, r6

_HIT = HitOptions()
_NDCG = NdcgOptions()
#: both query vectors are left out of the candidates, so search two deeper
SPARE = 2


#: ranked by the share of the largest possible score, at the precision of single floats
_LONGEST = "(select sqrt(max(list_dot_product(embedding::double[], embedding::double[]))) from embeddings)"


def _knn_sql(scale: str = "1") -> str:
    return f"""
with e as (select vec_id, list_transform(embedding::double[], lambda x: x * {scale}) as v from embeddings),
n as (select *, sqrt(list_dot_product(v, v)) as norm from e), m as (select max(norm) as longest from n),
s as (select a.vec_id as qid, b.vec_id as item_id, list_dot_product(a.v, b.v) as dot, a.norm * longest as reach from n a, n b, m),
r as (select *, row_number() over (partition by qid order by round(dot / reach, {R.DIGITS}) desc, item_id) as rank from s)
select qid, item_id, round(dot / reach, 6) as share, rank from r where rank <= 10"""


def _knn(spark: SparkSession, sf: str, scale: float = 1.0, **options) -> DataFrame:
    e = X.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("v"))
    found = R.knn(e, e, 10, qid="vec_id", query="v", item_id="vec_id", item="v", small_query_bytes=0, **options)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    norms = e.select(F.col("vec_id").alias("qid"), norm.alias("norm"))
    longest = e.agg(F.max(norm)).scalar()
    return found.join(norms, "qid").select("qid", "item_id", r6(F.col("score") / (F.col("norm") * longest)).alias("share"), F.col("rank").cast("bigint").alias("rank"))


@query(_knn_sql())
def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _knn(spark, sf)


@query(_knn_sql())
def knn_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the cell search, the path of large item tables."""
    return _knn(spark, sf, cell_rows=50)


@query(_knn_sql("1e-5::double"))
def knn_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors far from unit length rank alike."""
    return _knn(spark, sf, 1e-5)


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    """Original vector v and rewritten vector v + 1 (the last one wraps)."""
    e = X.table(spark, sf, "embeddings")
    last = e.agg(F.max("vec_id")).first()[0]
    follow = F.when(F.col("vec_id") == last, F.lit(0)).otherwise(F.col("vec_id") + 1).alias("rid")
    q = e.select(F.col("vec_id").alias("k"), "label", F.col("embedding").alias("original"), follow)
    return q.join(e.select(F.col("vec_id").alias("rid"), F.col("embedding").alias("rewritten")), "rid")


_RANKED_SQL = f"""
with q as (select q.vec_id as k, q.label, q.embedding as original, r.vec_id as rid, r.embedding as rewritten
  from embeddings q join embeddings r on r.vec_id = case when q.vec_id = (select max(vec_id) from embeddings) then 0 else q.vec_id + 1 end),
v as (select k, label, rid, 'original' as version, original as e from q union all select k, label, rid, 'rewritten', rewritten from q),
s as (select k, version, v.label = i.label as relevant, i.vec_id as item_id,
    round(list_dot_product(e::double[], i.embedding::double[]) / (sqrt(list_dot_product(e::double[], e::double[])) * {_LONGEST}), {R.DIGITS}) as score
  from v, embeddings i where i.vec_id <> v.k and i.vec_id <> v.rid),
ranked as (select *, row_number() over (partition by k, version order by score desc, item_id) as rank from s)"""


def _ranked(spark: SparkSession, sf: str, queries: DataFrame, depth: int, written: bool = False) -> DataFrame:
    """Candidates of both versions without the query vectors, ranked anew. What is
    ``written`` can be read more than once."""
    e = X.table(spark, sf, "embeddings")
    lists = R.knn_pair_lists(queries, e, depth + SPARE, "k", "original", "rewritten", item_id="vec_id", small_query_bytes=0)
    # by the key as lists: what is grouped by the key shuffles no candidates
    lists = lists.select("k", "version", "item_id").repartition(F.col("k")).join(queries.select("k", "rid", "label"), "k")
    others = F.filter("item_id", lambda x: (x != F.col("k")) & (x != F.col("rid")))
    lists = lists.select("k", "version", "label", others.alias("item_id"))
    once = e.groupBy("vec_id").count().where("count > 1").isEmpty()
    if once:  # a candidate meets one label, so its place in the list is its rank
        lists = lists.withColumn("item_id", F.slice("item_id", 1, depth))
        lists = materialise(lists, "candidates") if written else lists
    labels = e.select(F.col("vec_id").alias("item_id"), F.col("label").alias("item_label"))
    rows = lists.select("k", "version", "label", F.posexplode("item_id").alias("_at", "item_id")).join(labels, "item_id")
    rows = rows.select("k", "version", "item_id", F.col("label") == F.col("item_label"), F.col("_at") + 1).toDF("k", "version", "item_id", "relevant", "rank")
    if not once:
        again = W.partitionBy("k", "version").orderBy("rank")
        rows = rows.withColumn("rank", F.row_number().over(again)).where(F.col("rank") <= depth)
        rows = materialise(rows, "ranked") if written else rows
    return rows


def _hit_sql(opt: HitOptions) -> str:
    miss = opt.top_k + 1
    base = f"(ln(o) - ln(r)) / ln({miss})"
    return f"""{_RANKED_SQL},
h as (select k, coalesce(min(rank) filter (relevant and version = 'original' and rank <= {opt.top_k}), {miss}) as o,
  coalesce(min(rank) filter (relevant and version = 'rewritten' and rank <= {opt.top_k}), {miss}) as r from ranked group by k)
select k, case when o > {opt.top_k} then 0 else o end as original_rank, case when r > {opt.top_k} then 0 else r end as rewritten_rank,
  round(least(1.0, greatest(-1.0, case when {opt.rank_margin} > 0 and abs(o - r) <= {opt.rank_margin} then 0.0 else {base} end * {opt.shaping_weight}
    + case when r <= 5 then 0.5 when r <= 10 then 0.3 when r <= 20 then 0.1 else 0.0 end
    - case when o <= 5 and r > 5 then 0.5 when o <= 10 and r > 10 then 0.3 when o <= 20 and r > 20 then 0.1 else 0.0 end)), 6) as hit_reward
from h"""


def _hit(opt: HitOptions):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ranked = _ranked(spark, sf, _queries(spark, sf), opt.top_k)
        at = R.hit_locations(ranked, "k")
        at = at.select("k", *[F.col(f"{v}_rank").cast("bigint").alias(f"{v}_rank") for v in R.VERSIONS])
        return at.withColumn("hit_reward", r6(R.hit_reward(F.col("original_rank"), F.col("rewritten_rank"), opt)))

    return run


_MARGIN = HitOptions(rank_margin=15, shaping_weight=0.5)
query(_hit_sql(_HIT), "retrieval_hit_reward")(_hit(_HIT))
query(_hit_sql(_MARGIN), "retrieval_hit_margin")(_hit(_MARGIN))


def _ndcg_sql(mode: str, cached: bool) -> str:
    ks, ws = _NDCG.top_ks, _NDCG.weights
    lines = []
    for k, w in zip(ks, ws):
        gain = "sum(case when relevant and rank <= {k} and version = '{v}' then 1 / log2(rank + 1) else 0 end)"
        new = gain.format(k=k, v="rewritten")
        old = gain.format(k=k, v="original")
        lines.append((k, w, f"{new} as n{k}, {old} as o{k}"))
    ideals = ", ".join(f"{sum(1 / math.log2(i + 2) for i in range(n)):.17g}" for n in range(1, max(ks) + 1))
    parts = []
    for k, w, _ in lines:
        n = f"(n{k} / idcg[least({k}, num)])"
        o = f"(o{k} / idcg[least({k}, num)])"
        if cached:
            o = f"(case when k % 2 = 0 then 0.25 else {o} end)"
        d = f"({n} - {o})"
        delta = f"case when {d} >= 0 then {d} / ((1.0 - {o}) + 1e-8) else {d} / ({o} + 1e-8) end"
        parts.append(f"{w:.17g} * ({delta if mode == 'relative' else n})")
    return f"""{_RANKED_SQL},
c as (select label, count(*) as n from embeddings group by label),
num as (select q.k, (select n from c where c.label = q.label) - 1 - case when r.label = q.label then 1 else 0 end as num
  from q join embeddings r on r.vec_id = q.rid),
g as (select ranked.k, any_value(num.num) as num, {", ".join(x for _, _, x in lines)} from ranked join num on num.k = ranked.k group by ranked.k),
i as (select *, [{ideals}]::double[] as idcg from g)
select k, num as num_relevant, case when num > 0 then round(least(1.0, greatest(-1.0, {" + ".join(parts)})), 6) end as ndcg_reward from i"""


def _ndcg(mode: str, cached: bool):
    opt = NdcgOptions(reward_mode=mode)

    def run(spark: SparkSession, sf: str) -> DataFrame:
        e = X.table(spark, sf, "embeddings")
        queries = _queries(spark, sf)
        if cached:
            full = F.create_map(*[x for k in opt.top_ks for x in (F.lit(str(k)), F.lit(0.25))])
            queries = queries.withColumn("cache", F.when(F.col("k") % 2 == 0, full))
        cache = "cache" if cached else None
        searched = R.searched_versions(queries, opt, "original", cache)
        ranked = _ranked(spark, sf, searched, opt.depth)
        # relevant = same label, less the two query vectors themselves
        sizes = e.groupBy("label").agg(F.count("*").alias("n"))
        partner = e.select(F.col("vec_id").alias("rid"), F.col("label").alias("rlabel"))
        own = F.when(F.col("rlabel") == F.col("label"), 2).otherwise(1)
        totals = queries.join(sizes, "label").join(partner, "rid")
        totals = totals.select("k", (F.col("n") - own).alias("num_relevant"), *([cache] if cache else []))
        out = R.ndcg_rewards(ranked, totals, "k", opt, cache)
        return out.select("k", "num_relevant", r6("ndcg_reward").alias("ndcg_reward"))

    return run


query(_ndcg_sql("relative", False), "retrieval_ndcg_reward")(_ndcg("relative", False))
query(_ndcg_sql("absolute", False), "retrieval_ndcg_absolute")(_ndcg("absolute", False))
query(_ndcg_sql("relative", True), "retrieval_ndcg_cached")(_ndcg("relative", True))


# rows as a reward job has them: other categories, blank queries, blank and empty truths
_ROWS = """
select vec_id as k, case when vec_id % 5 = 0 then 'doc_math' else 'doc_retrieval' end as category,
  case when vec_id % 7 = 0 then '' else concat('query ', cast(vec_id as varchar(20))) end as query,
  case when vec_id % 11 = 0 then '' when vec_id % 13 = 0 then '[]'
    else concat('[', cast(vec_id + 2 as varchar(20)), ', [', cast(vec_id + 3 as varchar(20)), ', ', cast(vec_id + 2 as varchar(20)), ']]') end as truth
from embeddings
"""
_ABSOLUTE = NdcgOptions(reward_mode="absolute")


def _gain(k: int) -> str:
    return f"sum(case when hit and version = 'rewritten' and rank <= {k} then 1 / log2(rank + 1) else 0 end)"


@query(f"""{_RANKED_SQL},
x as ({_ROWS}),
f as (select ranked.*, item_id in (k + 2, k + 3) and truth like '[%, [%' as hit from ranked join x using (k)),
h as (select k, coalesce(min(rank) filter (hit and version = 'original' and rank <= {_HIT.top_k}), {_HIT.top_k + 1}) as o,
  coalesce(min(rank) filter (hit and version = 'rewritten' and rank <= {_HIT.top_k}), {_HIT.top_k + 1}) as r,
  {" + ".join(f"{w:.17g} * {_gain(k)} / {sum(1 / math.log2(i + 2) for i in range(min(k, 2))):.17g}" for k, w in zip(_ABSOLUTE.top_ks, _ABSOLUTE.weights))} as n
  from f group by k),
j as (select x.*, o, r, n, category = 'doc_retrieval' and query <> '' and truth <> '' as applies from x join h using (k))
select k, case when applies then round(least(1.0, greatest(-1.0, (ln(o) - ln(r)) / ln({_HIT.top_k + 1})
    + case when r <= 5 then 0.5 when r <= 10 then 0.3 when r <= 20 then 0.1 else 0.0 end
    - case when o <= 5 and r > 5 then 0.5 when o <= 10 and r > 10 then 0.3 when o <= 20 and r > 20 then 0.1 else 0.0 end)), 6) end as hit,
  case when applies and truth <> '[]' then round(n, 6) end as ndcg from j""")
def retrieval_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Both retrieval rewards as operators, with their null rules and double misses."""
    queries = _queries(spark, sf)
    ranked = _ranked(spark, sf, queries, _HIT.top_k, written=True)  # two scorers read it
    ranked = ranked.select("k", "version", F.col("item_id").cast("string").alias("candidate"), "rank")
    rows = R.score_retrieval_hit(X.frame(spark, sf, _ROWS), ranked, _HIT, key="k", output="hit")
    rows = R.score_retrieval_ndcg(rows, ranked, _ABSOLUTE, key="k", output="ndcg")
    return rows.select("k", r6("hit").alias("hit"), r6("ndcg").alias("ndcg"))
