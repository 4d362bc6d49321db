"""The registered queries of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.llm import ballcodes, decontaminate, fim, langid, lines, neardup, packing, pieces, quality, suffixes, tokencount, urls, warc
from tunetables.plans.registry import query

RISK, ERROR = 0.01, 0.05

ALLOW = ["com/", "www.example.com/en/"]
BLOCK = ["example.com/en/", "net/es/", "net/fr/"]
TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT
    )


_RULES_SQL = ", ".join(
    f"('{r}', '{v}')" for rules, v in ((ALLOW, "allow"), (BLOCK, "block")) for r in rules
)


@query(f"""
with rules(rule, verdict) as (values {_RULES_SQL}),
parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
hosts as (select *, split_part(rule, '/', 1) as h, substr(rule, strpos(rule, '/')) as p from rules),
fits as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from parts join hosts on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join fits using (page_id)
""")
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), ALLOW, BLOCK)


@query()
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Plan(size=3, percent=85, rows=6))


@query()
def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=400, batches=3, whole=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


_GAP = r"[\x20\x09-\x0D]+"
_GRID_SQL = ", ".join(f"('{r.name}', {i}, {c})" for r in quality.RULES for i, c in enumerate(r.cutoffs))

#: one row per document: the counts, the measures and the verdicts
QUALITY_SQL = rf"""
with docs as (
  select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
    list_filter(string_split_regex(coalesce(text, ''), '{_GAP}'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select doc_id, unnest(range(0, len(words) - {quality.WINDOW - 1})) as pos,
    unnest(list_transform(range(0, len(words) - {quality.WINDOW - 1}), lambda i: array_to_string(words[i + 1:i + {quality.WINDOW}], ' '))) as w
  from docs where len(words) >= {quality.WINDOW}),
twice as (select doc_id, w from windows group by all having count(*) > 1),
texts as (select doc_id, pos, 2 as n from windows semi join twice using (doc_id, w)),
repeats as (
  select doc_id, count(distinct pos + k) as n_repeat_words
  from texts, range({quality.WINDOW}) as r(k) where n > 1 group by doc_id),
counts as (
  select doc_id, stratum, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(text) - length(translate(text, '{quality.SYMBOLS}', '')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines,
    length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as capitals
  from docs left join repeats using (doc_id)),
measured as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    case when word_chars > 0 then n_symbols / word_chars else 0 end as symbol_share,
    case when n_lines > 0 then n_dup_lines / n_lines else 0 end as duplicate_line_share,
    case when n_words > 0 then n_repeat_words / n_words else 0 end as repeat_share,
    case when word_chars > 0 then capitals / word_chars else 0 end as shout_share
  from counts),
scores as (
  select doc_id, stratum, base_failed, unnest(['symbol_share', 'duplicate_line_share', 'repeat_share', 'shout_share']) as rule,
    unnest([symbol_share, duplicate_line_share, repeat_share, shout_share]) as score
  from measured),
grid(rule, nth, cutoff) as (values {_GRID_SQL}),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
tests as (
  select stratum, rule, nth, cutoff, count(*) as n, count(*) filter (score > cutoff) as rejected
  from scores join grid using (rule) where not base_failed and doc_id in (select doc_id from good) group by all),
levels as (select {ERROR} / ({len(quality.RULES)} * greatest(1, count(distinct stratum))) as level from tests),
tails as (
  select t.stratum, t.rule, t.nth, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({RISK}) + (n - k) * ln(1 - {RISK}))) as tail
  from (select *, unnest(range(0, rejected + 1)) as k from tests) t group by all),
passes as (
  select *, rejected < n * {RISK} and tail <= (select level from levels) as passed from tests join tails using (stratum, rule, nth)),
walks as (
  select *, bool_and(passed) over (partition by stratum, rule order by nth) as sure from passes),
cutoffs as (select stratum, rule, arg_max(cutoff, nth) as cutoff from walks where sure group by all),
failed as (select distinct doc_id from scores join cutoffs using (stratum, rule) where score > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from failed) as kept
from measured
"""


@query(QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quality.RULES, RISK, ERROR
    )
    return judged.drop("rules_failed")


@query()
def op1_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4).cast("long"))
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold == 2, F.lit(False)))
    model = langid.fit(docs.filter(fold != 2))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@query()
def op4_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"), least=0, every_row=True)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
with units as (
  select doc_id, unnest(range(0, len(l))) as unit, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
placed as (
  select *, cast(sum(length(line) + 1) over (partition by doc_id order by unit) - length(line) - 1 as bigint) as start,
    trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) as plain
  from units),
ranked as (
  select *, count(*) over (partition by plain) as copies, row_number() over (partition by plain order by doc_id, unit) as nth,
    first_value(doc_id) over (partition by plain order by doc_id, unit) as first_doc_id,
    first_value(unit) over (partition by plain order by doc_id, unit) as first_unit
  from placed where plain <> '' and len(string_split(plain, ' ')) +
    len(regexp_extract_all(plain, '[\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}]')) // 2 >= 10),
gone as (select *, start + length(line) as stop from ranked where nth > 1),
spans as (
  select doc_id, count(*) as n_removed, string_agg(format('{}-{}:{}.{}', start, stop, first_doc_id, first_unit), ',' order by start) as removed
  from gone group by doc_id),
left_over as (
  select doc_id, string_agg(case when g.unit is null then p.line || case when p.unit < last then chr(10) else '' end else '' end, '' order by p.unit) as text
  from (select *, max(unit) over (partition by doc_id) as last from placed) p left join gone g using (doc_id, unit) group by doc_id)
select d.doc_id, coalesce(n_removed, 0) as n_removed, coalesce(removed, '') as removed, case when d.text is not null then l.text end as text
from documents d left join spans using (doc_id) left join left_over l using (doc_id)
""")
def op5_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    left = lines.without_repeats(docs, lines.repeated_units(docs, kind="line", least_words=10))
    places = F.transform("removed", lambda s: F.format_string("%d-%d:%d.%d", s["start"], s["stop"], s["first"], s["first_unit"]))
    return left.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join(places, ",").alias("removed"), "text")


def _codes_sql(plan: ballcodes.Plan) -> str:
    """The rounds as steps of common table expressions, in whole numbers."""
    steps = [f"""
kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {plan.scale})::bigint) as q
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select vec_id, p, list_slice(q, p * len(q) // {plan.parts} + 1, (p + 1) * len(q) // {plan.parts}) as x
  from kept, range({plan.parts}) as r(p)),
book0 as (
  select p, row_number() over (partition by p order by vec_id) - 1 as entry, x as c
  from parts where vec_id in (select vec_id from kept order by vec_id limit {plan.entries}))"""]
    for r in range(plan.rounds + 1):
        steps.append(f"""
near{r} as (
  select vec_id, p, min((list_inner_product(list_transform(x, lambda a: a::double), list_transform(x, lambda a: a::double))
    - 2 * list_inner_product(list_transform(x, lambda a: a::double), list_transform(c, lambda a: a::double))
    + list_inner_product(list_transform(c, lambda a: a::double), list_transform(c, lambda a: a::double)))::bigint * 256 + entry) as best
  from parts join book{r} using (p) group by all)""")
        if r < plan.rounds:
            steps.append(f"""
mean{r} as (
  select p, entry, list(v order by pos) as c from (
    select p, best % 256 as entry, pos, floor(sum(v) / count(*))::bigint as v
    from (select n.p, best, unnest(x) as v, generate_subscripts(x, 1) as pos from near{r} n join parts using (vec_id, p)) group by all)
  group by all),
book{r + 1} as (select p, entry, coalesce(m.c, b.c) as c from book{r} b left join mean{r} m using (p, entry))""")
    last = plan.rounds
    return f"""
with {",".join(steps)},
codes as (
  select vec_id, string_agg(printf('%02x', best % 256), '' order by p) as code, sum(best // 256)::bigint as error from near{last} group by vec_id),
digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, entry)) as codebooks_sha256 from book{last})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from codes join kept using (vec_id), digest"""


CODES = ballcodes.Plan()


@query(_codes_sql(CODES))
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = ballcodes.compress(table(spark, sf_dir, "embeddings"), CODES)
    return ballcodes.label_errors(codes).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(ballcodes.digest(book.entries) if book else None).alias("codebooks_sha256"),
    )


@query(r"""
with docs as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units
  from documents),
cuts as (
  select *, len(units) as n,
    ('0x' || substr(h, 1, 8))::bigint % (len(units) + 1) as h1, ('0x' || substr(h, 9, 8))::bigint % (len(units) + 1) as h2,
    text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 100 as plain,
    ('0x' || substr(h, 25, 8))::bigint % 100 < 50 as last
  from docs),
pieces as (
  select *, array_to_string(list_slice(units, 1, least(h1, h2)), '') as prefix,
    array_to_string(list_slice(units, least(h1, h2) + 1, greatest(h1, h2)), '') as middle,
    array_to_string(list_slice(units, greatest(h1, h2) + 1, n), '') as suffix
  from cuts)
select doc_id, n, case when plain then 'plain' when last then 'spm' else 'psm' end as form,
  case when not plain then length(prefix) end as prefix_chars, case when not plain then length(middle) end as middle_chars,
  sha256(case when plain then text when last then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from pieces
""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"), fim.Plan())
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore("output", "form"), 256).alias("restored_sha256"),
    )


@query()
def op13_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
