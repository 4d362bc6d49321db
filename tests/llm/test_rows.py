"""Words, shingles, tokens, urls, languages, lines against plain versions."""

import random
import re
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tunetables.llm import langid, lines, packing, tokencount, urls, words
from tunetables.llm import queries as llm_queries
from tunetables.plans.registry import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = ["a", "B", "é", "É", " ", "  ", "\n", "\t", " ", "　", "1", "٣", "'s", "'S", "'ll", "<|endoftext|>", "<|endof", "!", "…", "中",
          "\x1c", "\x85", "​", "́", "😀", "|", "_", "ß", "Ω", "я", "İ", "Σ", "ﬁ", "각", "ᄀ", "ᅡ", "<|startoftext|>", "The", "hello,"]


def strange(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAb é\n\t ", max_size=30)), max_size=6))
def test_word_hashes_tell_words_apart(texts):
    hashes, at = words.word_hashes(pa.array(texts, pa.string()))
    want = [plain_words(t) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(flat)) == len(set(hashes.tolist()))


def test_shingles_are_sets():
    texts = ["a b c d", "a b c d a b c", "x", "", None, "A  b\tc"]
    sets = words.shingles(*words.word_hashes(pa.array(texts)), 3)
    assert [len(s) for s in sets] == [2, 4, 1, 0, 0, 1]
    assert set(sets[0]) < set(sets[1]) and sets[5][0] in sets[0]


def test_blocks_keep_rows_and_bounds():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "y" * 50, "", "z"]})
    parts = list(words.blocks(iter([batch]), limit=12))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 12 for p in parts)


def test_token_counts_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*strange(3000), "x" * 20_000, "", "<|endoftext|>" * 3]
    counter, whole = tokencount._counter(path), tokencount.whole_tokens(path)
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts, whole) == want
    assert len(whole) > 40_000


def test_token_memo_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokencount, "MEMO", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter = tokencount._Counter(path)
    texts = ["qqzx vvkj wwpt", "zzkq qqzx", "jjvv kkww xxqq zzpp"]
    want = [len(e.ids) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count([t], frozenset())[0] for t in texts] == want


def test_token_table_cases(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "hi <|endoftext|>", "b")], "doc_id long, text string, n_tokens string")
    out = tokencount.token_counts(df, public_tokenizers.path("byte_bpe_50k.json"), 1)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 16, 3, True)], key=str)
    assert tokencount.token_counts(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"), 1).count() == 0


def test_packing_ids_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*strange(3000, 2), "The cat, sat. ON|the Mat!", "<|EndOfText|> A. <|endoftext|>, B", "Él, dijo: ¿QUÉ? e\u0301. A\u0301, k\u212a.", "x., y,. z,", None, "a" * 5000]
    ids, at = packing._words(path).encode(pa.array(texts))
    lower = [t for t in texts if t and "<|" not in t]
    apart, cuts = packing._words(path).encode(pa.array(lower))  # the way without a special token in sight
    assert [apart[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [
        e.ids for e in Tokenizer.from_file(path).encode_batch(lower, add_special_tokens=False)
    ]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_packing_memo_starts_afresh(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 5)
    coder = packing._Words(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("a b c, D.", "e f g c! d", "d c b a? h!", "i j k l m n", "a, a. a"):
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(pa.array([text]))[0].tolist() == want


def plain_verdict(url, allow, block):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = []
    for rules, verdict in ((allow, "allow"), (block, "block")):
        for r in rules:
            h, slash, p = r.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                fits.append((len(r), verdict == "block", r, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_rules(spark):
    rng = random.Random(5)
    hosts = ["example.com", "www.example.com", "x.www.example.com", "myexample.com", "a.net", "NET", "net", "com", "", ".com", "a..com", "EXAMPLE.org"]
    rows = [(i, rng.choice(["http://", "://", "ftp://", ""]) + rng.choice(hosts) + rng.choice(["", "/", "/en/", "/en", "/es/x", "/EN/", "?q=/en/", "#/es/", "/fr/://b"]), None)
            for i in range(400)]
    rows += [(400, None, "x"), (400, None, "x"), (None, "http://a.com/", "y"), (401, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, llm_queries.ALLOW, llm_queries.BLOCK).collect())
    want = Counter((i, *plain_verdict(u, llm_queries.ALLOW, llm_queries.BLOCK)) for i, u, _ in rows)
    assert got == want
    assert urls.judge_urls(df.limit(0), ["com/"], []).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, [], []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS", 2)  # a crowded filter, so that several levels are needed
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    listed = spark.range(0, 3000, 7).selectExpr("concat('k', id) as key").unionByName(spark.createDataFrame([(None,), ("other",)], "key string"))
    levels = urls.build_cascade(listed, universe)
    assert len(levels) > 2
    got = {r.key for r in universe.filter(urls.member(levels, universe.key)).collect()}
    assert got == {f"k{i}" for i in range(0, 3000, 7)}


@pytest.mark.parametrize("pair", [4, 9])
def test_small_levels_do_not_repeat_each_other(spark, pair):
    # were levels to hash alike, both keys would pass level 1, and level 2 would be level 0 again
    universe = spark.range(20_000).selectExpr("concat('k', id) as key")
    listed = spark.createDataFrame([(f"a{pair}",), (f"b{pair}",)], "key string")
    both = universe.unionByName(listed)
    levels = urls.build_cascade(listed, both)
    assert {r.key for r in both.filter(urls.member(levels, both.key)).collect()} == {f"a{pair}", f"b{pair}"}


def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op2_languages"](spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in rows if rows[d].held_out and rows[d].lang_pred != "und"]
    assert len(held) > 20 and np.mean([rows[d].lang_pred == truth[d] for d in held]) > 0.9
    model = langid.fit(docs)
    odd = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 !? 34", "x"), (4, "中文中文", "x"), (5, "the " * 5000, "x"), (5, "the " * 5000, "x"), (None, "le la de", None)],
        "doc_id long, text string, lang_pred string",
    )
    out = langid.predict(odd, model, ["doc_id"]).collect()
    assert [r.lang_pred for r in out if r.doc_id in (1, 2, 3)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 7
    assert [r.rejected for r in out if r.doc_id == 4] == [True]
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, none, ["doc_id"]).collect()} == {"und"}


def test_a_prediction_is_its_text_alone():
    texts = ["Und der Zug.", "", "¡qué!", "x"]
    apart = [langid.counts([t])[0][0] for t in texts]
    assert all((a == b).all() for a, b in zip(apart, langid.counts(texts)[0]))


def test_repeated_lines_cases(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(3, f"x\n{line}", 0), (1, f"{line.upper()}\nshort\n  {line} ", 0), (2, None, 0), (4, "", 0), (4, "", 0), (None, f"é\n{line}", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, unit int")
    out = lines.repeated_units(df)
    got = {(r.doc_id, r.unit, r.start, r.stop, r.copies, r.first_doc_id, r.first_unit) for r in out.collect()}
    n = len(line)
    assert got == {(1, 2, n + 7, 2 * n + 10, 4, 1, 0), (3, 1, 2, n + 2, 4, 1, 0), (None, 1, 2, n + 2, 4, 1, 0)}
    kept = {(r.doc_id, r.text) for r in lines.without_repeats(df, out).collect()}
    assert kept == {(3, "x\n"), (1, f"{line.upper()}\nshort\n"), (2, None), (4, ""), (None, "é\n")}
    assert lines.repeated_units(df.limit(0)).count() == 0
    assert lines.without_repeats(df.limit(0), out).count() == 0


def test_two_texts_of_one_id_are_cut_apart(spark):
    a, b = ("%s two three four five six seven eight nine ten" % w for w in ("one", "won"))
    rows = [(1, f"{a}\nx"), (1, f"{b}\n{a}"), (2, f"{b}\ny"), (2, f"{a}\ny"), (2, f"{a}\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(r.text for r in lines.without_repeats(df, lines.repeated_units(df)).collect())
    assert got == Counter([f"{a}\nx", f"{b}\n", "y", "y", "y"])


def test_lines_without_spaces_are_not_one_word(spark):
    line = "文" * 18
    df = spark.createDataFrame([(1, f"{line}\na"), (2, f"b\n{line}"), (3, "字" * 17), (4, "字" * 17), (5, "x" * 99), (6, "x" * 99)], "doc_id long, text string")
    assert [(r.doc_id, r.start, r.stop) for r in lines.repeated_units(df).collect()] == [(2, 2, 20)]


def test_a_line_of_a_third_of_all_rows_and_a_very_long_text(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(i, f"{i}\n{line}") for i in range(300)] + [(999, "\n".join([line] * 40_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in lines.without_repeats(df, lines.repeated_units(df)).collect()}
    assert kept.pop(0) == f"0\n{line}" and kept.pop(999) == ""
    assert kept == {i: f"{i}\n" for i in range(1, 300)}


def test_repeated_paragraphs(spark):
    p = "a b c\nd e f"
    df = spark.createDataFrame([(1, f"{p}\n\nx"), (2, f"y\n\n{p}")], "doc_id long, text string")
    got = [(r.doc_id, r.start, r.stop) for r in lines.repeated_units(df, kind="paragraph", least_words=3).collect()]
    assert got == [(2, 3, 3 + len(p))]


@pytest.mark.parametrize("name", ["op5_repeated_lines", "op7_url_rules"])
def test_sql_over_whole_tables(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    rel = db.sql(ORACLES[name])
    assert Counter(tuple(r[c] for c in rel.columns) for r in got.collect()) == Counter(rel.fetchall())


def test_letters_are_unicode_letters():
    alpha, lower = langid._letters()
    for i in random.Random(3).sample(range(0x110000), 2000):
        assert alpha[i] == unicodedata.category(chr(i)).startswith("L")
        assert lower[i] == i or chr(int(lower[i])) == chr(i).lower()


def test_a_language_of_copies_is_learned_from(spark):
    docs = spark.range(40_000).select(
        F.when(F.col("id") < 39_000, "copies").otherwise("texts").alias("lang"),
        F.concat(F.lit("text "), F.when(F.col("id") < 39_000, F.col("id") % 15).otherwise(F.col("id"))).alias("text"),
    )
    got = {r.lang: r["count"] for r in langid.training_sample(docs, "lang", "text", 10).groupBy("lang").count().collect()}
    assert got == {"copies": 10, "texts": 10}
