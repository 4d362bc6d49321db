"""Vector codes, fill-in-the-middle and piece ids against plain versions and the library."""

import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tunetables.llm import ballcodes, fim, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = ["a", "B", "é", " ", "  ", "\n", "\n\n", "\t", "\r", "　", "1", "'s", "<s>", "</s>", "<0x41>", "!", "…", "中文", "각", "😀", "ﬁ", "é",
         "the", "hello", "ing", "▁", "x" * 60, "\x00", "​", " " * 17, "==", "<P>", "<", "S>"]


def strange(n, seed=1, most=40, signs=SIGNS):
    rng = random.Random(seed)
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, most))) for _ in range(n)]


# --- vector codes -------------------------------------------------------------------


def plain_codes(rows, plan):
    """(id, codes, error), and all entries, by looking at every entry."""
    kept = [(i, [int(np.floor(np.float64(x) * plan.scale)) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[: plan.entries]
    width = len(kept[0][1]) // plan.parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v in order] for p in range(plan.parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(plan.rounds):
        for p, book in enumerate(books):
            held = [[] for _ in book]
            for _, v in kept:
                held[nearest(part(v, p), book)[1]].append(part(v, p))
            books[p] = [[sum(c) // len(own) for c in zip(*own)] if own else e for own, e in zip(held, book)]
    out = []
    for i, v in kept:
        found = [nearest(part(v, p), books[p]) for p in range(plan.parts)]
        out.append((i, bytes(n for _, n in found), sum(d for d, _ in found)))
    return out, np.array(books)


VECTORS = "vec_id long, embedding array<float>, label int, code string, error double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 0.5) for i, v, lab in rows], VECTORS)


@pytest.mark.parametrize("plan", [ballcodes.Plan(parts=2, entries=7, rounds=3, scale=16), ballcodes.Plan(parts=4, entries=256, rounds=2), ballcodes.Plan(parts=1, entries=1, rounds=0)])
def test_codes_equal_a_plain_version(spark, plan):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 3, (5, 8))
    rows = [(int(i), [float(x) for x in centres[i % 5] + rng.normal(0, 0.2, 8)], int(i % 3) if i % 7 else None) for i in range(60)]
    rows += [(None, rows[0][1], 1), (5, rows[3][1], 1), (5, rows[3][1], 1), (7, rows[9][1], None)]  # null and repeated ids
    nan = float("nan")
    dirty = [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [nan] * 8, 1), (903, [float("inf")] * 8, 1), (904, [], 1), (-1, [1.0] * 6, 1)]
    codes, book = ballcodes.compress(vectors(spark, rows + dirty[:5]).repartition(3), plan)
    want, entries = plain_codes([(i, np.float32(v)) for i, v, _ in rows], plan)
    got = sorted(((r.id, bytes(r.code), r.error) for r in codes.collect()), key=str)
    assert got == sorted(want, key=str)
    assert (book.entries == entries).all()
    assert ballcodes.digest(book.entries) == hashlib.sha256(",".join(str(x) for x in entries.ravel()).encode()).hexdigest()
    sums = {}
    for (_, _, error), (_, _, label) in zip(want, rows):
        sums[label] = sums.get(label, 0) + error
    assert {(r.label, r.label_error) for r in ballcodes.label_errors(codes).collect()} == set(sums.items())
    shown = {r.id: r.vector for r in ballcodes.decompress(codes, book, plan.scale).collect()}
    assert len(shown[0]) == 8


def test_vectors_of_another_length_go(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0], 1), (3, [1.0, 2.0, 3.5, 4.0], 1)]
    codes, _ = ballcodes.compress(vectors(spark, rows), ballcodes.Plan(parts=2, entries=2))
    assert sorted(r.id for r in codes.collect()) == [1, 3]


def test_empty_and_void_vector_tables(spark):
    codes, book = ballcodes.compress(vectors(spark, []))
    assert book is None and codes.count() == 0
    assert ballcodes.label_errors(ballcodes.compress(vectors(spark, [(1, None, None)]))[0]).count() == 0


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="no error that a long holds"):
        ballcodes.compress(vectors(spark, [(1, [1e30] * 4, 1), (2, [0.0] * 4, 1)]))


@pytest.mark.parametrize("size", [3, 1 << 24])
def test_rings_find_the_nearest_entry(size):
    """Small numbers tie often; large ones pass the exact range of doubles."""
    rng = np.random.default_rng(size)
    entries = rng.integers(-size, size, (40, 4))
    entries[7] = entries[20]  # the lower of equal entries wins
    x = rng.integers(-size, size, (500, 4))
    own = rng.integers(0, 40, 500)
    d = ((x - entries[own]) ** 2).sum(1)
    reach = np.array([d[own == i].max(initial=0) for i in range(40)])
    got, error = ballcodes.reassign(x, own, entries, ballcodes.Neighbours.of(entries, reach))
    every = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    assert (got == every.argmin(1)).all() and (error == every.min(1)).all()


def test_cores_skip_work(monkeypatch):
    """In clear clusters no part is compared with anything but its entry."""
    entries = np.array([[0, 0], [1000, 0], [0, 1000]])
    x = np.repeat(entries, 50, axis=0) + np.random.default_rng(1).integers(-9, 9, (150, 2))
    own = np.repeat(np.arange(3), 50)
    d = ((x - entries[own]) ** 2).sum(1)
    near = ballcodes.Neighbours.of(entries, np.array([d[own == i].max() for i in range(3)]))
    monkeypatch.setattr(ballcodes, "distances", None)  # would fail if called
    assert (ballcodes.reassign(x, own, entries, near)[0] == own).all()


# --- fill-in-the-middle ----------------------------------------------------------------


def plain_fim(doc_id, text, plan):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if plan.unit == "line" else list(text)
    h = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in (plan.prefix, plan.suffix, plan.middle)) or h3 % 100 >= plan.rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < plan.spm:
        return doc_id, n, "spm", len(p), len(m), plan.suffix + s + plan.prefix + p + plan.middle + m
    return doc_id, n, "psm", len(p), len(m), plan.prefix + p + plan.suffix + s + plan.middle + m


@pytest.mark.parametrize("plan", [fim.Plan(), fim.Plan(unit="char", rate=70, spm=20, seed=3, prefix="[pre]", suffix="[suf]", middle="[mid]")])
def test_fill_in_middle_equals_a_plain_version(spark, plan):
    shared = "\n".join(strange(60, 5, signs=SIGNS[:-3]))  # a passage that many documents hold
    texts = [*strange(80, 2), *(f"{t}{shared}{t}" for t in strange(20, 3)), None, "", "\n", "\n\n", "no line end", "é" * 30_000, "ab\n" * 30_000]
    rows = [(i if i % 11 else None, t, 1, "x") for i, t in enumerate(texts)] + [(3, texts[5], 1, "x"), (3, texts[5], 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, output string").repartition(3)
    made = fim.fill_in_middle(df, plan)
    got = made.select("*", fim.restore("output", "form", plan).alias("restored")).collect()
    want = [plain_fim(i, t, plan) for i, t, *_ in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t, *_ in rows)
    assert fim.fill_in_middle(df.limit(0), plan).count() == 0


def test_shared_chunks_are_summarised_once():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefgh \n") for _ in range(60_000))
    memo, totals = fim.Memo("line"), []
    for n in range(10):
        own = "".join(rng.choice("abcdefgh \n") for _ in range(500 + n))
        raw = np.frombuffer(f"{own}{shared}".encode(), np.uint8)
        text = fim.Chunked(raw, 0, fim.chunk_ends(fim.border_candidates(raw).tolist(), 0, len(raw)), memo)
        totals.append(len(text.parts))
        assert text.n == len(re.findall(r"[^\n]*\n|[^\n]+", own + shared))
    assert memo.hits > 0.7 * sum(totals)
    assert all(fim.LEAST <= len(c) <= fim.MOST for c, _ in list(memo.held.values())[:20])


def test_digests_that_meet_are_told_apart(monkeypatch):
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda raw: 1)
    memo = fim.Memo("line")
    a, b = (np.frombuffer(x, np.uint8) for x in (b"a\nb", b"abc\n\n"))
    assert [len(memo.summary(x).marks) for x in (a, b, a, b)] == [1, 2, 1, 2]
    assert (memo.hits, memo.misses) == (1, 3)


def test_the_memo_is_bounded():
    memo = fim.Memo("line", limit=10_000)
    for i in range(200):
        memo.summary(np.frombuffer(bytes([i % 256, i // 256] * 200), np.uint8))
    assert memo.size <= 10_000 and len(memo.held) < 30


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "x")])
def test_marks_that_could_be_mistaken_are_refused(marks):
    with pytest.raises(ValueError):
        fim.Plan(prefix=marks[0], suffix=marks[1], middle=marks[2])


# --- piece ids -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def known():
    return pieces.Vocabulary(MODEL)


def test_ids_and_texts_equal_the_library(known):
    texts = strange(6000, 7) + ["中文字" * 500, "x" * 5000, "<unk>", " ", "a" * 49 + "\n" + "b" * 48]
    want = known.library.encode(texts, add_bos=True, add_eos=True)
    got = [np.frombuffer(e, "<u4").tolist() for e in known.encode(texts)]
    assert got == want
    assert [known.decode(i) for i in got] == [known.library.decode(i) for i in want]


def test_any_ids_decode_as_in_the_library(known):
    rng = random.Random(5)
    some = lambda: rng.choice([0, 1, 2, rng.randint(3, 258), 3 + 0xE4, 3 + 0xB8, 3 + 0xAD, 259, rng.randint(259, 31_999)])
    for ids in ([some() for _ in range(rng.randint(0, 8))] for _ in range(6000)):
        assert known.decode(ids) == known.library.decode(ids), ids


def test_short_and_long_segments_merge_alike(known):
    for s in strange(400, 9, 12, [s for s in SIGNS if "\n" not in s and " " not in s]):
        if s:
            assert known.short_ids([s]) == [known.long_ids(s)]


def test_no_merge_crosses_a_proved_border(known):
    for t in strange(300, 11):
        t = known.library.normalize(t)
        segments = known.segment.findall(t)
        assert "".join(segments) == t
        ends = np.cumsum([len(s) for s in segments])[:-1].tolist()
        assert all((t[e - 1], t[e]) not in known.side_by_side for e in ends)


def test_the_memo_starts_afresh(known, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 50)
    known.memo.clear()
    texts = strange(200, 13)
    want = known.library.encode(texts, add_bos=True, add_eos=True)
    got = [e for i in range(0, 200, 20) for e in known.encode(texts[i : i + 20])]
    assert [np.frombuffer(e, "<u4").tolist() for e in got] == want


def test_other_kinds_of_vocabularies_are_refused(monkeypatch):
    class Unigram:
        def __init__(self, model_file):
            pass

        def serialized_model_proto(self):
            return b"\x12\x02\x18\x01"  # a trainer's field: model type 1

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Unigram)
    with pytest.raises(ValueError, match="merge vocabulary"):
        pieces.Vocabulary("x")


def test_encode_texts(spark, known):
    rows = [(1, "Hello  world", 5, "a"), (None, None, 5, "b"), (2, "", 5, None), (2, "", 5, None), (3, "z" * 100_000, 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids string")
    got = pieces.encode_texts(df, MODEL).collect()
    want = {t or "": known.library.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in rows}
    assert len(got) == 5
    for r in got:
        ids = list(struct.unpack(f"<{r.n_tokens}I", bytes(r.ids)))
        assert ids == want[r.decoded]
    assert pieces.encode_texts(df.limit(0), MODEL).count() == 0
    assert sorted(r.n_tokens for r in pieces.encode_texts(df, MODEL, bos=False, eos=False).collect())[:3] == [0, 0, 0]


def test_a_difference_from_the_library_ends_the_job(spark, monkeypatch):
    known = pieces.Vocabulary(MODEL)
    known.memo["▁Hello"] = struct.pack("<I", 5)
    assert known.encode(["Hello"]) != known.encode(["hello"])
    assert np.frombuffer(known.encode(["Hello"])[0], "<u4").tolist() != known.library.encode("Hello", add_bos=True, add_eos=True)
