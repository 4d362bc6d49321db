"""ROUGE F-measures. Counting repeated n-grams and longest common subsequences
over whole texts has no built-in of linear cost, so the pair of texts goes
through one Arrow helper; word stems are memoised per task."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix rules of the published stemming algorithm (Porter 1980)
# with the commonly used extensions and irregular words.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """c/v per letter; y is a consonant first or after a vowel."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or (len(word) == 2 and shape == "vc")


def _first_rule(word: str, rules, ok) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            return base + new if ok(base, suffix) else word
    return word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("ies"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # -ed and -ing
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            base = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(base):
                word = _after_participle(base)
                break
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1]).endswith("c"):
        word = word[:-1] + "i"
    # derivations
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    word = _first_rule(
        word, STEP_2, lambda base, suffix: _measure(base + "l" if suffix == "logi" else base) > 0
    )
    word = _first_rule(word, STEP_3, lambda base, _: _measure(base) > 0)
    word = _first_rule(
        word, [(s, "") for s in STEP_4], lambda base, s: _measure(base) > 1 and (s != "ion" or base[-1:] in ("s", "t"))
    )
    # final e and ll
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def _after_participle(base: str) -> str:
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


_WORD = re.compile("[a-z0-9]+")


def words(text: str, stemmed: bool) -> list[str]:
    found = _WORD.findall(text.lower())
    return [stem(w) if len(w) > 3 else w for w in found] if stemmed else found


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence, one big-integer step per element of ``a``
    that ``b`` holds: a zero bit at j marks a match that lengthens the best
    sequence up to j."""
    return _lcs(a, _masks(b), len(b))


def _masks(b: list) -> dict:
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | (1 << j)
    return masks


def _lcs(a: list, masks: dict, n: int) -> int:
    full = (1 << n) - 1
    row = full
    for x in a:
        if x in masks:
            hit = row & masks[x]
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def _grams(t: list, n: int) -> Counter:
    return Counter(t) if n == 1 else Counter(zip(*[t[i:] for i in range(n)]))


@lru_cache(maxsize=256)
def _reference(text: str, kind: str, stemmed: bool) -> tuple:
    """What one reference is compared by, its length, and the beginnings that a
    word with one of its stems has."""
    b = words(text, stemmed)
    held = _masks(b) if kind == "l" else _grams(b, int(kind))
    return held, len(b), frozenset(x[:2] for x in b)


#: longest reference that is remembered; the completions of one prompt share it
MEMO_CHARS = 4096


def _may_meet(text: str, starts: frozenset) -> tuple[list[str], int]:
    """The stems of a text that may be among a reference's, in order, and the
    number of all. A stem keeps the first two letters of its word, or is the
    first one; the irregular words are looked up."""
    found = _WORD.findall(text.lower())
    near = [w for w in found if w[:2] in starts or w[0] in starts or w in IRREGULAR]
    return [stem(w) if len(w) > 3 else w for w in near], len(found)


def rouge_f(prediction: str, reference: str, kind: str, stemmed: bool) -> float:
    read = _reference if len(reference) <= MEMO_CHARS else _reference.__wrapped__
    held, n_b, starts = read(reference, kind, stemmed)
    if kind == "2" or not stemmed:
        a = words(prediction, stemmed)
        n_a = len(a)
    else:  # words that match nothing only count
        a, n_a = _may_meet(prediction, starts)
    if kind == "l":
        shared = _lcs(a, held, n_b)
    else:
        n = int(kind)
        shared = (_grams(a, n) & held).total()
        n_a, n_b = max(0, n_a - n + 1), max(0, n_b - n + 1)
    if not shared:
        return 0.0
    p, r = shared / n_a, shared / n_b
    return 2 * p * r / (p + r)


def rouge(prediction: Column, reference: Column, kind: str = "l", stemmed: bool = True) -> Column:
    """F-measure of 1-grams, 2-grams or the longest common subsequence."""
    if kind not in ("1", "2", "l"):
        raise ValueError("kind must be '1', '2' or 'l'")

    @F.arrow_udf("double")
    def run(p: pa.Array, r: pa.Array) -> pa.Array:
        pairs = zip(p.to_pylist(), r.to_pylist())
        out = [None if x is None or y is None else rouge_f(x, y, kind, stemmed) for x, y in pairs]
        return pa.array(out, pa.float64())

    return run(prediction, reference)
