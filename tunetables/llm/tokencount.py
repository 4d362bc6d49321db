"""Token counts of whole texts under a byte-level BPE vocabulary.

Whole-token shortcut: offline, every vocabulary string is encoded once, and
those that come out as their own single token are proved whole. A pre-token that
is proved whole counts one; only the others go through the merges, each distinct
one once per worker as long as the bounded memo holds it.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

# White space of the Unicode property, and the pre-token pattern of the vocabulary.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PRE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Beyond these blocks letter tables of two libraries may differ in age; such texts go whole to the library.
_OTHER = regex.compile(r"[^\x00-ɏͰ-ԯ‐-⁞₠-₿]")

#: distinct pre-tokens that a worker remembers before it starts afresh
MEMO = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: character to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """The strings of the vocabulary that the library encodes as one token, their own.
    Tokens that are no UTF-8 text are left out: no pre-token equals them."""
    tokenizer, alphabet = Tokenizer.from_file(vocabulary), byte_alphabet()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings, ids = [], []
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if token in special or not all(c in alphabet for c in token):
            continue
        try:
            strings.append(bytes(alphabet[c] for c in token).decode())
            ids.append(i)
        except UnicodeDecodeError:
            continue
    out = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(s for s, i, e in zip(strings, ids, out, strict=True) if e.ids == [i])


class _Counter:
    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.memo: dict[str, int] = {}

    def count(self, texts: list[str], whole: frozenset[str]) -> list[int]:
        totals, rest = [], []
        for text in texts:
            if _OTHER.search(text):
                totals.append(len(self.tokenizer.encode(text, add_special_tokens=False).ids))
                rest.append(())
                continue
            parts = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
            pre = [x for part in parts for x in _PRE.findall(part)]
            merges = [x for x in pre if x not in whole]
            totals.append(len(parts) - 1 + len(pre) - len(merges))
            rest.append(merges)
        memo = self.memo
        new = list({x for merges in rest for x in merges if x not in memo})
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list({x for merges in rest for x in merges})
        for x, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            memo[x] = len(e.ids)
        return [n + sum(map(memo.__getitem__, merges)) for n, merges in zip(totals, rest, strict=True)]


@lru_cache(maxsize=4)
def _counter(vocabulary: str) -> _Counter:
    return _Counter(vocabulary)


def token_count(spark: SparkSession, text: Column | str, vocabulary: str) -> Column:
    """Tokens of a text column as the library gives them, without added special
    tokens; special strings in a text are its default single tokens. Null and
    empty text have none. The vocabulary file must lie at the same path on every
    executor; the proved strings are broadcast, at most one per vocabulary entry."""
    whole = spark.sparkContext.broadcast(whole_tokens(vocabulary))

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        counter, out = _counter(vocabulary), []
        values = texts.fillna("").tolist()
        for i in range(0, len(values), 500):
            out += counter.count(values[i : i + 500], whole.value)
        return pd.Series(out, dtype="int64")

    return count(text)


def token_counts(df: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row, repeated rows included;
    null text is empty. Other columns are not read. An empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), token_count(df.sparkSession, text, vocabulary).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
