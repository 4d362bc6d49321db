"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set, in powers of two. An item's
sketch is its lowest shingle hashes. In a partition whose items have up to ``u``
shingles the sketch has ``(1 - t) u + 1`` of them and a few more, so many that a
document holding the share ``t`` of an item cannot miss all: of a sketch of ``m``
an item of ``q`` shingles must show ``m - (1 - t) q``. Documents too short for a
partition skip it. The length of a document plays no other part, unlike in a
comparison of two sketches, where a short item drowns in a long text.
Candidates are then verified on the item's whole shingle set.

Words are runs between white space; each character of a script written without
spaces is a word. An item of fewer words than a shingle has is one shingle of its
own length, which is looked up among the documents' shingles of that length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.llm.words import blocks, shingles, word_hashes
from tunetables.operators.staging import materialise

U = np.uint64
#: sketch hashes beyond those that must show, so that one common shingle makes no candidate
MORE = 3
#: shingles of the items that are searched in one pass over the documents
PASS = 1_000_000
#: scripts written without spaces between words
UNSPACED = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]"


@dataclass
class Partition:
    """Items of one size class: their sketches, sorted by hash, and their sets."""

    least: int  # shingles of a document that could hold the smallest item
    hashes: np.ndarray
    first: np.ndarray  # of each hash, in ``owners``
    owners: np.ndarray
    need: np.ndarray  # sketch hashes that an item must show
    ids: list
    sets: list[np.ndarray]
    maybe: np.ndarray  # of the hashes' high bits

    @classmethod
    def of(cls, ids: list, sets: list[np.ndarray], percent: int) -> Partition:
        upper = max(len(s) for s in sets)
        size = (100 - percent) * upper // 100 + 1 + MORE
        sketches = [s[:size] for s in sets]  # sets are sorted: the lowest hashes
        need = [len(k) - (100 - percent) * len(s) // 100 for k, s in zip(sketches, sets, strict=True)]
        flat = np.concatenate(sketches)
        owner = np.repeat(np.arange(len(sets)), [len(k) for k in sketches])
        order = np.argsort(flat, kind="stable")
        hashes, first = np.unique(flat[order], return_index=True)
        maybe = np.zeros(1 << 16, bool)
        maybe[(hashes >> U(48)).astype(np.int64)] = True
        least = -(-percent * min(len(s) for s in sets) // 100)
        return cls(least, hashes, np.append(first, len(flat)), owner[order], np.array(need), ids, sets, maybe)

    def search(self, docs: list[np.ndarray], percent: int) -> Iterator[tuple]:
        """(document's place, item, its shingles, those found) of every match."""
        long_enough = [i for i, s in enumerate(docs) if len(s) >= self.least]
        if not long_enough:
            return
        flat = np.concatenate([docs[i] for i in long_enough])
        doc = np.repeat(long_enough, [len(docs[i]) for i in long_enough])
        may = np.flatnonzero(self.maybe[(flat >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, flat[may]), len(self.hashes) - 1)
        hit = self.hashes[at] == flat[may]
        at, doc = at[hit], doc[may[hit]]
        many = self.first[at + 1] - self.first[at]
        owner = self.owners[np.repeat(self.first[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        pair, shown = np.unique(np.repeat(doc, many) * len(self.ids) + owner, return_counts=True)
        for p in pair[shown >= self.need[pair % len(self.ids)]].tolist():
            d, item = divmod(p, len(self.ids))
            own = self.sets[item]
            found = int(np.isin(own, docs[d], assume_unique=True).sum())
            if 100 * found >= percent * len(own):
                yield d, self.ids[item], len(own), found


def spaced(c: Column) -> Column:
    """The text with spaces around the characters that are words by themselves."""
    return F.regexp_replace(c, f"({UNSPACED})", " $1 ")


def item_classes(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, class_id, digest, unit, shingles): items with equal shingle sets share the
    class of their smallest id; ``unit`` is the length of their shingles in words.
    Items without an id or without words are left out."""
    text = spaced(F.col(text_col))
    rows = items.select(F.col(id_col).alias("item_id"), text.alias("text")).filter("item_id is not null").withColumn(
        "unit", F.least(F.lit(size), F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    )
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets = [s.view(np.int64) for s in shingles(*word_hashes(part.column("text")), size)]
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), part.column("unit"), pa.array(sets, pa.list_(pa.int64()))], ["item_id", "unit", "shingles"]
            )

    # an item's set may come twice, with equal rows; another text under the same id is a set of its own
    sets = rows.mapInArrow(run, f"item_id {kind}, unit int, shingles array<long>").filter(F.size("shingles") > 0).distinct()
    digest = F.md5(F.array_join(F.col("shingles").cast("array<string>"), ","))
    sets = materialise(sets.withColumn("digest", digest), "item-sets")
    first = sets.groupBy("digest").agg(F.min("item_id").alias("class_id"))
    return sets.join(first, "digest").select("item_id", "class_id", "digest", "unit", "shingles")


def contained_items(
    df: DataFrame, items: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", least_words: int = 1,
) -> DataFrame:
    """(id, item_id, n_item, n_found, containment) for every document and item of
    which the document holds ``percent`` hundredths of the distinct shingles.

    Items with equal sets are searched once, as a class, and each is reported. An
    item of fewer than ``size`` words is held by the texts in which its words stand
    in a row; ``least_words`` leaves such items out where they would hit clean
    texts. Ids may be of any type that can be ordered. Null and empty texts hold
    nothing and are held by nothing. Equal rows of documents are reported each,
    equal items once; another text under an item's id is an item too. A text is
    read whole, in memory of some times its size. Other columns are not read; empty
    tables give no rows. Items are searched in passes of about ``PASS`` shingles,
    each over all documents."""
    classes = materialise(
        item_classes(items, size, item_id_col, item_text_col).filter(F.col("unit") >= min(least_words, size)), "item-classes"
    )
    sets = materialise(classes.select("digest", "unit", "shingles").distinct(), "class-sets")
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    passes = max(1, -(-total // PASS))
    id_type = df.schema[id_col].dataType
    texts = df.select(F.col(id_col).alias("id"), spaced(F.col(text_col)).alias("text"))
    found = None
    for nth in range(passes):
        rows = sets.filter(F.pmod(F.xxhash64("digest"), F.lit(passes)) == nth).orderBy("digest").collect()  # PASS shingles
        alike: dict[tuple[int, int], tuple[list, list[np.ndarray]]] = {}
        for r in rows:
            ids, own = alike.setdefault((r["unit"], len(r["shingles"]).bit_length()), ([], []))
            ids.append(r["digest"])
            own.append(np.sort(np.array(r["shingles"], np.int64).view(U)))
        parts: dict[int, list[Partition]] = {}
        for (unit, _), x in alike.items():
            parts.setdefault(unit, []).append(Partition.of(*x, percent))
        held = df.sparkSession.sparkContext.broadcast(parts)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for part in blocks(batches):
                words, rows = word_hashes(part.column("text")), []
                for unit, searched in held.value.items():
                    docs = shingles(*words, unit)
                    rows += [m for p in searched for m in p.search(docs, percent)]
                at, item, n, shown = zip(*rows) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(at, pa.int64())), pa.array(item, pa.string()), pa.array(n, pa.int64()), pa.array(shown, pa.int64())],
                    ["id", "digest", "n_item", "n_found"],
                )

        one = texts.mapInArrow(run, f"id {id_type.simpleString()}, digest string, n_item long, n_found long")
        found = one if found is None else found.unionByName(one)
    members = materialise(classes.select("digest", F.col("item_id").alias("_item")).distinct(), "class-members")
    return found.join(members, "digest").select(
        F.col("id").alias(id_col), F.col("_item").alias("item_id"), "n_item", "n_found", (F.col("n_found") / F.col("n_item")).alias("containment")
    )
