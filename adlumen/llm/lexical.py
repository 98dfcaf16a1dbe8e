"""Ranked lexical search: an Aho-Corasick automaton of all item terms reads the documents.

No index of the documents is made. Every term stands in the automaton with a guard on both
sides, and texts are read with each foreign character turned into that guard, so that only
whole terms match. The first reading counts documents, terms and document frequencies; the
second finds the term frequencies again, adds them up for the items that have the term and
keeps the best documents of each item.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from adlumen.llm.common import once, small_batches

#: Bytes of item texts that one automaton holds; more items take more readings.
BLOCK_BYTES = 4 << 20
#: Scores worked on at a time, and terms met with items at a time.
CELLS, MEETINGS = 1 << 19, 1 << 20
#: Parts an item's candidates are ranked in before they meet.
PARTS = 32
#: Free parameters of the score in hundredths and thousandths: length share, saturation.
LENGTH, SATURATION, SCALE = 75, 8, 1_000_000_000

_TERM_BYTE = re.compile(rb"[0-9a-z\x80-\xff]")
#: Bytes of a text as read: A-Z lower-cased, what no term has as a guard.
_READ = bytes(b if _TERM_BYTE.match(bytes([b])) else 32 for b in bytes(range(256)).lower())


def readable(text: str | None) -> bytes:
    """The terms of a text between guards."""
    return b" " + (text or "").encode().translate(_READ) + b" "


def length(read: bytes) -> int:
    """Terms with their repeats."""
    guard = np.frombuffer(read, dtype=np.uint8) == 32
    return int(np.count_nonzero(guard[:-1] & ~guard[1:]))


class Items:
    """Terms of a block of items: which items have a term, and how often."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids, self.token = ids, uuid.uuid4().hex
        owners: dict[bytes, list[tuple[int, int]]] = {}
        for i, text in enumerate(texts):
            for term, times in Counter(readable(text).split()).items():
                owners.setdefault(term, []).append((i, times))
        self.terms = list(owners)
        self.count = np.array([len(o) for o in owners.values()], dtype=np.int64)
        self.start = np.cumsum(self.count) - self.count
        pairs = np.array([p for o in owners.values() for p in o], dtype=np.int64).reshape(-1, 2)
        self.item, self.times = pairs[:, 0].copy(), pairs[:, 1].copy()

    def automaton(self):
        """One for a worker and block; that of another block makes room for it."""
        held = once("lexical", dict)
        if self.token not in held:
            import ahocorasick

            made = ahocorasick.Automaton()
            for i, term in enumerate(self.terms):
                made.add_word(f" {term.decode('latin-1')} ", i)
            made.make_automaton()
            held.clear()
            held[self.token] = made
        return held[self.token]

    def found(self, read: bytes) -> Iterator[int]:
        """The term of every occurrence in a text."""
        if not self.terms:
            return iter(())
        return map(itemgetter(1), self.automaton().iter(read.decode("latin-1")))

    def scores(self, weight: np.ndarray, m: list[int], counts: list[Counter]) -> np.ndarray:
        """Documents by items."""
        sizes = np.fromiter(map(len, counts), dtype=np.int64, count=len(counts))
        total = int(sizes.sum())
        doc = np.repeat(np.arange(len(counts)), sizes)
        term = np.fromiter((t for c in counts for t in c), dtype=np.int64, count=total)
        tf = np.fromiter((n for c in counts for n in c.values()), dtype=np.int64, count=total)
        worth = weight[term] * ((SCALE * tf) // (1000 * tf + SATURATION * np.array(m, dtype=np.int64)[doc]))
        out = np.zeros(len(counts) * len(self.ids), dtype=np.int64)
        meetings = self.count[term]
        ends = np.cumsum(meetings)
        at = 0
        while at < total:
            # one term's items at least
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEETINGS, side="right")))
            n = meetings[at:to]
            place = np.repeat(self.start[term[at:to]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            np.add.at(out, np.repeat(doc[at:to] * len(self.ids), n) + self.item[place],
                      np.repeat(worth[at:to], n) * self.times[place])
            at = to
        return out.reshape(len(counts), len(self.ids))


def weights(n_docs: int, frequency: list[int]) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequency], dtype=np.int64)


class Best:
    """The ``k`` best (item, score, document) of each item so far; equal scores by document."""

    def __init__(self, k: int, n_items: int):
        self.k, self.least = k, np.ones(n_items, dtype=np.int64)
        self.held: pa.Table | None = None

    def add(self, scores: np.ndarray, docs: pa.Array) -> None:
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        doc, item = np.nonzero(scores >= least)
        if not len(doc):
            return
        new = pa.table({"item": item, "score": scores[doc, item], "doc": docs.take(pa.array(doc))})
        both = pa.concat_tables([self.held, new]) if self.held is not None else new
        order = pc.sort_indices(both, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc", "ascending")],
                                null_placement="at_end")
        both = both.take(order).combine_chunks()
        item = both.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.held = both.filter(pa.array(rank < self.k))
        last = rank == self.k - 1
        self.least[item[last]] = np.maximum(self.least[item[last]], both.column("score").to_numpy()[last])


def _texts(batches: Iterator[pa.RecordBatch], n_items: int = 1) -> Iterator[tuple[pa.Array, list]]:
    """Ids and texts, few enough that their scores stay bounded."""
    rows = max(1, CELLS // max(1, n_items))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(0), part.column(1).to_pylist()


def _statistics(docs: DataFrame, items) -> tuple[int, int, list[int]]:
    """Documents with a term, terms in all, and documents that have each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        of = np.zeros(len(block.terms), dtype=np.int64)
        n_docs = n_terms = 0
        for _, texts in _texts(batches):
            for read in map(readable, texts):
                n = length(read)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                of[list(set(block.found(read)))] += 1
        seen = np.flatnonzero(of)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], seen])),
                                          pa.array(np.concatenate([[n_docs, n_terms], of[seen]]).astype(np.int64))],
                                         names=["term", "n"])

    rows = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    got = dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True))
    return got.get(-1, 0), got.get(-2, 0), [got.get(i, 0) for i in range(len(items.value.terms))]


def _candidates(docs: DataFrame, items, n_docs: int, n_terms: int, weight: np.ndarray, k: int, item_type: T.DataType) -> DataFrame:
    """The best of each task."""
    id_type, arrow_item = to_arrow_type(docs.schema[0].dataType), to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        best = Best(k, len(block.ids))
        for ids, texts in _texts(batches, len(block.ids)):
            m, counts = [], []
            for read in map(readable, texts):
                m.append(100 - LENGTH + LENGTH * length(read) * n_docs // max(1, n_terms))
                counts.append(Counter(block.found(read)))
            best.add(block.scores(weight, m, counts), ids.cast(id_type))
        for part in best.held.to_batches() if best.held is not None else []:
            item = part.column("item").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array([block.ids[i] for i in item], arrow_item),
                                              part.column("doc"), part.column("score")],
                                             names=["item", "item_id", "doc_id", "score"])

    return docs.mapInArrow(run, T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", item_type),
        T.StructField("doc_id", docs.schema[0].dataType), T.StructField("score", T.LongType())]))


def search(docs: DataFrame, benchmark: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of every item.

    Only scores above 0 count; equal scores stand by ascending doc_id, null ids last.
    Null, empty and term-less texts are no documents and no queries. Repeated document
    rows are documents of their own with the same score. Items are distinct pairs of id
    and text: a repeated row is one item, rows that share an id only are ranked each.
    Either table empty: no rows. Other columns are ignored. Texts are read whole, in their
    row. Items are held in blocks of bounded size, two readings of the documents for each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    wanted = (benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
              .where("text IS NOT NULL").distinct())
    held = wanted.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_blocks = max(1, math.ceil(held / block_bytes))
    found = None
    for block in range(n_blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        items = spark.sparkContext.broadcast(Items([r.item_id for r in part], [r.text for r in part]))
        n_docs, n_terms, frequency = _statistics(given, items)
        best = _candidates(given, items, n_docs, n_terms, weights(n_docs, frequency), k, wanted.schema["item_id"].dataType)
        best = best.withColumn("block", F.lit(block))
        found = best if found is None else found.unionByName(best)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("block", "item", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank")
    return (first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
