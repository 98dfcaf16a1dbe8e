"""Benchmark decontamination: an FM-index per training shard, searched for benchmark phrases."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm.common import fresh, small_batches, stored
from adlumen.llm.fmindex import FMIndex

WINDOW = 10
#: Bytes of benchmark text searched in one pass; more text takes more passes.
BLOCK_BYTES = 4 << 20
#: Words that one shard's index covers at most, and bytes of text (a longer text is alone).
SHARD_WORDS, SHARD_BYTES = 4_000_000, 32 << 20
WORD = rb"[0-9a-z\x80-\xff]+"
_SPAN = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return re.findall(WORD, (text or "").encode().lower())


class Phrases:
    """Windows of benchmark items as symbols: one row for each distinct window, by length."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                owners.setdefault(tuple(ids[at:at + size]), set()).add(item)
        sizes = sorted({len(p) for p in owners})
        self.by_size = [np.array([p for p in owners if len(p) == s], dtype=np.int64) for s in sizes]
        self.items = [[sorted(owners[tuple(p)]) for p in rows.tolist()] for rows in self.by_size]
        self.shortest = sizes[0] if sizes else 0

    @classmethod
    def of(cls, values: dict) -> Phrases:
        made = cls.__new__(cls)
        vars(made).update(values)
        return made

    def hits(self, texts: list[list[bytes]]) -> list[tuple[int, int, int, list[str]]]:
        """(document, first word, words, items) of every occurrence in a shard.

        Words that no phrase has become a separator, and so do runs too short for any
        phrase; the index is built over what is left.
        """
        if not self.by_size:
            return []
        get = self.symbols.get
        sizes = np.array([len(t) + 1 for t in texts])
        ids = np.fromiter((get(w, 0) for t in texts for w in (*t, b"")), dtype=np.int64, count=int(sizes.sum()))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
        runs = edges.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= self.shortest]
        if not len(runs):
            return []
        lengths = runs[:, 1] - runs[:, 0] + 1  # with the separator behind
        starts = np.cumsum(lengths) - lengths
        from_ = np.repeat(runs[:, 0] - starts, lengths) + np.arange(lengths.sum())
        index = FMIndex(ids[from_])
        firsts = np.cumsum(sizes) - sizes
        out = []
        for rows, items in zip(self.by_size, self.items, strict=True):
            low, high = index.find(rows)
            counts = np.maximum(high - low, 0)
            which = np.repeat(np.arange(len(rows)), counts)
            suffix = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            at = from_[index.locate(suffix)]
            doc = np.searchsorted(firsts, at, side="right") - 1
            out += [(d, w, rows.shape[1], items[i]) for d, w, i in
                    zip(doc.tolist(), (at - firsts[doc]).tolist(), which.tolist(), strict=True)]
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, sorted, with overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def char_spans(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans from the first to the last word of each span of words."""
    places = [m.span() for m in _SPAN.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in words]


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text with each span replaced by nothing."""
    if not text or not spans:
        return text
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])


_ITEMS = "array<string>"
_SPANS = "array<struct<first:int,end:int>>"
RESULT = f"struct<n_words:bigint,n_hit:bigint,items:{_ITEMS},words:{_SPANS},spans:{_SPANS},clean:string>"
_PA_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_PA_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                        ("words", _PA_SPANS), ("spans", _PA_SPANS), ("clean", pa.string())])


def scan(docs: DataFrame, benchmark: DataFrame, into: str, text_col: str = "text", item_col: str = "item_id",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES, clean: bool = True) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_hit, items, words, spans, clean.

    ``words`` are the merged spans of hit words, ``spans`` the same in code points and
    ``clean`` the text without them (null unless asked for). A task indexes its rows in
    shards of bounded size and searches all phrases in each. The benchmark is searched in
    blocks of bounded size, a pass over the documents for each, so that no broadcast
    grows with it.

    Null or empty text: no words and no hits. Null items' texts and items without words
    have no window; items with the same window are all reported; repeated rows count as
    one item. No benchmark rows: no hits. No documents: no rows. Other columns pass
    through unchanged.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    held = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_blocks = max(1, math.ceil(held / block_bytes))
    out = docs
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        # as plain values: workers rebuild the object around them
        phrases = spark.sparkContext.broadcast(vars(Phrases([(r.item, r.text) for r in part.collect()], window)))
        out = _pass(out, phrases, into, text_col, block > 0, clean and block == n_blocks - 1)
        if block < n_blocks - 1:  # one pass at a time, so that workers hold one block
            out = stored(out, "benchmark-pass")
    return out


def _pass(docs: DataFrame, phrases, into: str, text_col: str, again: bool, clean: bool) -> DataFrame:
    fields = [f for f in docs.schema.fields if f.name != into]
    schema = T.StructType([*fields, T.StructField(into, T._parse_datatype_string(RESULT))])
    text_at = [f.name for f in fields].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        texts: list[list[bytes]] = []
        words = size = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            split = [words_of(t) for t in batch.column(text_at).to_pylist()]
            held.append(batch)
            texts += split
            words += sum(map(len, split))
            size += batch.nbytes
            if words >= SHARD_WORDS or size >= SHARD_BYTES:
                yield from shard(held, texts)
                held, texts, words, size = [], [], 0, 0
        if held:
            yield from shard(held, texts)

    def shard(held: list[pa.RecordBatch], texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for doc, at, n, owners in Phrases.of(phrases.value).hits(texts):
            spans.setdefault(doc, []).append((at, at + n))
            items.setdefault(doc, set()).update(owners)
        doc = 0
        for batch in held:
            rows = []
            before = batch.column(len(fields)).to_pylist() if again else [None] * batch.num_rows
            for text, old in zip(batch.column(text_at).to_pylist(), before, strict=True):
                found, owned = spans.get(doc, []), items.get(doc, set())
                if old:
                    found = found + [(s["first"], s["end"]) for s in old["words"]]
                    owned = owned | set(old["items"])
                found = merged(found)
                chars = char_spans(text, found) if found else []
                rows.append({
                    "n_words": len(texts[doc]), "n_hit": sum(b - a for a, b in found), "items": sorted(owned),
                    "words": [{"first": a, "end": b} for a, b in found],
                    "spans": [{"first": a, "end": b} for a, b in chars],
                    "clean": without(text, chars) if clean else None})
                doc += 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(fields)], pa.array(rows, _PA_RESULT)],
                                             names=schema.fieldNames())

    given = docs.select(*[F.col(f"`{f.name}`") for f in fields], *([into] if again else []))
    return given.mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the spans of every document."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scan(given, benchmark, "found", clean=False, **options)
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"), "found.spans")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit passages cut out of the text; n_chars, if given, follows the text."""
    into = fresh("found", docs.columns)
    found = scan(docs, benchmark, into, text_col, **options)
    hit = F.col(f"{into}.n_hit") > 0
    new = {text_col: F.when(hit, F.col(f"{into}.clean")).otherwise(F.col(text_col))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length(f"{into}.clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
