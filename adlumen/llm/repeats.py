"""Repeated passages, found level by level: only what repeats at one length is looked at doubled.

A passage is a window of some words that also stands in another document. The lengths go
down from the window's by halves (50, 25, 13, 7) and are worked upwards: windows of the
shortest length that stand in several documents leave places where the next length, at most
twice as long, may repeat; all others are out. It ends at the window's own length or when no
place is left. A window is told by the two windows of half its length that cover it.

Below the last level not every short window is handed on: of those inside one full window the
one of the smallest hash stands for it. Equal full windows choose equal short ones, so this
loses none, and a level hands on a few percent of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm.common import fresh, once, small_batches, stored

WINDOW = 50
#: The first level has windows of this many words at most.
SHORTEST = 7
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0x9E3779B97F4A7C15
#: Bytes of a text hashed with stored powers; more are made for a longer text.
_POWERS = 1 << 17


def levels(window: int = WINDOW, shortest: int = SHORTEST) -> list[int]:
    """Lengths from the shortest to the window; each is at most twice the one before."""
    out = [window]
    while out[0] > shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = (h ^ h >> np.uint64(30) ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    word = np.concatenate([[False], ~_SPACE[np.frombuffer(text, dtype=np.uint8)], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, by differences of one running polynomial of the bytes."""
    start, end = word_places(text)
    up, down = once("repeat-powers", lambda: [_powers(b, _POWERS) for b in (_BASE, pow(_BASE, -1, 1 << 64))])
    if len(text) > len(up):
        up, down = (_powers(b, len(text)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    run = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * up[:len(text)], out=run[1:])
    # the length tells apart what the sum alone might not
    return _mixed((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64), 1) if len(start) else run[:0]


def longer(h: np.ndarray, size: int, to: int, seed: int = 0) -> np.ndarray:
    """Hashes of all windows of ``to`` words from those of ``size``, doubled as often as needed."""
    while size < to:
        step = min(size, to - size)
        a, b = h[:max(0, len(h) - step)], h[step:]
        h = _mixed(a * np.uint64(_BASE) + (b << np.uint64(31) | b >> np.uint64(33)), seed)
        size += step
    return h


def least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours."""
    size = 1
    while size < n:
        step = min(size, n - size)
        h = np.minimum(h[:len(h) - step], h[step:])
        size += step
    return h


def chosen(text: bytes, sizes: list[int]) -> list[np.ndarray]:
    """For each length below the last, the short window that stands for each full window."""
    window, out, h, size = sizes[-1], [], word_hashes(text), 1
    if len(h) < window:
        return [np.zeros(0, dtype=np.uint64) for _ in sizes[:-1]]
    for to in sizes[:-1]:
        h, size = longer(h, size, to), to
        out.append(least(h, window - to + 1))
    return out


def _run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)
    return values[first], np.diff(np.concatenate([first, [len(values)]]))


def covered(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Half-open spans of words inside windows at the given places."""
    at = np.unique(starts)
    if not len(at):
        return []
    new = np.concatenate([[True], at[1:] > at[:-1] + window])
    return list(zip(at[new].tolist(), (at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])] + window).tolist(), strict=True))


# ---- tables -----------------------------------------------------------------------------


def _node(text_col: str = "text"):
    """Texts that are equal are one node."""
    return F.unhex(F.md5(F.col(text_col)))


def _first(*keys: str):
    """By key: the smallest id, where several documents have the key. Null ids are greater than all."""

    def of(places: DataFrame) -> DataFrame:
        least = places.groupBy(*keys).agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.expr("id IS NULL")).alias("nameless"))
        return least.where("first < last OR (nameless AND first IS NOT NULL)").select(*keys, "first")

    return of


def _windows(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """node, id and by level the chosen hashes with run lengths, of (id, node, text) long enough."""
    window = sizes[-1]
    names = [f"{c}{i}" for i in range(len(sizes) - 1) for c in ("h", "n")]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int32())] * (len(sizes) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], [[] for _ in names]
            for i, text in enumerate(batch.column(2).to_pylist()):
                raw = (text or "").encode()
                if len(raw) < 2 * window - 1:
                    continue
                found = chosen(raw, sizes)
                if len(found[0] if found else word_places(raw)[0][window - 1:]):
                    rows.append(i)
                    for k, (h, n) in enumerate(map(_run_lengths, found)):
                        columns[2 * k].append(h.view(np.int64))
                        columns[2 * k + 1].append(n.astype(np.int32))
            if rows:
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, columns, kinds)],
                    names=["id", "node", *names])

    fields = [T.StructField(c, T.ArrayType(T.LongType() if c[0] == "h" else T.IntegerType())) for c in names]
    return docs.mapInArrow(run, T.StructType([docs.schema["id"], docs.schema["node"], *fields]))


def _alive(hashes, lengths, repeated: set | None, before: np.ndarray | None) -> np.ndarray:
    """Which full windows are still in: those whose short window repeats, if they were in before."""
    good = np.fromiter((h in repeated for h in hashes), dtype=bool, count=len(hashes)) if repeated is not None else np.ones(len(hashes), bool)
    out = np.repeat(good, lengths)
    return out if before is None else out & before


def _marks(alive: np.ndarray) -> np.ndarray:
    """True stretches as first and end, flat."""
    edge = np.concatenate([[False], alive, [False]])
    return np.flatnonzero(edge[1:] != edge[:-1]).astype(np.int32)


def _flags(marks: list[int], n: int) -> np.ndarray:
    turn = np.zeros(n + 1, dtype=np.int8)
    turn[marks] = 1
    return (np.cumsum(turn)[:n] & 1).astype(bool)


def _repeated(state: DataFrame, level: int) -> DataFrame:
    """uid and the hashes of its places at this level that several documents have.

    A hash in very many documents is summed up in tasks first; the join back to the places
    is left to Spark, which splits it where one hash has very many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, rows, out = batch.column(0), [], []
            for i, (hashes, lengths, marks) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                h = np.array(hashes, dtype=np.int64)
                if marks is not None:
                    ends = np.cumsum(lengths)
                    inside = np.concatenate([[0], np.cumsum(_flags(marks, int(ends[-1])))])
                    h = h[inside[ends] > inside[ends - lengths]]
                h = np.unique(h)
                rows.append(np.full(len(h), i))
                out.append(h)
            at = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([uid.take(at), batch.column(1).take(at), pa.array(np.concatenate(out) if out else [], pa.int64())],
                                             names=["uid", "id", "h"])

    given = state.select("uid", "id", f"h{level}", f"n{level}", "marks")
    places = stored(given.mapInArrow(run, T.StructType([given.schema["uid"], given.schema["id"], T.StructField("h", T.LongType())])), "repeat-places")
    # as a table, so that nothing stands between the join and the exchange it may split
    return places.join(stored(places.transform(_first("h")), "repeat-hashes"), "h").groupBy("uid").agg(F.collect_list("h").alias("repeated"))


def _next(state: DataFrame, level: int) -> DataFrame:
    """The state with the places that are left after this level; documents without any are out."""
    schema = state.schema
    joined = state.join(_repeated(state, level), "uid").select(*state.columns, "repeated")
    h, n, m = (state.columns.index(c) for c in (f"h{level}", f"n{level}", "marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for hashes, lengths, old, repeated in zip(*(batch.column(c).to_pylist() for c in (h, n, m, batch.num_columns - 1)), strict=True):
                before = None if old is None else _flags(old, sum(lengths))
                marks.append(_marks(_alive(hashes, lengths, set(repeated), before)))
            columns = [*batch.columns[:-1]]
            columns[m] = pa.array(marks, pa.list_(pa.int32()))
            left = pa.array([len(x) > 0 for x in marks], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames()).filter(left)

    return stored(joined.mapInArrow(run, schema), "repeat-level")


def _last(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """uid, id, place and 128 bits of every full window still in, of (uid, id, text, marks)."""
    window = sizes[-1]
    fields = [texts.schema["uid"], texts.schema["id"], T.StructField("at", T.IntegerType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, marks) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                h = word_hashes(text.encode())
                keep = np.flatnonzero(_flags(marks, len(h) - window + 1)) if marks is not None else np.arange(len(h) - window + 1)
                one, two = (longer(h, 1, window, seed)[keep].view(np.int64) for seed in (0, 0x2545F491))
                at = pa.array(np.full(len(keep), i))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(keep.astype(np.int32)), pa.array(one), pa.array(two)],
                                                 names=["uid", "id", "at", "a", "b"])

    return texts.select("uid", "id", "text", "marks").mapInArrow(run, T.StructType(fields))


def _spans(starts: DataFrame, window: int) -> DataFrame:
    """uid and the spans of words to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"first": a, "end": b} for a, b in covered(np.array(at), window)] for at in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _PA_SPANS)], names=["uid", "spans"])

    return starts.groupBy("uid").agg(F.collect_list("at").alias("at")).mapInArrow(run, f"uid long, spans {_SPANS}")


_SPANS = "array<struct<first:int,end:int>>"
_PA_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def passages(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, first_id and spans: for each distinct text what to remove of its first document.

    ``first_id`` is the smallest id that has the text; documents with the text and a greater
    id lose every word if they have a window at all. Only texts with a window are listed.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sizes = levels(window, shortest)
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).alias("id"), _node(text_col).alias("node"), text.alias("text"))
    made = _windows(given, sizes)
    # equal texts once, under their smallest id
    own = [F.any_value(c).alias(c) for c in made.columns if c not in ("id", "node")]
    whole = made.groupBy("node").agg(F.min("id").alias("id"), *own)
    nodes = stored(whole.withColumns({"uid": F.monotonically_increasing_id(), "marks": F.lit(None).cast("array<int>")}), "repeat-windows")
    state = nodes
    for level in range(len(sizes) - 1):
        state = _next(state, level)
        if not state.limit(1).count():
            break
    # one text for each node, from the rows that have it under its smallest id
    left = state.select("uid", "node", "id", "marks")
    texts = given.alias("d").join(left.alias("l"), F.expr("d.node = l.node AND d.id <=> l.id")).select("l.uid", "l.id", "d.text", "l.marks")
    texts = texts.groupBy("uid").agg(*[F.any_value(c).alias(c) for c in ("id", "text", "marks")])
    full = stored(_last(texts, sizes), "repeat-full")
    later = F.expr("coalesce(id > first, first IS NOT NULL)")
    first = stored(full.transform(_first("a", "b")), "repeat-first")
    starts = full.join(first, ["a", "b"]).where(later).select("uid", "at")
    spans = _spans(starts, window)
    return nodes.select("uid", "node", F.col("id").alias("first_id")).join(spans, "uid", "left").select("node", "first_id", "spans")


_RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])


def without(text: str | None, spans: list[tuple[int, int]], whole: bool = False) -> tuple[int, int, str]:
    """Words, removed words, and the kept words joined by single spaces."""
    words = (text or "").encode().split()
    gone = [(0, len(words))] if whole else spans
    kept, at = [], 0
    for first, end in gone:
        kept += words[at:first]
        at = end
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def deduplicated(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the struct column ``repeats``: n_words, n_removed and the kept words as text.

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller id; all windows are judged on the given texts. Null, empty and short texts have
    no window and keep all their words. Null ids are greater than all others and equal to
    each other; rows that share an id are not smaller than each other, so repeated rows
    lose nothing to one another. No rows: no rows. Other columns pass through; a column
    of that name gives way to another name.
    """
    found = passages(docs, window, shortest, id_col, text_col)
    taken = docs.columns
    node, first, spans = fresh("node", taken), fresh("first_id", taken), fresh("spans", taken)
    into = fresh("repeats", taken)
    known = found.toDF(node + "_", first, spans)
    later = F.coalesce(F.col(id_col) > F.col(first), F.col(first).isNotNull() & F.col(id_col).isNull())
    keyed = docs.withColumn(node, _node(text_col)).join(known, F.col(node) == F.col(node + "_"), "left")
    given = keyed.select(*[F.col(f"`{c}`") for c in taken], F.col(spans), later.alias(first))
    text_at, n = taken.index(text_col), len(taken)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [dict(zip(_RESULT.fieldNames(), without(text, [(s["first"], s["end"]) for s in own or []], bool(whole)), strict=True))
                    for text, own, whole in zip(*(batch.column(c).to_pylist() for c in (text_at, n, n + 1)), strict=True)]
            made = pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], made], names=[*taken, into])

    return given.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, _RESULT)]))
