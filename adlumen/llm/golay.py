"""SimHash near-duplicates through Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from adlumen.llm.common import fresh, numbered, once, small_batches, stored
from adlumen.llm.components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Fixed values of the binary Golay code: length, data bits, generator polynomial.
LENGTH, DATA, GENERATOR = 23, 12, 0b101011100011
#: A fingerprint's three segments (first bit, bits), each read as a word of the code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints with one key that are compared within one group; more are split.
GROUP = 4_096


# ---- fingerprints ---------------------------------------------------------------


def shingle_texts(text: str | None, shingle: int = SHINGLE) -> Iterator[bytes]:
    """The shingles of a text in their places, words joined by a space; see shingle_hashes()."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    last = ends[min(shingle, len(words)) - 1:].tolist()
    first = [0, *(ends[:n - 1] + 1).tolist()]
    for a, b in zip(first, last, strict=True):
        yield joined[a:b]


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of each shingle in its place; a text of fewer words is one shingle, no words none."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingle_texts(text, shingle)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: a bit is set if more than half of the shingle hashes have it. No words: 0."""
    return _majority(shingle_hashes(text, shingle))


def _majority(hashes: np.ndarray, block: int = 1 << 14) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), block):
        part = hashes[at:at + block].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 check_col: str | None = None) -> DataFrame:
    """doc_id, fingerprint (signed long) and ``check_col`` of every row, or else a hash of its text."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    check = F.col(check_col) if check_col else F.xxhash64(text)
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), check.alias("check"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64)), batch.column(2)],
                                             names=["doc_id", "mark", "check"])

    return given.mapInArrow(run, T.StructType([given.schema["doc_id"], T.StructField("mark", T.LongType()),
                                               T.StructField("check", T.LongType())]))


# ---- keys -----------------------------------------------------------------------


def remainder(word: int) -> int:
    for bit in reversed(range(LENGTH - DATA, LENGTH)):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


def nearby() -> np.ndarray:
    """For each remainder the error patterns of weight up to 4 that leave it, six at most.

    Every word is within distance 3 of exactly one codeword. One at distance 3 is at
    distance 4 of five more. Two words that differ in up to two bits always share such a
    codeword: the one nearest to the word between them. Rows are padded with their first
    pattern.
    """
    single = [remainder(1 << bit) for bit in range(LENGTH)]
    found: list[list[int]] = [[] for _ in range(1 << (LENGTH - DATA))]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            rest = pattern = 0
            for bit in bits:
                rest ^= single[bit]
                pattern |= 1 << bit
            if weight < 4 or found[rest][0].bit_count() == 3:
                found[rest].append(pattern)
    width = max(map(len, found))
    return np.array([(f + [f[0]] * width)[:width] for f in found], dtype=np.int64)


def remainders() -> np.ndarray:
    """Remainder of the upper and of the lower bits of a word, by their value."""
    high = np.array([remainder(v << (LENGTH - DATA)) for v in range(1 << DATA)], dtype=np.int64)
    return high


def codewords(segment: np.ndarray) -> np.ndarray:
    """Data bits of the codewords near each segment: one row each, padded by repetition."""
    patterns = once("golay-near", nearby)
    high = once("golay-high", remainders)
    low_bits = LENGTH - DATA
    rest = high[segment >> low_bits] ^ (segment & ((1 << low_bits) - 1))
    return (segment[:, None] ^ patterns[rest]) >> low_bits


def keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs, no pair twice.

    Four differing bits leave two of the three segments with at most two each, so that a
    pair within the distance shares a codeword in both: each pair of segments gives a key
    for each pair of codewords.
    """
    near = [codewords((marks >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
    rows, out = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = (near[i][:, :, None] << DATA | near[j][:, None, :]).reshape(len(marks), -1)
        both.sort(axis=1)
        new = np.ones(both.shape, dtype=bool)
        new[:, 1:] = both[:, 1:] != both[:, :-1]
        rows.append(np.nonzero(new)[0])
        out.append(both[new] | pair << 2 * DATA)
    return np.concatenate(rows), np.concatenate(out)


# ---- links ----------------------------------------------------------------------


def chains(key: np.ndarray, mark: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each key, the fingerprints a chain of close pairs connects.

    ``key`` is sorted. Short groups are compared by shifting the arrays against each
    other; a longer one is walked from neighbour to neighbour, so that it gives fewer
    links than it has members.
    """
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    a, b = [], []
    small = np.repeat(sizes <= 32, sizes)
    k, m = key[small], mark[small]
    at, shift = np.arange(len(k)), 1
    while len(at := at[at + shift < len(k)]) and len(at := at[k[at] == k[at + shift]]):
        close = at[np.bitwise_count(m[at] ^ m[at + shift]) <= distance]
        a.append(m[close])
        b.append(m[close + shift])
        shift += 1
    for start, size in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
        group = np.unique(mark[start:start + size])
        left = np.ones(len(group), dtype=bool)
        for first in range(len(group)):
            if not left[first]:
                continue
            left[first], queue = False, [first]
            while queue:
                here = queue.pop()
                rest = np.flatnonzero(left)
                close = rest[np.bitwise_count(group[rest] ^ group[here]) <= distance]
                left[close] = False
                queue += close.tolist()
                a.append(np.full(len(close), group[here]))
                b.append(group[close])
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("mark", T.LongType())])


def links(marks: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints, enough to connect what is connected."""
    if distance > DISTANCE:
        raise ValueError("the keys hold for four differing bits or fewer")
    small_batches(marks.sparkSession)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                rows, key = keys(own)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[rows].view(np.int64))], names=["key", "mark"])

    given = stored(marks.select("mark").mapInArrow(keyed, _KEYED), "golay-keys")
    # keys that very many fingerprints share: blocks of those meet two by two
    often = (given.groupBy("key").count().where(F.col("count") > group)
             .select("key", F.ceil(F.col("count") / group).cast("long").alias("blocks")))
    block = F.pmod(F.xxhash64("mark"), F.col("blocks"))
    split = (given.join(often, "key").withColumn("own", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "mark"))
    whole = given.join(often, "key", "left_anti")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, mark in _groups(batches):
            a, b = chains(key, mark, distance)
            for at in range(0, len(a), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 18)].view(np.int64)) for x in (a, b)],
                                                 names=["a", "b"])

    met = whole.union(split).repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(linked, _LINK)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted batches joined so that no key is cut."""
    keys_, marks = [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        mark = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        cut = int(np.searchsorted(key, key[-1]))
        if cut:  # the last key may go on in the next batch
            yield np.concatenate([*keys_, key[:cut]]), np.concatenate([*marks, mark[:cut]])
            keys_, marks = [], []
        elif keys_ and keys_[-1][-1] != key[-1]:
            yield np.concatenate(keys_), np.concatenate(marks)
            keys_, marks = [], []
        keys_.append(key[cut:])
        marks.append(mark[cut:])
    if keys_:
        yield np.concatenate(keys_), np.concatenate(marks)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text", check_col: str | None = None) -> DataFrame:
    """doc_id, mark (fingerprint), check (text hash or ``check_col``) and component_id: the smallest doc_id reachable.

    Fingerprints within ``distance`` differing bits are linked; equal ones are one node.
    Null, empty and wordless texts have fingerprint zero and are linked like any other.
    Repeated rows stay, with the same component. A null doc_id takes part but names a
    component only if it has no other id. No rows: no output. Other columns are ignored.
    """
    marked = stored(fingerprints(docs, shingle, id_col, text_col, check_col), "fingerprints")
    nodes = marked.groupBy("mark").agg(F.min("doc_id").alias("least_id"))
    joined = components(links(nodes, distance))
    nodes = nodes.join(joined.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "root", F.coalesce("root", "mark"))
    named = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stored(nodes.join(named, "root").select("mark", "component_id", "root"), "fingerprint-classes")
    return marked.join(named, "mark").select("doc_id", "mark", "check", "component_id", "root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last.

    Of rows with that id the one with the smallest number of its text stays, of equal rows any one.
    """
    check = fresh("text_number", docs.columns)
    docs = numbered(docs, check, text_col)
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, check_col=check, **options)
    return first_of_each(docs, found, id_col, check).drop(check)


def first_of_each(docs: DataFrame, found: DataFrame, id_col: str, check_col: str) -> DataFrame:
    """one_of_each() for the components (doc_id, check, root) of ``found``; ``check_col`` tells texts apart."""

    def row(id_: str, check: str) -> Column:
        return F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(check).alias("check"))

    name = fresh("row_key", docs.columns)
    best = found.groupBy("root").agg(F.min(row("doc_id", "check")).alias(name)).select(name)
    return docs.withColumn(name, row(id_col, check_col)).join(best, name, "left_semi").dropDuplicates([name]).drop(name)
