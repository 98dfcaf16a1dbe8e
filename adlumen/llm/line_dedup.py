"""Line deduplication: an exact set-similarity join with prefix, positional and length filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm.common import fresh, once, small_batches, stored

#: Least Jaccard similarity of two lines' word sets, in hundredths.
SIMILARITY = 80
#: Words are counted in this many slots to order them by rarity (a fixed 8 MB at most).
SLOTS_BITS, CHUNKS = 20, 64
#: Lines that meet over one word at most; a more frequent word is split into blocks.
GROUP = 20_000
#: Earlier candidates tried first for each line and word; lines that none of them settles
#: and that have more are compared with all of them afterwards.
FIRST = 4
#: Slots of the filters that spare rows which cannot matter the way through a shuffle.
FILTER_SLOTS = 1 << 20
#: Stands for a null id: such rows come first.
NO_ID = -(1 << 63)

_ONE, _MASK = np.uint64(1), np.uint64(63)


def overlap_needed(n: np.ndarray, m: np.ndarray, similarity: int) -> np.ndarray:
    """Common words that sets of n and m words need."""
    return -(-(similarity * (n + m)) // (100 + similarity))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, dtype=np.int8)
_IS_SPACE[list(b" \t\n\v\f\r")] = 1
#: Multiplier of the word hashes, and texts hashed together (bytes; a longer one is alone).
_BASE, _BLOCK = 0x9E3779B97F4A7C15, 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word in order: its text, its line's number and a 64-bit hash.

    Words are found in blocks of bytes, and hashed by differences of one running
    polynomial: cost by byte, not by word.
    """
    out, held, first, size = [], [], 0, 0
    for i, text in enumerate(texts):
        held.append((text or "").encode())
        size += len(held[-1]) + 1
        if size >= _BLOCK or i == len(texts) - 1:
            out.append(_block(held, first))
            held, first, size = [], i + 1, 0
    none = np.zeros(0, dtype=np.int64)
    doc, number, h = ([none, *c] for c in (zip(*out, strict=True) if out else ((), (), ())))
    return np.concatenate(doc), np.concatenate(number), np.concatenate([x.astype(np.uint64) for x in h])


def _block(held: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = _LOWER[np.frombuffer(b"\n".join([*held, b""]), dtype=np.uint8)]
    up, down = once("line-powers", lambda: [
        _powers(_BASE, 2 * _BLOCK), _powers(pow(_BASE, -1, 1 << 64), 2 * _BLOCK)])
    if len(data) > len(up):
        up, down = _powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data))
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=run[1:])
    h = _mixed((run[end] - run[start]) * down[start])
    breaks = np.flatnonzero(data == 10)
    sizes = np.array([len(x) + 1 for x in held])
    begin = np.cumsum(sizes) - sizes
    doc = np.searchsorted(begin, start, side="right") - 1
    number = np.searchsorted(breaks, start) - np.searchsorted(breaks, begin)[doc]
    return doc + first, number, h


class Sets:
    """The distinct words of each line with a word, rarest first, as flat arrays."""

    def __init__(self, texts: list[str | None], rarity: np.ndarray | None = None):
        doc, number, h = word_hashes(texts)
        new = np.ones(len(h), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        self.doc, self.number, self.lines = doc[new], number[new], int(new.sum())
        if not self.lines:
            return
        line = np.cumsum(new) - 1
        kind = rarity[h >> np.uint64(64 - SLOTS_BITS)] if rarity is not None else np.zeros(len(h), dtype=np.uint64)
        # line, class of rarity and the upper bits of the hash in one number
        key = line.astype(np.uint64) << np.uint64(40) | kind << np.uint64(34) | h >> np.uint64(30)
        order = np.argsort(key)
        key, ordered = key[order], h[order]
        same = key[1:] == key[:-1]
        if (same & (ordered[1:] != ordered[:-1])).any():  # two words alike in all upper bits
            order = np.lexsort((h, kind, line))
            ordered = h[order]
        line = line[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (ordered[1:] != ordered[:-1]) | (line[1:] != line[:-1])
        self.words = ordered[new]
        self.size = np.bincount(line[new], minlength=self.lines)
        self.start = np.cumsum(self.size) - self.size
        self.key = np.add.reduceat(_mixed(self.words ^ np.uint64(_BASE)), self.start).view(np.int64)
        self.parity = parities(self.words, self.start, self.size)


def width(n: np.ndarray) -> np.ndarray:
    """64-bit words of parity that a line of n words has: 1, 2 or 4."""
    return np.where(n <= 80, 1, np.where(n <= 160, 2, 4))


def parities(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Four columns: for each slot of word hashes whether an odd number of words falls there.

    Shorter lines have fewer slots; their parities are those of longer ones laid over
    each other.
    """
    part = (words >> np.uint64(6) & np.uint64(3)).astype(np.int64) & np.repeat(width(size) - 1, size)
    bit = _ONE << (words & _MASK)
    return np.stack([np.bitwise_xor.reduceat(np.where(part == k, bit, np.uint64(0)), start) for k in range(4)]).view(np.int64)


def differing(x: list[np.ndarray], y: list[np.ndarray], common: np.ndarray) -> np.ndarray:
    """Slots whose parities differ, at the smaller width of the two: at most the differing words."""
    four = [a ^ b for a, b in zip(x, y, strict=True)]
    two = [four[0] ^ four[2], four[1] ^ four[3]]
    count = [sum(np.bitwise_count(c).astype(np.int64) for c in cs) for cs in ([two[0] ^ two[1]], two, four)]
    return np.where(common == 1, count[0], np.where(common == 2, count[1], count[2]))


def classes(counts: np.ndarray) -> np.ndarray:
    """Class of rarity, 0 to 63, by slot: three to a doubling."""
    return np.minimum(63, 3 * np.log2(counts + 1)).astype(np.uint64)


def rarities(docs: DataFrame) -> np.ndarray:
    """Occurrences of words by slot over all documents, added up in the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOTS_BITS, dtype=np.int64)
        for batch in batches:
            h = word_hashes(batch.column(0).to_pylist())[2]
            slots += np.bincount((h >> np.uint64(64 - SLOTS_BITS)).astype(np.int64), minlength=len(slots))
        yield from rows(dict(enumerate(slots.astype(np.uint32).reshape(CHUNKS, -1))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data, dtype=np.uint32).astype(np.int64)
                held[chunk] = held[chunk] + part if chunk in held else part
        yield from rows(held)

    def rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for chunk, part in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part.tobytes()])],
                                             names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition(CHUNKS, "chunk").mapInArrow(add, schema)
    out = np.zeros((CHUNKS, (1 << SLOTS_BITS) // CHUNKS), dtype=np.int64)
    for chunk, data in summed.collect():  # CHUNKS rows
        out[chunk] = np.frombuffer(data, dtype=np.int64)
    return out.reshape(-1)


_LINES = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("mark", T.LongType()), T.StructField("line", T.LongType()),
    T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType()), *(T.StructField(f"p{k}", T.LongType()) for k in range(4)),
    T.StructField("prefix", T.ArrayType(T.LongType()))])  # name of a word << 32 | its place


def first_lines(docs: DataFrame, rarity: np.ndarray, similarity: int, group: int = GROUP) -> DataFrame:
    """The first line of each set of words, with its prefix words and their places.

    A task passes on the first copy it reads; of those the first of all stays. A word with more than
    ``group`` occurrences stands for several blocks: a line takes one, and meets each
    other block under a name that the pair of blocks has in common.
    """
    counts = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        kinds = classes(counts.value)
        for batch in batches:
            sets = Sets(batch.column(2).to_pylist(), kinds)
            if not sets.lines:
                continue
            doc = batch.column(0).to_numpy(zero_copy_only=False)[sets.doc]
            mark = batch.column(1).to_numpy(zero_copy_only=False)[sets.doc]
            kept = []
            order = np.lexsort((sets.number, doc))
            lines = zip(order.tolist(), sets.key[order].tolist(), doc[order].tolist(), sets.number[order].tolist(), strict=True)
            for i, key, d, number in lines:
                at = (d, number)
                if key not in seen or at < seen[key]:
                    seen[key] = at
                    kept.append(i)
                elif at == seen[key]:  # another text with the same id
                    kept.append(i)
            if not kept:
                continue
            kept = np.array(kept)
            size = sets.size[kept]
            prefix = size - -(-similarity * size // 100) + 1
            of = np.repeat(np.arange(len(kept)), prefix)
            place = np.arange(prefix.sum()) - np.repeat(np.cumsum(prefix) - prefix, prefix)
            word = sets.words[sets.start[kept][of] + place]
            often = counts.value[word >> np.uint64(64 - SLOTS_BITS)]
            blocks = np.maximum(1, -(-often // group))
            own = (sets.key[kept][of].view(np.uint64) % blocks.astype(np.uint64)).astype(np.int64)
            other = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            of, place, word, own, blocks = (np.repeat(x, blocks) for x in (of, place, word, own, blocks))
            low, high = np.minimum(own, other), np.maximum(own, other)
            name = (word ^ (low * blocks + high).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(kept)))]).astype(np.int32)
            packed = (name << np.uint64(32) | place.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[kept], pa.int64()), pa.array(mark[kept], pa.int64()), pa.array(sets.number[kept]),
                 pa.array(sets.key[kept]), pa.array(size.astype(np.int32)), *(pa.array(x[kept]) for x in sets.parity),
                 pa.ListArray.from_arrays(ends, pa.array(packed))],
                names=_LINES.fieldNames())

    def first_of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keep = []
            for at in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "line")), strict=True):
                keep.append(last is None or at[0] != last[0] or at == last)
                last = at if keep[-1] else last
            yield batch.filter(pa.array(keep, pa.bool_()))

    return (docs.select("doc", "mark", "text").mapInArrow(run, _LINES)
            .repartition("key").sortWithinPartitions("key", "doc", "line").mapInArrow(first_of_key, _LINES))


_PAIRS = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("doc", "line", "key", "doc2", "line2", "key2")),
    T.StructField("more", T.BooleanType())])
_PARITY = ["p0", "p1", "p2", "p3"]
_ENTRY = ["word", "doc", "line", "key", "n", "place", *_PARITY, "probe"]


def earlier_candidates(entry: dict[str, np.ndarray], similarity: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(later, earlier, more) rows among entries sorted by word, doc, line and key.

    Every probe is held against the earlier lines of its word from the first on, until
    ``first`` of them pass the filters (0: all). Sets differ, except for lines of the same
    number in rows with one id.
    """
    word, n, place = (entry[c] for c in ("word", "n", "place"))
    parity, wide = [entry[c].view(np.uint64) for c in _PARITY], width(n)
    new = np.concatenate([[True], word[1:] != word[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(word)), 0))
    todo = np.flatnonzero(entry["probe"] & ~new)
    found = np.zeros(len(word), dtype=np.int64)
    more = np.zeros(len(word), dtype=bool)
    later, earlier, step = [], [], 0
    while len(todo := todo[start[todo] + step < todo]):
        other = start[todo] + step
        a, b = n[todo], n[other]
        need = overlap_needed(a, b, similarity)
        ok = np.minimum(a, b) >= need                                                    # length
        ok &= np.minimum(a - place[todo], b - place[other]) + np.minimum(place[todo], place[other]) >= need  # position
        left = np.flatnonzero(ok)
        x, y = todo[left], other[left]
        apart = differing([p[x] for p in parity], [p[y] for p in parity], np.minimum(wide[x], wide[y]))
        left = left[apart <= (a + b - 2 * need)[left]]                                     # parity of word slots
        x, y = todo[left], other[left]
        full = (found[x] >= first) if first else np.zeros(len(x), dtype=bool)
        more[x[full]] = True
        later.append(x[~full])
        earlier.append(y[~full])
        found[x] += 1
        settled = np.zeros(len(todo), dtype=bool)
        settled[left[full]] = True
        todo = todo[~settled]
        step += 1
    none = np.zeros(0, dtype=np.int64)
    x = np.concatenate([none, *later])
    return x, np.concatenate([none, *earlier]), more[x]


def candidates(lines: DataFrame, similarity: int, first: int, asked: DataFrame | None = None) -> DataFrame:
    """Pairs of a line and an earlier one that share a prefix word and pass the filters.

    ``asked``: slots of the words to look at (FILTER_SLOTS rows at most), else all words.
    """
    entries = (lines.select("doc", "line", "key", "n", *_PARITY, "probe", F.explode("prefix").alias("e"))
               .select("*", F.shiftright("e", 32).cast("int").alias("word"), F.expr("CAST(e & 4294967295L AS INT)").alias("place")))
    if asked is not None:
        entries = entries.withColumn("slot", F.pmod("word", F.lit(FILTER_SLOTS))).join(asked, "slot", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entry in _whole_words(batches):
            x, y, more = earlier_candidates(entry, similarity, first)
            for at in range(0, len(x), 1 << 17):
                i, j = x[at:at + (1 << 17)], y[at:at + (1 << 17)]
                cols = [entry[c][k] for k in (i, j) for c in ("doc", "line", "key")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, more[at:at + (1 << 17)])],
                                                 names=_PAIRS.fieldNames())

    met = entries.select(*_ENTRY).repartition("word").sortWithinPartitions("word")
    # a pair may meet under several words, and is settled once
    return (met.mapInArrow(run, _PAIRS).groupBy("doc", "line", "key", "doc2", "line2", "key2")
            .agg(F.max("more").alias("more")).where("doc <> doc2 OR line <> line2"))


def _whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches as arrays, cut only between words."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if held and (cut or held[-1][0][-1] != cols[0][-1]) and rows + cut >= 100_000:
            yield _entry([*held, [c[:cut] for c in cols]])
            held, rows, cols = [], 0, [c[cut:] for c in cols]
        held.append(cols)
        rows += len(cols[0])
    if held:
        yield _entry(held)


def _entry(parts: list[list[np.ndarray]]) -> dict[str, np.ndarray]:
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
    order = np.lexsort([cols[_ENTRY.index(c)] for c in ("key", "line", "doc", "word")])
    cols = [c[order] for c in cols]
    out = dict(zip(_ENTRY, cols, strict=True))
    out["n"], out["place"] = out["n"].astype(np.int64), out["place"].astype(np.int64)
    return out


_SET = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc", "line", "key")), T.StructField("words", T.BinaryType())])
def verified(pairs: DataFrame, docs: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose word sets, read from the texts again, are similar enough."""
    wanted = stored(pairs.select("doc", "line", "key").union(pairs.select("doc2", "line2", "key2")).distinct(), "wanted")
    slot = F.pmod(F.xxhash64("doc"), F.lit(FILTER_SLOTS))
    slots = F.broadcast(wanted.select(slot.alias("slot")).distinct())  # FILTER_SLOTS rows at most
    by_doc = wanted.groupBy("doc").agg(F.collect_set("line").alias("lines"))
    texts = docs.select("doc", "text").withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, numbers, texts_ = [], [], []
            for d, text, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut = (text or "").split("\n")
                for i in lines:
                    if i < len(cut):
                        doc.append(d)
                        numbers.append(i)
                        texts_.append(cut[i])
            one = Sets(texts_)
            if one.lines:
                words = [np.sort(one.words[a:a + n]).tobytes() for a, n in zip(one.start.tolist(), one.size.tolist(), strict=True)]
                of = one.doc.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc[i] for i in of], pa.int64()), pa.array([numbers[i] for i in of], pa.int64()),
                     pa.array(one.key), pa.array(words, pa.binary())], names=_SET.fieldNames())

    found = stored(texts.join(by_doc, "doc").select("doc", "text", "lines").mapInArrow(sets, _SET)
                   .dropDuplicates(["doc", "line", "key"]), "line-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (3, 4))
            ok = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                ok.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ok, pa.bool_())],
                                             names=["doc", "line", "key", "similar"])

    other = found.select(*[F.col(c).alias(f"{c}2") for c in found.columns])
    return (pairs.join(found, ["doc", "line", "key"]).join(other, ["doc2", "line2", "key2"])
            .select("doc", "line", "key", "words", "words2")
            .mapInArrow(check, "doc long, line long, key long, similar boolean").where("similar").drop("similar"))


def kept_lines(docs: DataFrame, similarity: int = SIMILARITY, group: int = GROUP, first: int = FIRST) -> DataFrame:
    """(doc, mark, kept): numbers of the lines to keep of each document that keeps some.

    ``docs``: doc, mark, text. A line goes if any earlier line, by document id and line
    number, has a similar set of words, whether that one goes itself or not.
    """
    rarity = rarities(docs)
    lines = stored(first_lines(docs, rarity, similarity, group), "lines")
    ids = ["doc", "line", "key"]
    pairs = stored(candidates(lines.withColumn("probe", F.lit(True)), similarity, first), "line-pairs")
    gone = stored(verified(pairs, docs, similarity).distinct(), "lines-gone")
    open_ = stored(pairs.where("more").select(*ids).distinct().join(gone, ids, "left_anti"), "lines-open")
    if not open_.isEmpty():
        asked = lines.join(open_.withColumn("probe", F.lit(True)), ids, "left").withColumn(
            "probe", F.coalesce("probe", F.lit(False)))
        words = asked.where("probe").select(F.explode("prefix").alias("e")).select(F.shiftright("e", 32).cast("int").alias("word"))
        slots = F.broadcast(words.select(F.pmod("word", F.lit(FILTER_SLOTS)).alias("slot")).distinct())
        rest = stored(candidates(asked, similarity, 0, slots), "line-pairs")
        gone = gone.union(verified(rest, docs, similarity)).distinct()
    return (lines.select("doc", "mark", "line", "key").join(gone, ids, "left_anti")
            .groupBy("doc", "mark").agg(F.collect_list("line").alias("kept")))


def deduplicated(docs: DataFrame, into: str, id_col: str = "doc_id", text_col: str = "text",
                 similarity: int = SIMILARITY, **options) -> DataFrame:
    """``docs`` with a struct column ``into``: lines, removed (counts of lines with a word), text.

    The words of a line are its runs without white space, A-Z in lower case, as a set.
    Lines whose sets have a Jaccard similarity of ``similarity`` hundredths or more match,
    and of two that match the later goes. Lines without words stay. Null text: no lines,
    text null. Rows with the same id and text are one document and keep the same lines;
    of rows with the same id and other texts, lines of the same number and words are one
    line. Null ids come first. No rows: no output. Other columns pass through.
    """
    small_batches(docs.sparkSession)
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.col(text_col).cast("string")
    own = docs.select(id_.alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))
    kept = kept_lines(own, similarity, **options)
    a, b, c = (fresh(x, docs.columns) for x in ("doc_key", "mark_key", "kept_lines"))
    kept = kept.select(F.col("doc").alias(a), F.col("mark").alias(b), F.col("kept").alias(c))
    joined = docs.withColumn(a, id_).withColumn(b, F.xxhash64(text)).join(kept, [a, b], "left")
    fields = docs.schema.fields
    schema = T.StructType([*fields, T.StructField(into, T._parse_datatype_string(
        "struct<lines:bigint,removed:bigint,text:string>"))])
    kind = pa.struct([("lines", pa.int64()), ("removed", pa.int64()), ("text", pa.string())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, keep in zip(batch.column(at).to_pylist(), batch.column(len(fields)).to_pylist(), strict=True):
                lines = text.split("\n") if text is not None else []
                worded = {i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")}
                go = worded - set(keep or ())
                left = "\n".join(x for i, x in enumerate(lines) if i not in go) if text is not None else None
                out.append({"lines": len(worded), "removed": len(go), "text": left})
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(fields)], pa.array(out, kind)],
                                             names=schema.fieldNames())

    return joined.select(*[F.col(f"`{x}`") for x in docs.columns], c).mapInArrow(run, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, for every row."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = deduplicated(given, "found", "doc_id", "text", **options)
    return found.select("doc_id", F.col("found.lines").alias("n_lines"), F.col("found.removed").alias("n_removed"),
                        F.col("found.text").alias("text"))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without repeated lines; a document that loses all its lines goes."""
    into = fresh("found", docs.columns)
    found = deduplicated(docs, into, id_col, text_col, **options).where(
        (F.col(f"{into}.removed") < F.col(f"{into}.lines")) | (F.col(f"{into}.lines") == 0))
    new = {text_col: F.col(f"{into}.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(f"{into}.text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[(new[c] if c in new else F.col(f"`{c}`")).alias(c) for c in docs.columns])
