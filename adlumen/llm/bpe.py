"""Byte-level BPE as a bounded-lookahead streaming transducer, and incremental decoding.

A merge can only be prevented from the right by a chain of merges of falling rank, each
starting where the one before ends. :func:`lookahead` follows those chains through the
merge list and gives the number of bytes beyond a boundary that can decide whether the
boundary stays. A boundary further than that from the end of what has been read is final,
and what follows a final boundary is encoded as if it stood alone. So the transducer keeps
one buffer of fixed size, whatever the length of the text.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm.common import once, small_batches

#: Pieces remembered by a worker with their ids; the memory is emptied when full.
REMEMBERED = 400_000
#: Pieces of more bytes go through the streaming buffer.
SHORT = 64
#: Bytes read into the buffer at a time, beside the lookahead.
CHUNK = 4_096

#: Fixed values of the byte-level format: white space by the Unicode property, and how a
#: text falls into pieces before merging.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
          + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def lookahead(merges: list[tuple[int, int, int]], size: list[int]) -> int:
    """Bytes beyond a boundary that can decide whether a merge takes it away.

    ``merges``: (left, right, made) by rank. For each merge the reach is the length of its
    right token plus what may be needed to know that this token stands there: any earlier
    merge that could have drawn its right edge, or that of a token on its right spine
    while that one still stood alone, into what follows.
    """
    drawn = [0] * len(size)   # by token: furthest reach of the merges so far with it on the left
    spine = [0] * len(size)   # by token: the same for its right spine, as of its making
    most = 0
    for left, right, made in merges:
        reach = size[right] + max(drawn[right], spine[right])
        most = max(most, reach)
        drawn[left] = max(drawn[left], reach)
        spine[made] = max(spine[made], drawn[right], spine[right])
    return most


class Known(dict):
    """Ids of pieces as packed 32-bit integers; a piece that is not remembered is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        packed = np.array(ids, dtype=np.int32).tobytes()
        if len(ids) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class Merges:
    """Vocabulary and merge list of a byte-level tokenizer file, by id."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {
            i: bytes(letters[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        by_rank = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.made = [made for _, _, made in by_rank]
        self.rank = {(a, b): rank for rank, (a, b, _) in reversed(list(enumerate(by_rank)))}.get
        self.letters = [0] * 256
        for c, b in letters.items():
            self.letters[b] = vocab[c]
        size = [0] * (max(self.bytes) + 1)
        for i, b in self.bytes.items():
            size[i] = len(b)
        self.reach = lookahead(by_rank, size)
        # all tokens' bytes in a row, to gather those of many ids at once
        self.pool = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(len(size))), dtype=np.uint8)
        self.size = np.array(size, dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pieces = regex.compile(PIECES).findall
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) \
            if self.special else None
        self.known = Known(self.piece)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a short piece: apply the earliest merge, leftmost first, until none is left."""
        ids, rank, none = [self.letters[b] for b in piece], self.rank, len(self.made)
        order = [rank(pair, none) for pair in pairwise(ids)]
        while order and (best := min(order)) < none:
            at = order.index(best)
            ids[at:at + 2] = [self.made[best]]
            del order[at]
            if at:
                order[at - 1] = rank((ids[at - 1], ids[at]), none)
            if at < len(order):
                order[at] = rank((ids[at], ids[at + 1]), none)
        return ids

    def merge_long(self, piece: bytes) -> list[int]:
        """The same with a queue of merges and linked neighbours: n log n."""
        ids = [self.letters[b] for b in piece]
        n, rank, made_by = len(ids), self.rank, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(f, i, ids[i], ids[i + 1]) for i in range(n - 1) if (f := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            best, i, a, b = heapq.heappop(queue)
            made, j = made_by[best], after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (f := rank((made, ids[k]))) is not None:
                    heapq.heappush(queue, (f, i, made, ids[k]))
            if (h := before[i]) >= 0 and (f := rank((ids[h], made))) is not None:
                heapq.heappush(queue, (f, h, ids[h], made))
        return [i for i in ids if i >= 0]

    def push(self, held: bytes, more: bytes, last: bool) -> tuple[list[int], bytes]:
        """One step: what is final of ``held + more``, and the bytes still to be decided."""
        data = held + more
        ids = self.merge_long(data)
        if last:
            return ids, b""
        end, sure = 0, 0
        for n, i in enumerate(ids):
            if end + len(self.bytes[i]) + self.reach > len(data):
                break
            end, sure = end + len(self.bytes[i]), n + 1
        return ids[:sure], data[end:]

    def piece(self, text: str) -> list[int]:
        raw = text.encode()
        if len(raw) <= SHORT:
            return self.merge(raw)
        ids, held = [], b""
        for at in range(0, len(raw), CHUNK):
            done, held = self.push(held, raw[at:at + CHUNK], at + CHUNK >= len(raw))
            ids += done
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit integers."""
        known, parts, at = self.known.__getitem__, [], 0
        if self.marks:
            for m in self.marks.finditer(text):
                parts += map(known, self.pieces(text[at:m.start()]))
                parts.append(np.int32(self.special[m.group()]).tobytes())
                at = m.end()
        parts += map(known, self.pieces(text[at:] if at else text))
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype=np.int32).tolist()

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.pool[at].tobytes()


class Decoder:
    """Ids to text, a part at a time: bytes of an unfinished character wait for the next part."""

    def __init__(self, merges: Merges):
        self.raw = merges.raw
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: np.ndarray | list[int], last: bool = False) -> str:
        return self.state.decode(self.raw(np.asarray(ids, dtype=np.int64)), last)


def _merges(path: str) -> Merges:
    return once(("bpe", path), lambda: Merges(path))


_ID = "doc_id"


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and token ids of every row.

    Null or empty text: no ids. Special strings of the tokenizer file inside a text become
    their special ids. Repeated rows are encoded each. Other columns are ignored. No
    shuffle: each text is encoded where it is read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(tokenizer)
        for batch in batches:
            for part in _parts(batch):
                packed = [merges.packed(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[_ID, "ids"])

    given = docs.select(F.col(id_col).alias(_ID), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, T.StructType([given.schema[_ID], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and decoded text. Null ids: empty text; bytes that are no UTF-8 become U+FFFD."""
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(tokenizer)
        for batch in batches:
            for part in _parts(batch):
                texts, column = [], part.column(1)
                values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                for known, first, end in zip(column.is_valid().to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    one, end = Decoder(merges), end if known else first
                    texts.append("".join(one.push(values[at:min(at + CHUNK, end)], at + CHUNK >= end)
                                         for at in range(first, end, CHUNK)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[_ID, "ids", "text"])

    given = tokens.select(_ID, "ids")
    return given.mapInArrow(run, T.StructType([*given.schema.fields, T.StructField("text", T.StringType())]))


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ids and decoded texts, and columns asked for."""
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return decoded.select(
        _ID, F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"), *more)


def _parts(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, one row at least."""
    if batch.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    rows = max(1, batch.num_rows * most // batch.nbytes)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
