"""Chat formatting with loss masks from offset intersection."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm.common import once, small_batches

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = (TURN, BODY, END)
#: Starts of strings that mark turns, here or in other templates. One backslash more after
#: the first character takes a mark its meaning; one less gives it back.
_ESCAPED = re.compile(r"(?<=<)\\(?=\\*\|)|(?<=<)\\(?=\\*/?s>)|(?<=\[)\\(?=\\*/?INST\])")
_PLAIN = re.compile(r"(?<=<)(?=\\*\|)|(?<=<)(?=\\*/?s>)|(?<=\[)(?=\\*/?INST\])")
_TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.S)

FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("loss", T.ArrayType(T.BooleanType()))])


def escape(text: str) -> str:
    return _PLAIN.sub("\\\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def render(turns: list[tuple[str | None, str | None]], scored: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of the scored texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role or '')}{BODY}", escape(text or "")
        if role == scored:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def tokens_in(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the tokens that share a character with a span; all three are sorted."""
    mask = np.zeros(len(starts), dtype=bool)
    if spans:
        low = np.searchsorted(ends, [s for s, _ in spans], side="right")
        high = np.searchsorted(starts, [e for _, e in spans], side="left")
        for a, b, (s, e) in zip(low, high, spans, strict=True):
            if e > s:
                mask[a:b] = True
    return mask


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURNS.findall(formatted)]


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The text under the mask, one piece for each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], loss, [False]]).astype(np.int8)))
    return [unescape(formatted[starts[a]:ends[b - 1]]) for a, b in edges.reshape(-1, 2)]


def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer
    from tokenizers.processors import ByteLevel

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.post_processor = ByteLevel(trim_offsets=False)
    # marks are tokens of their own, so that no token reaches across the edge of a turn
    tok.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in CONTROL])
    return tok


def format_chats(rows: DataFrame, tokenizer: str, scored: str = "assistant") -> DataFrame:
    """One formatted and masked row for each conversation.

    Takes conv_id, turn, role, text; other columns are ignored. Output: conv_id,
    formatted, and for each token id, start, end (code points) and loss. A whole
    conversation is rendered and encoded once; the sorted spans of the scored texts meet
    the sorted token offsets by binary search.

    Null text or role: empty. Null turns come first; rows of one turn are ordered by role
    and text, repeated rows are turns of their own. A null conv_id is a conversation. No
    rows: no output. Conversations are spread by id and read in order, one at a time: a
    task holds one conversation, which is one row of the result.
    """
    small_batches(rows.sparkSession)
    given = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
                        ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = once(("chat", tokenizer), lambda: _tokenizer(tokenizer))

        def formatted(conv, turns):
            text, spans = render(turns, scored)
            enc = tok.encode(text, add_special_tokens=False)
            at = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
            mask = tokens_in(spans, at[:, 0], at[:, 1])
            return pa.RecordBatch.from_arrays([
                pa.array([conv], pa.int64()), pa.array([text]), pa.array([enc.ids], pa.list_(pa.int32())),
                pa.array([at[:, 0]], pa.list_(pa.int32())), pa.array([at[:, 1]], pa.list_(pa.int32())),
                pa.array([mask], pa.list_(pa.bool_()))], schema=schema)

        def joined(found):
            return pa.Table.from_batches(found, schema).combine_chunks().to_batches()

        conv, turns, ready, chars = None, None, [], 0
        for batch in batches:
            c, _, r, t = (col.to_pylist() for col in batch.columns)
            for i in range(len(c)):
                if turns is not None and c[i] != conv:
                    ready.append(formatted(conv, turns))
                    chars += ready[-1].nbytes
                    turns = None
                    if chars > 8 << 20:
                        yield from joined(ready)
                        ready, chars = [], 0
                if turns is None:
                    conv, turns = c[i], []
                turns.append((r[i], t[i]))
        if turns is not None:
            ready.append(formatted(conv, turns))
        if ready:
            yield from joined(ready)

    return given.mapInArrow(run, FORMATTED)


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of turns and scored text, taken from the formatted rows alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = turns_of(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(loss_texts(text, np.array(row["starts"], dtype=np.int64), np.array(row["ends"], dtype=np.int64),
                                          np.array(row["loss"], dtype=bool)))
                out.append((row["conv_id"], len(turns), sha256(said.encode()).hexdigest(), len(loss),
                            sha256(loss.encode()).hexdigest(), len(text)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(col), kind) for col, kind in zip(
                        zip(*out, strict=True),
                        (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                    names=DIGEST.fieldNames())

    return chats.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(run, DIGEST)
