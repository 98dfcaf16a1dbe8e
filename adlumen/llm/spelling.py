"""Spelling variants: words one edit apart, found among sorted permuterm rotations.

A word with its terminator is written in all its rotations. Of a rotation that ends in some
letter, the part before that letter is what is left when the letter is edited. Words that
differ by one replaced letter share such a part; a word with one letter less is such a part
itself, as its own whole rotation. So the rotations with one prefix, sorted, hold exactly the
words that are near each other by the edit of that one place; there are no more of them than
the alphabet has letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adlumen.llm.common import small_batches, stored

#: Words have so many code points and occurrences or more; a form has so many times the word's.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: Occurrences whose checksum this divides lose a letter.
SLIP = 199
#: Different words a task counts before it hands them on.
COUNTED = 1 << 18
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_END = "$"


def slipped(run: str, check: int) -> str:
    """A run as it counts: every so many checksums a letter is lost."""
    if check % SLIP:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1:]


def runs(doc: object, text: str | None, letters: int = LETTERS) -> Counter:
    """The runs of one text as they count, with their occurrences; null ids read as empty."""
    out: Counter = Counter()
    before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
    for run, n in Counter(_RUN.findall((text or "").encode().lower().decode())).items():
        if len(run) >= letters:
            word = slipped(run, zlib.crc32(run.encode(), before))
            if len(word) >= letters:
                out[word] += n
    return out


def words(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n of every word of the corpus; counts are added up in tasks before they are dealt out."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def batch_of(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in runs(doc, text, letters).items():
                    counted[word] += n
                if len(counted) >= COUNTED:
                    yield batch_of(counted)
                    counted.clear()
        yield batch_of(counted)

    return (given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= occurrences))


def rotations(found: DataFrame) -> DataFrame:
    """rest, edit, first and n: every rotation of every (word, n) cut before its edited letter.

    ``edit`` is empty where the rest is a whole word. ``first``: the letter does not repeat
    the one before it, so that of several letters whose loss gives one word only one counts.
    """
    at = F.explode(F.expr("sequence(0, length(word))")).alias("at")
    # behind the last letter there is only the whole word
    turned = found.select("word", "n", at).select("n", F.explode(F.expr(f"""slice(array(
        struct(concat(substr(word, at + 1), '{_END}', substr(word, 1, at)) AS rest, '' AS edit, true AS first),
        struct(concat(substr(word, at + 2), '{_END}', substr(word, 1, at)) AS rest, substr(word, at + 1, 1) AS edit,
               at = 0 OR substr(word, at, 1) <> substr(word, at + 1, 1) AS first)), 1, if(at < length(word), 2, 1))""")).alias("r"))
    return turned.select("r.rest", "r.edit", "r.first", "n")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches, cut so that all rows with one rest are in one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest = batch.column(0)
        other = np.flatnonzero(pc.not_equal(rest.slice(1), rest.slice(0, len(rest) - 1)).to_numpy(zero_copy_only=False))
        if len(other):  # the last rest may go on in the next batch
            cut = int(other[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(0)[-1].as_py() != rest[0].as_py():
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _near(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are near: the same rest, and an empty edit only with first letters."""
    rest = table.column("rest").combine_chunks()
    same = np.zeros(len(rest), dtype=bool)
    same[1:] = pc.equal(rest.slice(1), rest.slice(0, len(rest) - 1)).to_numpy(zero_copy_only=False)
    group = np.cumsum(~same)
    whole = pc.equal(table.column("edit"), "").to_numpy()
    first = table.column("first").to_numpy()
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    at, shift = np.flatnonzero(same) - 1, 1
    while len(at := at[at + shift < len(group)]) and len(at := at[group[at] == group[at + shift]]):
        good = at[~whole[at] | first[at + shift]]  # the empty edit stands first in its group
        a.append(good)
        b.append(good + shift)
        shift += 1
    return np.concatenate([*a, *b]), np.concatenate([*b, *a])


def _word(rest: str, edit: str) -> str:
    after, _, before = rest.partition(_END)
    return before + edit + after


def neighbours(found: DataFrame) -> DataFrame:
    """word, near and near_n of every word of (word, n) and each word one edit away, once each.

    Words hold no ``$`` and are distinct. No words: no rows.
    """
    turned = rotations(found).repartition("rest").sortWithinPartitions("rest", "edit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _cut(batches):
            a, b = _near(table)
            if not len(a):
                continue
            rows, back = np.unique(np.concatenate([a, b]), return_inverse=True)
            met = table.take(pa.array(rows))
            names = pa.array(map(_word, met.column("rest").to_pylist(), met.column("edit").to_pylist()), pa.string())
            n = met.column("n").combine_chunks()
            a, b = pa.array(back[:len(a)]), pa.array(back[len(a):])
            yield pa.RecordBatch.from_arrays([names.take(a), names.take(b), n.take(b)], names=["word", "near", "near_n"])

    return turned.mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last of the chain word, form, form of the form, of distinct (word, form).

    Each round follows a chain twice as far; counts grow along a chain, so it has no ring.
    """
    now = stored(forms.selectExpr("word", "form AS root", "true AS moved"), "spelling-roots")
    while now.where("moved").limit(1).count():
        on = now.selectExpr("word AS root", "root AS next")
        now = stored(now.join(on, "root", "left").selectExpr(
            "word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"), "spelling-roots")
    return now.drop("moved")


def variants(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, times: int = TIMES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus.

    A form is the near word of largest n (ties: smallest in code-point order) if it has
    ``times`` the word's occurrences or more. Null, empty and letter-less texts have no
    words; a null id reads as empty text in the checksum; repeated rows count each. A text
    is read whole in its row. No documents: no rows. Other columns are ignored.
    """
    found = stored(words(docs, letters, occurrences, id_col, text_col), "spelling-words")
    best = neighbours(found).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = found.join(best, "word", "left").withColumn("far", -F.col("best.less") >= times * F.col("n"))
    known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                F.expr("if(far, best.near, NULL) AS form"), F.expr("if(far, -best.less, NULL) AS form_n")), "spelling-forms")
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
