"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.functions.sums import exact_sum
from adlumen.llm.common import once, small_batches, stored

ORDER = 4
#: Hash values of the stored n-grams: at most 2 ** BITS rows an order, whatever the corpus.
BITS = 21
#: Temperatures that are tried.
TEMPERATURES = np.geomspace(0.005, 2.0, 40)
#: A document is rejected if its cross-entropy lies so many deviations above the mean of
#: its language.
DEVIATIONS = 4.0
#: Code points worked on together; a longer text is alone.
POINTS = 1 << 19
_SPACE = 32
_WIDTH = 16


def letters() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark that goes with letters, else 0."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            kinds[cp] = 2
        elif cp > 0x2FF and unicodedata.category(c)[0] == "M":
            kinds[cp] = 1
    return kinds


class Grams:
    """The ORDER-grams of a batch of texts, packed into 64 bits, and the text of each.

    Lower case; runs of anything but letters are one space; three spaces stand before a
    text and one behind it.
    """

    def __init__(self, texts: list[str | None]):
        kinds = once("letters", letters)
        points = [np.frombuffer((t or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32) for t in texts]
        pad = np.full(ORDER - 1, _SPACE, dtype=np.uint32)
        parts = [x for p in points for x in (pad, p, pad[:1])]
        code = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
        size = np.array([len(p) + ORDER for p in points], dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), size)
        kind = kinds[code]
        self.worded = np.bincount(doc[kind == 2], minlength=len(texts)) > 0
        code = np.where(kind > 0, code, _SPACE)
        first = np.cumsum(size) - size
        keep = np.ones(len(code), dtype=bool)
        keep[1:] = (code[1:] != _SPACE) | (code[:-1] != _SPACE)
        head = (first[:, None] + np.arange(ORDER - 1)).reshape(-1)
        keep[head] = True  # the spaces before a text
        start = np.zeros(len(code), dtype=bool)
        start[head] = True
        code, doc, start = code[keep], doc[keep], start[keep]
        unit = ((code & 0xFFFF) ^ (code >> 16) * 0x9E37 & 0xFFFF).astype(np.uint64)
        gram = np.zeros(len(unit), dtype=np.uint64)
        for back in range(ORDER):
            gram[back:] |= unit[:len(unit) - back] << np.uint64(_WIDTH * back)
        self.gram, self.doc = gram[~start], doc[~start]


def groups(texts: list[str | None], most: int = POINTS) -> Iterator[tuple[int, int]]:
    """First and end of neighbouring texts of ``most`` code points together, one text at least."""
    first = size = 0
    for i, text in enumerate(texts):
        own = len(text or "") + ORDER
        if i > first and size + own > most:
            yield first, i
            first, size = i, 0
        size += own
    if len(texts) > first:
        yield first, len(texts)


def slots(gram: np.ndarray) -> np.ndarray:
    """Hash values of packed n-grams."""
    h = gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def counted(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all labelled texts; partial counts are merged in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for first, end in groups(own):
                    found = np.unique(Grams(own[first:end]).gram, return_counts=True)
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                    if size > 1 << 20:
                        held = {x: [_merged(parts)] for x, parts in held.items()}
                        size = sum(len(p[0][0]) for p in held.values())
                        if size > 1 << 20:
                            yield from rows(held)
                            held, size = {}, 0
        yield from rows(held)

    def rows(held) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            gram, n = _merged(parts)
            for at in range(0, len(gram), 1 << 17):
                g = gram[at:at + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g)), pa.array(g.view(np.int64)), pa.array(n[at:at + (1 << 17)].astype(np.int64))],
                    names=["lang", "gram", "n"])

    return (labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return gram, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


@F.pandas_udf(T.IntegerType())
def _slot(gram: pd.Series) -> pd.Series:
    return pd.Series(slots(gram.to_numpy()))


def _by_slot(grid: DataFrame, langs: list[str], value: str, weight: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hash values and a log value for each language; at most 2 ** BITS rows."""
    one = (grid.withColumn("slot", _slot("key")).groupBy("slot", "lang")
           .agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("v"))
           .groupBy("slot").agg(*[F.max(F.when(F.col("lang") == x, F.col("v"))).alias(f"v{i}") for i, x in enumerate(langs)]))
    got = one.toPandas().sort_values("slot")
    return got["slot"].to_numpy(dtype=np.int32), np.log(got.drop(columns="slot").to_numpy(dtype=np.float64)).astype(np.float32)


def train(labelled: DataFrame, order: int = ORDER) -> dict:
    """Models of all languages of ``labelled`` (lang, text), as arrays.

    The highest order has raw counts, each lower one the number of different characters
    seen before its n-grams. Probabilities of every stored n-gram under every language
    are made here, from the n-gram's own discounted count and, by the weight of its
    context, the next lower order. Each order is stored as a sorted array of n-gram
    hashes and one of context hashes, with a row of logarithms for each.
    """
    counts = stored(counted(labelled), "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    model = {"langs": langs, "orders": {}}
    if not langs:
        return model
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        mask = (1 << _WIDTH * k) - 1
        tables[k] = stored(tables[k + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
                           .agg(F.count(F.lit(1)).alias("n")), f"grams-{k}")
    alphabet = tables[1].select("gram").distinct().count() + 1
    every = F.array(*[F.lit(x) for x in langs])
    lower = None
    for k in range(1, order + 1):
        table = tables[k]
        few = table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        few = few.select("lang", F.coalesce(F.expr("try_divide(n1, n1 + 2 * n2)"), F.lit(0.5)).alias("d")).withColumn(
            "d", F.greatest(F.lit(0.05), F.least(F.lit(0.95), "d")))
        context = F.shiftrightunsigned("gram", _WIDTH) if k > 1 else F.lit(0).cast("long")
        seen = table.withColumn("context", context).join(F.broadcast(few), "lang")  # a row a language
        contexts = stored(seen.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.first("d") * F.count(F.lit(1)) / F.sum("n")).alias("weight")), f"contexts-{k}")
        grid = (table.groupBy("gram").agg(F.sum("n").alias("mass")).withColumn("lang", F.explode(every))
                .withColumn("context", context))
        grid = (grid.join(seen.select("lang", "gram", "n", "d"), ["lang", "gram"], "left")
                .join(contexts, ["lang", "context"], "left"))
        if k == 1:
            grid = grid.withColumn("below", F.lit(1.0 / alphabet))
        else:
            grid = grid.withColumn("rest", F.col("gram").bitwiseAND(F.lit((1 << _WIDTH * (k - 1)) - 1)))
            grid = grid.join(lower.select("lang", F.col("gram").alias("rest"), F.col("p").alias("below")), ["lang", "rest"])
        p = (F.coalesce((F.col("n") - F.col("d")) / F.col("total"), F.lit(0.0))
             + F.coalesce("weight", F.lit(1.0)) * F.col("below"))
        lower = stored(grid.select("lang", "gram", "mass", p.alias("p")), f"probabilities-{k}")
        wide = (contexts.groupBy("context").agg(F.sum("total").alias("mass")).withColumn("lang", F.explode(every))
                .join(contexts.select("lang", "context", "weight"), ["lang", "context"], "left")
                .select("lang", F.col("context").alias("key"), "mass", F.coalesce("weight", F.lit(1.0)).alias("w")))
        model["orders"][k] = (_by_slot(lower.withColumnRenamed("gram", "key"), langs, "p", "mass"),
                              _by_slot(wide, langs, "w", "mass"))
    model["floor"] = -math.log(alphabet)
    return model


class Scorer:
    """Cross-entropies of texts under all languages of a model."""

    def __init__(self, model: dict):
        self.model, self.langs = model, model["langs"]
        self.places = {}
        for k, tables in model["orders"].items():
            for kind, (slot, _) in enumerate(tables):
                at = np.full(1 << BITS, -1, dtype=np.int32)  # where a hash stands in the sorted array
                at[slot] = np.arange(len(slot), dtype=np.int32)
                self.places[k, kind] = at

    def logs(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.full((len(gram), len(self.langs)), self.model["floor"], dtype=np.float32)
        own = gram & np.uint64((1 << _WIDTH * order) - 1) if order < ORDER else gram
        at = self.places[order, 0][slots(own)]
        out = self.model["orders"][order][0][1][at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            rest = own[missing]
            low = self.logs(rest, order - 1)
            context = self.places[order, 1][slots(rest >> np.uint64(_WIDTH) if order > 1 else rest * np.uint64(0))]
            weight = self.model["orders"][order][1][1][context]
            weight[context < 0] = 0.0
            out[missing] = low + weight
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a character for each text and language, and whether the text has a letter."""
        total, worded = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=bool)
        for first, end in groups(texts):
            grams = Grams(texts[first:end])
            worded[first:end] = grams.worded
            for at in range(0, len(grams.gram), 1 << 18):
                logs, doc = self.logs(grams.gram[at:at + (1 << 18)]), grams.doc[at:at + (1 << 18)] + first
                edges = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                total[doc[edges]] -= np.add.reduceat(logs, edges, axis=0)
            total[first:end] /= np.maximum(np.bincount(grams.doc, minlength=end - first), 1)[:, None]
        return total, worded


def posterior(entropy: np.ndarray, temperature: float) -> np.ndarray:
    scaled = -(entropy - entropy.min(axis=1, keepdims=True)) / temperature
    e = np.exp(scaled)
    return e / e.sum(axis=1, keepdims=True)


def calibrate(learn: DataFrame, model: dict) -> dict:
    """Temperature of least log loss, and the rejection limit of each language.

    All labelled texts with a letter are scored. Each task sums up what it saw; the driver
    gets a count, two moments and a loss for each temperature of every language.
    """
    langs = model["langs"]
    model = model | {"temperature": 1.0, "limits": [math.inf] * len(langs)}
    if not langs:
        return model
    small_batches(learn.sparkSession)
    held = learn.sparkSession.sparkContext.broadcast(model)
    width = 3 + len(TEMPERATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        at = {lang: i for i, lang in enumerate(scorer.langs)}
        sums = np.zeros((len(at), width))
        for batch in batches:
            entropy, worded = scorer.entropies(batch.column(1).to_pylist())
            truth = np.array([at[x] for x in batch.column(0).to_pylist()], dtype=np.int64)[worded]
            entropy = entropy[worded]
            rows = np.arange(len(truth))
            own = entropy[rows, truth]
            seen = [np.ones(len(own)), own, own * own]
            seen += [-np.log(np.maximum(posterior(entropy, t)[rows, truth], 1e-9)) for t in TEMPERATURES] if len(own) else [own] * len(TEMPERATURES)
            np.add.at(sums, truth, np.array(seen).T)
        lang, what = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(what), pa.array(sums[lang, what])], names=["lang", "what", "v"])

    parts = learn.select("lang", "text").mapInArrow(run, "lang long, what long, v double")
    sums = np.zeros((len(langs), width))
    for r in parts.groupBy("lang", "what").agg(exact_sum(F.col("v")).alias("v")).collect():
        sums[r.lang, r.what] = r.v
    n = sums[:, 0]
    if not n.any():
        return model
    mean = sums[:, 1] / np.maximum(n, 1)
    deviation = np.sqrt(np.maximum(sums[:, 2] / np.maximum(n, 1) - mean * mean, 0.0))
    limits = np.where(n > 1, mean + DEVIATIONS * deviation, math.inf)
    best = sums[:, 3:].sum(axis=0).argmin()
    return model | {"temperature": float(TEMPERATURES[best]), "limits": limits.tolist()}


_OUT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy and rejected of every row.

    The language of lowest cross-entropy a character; ``score`` is its calibrated
    probability among the learned languages; ``rejected`` tells that even the best model
    fits worse than the limit of its language. Null text or one without a letter, and
    any text when nothing was learned: ``und``, score 0, rejected. No shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        langs, limits = scorer.langs, np.array(held.value["limits"] or [0.0])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = len(texts)
            if langs:
                entropy, worded = scorer.entropies(texts)
                best = entropy.argmin(axis=1)
                score = posterior(entropy, held.value["temperature"]).max(axis=1, initial=0.0) * worded
                least = entropy.min(axis=1, initial=np.inf)
            else:
                best, worded, score, least = np.zeros(n, dtype=int), np.zeros(n, dtype=bool), np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([langs[b] if w else "und" for b, w in zip(best, worded, strict=True)], pa.string()),
                pa.array(score, pa.float64()), pa.array(least, pa.float64(), mask=~worded),
                pa.array(~worded | (least > limits[best]))], names=["doc_id", *(f.name for f in _OUT)])

    return given.mapInArrow(run, T.StructType([given.schema["doc_id"], *_OUT]))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Learn from all rows not held out, and predict all: predict() and held_out."""
    small_batches(docs.sparkSession)
    learn = docs.where("text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    model = train(learn.select("lang", "text"))
    model = calibrate(learn, model)
    return predict(docs, model).withColumn("held_out", held_out())
