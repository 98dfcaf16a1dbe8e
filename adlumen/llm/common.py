"""Shared pieces of the training-data operators."""

from __future__ import annotations

import re
import sys
import types

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.session import shared_dir

#: Rows and bytes of one Arrow batch, so that long texts do not fill a worker.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20

#: Words as maximal runs of anything but ASCII white space (Java regular expression).
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once below the shared folder and read back: cuts lineage, survives lost executors.

    Shuffle files of a written step are of no more use, and go when it ends; otherwise the
    steps of one operator would pile up on local disks until the driver collects garbage.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(id_col: str = "doc_id", text_col: str = "text"):
    """Hash that tells apart rows which share an id but not a text."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def numbered(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a long ``name`` that equal texts share and different texts never do; null is as empty.

    That is a hash of the text, made zero or more. Texts that a hash does not tell apart, but
    their SHA-256 does, have negative numbers instead, all but one of them.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own, digest = F.xxhash64(text).bitwiseAND((1 << 63) - 1), F.unhex(F.sha2(text, 256))
    texts = docs.select(own.alias("own"), digest.alias("digest"))
    shared = stored(texts.groupBy("own").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
                    .where("least < most"), "shared-hashes")
    if shared.isEmpty():
        return docs.withColumn(name, own)
    moved = stored(texts.join(shared, "own").where("digest > least").select("own", "digest").distinct()
                   .withColumn("number", -1 - F.monotonically_increasing_id()), "moved-texts")
    a, b, c = (fresh(n, [*docs.columns, name]) for n in ("own_key", "digest_key", "number_key"))
    return (docs.withColumns({a: own, b: digest}).join(moved.toDF(a, b, c), [a, b], "left")
            .withColumn(name, F.coalesce(c, a)).drop(a, b, c))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no given column has (names are compared without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def sql_text(pattern: str) -> str:
    """A pattern as the inside of a Spark SQL string literal."""
    return re.sub(r"(['\\])", r"\\\1", pattern)


def once(key, make):
    """What ``make`` returns, made once in each Python worker (workers serve many tasks)."""
    kept = sys.modules.setdefault("_adlumen_worker", types.ModuleType("_adlumen_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
