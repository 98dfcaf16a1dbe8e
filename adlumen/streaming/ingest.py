"""Judged ingest of a stream: each micro-batch is stored exactly once, and no row is lost.

Every landed row ends as stored, quarantined (with its errors), late (behind the watermark,
kept beside the quarantined ones) or duplicate (counted). What a batch did is one row of a
ledger. All tables have a folder for each query and batch, which a replay of the batch
replaces; and a batch is judged by the ledger rows of earlier batches only, so a replay
judges as the first attempt did.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from adlumen.operators.windows import first_per_key
from adlumen.plans import ingest
from adlumen.sinks.tables import exists

LATE = "late"
_BATCH = (("query", T.StringType()), ("batch", T.LongType()))
_LEDGER = ("query string, batch long, landed long, stored long, quarantined long, late long, duplicates long, "
           "max_micros long, watermark_micros long")


def _with(schema: T.StructType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in more]])


@dataclass(frozen=True)
class JudgedIngest:
    """Where a stream's batches go, and how they are judged.

    ``delay_seconds`` is how far behind the newest valid event of earlier batches a row may
    be. Only valid rows move that watermark: a broken clock that is refused cannot make the
    rows behind it late. ``keys`` tell copies of a row.
    """

    root: str
    query: str
    delay_seconds: int
    kind: ingest.Kind = ingest.AD_EVENTS
    keys: tuple[str, ...] = ("event_id",)

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/query={self.query}/batch={batch}"

    def _replace(self, rows: DataFrame, table: str, batch: int) -> str:
        folder = self._folder(table, batch)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
        return folder

    def ledger(self, spark: SparkSession) -> DataFrame:
        """A row for each finished batch."""
        if not exists(spark, f"{self.root}/ledger"):
            return spark.createDataFrame([], _LEDGER)
        return spark.read.schema(_LEDGER).parquet(f"{self.root}/ledger").where(F.col("query") == self.query)

    def stored(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Stored rows of finished batches, with query and batch."""
        return self._finished(spark, "stored", schema)

    def refused(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Quarantined and late rows with ``errors`` and ``outcome``."""
        return self._finished(spark, "refused", _with(schema, ("errors", T.ArrayType(T.StringType())), ("outcome", T.StringType())))

    def _finished(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        whole = _with(schema, *_BATCH)
        if not exists(spark, f"{self.root}/{table}"):
            return spark.createDataFrame([], whole)
        rows = spark.read.schema(whole).parquet(f"{self.root}/{table}").where(F.col("query") == self.query)
        return rows.join(self.ledger(spark).select("batch"), "batch", "left_semi").select(whole.fieldNames())

    def process(self, landed: DataFrame, batch: int) -> None:
        """Judge and store one micro-batch; the same batch again gives the same tables."""
        spark, time = landed.sparkSession, self.kind.time
        before = self.ledger(spark).where(F.col("batch") < batch)
        newest = before.agg(F.max("max_micros")).head()[0]
        watermark = None if newest is None else newest - self.delay_seconds * 1_000_000
        micros = F.unix_micros(time)
        judged = ingest.judged(landed, self.kind).select(*landed.columns, "errors", "outcome")
        valid = F.col("outcome") == ingest.STORED
        if watermark is not None:
            judged = judged.withColumn("outcome", F.when(valid & (micros < watermark), LATE).otherwise(F.col("outcome")))
        # counted while it is written: the batch is read and judged once
        seen = Observation()
        judged_root = self._replace(judged.observe(
            seen, F.count(F.lit(1)).alias("landed"),
            F.count_if(F.col("outcome") == ingest.QUARANTINED).alias("quarantined"), F.count_if(F.col("outcome") == LATE).alias("late"),
            F.max(F.when(valid, micros)).alias("max_micros")), "judged", batch)
        rows = spark.read.schema(judged.schema).parquet(judged_root)
        self._replace(rows.where(~valid), "refused", batch)

        ties = [F.col(time), F.xxhash64(*[c for c in landed.columns if c not in self.keys])]
        kept = first_per_key(rows.where(valid).drop("errors", "outcome"), list(self.keys), ties)
        if watermark is not None:
            kept = kept.join(self._recent(spark, landed.schema, before, watermark), list(self.keys), "left_anti")
        stored = Observation()
        self._replace(kept.select(*landed.columns).observe(stored, F.count(F.lit(1)).alias("stored")), "stored", batch)
        # the newest event so far is carried on, so that one ledger row tells the watermark
        counts = seen.get | stored.get
        highest = max((x for x in (newest, counts["max_micros"]) if x is not None), default=None)
        on_time = counts["landed"] - counts["quarantined"] - counts["late"]
        entry = (counts["landed"], counts["stored"], counts["quarantined"], counts["late"], on_time - counts["stored"], highest, watermark)
        self._replace(spark.createDataFrame([entry], _LEDGER.split("batch long, ")[1]).coalesce(1), "ledger", batch)

    def _recent(self, spark: SparkSession, schema: T.StructType, before: DataFrame, watermark: int) -> DataFrame:
        """Keys stored by earlier batches, as far back as a copy of a row on time may lie."""
        since = watermark - self.delay_seconds * 1_000_000
        batches = [r.batch for r in before.where(F.col("max_micros") >= since).select("batch").collect()]
        rows = spark.read.schema(_with(schema, *_BATCH)).parquet(f"{self.root}/stored")
        recent = rows.where((F.col("query") == self.query) & F.col("batch").isin(batches))
        return recent.where(F.unix_micros(self.kind.time) >= since).select(*self.keys).distinct()

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process what is available now, then stop; a restart continues from the checkpoint."""
        return (stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
