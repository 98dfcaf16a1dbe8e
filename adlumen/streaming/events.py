"""Structured Streaming jobs over ad events.

Each has a batch twin that gives the same rows; late data beyond the watermark delay is
dropped and shows up in the query progress as rows dropped by watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from adlumen.functions import storage as st
from adlumen.operators.aggregate import metric_aggregates, metric_sums
from adlumen.schemas import METRICS
from adlumen.sinks.tables import EVENT_LAYOUT


def read_stream(spark: SparkSession, folder: str, schema: StructType, **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def deduplicate(events: DataFrame, delay: str, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Copies of a key arriving within the delay are dropped; state is kept only that long."""
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def sliding_counts(
    events: DataFrame, keys: list[str], delay: str, length: str = "24 hours", slide: str = "1 hour"
) -> DataFrame:
    """Metrics per key over a sliding window, emitted once the watermark passes its end.

    A sliding window copies its input once per overlapping window. Events are therefore
    counted per slide first; only those counts are copied into the long windows.
    """
    slides = (
        events.withWatermark("timestamp", delay)
        .groupBy(*keys, F.window("timestamp", slide).alias("slide"))
        .agg(*metric_aggregates())
    )
    return (
        slides.groupBy(*keys, F.window("slide", length, slide).alias("window"))
        .agg(*metric_sums())
        .select(*keys, F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), *METRICS)
    )


class LateRows(StreamingQueryListener):
    """Counts rows dropped for coming after the watermark, over all batches of all queries.

    Register with ``spark.streams.addListener`` before the query starts. A query's own
    progress reports cover its latest batches only.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.rows[str(event.progress.id)] = self.rows.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped in the batches that the query still reports; see :class:`LateRows` for all."""
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )


def to_partitioned_events(
    events: DataFrame, layout: list[str] = EVENT_LAYOUT, files_per_partition: int = 1
) -> DataFrame:
    """Adds the partition columns and gathers each partition's rows of a micro-batch.

    Without the shuffle every task would open a file in every partition. A stream with
    one dominant partition raises ``files_per_partition`` to spread it over tasks.
    """
    salt = F.pmod(F.xxhash64("event_id"), F.lit(files_per_partition))
    levels = events.withColumns(st.partition_columns(F.col("timestamp")))
    return levels.repartition(*layout, salt)


def write_stream(
    df: DataFrame, root: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Process what is available now, then stop; restart continues from the checkpoint."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", root).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def ingest(events: DataFrame, root: str, checkpoint: str, files_per_partition: int = 8) -> StreamingQuery:
    """Rows of one hour and type, often all of a batch, go to several tasks."""
    spread = to_partitioned_events(events, files_per_partition=files_per_partition)
    return write_stream(spread, root, checkpoint, EVENT_LAYOUT)
