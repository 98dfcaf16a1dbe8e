"""Streaming queries: each runs over everything available and is read back as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlumen.queries.common import AD, ALL_AD, COUNTS, query, rounded
from adlumen.queries.reports import attribution_sql
from adlumen.session import shared_dir
from adlumen.sources import eventlog as log
from adlumen.streaming import attribution, events as streaming
from adlumen.streaming.ingest import JudgedIngest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _stream(spark, folder, known_types=False):
    schema = log.table(spark, folder, "events").schema
    rows = streaming.read_stream(spark, folder, schema, pathGlobFilter="events.parquet")
    return log.ad_columns(rows.where(F.col("event_type").isin(*log.LOG_EVENT_TYPES)) if known_types else rows)


def _run(spark, stream, purpose, partition_by=None):
    root = shared_dir(spark, purpose)
    streaming.write_stream(stream, f"{root}/table", f"{root}/checkpoint", partition_by).awaitTermination()
    return spark.read.parquet(f"{root}/table")


@query(QUERIES)
def stream_ingest(spark, folder):
    """Stream → table partitioned by day and type; rows per partition."""
    levels = ["year", "month", "day", "event_type"]
    stream = streaming.to_partitioned_events(_stream(spark, folder), levels)
    written = _run(spark, stream, "ingest", levels)
    return written.groupBy(*levels).agg(F.count("*").alias("rows"))


SQL["stream_ingest"] = f"""WITH {ALL_AD}
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  event_type, count(*) AS rows FROM ad GROUP BY ALL"""


@query(QUERIES)
def stream_dedup(spark, folder):
    """Every 50th event sent twice; copies are dropped in the stream."""
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    stream = _stream(spark, folder).withColumn("copy", F.explode(copies)).drop("copy")
    kept = _run(spark, streaming.deduplicate(stream, "1 hour"), "dedup")
    return rounded(kept.select("event_id", "event_type", "ad_id", "revenue", "cost"))


SQL["stream_dedup"] = f"""WITH {ALL_AD}
SELECT event_id, event_type, ad_id, round(revenue, 6) AS revenue, round(cost, 6) AS cost FROM ad"""


@query(QUERIES)
def stream_window_counts(spark, folder):
    """24-hour windows every hour per advertiser, as far as the watermark has closed them."""
    counts = streaming.sliding_counts(_stream(spark, folder, known_types=True), ["advertiser_id"], "2 hours")
    out = _run(spark, counts, "windows")
    return rounded(out.withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("window_start", "window_end")}))


SQL["stream_window_counts"] = f"""WITH {AD},
w AS (SELECT advertiser_id, date_trunc('hour', ts) - to_hours(CAST(i AS BIGINT)) AS s, event_type, cost, revenue
  FROM ad, (SELECT unnest(range(24)) AS i)),
c AS (SELECT advertiser_id, s, {COUNTS} FROM w GROUP BY ALL)
SELECT advertiser_id, strftime(s, '%Y-%m-%d %H:%M') AS window_start,
  strftime(s + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M') AS window_end, impressions, clicks, conversions, views,
  round(spend, 6) AS spend, round(revenue, 6) AS revenue
FROM c WHERE s + INTERVAL 24 HOUR <= (SELECT max(ts) FROM ad) - INTERVAL 2 HOUR"""


_PIECES, _DELAY = 4, 3600


def _landings(spark, folder):
    """The log in pieces of about a week; some rows come a piece later, some twice."""
    piece = F.least(F.lit(_PIECES - 1), F.expr("(day(timestamp) - 1) div 8"))
    own = F.least(F.lit(_PIECES - 1), piece + F.when(F.col("event_id") % 20 == 0, 1).otherwise(0))
    next_ = F.least(F.lit(_PIECES - 1), piece + 1)
    pieces = F.when(F.col("event_id") % 50 == 1, F.array(own, own)).when(F.col("event_id") % 50 == 2, F.array(own, next_)).otherwise(F.array(own))
    return log.all_events(spark, folder).withColumn("piece", F.explode(pieces))


@query(QUERIES)
def stream_late_rows(spark, folder):
    """A stream in four batches with late rows and copies: landed = stored + quarantined + late + duplicates."""
    root = shared_dir(spark, "late-rows")
    landed = _landings(spark, folder)
    rows = landed.drop("piece")
    sink = JudgedIngest(f"{root}/table", "log", _DELAY)
    for piece in range(_PIECES):
        landed.where(F.col("piece") == piece).drop("piece").write.mode("append").parquet(f"{root}/landing")
        sink.start(streaming.read_stream(spark, f"{root}/landing", rows.schema), f"{root}/checkpoint").awaitTermination()
    refused = sink.refused(spark, rows.schema)
    ends = sink.stored(spark, rows.schema).select("batch", F.lit("stored").alias("outcome"), "event_id").union(
        refused.select("batch", "outcome", "event_id"))
    counted = sink.ledger(spark).selectExpr("batch", "stack(2, 'landed', landed, 'duplicate', duplicates) AS (outcome, rows)")
    return ends.groupBy("batch", "outcome").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids")).unionByName(
        counted.where("rows > 0").withColumn("ids", F.lit(None).cast("long")))


SQL["stream_late_rows"] = f"""WITH {ALL_AD},
p AS (SELECT *, least({_PIECES - 1}, (day(ts) - 1) // 8) AS piece, event_type NOT IN ('impression', 'click', 'conversion', 'engagement')
  OR coalesce(user_id % 5 = 4, false) AS bad FROM ad),
o AS (SELECT *, CAST(least({_PIECES - 1}, piece + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS batch FROM p),
l AS (SELECT event_id, ts, bad, batch FROM o UNION ALL SELECT event_id, ts, bad, batch FROM o WHERE event_id % 50 = 1
  UNION ALL SELECT event_id, ts, bad, CAST(least({_PIECES - 1}, piece + 1) AS BIGINT) FROM o WHERE event_id % 50 = 2),
w AS (SELECT b.batch, max(l.ts) - INTERVAL {_DELAY} SECOND AS mark FROM (SELECT DISTINCT batch FROM l) b JOIN l ON l.batch < b.batch AND NOT bad GROUP BY b.batch),
j AS (SELECT event_id, ts, batch, CASE WHEN bad THEN 'quarantined' WHEN ts < mark THEN 'late' ELSE 'stored' END AS judged FROM l LEFT JOIN w USING (batch)),
r AS (SELECT *, CASE WHEN judged = 'stored' AND row_number() OVER (PARTITION BY event_id, judged ORDER BY batch) > 1 THEN 'duplicate' ELSE judged END AS outcome FROM j)
SELECT batch, outcome, count(*) AS rows, CAST(sum(event_id) FILTER (outcome <> 'duplicate') AS BIGINT) AS ids FROM r GROUP BY batch, outcome
UNION ALL SELECT batch, 'landed', count(*), NULL FROM l GROUP BY batch"""


_END = "timestamp'2100-01-01'"
_OWN_DAYS = "if(event_id % 31 = 0, NULL, cast(event_id % 31 AS int))"


@query(QUERIES)
def stream_attribution(spark, folder):
    """Touches and conversions as two streams, joined within each conversion's own window of 1 to 30 days.

    A last row far in the future lets the watermark pass every conversion of the log.
    """
    root, keys = shared_dir(spark, "stream-attribution"), ["user_id", "ad_id"]
    events = log.ad_events(spark, folder).select("event_id", "event_type", "timestamp", "user_id", "ad_id", "revenue")
    events = events.withColumn(attribution.OWN_WINDOW, F.expr(_OWN_DAYS))
    end = spark.range(1).selectExpr("-1L AS event_id", "explode(array('impression', 'conversion')) AS event_type", f"{_END} AS timestamp",
                                    "-1L AS user_id", "-1L AS ad_id", "0.0D AS revenue", "1 AS attribution_window_days")
    for rows in (events, end):
        rows.select(*events.columns).write.mode("append").parquet(f"{root}/landing")
        stream = streaming.read_stream(spark, f"{root}/landing", events.schema)
        found = attribution.attribute(stream, stream.where("event_type = 'conversion'"), keys, "1 hour", 30)
        streaming.write_stream(found, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{root}/table").where("conversion_id <> -1")
    return rounded(out.select(
        "conversion_id", *keys,
        *[F.coalesce(F.unix_micros(c), F.lit(-1)).alias(c) for c in ("conversion_ts", "click_ts", "impression_ts")],
        F.coalesce("credited_ad_id", F.lit(-1)).alias("credited_ad_id"), "is_view_through", "revenue"))


SQL["stream_attribution"] = attribution_sql(["user_id", "ad_id"], "CASE WHEN v.event_id % 31 = 0 THEN 7 ELSE v.event_id % 31 END")
