"""Exact global ranks and quantiles without a single-task sort.

A window without partition keys, or Spark's exact ``percentile``, brings every value to
one task. Here values are first counted, then split into buckets of similar width at
approximate quantiles. Only bucket totals (a few hundred rows) are accumulated in order;
positions inside a bucket are found in parallel. The cut points only balance the work:
any monotone split gives the same exact answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 128


def _bucket_of(value: Column, cuts: Column) -> Column:
    return F.size(F.filter(cuts, lambda c: c <= value))


def _cut_points(value: str, buckets: int) -> Column:
    fractions = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    return F.expr(
        f"array_distinct(percentile_approx(`{value}`, array({fractions}), {buckets * 20})) AS cuts"
    )


def quantile_cuts(
    df: DataFrame, metrics: dict[str, Column], probabilities: list[float], buckets: int = BUCKETS
) -> DataFrame:
    """Rows (metric, probability, value): linearly interpolated quantiles, NULLs skipped."""
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("metric"), col.cast("double").alias("value"))
            for name, col in metrics.items()
        ])
    )
    counts = (
        df.select(pairs.alias("p")).select("p.metric", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("metric", "value").agg(F.count("*").alias("copies"))
    )
    # `copies` is read here so that all three uses share one shuffle of `counts`
    cuts = counts.where(F.col("copies") > 0).groupBy("metric").agg(_cut_points("value", buckets))
    # one row per metric: a handful of names chosen by the caller
    placed = counts.join(F.broadcast(cuts), "metric").select(
        "metric", "value", "copies", _bucket_of(F.col("value"), F.col("cuts")).alias("bucket")
    )
    in_order = Window.partitionBy("metric").orderBy("bucket")
    whole = Window.partitionBy("metric")
    totals = placed.groupBy("metric", "bucket").agg(F.sum("copies").alias("rows")).select(
        "metric", "bucket", "rows",
        (F.sum("rows").over(in_order) - F.col("rows")).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    position = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    wanted = (
        totals.withColumn("probability", position)
        .withColumn("exact_rank", F.col("probability") * (F.col("n") - 1))
        .withColumn("rank", F.explode(F.array_distinct(F.array(
            F.floor("exact_rank"), F.ceil("exact_rank")))))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows")))
        .select("metric", "bucket", "probability", "exact_rank", "rank", "before")
    )
    inside = Window.partitionBy("metric", "bucket").orderBy("value")
    running = placed.withColumn("upto", F.sum("copies").over(inside)).withColumn(
        "from", F.col("upto") - F.col("copies")
    )
    # at most two rows per metric and probability
    hits = running.join(F.broadcast(wanted), ["metric", "bucket"]).where(
        (F.col("rank") - F.col("before") >= F.col("from"))
        & (F.col("rank") - F.col("before") < F.col("upto"))
    )
    share = F.col("exact_rank") - F.floor("exact_rank")
    return (
        hits.groupBy("metric", "probability")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.max(share).alias("share"))
        .select("metric", "probability",
                (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("value"))
    )


def approximate_cuts(
    df: DataFrame, metrics: dict[str, Column], probabilities: list[float], accuracy: int = 10_000
) -> DataFrame:
    """Sketch-based variant of :func:`quantile_cuts`: one pass, bounded error."""
    sketches = df.agg(
        *[F.percentile_approx(col.cast("double"), probabilities, accuracy).alias(name)
          for name, col in metrics.items()]
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.lit(float(p)).alias("probability"),
                 F.element_at(name, i).alias("value"))
        for name in metrics for i, p in enumerate(probabilities, 1)
    ]))
    return sketches.select(rows.alias("r")).select("r.*")


def global_position(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``position`` (0-based) in the order of ``key``, a unique numeric column."""
    cuts = df.agg(_cut_points(key, buckets))
    # one row holding at most `buckets` numbers
    placed = (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn("_bucket", _bucket_of(F.col(key), F.col("_cuts"))).drop("_cuts")
    )
    in_order = Window.orderBy("_bucket")  # at most `buckets` rows
    offsets = placed.groupBy("_bucket").agg(F.count("*").alias("_rows")).select(
        "_bucket", (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_before")
    )
    inside = Window.partitionBy("_bucket").orderBy(key)
    return (
        placed.withColumn("_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("position", F.col("_before") + F.col("_in"))
        .drop("_bucket", "_in", "_before")
    )


def batches(df: DataFrame, key: str, size: int = 100) -> DataFrame:
    """Consecutive batches of ``size`` rows in key order."""
    return (
        global_position(df, key)
        .withColumn("batch", F.floor(F.col("position") / size))
        .drop("position")
    )
