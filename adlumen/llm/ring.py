"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

VNODES = 64
#: Rows that one cell of the ring holds on average; a cell is ranked within one task.
CELL_ROWS = 50_000
_SIGN = 1 << 63


def ring(n_shards: int, vnodes: int = VNODES) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes in clockwise order, and the shard of each."""
    nodes = sorted(
        (xxhash.xxh64_intdigest(f"shard {s} node {v}") - _SIGN, s)
        for s in range(n_shards) for v in range(vnodes))
    return (np.array([p for p, _ in nodes], dtype=np.int64),
            np.array([s for _, s in nodes], dtype=np.int64))


def capacities(n_rows: int, n_shards: int, load: float) -> list[int]:
    """Rows each shard may hold. ``load`` 1: counts at most one apart; else ceil(load * mean)."""
    if load <= 1:
        return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]
    return [math.ceil(load * n_rows / n_shards)] * n_shards


def flows(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) for the rows of each arc.

    Works on row counts per arc only. In step d what is left of every arc asks the shard
    of the d-th virtual node clockwise; a full shard passes the rows on.
    """
    room, arcs, out = list(room), len(counts), []
    used, taken = [0] * len(room), [0] * arcs
    waiting, step = [a for a in range(arcs) if counts[a]], 0
    while waiting:
        if step >= arcs:
            raise ValueError("the shards cannot hold all rows")
        rest = []
        for arc in waiting:
            shard = owners[(arc + step) % arcs]
            n = min(counts[arc] - taken[arc], room[shard] - used[shard])
            if n > 0:
                out.append((arc, taken[arc], taken[arc] + n, shard, used[shard]))
                taken[arc] += n
                used[shard] += n
            if taken[arc] < counts[arc]:
                rest.append(arc)
        waiting, step = rest, step + 1
    return out


_FLOW = T.StructType([T.StructField("arc", T.IntegerType()), *(
    T.StructField(n, T.LongType()) for n in ("first", "end", "shard", "slot0"))])


def assign(docs: DataFrame, n_shards: int, vnodes: int = VNODES, load: float = 1.0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and gapless slot of every row: doc_id, size, text_crc32, shard, slot.

    A row's id gives its place on the ring, the next virtual node clockwise its shard. A
    shard takes rows up to its bound; the rest continues clockwise. Which rows stay is
    decided by the ring alone: rows of an arc are ranked by hash, id and text, and only
    counts per arc (``n_shards * vnodes`` numbers) reach the driver.

    Null text: size 8, checksum 0. Null ids share one place. Equal rows are
    interchangeable and take different slots. No rows: no output. Other columns of
    ``docs`` are ignored.
    """
    if n_shards < 1 or vnodes < 1:
        raise ValueError("at least one shard and one node")
    spark = docs.sparkSession
    places, owners = ring(n_shards, vnodes)

    @F.pandas_udf("int")
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(places, at.to_numpy()) % len(places)).astype("int32"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.col(id_col)).alias("at"))
    n_rows = rows.count()
    bits = max(1, math.ceil(math.log2(max(2, n_rows / CELL_ROWS))))
    rows = rows.withColumn("arc", arc_of("at")).withColumn("part", F.shiftright("at", 64 - bits))

    cells = rows.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    cells = cells.select("arc", "part", before.alias("before"), "n")
    counts = [0] * len(places)
    for arc, n in cells.groupBy("arc").agg(F.sum("n")).collect():
        counts[arc] = n
    table = flows(counts, owners.tolist(), capacities(n_rows, n_shards, load))
    flow = F.broadcast(spark.createDataFrame(table, _FLOW))  # at most nodes x shards rows

    ranked = rows.withColumn("in_cell", F.row_number().over(
        Window.partitionBy("arc", "part").orderBy("at", "doc_id", "text_crc32", "size")) - 1)
    ranked = (ranked.join(cells.select("arc", "part", "before"), ["arc", "part"])
              .withColumn("rank", F.col("before") + F.col("in_cell")))
    return (ranked.join(flow, "arc").where("rank >= first AND rank < end")
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot")))
