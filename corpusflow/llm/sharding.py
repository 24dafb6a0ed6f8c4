"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Rows arrive in the order of a hash of their key. A row goes to the first shard clockwise of its
place on the ring that is not yet full, so a full shard's overflow continues clockwise and no load
passes its bound. All that this needs is the moment at which each shard becomes full, and these
moments come from histograms: rows per arc of the ring and range of the arrival order. A range in
which some shard fills up is looked at again with finer ranges, down to a bounded number of rows.
After that every row is placed by itself.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.sources.scratch import stage

RING_BITS = 31
ORDER_BITS = 62
LEVEL_BITS = 8
#: A range of the arrival order with no more rows than this is read row by row.
MOST_ROWS = 20_000
ROWS_PER_SLOT_BUCKET = 4096


@dataclass(frozen=True)
class Ring:
    """Virtual nodes in the order of their places."""

    places: np.ndarray
    shards: np.ndarray

    @staticmethod
    def of(shards: int, virtual_nodes: int) -> Ring:
        def place(node: str) -> int:
            return int.from_bytes(hashlib.sha256(node.encode()).digest()[:8], "big") >> (64 - RING_BITS)

        nodes = sorted((place(f"shard {s} node {v}"), s) for s in range(shards) for v in range(virtual_nodes))
        places, owners = zip(*nodes)
        return Ring(np.array(places, np.int64), np.array(owners, np.int64))

    def arcs(self, places: np.ndarray) -> np.ndarray:
        """Number of the first virtual node clockwise."""
        return np.searchsorted(self.places, places) % len(self.places)

    def owners(self, full: np.ndarray) -> np.ndarray:
        """The shard that takes each arc's rows: the first one clockwise that isn't full."""
        free = np.flatnonzero(~full[self.shards])
        if not len(free):
            raise ValueError("the bounds are smaller than the rows")
        after = np.searchsorted(free, np.arange(len(self.shards)))
        return self.shards[free[after % len(free)]]


def bounds_of(total: int, shards: int, slack: float) -> np.ndarray:
    """Bound of each shard. Without slack they sum to the total and differ by one at most."""
    if slack > 0:
        return np.full(shards, int(np.ceil((1 + slack) * total / shards)), np.int64)
    return np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)


class Filling:
    """Finds the moment, as (order, row), after which each shard takes no more rows."""

    LAST = (1 << ORDER_BITS) - 1, (1 << 63) - 1

    def __init__(self, rows: DataFrame, ring: Ring, bounds: np.ndarray):
        self.rows, self.ring, self.bounds = rows, ring, bounds
        self.loads = np.zeros(len(bounds), np.int64)
        self.full = bounds <= 0
        self.until = [(-1, -1) if f else self.LAST for f in self.full]

    def take(self, counts: np.ndarray, end: tuple[int, int]) -> bool:
        """Add rows per arc that arrive up to `end`; False if one of them may be an overflow."""
        if self.full.all():
            return not counts.any()
        loads = self.loads + np.bincount(self.ring.owners(self.full), counts, len(self.loads)).astype(np.int64)
        if ((loads > self.bounds) & ~self.full).any():
            return False
        self.loads = loads
        for s in np.flatnonzero((loads >= self.bounds) & ~self.full):
            self.full[s], self.until[s] = True, end
        return True

    def run(self, low: int = 0, bits: int = ORDER_BITS, column: str = "o", fixed: int | None = None) -> None:
        """Take the rows with low <= column < low + 2 ** bits, in order."""
        rows = self.rows.filter((F.col(column) >= low) & (F.col(column) <= low + (1 << bits) - 1))
        if fixed is not None:
            rows = rows.filter(F.col("o") == fixed)
        shift = max(0, bits - LEVEL_BITS)
        part = F.shiftright(F.col(column) - low, shift)
        table = rows.groupBy(part.alias("part"), "arc").agg(F.sum("w").alias("w"), F.count("*").alias("n")).toArrow()
        part, arc, weight, number = (table[c].to_numpy() for c in ("part", "arc", "w", "n"))
        for p in np.unique(part).tolist():
            here = part == p
            start = low + (p << shift)
            last = start + (1 << shift) - 1
            end = (last, self.LAST[1]) if column == "o" else (fixed, last)
            if self.take(np.bincount(arc[here], weight[here], len(self.ring.shards)), end):
                continue
            if number[here].sum() <= MOST_ROWS:
                self.one_by_one(rows.filter(F.col(column).between(start, last)))
            elif shift:
                self.run(start, shift, column, fixed)
            else:  # many rows at one moment: rows alike in all columns, so their row numbers decide
                self.run(0, 63, "row", start)

    def one_by_one(self, rows: DataFrame) -> None:
        table = rows.select("o", "row", "arc", "w").toArrow().to_pandas().sort_values(["o", "row"])
        owners = self.ring.owners(self.full) if not self.full.all() else None
        for moment, row, arc, weight in table.itertuples(index=False):
            if owners is None:
                raise ValueError("the bounds are smaller than the rows")
            s = owners[arc]
            self.loads[s] += weight
            if self.loads[s] >= self.bounds[s]:
                self.full[s], self.until[s] = True, (moment, row)
                owners = self.ring.owners(self.full) if not self.full.all() else None


def assign(
    df: DataFrame,
    shards: int,
    place: list[Column],
    order: list[Column],
    weight: Column | None = None,
    slack: float = 0.0,
    virtual_nodes: int = 64,
) -> DataFrame:
    """Add shard (int) and slot (bigint, gapless from 0 within the shard).

    `place`: what decides a row's place on the ring; `order`: what decides when it arrives. Both
    are hashed, nulls included. Rows alike in `order` arrive one after another and are
    interchangeable. `weight` (default: 1 a row) counts against the bound, which is (1 + slack)
    shares; without slack, all shards differ by one row at most. A shard takes rows until it
    reaches its bound, so with weights it may pass it by one row's weight. Pass narrow rows: they
    are written once, and texts can be joined afterwards. Columns called shard or slot are replaced.
    An empty table gives no rows.
    """
    if {"shard", "slot"} & set(df.columns):
        df = df.drop("shard", "slot")
    kept = df.columns
    ring = Ring.of(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(places: pd.Series) -> pd.Series:
        return pd.Series(ring.arcs(places.to_numpy()).astype(np.int32))

    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept"),
        arc_of(F.shiftright(F.xxhash64(*place, F.lit("place")), 64 - RING_BITS) + F.lit(1 << (RING_BITS - 1))).alias("arc"),
        F.pmod(F.xxhash64(*order, F.lit("order")), F.lit(1 << ORDER_BITS)).alias("o"),
        (F.lit(1) if weight is None else weight).cast("bigint").alias("w"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "ring-rows")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    filling = Filling(rows, ring, bounds_of(total, shards, slack))
    filling.run()
    until_order = np.array([o for o, _ in filling.until], np.int64)
    until_row = np.array([r for _, r in filling.until], np.int64)

    @F.pandas_udf("int")
    def shard_of(arc: pd.Series, order: pd.Series, row: pd.Series) -> pd.Series:
        at, order, row = arc.to_numpy().astype(np.int64), order.to_numpy(), row.to_numpy()
        shard = ring.shards[at]
        while True:
            o, r = until_order[shard], until_row[shard]
            late = (order > o) | ((order == o) & (row > r))
            if not late.any():
                return pd.Series(shard.astype(np.int32))
            at[late] = (at[late] + 1) % len(ring.shards)
            shard[late] = ring.shards[at[late]]

    placed = rows.select("kept", "o", "row", shard_of("arc", "o", "row").alias("shard"))
    return with_slots(placed, "o", count).select("kept.*", "shard", "slot")


def with_slots(placed: DataFrame, order: str, count: int) -> DataFrame:
    """Number the rows of each shard in their order.

    Rows are numbered within a shard's range of the order and the task that wrote them, so neither
    a whole shard nor many rows alike in `order` meet in one window. In a range with several
    tasks' rows at one moment those of the first task come first.
    """
    buckets = max(6, int(np.ceil(np.log2(max(1, count // ROWS_PER_SLOT_BUCKET)))))
    placed = placed.withColumn("bucket", F.shiftright(order, ORDER_BITS - min(buckets, 40)))
    # A range holds about ROWS_PER_SLOT_BUCKET rows, unless many are alike; those are cut by task.
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("rows")).filter(F.col("rows") > MOST_ROWS)
    crowded = stage(crowded.select("bucket", F.lit(True).alias("crowded")), "crowded-ranges")
    placed = placed.join(crowded, "bucket", "left")
    task = F.when(F.col("crowded"), F.shiftright("row", 33)).otherwise(F.lit(0)).alias("task")
    moment = F.when(F.col("crowded"), F.col(order)).otherwise(F.lit(0)).alias("moment")
    placed = placed.select("*", moment, task)
    group = ["shard", "bucket", "moment", "task"]
    sizes = placed.groupBy(*group).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket", "moment", "task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*group).orderBy(order, "row")
    return (
        placed.withColumn("number", F.row_number().over(within))
        .join(offsets, group)
        .withColumn("slot", F.col("before") + F.col("number") - 1)
    )
