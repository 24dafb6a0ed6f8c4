"""Caps, order and split from stable hashes.

Nothing here sorts or ranks whole groups. A histogram over the top 16 bits of the hash
(at most 65,536 rows per group, combined before the shuffle) finds the bucket that holds
the k-th smallest hash; only the distinct keys of that bucket are ranked, each with the
number of its rows. Rows with one key are interchangeable. If the cut falls among them, they
alone are numbered, each task its own, so counts are exact whether or not keys are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.config import VALIDATION_SHARE
from corpusflow.functions.hashing import HASH_BITS, bucket, stable_hash
from corpusflow.sources.scratch import stage


def _hashed(df: DataFrame, key: str, seed: int, tag: str, by: tuple[str, ...]) -> DataFrame:
    h = stable_hash(F.col(key), seed, tag)
    return df.select(*by, h.alias("h"), F.col(key).cast("string").alias("k"), bucket(h).alias("b"))


def _edges(narrow: DataFrame, k: Column, by: tuple[str, ...]) -> DataFrame:
    """Per group: the bucket with the k-th smallest hash, and how many rows to take in it.

    `k` may use n, the size of the group. Groups with no more than k rows have no edge.
    """
    histogram = narrow.groupBy(*by, "b").agg(F.count("*").alias("c"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    running = F.sum("c").over(group.orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        histogram.select(*by, "b", "c", running.alias("seen"), F.sum("c").over(group).alias("n"))
        .withColumn("want", k)
        .filter((F.col("seen") >= F.col("want")) & (F.col("seen") - F.col("c") < F.col("want")))
        .filter(F.col("n") > F.col("want"))
        .select(*by, "b", (F.col("want") - F.col("seen") + F.col("c")).alias("take"))
    )


def _cut(inside: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Per group: the key at the cut, how many of its rows to take, and how many it has."""
    keys = inside.groupBy(*by, "h", "k", "take").agg(F.count("*").alias("rows"))
    ranked = (W.partitionBy(*by) if by else W.partitionBy(F.lit(0))).orderBy("h", "k")
    seen = F.sum("rows").over(ranked.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        keys.withColumn("seen", seen)
        .filter((F.col("seen") >= F.col("take")) & (F.col("seen") - F.col("rows") < F.col("take")))
        .select(
            *by, F.struct("h", "k").alias("cut"), (F.col("take") - F.col("seen") + F.col("rows")).alias("some"), "rows"
        )
    )


def _global_cut(narrow: DataFrame, k: Column) -> Row | None:
    """(cut, some, rows) of the k-th row in hash order; None if all rows fit."""
    edge = _edges(narrow, k, ()).first()
    if edge is None:
        return None
    inside = narrow.filter(F.col("b") == edge["b"]).withColumn("take", F.lit(edge["take"]))
    return _cut(inside, ()).first()


def _place(key: Column, seed: int, tag: str) -> Column:
    return F.struct(stable_hash(key, seed, tag).alias("h"), key.cast("string").alias("k"))


def _numbered(tied: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Add `__n`, the number of a row in its group from 1.

    The rows are written once with their place, so that it stays. They are numbered within the
    task that wrote them, after the rows of the tasks before: only a count per task is summed up.
    """
    rows = stage(tied.withColumn("__at", F.monotonically_increasing_id()), "tied")
    rows = rows.withColumn("__task", F.shiftright("__at", 33))
    counts = rows.groupBy(*by, "__task").agg(F.count("*").alias("__c"))
    tasks = (W.partitionBy(*by) if by else W.partitionBy(F.lit(0))).orderBy("__task")
    before = F.sum("__c").over(tasks.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__c")
    offsets = stage(counts.select(*by, "__task", before.alias("__before")), "tied-offsets")
    number = F.row_number().over(W.partitionBy(*by, "__task").orderBy("__at"))
    placed = rows.withColumn("__n", number).join(offsets, [*by, "__task"])
    return placed.withColumn("__n", F.col("__n") + F.col("__before")).drop("__at", "__task", "__before")


def _marked(df: DataFrame, key: Column, cut: Row | None, seed: int, tag: str, into: str) -> DataFrame:
    """Add whether a row is one of those up to the cut."""
    if cut is None:
        return df.withColumn(into, F.lit(True))
    place = _place(key, seed, tag)
    last = F.struct(F.lit(cut["cut"]["h"]).alias("h"), F.lit(cut["cut"]["k"]).alias("k"))
    if cut["some"] == cut["rows"]:
        return df.withColumn(into, F.coalesce(place <= last, F.lit(False)))
    tied = _numbered(df.filter(place == last)).withColumn(into, F.col("__n") <= cut["some"]).drop("__n")
    return df.filter(~F.coalesce(place == last, F.lit(False))).withColumn(into, F.coalesce(place < last, F.lit(False))).unionByName(tied)


def cap_by(df: DataFrame, key: Column, among: DataFrame, limit: int, seed: int) -> DataFrame:
    """The rows that a cap of `limit` on the keys `among` (one column) keeps.

    For rows that are costly to make: stage their keys, cap those, and make only the kept rows.
    """
    cut = _global_cut(_hashed(among, among.columns[0], seed, "cap", ()), F.lit(limit))
    return _marked(df, key, cut, seed, "cap", "__in").filter("__in").drop("__in")


def cap(df: DataFrame, key: str, limit: int, seed: int) -> DataFrame:
    """At most `limit` rows, chosen by hash; 0 means no cap."""
    return cap_by(df, F.col(key), df.select(key), limit, seed) if limit else df


def cap_per_group(df: DataFrame, by: str, key: str, limit: int, seed: int) -> DataFrame:
    """At most `limit` rows of each group, chosen by hash."""
    if not limit:
        return df
    return _capped(df, by, F.col(key), df.select(by, key), F.lit(limit), seed)


def cap_groups(df: DataFrame, by: str, key: Column, among: DataFrame, limits: dict[str, int], seed: int) -> DataFrame:
    """The rows that caps of the groups in `limits` on the keys `among` (group, key) keep. Other
    groups keep all. The caps of all groups come from one histogram."""
    pairs = [F.lit(x) for name, limit in limits.items() for x in (name, int(limit))]
    no_limit = F.lit((1 << 63) - 1)
    return _capped(df, by, key, among, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(by)), no_limit), seed)


def _capped(df: DataFrame, by: str, key: Column, among: DataFrame, limit: Column, seed: int) -> DataFrame:
    """Edges and cuts have one row per group. They are written to the shared folder, so Spark
    knows their size: below its threshold it broadcasts them and no row of `df` moves,
    above it adaptive execution splits a hot group over tasks.
    """
    narrow = _hashed(among, among.columns[1], seed, "cap", (by,))
    edges = stage(_edges(narrow, limit.cast("bigint"), (by,)), "edges")
    cuts = stage(_cut(narrow.join(edges, [by, "b"]), (by,)), "cuts")
    joined = df.join(cuts, by, "left")
    place, split = _place(key, seed, "cap"), F.col("some") < F.col("rows")
    at_cut = F.coalesce((place == F.col("cut")) & split, F.lit(False))
    kept = joined.filter((F.col("cut").isNull() | (place <= F.col("cut"))) & ~at_cut)
    if not cuts.filter("some < rows").isEmpty():
        tied = _numbered(joined.filter(at_cut), (by,)).filter(F.col("__n") <= F.col("some"))
        kept = kept.unionByName(tied.drop("__n"))
    return kept.drop("cut", "some", "rows")


def first_rows(df: DataFrame, limit: int, *order: str) -> DataFrame:
    """Prefix cap: the first `limit` rows by a row key, in place of arrival order."""
    return df.orderBy(*order).limit(limit) if limit else df


def holdout(df: DataFrame, key: str, seed: int, share: float = VALIDATION_SHARE) -> DataFrame:
    """Add `split`: exactly max(1, floor(share * n)) rows are 'val', the others 'train'."""
    size = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(share)))
    cut = _global_cut(_hashed(df, key, seed, "order", ()), size)
    marked = _marked(df, F.col(key), cut, seed, "order", "__in")
    return marked.withColumn("split", F.when(F.col("__in"), F.lit("val")).otherwise(F.lit("train"))).drop("__in")


def shuffled(df: DataFrame, key: str, seed: int, *first: str) -> DataFrame:
    """Seeded random order. The hash is uniform, so a row's partition follows from it directly:
    partitions are ranges of the hash, rows are sorted within them, and nothing is sampled.

    Columns in `first` sort before the hash within a partition. A writer that partitions by them
    then keeps the order inside each of its files, and from file to file.
    """
    place = _place(F.col(key), seed, "order")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The top 31 bits times the partitions fit a bigint.
    part = F.shiftright(F.shiftright(place["h"], HASH_BITS - 31) * parts, 31).cast("int")
    return df.repartitionById(parts, part).sortWithinPartitions(*first, place["h"], place["k"])


def with_position(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add `position`, the 0-based place of each row in the seeded order.

    Ranks run inside a hash bucket; bucket offsets come from the histogram, whose size is
    bounded by 2**16 rows, so it is safe to broadcast.
    """
    place = _place(F.col(key), seed, "order")
    rows = df.withColumn("__h", place["h"]).withColumn("__b", bucket(place["h"]))
    counts = rows.groupBy("__b").agg(F.count("*").alias("__c"))
    before = F.sum("__c").over(W.partitionBy(F.lit(0)).orderBy("__b")) - F.col("__c")
    offsets = counts.select("__b", before.alias("__before"))
    rank = F.row_number().over(W.partitionBy("__b").orderBy("__h", F.col(key).cast("string")))
    return (
        rows.join(F.broadcast(offsets), "__b")
        .withColumn("position", F.col("__before") + rank - 1)
        .drop("__h", "__b", "__before")
    )
