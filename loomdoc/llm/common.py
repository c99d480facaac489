"""Helpers shared by the operators: reading tables, shared storage, clean-up of shuffles, components of a graph."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.storage import cut, shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark alone so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def conf(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the actions inside the block; dots are written as two underscores."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Keys that attach() sends to every task at most, and rows below which a key is never one of them.
HEAVIEST, FEW = 1000, 1 << 14


def attach(rows: DataFrame, table: DataFrame, on: str, held: str) -> DataFrame:
    """rows joined with table, which has one row for each value of on and says in held how many of rows have it.

    held is left out. Keys held by more than a thousandth of rows, a thousand at most, go to every task, so that none
    of them gathers its rows in one; the others meet by a shuffle.
    """
    total = table.agg(F.sum(held)).first()[0] or 0
    least = max(FEW, total // HEAVIEST)
    heavy = table.filter(F.col(held) > least).drop(held)
    if total <= least or heavy.isEmpty():
        return rows.join(table.drop(held), on)
    light = table.filter(F.col(held) <= least).drop(held)
    few = rows.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on)
    return rows.join(F.broadcast(heavy), on).unionByName(few)


#: Edges of a graph in a partition between rounds.
EDGES = 1 << 18


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

    edges: pairs of longs, any order, repeats and loops allowed. Returns (node, component) for every node that
    has an edge to another node; component is the smallest node reachable. Every step is a map-side combined
    minimum and a join, so a hub's edges are summed before they move and adaptive execution can split them. It ends
    when all edges make stars, each around its smallest node, with no round more to confirm it. Edges are kept in
    as many partitions as their number asks for. Nothing but two counts per round reaches the driver.
    """
    e = edges.select(F.least(u, v).alias("lo"), F.greatest(u, v).alias("hi")).filter("lo < hi").distinct()
    e = cut(e)
    for _ in range(max_rounds):
        # of stars, no upper end has two edges or is a lower end as well
        ends = e.select(F.col("hi").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("lo", F.lit(0), F.lit(1)))
        n, open_ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).agg(F.sum("up"), F.count(F.expr("case when up > 1 or up > 0 and down > 0 then 1 end"))).first()
        if not open_ends:
            break
        # large star: every neighbour above a node goes to the smallest node around it
        both = e.select(F.col("lo").alias("a"), F.col("hi").alias("b")).union(e.select(F.col("hi").alias("a"), F.col("lo").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("lo"), F.col("b").alias("hi")).filter("lo < hi").distinct()
        # small star: every neighbour below a node, and the node, go to the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")), F.struct(F.col("m").alias("lo"), F.col("hi").alias("hi")))).alias("p")).select("p.lo", "p.hi").filter("lo < hi").distinct()
        # two edges at most come of each
        e = cut(small.coalesce(blocks_for(2 * n, EDGES)))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.union(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def trim() -> None:
    """Give freed memory back to the system: Arrow's pool and the C library else keep a worker at its largest for good."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator, rows: int = 2048) -> Iterator:
    """The same rows in Arrow batches of at most rows, so that a worker's Python objects stay few; memory is trimmed at the end."""
    try:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield b.slice(at, rows)
    finally:
        trim()


def free_name(names: list[str], stem: str) -> str:
    """A column name that clashes with none of names, whatever their case."""
    taken = {n.lower() for n in names}
    return next(f"{stem}{i}" for i in range(len(taken) + 1) if f"{stem}{i}" not in taken)


def blocks_for(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))
