"""Exact top-k inner products by no-random-access aggregation over sorted lists (Fagin, Lotem, Naor, 2001).

Every block of rows keeps one list for each dimension, sorted by component. A query reads its lists from the end where
query times component is largest, a step of entries at a time, and keeps for every row the sum of what was read, with
the lists' worst values for the rest (a lower bound) or their current values (an upper bound). Rows whose upper bound is
below the k-th lower bound are out, ties are not. Reading stops when no more than k rows are in, as outsiders then cannot
qualify, or at the lists' ends, where the bounds meet; what is left gets its final scores.

A block's lists are made once. Queries come to it as a stream, after its rows in the sorted partition, so a task holds one
block and a batch of queries, whatever their number. A first round asks one block for each query; its k-th best score
there is a bound that the other blocks' rows have to reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdoc.llm.common import blocks_for, cut

#: Rows of a block.
ROWS = 4096
#: Shares of the lists' lengths after which bounds are looked at.
DEPTHS = (1 / 4, 3 / 4, 15 / 16, 1.0)
#: Beyond this, sums of products are no longer exact in double precision.
EXACT = float(1 << 53)


class Lists:
    """A block of rows: for each dimension its components in descending order, their rows, and each row's place there."""

    def __init__(self, block: np.ndarray, ids: np.ndarray):
        self.whole, self.ids = block, ids
        self.block = block.astype(np.float64)
        self.largest = float(np.abs(self.block).max(initial=0)) * block.shape[1]
        self.rows = np.argsort(-self.block, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.block.T, self.rows, 1)
        self.place = np.argsort(self.rows, axis=1).astype(np.int32)

    def search(self, query: np.ndarray, k: int, own: int, bar: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows (ties to smaller id, own left out); of fewer, all.

        bar: a score that rows have to reach to be asked for.
        """
        alive = self.ids != own
        if self.largest * float(np.abs(query).max(initial=0)) < EXACT:
            rows = np.flatnonzero(self._open(query.astype(np.float64), alive, k, bar))
            score = np.rint(self.block[rows] @ query).astype(np.int64)
        else:  # too large for bounds in double precision: whole numbers of any size
            rows = np.flatnonzero(alive)
            full = self.whole[rows].astype(object) @ query.astype(object)
            if len(full) and max(map(abs, full)) >> 63:
                raise OverflowError("a score does not fit into 64 bits")
            score = full.astype(np.int64)
        if bar is not None:
            rows, score = rows[score >= bar], score[score >= bar]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return rows[best], score[best]

    def _open(self, query: np.ndarray, alive: np.ndarray, k: int, bar: int | None) -> np.ndarray:
        """Which rows are still in when reading stops."""
        n = len(self.ids)
        up, down = np.flatnonzero(query >= 0), np.flatnonzero(query < 0)
        worst = np.where(query >= 0, self.values[:, -1], self.values[:, 0]) * query
        floor = -np.inf if bar is None else bar - worst.sum()
        seen = np.zeros(n)  # what the entries read add up to, each beyond its list's worst
        in_, depth = alive, 0
        for share in DEPTHS:
            stop = int(n * share)
            if stop <= depth or in_.sum() <= k:
                continue
            for dims, part in ((up, slice(depth, stop)), (down, slice(n - stop, n - depth))):
                if len(dims):
                    gain = self.values[dims, part] * query[dims, None] - worst[dims, None]
                    seen += np.bincount(self.rows[dims, part].ravel(), weights=gain.ravel(), minlength=n)
            depth = stop
            edge = np.where(query >= 0, self.values[:, depth - 1], self.values[:, n - depth]) * query - worst
            room = np.full(n, edge.sum())  # what the unread entries can add: their lists' current values
            if len(up):
                room -= edge[up] @ (self.place[up] < depth)
            if len(down):
                room -= edge[down] @ (self.place[down] >= n - depth)
            lower = seen[alive]
            least = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k])
            in_ = alive & (seen + room >= least - 0.5)  # a row below can't reach the k best, nor tie with them
        return in_


def search(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows; queries are the rows whose id is divisible by every.

    Components become floor(scale * x); scores are exact integers, equal ones rank by id. Rows with a null id, or whose
    vector is null, empty or holds a null or non-finite component, take no part; a query meets rows of its own
    dimension. Rows that repeat an id are candidates each (never for a query of that id); a repeated query is asked
    once, with the vector that sorts first. A score beyond 64 bits is an error. Other columns are left out, an empty
    table gives no rows. Rows go into blocks of about ROWS, whatever their ids.
    """
    x = F.col(f"`{vec_col}`")
    good = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.cast("array<double>").alias("x")).filter("id is not null and size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    rows = cut(good.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("x")))
    nb = blocks_for(rows.count(), ROWS)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(nb)).cast("int")
    # numbers of written rows: a repeated id or vector doesn't fill one block
    body = rows.withColumn("row", F.monotonically_increasing_id()).select(F.size("x").alias("d"), block("row").alias("b"), F.lit(0).alias("kind"), "id", "x", F.lit(None).cast("long").alias("bar"))
    asked = cut(rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("x").alias("x")).select(F.size("x").alias("d"), block("id").alias("home"), F.lit(1).alias("kind"), "id", "x"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, lists = None, [], None
        for b in batches:
            d, n, kind, ids = (b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "b", "kind", "id"))
            bar = b.column("bar").to_pylist()
            flat, offsets = b.column("x").values.to_numpy(), b.column("x").offsets.to_numpy()
            edge = np.flatnonzero((np.diff(d) != 0) | (np.diff(n) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(d)]):
                if i == j:
                    continue
                if (d[i], n[i]) != at:
                    at, parts, lists = (d[i], n[i]), [], None
                x = flat[offsets[i] : offsets[j]].reshape(j - i, d[i])
                if kind[i] == 0:
                    parts.append((x.copy(), ids[i:j].copy()))
                    continue
                if lists is None and parts:
                    lists, parts = Lists(*(np.concatenate(p) for p in zip(*parts, strict=True))), []
                if lists:
                    got = [(own, *lists.search(v, k, own, least)) for own, v, least in zip(ids[i:j].tolist(), x, bar[i:j], strict=True)]
                    q = np.repeat([own for own, _, _ in got], [len(r) for _, r, _ in got])
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(lists.ids[np.concatenate([r for _, r, _ in got])], pa.int64()), pa.array(np.concatenate([s for _, _, s in got]), pa.int64())], schema=schema)

    def round_(queries: DataFrame) -> DataFrame:
        met = body.unionByName(queries.select("d", "b", "kind", "id", "x", "bar"))
        return met.repartition(nb, "d", "b").sortWithinPartitions("d", "b", "kind", "id").mapInArrow(run, "query_id long, vec_id long, score long")

    first = cut(round_(asked.withColumn("b", F.col("home")).withColumn("bar", F.lit(None).cast("long"))))
    bars = first.groupBy("query_id").agg(F.min("score").alias("bar"), F.count("*").alias("n")).filter(F.col("n") == k).select(F.col("query_id").alias("id"), "bar")
    others = asked.join(bars, "id", "left").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).filter("b <> home")
    best = first.unionByName(round_(others)) if nb > 1 else first
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
