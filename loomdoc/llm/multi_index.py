"""Embedding near-duplicates over an inverted multi-index (Babenko, Lempitsky, 2012).

Vectors are scaled to length 1 and cut in halves; each half has a codebook, trained by k-means on a bounded sample, and
the two numbers are a cell of the product grid. A half lies in another centre's region only beyond their bisector, so
the squared distances to both halves' bisectors, added, bound a neighbour's distance from below. Each vector visits
cells in ascending order of that sum (the multi-sequence order) up to a limit: the one at which, on the sample, the
target recall of neighbours at exactly the least cosine, in random directions, is met; nearer ones are met more often.
At recall 1 the limit is the squared distance at that cosine itself, 2 - 2 * cosine, beyond which there can be none: no
link is lost then, for some ten times the work. Visited cells are compared in double precision, so nothing below the
cosine links. A link counts at both ends, whichever of them found it.

Equal vectors of a label are one row with a weight. A cell's rows are dealt into blocks of bounded size, so a large
group is many groups; within one, links are counted and only a spanning star of each connected part is given on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdoc.llm.common import attach, components, cut

#: Fewest and most centres of each half (between, as many as leave CELL rows to a cell), rows that they are trained on
#: (EACH for a centre, SAMPLE at least; about that many go to the driver), rows of a block, recall aimed at.
FEWEST, MOST, CELL, SAMPLE, EACH, ROWS, SEED, ROUNDS, RECALL = 16, 2048, 2000, 20_000, 32, 2048, 13, 12, 0.999


def unit(m: np.ndarray) -> np.ndarray:
    """Rows, finite and not zero, at length 1; scaled by their largest component first, so no square over- or underflows."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = distances(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=len(c)) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None], 0))


def beyond(d: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Squared distance of each half to the region of each centre, from its distances to all centres, by bisectors."""
    sq = d * d
    out = np.empty_like(d)
    for i in range(d.shape[1]):
        out[:, i] = ((sq[:, i : i + 1] - sq) / (2 * between[i])).max(1)
    return np.maximum(out, 0) ** 2


def visited(h1: np.ndarray, h2: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Cells whose halves' sum is within limit, in ascending order of it."""
    a, b = np.flatnonzero(h1 <= limit), np.flatnonzero(h2 <= limit)
    total = h1[a][:, None] + h2[b][None]
    i, j = np.unravel_index(np.argsort(total, axis=None, kind="stable"), total.shape)
    ok = total[i, j] <= limit
    yield from zip(a[i[ok]].tolist(), b[j[ok]].tolist(), strict=True)


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link if their labels are equal and not null and their vectors' cosine, in double precision, is at least
    cosine; of such pairs the share recall is found, all at 1. Null vectors, those with null or non-finite components,
    zero vectors and rows without a label link with nothing; the length of a vector, tiny or huge, does not matter;
    vectors of different dimension don't link. Rows with one id are rows of their own; component_id is the smallest
    id reachable, the row's own id included. Other columns are left out, an empty table gives no rows.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"), F.col(f"`{label_col}`").cast("string").alias("label"))
    rows = rows.withColumn("ok", F.expr("label is not null and vec_id is not null and size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) and exists(x, c -> c <> 0)").eqNullSafe(True))
    # vectors meet their group again by 128 bits, not by all their components
    name = F.struct(F.xxhash64("label", "x").alias("a"), F.xxhash64(F.lit("second"), "x", "label").alias("b"))
    rows = cut(rows.withColumn("name", name))
    ok = rows.filter("ok")
    # one row for equal vectors of a label; rep names it
    reps = cut(ok.groupBy("label", "x", "name").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    # ids are unique to a rep unless rows repeat an id with other vectors: number the reps by themselves
    reps = cut(reps.withColumn("node", F.monotonically_increasing_id()))
    total = reps.count()
    k = min(MOST, max(FEWEST, round((total / CELL) ** 0.5)))
    share = max(SAMPLE, EACH * k) / max(total, 1)
    drawn = reps if share >= 1 else reps.filter(F.pmod(F.xxhash64("name"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = [np.array(r.x) for r in drawn.select("x").orderBy("x").collect()]
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dims = sorted(set(map(len, sample)))
    d = max(dims, key=lambda k: sum(len(v) == k for v in sample))
    base = unit(np.stack([v for v in sample if len(v) == d]))
    half = (d + 1) // 2
    second = lambda m: m[:, half:] if d > 1 else np.zeros((len(m), 1))
    books = [kmeans(base[:, :half], k), kmeans(second(base), k)]
    between = [np.maximum(distances(c, c), 1e-9) + np.diag(np.full(len(c), np.inf)) for c in books]

    def halves(m: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """For both halves, the nearest centre and the squared distance to each centre's region."""
        return tuple((x.argmin(1), beyond(x, t)) for x, t in zip((distances(m[:, :half], books[0]), distances(second(m), books[1])), between, strict=True))

    def fitted(xs) -> np.ndarray:
        """Vectors at length 1; those of another dimension are then padded or cut, which brings none further apart."""
        if all(len(v) == d for v in xs):
            return unit(np.array(xs, float))
        return np.stack([np.pad(unit(np.asarray(v, float)[None])[0][:d], (0, max(0, d - len(v)))) for v in xs])

    def limit() -> float:
        if recall >= 1:
            return 2 - 2 * cosine + 1e-9
        rng = np.random.default_rng(SEED)
        g = rng.normal(size=base.shape)
        g -= (g * base).sum(1, keepdims=True) * base
        g /= np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-300)
        (_, a), (_, b) = halves(base)
        (i, _), (j, _) = halves(unit(cosine * base + np.sqrt(max(0.0, 1 - cosine**2)) * g))
        each = np.arange(len(base))
        return float(np.quantile(a[each, i] + b[each, j], recall)) + 1e-12

    reach = limit()
    if not np.isfinite(reach):
        raise ArithmeticError("no finite limit for the cells to visit")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                (i, _), (j, _) = halves(fitted(b.column("x").to_pylist()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(i, pa.int64()), pa.array(j, pa.int64())], names=[*b.schema.names, "i", "j"])

    body = reps.select("node", "label", "x", "n")
    kinds = "node long, label string, x array<double>, n long, i long, j long"
    cells = cut(body.mapInArrow(assign, kinds))
    counts = cells.groupBy("label", "i", "j").agg(F.count("*").alias("held"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            (_, h1), (_, h2) = halves(fitted(b.column("x").to_pylist()))
            at, ci, cj = [], [], []
            for k in range(b.num_rows):
                for i, j in visited(h1[k], h2[k], reach):
                    at.append(k)
                    ci.append(i)
                    cj.append(j)
            take = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*take.columns, pa.array(ci, pa.int64()), pa.array(cj, pa.int64())], names=[*b.schema.names, "i", "j"])

    probes = body.mapInArrow(visit, kinds)
    # a cell's own rows in blocks of ROWS; a probe goes to each of them
    split = F.ceil(F.col("held") / ROWS).cast("int")
    own = cells.join(counts, ["label", "i", "j"]).withColumn("s", F.pmod(F.xxhash64("node"), split).cast("int"))
    asked = probes.join(counts, ["label", "i", "j"]).withColumn("s", F.explode(F.sequence(F.lit(0), split - 1))).withColumn("t", F.pmod(F.xxhash64("node"), split).cast("int"))
    own = own.withColumn("t", F.explode(F.sequence(F.lit(0), split - 1)))
    keys = ["label", "i", "j", "s", "t"]
    own, asked = (x.select("node", "x", "n", *keys).toDF("node", "x", "n", *(f"{side}_{k}" for k in keys)) for side, x in (("a", own), ("q", asked)))
    mutual = recall >= 1  # both ends then find each other

    def compare(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(q):
            lens_a, lens_q = a["x"].map(len).to_numpy(), q["x"].map(len).to_numpy()
            for dim in np.intersect1d(lens_a, lens_q):
                ra, rq = a[lens_a == dim], q[lens_q == dim]
                va, vq = unit(np.stack(ra["x"].to_numpy()).astype(float)), unit(np.stack(rq["x"].to_numpy()).astype(float))
                na, nq = ra["node"].to_numpy(), rq["node"].to_numpy()
                if not mutual:
                    (_, h1), (_, h2) = halves(fitted(ra["x"].to_list()))
                    (qi, _), (qj, _) = halves(fitted(rq["x"].to_list()))
                for c in range(0, len(vq), ROWS):
                    near = (vq[c : c + ROWS] @ va.T >= cosine) & (nq[c : c + ROWS, None] != na[None])
                    links = near @ ra["n"].to_numpy()
                    hit = np.flatnonzero(links)
                    if not len(hit):
                        continue
                    if not mutual:  # rows that don't visit the probe's cell in their turn get the link here
                        u, v = np.nonzero(near)
                        blind = h1[v, qi[c + u]] + h2[v, qj[c + u]] > reach
                        if blind.any():
                            more = np.bincount(v[blind], weights=rq["n"].to_numpy()[c + u[blind]], minlength=len(na)).astype(np.int64)
                            far = np.flatnonzero(more)
                            out.append(pd.DataFrame({"node": na[far], "links": more[far], "to": -1}))
                    # a bipartite graph of these probes and rows: stars of its parts
                    nodes, place = np.unique(np.concatenate([nq[c : c + ROWS][hit], na]), return_inverse=True)
                    label = np.arange(len(nodes))
                    u, v = np.nonzero(near[hit])
                    u, v = place[:len(hit)][u], place[len(hit):][v]
                    while True:
                        new = label.copy()
                        np.minimum.at(new, u, label[v])
                        np.minimum.at(new, v, label[u])
                        new = new[new]
                        if (new == label).all():
                            break
                        label = new
                    out.append(pd.DataFrame({"node": nq[c : c + ROWS][hit], "links": links[hit], "to": -1}))
                    far = np.flatnonzero(label != np.arange(len(nodes)))
                    out.append(pd.DataFrame({"node": nodes[far], "links": 0, "to": nodes[label[far]]}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "to": []}, dtype="int64")

    found = cut(own.groupBy(*(f"a_{k}" for k in keys)).cogroup(asked.groupBy(*(f"q_{k}" for k in keys))).applyInPandas(compare, "node long, links long, to long"))
    degree = found.filter("to < 0").groupBy("node").agg(F.sum("links").alias("others"))
    comp = components(found.filter("to >= 0").selectExpr("node as u", "`to` as v"))
    named = cut(reps.select("node", "name", "rep", "n").join(degree, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = cut(named.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("m")))
    full = cut(attach(named, least, "component", "m").selectExpr("name", "n", "coalesce(others, 0) + n - 1 as n_links", "least"))
    joined = attach(ok.select("vec_id", "name"), full, "name", "n").selectExpr("vec_id", "n_links", "least as component_id")
    alone = rows.filter("not ok").selectExpr("vec_id", "0L as n_links", "vec_id as component_id")
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
