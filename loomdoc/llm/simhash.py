"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Each text is filed under its segments and looks up, in each, a small Hamming ball
around its own; what it finds is compared by the distance of whole fingerprints. Two uses:

* near_duplicates: 64 bits, links at a given distance, none lost. If radii of the segments' balls, each plus one, add
  up to more than the distance, two fingerprints within it lie in each other's ball in some segment (the pigeonhole
  principle, sharpened). Of the layouts that do, the one with the least work for the number of fingerprints is taken:
  at 4 bits four segments with radii 1, 0, 0 and 0 up to some million, three with 1, 1 and 0 or two with 2 and 1 beyond.
* similar: links at a Jaccard similarity of the sets of word shingles. A similarity sets the share of bits that differ,
  so fingerprints are longer, balls hold the segment and those with one of its least certain bits turned (the bits
  whose counts are nearest to half), and there are as many segments as the recall asked for takes. Pairs within the
  distance are then compared by their whole sets, so none below the similarity links.

Only distinct texts take part. Within a bucket each text is first compared with one of the bucket alone; what these
links join is not compared again, so a dense group of near copies costs a few comparisons for each text, not one for
each pair. Then every pair of a bucket that they have not joined is compared. Where a similarity decides, buckets that
stay mixed and dense get a step between: how many of a text's shingles occur in another text of such buckets bounds what
it can share with any. The text with the largest share of these (what the others are copies of, if it is there) is
compared with the rest of its bucket, and pairs that the bounds rule out are left out; none that links is. One bound is a
bitmap of each set: a bit that differs is a shingle that only one has, so of small sets hardly more than the links is left.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdoc.llm.common import attach, components, cut, free_name, slices

SEED = 42
#: Least certain bits of a segment that its ball turns; deviations of the distance that are let through beyond its mean.
FLIPS, SLACK = 3, 3.0
#: Rows of a bucket that one task compares with what looks it up, and comparisons that cost as much as a row moved.
SLICE, RATIO = 2048, 50
#: Rows of a mixed bucket from which it is dense (and four times the mean at least), and words of the fingerprints and of
#: the bitmaps by which texts of such are compared.
DENSE, SKETCH, BITMAP = 16, 16, 32


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only


def hashes(w: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each run of shingle words, of all words where they are fewer; none without words."""
    if not w:
        return np.zeros(0, "<u8")
    joined = b" ".join(w)
    if len(w) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    of = xxhash.xxh64_digest
    return np.frombuffer(b"".join([of(joined[a:b], SEED) for a, b in zip(starts[: len(w) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]), ">u8").astype("<u8")


def shingle_set(w: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of the distinct runs of shingle words, of all words where they are fewer; none without words."""
    return np.unique(hashes(w, shingle))


def bit_counts(h: np.ndarray, n_words: int = 1) -> np.ndarray:
    """How many of the hashes have each bit set; words beyond the first are mixed from the hash and the word's number."""
    total = np.zeros(64 * n_words, np.int64)
    for at in range(0, len(h), 255 * 64):
        part = h[at : at + 255 * 64, None] + np.arange(n_words, dtype="<u8") * np.uint64(0x9E3779B97F4A7C15)
        part[:, 1:] = _mix(part[:, 1:])
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        total += bits[:whole].reshape(-1, 255, 64 * n_words).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        total += bits[whole:].sum(0, dtype=np.uint8)
    return total


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of a text's shingles of words, repeats included; 0 without words."""
    h = hashes(words(text), shingle)
    return int(np.packbits(2 * bit_counts(h) > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; null texts have no words. No shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], schema=schema)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"coalesce(cast(`{text_col}` as string), '') as text")
    return rows.mapInArrow(run, "doc_id long, fp long")


def layout(distance: int, n: int, bits: int = 64) -> list[tuple[int, int]]:
    """Width and radius of each segment: of the layouts that lose no pair, the one with the least work for n fingerprints.

    A look-up counts as one, a comparison of what a bucket holds by chance as one RATIO-th.
    """
    best: tuple[float, list[tuple[int, int]]] = (math.inf, [])
    for m in range(1, max(1, min(distance, bits)) + 1):
        # at least one ball is larger than a point; the radii plus one add up to distance + 1; wider segments get the smaller balls
        radii = [(distance + 1) // m - 1 + (i < (distance + 1) % m) for i in range(m)]
        widths = [bits // m + (i >= m - bits % m) for i in range(m)]
        work = sum(sum(math.comb(w, k) for k in range(r + 1)) * (1 + n / 2**w / RATIO) for w, r in zip(widths, radii, strict=True))
        if work < best[0]:
            best = (work, list(zip(widths, radii, strict=True)))
    return best[1]


def _long(bits: int) -> Column:
    """64 bits as a signed long."""
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def _ball(segment: Column, width: int, radius: int) -> Column:
    """The segment and all that differ from it in up to radius bits."""
    out = F.array(segment)
    for masks in (itertools.combinations(range(width), k) for k in range(1, radius + 1)):
        turned = F.array(*(_long(sum(1 << b for b in m)) for m in masks))
        out = F.concat(out, F.transform(turned, segment.bitwiseXOR))
    return out


def _linked(nodes: DataFrame, own: Column, probes: Column, carry: list[str], close: str, verify: Callable[[DataFrame], DataFrame], bounds: Callable[[DataFrame], DataFrame] | None = None, able: str = "") -> DataFrame:
    """node and component of every node that links to another.

    own, probes: arrays of the keys that a node is filed under and that it looks up; close: SQL over u and v, two
    nodes, and the columns of carry as u_ and v_; verify: of pairs u, v those that link; bounds: of a table of nodes
    node, share, by which the best of a dense bucket is chosen, and what the SQL able needs, again as u_ and v_, to say
    whether two of these nodes can link.
    """
    side = lambda df, keys, s, *more: df.select(F.explode(keys).alias("key"), F.col("node").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in (*carry, *more)))
    pair = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    number = lambda comp: cut(nodes.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component"))
    edges = lambda comp: comp.selectExpr("node as u", "component as v")

    def spans_of(filed: DataFrame) -> DataFrame:
        return filed.groupBy("key").agg(F.min("v_c").alias("lo"), F.max("v_c").alias("hi"), F.count("*").alias("held"))

    hubs = side(nodes, own, "v").groupBy("key").agg(F.min(F.struct("v", *(f"v_{c}" for c in carry))).alias("h")).select("key", "h.*")
    spokes = cut(side(nodes, probes, "u").join(hubs, "key").filter(f"u <> v and {close}").select(*pair).distinct())
    comp = cut(components(verify(spokes)))
    nodes = named = number(comp)
    more: list[str] = []
    rule = f"u <> v and u_c <> v_c and {close}"
    if bounds:
        filed = side(named, own, "v", "c")
        spans = spans_of(filed)
        usual = spans.agg(F.avg("held")).first()[0] or 0.0
        dense = cut(spans.filter(f"held >= {max(DENSE, 4 * usual)!r} and lo <> hi").select("key"))
        if not dense.isEmpty():
            inside = filed.join(dense, "key")
            known = cut(bounds(inside.select(F.col("v").alias("node")).distinct()))
            best = inside.join(known.withColumnRenamed("node", "v"), "v").groupBy("key").agg(F.max(F.struct("share", "v", "v_c", *(f"v_{c}" for c in carry))).alias("h")).select("key", "h.*").drop("share")
            second = cut(side(named, probes, "u", "c").join(best, "key").filter(rule).select(*pair).distinct())
            comp = cut(components(verify(second).union(edges(comp))))
            nodes = nodes.drop("c")
            named = cut(number(comp).join(known.drop("share"), "node", "left"))
            more = [c for c in known.columns if c not in ("node", "share")]
            rule += f" and (u_{more[0]} is null or v_{more[0]} is null or {able})"
    filed, asked = side(named, own, "v", "c", *more), side(named, probes, "u", "c", *more)
    spans = spans_of(filed)
    mixed = asked.join(spans, "key").filter("lo <> hi or lo <> u_c").drop("lo", "hi")
    plain = mixed.filter(F.col("held") <= SLICE).join(filed, "key").filter(rule).select(*pair)
    # a bucket of more rows in slices, which meet all that look it up
    heavy = spans.filter(F.col("held") > SLICE).select("key", F.ceil(F.col("held") / SLICE).cast("int").alias("n"))
    sliced = filed.join(heavy, "key").withColumn("s", F.pmod(F.xxhash64("v"), F.col("n")).cast("int")).drop("n")
    fanned = mixed.filter(F.col("held") > SLICE).withColumn("s", F.explode(F.sequence(F.lit(0), F.ceil(F.col("held") / SLICE).cast("int") - 1)))
    split = fanned.join(sliced, ["key", "s"]).filter(rule).select(*pair)
    rest = cut(plain.union(split).distinct().join(spokes, ["u", "v"], "left_anti"))
    return components(verify(rest).union(edges(comp)))


def _segments(column: Column, widths: list[int]) -> list[Column]:
    out, at = [], 0
    for w in widths:
        out.append(F.shiftrightunsigned(column, at).bitwiseAND(_long((1 << w) - 1)))
        at += w
    return out

def link_components(fps: DataFrame, distance: int = 4) -> DataFrame:
    """node (a fingerprint of column fp that links to another) and component, over links of at most distance bits."""
    nodes = cut(fps.select(F.col("fp").alias("node")).distinct())
    plan = layout(distance, nodes.count())
    parts = _segments(F.col("node"), [w for w, _ in plan])
    own = F.array(*(F.struct(F.lit(i).alias("i"), p.alias("x")) for i, p in enumerate(parts)))
    balls = [F.transform(_ball(p, w, r), lambda x: F.struct(F.lit(i).alias("i"), x.alias("x"))) for i, (p, (w, r)) in enumerate(zip(parts, plan, strict=True))]
    return _linked(nodes, own, F.concat(*balls), [], f"bit_count(u ^ v) <= {int(distance)}", lambda pairs: pairs)


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    component_id is the smallest doc_id among the rows reachable over links. Rows of one id are rows of their own
    with one id; a row with a null id has a component like any other, null where no row in it has an id. Null texts
    are empty, a very long text is a row like others (its words are hashed in one task), other columns are left out,
    an empty table gives no rows. Links are sought between distinct fingerprints, so a group of copies of any size is
    one row there; its members meet again by attach().
    """
    rows = cut(fingerprints(docs, shingle, id_col, text_col))
    groups = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    return _named(rows, groups, "fp", link_components(groups)).selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') as fingerprint", "component_id")


def _named(rows: DataFrame, groups: DataFrame, key: str, comp: DataFrame) -> DataFrame:
    """rows with component_id; groups: key, node (key itself if there is none), least id and number n of rows."""
    node = "node" if "node" in groups.columns else key
    named = cut(groups.join(comp.withColumnRenamed("node", node), node, "left").select(key, "least", "n", F.coalesce("component", node).alias("component")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    ids = attach(named, cut(least), "component", "m").select(key, "n", "component_id")
    return attach(rows, cut(ids), key, "n")


# Similarity of sets -------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Plan:
    """Long fingerprints: segments segments of width bits, each in one of n_words words, and one more word for a first look."""

    width: int
    segments: int
    first: int
    distance: int

    @property
    def each(self) -> int:
        return 64 // self.width

    @property
    def n_words(self) -> int:
        return -(-self.segments // self.each)


def _bound(similarity: float, bits: int) -> int:
    """The distance that fingerprints of so many bits stay within at the similarity, but for SLACK deviations.

    Sets of one size at Jaccard similarity s have the cosine 2s / (1 + s), and a bit differs with the share of the angle.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(bits, math.ceil(bits * p + SLACK * math.sqrt(bits * p * (1 - p))))


def _distance(a: str, b: str) -> str:
    """SQL for the distance of two fingerprints, arrays of longs."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"


@lru_cache(maxsize=64)
def plan_for(similarity: float, recall: float, n: int) -> Plan:
    """The plan with the least work for n texts at which a pair at exactly the similarity meets with that chance.

    Counts of a bit are about normal with the sets' cosine as correlation. The chance that a segment meets is counted on draws of such pairs.
    """
    cos = 2 * similarity / (1 + similarity)
    rng = np.random.default_rng(SEED)
    best = (math.inf, Plan(16, 1, 64, 64))
    for width in (16, 21, 32):
        x = rng.normal(size=(20_000, width))
        y = cos * x + math.sqrt(1 - cos * cos) * rng.normal(size=x.shape)
        differ = (x > 0) != (y > 0)
        meets = np.zeros(len(x), bool)
        for z in (x, y):
            weak = np.zeros_like(differ)
            np.put_along_axis(weak, np.argsort(np.abs(z), axis=1)[:, :FLIPS], True, 1)
            meets |= (differ.sum(1) <= 1) & ~(differ & ~weak).any(1)
        hit = max(meets.mean(), 1e-3)
        m = math.ceil(math.log(1 - recall) / math.log(1 - hit))
        work = m * (2 + FLIPS + (1 + FLIPS) * n / 2**width / RATIO)
        if work < best[0]:
            best = (work, Plan(width, m, _bound(similarity, 64), _bound(similarity, 64 * -(-m // (64 // width)))))
    return best[1]


def long_fingerprint(h: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, int]:
    """Words of segments, for each segment its FLIPS least certain bits, and the word for a first look."""
    count = bit_counts(h, plan.n_words + 1)
    out = np.packbits(2 * count > len(h), bitorder="little").view("<u8")
    doubt = np.abs(2 * count[: 64 * plan.n_words] - len(h)).reshape(plan.n_words, 64)[:, : plan.each * plan.width].reshape(-1, plan.width)[: plan.segments]
    return out[:-1].view("<i8"), np.argsort(doubt, axis=1, kind="stable")[:, :FLIPS].astype(np.int8).ravel(), int(out[-1:].view("<i8")[0])


def bitmap(h: np.ndarray) -> np.ndarray:
    """BITMAP words with the bit of each hash's remainder set: two sets differ in as many hashes as bits, or more."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(h % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def digest(w: list[bytes]) -> bytes:
    """What names a text's words: their SHA-256."""
    return hashlib.sha256(b" ".join(w)).digest()


def _measured(docs: DataFrame, plan: Plan, shingle: int, text_col: str) -> tuple[DataFrame, list[str]]:
    """docs, all columns, with the digest of each text's words, its fingerprint's words, their least certain bits and
    the word for a first look, written once; and the four columns' names. Null texts have no words."""
    names = [free_name(docs.columns, n) for n in ("digest_", "print_", "weak_", "look_")]
    kinds = (T.BinaryType(), T.ArrayType(T.LongType()), T.ArrayType(T.ByteType()), T.LongType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            of, got = [], []
            for t in b.column(b.schema.get_field_index(text_col)).cast(pa.string()):
                w = words(t.as_py() or "")
                of.append(digest(w))
                got.append(long_fingerprint(shingle_set(w, shingle), plan))
            fp, weak, look = zip(*got, strict=True) if got else ((), (), ())
            more = [pa.array(of, pa.binary()), pa.array(fp, pa.list_(pa.int64())), pa.array(weak, pa.list_(pa.int8())), pa.array(look, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *names])

    return cut(docs.mapInArrow(run, schema)), names


def _groups(docs: DataFrame, similarity: float, shingle: int, recall: float, id_col: str, text_col: str) -> tuple[DataFrame, str, DataFrame, DataFrame]:
    """docs with a digest, its column's name, distinct texts (digest, node, least, n) and components (node, component)."""
    plan = plan_for(similarity, recall, docs.count())
    wide, names = _measured(docs, plan, shingle, text_col)
    rows = wide.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *(F.col(f"`{n}`").alias(k) for n, k in zip(names, ("digest", "fp", "weak", "look"), strict=True)))
    texts = wide.select(F.col(f"`{names[0]}`").alias("digest"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("fp").alias("fp"), F.first("weak").alias("weak"), F.first("look").alias("look"))
    groups = cut(cut(found).withColumn("node", F.monotonically_increasing_id()))  # numbers of written rows, kept as written
    turn = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    shift = lambda way, x, k: F.call_function(way, x, k.cast("int"))
    # not by way of one another: a key is then computed once, whatever the optimizer does with projections
    key = lambda i: shift("shiftrightunsigned", F.get("fp", F.floor(i / plan.each).cast("int")), i % plan.each * plan.width).bitwiseAND(F.lit((1 << plan.width) - 1)).bitwiseOR(shift("shiftleft", i.cast("long"), F.lit(40)))
    own = F.transform(turn(plan.segments), key)
    turned = F.transform(turn(plan.segments * FLIPS), lambda j: key(F.floor(j / FLIPS).cast("int")).bitwiseXOR(shift("shiftleft", F.lit(1).cast("long"), F.get("weak", j))))

    def verify(pairs: DataFrame) -> DataFrame:
        return _similar_pairs(texts, groups, pairs, plan, similarity, shingle)

    def bounds(some: DataFrame) -> DataFrame:
        sets = cut(_sets(texts, groups, some, shingle, sketches=True))
        several = sets.select(F.explode("s").alias("e")).groupBy("e").count().filter("count > 1").select("e")
        most = sets.select("node", F.explode("s").alias("e")).join(several, "e").groupBy("node").agg(F.count("*").cast("int").alias("most"))
        return sets.select("node", F.size("s").alias("size"), "sketch", "map").join(most, "node", "left").select("size", "node", F.coalesce("most", F.lit(0)).alias("most"), "sketch", "map", F.expr("coalesce(most, 0) / greatest(size, 1)").alias("share"))

    # sets as similar have this share of both sizes in common, sketches this near, and no more bits of bitmaps than shingles that only one has
    apart = (1 - similarity) / (1 + similarity) + 1e-9
    able = f"least(u_most, v_most) >= {similarity / (1 + similarity) - 1e-9!r}D * (u_size + v_size) and {_distance('u_sketch', 'v_sketch')} <= {_bound(similarity, 64 * SKETCH)} and {_distance('u_map', 'v_map')} <= {apart!r} * (u_size + v_size)"

    nodes = groups.select("node", "look", "fp", "weak")
    comp = _linked(nodes, own, F.concat(own, turned), ["look"], f"bit_count(u_look ^ v_look) <= {plan.first}", verify, bounds, able)
    return wide, names[0], groups, comp


def _sets(texts: DataFrame, groups: DataFrame, some: DataFrame, shingle: int, sketches: bool = False) -> DataFrame:
    """node and s, the set of its shingles' hashes, of some nodes; with sketches also sketch and map, a fingerprint of
    SKETCH words and the bitmap. All comes of one pass: each one more keeps a worker more in an executor for good."""
    names = ["s", "sketch", "map"] if sketches else ["s"]
    made = pa.schema([("node", pa.int64()), *((n, pa.list_(pa.int64())) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            sets = [shingle_set(words(t.as_py()), shingle) for t in b.column(1)]
            cols = [[h.view("<i8") for h in sets]]
            if sketches:
                cols += [[np.packbits(2 * bit_counts(h, SKETCH) > len(h), bitorder="little").view("<i8") for h in sets], [bitmap(h) for h in sets]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.list_(pa.int64())) for c in cols)], schema=made)

    asked = groups.select("digest", "node").join(some, "node", "left_semi")
    one = texts.join(asked, "digest").dropDuplicates(["node"]).select("node", "text")
    return one.mapInArrow(run, ", ".join(["node long", *(f"{n} array<long>" for n in names)]))


def _similar_pairs(texts: DataFrame, groups: DataFrame, pairs: DataFrame, plan: Plan, similarity: float, shingle: int) -> DataFrame:
    """Of pairs u, v of nodes those whose whole fingerprints are near and whose whole sets are as similar."""
    prints = groups.select("node", "fp")
    near = pairs.join(prints.selectExpr("node as u", "fp as a"), "u").join(prints.selectExpr("node as v", "fp as b"), "v").filter(f"{_distance('a', 'b')} <= {plan.distance}")
    near = cut(near.select("u", "v"))
    sets = cut(_sets(texts, groups, near.selectExpr("u as node").union(near.selectExpr("v as node")).distinct(), shingle))
    both = near.join(sets.selectExpr("node as u", "s as a"), "u").join(sets.selectExpr("node as v", "s as b"), "v")
    shared = both.selectExpr("u", "v", "size(a) + size(b) as total", "size(array_intersect(a, b)) as shared")
    return cut(shared.filter(F.expr("shared / (total - shared)") >= F.lit(float(similarity))).select("u", "v"))


def similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and component_id of every row, over links of a Jaccard similarity of sets of shingles of words.

    A pair at exactly the similarity is met with the chance recall, a nearer one with more; none below it links.
    component_id is the smallest doc_id among the rows reachable. Rows of one id are rows of their own with one id; a
    row with a null id has a component like any other, null where no row in it has an id. Null texts have no words;
    texts without words, and texts of the same words, are copies of each other. Other columns are left out.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    wide, key, groups, comp = _groups(slim, similarity, shingle, recall, "doc_id", "text")
    return _named(wide.select("doc_id", F.col(key).alias("digest")), groups.select("digest", "node", "least", "n"), "digest", comp).select("doc_id", "component_id")


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, without near copies: of each component as in similar() the row with the smallest id stays.

    Ids need not be unique: what decides is the text, so rows that share an id and are no near copies all stay. Rows
    with a null id go before none but stay where no other row is like them; of copies of one text with one id any one
    stays.
    """
    names = docs.columns
    wide, key, groups, comp = _groups(docs, similarity, shingle, recall, id_col, text_col)
    named = cut(groups.select("digest", "node", "least", "n").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # of a component's texts the one with the smallest id, nulls last, then the smallest number
    order = F.struct(F.col("least").isNull().alias("none"), "least", "node")
    best = named.groupBy("component").agg(F.min(order).alias("best"), F.sum("n").alias("m"))
    stays = best.select("best.node", "best.least").join(named.select("node", "digest", "n"), "node")
    least, many = (free_name(wide.columns, n) for n in ("least_", "many_"))
    stays = cut(stays.select(F.col("digest").alias(key), F.col("least").alias(least), (F.col("n") > 1).alias(many)))
    marked = wide.join(stays, key).filter(F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(least)))
    alone = marked.filter(~F.col(many)).select(*(f"`{n}`" for n in names))
    again = marked.filter(many).dropDuplicates([key]).select(*(f"`{n}`" for n in names))
    return alone.unionByName(again)
