"""Secret scans: known forms, and a battery of randomness tests on whatever else could be a key.

Candidates are runs of 20 or more characters of base64 alphabets with a letter and, as keys have, a digit or both
cases. Each is read in the smallest usual encoding that holds it (hexadecimal, base32, base36, base62, base64), and its
symbols are tested against a uniform draw from that alphabet: chi-squared counts, runs about the middle, serial
correlation. The least of the three p-values gives the combined one, p = 1 - (1 - least)^3; keys have large ones.

How much else has as large ones depends on encoding and length, and the cut is chosen for each such class over the whole
table, so that the estimated share of others among what is accepted stays below a rate. Counts by bin of p are compared
with the share of random tokens that a bin holds, which is drawn by simulation for the class, as the tests are discrete
and not quite independent. Random tokens are counted by the top quarter, where others are rarest; what bins below
hold beyond them are others. Their shape is taken from neighbouring classes together until enough tokens are there, an
error of one deviation added; their number from the class's lowest bin, as far as that is more than chance. Without enough tokens nothing is accepted.

DataFrame functions only. Texts are read once: spans and candidates are written, a bounded table of counts (class by
bin) goes to the driver, and the result is read from what was written. No shuffle but that of the counts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdoc.llm.common import cut, free_name

# Fixed patterns of the known forms; letters of the names in either case, ASCII only.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

_HEX = "0123456789abcdef"
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_B36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_B62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_B64 = _B62 + "+/"
#: Bins of p; lengths from which a class is a quarter of an octave, and how many of these there are; how many
#: neighbours a prefix sum adds at once; characters of a block in which known forms are looked up.
P_BINS, OCTAVES, CLASSES, STEP, BLOCK = 50, 64, 36, 128, 4096
#: The least p that is ever accepted, the share of others among what is accepted, tokens in the upper half that classes
#: are pooled for, those below which nothing is accepted, and draws that a class's null table is made of.
LEAST_P, RATE, POOL, LEAST, DRAWS = 0.02, 0.05, 400, 20, 10_000


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, pattern: str, kind: int, test: str, least: int, group: int = 0) -> Column:
    """Structs (start, kind, end, token) of the leftmost matches, one after another, whose group has least characters.

    Starts are sums of the lengths of what stands between matches and of the matches, in blocks of STEP so that many
    matches cost little more than few.
    """
    none = F.array().cast("array<struct<start:long,kind:int,end:long,token:string>>")

    def found(p: Column) -> Column:
        between, match, part = p["between"], p["match"], p["part"]
        lens = F.zip_with(F.slice(between, 1, F.size(match)), match, lambda a, b: (F.length(a) + F.length(b)).cast("long"))

        def from_lens(ls: Column) -> Column:
            total = lambda arr: F.aggregate(arr, F.lit(0).cast("long"), lambda a, x: a + x)
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(match) - 1) / STEP).cast("int")), lambda b: total(F.slice(ls, b * STEP + 1, F.lit(STEP))))
            before = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

            def starts(bp: Column) -> Column:
                def one(m: Column, i: Column) -> Column:
                    b = F.floor(i / STEP).cast("int")
                    start = F.get(bp, b) + total(F.slice(ls, b * STEP + 1, i % STEP)) + F.length(F.get(between, i))
                    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(m)).alias("end"), F.get(part, i).alias("token"))

                return F.transform(match, one)

            return _let(before, starts)

        return F.filter(_let(lens, from_lens), lambda s: F.length(s["token"]) >= least)

    pieces = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    return F.when(text.rlike(test), _let(pieces, found)).otherwise(none)


def _by_kind(text: Column) -> list[Column]:
    """The known forms, an array for each kind, by start."""
    return [
        _spans(text, ASSIGN, 0, ASSIGN.rsplit("(", 1)[0] + "[A-Za-z0-9+/_.=-]{6}", 6, 2),
        _spans(text, ACCESS, 1, "AKIA[A-Z0-9]{16}", 20),
        _spans(text, HEX, 2, "[0-9a-f]{24}", 24),
    ]


def _touches(run: Column, known: Column, before: Column) -> Column:
    """Whether a run overlaps one of known, which are in order and apart; before: how many of them start before each block."""
    over = lambda of: F.exists(of, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    block = lambda at: F.get(before, F.floor(at / BLOCK).cast("int"))
    first = F.greatest(block(run["start"]) - 1, F.lit(0))
    return F.when(F.size(known) <= 32, over(known)).otherwise(over(F.slice(known, first + 1, block(run["end"] + BLOCK) - first)))


def _before(text: Column, known: Column) -> Column:
    """How many of known start before each block of the text and the one after it."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int") + 2)
    counted = F.transform(blocks, lambda b: F.size(F.filter(known, lambda k: k["start"] < b * BLOCK)))
    return F.when(F.size(known) > 32, counted).otherwise(F.array().cast("array<int>"))


def _tail(z: Column) -> Column:
    """The upper tail of the normal distribution by the logistic approximation of Page (1977)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def randomness(token: Column) -> Column:
    """A struct k, p: the size of the token's alphabet, and the combined p-value of its symbols under a uniform draw from it."""
    bare = F.regexp_replace(F.translate(token, "-_", "+/"), "=+$", "")
    enc = lambda t, a, k: F.struct(t.alias("text"), F.lit(a).alias("alphabet"), F.lit(k).alias("k"))

    def by_encoding(t: Column) -> Column:
        return (
            F.when(t.rlike("^[0-9a-f]+$") | t.rlike("^[0-9A-F]+$"), enc(F.lower(t), _HEX, 16.0))
            .when(t.rlike("^[A-Z2-7]+$"), enc(t, _B32, 32.0))
            .when(t.rlike("^[a-z0-9]+$"), enc(t, _B36, 36.0))
            .when(t.rlike("^[A-Z0-9]+$"), enc(F.lower(t), _B36, 36.0))
            .when(t.rlike("^[A-Za-z0-9]+$"), enc(t, _B62, 62.0))
            .otherwise(enc(t, _B64, 64.0))
        )

    def tests(e: Column) -> Column:
        symbols = F.transform(F.split(e["text"], ""), lambda c: F.call_function("locate", c, e["alphabet"]).cast("double") - 1)

        def of(v: Column) -> Column:
            n, k = F.size(v).cast("double"), e["k"]
            add = lambda arr: F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
            squares = add(F.transform(F.array_distinct(v), lambda s: F.pow(F.size(F.filter(v, lambda x: x == s)).cast("double"), 2)))
            chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
            high = F.size(F.filter(v, lambda x: x >= k / 2)).cast("double")
            rest = F.slice(v, 2, F.size(v) - 1)
            steps = F.zip_with(F.slice(v, 1, F.size(v) - 1), rest, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
            runs = 1 + F.size(F.filter(steps, lambda s: (s["a"] >= k / 2) != (s["b"] >= k / 2)))
            mu = 2 * high * (n - high) / n + 1
            var = (mu - 1) * (mu - 2) / (n - 1)
            run_z = F.when(var > 0, F.abs(runs - mu) / F.sqrt(F.greatest(var, F.lit(1e-9)))).otherwise(F.lit(9.0))
            mean = add(v) / n
            spread = add(F.transform(v, lambda x: (x - mean) * (x - mean)))
            serial = add(F.transform(steps, lambda s: (s["a"] - mean) * (s["b"] - mean)))
            ser_z = F.when(spread > 0, F.abs(serial / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
            least = F.least(F.lit(1.0), _tail(chi), 2 * _tail(run_z), 2 * _tail(ser_z))
            return F.struct(k.cast("int").alias("k"), (1 - F.pow(1 - least, F.lit(3.0))).alias("p"))

        return _let(symbols, of)

    return _let(bare, lambda t: _let(by_encoding(t), tests))


def _length_class(token: Column) -> Column:
    n = F.length(token)
    return F.when(n < OCTAVES, n).otherwise(OCTAVES + F.least(F.lit(CLASSES - 1), F.floor(4 * F.log2(n / OCTAVES)).cast("int")))


def _candidates(text: Column, kinds: list[Column]) -> Column:
    """Structs (start, kind, end, class, k, p) of the runs that could be keys and touch no known form; kinds: as of _by_kind."""
    runs = F.filter(_spans(text, CANDIDATE, 3, CANDIDATE, 20), lambda s: s["token"].rlike("[A-Za-z]") & (s["token"].rlike("[0-9]") | (s["token"].rlike("[a-z]") & s["token"].rlike("[A-Z]"))))
    free = runs
    for known in kinds:
        free = _let(F.struct(free.alias("runs"), known.alias("known"), _before(text, known).alias("before")), lambda x: F.filter(x["runs"], lambda s: ~_touches(s, x["known"], x["before"])))
    tested = F.transform(free, lambda s: F.struct(s.alias("s"), randomness(s["token"]).alias("r")))
    return F.transform(tested, lambda t: F.struct(t["s"]["start"].alias("start"), t["s"]["kind"].alias("kind"), t["s"]["end"].alias("end"), _length_class(t["s"]["token"]).alias("class"), t["r"]["k"].alias("k"), t["r"]["p"].alias("p")))


@lru_cache(maxsize=512)
def null_shares(k: int, length: int) -> np.ndarray:
    """The share of random tokens of a length over k symbols that each bin of p holds, by the tests above on draws."""
    n = min(length, 256)
    rng = np.random.default_rng(k * 1000 + n)
    v = rng.integers(0, k, (DRAWS, n)).astype(float)
    if k == 64:  # without one of the two last symbols, or without capitals, a token is read in a smaller alphabet
        v = v[(v >= 62).any(1)]
    elif k == 62:
        v = v[((v >= 10) & (v < 36)).any(1) & (v >= 36).any(1)]
    tail = lambda z: 1 / (1 + np.exp(np.minimum(700, 1.5976 * z + 0.07056 * z**3)))
    squares = sum((v == x).sum(1) ** 2 for x in range(k))
    chi = (k / n * squares - n - (k - 1)) / np.sqrt(2 * (k - 1) * (n - 1) / n)
    high = v >= k / 2
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    mu = 2 * high.sum(1) * (n - high.sum(1)) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    run_z = np.where(var > 0, np.abs(runs - mu) / np.sqrt(np.maximum(var, 1e-9)), 9)
    c = v - v.mean(1, keepdims=True)
    spread = (c * c).sum(1)
    ser_z = np.where(spread > 0, np.abs((c[:, 1:] * c[:, :-1]).sum(1) / np.maximum(spread, 1e-9) + 1 / n) * np.sqrt(n), 9)
    least = np.minimum(1, np.minimum(tail(chi), 2 * np.minimum(tail(run_z), tail(ser_z))))
    at = np.minimum(P_BINS - 1, ((1 - (1 - least) ** 3) * P_BINS).astype(int))
    return np.bincount(at, minlength=P_BINS) / max(1, len(v))


def _length_of(c: int) -> int:
    return c if c < OCTAVES else int(OCTAVES * 2 ** ((c - OCTAVES + 0.5) / 4))


def thresholds(counts: list[tuple[int, int, int, int]]) -> dict[tuple[int, int], float]:
    """The least p accepted in each class, from counts of (alphabet, class, bin, tokens); classes without one are left out."""
    by: dict[tuple[int, int], np.ndarray] = {}
    for k, c, b, n in counts:
        by.setdefault((k, c), np.zeros(P_BINS))[b] += n
    half, top = P_BINS // 2, P_BINS * 3 // 4
    above = lambda x: np.cumsum(x[::-1])[::-1]  # noqa: E731  of each bin and those beyond it

    def others(pool: list[tuple[int, int]]) -> np.ndarray:
        """Others in each bin and beyond, for one in the lowest bin, as the classes of the pool together show them."""
        n = sum(by[x] for x in pool)
        q = sum(by[x].sum() * null_shares(x[0], _length_of(x[1])) for x in pool) / n.sum()
        random = n[top:].sum() / q[top:].sum()
        error = np.sqrt(above(n) + (above(q) / q[top:].sum()) ** 2 * n[top:].sum())
        more = np.maximum(0, above(n) - random * above(q)) + error
        low = n[0] - random * q[0]
        return more / low if low > 1 else np.ones(P_BINS)

    out = {}
    for x, n in by.items():
        near = sorted(by, key=lambda y: (y[0] != x[0], abs(np.log(_length_of(y[1]) / _length_of(x[1]))), y))
        size = np.cumsum([by[y][half:].sum() for y in near])
        if size[-1] < LEAST:
            continue
        pool = near[: int(np.searchsorted(size, min(POOL, size[-1]))) + 1]
        q = null_shares(x[0], _length_of(x[1]))
        chance = n[half:].sum() / q[half:].sum() * q[0]  # random tokens in the lowest bin
        low = max(0.0, n[0] - chance - np.sqrt(chance))
        share = low * others(pool) / np.maximum(above(n), 1e-9)
        ok = [b for b in range(int(LEAST_P * P_BINS), half + 1) if above(n)[b] and share[b] <= RATE]
        if ok:
            out[x] = ok[0] / P_BINS
    return out


def with_spans(docs: DataFrame, text_col: str = "text", base: str = "_base", more: str = "_random", keep_text: bool = True) -> DataFrame:
    """docs with two columns more: known forms, and random tokens beyond their class's cut; written once on the way.

    The names are the caller's to choose, so that they clash with none of its own. Null texts are empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kinds = [free_name([*docs.columns, base, more], n) for n in ("assign_", "access_", "hex_")]
    known = docs.withColumns(dict(zip(kinds, _by_kind(text), strict=True))).withColumn(more, _candidates(text, list(map(F.col, kinds))))
    known = known.withColumn(base, F.array_sort(F.concat(*map(F.col, kinds)))).drop(*kinds)
    known = cut(known if keep_text else known.drop(text_col))
    tokens = known.select(F.explode(more).alias("t")).groupBy("t.k", "t.class", F.least(F.lit(P_BINS - 1), F.floor(F.col("t.p") * P_BINS).cast("int")).alias("bin"))
    counts = [(r["k"], r["class"], r["bin"], r["n"]) for r in tokens.agg(F.count("*").alias("n")).collect()]  # 5 alphabets by 80 classes by P_BINS rows at most
    cuts = thresholds(counts)
    code = lambda k, c: k * 1000 + c
    pairs = [F.lit(v) for (k, c), p in sorted(cuts.items()) for v in (code(k, c), p)]
    least = F.create_map(*pairs) if pairs else F.lit(None).cast("map<int, double>")
    kept = F.filter(more, lambda s: s["p"] >= F.coalesce(F.element_at(least, code(s["k"], s["class"])), F.lit(2.0)))
    return known.withColumn(more, F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"])))


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every row.

    Spans are kind:start:end in code points, end exclusive, by start, then kind, joined by commas; base_sha256 is the
    digest of the known forms' alone. Null texts are empty, repeated rows count each, other columns are left out, an
    empty table gives no rows. A very long text is one row of one task; its cost is linear in its characters and matches.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = with_spans(rows, "text", "base", "random", keep_text=False)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.array_sort(F.concat(_bare(F.col("base")), F.col("random")))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs, all columns, with every span of a text (overlapping ones as one) replaced by mark; length_col follows.

    Null texts stay null, and with them their length; no row goes; columns of any name stay as they are.
    """
    names = docs.columns
    base, more = free_name(names, "base_spans_"), free_name(names, "random_spans_")
    found = with_spans(docs, text_col, base, more)
    text = F.col(f"`{text_col}`")
    spans = F.array_sort(F.concat(_bare(F.col(base)), F.col(more)))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = text.substr((s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        apart = (x["start"] >= s["at"]) & ((x["start"] > s["at"]) | (s["at"] == 0))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(apart, F.concat(s["out"], F.array(piece, F.lit(mark)))).otherwise(s["out"]).alias("out"))

    done = F.aggregate(spans, zero, step, lambda s: F.concat(F.array_join(s["out"], ""), text.substr((s["at"] + 1).cast("int"), F.length(text))))
    new = F.when(F.size(spans) > 0, done).otherwise(text)
    out = found.withColumn(text_col, new).drop(base, more)
    return out.withColumn(length_col, F.length(text).cast(dict(docs.dtypes)[length_col])) if length_col in names else out
