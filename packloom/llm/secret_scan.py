"""Secrets in texts: fixed patterns, and a randomness test battery with false-discovery control.

Beside the base patterns, every run of 16 or more token characters is a candidate. Its encoding is inferred from its
characters. Three tests ask whether it looks random: chi-squared uniformity of that alphabet, the number of runs of
character classes, and lag-1 serial correlation; Fisher's sum joins them. Two of the statistics are also held against
ordinary text, whose letters repeat and whose classes seldom change; that p-value shrinks with length. Candidates that
pass the battery are reported where Benjamini and Hochberg's rule, applied to all candidates of the corpus within
bands of length, rejects ordinary text at the false-discovery rate.

A text is read once for the matches and the lengths of the gaps between them; all else works on these: places are
running sums over a text's matches, each distinct token is tested once, in plain columns, and spans meet by row.
Built from DataFrame functions alone.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: The base patterns, in the order of their kinds, and the words that an assignment holds in lower case.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of these is as long as it can be, so its least length can stand in the pattern.
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}+", r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 8
KINDS = ("assign", "access", "hex", "random")
#: Candidate must look random at this level; false-discovery rate against ordinary text.
RANDOM_LEVEL, RATE = 0.001, 0.01
#: Lower ends of the bands of length.
BANDS = (16, 24, 40, 64)
#: Sums of squared and cubed letter shares of ordinary text, times those of even shares; chance of a class change.
TEXT_SQUARES, TEXT_CUBES, TEXT_CHANGE = 1.75, 4.4, 0.1
#: Tokens that are added are broadcast up to this size together.
BROADCAST_BYTES = 8_000_000
#: A published Chebyshev fit of the complementary error function, within 1.2e-7 of it relatively.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABET = _UPPER + _LOWER + _DIGITS + "+/-_="
_PIECES = "array<struct<gap:int,match:string>>"


def pieces(text: Column, pattern: str, possible: Column) -> Column:
    """The leftmost non-overlapping matches in order, each with the length of the gap before it; none unless possible."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.transform(F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g")), lambda x: F.struct(x["g"].alias("gap"), x["m"].alias("match")))
    return F.when(possible, zipped).otherwise(F.array().cast(_PIECES))


def located(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, start, end, match) of all pieces, in code points: the running sum of gaps and matches."""
    each = rows.select(*keys, F.posexplode(column).alias("k", "p")).select(*keys, "k", "p.gap", "p.match", F.length("p.match").alias("n"))
    end = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy(*keys).orderBy("k")).cast("int")
    return each.withColumn("end", end).select(*keys, (F.col("end") - F.col("n")).alias("start"), "end", "match")


def spans_of(scanned: DataFrame) -> DataFrame:
    """(row, start, end, kind, match): base spans, and the candidates (kind 3, with match) that overlap none of them."""
    assign = located(scanned, ["row"], "assigned").where(F.length(F.regexp_extract("match", ASSIGN, 1)) >= LEAST_VALUE)
    runs = located(scanned, ["row"], "runs")
    # abs: else Spark takes the union for partitioned by row, which fails where its parts are coalesced differently.
    parts = [assign.select(F.abs("row").alias("row"), "start", "end", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("match"))]
    # Access keys and hex runs are made of candidates' characters, so they lie within candidates.
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        inner = runs.where(F.col("match").rlike(pattern)).select("row", F.col("start").alias("from"), pieces(F.col("match"), pattern, F.lit(True)).alias("inner"))
        found = located(inner, ["row", "from"], "inner")
        parts.append(found.select("row", (F.col("from") + F.col("start")).alias("start"), (F.col("from") + F.col("end")).alias("end"), F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("match")))
    parts.append(runs.select("row", "start", "end", F.lit(3).alias("kind"), "match"))
    base = lambda c: F.when(F.col("kind") < 3, F.col(c))
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    marked = reduce(DataFrame.unionByName, parts).withColumn("reach", F.max(base("end")).over(earlier)).withColumn("next", F.min(base("start")).over(later))
    covered = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    return marked.where((F.col("kind") < 3) | ~covered).select("row", "start", "end", "kind", "match")


# ---------------------------------------------------------------- the battery: p-values as natural logarithms


def log_upper(z: Column) -> Column:
    """ln P(Z > z) of the normal law, exact to 1e-6 in its own size however far out."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    fit = reduce(lambda acc, c: acc * t + c, ERFC[-2::-1], F.lit(ERFC[-1]))
    tail = F.log(t / 2) - x * x + fit
    return F.when(z >= 0, tail).otherwise(F.log1p(-F.exp(tail)))


def log_chi_squared(x: Column, df: Column) -> Column:
    """ln P(chi-squared of odd df > x), by the closed form of its tail; at least ln 1e-300."""
    root = F.sqrt(x)
    terms = F.aggregate(
        F.sequence(F.lit(1), ((df - 1) / 2).cast("int")),
        F.struct(root.alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct((acc["term"] * x / (2 * i + 1)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")),
        lambda acc: acc["sum"],
    )
    tail = 2 * F.exp(log_upper(root)) + math.sqrt(2 / math.pi) * F.exp(-x / 2) * terms
    return F.when(x > 1300, math.log(1e-300)).otherwise(F.log(F.greatest(F.lit(1e-300), F.least(F.lit(1.0), tail))))


def log_fisher(*logs: Column) -> Column:
    """ln of the combined p-value of independent ones: the tail of chi-squared with two degrees of freedom each."""
    half = -sum(logs, F.lit(0.0))
    terms, term = F.lit(1.0), F.lit(1.0)
    for k in range(1, len(logs)):
        term = term * half / k
        terms = terms + term
    return F.least(F.lit(0.0), F.log(terms) - half)


def alphabet_size(token: Column) -> Column:
    """Number of symbols of the encoding that the token's characters allow, the narrowest first."""
    cases = (("[0-9]+", 10), ("[0-9a-f]+|[0-9A-F]+", 16), ("[a-z]+|[A-Z]+", 26), ("[A-Z2-7]+=*", 32), ("[a-z0-9]+|[A-Z0-9]+", 36), ("[A-Za-z]+", 52), ("[A-Za-z0-9]+", 62))
    out = None
    for pattern, k in cases:
        out = F.when(token.rlike(f"^(?:{pattern})$"), k) if out is None else out.when(token.rlike(f"^(?:{pattern})$"), k)
    return out.otherwise(64).cast("double")


def battery(tokens: DataFrame) -> DataFrame:
    """tokens (match, ...) with length, chi, runs, serial (the statistics) and random, text (ln p as either)."""
    n, k = F.col("n_"), F.col("k_")
    rows = tokens.withColumn("token", F.rtrim(F.col("match"), F.lit("=")))
    rows = rows.withColumns({"length": F.length("token"), "n_": F.length("token").cast("double"), "k_": alphabet_size(F.col("token")), "chars": F.filter(F.split("token", ""), lambda c: c != ""), "kinds": F.translate("token", _ALPHABET, "U" * 26 + "L" * 26 + "D" * 10 + "S" * 5)})
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    squares = F.aggregate(F.array_distinct("chars"), F.lit(0.0), lambda acc, c: acc + F.pow(times(F.col("token"), c), F.lit(2.0)))
    sums = F.aggregate(
        F.transform("chars", lambda c: F.instr(F.lit(_ALPHABET), c).cast("double")),
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("p"), F.lit(None).cast("double").alias("last")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), (acc["q"] + x * x).alias("q"), (acc["p"] + F.coalesce(acc["last"] * x, F.lit(0.0))).alias("p"), x.alias("last")),
    )
    place = lambda at: F.instr(F.lit(_ALPHABET), F.element_at("chars", at)).cast("double")
    rows = rows.withColumns({"squares": squares, "runs": F.length(F.regexp_replace("kinds", r"(.)\1+", "$1")).cast("double"), "sums": sums, "ends": place(1) + place(-1), **{f"in_{c}": times(F.col("kinds"), F.lit(c)).cast("double") for c in "ULDS"}})
    # Chi-squared under even shares; under the uneven shares of text the moments of the sum of squares.
    s2, s3 = F.lit(TEXT_SQUARES) / k, F.lit(TEXT_CUBES) / (k * k)
    spread = F.sqrt(2 * n * (n - 1) * (s2 - s2 * s2) + 4 * n * (n - 1) * (n - 2) * F.greatest(s3 - s2 * s2, F.lit(0.0)))
    # Runs of character classes, given how many characters each class has.
    counts = [F.col(f"in_{c}") for c in "ULDS"]
    q2, q3 = sum(c * c for c in counts), sum(c * c * c for c in counts)
    var = (q2 * (q2 + n * (n + 1)) - 2 * n * q3 - n * n * n) / (n * n * (n - 1))
    changes = (n - 1) * TEXT_CHANGE
    # Serial correlation of the characters' places in the alphabet; the two ends' share is put back.
    m = F.col("sums.s") / n
    around = F.col("sums.q") - n * m * m
    along = F.col("sums.p") - m * (2 * F.col("sums.s") - F.col("ends")) + (n - 1) * m * m
    rows = rows.withColumns({
        "chi": F.col("squares") * k / n - n,
        "z_uneven": (n + n * (n - 1) * s2 - F.col("squares")) / spread,
        "z_runs": F.when(var > 1e-9, (F.col("runs") - (n * (n + 1) - q2) / n) / F.sqrt(var)).otherwise(0.0),
        "z_seldom": (F.col("runs") - 1 - changes) / F.sqrt(changes * (1 - TEXT_CHANGE)),
        "z_serial": F.when(around > 1e-9, (along / around + 1 / n) * F.sqrt(n)).otherwise(0.0),
    })
    both = lambda z: F.least(F.lit(0.0), math.log(2) + log_upper(F.abs(z)))
    rows = rows.withColumns({"p_even": log_chi_squared(F.col("chi"), k - 1), "p_runs": both(F.col("z_runs")), "p_serial": both(F.col("z_serial")), "p_uneven": log_upper(F.col("z_uneven")), "p_seldom": log_upper(F.col("z_seldom"))})
    return rows.select(*tokens.columns, "length", "chi", "z_runs", "z_serial", log_fisher(F.col("p_even"), F.col("p_runs"), F.col("p_serial")).alias("random"), log_fisher(F.col("p_uneven"), F.col("p_seldom")).alias("text"))


def thresholds(counts: DataFrame, rate: float = RATE) -> list[int]:
    """Benjamini and Hochberg's least bin that is rejected in each band, from (band, bin, hits, candidates) of all candidates.

    Bins are tenths of -log10 p; a bin counts as its largest p-value, so the rate is kept. There are a few thousand
    bins at most, whatever the input.
    """
    w = Window.partitionBy("band").orderBy(F.desc("bin"))
    total = F.sum("candidates").over(Window.partitionBy("band"))
    top = F.pow(F.lit(10.0), -F.col("bin") / 10)
    good = counts.withColumn("so_far", F.sum("hits").over(w)).withColumn("total", total).where((F.col("hits") > 0) & (top <= rate * F.col("so_far") / F.col("total")))
    out = [1 << 30] * len(BANDS)
    for r in good.groupBy("band").agg(F.min("bin").alias("bin")).collect():
        out[r[0]] = r[1]
    return out


def scan(docs: DataFrame, rate: float = RATE, level: float = RANDOM_LEVEL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans of every document.

    Null text: empty, no spans (the digest is that of no bytes). Repeated rows are scanned each. No rows: none. Other
    columns are ignored. Added spans ("random") never overlap base spans. Places of a text's spans come from windows
    over that text's matches, which are rows of their own, however many they are.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    low = F.lower(text)
    named = reduce(lambda a, b: a | b, (low.contains(x) for x in ASSIGNED))
    scanned = cut(rows.select("doc_id", pieces(text, ASSIGN, named & text.rlike(ASSIGN)).alias("assigned"), pieces(text, CANDIDATE, text.rlike(CANDIDATE)).alias("runs")).withColumn("row", F.monotonically_increasing_id()))
    spans = cut(spans_of(scanned))
    band = sum((F.when(F.col("length") >= low, 1).otherwise(0) for low in BANDS[1:]), F.lit(0))
    tested = battery(spans.where("kind = 3").groupBy("match").agg(F.count("*").alias("n")))
    bins = F.floor(-F.col("text") / math.log(10) * 10).cast("long")
    likely = (F.col("text") <= math.log(rate)) & (F.col("random") >= math.log(level))
    tested = cut(tested.select("match", "n", band.alias("band"), F.when(likely, bins).alias("bin")))
    # Only p-values up to the rate can be reported; all candidates are counted.
    hits = F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)
    limits = thresholds(tested.groupBy("band", F.coalesce("bin", F.lit(0)).alias("bin")).agg(F.sum(hits).alias("hits"), F.sum("n").alias("candidates")), rate)
    limit = F.element_at(F.array(*map(F.lit, limits)), F.col("band") + 1)
    chosen = cut(tested.where(F.col("bin") >= limit).select("match"))
    size = chosen.agg(F.coalesce(F.sum(F.length("match")), F.lit(0))).first()[0]
    added = spans.where("kind = 3").join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, "match")
    both = spans.where("kind < 3").select("row", "start", "kind", "end").unionByName(added.select("row", "start", "kind", "end"))
    listed = both.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    out = scanned.select("row", "doc_id").join(listed, "row", "left").withColumn("all", F.coalesce("all", F.array().cast("array<struct<start:int,kind:int,end:int>>"))).withColumn("base", F.filter("all", lambda x: x["kind"] < 3))
    kind = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    number = lambda k: F.size(F.filter("all", lambda x: x["kind"] == k)).cast("long")
    return out.select("doc_id", *(number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)), F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.col("all")).alias("spans"))
