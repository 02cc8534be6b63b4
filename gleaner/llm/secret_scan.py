"""Secret scans in DataFrame functions only (operator 7).

Base patterns give spans of known shapes.  Beside them, every unbroken token of twenty or more characters takes a
battery of randomness tests over the alphabet of the encoding it looks like: chi-squared uniformity of its symbols, runs
above and below the middle symbol, and serial correlation.  What ordinary long words score in the same battery, by
length, is the null distribution; a token's p-value is how likely an ordinary token of its length is as even as it is.
A table of few such words takes the null from `REFERENCE`, so that one without any is tested as well.
Beside a whole token its parts between `/`, `_` and `-` are tested, and UUIDs without their hyphens, as a random value
glued to a name or path shows only alone; of spans within one another the widest declared stays.
Within each band of lengths the false discovery rate is held at `LEVEL` (Benjamini and Hochberg, p-values rounded up to
the edge of a bin, so that counts per bin are all that is gathered).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.shared import let, settled, sums_before

#: Fixed patterns: kind, what is matched, the least length that counts, and of which group.  Runs of the last two are
#: maximal, so the least length stands in the pattern and means the same.
BASE = (
    ("assign", r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
)
#: `=` stands only behind, as padding, so a name before it is a token of its own.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
UUID = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
#: What is tested within a token: parts between slashes, parts without any joint, UUIDs.
PARTS = (r"[A-Za-z0-9+_-]{20,}={0,2}", r"[A-Za-z0-9+]{20,}={0,2}", f"(?<![A-Za-z0-9]){UUID}(?![A-Za-z0-9])")
#: Encodings by the characters they use, the narrowest that fits: pattern and alphabet.
ENCODINGS = (
    ("decimal", "^[0-9]+$", "0123456789"),
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("hex_upper", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
#: What an ordinary word looks like; false discoveries allowed; bins of p-values for each factor of ten.
ORDINARY, LEVEL, BINS = "^[A-Za-z]?[a-z]+$", 0.01, 10
#: Long ordinary words that the null is taken from, whatever the table holds: common words in a row, cut to sizes of
#: every band up to 181 characters.
_COMMON = ("information development international government community management understanding particular environment "
           "experience education production technology department important different following available national "
           "performance organization relationship individual everything according president character knowledge "
           "population treatment").split()
REFERENCE = ["".join((_COMMON * 2)[i:i + 24])[:size] for i in range(len(_COMMON))
             for size in (20, 22, 24, 28, 33, 40, 47, 56, 66, 80, 93, 112, 140, 170)]


def _spans(text: Column, pattern: str, least: int, group: int) -> Column:
    """The array of (start, end, found) of leftmost matches that do not overlap, those of at least `least` characters."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    own = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits

    def placed(hit: Column, gap: Column, part: Column) -> Column:
        sizes = F.transform(hit, lambda x, i: (F.length(x) + F.length(F.get(gap, i))).cast("long"))
        return let(sums_before(sizes), lambda before: F.filter(F.transform(hit, lambda x, i: F.struct(
            (F.get(before, i) + F.length(F.get(gap, i))).alias("start"),
            (F.get(before, i) + F.length(F.get(gap, i)) + F.length(x)).alias("end"),
            x.alias("found"), F.length(F.get(part, i)).alias("size"))), lambda s: s["size"] >= least))

    found = let(hits, lambda h: let(between, lambda g: let(own, lambda p: placed(h, g, p))))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string,size:int>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def normal_below(z: Column) -> Column:
    """The standard normal distribution function, by the polynomial approximation with five terms."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    tail = F.lit(0.0)
    for c in reversed(terms):
        tail = (tail + c) * t
    tail = tail * F.exp(-z * z / 2) * 0.3989422804014327
    return F.when(z < 0, tail).otherwise(1 - tail)


def battery(tokens: DataFrame) -> DataFrame:
    """(token) with n, band, encoding and unevenness: the sum of the three tests' normal scores, about -1 to 2 for
    random tokens and growing with length for all others."""
    core = F.when(F.col("token").rlike(f"^{UUID}$"), F.translate(F.lower("token"), "-", "")) \
        .otherwise(F.regexp_replace(F.translate("token", "-_", "+/"), "=", ""))
    kind, letters = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for name, pattern, alphabet in reversed(ENCODINGS[:-1]):
        kind = F.when(core.rlike(pattern), name).otherwise(kind)
        letters = F.when(core.rlike(pattern), alphabet).otherwise(letters)
    rows = tokens.select("token", core.alias("core"), kind.alias("encoding"), letters.alias("letters")) \
        .where(F.length("core") > 1) \
        .select("token", "encoding", F.length("letters").cast("double").alias("k"), F.transform(
            F.split("core", ""), lambda c: (F.instr(F.col("letters"), c) - 1).cast("double")).alias("v")) \
        .select("token", "encoding", "k", F.filter("v", lambda x: x >= 0).alias("v")) \
        .withColumn("n", F.size("v").cast("double"))

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)

    k, n, v = F.col("k"), F.col("n"), F.col("v")
    squares = add(F.transform(F.array_distinct(v), lambda s: F.pow(F.size(F.filter(v, lambda x: x == s)), F.lit(2.0))))
    free = k - 1
    chi = F.cbrt((k / n * squares - n) / free)
    uniform = (chi - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    high = F.transform(v, lambda x: (x >= k / 2).cast("double"))
    rows = rows.withColumn("uniform", uniform).withColumn("high", high).withColumn("n1", add(F.col("high"))) \
        .withColumn("turns", add(F.transform(F.sequence(F.lit(1), F.size("high") - 1), lambda i: (
            F.get("high", i) != F.get("high", i - 1)).cast("double"))) + 1)
    mean = 2 * F.col("n1") * (n - F.col("n1")) / n + 1
    spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.05)))
    middle = (k - 1) / 2
    cross = add(F.transform(F.sequence(F.lit(1), F.size(v) - 1),
                            lambda i: (F.get(v, i) - middle) * (F.get(v, i - 1) - middle)))
    power = add(F.transform(v, lambda x: F.pow(x - middle, F.lit(2.0))))
    serial = cross / F.greatest(power, F.lit(1e-9)) * F.sqrt(n)
    return rows.select(
        "token", "encoding", F.col("n").cast("int").alias("n"), F.floor(F.log2("n") * 2).cast("int").alias("band"),
        (F.col("uniform") + F.abs((F.col("turns") - mean) / spread) - 0.8 + F.abs(serial) - 0.8).alias("unevenness"))


def random_tokens(tokens: DataFrame, level: float = LEVEL) -> DataFrame:
    """Of different tokens (column token) those declared random: token, encoding, p."""
    scored = settled(battery(tokens.where(F.col("token").isNotNull())))
    pooled = (F.avg("unevenness").alias("mean"), F.stddev_pop("unevenness").alias("sd"))
    words = tokens.sparkSession.range(1).select(F.explode(F.array(*[F.lit(w) for w in REFERENCE])).alias("token"))
    known = battery(words)
    null, every = known.groupBy("band").agg(*pooled), known.agg(*pooled).first()
    # bands beyond the longest word take the scores of all words, which are shorter and so closer to random
    tested = scored.where(~F.col("token").rlike(ORDINARY)).join(null, "band", "left") \
        .withColumn("z", (F.col("unevenness") - F.coalesce("mean", F.lit(every.mean)))
                    / F.greatest(F.coalesce("sd", F.lit(every.sd)), F.lit(0.5))) \
        .where(F.col("z").isNotNull()) \
        .withColumn("p", F.greatest(normal_below(F.col("z")), F.lit(1e-30))) \
        .withColumn("bin", F.floor(F.log10("p") * BINS).cast("int") + 1)
    tested = settled(tested.select("token", "encoding", "band", "p", "bin"))
    per_bin = tested.groupBy("band", "bin").agg(F.count("*").alias("c"))
    own = W.partitionBy("band")
    passing = per_bin.withColumn("upto", F.sum("c").over(own.orderBy("bin"))).withColumn("all", F.sum("c").over(own)) \
        .where(F.pow(F.lit(10.0), F.col("bin") / BINS) * F.col("all") <= level * F.col("upto")) \
        .groupBy("band").agg(F.max("bin").alias("last"))
    return tested.join(passing, "band").where("bin <= last").select("token", "encoding", "p")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: doc_id, base and added, arrays of (kind, start, end) in code points, end exclusive.

    base holds the fixed patterns' spans by start, then kind as listed; added the spans of tokens declared random that
    no base span touches, of kind `random`.  A null text counts as empty.  Texts are read whole.  Rows that agree in id
    and text get the same spans; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(1), whole).alias("ka"),
        F.xxhash64(F.lit(2), whole, F.length(whole)).alias("kb"),
        *[_spans(whole, p, least, g).alias(f"k{i}") for i, (_, p, least, g) in enumerate(BASE)],
        _spans(whole, TOKEN, 20, 0).alias("tokens"))
    def tagged(i: int) -> Column:
        return F.transform(f"k{i}", lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("no"), s["end"].alias("end")))

    rows = rows.withColumn("base", F.array_sort(F.concat(*[tagged(i) for i in range(len(BASE))])))
    rows = settled(rows.select("doc_id", "ka", "kb", "base", "tokens"))
    whole_tokens = rows.where(F.size("tokens") > 0).select("doc_id", "ka", "kb", "base", F.explode("tokens").alias("t"))
    parts = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.col("t.end") - F.col("t.start")).alias("end"),
                             F.col("t.found").alias("found"), F.col("t.size").alias("size")))
    parts = F.array_distinct(F.concat(parts, *[_spans(F.col("t.found"), p, 20, 0) for p in PARTS]))
    each = whole_tokens.select("doc_id", "ka", "kb", "base", F.col("t.start").alias("at"), F.explode(parts).alias("p")) \
        .select("doc_id", "ka", "kb", "base", (F.col("at") + F.col("p.start")).alias("start"),
                (F.col("at") + F.col("p.end")).alias("end"), F.col("p.found").alias("token")) \
        .where(~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))).drop("base")
    each = settled(each)
    declared = random_tokens(each.select("token").distinct())
    # spans of one token lie within one another or apart
    before = W.partitionBy("doc_id", "ka", "kb").orderBy("start", F.col("end").desc()).rowsBetween(
        W.unboundedPreceding, -1)
    spans = each.join(declared.select("token"), "token").select("doc_id", "ka", "kb", "start", "end").distinct() \
        .withColumn("reached", F.max("end").over(before))
    added = spans.where(F.col("reached").isNull() | (F.col("reached") < F.col("end"))).groupBy("doc_id", "ka", "kb").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("found")) \
        .select(F.col("doc_id").alias("f_id"), F.col("ka").alias("f_a"), F.col("kb").alias("f_b"), "found")
    names = F.array(*[F.lit(name) for name, *_ in BASE])
    joined = rows.join(added, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("ka") == F.col("f_a"))
                       & (F.col("kb") == F.col("f_b")), "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return joined.select("doc_id", F.transform("base", lambda s: F.struct(
        F.get(names, s["no"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        F.coalesce(F.transform("found", lambda s: F.struct(
            F.lit("random").alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), none).alias("added"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
