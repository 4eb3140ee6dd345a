"""Secret scans with Spark expressions only: fixed patterns, and a battery of randomness tests for other strings.

Every run of 20 or more key characters (a ``=`` only as padding at its end), cut at the spans of fixed patterns, is a candidate,
and so are the pieces of 20 or more characters into which the separators of either base 64, or of both, divide it: a key after a name, a
path or a prefix is tested by itself. A candidate's encoding is the smallest alphabet that holds its characters (hex,
base 32, base 36, base 62, base 64). Under the hypothesis that the string is uniformly random in that alphabet, three
tests give p-values: chi-squared of the symbol counts, runs above and below the middle of the alphabet, and lag-1 serial
correlation. Three times the least of them is the string's p-value. Prose, identifiers and paths reject the hypothesis, keys do not.

False discoveries are controlled per length class over the whole input (Benjamini-Hochberg on a fine grid of p-values, so
that no global sort is needed): at most ``q`` of the strings dismissed as ordinary are random ones. A string that is not dismissed
is reported only if it is long enough that a text of its length would be: the symbol coincidences of prose must lie beyond the cutoff.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fogon.llm.store import cut, prepare

# Fixed patterns, in the order of their kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?"
# Candidates within a run: base 64 characters, those of the URL form, letters and digits alone.
PIECES = [r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9_-]{20,}=*", r"[A-Za-z0-9]{20,}=*"]
# Stands for the characters of a fixed pattern's span; no key character.
MASK = "\x01"
KINDS = ["assign", "access", "hex", "random"]
# Alphabets, smallest first: pattern of a whole string (padding cut off) and symbols in order.
ALPHABETS = [
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[0-9A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("^[0-9A-Za-z_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
COINCIDENCE = 0.065  # chance that two letters of prose agree
BINS_PER_DECADE, DECADES = 20, 30
LONGEST_CLASS = 40
FDR = 0.05
SPAN = "struct<start:int,kind:int,end:int>"
HIT = "struct<start:int,kind:int,end:int,s:string>"
HITS = 256  # matches of a block whose places are summed together


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once: a column inside a lambda is computed anew for every element."""
    return F.transform(F.array(value), f)[0]


def _hits(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """(start, kind, end, s) of the matches whose group is long enough. Text without a match isn't split.

    Places are running sums of the lengths of matches and of what lies between them, within blocks and then over the blocks, so that no
    long array is copied for each of its elements.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), judged.alias("part"))

    def local(parts: Column) -> Column:
        def block(b: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{HIT}>").alias("out"))
            return F.aggregate(F.slice(parts, b * HITS + 1, HITS), start, lambda s, x: F.struct(
                (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
                F.when(F.length(x["part"]) >= least, F.concat(s["out"], F.array(F.struct(
                    (s["at"] + F.length(x["gap"])).alias("start"), F.lit(kind).alias("kind"),
                    (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), x["hit"].alias("s"))))).otherwise(s["out"]).alias("out")))
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(parts) / HITS).cast("int") - 1), block)

    def shifted(blocks: Column) -> Column:
        totals = F.aggregate(blocks, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x["at"])))
        return _with(totals, lambda t: F.flatten(F.transform(blocks, lambda x, i: F.transform(x["out"], lambda h: F.struct(
            (h["start"] + F.get(t, i)).alias("start"), h["kind"].alias("kind"), (h["end"] + F.get(t, i)).alias("end"), h["s"].alias("s"))))))

    hits = _with(F.filter(zipped, lambda x: x["hit"].isNotNull()), lambda parts: _with(local(parts), shifted))
    return F.when(F.regexp_like(text, F.lit(pattern)), hits).otherwise(F.array().cast(f"array<{HIT}>"))


def _spans(hits: Column) -> Column:
    return F.transform(hits, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def _at(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Places of the matches."""
    return _spans(_hits(text, pattern, kind, group, least))


def _tail(z: Column) -> Column:
    """Two-sided normal tail of z >= 0: complementary error function by a rational exponent."""
    # Coefficients of the approximation of erfc with relative error below 1.2e-7.
    coefficients = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]

    def at(x: Column) -> Column:
        def value(t: Column) -> Column:
            exponent = F.lit(coefficients[-1])
            for c in reversed(coefficients[:-1]):
                exponent = exponent * t + c
            return t * F.exp(exponent - x * x)
        return _with(1 / (1 + x / 2), value)

    return _with(z / F.lit(2.0**0.5), at)


def _wilson(chi: Column, k: Column) -> Column:
    """Normal score of a chi-squared statistic divided by its k - 1 degrees of freedom; 0 where it is small."""
    spread = F.lit(2.0) / (9 * (k - 1))
    return F.greatest((F.pow(chi, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread), F.lit(0.0))


def randomness(symbols: Column) -> Column:
    """struct(n, k, p, p_prose): length without padding, alphabet size, the battery's p-value and that of prose; null if no alphabet fits.

    Each step reads what the step before has made, so the work is linear in the length.
    """
    def with_alphabet(s: Column) -> Column:
        return F.struct(s.alias("s"), F.coalesce(*[F.when(s.rlike(p), F.lit(a)) for p, a in ALPHABETS]).alias("a"))

    def judged(x: Column) -> Column:
        return F.when(x["a"].isNotNull() & (F.length(x["s"]) >= 20), _with(symbol_values(x), lambda y: _with(counts(y), lambda c: _with(moments(c), lambda m: _with(scores(m), verdict)))))

    def symbol_values(x: Column) -> Column:
        """The string's characters and their numbers in the alphabet."""
        chars = F.split(x["s"], "")
        return F.struct(x["s"].alias("s"), F.length(x["s"]).cast("double").alias("n"), F.length(x["a"]).cast("double").alias("k"), chars.alias("chars"),
                        F.transform(chars, lambda c: F.instr(x["a"], c).cast("double") - 0.5).alias("values"))

    def counts(x: Column) -> Column:
        n, half, values = x["n"], x["k"] / 2, x["values"]
        squares = F.aggregate(F.array_distinct(x["chars"]), F.lit(0.0), lambda total, c: total + F.pow(n - F.length(F.replace(x["s"], c, F.lit(""))), 2))
        pairs = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.struct(
            n.alias("n"), x["k"].alias("k"), values.alias("values"), pairs.alias("pairs"), squares.alias("squares"), half.alias("half"),
            (F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n).alias("mean"))

    def moments(x: Column) -> Column:
        half, mean = x["half"], x["mean"]
        return F.struct(
            x["n"].alias("n"), x["k"].alias("k"), x["squares"].alias("squares"),
            F.aggregate(x["values"], F.lit(0.0), lambda a, v: a + F.when(v > half, 1.0).otherwise(0.0)).alias("high"),
            F.aggregate(x["pairs"], F.lit(1.0), lambda r, p: r + F.when((p["a"] > half) != (p["b"] > half), 1.0).otherwise(0.0)).alias("runs"),
            F.aggregate(x["values"], F.lit(0.0), lambda a, v: a + F.pow(v - mean, 2)).alias("around"),
            F.aggregate(x["pairs"], F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean)).alias("lagged"))

    def scores(x: Column) -> Column:
        n, k, high = x["n"], x["k"], x["high"]
        expected = 2 * high * (n - high) / n + 1
        wide = (expected - 1) * (expected - 2) / (n - 1)
        # What the chi-squared statistic of prose of this length would be.
        prose = F.greatest(k * ((n - 1) * COINCIDENCE + 1) - n, F.lit(0.0)) / (k - 1)
        return F.struct(
            n.alias("n"), k.alias("k"),
            _wilson(F.greatest(k / n * x["squares"] - n, F.lit(0.0)) / (k - 1), k).alias("z_chi"),
            F.when(wide > 0, F.abs(x["runs"] - expected) / F.sqrt(wide)).otherwise(F.lit(40.0)).alias("z_runs"),
            F.when(x["around"] > 0, F.abs(x["lagged"] / x["around"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(40.0)).alias("z_serial"),
            _wilson(prose, k).alias("z_prose"))

    def verdict(x: Column) -> Column:
        p = F.least(F.lit(1.0), 3 * F.least(*[_tail(F.least(x[z], F.lit(40.0))) for z in ("z_chi", "z_runs", "z_serial")]))
        return F.struct(x["n"].cast("int").alias("n"), x["k"].cast("int").alias("k"), p.alias("p"),
                        F.when(x["k"] <= 16, F.lit(0.0)).otherwise(_tail(F.least(x["z_prose"], F.lit(40.0)))).alias("p_prose"))

    return _with(F.rtrim(symbols, F.lit("=")), lambda s: _with(with_alphabet(s), judged))


def _masked(text: Column, base: Column) -> Column:
    """``text`` of the same length with MASK in place of the spans, and of one separator right after each."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    covered = F.aggregate(F.array_sort(base), start, lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.concat(s["out"], F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))),
                 F.repeat(F.lit(MASK), F.greatest(x["end"] - F.greatest(s["at"], x["start"]), F.lit(0)))).alias("out")),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(base) > 0, F.regexp_replace(covered, f"(?<={MASK})[/+_-]", MASK)).otherwise(text)


def _candidates(text: Column) -> Column:
    """For each run of key characters, itself and the pieces within it with their places, each place once. Runs don't overlap."""
    def pieces(run: Column) -> Column:
        within = F.concat(*[_hits(run["s"], p, 3) for p in PIECES])
        moved = F.transform(within, lambda x: F.struct(
            (run["start"] + x["start"]).alias("start"), x["kind"].alias("kind"), (run["start"] + x["end"]).alias("end"), x["s"].alias("s")))
        return F.when(run["s"].rlike("[+/_-]"), _with(F.array_sort(moved), once)).otherwise(F.array(run))

    def once(x: Column) -> Column:
        return F.filter(x, lambda y, i: (i == 0) | (F.get(x, i - 1) != y))

    return F.transform(_hits(text, RUN, 3), pieces)


def _merged(spans: Column) -> Column:
    """Overlapping spans of one kind as one."""
    def step(out: Column, x: Column) -> Column:
        last = F.element_at(out, -1)
        return F.when((F.size(out) > 0) & (F.get(out, F.size(out) - 1)["end"] > x["start"]), F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(f"array<{SPAN}>"), step)


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE), F.lit(BINS_PER_DECADE * DECADES)).cast("int")


def _class(n: Column) -> Column:
    return F.least(F.floor(F.log2(n / 20.0) * 4), F.lit(LONGEST_CLASS)).cast("int")


def cutoffs(candidates: DataFrame, q: float) -> DataFrame:
    """(length_class, cut_bin): bins from cut_bin on are dismissed. At most 41 rows, from at most 41 x 601 counts."""
    counts = candidates.groupBy("length_class", "bin").count()
    w = Window.partitionBy("length_class")
    below = F.sum("count").over(w.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0))
    largest_p = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE)
    passed = counts.withColumn("below", below).withColumn("all", F.sum("count").over(w)).filter(largest_p * F.col("all") <= q * F.col("below"))
    return passed.groupBy("length_class").agg(F.min("bin").alias("cut_bin"))


def scan(docs: DataFrame, q: float = FDR, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep``, and found: array of (start, kind, end), sorted; kind is an index into KINDS.

    Places count code points, the end is exclusive. Null and empty texts have no spans. Every row of the input has one row;
    a null doc_id stays null. What a span of a fixed pattern covers is not reported again; overlapping random spans are one.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.col("doc_id"), *[F.col(c).alias(f"_{c}") for c in keep], text.alias("t"))
    places = named.select(
        "doc_id", *[f"_{c}" for c in keep], "t",
        F.concat(_at(F.col("t"), ASSIGN, 0, 1, 6), F.when(F.contains("t", F.lit("AKIA")), _at(F.col("t"), ACCESS, 1)).otherwise(F.array().cast(f"array<{SPAN}>")), _at(F.col("t"), HEX, 2)).alias("base"))
    masked = places.withColumn("m", _masked(F.col("t"), F.col("base")))
    def judged(run: Column) -> Column:
        tested = F.transform(run, lambda c: F.struct(
            F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")).alias("span"), randomness(c["s"]).alias("r")))
        return F.transform(F.filter(tested, lambda x: x["r"].isNotNull()), lambda x: F.struct(
            x["span"].alias("span"), _class(x["r"]["n"]).alias("length_class"), _bin(x["r"]["p"]).alias("bin"), _bin(x["r"]["p_prose"]).alias("prose")))

    runs = F.transform(_candidates(F.col("m")), judged)
    scanned = cut(masked.select("doc_id", *[f"_{c}" for c in keep], "base", F.filter(runs, lambda x: F.size(x) > 0).alias("judged")), "secrets")
    limits = cutoffs(scanned.select(F.explode(F.flatten("judged")).alias("j")).select("j.length_class", "j.bin"), q)
    # One row: at most 41 (class, cut) pairs.
    table = limits.agg(F.map_from_entries(F.collect_list(F.struct("length_class", "cut_bin"))).alias("cuts")).scalar()
    never = BINS_PER_DECADE * DECADES + 1

    def random(x: Column) -> Column:
        cut_bin = F.coalesce(F.element_at("cuts", x["length_class"]), F.lit(never))
        return (x["bin"] < cut_bin) & (x["prose"] >= F.least(cut_bin, F.lit(4 * BINS_PER_DECADE)))

    added = F.flatten(F.transform("judged", lambda run: _merged(F.transform(F.filter(run, random), lambda x: x["span"]))))
    found = F.array_sort(F.concat("base", added))
    return scanned.withColumn("cuts", table).select("doc_id", *[F.col(f"_{c}").alias(c) for c in keep], found.alias("found"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, q: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span, overlapping ones merged, replaced by ``mark``; n_chars follows the text."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    found = scan(rows, q, ("text", "row"))
    text = F.coalesce("text", F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("found", start, lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))).otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    hit = F.size("found") > 0
    out = found.withColumn("new", F.when(hit, cleaned).otherwise(F.col("text")))
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length("new").cast("long")).otherwise(F.col("row.n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("found", lambda x: x["kind"] < 3)
    kinds = F.transform("found", lambda x: x["kind"])
    counts = [(F.size("found") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


SQL: dict[str, str] = {}
