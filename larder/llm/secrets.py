"""Secrets in texts, with DataFrame and SQL functions alone.

Three rules (`KINDS`) give the base spans.  A battery of randomness tests adds spans of kind `random`: each run of 20 or
more characters of the usual encodings that holds a letter and a digit is a candidate; its encoding is inferred from the
characters it uses, and three statistics are taken of its symbols under the hypothesis that they are drawn uniformly from
that encoding's alphabet:

* chi-squared of the symbol counts, in as many equal cells of the alphabet as the length can fill (as a normal deviate by the Wilson-Hilferty cube root),
* the number of runs of symbols in the lower and the upper half of the alphabet,
* the serial correlation of neighbouring symbols.

Their squares add up to a chi-squared value of three degrees, whose p-value is combined over the corpus by the
Benjamini-Hochberg rule within bands of length (short runs are many and their tests weak, so they don't set the limit for
long ones).  Candidates that the rule rejects are structured text; the others are random, and become spans.  Counts for the rule are
gathered over all documents as a histogram of bounded size.

The rules come first: runs are sought in what the base spans leave of the text, so that a key beside one is judged alone and no
random span touches a base span.  `scan` lists the spans, `redact` masks them.

Defined cases: a null text is empty and has no span; equal rows give equal results; null doc_ids are kept; an empty table
gives no row; other columns are ignored (`scan`) or kept, whatever their names (`redact`).  A text of any length is one row's
work, whose time grows with its length and, but for a logarithm, with its hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import materialize

# Fixed values of the contract: kind, pattern, group that must be long, its least length.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"base16": "0123456789abcdef", "base32": UPPER + "234567", "base36": DIGITS + LOWER,
             "base62": DIGITS + UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/"}
BANDS = [24, 32, 48, 64, 128]  # a band starts at each of these lengths
LEVEL = 0.05
PER_CELL = 4  # symbols that a cell of the chi-squared table expects at least
STEPS = 512  # p-values are counted in steps of 1 / STEPS of their logarithm's range
LEAST_LOG = -40.0
MASK = "[SECRET]"
CHUNK_BITS = 12  # parts of a text are taken from chunks of 4,096 characters
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def _let(value: Column, body) -> Column:
    """body(value), with the value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, join) -> Column:
    """join over the first 1, 2, ... values, by doubling: n log n steps, where appending to an array would take n squared."""

    def whole(x: Column) -> Column:
        rounds = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(x), F.lit(1)))).cast("int"))
        shifts = F.transform(rounds, lambda r: F.pow(F.lit(2.0), r).cast("int"))
        return F.aggregate(shifts, x, lambda seen, shift: F.transform(
            seen, lambda v, i: F.when(i >= shift, join(v, F.get(seen, i - shift))).otherwise(v)))

    return _let(values, whole)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, text>> of the leftmost non-overlapping matches; positions in code points."""

    def placed(hits: Column) -> Column:
        def at(gaps: Column) -> Column:
            ends = _running(F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h)), lambda v, w: v + w)
            return F.transform(F.arrays_zip(hits.alias("hit"), ends.alias("end")),
                               lambda y: F.struct((y["end"] - F.length(y["hit"])).alias("start"), y["hit"].alias("text")))

        # Most texts have no match and are not split.
        return F.when(F.size(hits) > 0, _let(F.split(text, pattern, -1), at)).otherwise(F.array().cast("array<struct<start:int,text:string>>"))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _replaced(text: Column, spans: Column, fill) -> Column:
    """The text with fill(at, span) for each span; the spans ascend by start, and `at` is where those before it end.

    Parts are taken from chunks of the text, as a substring is sought from the start of its string.
    """

    def part(chunks: Column, a: Column, b: Column) -> Column:
        first = F.shiftright(a, CHUNK_BITS)
        near = F.slice(chunks, first + 1, F.greatest(F.shiftright(b, CHUNK_BITS) - first + 1, F.lit(0)))
        return F.substring(F.array_join(near, ""), a.bitwiseAND((1 << CHUNK_BITS) - 1) + 1, F.greatest(b - a, F.lit(0)))

    def build(x: Column) -> Column:
        at = lambda i: F.coalesce(F.get(x["upto"], i - 1), F.lit(0))
        parts = F.transform(spans, lambda s, i: F.concat(part(x["chunks"], at(i), s["start"]), fill(at(i), s)))
        return F.concat(F.array_join(parts, ""), part(x["chunks"], at(F.size(x["upto"])), F.length(text)))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << CHUNK_BITS}}}"), F.lit(0))
    upto = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) > 0, _let(F.struct(chunks.alias("chunks"), upto.alias("upto")), build)).otherwise(text)


def _rule_spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    long_enough = F.filter(_spans(text, pattern), lambda s: F.length(F.regexp_extract(s["text"], pattern, group)) >= least)
    return F.transform(long_enough, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), (s["start"] + F.length(s["text"])).alias("end"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """The spans of the three rules, by start and then by rule."""
    parts = [_rule_spans(text, rank, *rule) for rank, rule in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts)).cast(f"array<{SPAN}>")


def _encoding(run: Column) -> Column:
    return (F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "base16").when(run.rlike("^[A-Z2-7]+=*$"), "base32")
            .when(run.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36").when(run.rlike("^[0-9A-Za-z]+$"), "base62").otherwise("base64"))


def _symbols(run: Column, encoding: Column) -> Column:
    """The run's symbols as numbers of its alphabet."""
    plain = F.translate(F.rtrim(run, F.lit("=")), "-_", "+/")
    folded = F.when(encoding.isin("base16", "base36"), F.lower(plain)).otherwise(plain)
    letters = F.lit(None).cast("string")
    for name, alphabet in ALPHABETS.items():
        letters = F.when(encoding == name, F.lit(alphabet)).otherwise(letters)
    chars = F.filter(F.split(folded, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.position(c, letters) - 1)


def _erfc(x: Column) -> Column:
    """Abramowitz and Stegun 7.1.26, for x >= 0."""
    t = 1 / (1 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return series * F.exp(-x * x)


def p_value(run: Column) -> Column:
    """p of the three tests together under a uniform draw from the inferred alphabet."""
    encoding = _encoding(run)
    size = F.lit(None).cast("double")
    for name, alphabet in ALPHABETS.items():
        size = F.when(encoding == name, float(len(alphabet))).otherwise(size)

    def tests(x: Column) -> Column:
        symbols, k = x["symbols"], x["k"]
        n = F.size(symbols).cast("double")
        cells = F.least(k, F.greatest(F.lit(2.0), F.floor(n / PER_CELL).cast("double")))
        cell = F.transform(symbols, lambda v: F.floor(v * cells / k).cast("int"))

        def share(c: Column) -> Column:
            return (F.ceil((c + 1) * k / cells) - F.ceil(c * k / cells)) / k

        square = F.aggregate(F.array_distinct(cell), F.lit(0.0),
                             lambda a, c: a + F.pow(F.size(F.filter(cell, lambda y: y == c)).cast("double"), 2.0) / share(c))
        free = cells - 1
        chi = F.greatest(square / n - n, F.lit(0.0))
        z1 = (F.pow(chi / free, 1.0 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        pairs = F.arrays_zip(F.slice(symbols, F.lit(1), F.size(symbols) - 1).alias("a"),
                             F.slice(symbols, F.lit(2), F.size(symbols) - 1).alias("b"))
        changes = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + ((p["a"] * 2 >= k) != (p["b"] * 2 >= k)).cast("double"))
        z2 = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        middle = (k - 1) / 2
        product = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - middle) * (p["b"] - middle))
        z3 = product / ((k * k - 1) / 12) / F.sqrt(n - 1)
        half = (z1 * z1 + z2 * z2 + z3 * z3) / 2
        return _erfc(F.sqrt(half)) + F.sqrt(half) * 1.1283791670955126 * F.exp(-half)

    one = F.array(F.struct(_symbols(run, encoding).alias("symbols"), size.alias("k")))
    return F.transform(one, tests)[0]


def candidate_spans(text: Column) -> Column:
    """array<struct<start, end, band, step>> of the runs to be judged; step grows with the p-value."""
    mixed = F.filter(_spans(text, CANDIDATE), lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]"))

    def judged(s: Column) -> Column:
        size = F.length(s["text"])
        band = F.lit(0)
        for b in BANDS:
            band = band + (size >= b).cast("int")
        log_p = F.log(F.greatest(p_value(s["text"]), F.exp(F.lit(LEAST_LOG))))
        step = F.least(F.ceil((log_p - LEAST_LOG) / -LEAST_LOG * STEPS), F.lit(STEPS)).cast("int")
        return F.struct(s["start"].alias("start"), (s["start"] + size).alias("end"), band.alias("band"), step.alias("step"))

    return F.transform(mixed, judged).cast("array<struct<start:int,end:int,band:int,step:int>>")


def rejected_steps(candidates: DataFrame, column: str) -> dict[int, int]:
    """For each band of length the highest step that the Benjamini-Hochberg rule rejects (at most one row a band)."""
    counts = candidates.select(F.explode(column).alias("c")).groupBy("c.band", "c.step").count()
    upto = Window.partitionBy("band").orderBy("step")
    whole = Window.partitionBy("band")
    p = F.exp((F.col("step") / STEPS - 1) * -LEAST_LOG)
    ranked = counts.withColumn("k", F.sum("count").over(upto)).withColumn("m", F.sum("count").over(whole))
    kept = ranked.filter(p <= LEVEL * F.col("k") / F.col("m")).groupBy("band").agg(F.max("step").alias("step"))
    return {r["band"]: r["step"] for r in kept.collect()}


def _random(judged: Column, limits: dict[int, int]) -> Column:
    """The runs that the rule doesn't reject."""
    if not limits:
        return judged
    table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    return F.filter(judged, lambda s: s["step"] > F.coalesce(F.element_at(table, s["band"]), F.lit(-1)))


def _all_spans(base: Column, random: Column) -> Column:
    """Base spans and random ones, by start and then by rule."""
    added = F.transform(random, lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), F.lit("random").alias("kind")))
    return F.array_sort(F.concat(base, added.cast(f"array<{SPAN}>")))


def _written(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _found(text: Column) -> Column:
    """struct<base, runs>: the spans of the rules, and the judged runs of what they leave of the text."""
    blank = lambda at, b: F.repeat(F.lit(" "), F.greatest(b["end"] - F.greatest(at, b["start"]), F.lit(0)))
    return _let(base_spans(text), lambda base: F.struct(
        base.alias("base"), candidate_spans(_replaced(text, base, blank)).alias("runs")))


def _free_name(df: DataFrame) -> str:
    """A column name that the table does not have."""
    taken, name = {c.lower() for c in df.columns}, "found"
    while name in taken:
        name += "_"
    return name


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of each document."""
    table = materialize(docs.select("doc_id", _found(F.coalesce("text", F.lit(""))).alias("found")))
    base = F.col("found.base")
    spans = _all_spans(base, _random(F.col("found.runs"), rejected_steps(table, "found.runs")))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    rows = table.select("doc_id", base.alias("base"), spans.alias("spans"))
    return rows.select("doc_id", *[count(k) for k, *_ in KINDS], F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                       _written(F.col("spans")).alias("spans"), count("random"))


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """`docs` with every span of its texts replaced by the mask; n_chars, where there, follows the new text."""
    name = _free_name(docs)
    table = materialize(docs.select("*", _found(F.coalesce("text", F.lit(""))).alias(name)))
    found = F.col(name)
    limits = rejected_steps(table.select(found["runs"].alias("runs")), "runs")
    # A span that begins inside an earlier one goes with it.
    fill = lambda at, s: F.when(s["start"] >= at, F.lit(mask)).otherwise(F.lit(""))
    clean = table.withColumn(name, _let(_all_spans(found["base"], _random(found["runs"], limits)), lambda spans: F.struct(
        F.size(spans).alias("n"), _replaced(F.col("text"), spans, fill).alias("text"))))
    out = {"text": found["text"]}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(found["n"] == 0, F.col("n_chars")).otherwise(F.length(found["text"]).cast(kind))
    return clean.withColumns(out).select(*docs.columns)
