"""Secrets by form and by a battery of randomness tests, in DataFrame functions only.

Named assignments, access keys and long hexadecimal runs are found by form. Every other
long run of encoding characters is a candidate. Its alphabet is inferred (hexadecimal and
alphanumeric of either case, base32, base64), and three tests ask whether it could be a
uniform random string over that alphabet: chi-squared of the character counts, runs above and
below the middle of the alphabet, and serial correlation of neighbours. Tokens made by people
fail at least one. Within each class of length, Benjamini and Hochberg's rule decides which
candidates are rejected as not random while controlling the share of false rejections; those
it cannot reject, and which carry enough bits, are added to the secrets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, spans_text

KINDS = ("assign", "access", "hex")
FOUND = "random"

# Group 2 of an assignment has to have 12 characters or more, checked after matching.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the whole run: its end is where the run ends
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

# The characters of each encoding in the order of their values.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "base16": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "lower36": DIGITS + LOWER,
    "upper36": DIGITS + UPPER,
    "base64": UPPER + LOWER + DIGITS + "+/",
}
LENGTHS = (24, 32, 48)  # borders of the classes of length


def matches(text: Column, pattern: str) -> Column:
    """[(start, end, match)] of the leftmost non-overlapping matches, in code points.

    A text without a match is looked through once. Else the text between matches gives the
    offsets.
    """
    p = F.lit(pattern)
    found, between = F.regexp_extract_all(text, p, F.lit(0)), F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(between, 1, F.size(found)), found,
                       lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,end:int,hit:string>>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), x["hit"].alias("hit")))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(sizes, start, step, lambda acc: acc["out"])
                  ).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def of_kind(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
        m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """[(start, rank, kind, end)] of the spans found by form, by start, then kind."""
    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(
        F.regexp_extract(m["hit"], ASSIGN, 2)) >= 12)
    return F.array_sort(F.concat(
        of_kind(assign, "assign", 0), of_kind(matches(text, ACCESS), "access", 1),
        of_kind(matches(text, HEX), "hex", 2)))


def encoding(token: Column) -> Column:
    """Name of the narrowest alphabet; null for what no encoder writes (one class of
    characters alone, such as words and numbers)."""
    digit, lower, upper = token.rlike("[0-9]"), token.rlike("[a-z]"), token.rlike("[A-Z]")
    return (F.when(token.rlike("^[0-9a-f]+$") & digit & lower, "hex")
            .when(token.rlike("^[0-9A-F]+$") & digit & upper, "base16")
            .when(token.rlike("^[A-Z2-7]+$") & digit & upper, "base32")
            .when(token.rlike("^[a-z0-9]+$") & digit & lower, "lower36")
            .when(token.rlike("^[A-Z0-9]+$") & digit & upper, "upper36")
            .when(token.rlike("^[A-Za-z0-9+/]+$") & digit & lower & upper, "base64"))


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, to 8e-8 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (
        -1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def with_tests(tokens: DataFrame) -> DataFrame:
    """`tokens` (.., token) of a known encoding with `bits` and the combined `p`.

    Three tests, so p is three times the least of their p-values (1 at most).
    """
    plain = F.rtrim(F.translate("token", "-_=", "+/ "))
    df = (tokens.withColumn("_plain", plain).withColumn("_code", encoding(F.col("_plain")))
          .where(F.col("_code").isNotNull()))
    alphabet = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    df = df.withColumn("_letters", alphabet[F.col("_code")])
    df = df.withColumn("_v", F.transform(
        F.split("_plain", ""), lambda c: F.instr(F.col("_letters"), c) - 1))
    n, k = F.length("_plain").cast("double"), F.length("_letters").cast("double")

    def total(values: Column, of) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + of(x))

    # chi-squared, made normal by Wilson and Hilferty's cube root
    counts = F.transform(F.array_distinct("_v"), lambda v: F.size(
        F.filter("_v", lambda x: x == v)).cast("double"))
    chi = k / n * total(counts, lambda c: c * c) - n
    df = df.withColumn("_n", n).withColumn("_k", k).withColumn("_chi", chi)
    spread = 2 / (9 * (F.col("_k") - 1))
    df = df.withColumn("_p1", normal_tail(
        (F.pow(F.greatest(F.col("_chi"), F.lit(0.0)) / (F.col("_k") - 1), F.lit(1 / 3))
         - (1 - spread)) / F.sqrt(spread)))
    # runs of characters in the same half of the alphabet
    df = df.withColumn("_pairs", F.zip_with(
        F.slice("_v", 1, F.size("_v") - 1), F.slice("_v", 2, F.size("_v") - 1),
        lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))))
    half = F.col("_k") / 2
    high = total(F.col("_v"), lambda v: F.when(v >= half, 1.0).otherwise(0.0))
    runs = total(F.col("_pairs"), lambda x: F.when(
        (x["a"] >= half) != (x["b"] >= half), 1.0).otherwise(0.0)) + 1
    df = df.withColumn("_high", high).withColumn("_runs", runs)
    both = 2 * F.col("_high") * (F.col("_n") - F.col("_high"))
    mean = both / F.col("_n") + 1
    variance = both * (both - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    df = df.withColumn("_p2", F.when(variance > 0, 2 * normal_tail(
        F.abs(F.col("_runs") - mean) / F.sqrt(variance))).otherwise(0.0))
    # serial correlation of neighbours, about normal with mean -1/n and variance 1/n
    average = total(F.col("_v"), lambda v: v.cast("double")) / F.col("_n")
    df = df.withColumn("_mean", average)
    square = total(F.col("_v"), lambda v: (v - F.col("_mean")) * (v - F.col("_mean")))
    product = total(F.col("_pairs"), lambda x: (x["a"] - F.col("_mean"))
                    * (x["b"] - F.col("_mean")))
    df = df.withColumn("_r", F.when(square > 0, product / square))
    df = df.withColumn("_p3", F.coalesce(2 * normal_tail(F.abs(
        (F.col("_r") + 1 / F.col("_n")) * F.sqrt("_n"))), F.lit(0.0)))
    p = F.least(F.lit(1.0), 3 * F.least("_p1", "_p2", "_p3"))
    return df.select(*tokens.columns, (F.col("_n") * F.log2("_k")).alias("bits"), p.alias("p"))


def length_class(token: Column) -> Column:
    return sum(((F.length(token) >= border).cast("int") for border in LENGTHS), F.lit(0))


def rejected_below(tested: DataFrame, rate: float, steps: int = 20, deepest: int = 15
                   ) -> list[float]:
    """For each class of length the p-value up to which the rule rejects (0: none).

    The step-up rule is run on counts per class and 1/steps of a power of ten, at most
    steps * deepest rows a class; a step counts by its larger end, so it rejects no more
    than the rule on every single value would.
    """
    step = F.least(F.lit(steps * deepest), F.floor(-F.log10(F.greatest(
        F.col("p"), F.lit(10.0 ** -deepest))) * steps)).cast("int")
    counted = (tested.select(length_class(F.col("token")).alias("size"), step.alias("step"))
               .groupBy("size", "step").agg(F.count("*").alias("n")))
    up = Window.partitionBy("size").orderBy(F.desc("step"))
    ranked = counted.withColumn("rank", F.sum("n").over(up)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("size")))
    value = F.pow(F.lit(10.0), -F.col("step") / steps)
    cut = (ranked.where(value <= rate * F.col("rank") / F.col("all"))
           .groupBy("size").agg(F.max(value).alias("cut")).collect())  # one row per class
    found = {r["size"]: r["cut"] for r in cut}
    return [found.get(i, 0.0) for i in range(len(LENGTHS) + 1)]


def scan(docs: DataFrame, rate: float = 0.05, least_bits: float = 90.0) -> DataFrame:
    """(doc_id, base, added) of each row: spans (start, rank, kind, end) in code points.

    `base` is by start, then kind; `added` holds the candidates that pass as random and
    overlap no base span. A null or empty text has none; repeated rows are judged each;
    other columns are ignored; an empty table gives no rows.
    """
    text = F.col("text")
    parts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", base_spans(text).alias("base"), matches(text, CANDIDATE).alias("found"))
    parts = checkpointed(parts.withColumn("found", F.filter(
        "found", lambda c: ~F.exists("base", lambda s: (s["start"] < c["end"])
                                     & (c["start"] < s["end"]))))
        .withColumn("row", F.monotonically_increasing_id()))
    tokens = parts.select("row", F.explode("found").alias("c")).select(
        "row", "c.start", "c.end", F.col("c.hit").alias("token"))
    tested = checkpointed(with_tests(tokens))
    cuts = F.array(*[F.lit(c) for c in rejected_below(tested, rate)])
    passed = tested.where((F.col("p") > F.get(cuts, length_class(F.col("token"))))
                          & (F.col("bits") >= least_bits))
    added = passed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("rank"), F.lit(FOUND).alias("kind"), "end")))
        .alias("added"))
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return (parts.drop("found").join(added, "row", "left")
            .select("doc_id", "base", F.coalesce("added", empty).alias("added")))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256 and spans of `scan`."""
    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(every).alias("spans"))
