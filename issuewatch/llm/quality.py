"""Quality rules with thresholds learnt per language and source.

Fixed rules judge a text alone (`base`). The others compare four ratios of a text with
its language and source: each ratio's quantiles come from a mergeable sketch, a
histogram whose bins keep the leading `SUB_BITS` bits of a value (relative error below
2**-SUB_BITS). Sketches merge by adding counts, so a small group borrows the sketch of
its language, or of everything. All of it is integer arithmetic: equal results on any
partitioning.

A fence lies some spreads outside the quartiles, and the spread too is learnt. Every text
has a word length, so there it is the interquartile range. Most texts have no symbols or
repeats, so there it is the lower quartile of those that have some (the upper ones may be
noise), less where these are few. A group's spread is drawn towards its language's, the
more the smaller the group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Words in a window, for repeated passages within one text.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SUB_BITS = 6
#: Documents that a group needs for quartiles of its own.
MIN_GROUP = 100
#: Documents that a language's spread weighs as much as, beside the group's own.
PRIOR = 50
#: Under one text in `RARE` with a ratio above 0, the lower quartile of these shrinks in
#: proportion.
RARE = 50
#: Ratios of a text, scaled to integers: (name, numerator, denominator, scale, spreads
#: from a quartile to its fence, whether small values fail too).
RATIOS = (
    ("word_length", "word_chars", "n_words", 1000, 4, True),
    ("symbols", "n_symbols", "word_chars", 10_000, 3, False),
    ("dup_lines", "n_dup_lines", "n_lines", 10_000, 3, False),
    ("repeats", "n_repeat_words", "n_words", 10_000, 3, False),
)


def repeat_words() -> Column:
    """Words in windows that occur twice or more, from the column `s` of `base_counts`: the
    sorted (hash, position) pairs of a text's windows, null where none repeats."""
    n = F.size("s")
    at = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.when((F.get("s", j)["x"] == F.get("s", j - 1)["x"]) | (F.get("s", j)["x"] == F.get("s", j + 1)["x"]), F.get("s", j)["i"]),
    )
    at = F.array_sort(F.filter(at, lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        at, zero, lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n")), lambda acc: acc["n"]
    )
    return F.when(F.col("s").isNull(), 0).otherwise(covered).cast("long")


def base_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0).alias("lines"),
        F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)).alias("h"),
    )
    last = F.size("h") - WINDOW
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("w", F.when(last > 0, windows))
    pairs = F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("s", F.when(F.size("w") > F.size(F.array_distinct("w")), pairs))
    n_lines = F.size("lines").cast("long")
    return rows.select(
        "id",
        "lang",
        "source",
        F.size("h").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeat_words().alias("n_repeat_words"),
    )


def bin_of(value: str) -> str:
    """SQL: the sketch bin of a non-negative integer; order-preserving."""
    e = f"(length(bin({value})) - {SUB_BITS + 1})"
    return f"case when {value} < {2 << SUB_BITS} then {value} else {1 << SUB_BITS} * {e} + shiftright({value}, {e}) end"


def floor_of(b: str) -> str:
    """SQL: the least value of a bin."""
    e = f"cast(greatest({b} div {1 << SUB_BITS} - 1, 0) as int)"
    return f"shiftleft({b} - {1 << SUB_BITS} * {e}, {e})"


def sketches(ratios: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n) over the rows of (lang, source, <ratio names>)."""
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("ratio"), F.expr(f"cast({bin_of(r[0])} as long)").alias("bin")) for k, r in enumerate(RATIOS)]))
    return ratios.select("lang", "source", each).groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n"))


def quartiles(bins: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, size, q1, q3, spread) of the sketch rows of each group."""
    merged = bins.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    merged = merged.withColumn("size", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("bin")))
    merged = merged.withColumn("zeros", F.sum(F.expr("if(bin = 0, n, 0L)")).over(group))
    found = merged.groupBy(*keys, "ratio").agg(
        F.max("size").alias("size"),
        F.max("zeros").alias("zeros"),
        F.expr("min(case when 4 * upto >= size then bin end)").alias("b1"),
        F.expr("min(case when 4 * upto >= 3 * size then bin end)").alias("b3"),
        F.expr("coalesce(min(case when bin > 0 and 4 * (upto - zeros) >= size - zeros then bin end), 0L)").alias("some"),
    )
    found = found.select(*keys, "ratio", "size", "zeros", *[F.expr(floor_of(b)).alias(q) for b, q in (("b1", "q1"), ("b3", "q3"), ("some", "usual"))])
    two_sided = F.col("ratio").isin([k for k, r in enumerate(RATIOS) if r[5]])
    spread = F.when(two_sided, F.col("q3") - F.col("q1")).otherwise(F.expr(f"usual * least(size, {RARE} * (size - zeros)) div size"))
    return found.select(*keys, "ratio", "size", "q1", "q3", spread.alias("spread"))


def fences(bins: DataFrame) -> DataFrame:
    """(lang, source, lo_<ratio>, hi_<ratio> ...): one row per language and source."""

    def widest(keys: list[str], tag: str) -> DataFrame:
        q = quartiles(bins, keys)
        return q.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.col("ratio").alias(f"{tag}_ratio"), *[F.col(c).alias(f"{tag}_{c}") for c in ("size", "q1", "q3", "spread")])

    own, lang, every = widest(["lang", "source"], "a"), widest(["lang"], "b"), widest([], "c")
    found = own.join(lang, F.col("a_lang").eqNullSafe(F.col("b_lang")) & (F.col("a_ratio") == F.col("b_ratio"))).join(every, F.col("a_ratio") == F.col("c_ratio"))
    pick = lambda q: F.when(F.col("a_size") >= MIN_GROUP, F.col(f"a_{q}")).when(F.col("b_size") >= MIN_GROUP, F.col(f"b_{q}")).otherwise(F.col(f"c_{q}"))
    found = found.withColumn("typical", F.when(F.col("b_size") >= MIN_GROUP, F.col("b_spread")).otherwise(F.col("c_spread")))
    found = found.withColumn("drawn", F.expr(f"(a_size * a_spread + {PRIOR} * typical) div (a_size + {PRIOR})"))
    found = found.select(F.col("a_lang").alias("f_lang"), F.col("a_source").alias("f_source"), F.col("a_ratio").alias("ratio"), pick("q1").alias("q1"), pick("q3").alias("q3"), "drawn", "typical", "c_spread")
    out = []
    for k, (name, _, _, _, reach, both) in enumerate(RATIOS):
        # a group or language of copies has no range of its own
        spread = reach * (F.greatest("drawn", "typical", "c_spread") if both else F.col("drawn"))
        out.append(F.max(F.when(F.col("ratio") == k, F.col("q3") + spread)).alias(f"hi_{name}"))
        if both:
            out.append(F.max(F.when(F.col("ratio") == k, F.col("q1") - spread)).alias(f"lo_{name}"))
    return found.groupBy("f_lang", "f_source").agg(*out)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: (`id_col`, the base counts, base_failed, kept).

    `base_failed`: under `MIN_WORDS` words, or over `MAX_REPEAT_PERCENT` percent of them in
    repeated windows. `kept`: passes the base rules, and no ratio lies outside the fences
    of the document's language and source, which are learnt from the documents that pass
    the base rules. The fences lie outside the quartiles, so a group in which many
    documents look alike loses none of them.

    Null and empty texts have no words and fail. A null language or source is a group of
    its own. Repeated rows each give a row; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = base_counts(docs, id_col, text_col, lang_col, source_col)
    rows = materialise(rows, "counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    ratios = [F.expr(f"case when {d} = 0 then 0L else {scale} * {n} div {d} end").alias(name) for name, n, d, scale, _, _ in RATIOS]
    rows = rows.select("*", *ratios)
    bins = materialise(sketches(rows.where(~F.col("base_failed"))), "sketches")
    limits = fences(bins)
    inside = ~F.col("base_failed")
    for name, _, _, _, _, both in RATIOS:
        inside = inside & (F.col(name) <= F.col(f"hi_{name}"))
        if both:
            inside = inside & (F.col(name) >= F.col(f"lo_{name}"))
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select(F.col("id").alias(id_col), *counts, "base_failed", F.coalesce(inside, F.lit(False)).alias("kept"))
