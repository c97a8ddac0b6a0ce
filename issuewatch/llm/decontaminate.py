"""Benchmark decontamination with spaced seeds.

A fixed mask lays over a window of words and ignores some of its positions, so a copy
with substituted words still agrees with the original on many masked windows. Seeds
(mask, hash of the words it keeps) of the benchmark meet those of the documents; around
each hit the two texts are compared word by word, and an overlap counts if it is long
enough and at least four of five of its words are equal.

Words are lower-cased runs of letters, marks and digits, each a 64-bit hash.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

WORD = r"[\p{L}\p{M}\p{N}]+"
#: 1: the position counts, 0: any word may stand there. With the four of them each stretch of 13
#: words agrees on some window whichever two of its words are changed.
MASKS = ("11101001101", "11010110011", "10110011101", "11111101")
#: An overlap has this many words, or the whole item if that is shorter.
MIN_OVERLAP = 13
#: Benchmark seeds up to this count are broadcast, at about 40 bytes each; more are joined by a
#: shuffle of the documents' (id, position, seed) alone, and the words of documents with a
#: hit are read a second time.
MAX_BROADCAST_SEEDS = 2_000_000


def word_hashes(text: Column) -> Column:
    """The words of a text (null: none) as an array of longs."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)
    return F.transform(found, lambda w: F.xxhash64(w))


def covering_masks(n: int) -> list[str]:
    """Masks for an item of `n` words; with up to `n // 5` words changed, one agrees at least.

    The words are dealt to two blocks more than may change, and each choice of blocks that
    could hold all changes is left out once. Where none may change, one mask keeps all.
    """
    changes = n // 5
    blocks = changes + 2 if changes else 1
    block_of = [k * blocks // n for k in range(n)]
    return ["".join("0" if b in out else "1" for b in block_of) for out in combinations(range(blocks), changes)]


def masks_for(short_lengths: list[int]) -> list[str]:
    """The fixed masks, then covering ones for each item length up to the least overlap."""
    return [*MASKS, *(m for n in sorted(set(short_lengths)) for m in covering_masks(n))]


def seeds(rows: DataFrame, masks: list[str], whole: bool) -> DataFrame:
    """`rows` (with an array `h`) exploded to (pos, seed, span) for each mask and window.

    `whole`: masks but the fixed ones are laid over arrays of just their length only.
    """
    placed = rows.select("*", F.posexplode("h").alias("pos", "w0")).drop("w0")
    keyed = []
    for i, mask in enumerate(masks):
        fits = F.size("h") - F.col("pos") >= len(mask)
        if whole and i >= len(MASKS):
            fits = (F.size("h") == len(mask)) & (F.col("pos") == 0)
        kept = [F.get("h", F.col("pos") + k) for k, bit in enumerate(mask) if bit == "1"]
        keyed += [F.when(fits, F.xxhash64(F.lit(i), *kept)), F.lit(len(mask))]
    return placed.select("*", F.stack(F.lit(len(masks)), *keyed).alias("seed", "span")).where("seed is not null")


def best_stretch(equal: Column, need: Column) -> Column:
    """(best, lo, hi): of the stretches of a boolean array with at least `need` elements and
    four of five true, the one with most true; best is 0 if there is none, `hi` exclusive.

    With 4 for each element and -5 for each true one summed up to a place, a stretch fits if
    the sum at its end is no higher than at its start. `firsts` has at k the first place
    with a sum of k or more, which starts the longest stretch to an end with sum k.
    """
    start_of = lambda i, e: F.struct(i.alias("i"), e.alias("e"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("e"), F.array(start_of(F.lit(0), F.lit(0))).alias("firsts"), *[F.lit(0).alias(x) for x in ("best", "lo", "hi")])

    def step(acc: Column, x: Column) -> Column:
        i, e, firsts = acc["i"] + 1, acc["e"] + F.when(x, 1).otherwise(0), acc["firsts"]
        total, known = 4 * i - 5 * e, F.size(firsts)
        start = F.when(total < known, F.get(firsts, F.greatest(total, F.lit(0)))).otherwise(start_of(i, e))
        better = (i - start["i"] >= need) & (e - start["e"] > acc["best"])
        firsts = F.when(total < known, firsts).otherwise(F.concat(firsts, F.array_repeat(start_of(i, e), total - known + 1)))
        best = [F.when(better, new).otherwise(acc[x]).alias(x) for x, new in (("best", e - start["e"]), ("lo", start["i"]), ("hi", i))]
        return F.struct(i.alias("i"), e.alias("e"), firsts.alias("firsts"), *best)

    return F.aggregate(equal, zero, step, lambda acc: F.struct(acc["best"].alias("best"), acc["lo"].alias("lo"), acc["hi"].alias("hi")))


def narrow_hits(rows: DataFrame, planted: DataFrame, masks: list[str]) -> DataFrame:
    """The windows of `rows` (id, h) that share a seed with `planted`, each with its words. Only
    (id, digest of the words, position, seed) is shuffled to the seeds."""
    marked = rows.withColumn("g", F.xxhash64("h"))
    windows = seeds(marked, masks, whole=False).select("id", "g", "pos", "seed")
    hits = materialise(windows.join(planted, "seed").select("id", "g", "pos", "item", "item_at", "size").distinct(), "hits")
    held = hits.select(F.col("id").alias("__id"), F.col("g").alias("__g")).distinct()
    held = F.broadcast(held) if held.count() <= MAX_BROADCAST_SEEDS else held
    words = marked.join(held, F.col("id").eqNullSafe(F.col("__id")) & (F.col("g") == F.col("__g")), "left_semi")
    words = words.select(F.col("id").alias("__id"), F.col("g").alias("__g"), "h").distinct()
    return hits.join(words, F.col("id").eqNullSafe(F.col("__id")) & (F.col("g") == F.col("__g"))).drop("__id", "__g", "g")


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document and benchmark item whose words overlap.

    Columns: `id_col`, `item_col`, doc_pos, item_pos (first word of the best overlap),
    n_words (its length) and n_equal (words that agree). Items with equal words are one
    class and named by their smallest id. Of several overlaps of a pair the one with most
    equal words is returned, then the earliest.

    Null, empty and wordless texts never match, on either side; items up to `MIN_OVERLAP`
    words match as a whole, those under 5 words by exactly their words. Repeated rows and
    rows that share an id are one document. Null ids are kept as an id of their own.
    Other columns are ignored; an empty table gives an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("h"))
    items = materialise(items.where(F.size("h") > 0).groupBy("h").agg(F.min("item").alias("item")), "items")
    lengths = items.select(F.size("h").alias("n")).where(F.col("n") <= MIN_OVERLAP).distinct()
    masks = masks_for([r["n"] for r in lengths.collect()])  # at most MIN_OVERLAP lengths
    planted = seeds(items, masks, whole=True).select("seed", "item", F.col("pos").alias("item_at"), F.size("h").alias("size"))
    planted = materialise(planted, "seeds")
    few = planted.count() <= MAX_BROADCAST_SEEDS
    rows = docs.select(F.col(id_col).alias("id"), word_hashes(F.col(text_col)).alias("h"))
    if few:
        near = seeds(rows, masks, whole=False).join(F.broadcast(planted.select("seed").distinct()), "seed", "left_semi")
        hits = near.join(F.broadcast(planted), "seed")
    else:
        hits = narrow_hits(rows, planted, masks)
    # the document's words beside the item's, from the first to the last that both have
    cut, doc_cut = F.greatest(F.lit(0), F.col("item_at") - F.col("pos")), F.greatest(F.lit(0), F.col("pos") - F.col("item_at"))
    length = F.least(F.size("h") - doc_cut, F.col("size") - cut)
    beside = hits.select("id", "item", cut.alias("cut"), doc_cut.alias("doc_cut"), F.slice("h", doc_cut + 1, length).alias("part")).distinct()
    equal = F.zip_with("part", F.slice("h", F.col("cut") + 1, F.size("part")), lambda a, b: a == b)
    beside = beside.join(items, "item").select("id", "item", "cut", "doc_cut", F.size("h").alias("size"), equal.alias("equal"))
    need = F.least(F.lit(MIN_OVERLAP), "size")
    found = beside.withColumn("need", need).withColumn("s", best_stretch(F.col("equal"), F.col("need"))).where("s.best > 0")
    # unequal words at the ends do not count, down to the least length
    found = found.withColumn("stretch", F.slice("equal", F.col("s.lo") + 1, F.col("s.hi") - F.col("s.lo")))
    ends = lambda x: (F.array_position(x, True) - 1).cast("int")
    found = found.withColumn("head", F.least(ends(F.col("stretch")), F.size("stretch") - F.col("need")))
    found = found.withColumn("n", F.size("stretch") - F.col("head"))
    found = found.withColumn("n", F.col("n") - F.least(ends(F.reverse("stretch")), F.col("n") - F.col("need")))
    lo = F.col("s.lo") + F.col("head")
    found = found.select("id", "item", (F.col("doc_cut") + lo).alias("doc_pos"), (F.col("cut") + lo).alias("item_pos"), "n", F.col("s.best").alias("n_equal"))
    best = F.max(F.struct("n_equal", (-F.col("doc_pos")).alias("d"), (-F.col("item_pos")).alias("i"), "n"))
    return (
        found.groupBy("id", "item")
        .agg(best.alias("b"))
        .select(
            F.col("id").alias(id_col),
            F.col("item").alias(item_col),
            (-F.col("b.d")).alias("doc_pos"),
            (-F.col("b.i")).alias("item_pos"),
            F.col("b.n").alias("n_words"),
            F.col("b.n_equal").alias("n_equal"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without an overlap with the benchmark (null ids are one id)."""
    found = find_overlaps(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["__id"]), "left_anti")
