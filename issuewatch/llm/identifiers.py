"""Personal data: seed entities, the lexical patterns they induce, and what these discover.

Fixed expressions find the seeds of four kinds. Every seed and every other token that looks
like an identifier (it holds a digit or an at sign) is a mention, with the words around
it. A mention's patterns are its last word on the left, its last two words on the left, and
its last word on the left with the first on the right. Patterns and instances (texts of
mentions) make a graph, which Spark scores in rounds:

* a pattern is trusted for a kind by the share of its instances that are of this kind,
  each counted by its own trust, one more instance being counted as not;
* an instance that is a seed of a kind is trusted fully, another one that could be of
  the kind by 1 - the product of (1 - trust) of its patterns.

Patterns that are trusted enough and have enough different seeds then discover: a mention
that is no seed, could be of the kind, and stands in such a pattern is added.

Each document is read once, in Arrow batches; mentions, edges and scores are tables, and
every step is a hash aggregate or an equi-join on them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialise

#: The kinds in the order of the output, and the expressions of their seeds. Possessive
#: repeats and the look-behind only save going back; the matches are those of the plain forms.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Scoring rounds, and what a pattern needs to discover: its trust in thousandths, and different seeds.
ROUNDS = 3
LEAST_TRUST, LEAST_SEEDS = 800, 5
#: Characters on either side in which the words of a pattern are looked for.
WINDOW = 48

_MARK = re.compile(r"[0-9@]")
_ENDS = " \t\n\x0b\f\r:=,;\"'<>[]{}|"
_REST = re.compile(r"[^\s:=,;\"'<>\[\]{}|]*+")
_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])*+")
_DIGIT = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: a run of local characters is taken whole, whether or not a domain follows."""
    out = []
    at = text.find("@")
    while at >= 0:
        # the run that ends at this sign; what stands before the last match is not looked at again
        low = out[-1][1] if out else 0
        begin = at
        while begin > low and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        match = EMAIL.match(text, begin) if begin < at else None
        if match and match.group(1):
            out.append(match.span())
            at = text.find("@", match.end())
        else:
            at = text.find("@", at + 1)
    return out


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind, then start."""
    found = [(0, *span) for span in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group()) if 13 <= m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return found


def could_be(text: str) -> list[int]:
    """The kinds that an unseen identifier with this text may be of: an address needs letters and
    an at sign, a host number three dots and else digits or hex letters, a card 12 to 19 digits
    and a phone number 7 to 15 with nothing but signs between."""
    digits = sum(c in "0123456789" for c in text)
    letters = sum(c.isalpha() for c in text)
    kinds = []
    if letters and "@" in text.strip("@"):
        kinds.append(0)
    if digits and text.count(".") == 3 and not re.search(r"[^0-9A-Fa-f.]", text):
        kinds.append(1)
    if 12 <= digits <= 19 and not letters and "@" not in text:
        kinds.append(2)
    if 7 <= digits <= 15 and not letters and "@" not in text:
        kinds.append(3)
    return kinds


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end): the seeds, and with kind -1 every other token that holds a digit or an
    at sign. A number goes on over single signs and blanks; a token that touches a seed is none."""
    out = list(base)
    taken = sorted((s, e) for _, s, e in base)
    at, k, n = 0, 0, len(taken)
    while mark := _MARK.search(text, at):
        low, at = at, mark.start()
        while k < n and taken[k][1] <= at:
            k += 1
        if k < n and taken[k][0] <= at:
            at = taken[k][1]
            continue
        begin = at
        while begin > low and text[begin - 1] not in _ENDS and not text[begin - 1].isspace():
            begin -= 1
        end = _REST.match(text, at).end()
        number = _NUMBER.match(text, begin)
        if number and number.end() >= end - 1:
            end = max(end, number.end())
        at = end
        if any(s < end and e > begin for s, e in taken[max(0, k - 1) : k + 1]):
            continue
        while end > begin and text[end - 1] in ".!?)" and not (text[end - 1] == ")" and "(" in text[begin:end]):
            end -= 1
        out.append((-1, begin, end))
    return out


def _edge_words(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The two words before a mention and the one behind it, in lower case ('' where there is none)."""
    before = text[max(0, start - WINDOW) : start].lower().split()
    behind = text[end : end + WINDOW].lower().split(None, 1)
    return (before[-2] if len(before) > 1 else "", before[-1] if before else "", behind[0] if behind else "")


_BASE = "array<struct<kind:int,start:int,end:int>>"
_MENTIONS = "array<struct<kind:int,start:int,end:int,value:string,kinds:array<int>,two:string,one:string,next:string>>"


def read_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, base, mentions): one row per document; `row` numbers them as long as they are stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fields = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    base_type = pa.list_(pa.struct(fields))
    mention_type = pa.list_(pa.struct([*fields, ("value", pa.string()), ("kinds", pa.list_(pa.int32())), *((c, pa.string()) for c in ("two", "one", "next"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                if not text or not _MARK.search(text):
                    base.append([])
                    found.append([])
                    continue
                spans = seeds(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                all_of = []
                for k, s, e in mentions(text, spans):
                    value, (two, one, after) = text[s:e], _edge_words(text, s, e)
                    all_of.append({"kind": k, "start": s, "end": e, "value": value, "kinds": could_be(value) if k < 0 else [k], "two": two, "one": one, "next": after})
                found.append(all_of)
            columns = [batch.column("row"), batch.column("id"), pa.array(base, base_type), pa.array(found, mention_type)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "base", "mentions"])

    return rows.mapInArrow(run, f"row long, id {kind}, base {_BASE}, mentions {_MENTIONS}")


def pattern_keys() -> Column:
    """The hashes of a mention's patterns; one without a word on the left has none."""
    one, two, after = F.col("m.one"), F.col("m.two"), F.col("m.next")
    keys = [F.xxhash64(F.lit(0), one), F.when(two != "", F.xxhash64(F.lit(1), two, one)), F.when(after != "", F.xxhash64(F.lit(2), one, after))]
    return F.when(one != "", F.array_compact(F.array(*keys)))


def graph_edges(read: DataFrame) -> DataFrame:
    """(pattern, value, kind, seed): distinct; for each kind that the value is a seed of or could be,
    and with kind null if it can be of none."""
    each = read.select(F.explode("mentions").alias("m"))
    each = each.select(pattern_keys().alias("keys"), F.xxhash64("m.value").alias("value"), F.col("m.kinds").alias("kinds"), (F.col("m.kind") >= 0).alias("seed"))
    each = each.select(F.explode("keys").alias("pattern"), "value", "kinds", "seed")
    return each.select("pattern", "value", F.explode_outer("kinds").alias("kind"), "seed").groupBy("pattern", "value", "kind").agg(F.max("seed").alias("seed"))


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, trust, seeds) after some rounds; trust in thousandths, rounded down."""
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("size"))
    known = edges.where("kind is not null")
    # only kinds with a seed can be trusted
    counts = known.where("seed").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    linked = known.join(counts, ["pattern", "kind"]).join(sizes, "pattern")
    linked = materialise(linked, "linked")
    trust = None
    for k in range(rounds):
        if trust is None:
            worth = linked.withColumn("worth", F.when(F.col("seed"), 1000).otherwise(0))
        else:
            worth = linked.join(trust, ["value", "kind"], "left")
            worth = worth.withColumn("worth", F.when(F.col("seed"), 1000).otherwise(F.coalesce("belief", F.lit(0))))
        patterns = worth.groupBy("pattern", "kind", "seeds").agg(F.sum("worth").alias("total"), F.max("size").alias("size"))
        patterns = patterns.select("pattern", "kind", "seeds", F.expr("total div (size + 1)").alias("trust"))
        patterns = materialise(patterns, "patterns")
        if k == rounds - 1:
            drop_scratch(linked)
            return patterns
        doubt = linked.where("not seed").join(patterns.select("pattern", "kind", "trust"), ["pattern", "kind"])
        doubt = doubt.groupBy("value", "kind").agg(F.sum(F.round(F.log1p(-F.col("trust") / 1001) * 1_000_000).cast("long")).alias("log"))
        trust = doubt.select("value", "kind", F.floor(1000 * (1 - F.exp(F.col("log") / 1_000_000))).alias("belief"))
    raise ValueError("there must be a round")


def discoveries(read: DataFrame, patterns: DataFrame, least_trust: int, least_seeds: int) -> DataFrame:
    """(row, added): the spans that high-confidence patterns discover, as arrays of (kind, start, end)."""
    good = patterns.where((F.col("trust") >= least_trust) & (F.col("seeds") >= least_seeds)).select("pattern", "kind", "trust")
    unseen = read.select("row", F.explode("mentions").alias("m")).where("m.kind < 0 and size(m.kinds) > 0")
    unseen = unseen.select("row", "m.start", "m.end", "m.kinds", F.explode(pattern_keys()).alias("pattern"))
    hits = unseen.join(good, "pattern").where(F.array_contains("kinds", F.col("kind")))
    best = hits.groupBy("row", "start", "end", "kind").agg(F.max("trust").alias("trust"))
    best = best.groupBy("row", "start", "end").agg(F.max(F.struct("trust", (-F.col("kind")).alias("k"))).alias("b"))
    span = F.struct((-F.col("b.k")).alias("kind"), "start", "end")
    return best.groupBy("row").agg(F.collect_list(span).alias("added"))  # at most a document's mentions


def find_identifiers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, least_trust: int = LEAST_TRUST, least_seeds: int = LEAST_SEEDS
) -> DataFrame:
    """One row per document: (`id_col`, base, added), two arrays of (kind, start, end).

    `base` holds the leftmost matches of the fixed expressions by kind, then start; spans of
    different kinds may overlap. `added` holds what the patterns discover: tokens apart from
    all base spans, each with the kind of the most trusted pattern (ties: the first kind).
    Positions are code points, the end is exclusive, kinds count from 0 in the order of `KINDS`.

    A null or empty text has no spans. Repeated rows each give a row and count once in the
    graph; null ids are kept; other columns are ignored; an empty table gives an empty result.
    """
    read = materialise(read_documents(docs, id_col, text_col), "mentions")
    patterns = score_patterns(materialise(graph_edges(read), "edges"), rounds)
    added = discoveries(read, patterns, least_trust, least_seeds)
    found = read.select("row", "id", "base").join(added, "row", "left")
    return found.select(F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast(_BASE)).alias("added"))


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of `find_identifiers`' rows: base spans a kind, checksum of them, all spans."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    counts = [F.expr(f"bigint(size(filter(base.kind, k -> k = {i})))").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    base = F.sha2(text(F.array_sort("base")).cast("binary"), 256).alias("base_sha256")
    return found.select(id_col, *counts, base, text(F.array_sort(F.concat("base", "added"))).alias("spans"))
