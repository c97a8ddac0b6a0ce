import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from issuewatch.llm import identifiers

NAMES = ("email", "ip", "card", "phone")


def plain_base(text):
    """The base rules as they are written, without any short cut."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def brute(texts, rounds=3, least_trust=800, least_seeds=5):
    """Base and added spans of every text, the graph held in dictionaries."""
    found = []
    for text in texts:
        base = plain_base(text or "")
        each = []
        for kind, s, e in identifiers.mentions(text or "", base):
            before = (text[max(0, s - 48) : s]).lower().split()
            after = text[e : e + 48].lower().split()[:1]
            keys = []
            if before:
                keys = [(0, before[-1])] + [(1, *before[-2:])] * (len(before) > 1) + [(2, before[-1], *after)] * len(after)
            each.append((kind, s, e, text[s:e], identifiers.could_be(text[s:e]) if kind < 0 else [kind], keys))
        found.append((base, each))
    size, seed, maybe = defaultdict(set), defaultdict(set), defaultdict(set)
    for _, each in found:
        for kind, _, _, value, kinds, keys in each:
            for key in keys:
                size[key].add(value)
                for k in kinds:
                    (seed if kind >= 0 else maybe)[key, k].add(value)
    belief = {}
    for r in range(rounds):
        trust = {}
        for (key, k), values in seed.items():
            total = 1000 * len(values) + sum(belief.get((v, k), 0) for v in maybe[key, k] - values)
            trust[key, k] = total // (len(size[key]) + 1)
        logs = defaultdict(int)
        for (key, k), t in trust.items():
            for v in maybe[key, k] - seed[key, k]:
                logs[v, k] += round(math.log1p(-t / 1001) * 1_000_000)
        belief = {at: math.floor(1000 * (1 - math.exp(x / 1_000_000))) for at, x in logs.items()}
    out = []
    for base, each in found:
        added = []
        for kind, s, e, _, kinds, keys in each:
            best = [(trust[key, k], -k) for key in keys for k in kinds if kind < 0 and trust.get((key, k), 0) >= least_trust and len(seed[key, k]) >= least_seeds]
            if best:
                added.append((-max(best)[1], s, e))
        out.append((base, added))
    return out


def line(spans):
    return ",".join(f"{NAMES[k]}:{s}:{e}" for k, s, e in sorted(spans))


def expected(rows):
    out = []
    for (doc_id, _), (base, added) in zip(rows, brute([t for _, t in rows]), strict=True):
        counts = [sum(k == i for k, _, _ in base) for i in range(4)]
        out.append((doc_id, *counts, hashlib.sha256(line(base).encode()).hexdigest(), line(base + added)))
    return sorted(out, key=repr)


def result(docs):
    return sorted((tuple(r) for r in identifiers.span_digest(identifiers.find_identifiers(docs)).collect()), key=repr)


def card(draw):
    digits = "".join(draw.choice("0123456789") for _ in range(15))
    return next(digits + c for c in "0123456789" if identifiers.luhn(digits + c))


def letters(draw):
    """Texts whose contexts name the kind, some with identifiers that no base rule finds."""
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8)))
    texts = []
    for k in range(400):
        number = draw.randrange(1000, 9999)
        made = [
            f"please write to {word()}.{number}@mail{k % 7}.example.com today",
            f"please write to {word()}{number}@intranet today",
            f"call me at +1 ({draw.randrange(200, 999)}) 555-{number} or later",
            f"call me at 555-{number} or later",
            f"login from host {draw.randrange(256)}.{draw.randrange(256)}.1.{draw.randrange(256)} was seen",
            f"login from host 10.c{number % 97:x}.1.{number} was seen",
            f"paid with card: {card(draw)}.",
            f"paid with card: {number}.{number}.{draw.randrange(1000, 9999)}.{number}!",
            f"the {word()} of {number} and version {k % 9}.0, order {draw.randrange(10**7, 10**9)} came",
            f"the {word()} of the {word()}",
        ]
        texts.append(" ".join(word() for _ in range(draw.randrange(5))) + " " + "\n".join(draw.sample(made, draw.randrange(1, 4))))
    return texts


def test_patterns_discover_unseen_identifiers(spark):
    texts = letters(random.Random(4))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = result(docs)
    assert got == expected(rows)
    spans = {r[0]: r[-1] for r in got}
    unseen = {"email": "@intranet", "phone": "at 555-", "ip": r"host 10\.c", "card": r"card: \d{4}\.\d{4}\."}
    for kind, mark in unseen.items():
        holds = [i for i, t in rows if re.search(mark, t)]
        assert len(holds) > 20
        # a context of another kind is not taken, a clean text has none
        more = [i for i in holds if spans[i].count(f"{kind}:") > sum(k == NAMES.index(kind) for k, _, _ in plain_base(texts[i]))]
        assert len(more) == len(holds), kind
    clean = [i for i, t in rows if not re.search(r"@|\+1|\d\.\d|host|555-|card", t)]
    assert clean and all(spans[i] == "" for i in clean)


def test_base_rules_equal_the_plain_expressions():
    draw = random.Random(9)
    odd = "aZ09.@+-() %_é٣:=,\n"
    for k in range(30000):
        text = "".join(draw.choice(odd if k % 2 else "0123456789.-+ @a") for _ in range(draw.randrange(60)))
        assert identifiers.seeds(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "a." * 150_000, "1" * 300_000, "1.1.1." * 50_000, "@" * 300_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000, "(" * 300_000 + "1"])
def test_long_texts_are_read_in_one_go(text):
    spans = identifiers.seeds(text)
    identifiers.mentions(text, spans)


def test_query_rows_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == expected(rows)


def test_edge_rows(spark, docs, none):
    more = spark.createDataFrame([(11, "mail x@y.z"), (11, "mail x@y.z"), (12, "\U0001f389 a1@b.cc +49 (30) 1234567."), (None, "1.2.3.4")], "doc_id long, text string")
    both = docs.select("doc_id", "text", F.lit("k").alias("kind"), F.lit(1).alias("row")).unionByName(more.selectExpr("*", "'q' as kind", "2 as row"))
    rows = [(r.doc_id, r.text) for r in both.collect()]
    assert result(both) == expected(rows)
    assert result(none) == [] and result(docs.where("text is null"))[0][-1] == ""
