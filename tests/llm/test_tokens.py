import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from issuewatch.llm import tokens
from issuewatch.llm.queries import QUERIES, vocabulary

from .paths import scratch


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def encode(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def test_word_encoder_equals_the_tokenizer(tokenizer):
    texts = ["", " ", "Don't stop, it's 's", "abc<|endoftext|> x<|startoftext|>", "x ́y é", "a\x1cb\x85c d", "ÀÉ İ ǅ ß ÿŸ", "漢字かな 𝒳 🎉", "12 3.4a a___b -- ×÷", "가 ᆨ", "can't x'S ''s !'d 're's 12'm", "µ÷× café\u00a0noir", "\x7f a\x1fb"]
    for encoder in (tokens.WordEncoder(vocabulary()), tokens.WordEncoder(vocabulary(), cache_parts=2)):
        for _ in range(2):
            assert [x.tolist() for x in encoder.encode_batch([*texts, None])] == [encode(tokenizer, t) for t in [*texts, None]]


def test_query_matches_the_tokenizer(spark, tokenizer):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in QUERIES["op2_token_output"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for r in rows:
        ids = np.array(encode(tokenizer, r["text"]), "<u4")
        assert tuple(got[r["doc_id"]]) == (r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_round_trip_and_selective_reads(spark, docs, tokenizer):
    path = scratch(spark, "tokens")
    tokens.write_tokens(docs, path, vocabulary(), partitions=4)
    rows = tokens.read_tokens(spark, path).orderBy("start").collect()
    expected = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert [(r["doc_id"], r["tokens"]) for r in rows] == [(i, encode(tokenizer, t)) for i, t in expected]
    ends = np.cumsum([len(r["tokens"]) for r in rows])
    assert [r["start"] for r in rows] == [0, *ends[:-1].tolist()]
    meta = tokens.read_metadata(spark, path)
    scans = re.findall(r"ReadSchema: struct<[^>]*>", meta._jdf.queryExecution().executedPlan().toString())
    assert scans and not any("tokens:" in x.replace("n_tokens:", "") for x in scans)
    assert sorted(tuple(r) for r in meta.collect() if r["doc_id"]) == sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in rows if r["doc_id"])
    assert rows[4]["n_tokens"] > 2
    first, last = rows[4]["start"] + 1, rows[6]["start"]
    assert [r["start"] for r in tokens.read_tokens(spark, path, first, last).orderBy("start").collect()] == [rows[4]["start"], rows[5]["start"]]
    assert {r["doc_id"] for r in tokens.read_documents(spark, path, 5, 7).collect()} == {5, 6, 7}


def test_ranges_open_only_their_files_and_pages(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(0, cast(id % 7 as int)), x -> concat('w', x))) as text")
    path = scratch(spark, "tokens")
    tokens.write_tokens(docs, path, vocabulary(), partitions=5)
    rows = tokens.read_tokens(spark, path).orderBy("start").collect()
    end = rows[-1]["start"] + rows[-1]["n_tokens"]
    index = spark.read.parquet(f"{path}/index").orderBy("part").collect()
    assert len(index) == 5
    cuts = [r["base"] for r in index]
    ranges = [(a + d, b + e) for a in cuts for b in [*cuts, end] for d in (-1, 0, 1) for e in (-1, 0, 1) if (a + b + d + e) % 23 == 0]
    for first, last in [*ranges, (0, 1), (end - 1, end), (end, end + 9), (-9, 0), (7, 7), (9, 3), (None, 40), (40, None), (None, None)]:
        found = tokens.read_tokens(spark, path, first, last).orderBy("start").collect()
        low, high = -1 if first is None else first, end if last is None else last
        assert found == [r for r in rows if low < high and r["start"] + r["n_tokens"] > low and r["start"] < high], (first, last)
    some = tokens.read_tokens(spark, path, cuts[2] + 50, cuts[2] + 60)
    assert len({f for f in some.inputFiles() if "/data/" in f}) == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = some._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = "".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan))
    assert "GreaterThan(until,50)" in pushed and "LessThan(offset,60)" in pushed
    one = tokens.read_documents(spark, path, 100, 101)
    assert [r["doc_id"] for r in one.orderBy("doc_id").collect()] == [100, 101]
    assert len({f for f in one.inputFiles() if "/data/" in f}) <= 2
    assert tokens.read_documents(spark, path, 900, 901).count() == 0


def test_empty_table(spark, none):
    path = scratch(spark, "tokens")
    tokens.write_tokens(none, path, vocabulary())
    assert tokens.digests(tokens.read_tokens(spark, path)).count() == 0
    assert tokens.read_tokens(spark, path, 0, 5).count() == 0
    assert tokens.read_documents(spark, path, 0, 5).count() == 0
