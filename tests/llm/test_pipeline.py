"""The pipeline against plain Python on its own earlier stages."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from issuewatch.llm.common import materialise
from issuewatch.llm.queries import vocabulary

from .test_decontaminate import brute as brute_overlaps
from .test_decontaminate import words
from .test_simhash import brute_components, brute_fingerprint
from .test_tokens import encode

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage, and after each."""
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialise(stage(spark, frames[-1], SF), "test-stage"))
    return [f.collect() for f in frames]


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "source mixing", "token-ID output"]


def test_language_stage_rejects_only_unrecognised(stages):
    before, after = ({r["doc_id"]: r for r in s} for s in stages[:2])
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)
    assert all(r["text"] == before[i]["text"] for i, r in after.items())


def test_dedup_stage_keeps_the_first_of_each_group(stages):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in stages[1]]
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(set(brute_components(rows, 4)))


def test_decontamination_stage_drops_exactly_the_overlaps(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {tuple(w[k : k + 5]) for _, t in items for w in [words(t)] for k in range(len(w) - 4)}
    near = [(r["doc_id"], r["text"]) for r in stages[2] if any(tuple(w[k : k + 5]) in grams for w in [words(r["text"])] for k in range(len(w) - 4))]
    gone = {d for d, _ in brute_overlaps(near, items)}
    assert {r["doc_id"] for r in stages[3]} == {r["doc_id"] for r in stages[2]} - gone


def test_mixing_stage_repeats_whole_rows(stages):
    known = set(stages[3])
    assert set(stages[4]) <= known
    assert max(stages[4].count(r) for r in set(stages[4])) <= corpus_pipeline.MIX_MAX_EPOCHS


def test_token_stage_and_run(spark, stages):
    tokenizer = Tokenizer.from_file(vocabulary())
    start, expected = 0, []
    for r in sorted(stages[4], key=lambda r: r["doc_id"]):
        ids = np.array(encode(tokenizer, r["text"]), "<u4")
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages[5])) == expected
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == expected
