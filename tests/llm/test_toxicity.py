import zlib

import numpy as np

from issuewatch.llm import toxicity
from issuewatch.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert len(got) == 10_000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) >= 0.96 * len(held)
    assert sum(a and b for a, b in held) >= 0.75 * sum(a for a, _ in held)


def test_learns_a_pair_that_no_linear_weights_can():
    """Label 1 only where both or neither of two terms are there."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(800):
        a, b = rng.integers(0, 2, 2)
        index = np.array([i for i, on in enumerate((a, b)) if on] + [2], np.int64)
        rows.append((index, np.ones(len(index))))
        labels.append(float(a == b))
    model = toxicity.train(rows, np.array(labels), np.arange(3))
    wrong = sum((model.score(i, v) >= 0.5) != bool(y) for (i, v), y in zip(rows, labels, strict=True))
    assert wrong == 0


def test_edge_rows(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (7, None), (None, 1), (8, 0), (99, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert all(r["predicted"] == 0 for r in toxicity.score_toxicity(docs, labels.limit(0)).collect())
