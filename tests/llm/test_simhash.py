import random

import pytest
import xxhash

from issuewatch.llm import simhash
from issuewatch.llm.queries import QUERIES


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(pairs, max_bits):
    """id -> smallest id over links, by comparing all pairs."""
    ids = [i for i, _ in pairs]
    label = list(range(len(pairs)))
    for _ in pairs:
        before = list(label)
        for a in range(len(pairs)):
            for b in range(len(pairs)):
                if (pairs[a][1] ^ pairs[b][1]).bit_count() <= max_bits:
                    label[a] = min(label[a], label[b])
        if before == label:
            break
    return [min((ids[k] for k in range(len(ids)) if label[k] == x and ids[k] is not None), default=None) for x in label]


def test_fingerprint_matches_brute_force():
    draw = random.Random(3)
    texts = [" ".join(draw.choice("aB cé dd\teee") for _ in range(n)) for n in (0, 1, 3, 5, 20, 700)] + [None, "one", "a b c", "a\x1cb c d e", "Ä b c d"]
    assert [simhash.fingerprint(t, 4) for t in texts] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("blocks", [5, 6, 7, 9])
def test_every_close_pair_shares_a_key(spark, blocks):
    draw = random.Random(blocks)
    base = [draw.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for fp in base:
        for bits in range(1, 7):
            fps.add(fp ^ sum(1 << k for k in draw.sample(range(64), bits)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.close_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, blocks).collect()
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert {tuple(r) for r in got} == expected


def test_blocks_follow_the_count():
    assert simhash.blocks_for(10, 4) == 6
    assert simhash.blocks_for(10**9, 4) > 6
    with pytest.raises(ValueError):
        simhash.block_masks(4, 4)


def test_components_match_brute_force_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in rows], 4)
    got = {r["doc_id"]: r for r in QUERIES["op1_simhash_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r, component in zip(rows, expected, strict=True):
        assert got[r["doc_id"]]["component_id"] == component
        assert got[r["doc_id"]]["fingerprint"] == f"{brute_fingerprint(r['text']):016x}"


def test_edge_rows(docs, none):
    got = simhash.simhash_near_dedup(docs).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert by_id[1]["fingerprint"] == "0" * 16
    assert by_id[5]["component_id"] == 4 and by_id[None]["component_id"] is None
    assert simhash.simhash_near_dedup(none).count() == 0


def test_keep_one(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 6, 7, 8]
    assert simhash.keep_one(none).count() == 0
