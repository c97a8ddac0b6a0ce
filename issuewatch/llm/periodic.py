"""Periodic runs of words by seed and extend along the diagonals of a document.

A run with period q and `least` words or more, at least two periods long, agrees with itself
q words further on over max(least - q, q) words. So every run has two equal grams of words,
q words apart, that begin at a multiple of a fixed step. Grams are named by doubling (the
name of 2k words is that of the pair of k-word names, kept only where it occurs again in
the document), which gives an exact index for every power of two. The lags are gone through
in classes: those from 2k to 4k use the grams of k words, so the index grows with the lag
and an anchor has at most 2k partners.

A pair of equal grams is extended to both ends by the same index, in one step per power of
two. For each lag the table `covered` holds how far its diagonal is known; an anchor
before that point is not extended again. A stretch that has a shorter period too has the
same ends on the shorter lag's diagonal, so of equal stretches the smallest lag is kept.
Work and memory are in proportion to a text's words times the logarithm of its length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a task looks at together; a longer text is looked at alone.
CHUNK_WORDS = 1 << 18

RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def gram_names(words: np.ndarray) -> list[np.ndarray]:
    """names[j][i] stands for the 2**j words from i on: equal words have equal names.

    `words` are numbers from 0 that no two documents share, so a gram never matches one of
    another document or one that reaches beyond its own. A gram that occurs once has a
    negative name of its own. Each array has one more place, which matches nothing.
    """
    n = len(words)
    alone = -1 - np.arange(n + 1, dtype=np.int64)
    names, level = [], np.full(n + 1, -1, np.int64)
    level[:n] = words
    at = np.flatnonzero(np.bincount(words)[words] > 1) if n else np.zeros(0, np.int64)
    width = 1
    while len(at):
        now = alone.copy()
        now[at] = level[at]
        names.append(now)
        first = at[now[np.minimum(at + width, n)] >= 0]
        code = now[first] * (n + 1) + now[first + width]
        _, name, size = np.unique(code, return_inverse=True, return_counts=True)
        again = size[name] > 1
        at, level = first[again], alone.copy()
        level[at] = name[again]
        width *= 2
    return names


def equal_ahead(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from `a` and from `b` > `a` on are equal."""
    n = len(names[0]) - 1
    got = np.zeros(len(a), np.int64)
    for j in reversed(range(len(names))):
        got += (names[j][a + got] == names[j][np.minimum(b + got, n)]).astype(np.int64) << j
    return got


def equal_behind(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words that end before `a` and before `b` > `a` are equal."""
    n = len(names[0]) - 1
    got = np.zeros(len(a), np.int64)
    for j in reversed(range(len(names))):
        x, y = a - got - (1 << j), b - got - (1 << j)
        x, y = np.where(x < 0, n, x), np.maximum(y, 0)
        got += (names[j][x] == names[j][y]).astype(np.int64) << j
    return got


def runs(words: np.ndarray, least: int) -> np.ndarray:
    """(start, end, period) of every run of at least `least` words, by start, then period."""
    n, names = len(words), gram_names(words)
    overlap = (least + 1) // 2  # that a run with a lag below it has at least
    found = [np.zeros((0, 3), np.int64)]
    for j, name in enumerate(names):
        width = 1 << j
        if 2 * width <= overlap:
            continue
        shortest = width <= overlap
        first, last = (1 if shortest else 2 * width), 4 * width
        step = overlap - width + 1 if shortest else width + 1
        at = np.flatnonzero(name >= 0)
        index = np.sort(name[at] * (n + 1) + at)
        places = index % (n + 1)
        anchors = at[at % step == 0]
        base = name[anchors] * (n + 1)
        low = np.searchsorted(index, base + np.minimum(anchors + first, n))
        high = np.searchsorted(index, base + np.minimum(anchors + last, n))
        some = high > low
        covered = np.zeros(last - first, np.int64)
        for a, x, y in zip(anchors[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
            lag = places[x:y] - a
            lag = lag[covered[lag - first] <= a]
            if not len(lag):
                continue
            here = np.full(len(lag), a, np.int64)
            start = here - equal_behind(names, here, here + lag)
            end = here + equal_ahead(names, here, here + lag)
            covered[lag - first] = end
            end = end + lag
            long = end - start >= np.maximum(least, 2 * lag)
            if long.any():
                found.append(np.stack([start[long], end[long], lag[long]], axis=1))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _one_chunk(ids: pa.Array, texts: list[list[bytes]], least: int) -> pa.RecordBatch:
    numbers, used = [], 0
    for words in texts:
        number = defaultdict(count(used).__next__)
        numbers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        used += len(number)
    edges = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    found = runs(np.concatenate(numbers), least)
    step = np.zeros(edges[-1] + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 1], -1)
    kept = np.cumsum(step) == 0
    offsets = np.searchsorted(found[:, 0], edges)
    collapsed = []
    for k, words in enumerate(texts):
        if offsets[k] < offsets[k + 1]:
            words = list(compress(words, kept[edges[k] : edges[k + 1]].tolist()))
        collapsed.append(b" ".join(words))
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    columns = [found[:, 0] - edges[doc], found[:, 1] - found[:, 0], found[:, 2]]
    parts = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)
    n_words = pa.array(np.diff(edges))
    text = pa.array(collapsed, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, n_words, lists, text], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """One row per document: (`id_col`, n_words, runs, collapsed).

    Words are cut at ASCII white space and numbered from 0. A run is a stretch of words with
    smallest period q (words q apart are equal), of at least max(`least`, 2 q) words, that
    no neighbouring word extends with that period. `runs` has (start, length, period) of all
    of them, by start, then period. `collapsed` is the text without the words that some run
    holds after its first q words, joined by one blank.

    A null, empty or blank text has no words, no runs and an empty `collapsed`. Repeated
    rows each give a row, null ids are kept, other columns are ignored, an empty table
    gives an empty result. A text is looked at by one task, however long it is.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[list[bytes]] = []
            begun, size = 0, 0
            for k, text in enumerate(batch.column("text").cast(pa.binary())):
                words = (text.as_py() or b"").split()
                if texts and size + len(words) > CHUNK_WORDS:
                    yield _one_chunk(batch.column("id").slice(begun, k - begun), texts, least)
                    texts, begun, size = [], k, 0
                texts.append(words)
                size += len(words)
            if texts:
                yield _one_chunk(batch.column("id").slice(begun), texts, least)

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, n_words long, runs {RUN_TYPE}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of `periodic_runs`' rows: number of runs, the longest one (ties: the
    first, then the one of smallest period; without runs nulls) and two checksums."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
