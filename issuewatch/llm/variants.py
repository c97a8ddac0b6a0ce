"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

Each code point belongs to one of `LEVELS` letter groups. A word's path is the number of its
letters in each group, group after group, and the trie arranges all words by their paths.
One inserted letter adds one to one count (a surplus), one deleted letter takes one away
(a deficit), a replaced one does both or neither. So a depth-first search that may spend
one surplus and one deficit reaches the leaves of all words one edit away, and few others;
those words are verified letter by letter.

The trie is cut into subtrees after so many levels that each holds few words. A subtree is
a group of rows sorted behind each other: its words, then the words that search it, each
with what is left of its budget. A task holds one subtree's words (at most about
`SUBTREE_WORDS`, since a larger one is dealt to several parts, which are all searched) and
takes the searching words in batches, so neither is bounded by the vocabulary's size. The
search carries all words of a batch that reach a node down together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialise

#: Letter groups are code points with equal remainder by 16, in this order,
#: those of letters that are frequent in European languages first.
GROUP_ORDER = (5, 14, 4, 9, 1, 2, 8, 15, 3, 12, 7, 6, 10, 13, 0, 11)
LEVELS = len(GROUP_ORDER)
#: Counts are told apart up to this number.
MAX_COUNT = 70
#: Words of a subtree that a task holds at a time.
SUBTREE_WORDS = 50_000
#: Searching words that a task carries down the trie together.
BATCH_WORDS = 1 << 16
#: Words of a node that are verified without going deeper.
LEAF_WORDS = 16
#: Pairs verified at a time.
PAIRS = 1 << 20

_ZERO = ord("0")


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """(id, run): every maximal run of Latin letters with `least` letters or more, A-Z lower-cased."""
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), 0)
    rows = docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run"))
    return rows.withColumn("run", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words behind each other, and the n + 1 edges between words."""
    edges = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32), edges


def _fixed(rows: np.ndarray) -> pa.Array:
    """A matrix of ASCII codes as strings, one a row."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows, np.uint8)))


def _matrix(paths: pa.Array) -> np.ndarray:
    """Equally long ASCII strings as a matrix of codes."""
    joined = "".join(paths.to_pylist()).encode()
    return np.frombuffer(joined, np.uint8).reshape(len(paths), -1).astype(np.int16)


def with_paths(words: DataFrame) -> DataFrame:
    """(word, n, path): `path` has one character a level, its count from '0' on."""
    level = np.argsort(GROUP_ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, edges = _letters(batch.column("word"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            counts = np.bincount(row * LEVELS + level[codes % LEVELS], minlength=batch.num_rows * LEVELS)
            paths = _ZERO + np.minimum(counts, MAX_COUNT).reshape(-1, LEVELS)
            yield pa.RecordBatch.from_arrays([*batch.columns, _fixed(paths)], ["word", "n", "path"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, path string")


def moves(depth: int) -> list[tuple[np.ndarray, int, int]]:
    """All ways to spend the budget on `depth` levels: (change of counts, surplus left, deficit left)."""
    one = np.eye(depth, dtype=np.int16)
    out = [(np.zeros(depth, np.int16), 1, 1)]
    out += [(one[i], 0, 1) for i in range(depth)] + [(-one[i], 1, 0) for i in range(depth)]
    return out + [(one[i] - one[j], 0, 0) for i in range(depth) for j in range(depth) if i != j]


def searches(words: DataFrame, depth: int) -> DataFrame:
    """(word, n, path, top, surplus, deficit): each word with every subtree its budget reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = _matrix(batch.column("path"))[:, :depth]
            for change, surplus, deficit in moves(depth):
                there = tops + change
                ok = np.flatnonzero(((there >= _ZERO) & (there <= _ZERO + MAX_COUNT)).all(axis=1))
                rest = [pa.array(np.full(len(ok), x, np.int32)) for x in (surplus, deficit)]
                some = batch.take(pa.array(ok))
                yield pa.RecordBatch.from_arrays([*some.columns, _fixed(there[ok]), *rest], ["word", "n", "path", "top", "surplus", "deficit"])

    return words.mapInArrow(run, "word string, n long, path string, top string, surplus int, deficit int")


class Trie:
    """The words of a subtree, sorted by path: a node is a range of rows with equal first counts."""

    def __init__(self, words: pa.Array, n: np.ndarray, paths: np.ndarray, depth: int) -> None:
        order = np.lexsort(paths.T[::-1])
        self.words, self.n, self.paths, self.depth = words.take(pa.array(order)), n[order], paths[order], depth
        self.codes, self.edges = _letters(self.words)
        self.rank = np.argsort(np.argsort(np.array(self.words.to_pylist(), object)))  # by code points

    def search(self, paths: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (searching word, word of the trie) that the budget allows."""
        stack = [(0, len(self.n), self.depth, np.arange(len(paths)), surplus, deficit)]
        left, right, size = [], [], 0
        while stack:
            low, high, level, q, s, d = stack.pop()
            if high - low <= LEAF_WORDS or level == LEVELS:
                step = max(1, PAIRS // len(q))
                for at in range(low, high, step):  # a leaf may hold more words than a block of pairs
                    there = np.arange(at, min(at + step, high))
                    left.append(np.repeat(q, len(there)))
                    right.append(np.tile(there, len(q)))
                    size += len(left[-1])
                    if size >= PAIRS:
                        yield np.concatenate(left), np.concatenate(right)
                        left, right, size = [], [], 0
                continue
            column, wanted = self.paths[low:high, level], paths[q, level]
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
            for a, b in zip(cuts, cuts[1:], strict=False):
                over = column[a] - wanted
                some = np.flatnonzero((over == 0) | ((over == 1) & s) | ((over == -1) & d))
                if len(some):
                    over = over[some]
                    stack.append((low + a, low + b, level + 1, q[some], s[some] & (over != 1), d[some] & (over != -1)))
        if left:
            yield np.concatenate(left), np.concatenate(right)


def _common(a: np.ndarray, b: np.ndarray, at: np.ndarray, there: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
    """How many letters from a[at] and b[there] on, going by `step`, are equal; `room` at most."""
    got = np.zeros(len(at), np.int64)
    going = np.flatnonzero(room > 0)
    k = 0
    while len(going):
        going = going[a[at[going] + step * k] == b[there[going] + step * k]]
        k += 1
        got[going] = k
        going = going[room[going] > k]
    return got


def one_edit(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether word i of `a` and word j of `b` differ by exactly one inserted, deleted or replaced letter."""
    start, end, other, stop = a[1][i], a[1][i + 1], b[1][j], b[1][j + 1]
    size, more = end - start, stop - other
    ok = np.flatnonzero(np.abs(size - more) <= 1)
    start, end, other, stop, size, more = (x[ok] for x in (start, end, other, stop, size, more))
    room, need = np.minimum(size, more), np.maximum(size, more) - 1
    front = _common(a[0], b[0], start, other, 1, room)
    differ = (front < room) | (size != more)
    back = _common(a[0], b[0], end - 1, stop - 1, -1, np.where(differ, np.minimum(room, need - front), 0))
    out = np.zeros(len(i), bool)
    out[ok] = differ & (front + back >= need)
    return out


def _answers(trie: Trie, batch: pa.Table) -> pa.RecordBatch:
    """(word, n_near, best_n, best): what the trie holds for the searching words."""
    words = batch.column("word").combine_chunks()
    letters = _letters(words)
    paths = _matrix(batch.column("path").combine_chunks())
    s, d = (batch.column(c).to_numpy() > 0 for c in ("surplus", "deficit"))
    found = [np.zeros((2, 0), np.int64)]
    for q, w in trie.search(paths, s, d):
        hit = one_edit(letters, (trie.codes, trie.edges), q, w)
        found.append(np.stack([q[hit], w[hit]]))
    q, w = np.concatenate(found, axis=1)
    order = np.lexsort((trie.rank[w], -trie.n[w], q))
    q, w = q[order], w[order]
    who, first, size = np.unique(q, return_index=True, return_counts=True)
    best = pa.array(w[first])
    columns = [words.take(pa.array(who)), pa.array(size, pa.int64()), pa.array(trie.n[w[first]], pa.int64()), trie.words.take(best)]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def subtree_depth(words: DataFrame, subtree_words: int) -> int:
    """The fewest levels after which no subtree holds more words than that, else all levels."""
    tops = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(LEVELS)), lambda k: F.struct(k.alias("depth"), F.substring("path", 1, k).alias("top")))).alias("t"))
    sizes = tops.groupBy("t.depth", "t.top").agg(F.count("*").alias("size")).groupBy("depth").agg(F.max("size").alias("size"))
    return min((r["depth"] for r in sizes.collect() if r["size"] <= subtree_words), default=LEVELS)  # LEVELS rows


def near_words(words: DataFrame, subtree_words: int = SUBTREE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of those in `words` (word, n, path; distinct words) that have a near word:
    how many they have, and the one of largest n (ties: the first by code points)."""
    spark = words.sparkSession
    depth = subtree_depth(words, subtree_words)
    own = words.withColumn("top", F.substring("path", 1, depth))
    parts = own.groupBy("top").agg(F.ceil(F.count("*") / subtree_words).alias("parts"))
    held = own.join(parts, "top").select(
        F.concat_ws("/", "top", F.pmod(F.xxhash64("word"), F.col("parts"))).alias("key"), F.lit(0).alias("role"), "word", "n", "path", F.lit(0).alias("surplus"), F.lit(0).alias("deficit")
    )
    asked = searches(words, depth).join(parts, "top")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asked = asked.select(F.concat_ws("/", "top", "part").alias("key"), F.lit(1).alias("role"), "word", "n", "path", "surplus", "deficit")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = held.unionByName(asked).repartition(tasks, "key").sortWithinPartitions("key", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, trie, size = None, None, 0
        held: list[pa.RecordBatch] = []
        asking: list[pa.RecordBatch] = []
        for batch in batches:
            names = batch.column("key").dictionary_encode()
            at, role = names.indices.to_numpy(), batch.column("role").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(at) != 0) | (np.diff(role) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if names.dictionary[int(at[a])].as_py() != key:
                    if asking:
                        yield _answers(trie, pa.Table.from_batches(asking))
                    key, trie, held, asking, size = names.dictionary[int(at[a])].as_py(), None, [], [], 0
                if role[a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if trie is None and not held:  # a part that no word was dealt to
                    continue
                if trie is None:
                    table = pa.Table.from_batches(held)
                    trie = Trie(table.column("word").combine_chunks(), table.column("n").to_numpy(), _matrix(table.column("path").combine_chunks()), depth)
                    held = []
                asking.append(batch.slice(a, b - a))
                size += b - a
                if size >= BATCH_WORDS:
                    yield _answers(trie, pa.Table.from_batches(asking))
                    asking, size = [], 0
        if asking:
            yield _answers(trie, pa.Table.from_batches(asking))

    found = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    return found.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, max_n: int) -> DataFrame:
    """(word, root) of the words in `forms` (word, form): the last word of the chain of forms.

    Each form has at least twice its word's n, so a chain has at most log2(max_n) steps,
    and each round doubles the steps that a word looks ahead.
    """
    first = steps = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(math.log2(max(2, max_n)) + 1)))):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        done, steps = steps, materialise(steps.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        if done is not first:
            drop_scratch(done)
    return steps


def spelling_variants(occurrences: DataFrame, word: Column | str = "word", least_count: int = 3, ratio: int = 2, subtree_words: int = SUBTREE_WORDS) -> DataFrame:
    """One row per word that occurs `least_count` times or more: (word, form, root, n, n_near, form_n).

    Words are near if they differ by exactly one inserted, deleted or replaced code point.
    `n_near` counts a word's near words; `form` is the one of them of largest n (ties: the
    first by code points) if it has at least `ratio` times the word's own n, else null; `root`
    is the last word when forms are followed from word to word, the word itself if it has
    none. `ratio` is over 1, so that chains end.

    Null words and empty ones are left out. Repeated rows count each time; other columns
    are ignored; no rows give an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    column = F.col(word) if isinstance(word, str) else word
    counts = occurrences.select(column.alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    words = materialise(with_paths(counts.where(F.col("n") >= least_count)), "words")
    near = materialise(near_words(words, subtree_words), "near")
    named = words.select("word", "n").join(near, "word", "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    named = named.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"))
    named = materialise(named, "named")
    forms = named.where("form is not null").select("word", "form")
    max_n = words.agg(F.max("n")).first()[0] or 1
    return named.join(roots(forms, max_n), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
