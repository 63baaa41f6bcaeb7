"""Operator 11, periodic runs of words, by uniting suffix classes by decreasing common prefix.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``min_repeats * q`` and ``min_words`` long, that no
neighbouring word extends.  Per document:

* Suffixes of the word sequence are sorted by prefix doubling, starting from
  ``floor`` words, where ``floor`` is the shortest common prefix that two
  suffixes of a run can have; neighbours in that order and their common prefix
  lengths (LCP) are the edges of a tree.
* Edges are taken by decreasing LCP, as Kruskal's algorithm does.  Union-find
  keeps the class of every position, and each class its positions in order; the
  smaller class is put into the larger.  At LCP ``l`` two positions are in one
  class exactly when their suffixes agree on ``l`` words.
* Positions ``a < b`` that become adjacent at LCP ``l`` with ``b - a <= l`` seed the
  stretch of ``b - a + l`` words from ``a`` on with period ``b - a``; were there a smaller
  period, a position between them would be in the class.  ``l`` is their exact
  LCP, so the stretch can't be extended to the right; it is a run if the words
  before ``a`` and ``b`` differ.  Every run is found once, by its first word.

The work is one pass over the documents without a shuffle; a document's own
length bounds what a task holds (about 60 bytes a word and level of doubling).
Common prefixes below ``floor`` are never looked at, so a text without a repeated
stretch of ``floor`` words ends at once.

Defined cases: null or empty texts and texts of white space have no words and
no runs; nulls in the other columns don't matter; a null doc_id is kept (and
edited by no rule of ``planted``); repeated rows and equal ids give a row each;
texts of any length are searched whole; of runs with equal repeats the one that
starts first, then the one with the smaller period is the greatest; extra
columns are ignored, whatever their names; an empty table returns no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import row_slices

MIN_WORDS = 6
MIN_REPEATS = 4
CHUNK = 512  # positions in a chunk of an ordered set, at most twice as many

Run = tuple[int, int, int]  # first word, number of words, period


class Positions:
    """An ordered set of positions in sorted chunks, so that adding one moves few others."""

    __slots__ = ("chunks", "first", "size")

    def __init__(self, position: int):
        self.chunks, self.first, self.size = [[position]], [position], 1

    def add(self, position: int) -> None:
        k = max(0, bisect_left(self.first, position) - 1)
        chunk = self.chunks[k]
        chunk.insert(bisect_left(chunk, position), position)
        self.first[k] = chunk[0]
        self.size += 1
        if len(chunk) > 2 * CHUNK:
            self.chunks.insert(k + 1, chunk[CHUNK:])
            self.first.insert(k + 1, chunk[CHUNK])
            del chunk[CHUNK:]

    def neighbours(self, position: int) -> tuple[int | None, int | None]:
        """The positions right before and behind a position of the set."""
        k = max(0, bisect_left(self.first, position + 1) - 1)
        chunk = self.chunks[k]
        at = bisect_left(chunk, position)
        before = chunk[at - 1] if at else self.chunks[k - 1][-1] if k else None
        behind = chunk[at + 1] if at + 1 < len(chunk) else self.chunks[k + 1][0] if k + 1 < len(self.chunks) else None
        return before, behind

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of the values from 1 on, in their order."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


def _paired(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of (left[i], right[i + shift]), with 0 behind the end."""
    behind = np.zeros(len(left), np.int64)
    behind[: max(0, len(left) - shift)] = right[shift:]
    return _dense(left * (int(right.max()) + 1) + behind)


def common_prefixes(words: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (a, b, LCP) between neighbours in suffix order that agree on ``floor`` words or more.

    ``words`` are ids from 1 on.  Ranks of all stretches of each length are kept, so that the
    LCP of any two positions is read off from the longest stretch to the shortest.
    """
    none = np.zeros(0, np.int64)
    if len(words) <= floor:
        return none, none, none
    short, width, rank = [(1, words)], 1, words  # stretches of 1, 2, 4, .. words
    while 2 * width <= floor:
        rank, width = _paired(rank, rank, width), 2 * width
        short.append((width, rank))
    for k, r in reversed(short):  # the rest of the floor
        if width + k <= floor:
            rank, width = _paired(rank, r, width), width + k
    long = [(width, rank)]
    while width < len(words) and int(rank.max()) < len(words):
        rank, width = _paired(rank, rank, width), 2 * width
        long.append((width, rank))
    order = np.argsort(rank, kind="stable")
    base = long[0][1]
    same = base[order[1:]] == base[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    if not len(a):
        return none, none, none
    lcp = np.zeros(len(a), np.int64)
    n = len(words)
    for k, r in [*reversed(long), *reversed(short)]:
        x, y = a + lcp, b + lcp
        inside = (x + k <= n) & (y + k <= n)
        hit = np.zeros(len(a), bool)
        hit[inside] = r[x[inside]] == r[y[inside]]
        lcp[hit] += k
    return a, b, lcp


def runs_of(words: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[Run]:
    """All runs of a sequence of word ids (from 1 on), by first word, then period."""
    if min_repeats < 2:
        raise ValueError("a run has two repeats at least")
    # A run of period q has two suffixes with LCP length - q.
    floor = max(1, min(max(min_words - q, (min_repeats - 1) * q) for q in range(1, min_words + 1)))
    left, right, lcp = common_prefixes(words, floor)
    if not len(lcp):
        return []
    w = words.tolist()
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def class_of(p: int) -> int:
        root = p
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while p != root:
            parent[p], p = root, parent[p]
        return root

    found = []
    by_lcp = np.argsort(-lcp, kind="stable")
    for a, b, l in zip(left[by_lcp].tolist(), right[by_lcp].tolist(), lcp[by_lcp].tolist()):
        a, b = class_of(a), class_of(b)
        x, y = members.pop(a, None) or Positions(a), members.pop(b, None) or Positions(b)
        if x.size < y.size:
            a, b, x, y = b, a, y, x
        added = list(y)
        for p in added:
            x.add(p)
        parent[b], members[a] = a, x
        new = set(added)
        for p in added:
            before, behind = x.neighbours(p)
            for start, other in ((before, p), (p, behind)):
                # Two positions of the added class were together before.
                if start is None or other is None or (start in new and other in new):
                    continue
                period = other - start
                length = period + l
                if period <= l and length >= max(min_words, min_repeats * period) and (start == 0 or w[start - 1] != w[other - 1]):
                    found.append((start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in keep.tolist()]


def words_in_order(text: str | None) -> list[bytes]:
    """Maximal stretches of bytes other than space and TAB..CR, as they stand."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def find_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_repeats: int = MIN_REPEATS,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs array<struct<start, length, period>>, collapsed`` (the words left,
    joined by one space) of every row.  ``rewrite`` may change a document's words first."""

    def run(batches):
        for b in row_slices(batches):
            counts, runs, texts = [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_in_order(text)
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                ids: dict[bytes, int] = {}
                own = np.array([ids.setdefault(x, len(ids) + 1) for x in words], dtype=np.int64)
                # With every word different no stretch repeats.
                of = runs_of(own, min_words, min_repeats) if len(ids) < len(words) else []
                counts.append(len(words)), runs.append([dict(zip(("start", "length", "period"), r)) for r in of])
                texts.append(b" ".join(collapsed(words, of)))
            kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
            yield pa.record_batch(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def collapsed_documents(docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``doc_id, text``: every row's words, those of a run only once."""
    return find_runs(docs, min_words, min_repeats).select("doc_id", F.col("collapsed").alias("text"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The report's documents: of one in ten, by the id's checksum, the words from a place on repeat with a period."""
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def runs_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the greatest run's ``start, length, period, exponent_milli``, and digests of all runs and the words left."""
    # length / period compared exactly, by cross products; the earlier run stands on ties.
    greatest = F.reduce(
        "runs",
        F.col("runs")[0],
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (
        find_runs(docs, rewrite=planted)
        .withColumn("greatest", F.when(F.size("runs") > 0, greatest))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            *(F.col("greatest")[k].alias(k) for k in ("start", "length", "period")),
            F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
            F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
