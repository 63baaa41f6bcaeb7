"""Operator 2, benchmark decontamination: SimHash of item-sized windows.

For an item of ``n`` words every document is read in windows of ``n`` words (a
shorter document is one window).  A window's 64-bit SimHash is the sign, per
bit, of the sum over its five-word shingles; sums over a window are differences
of running sums.  Items of one size share a multi-index table: eight 8-bit
blocks, each listing the items whose block is within ``RADIUS // 8`` bits, so
by the pigeonhole principle every item within ``RADIUS`` bits is listed by some
block.  Candidates are then verified exactly: the weighted (multiset) Jaccard
similarity of window and item shingles must be at least ``SIMILARITY``.

Windows that share no shingle with any item of their size cannot pass the
verification and are skipped before hashing.

The benchmark is the query set: it goes to the tasks in blocks of
``BLOCK_ITEMS`` items, one pass over the documents for each block, so what a
task holds is bounded however long the benchmark is.

Defined cases: null or wordless texts and items match nothing; texts of fewer
than five words are one shingle; repeated items are reported each; repeated or
null doc_ids give one row per input row and item; extra columns are ignored;
empty tables give no rows.  Of several windows of a document over an item the
most similar, then the first, is reported.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import WordHashes, boxed, shingle_hashes, text_words, words_of

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 20
BLOCKS = 8
BLOCK_ITEMS = 20_000
FILTER_BITS = 20


def bit_signs(h: np.ndarray) -> np.ndarray:
    """[n, 64] of +1/-1 by the bits of each hash."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def simhash_bytes(sums: np.ndarray) -> np.ndarray:
    """[n, 8] bytes of the fingerprints from [n, 64] sums (bit set when the sum is positive)."""
    return np.packbits(sums > 0, axis=1)


POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


@dataclass
class SizeClass:
    """Items of one number of words and their multi-index Hamming table."""

    n_words: int
    item_ids: list
    counts: list[tuple[np.ndarray, np.ndarray]]  # distinct shingles and their multiplicity
    prints: np.ndarray  # [items, 8]
    near: np.ndarray = field(init=False)  # [8, 256, items]: item's block within RADIUS // BLOCKS bits

    def __post_init__(self):
        values = np.arange(256, dtype=np.uint8)
        self.near = np.stack([POPCOUNT[values[:, None] ^ self.prints[None, :, b]] <= RADIUS // BLOCKS for b in range(BLOCKS)])

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all fingerprints within RADIUS of an item."""
        listed = self.near[0][prints[:, 0]].copy()
        for b in range(1, BLOCKS):
            listed |= self.near[b][prints[:, b]]
        w, i = np.nonzero(listed)
        d = POPCOUNT[prints[w] ^ self.prints[i]].sum(axis=1, dtype=np.int64)
        ok = d <= RADIUS
        return w[ok], i[ok], d[ok]


class BenchmarkIndex:
    def __init__(self, items: list[tuple[int, str]]):
        memo = WordHashes()
        classes: dict[int, list] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if words:
                s = shingle_hashes(memo.of(words), SHINGLE)
                classes[len(words)].append((item_id, np.unique(s, return_counts=True), simhash_bytes(bit_signs(s).sum(axis=0, keepdims=True))[0]))
        self.classes = [
            SizeClass(n, [x[0] for x in rows], [x[1] for x in rows], np.stack([x[2] for x in rows])) for n, rows in sorted(classes.items())
        ]
        # Which size classes have a shingle, and a bitmap of shingle bits to reject most words at once.
        pairs = sorted({(int(s), k) for k, c in enumerate(self.classes) for u, _ in c.counts for s in u})
        self.shingles = np.array([p[0] for p in pairs], dtype=np.uint64)
        self.owner = np.array([p[1] for p in pairs], dtype=np.int64)
        self.bitmap = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.bitmap[(self.shingles >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.short = sorted({c.n_words for c in self.classes if c.n_words < SHINGLE})

    def hits(self, s: np.ndarray) -> dict[int, np.ndarray]:
        """Positions of ``s`` holding a shingle of a class' items, by class."""
        at = np.flatnonzero(self.bitmap[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        out: dict[int, np.ndarray] = {}
        if len(at) and len(self.shingles):
            lo, hi = np.searchsorted(self.shingles, s[at]), np.searchsorted(self.shingles, s[at], side="right")
            n = hi - lo
            if n.sum():
                pos = np.repeat(at, n)
                own = self.owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                for k in np.unique(own):
                    out[int(k)] = pos[own == k]
        return out

    def matches(self, h: np.ndarray):
        """(item_id, first word, words, similarity, distance) of the best window of each matching item, from word hashes."""
        if not len(h):
            return
        full = shingle_hashes(h, SHINGLE)
        for k, pos in self.hits(full).items():
            c = self.classes[k]
            if c.n_words >= SHINGLE or len(h) < SHINGLE:
                yield from self.windows(c, full, pos, max(1, c.n_words - SHINGLE + 1))
        for n in self.short if len(h) >= SHINGLE else ():
            # Items shorter than a shingle: windows of so many words are one shingle each.
            s = short_windows(h, n)
            for k, pos in self.hits(s).items():
                if self.classes[k].n_words == n:
                    yield from self.windows(self.classes[k], s, pos, 1)

    def windows(self, c: SizeClass, s: np.ndarray, pos: np.ndarray, m: int):
        """Best windows of ``m`` shingles around the hits at ``pos``."""
        m = min(m, len(s))
        first, last = np.maximum(pos - m + 1, 0), np.minimum(pos, len(s) - m)
        mark = np.zeros(len(s) - m + 2, dtype=np.int64)
        np.add.at(mark, first, 1)
        np.add.at(mark, last + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
        best: dict[int, tuple] = {}
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for at in range(0, len(run), 4096):
                part = run[at : at + 4096]
                sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bit_signs(s[part[0] : part[-1] + m]), axis=0)])
                prints = simhash_bytes(sums[part - part[0] + m] - sums[part - part[0]])
                for w, i, d in zip(*c.within(prints)):
                    sim = weighted_jaccard(s[part[w] : part[w] + m], c.counts[i])
                    if sim >= SIMILARITY and (i not in best or sim > best[i][0]):
                        best[i] = (sim, int(part[w]), int(d))
        for i, (sim, start, d) in sorted(best.items()):
            yield c.item_ids[i], start, c.n_words, sim, d


def short_windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, as ``shingle_hashes`` gives them for a text of ``n`` words."""
    return np.concatenate([shingle_hashes(h[i : i + n], SHINGLE) for i in range(len(h) - n + 1)])


def weighted_jaccard(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger multiplicities of the shingles."""
    u, c = np.unique(window, return_counts=True)
    _, a, b = np.intersect1d(u, item[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(c[a], item[1][b]).sum())
    return both / (len(window) + int(item[1].sum()) - both)


MATCH_SCHEMA = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"


def benchmark_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS):
    """The query set in blocks of bounded size, in item order."""
    rows, block = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator(), []
    for r in rows:
        block.append((r[0], r[1]))
        if len(block) == block_items:
            yield block
            block = []
    if block:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and benchmark item found in it (``MATCH_SCHEMA``)."""
    return matches_of_rows(docs, benchmark, block_items).drop("row")


def row_key():
    return F.xxhash64(F.col("text").cast("string"))


def matches_of_rows(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``find_matches`` with ``row``, a hash of the document's text."""
    spark, out = docs.sparkSession, None
    schema = f"{MATCH_SCHEMA}, row long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row_key().alias("row"))
    for block in benchmark_blocks(benchmark, block_items):
        handle = spark.sparkContext.broadcast(block)

        def run(batches, handle=handle):
            index = BenchmarkIndex(handle.value)
            for b, texts in text_words(batches, WordHashes()):
                ids = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), texts)
                found = [(doc_id, *m, row) for doc_id, row, h in ids for m in index.matches(h)]
                if found:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64())
                    names = ["doc_id", "item_id", "start_word", "n_words", "similarity", "distance", "row"]
                    yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*found), types)], names=names)

        one = rows.mapInArrow(run, schema)
        out = one if out is None else out.unionAll(one)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a benchmark match; rows that share a doc_id, or have none, are told apart by their text."""
    bad = matches_of_rows(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
    rows = boxed(docs, F.col("doc_id").cast("long").alias("_key"), row_key().alias("_hash"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_row"))
    return rows.join(bad, same, "left_anti").select("_doc.*")
