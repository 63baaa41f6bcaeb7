"""Operator 10, LM scoring: stupid backoff over bigram and unigram counts of the whole corpus.

Every word of a document contributes ``ln c(h w) - ln c(h)`` when its bigram
occurs at least ``MIN_COUNT`` times in the corpus, else
``ln ALPHA + ln c(w) - ln N``; a first word contributes ``ln c(w) - ln N``.
Logarithms are kept in millionths as integers, so sums do not depend on order.

Count tables are partitioned by hash and joined to the documents' n-grams in
the same shuffle: a task packs the n-grams of some thousand documents into one
row per part (keys, documents and multiplicities as byte planes), a part counts
each n-gram over all its rows and returns what it adds to its documents, packed
into one row per block of documents; a block sums them up.

Two bounded exact tables go to every task: the counts of the ``TOP_WORDS`` most
frequent words and of the pairs of the ``DENSE_WORDS`` most frequent ones.  They
are no cap: any other word (a tail word) or bigram is counted in its part, and
without those hot keys no part can hold more than a small share of the corpus.
Bigrams of two top words are keyed by the pair; others by their tail words:

* kind 0: key (h, w), both top;
* kind 1: key w (tail), with h: gives c(w), c(h w) and the backoff;
* kind 2: key h (tail), with w: gives c(h w) and, from kind 1, c(h).

Defined cases: null or wordless texts have no word, score 0 and a null mean;
rows that share a doc_id are one document; null doc_ids are one document;
extra columns are ignored; an empty table returns no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import WordHashes, mix64, row_slices

ALPHA = 0.4
MIN_COUNT = 2
TOP_WORDS = 1 << 16
DENSE_WORDS = 512
PART_WORDS = 1 << 20  # words to a part
PARTS_TO_BLOCK = 4  # parts of n-grams to a block of documents
BLOCK_WORDS = 1 << 20  # words packed at a time
NULL_ID = -(1 << 63)
TAIL = np.uint64(1 << 63)
NO_WORD = np.uint64(TOP_WORDS)  # context of a first word


class WordCodes:
    """Codes of words: the rank of a top word, else its hash with the highest bit set."""

    def __init__(self, top: list[int]):
        self.hasher = WordHashes()
        top = np.array(top, dtype=np.uint64)
        order = np.argsort(top)
        self.sorted, self.rank = top[order], order.astype(np.uint64)
        self.slots = np.zeros(1 << 20, dtype=bool)  # by hash bits; spares most tail words the search
        self.slots[self._slot(top)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(40) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def of_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        h, counts = self.hasher.of_column(col)
        h |= TAIL
        maybe = np.flatnonzero(self.slots[self._slot(h)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.sorted, h[maybe]), len(self.sorted) - 1)
            found = self.sorted[at] == h[maybe]
            h[maybe[found]] = self.rank[at[found]]
        return h, counts


def blocks(batches, codes: WordCodes, at_most: int = BLOCK_WORDS):
    """(doc ids, words of each, all word codes) of some documents at a time, about ``at_most`` words."""
    ids, sizes, parts, n = [], [], [], 0
    for b in row_slices(batches, 128):
        codes_of, counts = codes.of_column(b.column(1))
        ids.append(b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        sizes.append(counts)
        parts.append(codes_of)
        n += len(codes_of)
        if n >= at_most:
            yield np.concatenate(ids), np.concatenate(sizes), np.concatenate(parts)
            ids, sizes, parts, n = [], [], [], 0
    if ids:
        yield np.concatenate(ids), np.concatenate(sizes), np.concatenate(parts)


def frequent_words(rows: DataFrame, at_most: int = TOP_WORDS) -> list[int]:
    """Hashes of the most frequent words; counts leave out words that a block has once."""

    def run(batches):
        for _, _, w in blocks(batches, WordCodes([])):
            u, c = np.unique(w, return_counts=True)
            yield pa.record_batch([pa.array(u[c > 1].view(np.int64)), pa.array(c[c > 1])], names=["word", "n"])

    top = rows.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "word").limit(at_most)
    return [h % (1 << 64) for h in top.toArrow().column("word").to_pylist()]


def contexts(sizes: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The word before each word, NO_WORD at the start of a document."""
    h = np.empty_like(w)
    h[1:] = w[:-1]
    starts = np.cumsum(sizes) - sizes
    h[starts[sizes > 0]] = NO_WORD
    return h


def dense_pairs(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (h < DENSE_WORDS) & (w < DENSE_WORDS)


def exact_counts(rows: DataFrame, top: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts of the top words, of the pairs of the first DENSE_WORDS, and of all words."""
    handle = rows.sparkSession.sparkContext.broadcast(top)
    cells = DENSE_WORDS * DENSE_WORDS

    def run(batches):
        words, pairs, total = np.zeros(TOP_WORDS, np.int64), np.zeros(cells, np.int64), 0
        for _, sizes, w in blocks(batches, WordCodes(handle.value)):
            h = contexts(sizes, w)
            total += len(w)
            words += np.bincount(w[w < TOP_WORDS].astype(np.int64), minlength=TOP_WORDS)
            d = dense_pairs(h, w)
            pairs += np.bincount((h[d] * np.uint64(DENSE_WORDS) + w[d]).astype(np.int64), minlength=cells)
        slot = np.concatenate([np.flatnonzero(words), TOP_WORDS + np.flatnonzero(pairs), [-1]])
        n = np.concatenate([words[words > 0], pairs[pairs > 0], [total]])
        yield pa.record_batch([pa.array(slot, pa.int64()), pa.array(n, pa.int64())], names=["slot", "n"])

    got = rows.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = (np.asarray(got.column(c).to_pylist(), dtype=np.int64) for c in ("slot", "n"))
    all_cells = np.zeros(TOP_WORDS + cells, np.int64)
    all_cells[slot[slot >= 0]] = n[slot >= 0]
    return all_cells[:TOP_WORDS], all_cells[TOP_WORDS:], int(n[slot == -1].sum())


def mlog(x: np.ndarray) -> np.ndarray:
    """ln in millionths, rounded (0 for counts of 0, which are never used)."""
    return np.rint(np.log(np.maximum(x, 1).astype(np.float64)) * 1e6).astype(np.int64)


MLOG_ALPHA = round(math.log(ALPHA) * 1e6)


def planes(x: np.ndarray) -> bytes:
    """The array's bytes, lowest of all numbers first: constant upper bytes compress away in the shuffle."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def by_document(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(ids, return_inverse=True)
    out = np.zeros(len(u), np.int64)
    np.add.at(out, at, values)
    return u, out


PACKED = "part int, kind int, keys binary, others binary, docs binary, counts binary, doc_id long, words long, micro long"


def packed_ngrams(rows: DataFrame, model, parts: int) -> DataFrame:
    """Rows of packed n-grams per part, and one row per document with what the bounded tables settle."""
    handle = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        top, words_n, pairs_n, total = handle.value
        log_word, log_pair, log_n = mlog(words_n), mlog(pairs_n), int(mlog(np.array([total]))[0])
        for ids, sizes, w in blocks(batches, WordCodes(top)):
            doc = np.repeat(np.arange(len(ids)), sizes)
            h = contexts(sizes, w)
            micro = np.zeros(len(ids), np.int64)
            top_w, top_h, first = w < TAIL, h < TAIL, h == NO_WORD
            a = first & top_w
            np.add.at(micro, doc[a], log_word[w[a].astype(np.int64)] - log_n)
            d = dense_pairs(h, w)
            cell = (h[d] * np.uint64(DENSE_WORDS) + w[d]).astype(np.int64)
            hi, wi = h[d].astype(np.int64), w[d].astype(np.int64)
            np.add.at(micro, doc[d], np.where(pairs_n[cell] >= MIN_COUNT, log_pair[cell] - log_word[hi], MLOG_ALPHA + log_word[wi] - log_n))
            none, null = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())
            yield pa.record_batch(
                [none, none, null, null, null, null, pa.array(ids), pa.array(sizes), pa.array(micro)],
                names=["part", "kind", "keys", "others", "docs", "counts", "doc_id", "words", "micro"],
            )
            pair = top_w & top_h & ~first & ~d
            for kind, sel, key, other in (
                (0, pair, (h << np.uint64(20)) | w, np.zeros_like(w)),
                (1, ~top_w, w, h),
                (2, ~top_h, h, w),
            ):
                yield from pack(kind, mix64(key[sel]), other[sel], ids[doc[sel]], parts)

    return rows.mapInArrow(run, PACKED)


def pack(kind: int, key: np.ndarray, other: np.ndarray, docs: np.ndarray, parts: int):
    """One row per part; equal (key, other, document) entries are counted.  ``mix64`` is one-to-one, so keys stay exact."""
    if not len(key):
        return
    order = np.lexsort((docs, other, key))
    key, other, docs = key[order], other[order], docs[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (other[1:] != other[:-1]) | (docs[1:] != docs[:-1])]))
    counts = np.diff(np.append(new, len(key))).astype(np.int32)
    key, other, docs = key[new], other[new], docs[new]
    part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
    spans = list(zip(cuts[:-1], cuts[1:]))
    n, null = len(spans), pa.nulls(len(spans), pa.int64())
    yield pa.record_batch(
        [
            pa.array(part[cuts[:-1]], pa.int32()),
            pa.array([kind] * n, pa.int32()),
            *[pa.array([planes(x[a:b]) for a, b in spans], pa.binary()) for x in (key, other, docs, counts)],
            null, null, null,
        ],
        names=["part", "kind", "keys", "others", "docs", "counts", "doc_id", "words", "micro"],
    )


def unpacked(rows: pd.DataFrame, kind: int):
    """(keys, others, docs, counts) of one kind, sorted by key and other."""
    own = rows[rows["kind"] == kind]
    cols = [np.concatenate([np.zeros(0, t), *(unplanes(x, t) for x in own[c])]) for c, t in (("keys", np.uint64), ("others", np.uint64), ("docs", np.int64), ("counts", np.int32))]
    order = np.lexsort((cols[1], cols[0]))
    return [c[order] for c in cols]


def grouped(same: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each entry and total of each group; ``same[i]``: entry i+1 belongs with entry i."""
    group = np.concatenate([[0], np.cumsum(~same)]) if len(counts) else np.zeros(0, np.int64)
    return group, np.bincount(group, weights=counts).astype(np.int64) if len(counts) else np.zeros(0, np.int64)


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log`` of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    top = frequent_words(rows)
    words_n, pairs_n, total = exact_counts(rows, top)
    parts = max(1, -(-total // PART_WORDS))
    packed = packed_ngrams(rows, (top, words_n, pairs_n, total), parts)
    blocks_n = -(-parts // PARTS_TO_BLOCK)
    handle = rows.sparkSession.sparkContext.broadcast((words_n, total))

    def to_blocks(ids: np.ndarray, words: np.ndarray, micro: np.ndarray) -> pd.DataFrame:
        """One packed row per block of the documents."""
        block = ((mix64(ids.view(np.uint64)) >> np.uint64(32)) * np.uint64(blocks_n) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        block, cols = block[order], [x[order] for x in (ids, words, micro)]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])), len(block)) if len(block) else np.zeros(1, np.int64)
        spans = list(zip(cuts[:-1], cuts[1:]))
        packed = {n: [planes(x[a:b]) for a, b in spans] for n, x in zip(("docs", "words", "micro"), cols)}
        return pd.DataFrame({"block": block[cuts[:-1]] if len(block) else block, **packed})

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, words, micro = (np.concatenate([unplanes(x, np.int64) for x in pdf[c]]) for c in ("docs", "words", "micro"))
        u, n_words = by_document(ids, words)
        return pd.DataFrame({"doc_id": u, "n_words": n_words, "micro": by_document(ids, micro)[1]})

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["part"].iloc[0] < 0:
            # Documents' own rows, spread over negative parts.
            ids, micro = by_document(pdf["doc_id"].to_numpy(np.int64), pdf["micro"].to_numpy(np.int64))
            return to_blocks(ids, by_document(pdf["doc_id"].to_numpy(np.int64), pdf["words"].to_numpy(np.int64))[1], micro)
        words, n = handle.value
        log_word, log_n = mlog(words), int(mlog(np.array([n]))[0])
        found_ids, found = [], []

        def add(ids, value, counts):
            found_ids.append(ids)
            found.append(value * counts)

        def top_log(code):
            return log_word[np.minimum(code, np.uint64(TOP_WORDS - 1)).astype(np.int64)]

        key, _, ids, counts = unpacked(pdf, 0)
        if len(key):
            pair = unmix64(key)
            g, totals = grouped(key[1:] == key[:-1], counts)
            c = totals[g]
            seen = mlog(c) - top_log(pair >> np.uint64(20))
            add(ids, np.where(c >= MIN_COUNT, seen, MLOG_ALPHA + top_log(pair & np.uint64((1 << 20) - 1)) - log_n), counts)
        key, other, ids, counts = unpacked(pdf, 1)
        tail_keys, tail_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(key):
            gw, word_totals = grouped(key[1:] == key[:-1], counts)
            tail_keys, tail_n = key[np.concatenate([[True], key[1:] != key[:-1]])], word_totals
            g, totals = grouped((key[1:] == key[:-1]) & (other[1:] == other[:-1]), counts)
            c, cw = totals[g], word_totals[gw]
            first, tail_h = other == NO_WORD, other >= TAIL
            seen = mlog(c) - np.where(tail_h, 0, top_log(other))
            value = np.where(c >= MIN_COUNT, seen, MLOG_ALPHA + mlog(cw) - log_n)
            add(ids, np.where(first, mlog(cw) - log_n, value), counts)
        key, other, ids, counts = unpacked(pdf, 2)
        if len(key):
            g, totals = grouped((key[1:] == key[:-1]) & (other[1:] == other[:-1]), counts)
            c, ch = totals[g], tail_n[np.searchsorted(tail_keys, key)]
            tail_w = other >= TAIL
            seen = np.where(tail_w, 0, mlog(c)) - mlog(ch)
            add(ids, np.where(c >= MIN_COUNT, seen, np.where(tail_w, 0, MLOG_ALPHA + top_log(other) - log_n)), counts)
        ids, micro = by_document(np.concatenate(found_ids), np.concatenate(found))
        return to_blocks(ids, np.zeros(len(ids), np.int64), micro)

    own = -1 - F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    scored = packed.withColumn("part", F.coalesce("part", own.cast("int"))).groupBy("part").applyInPandas(score, "block int, docs binary, words binary, micro binary")
    per_doc = scored.groupBy("block").applyInPandas(add_up, "doc_id long, n_words long, micro long")
    log_score = F.col("micro") / F.lit(1e6)
    return per_doc.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"),
        "n_words",
        log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log"),
    )


def unmix64(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix64``."""
    inverse = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * inverse
    return x ^ (x >> np.uint64(32))


LM_SQL = f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), k AS (
  SELECT doc_id, unnest(ws) AS w, unnest(list_concat([NULL], ws[:-2])) AS h, unnest(range(len(ws))) AS i FROM t WHERE len(ws) > 0
), u AS (SELECT w, count(*) AS c FROM k GROUP BY w),
b AS (SELECT h, w, count(*) AS c FROM k WHERE i > 0 GROUP BY h, w),
n AS (SELECT count(*) AS c FROM k),
s AS (
  SELECT k.doc_id,
    CASE WHEN k.i > 0 AND b.c >= {MIN_COUNT}
         THEN CAST(round(ln(b.c) * 1e6) AS BIGINT) - CAST(round(ln(uh.c) * 1e6) AS BIGINT)
         ELSE CASE WHEN k.i > 0 THEN {MLOG_ALPHA} ELSE 0 END
              + CAST(round(ln(u.c) * 1e6) AS BIGINT) - CAST(round(ln((SELECT c FROM n)) * 1e6) AS BIGINT) END AS micro
  FROM k JOIN u ON k.w = u.w LEFT JOIN u AS uh ON k.h = uh.w LEFT JOIN b ON k.h = b.h AND k.w = b.w
), p AS (SELECT doc_id, sum(micro) AS micro FROM s GROUP BY doc_id),
d AS (SELECT doc_id, CAST(sum(len(ws)) AS BIGINT) AS n_words FROM t GROUP BY doc_id)
SELECT d.doc_id, d.n_words, CAST(coalesce(p.micro, 0) AS DOUBLE) / 1e6 AS log_score,
       CASE WHEN d.n_words > 0 THEN CAST(coalesce(p.micro, 0) AS DOUBLE) / 1e6 / d.n_words END AS mean_log
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""
