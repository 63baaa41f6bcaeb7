"""Operator 4, quality classifier: hashed word n-gram logistic regression, FTRL updates.

Tokens are runs of word characters or of punctuation; a token equal to the one
before it becomes a repeat mark.  Unigrams and bigrams are hashed into
``2**BITS`` weights.  A score is the sigmoid of the sparse dot product of the
n-gram counts, scaled by one over the square root of their number, with the
weights.

Training (on the driver, follow-the-regularised-leader with per-coordinate
rates) sees a bounded sample: at most about ``TRAIN_DOCS`` labelled documents
picked by a hash of doc_id, each whole, as distinct n-gram slots with counts.
Scoring reads every text whole.

Defined cases: null and empty texts have no n-gram and get the sigmoid of the
bias; labels that are null are not learned from; of several labels of one
document the smallest counts; without labels every score is 0.5; null or
repeated doc_id values are kept, one row out per row in; extra columns are
ignored; an empty table returns no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import MEMO_WORDS, row_slices

BITS = 18
TRAIN_DOCS = 6000
THRESHOLD = 0.3

TOKEN = re.compile(r"\w+|[^\w\s]+")


class TokenHashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))
        self[token] = h
        return h


REPEAT = np.uint64(0x9E3779B97F4A7C15)


def ngram_slots(text: str | None, memo: TokenHashes) -> np.ndarray:
    """Weight slots of the text's token unigrams and bigrams, repeats included."""
    tokens = TOKEN.findall(text) if text else []
    h = np.fromiter(map(memo.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    if len(h) > 1:
        h = np.where(np.concatenate([[False], h[1:] == h[:-1]]), REPEAT, h)
    two = (h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:]) * np.uint64(0x165667B19E3779F9)
    return (np.concatenate([h, two]) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, slots: np.ndarray) -> float:
        dot = float(self.weights[slots].sum(dtype=np.float64)) / np.sqrt(len(slots)) if len(slots) else 0.0
        return float(1 / (1 + np.exp(-np.clip(dot + self.bias, -35, 35))))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 3, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 1.0) -> QualityModel:
    """FTRL-proximal logistic regression over ``(distinct slots, their counts, label)`` rows in the given order."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)
    zb = nb = 0.0

    def solve(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    data = [(idx, count, int(count.sum()), y) for idx, count, y in rows]
    for _ in range(epochs):
        for idx, count, total, y in data:
            x = count / np.sqrt(total) if total else count.astype(float)
            w = solve(z[idx], n[idx])
            wb = -zb / ((beta + np.sqrt(nb)) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w @ x + wb, -35, 35)))
            g = (p - y) * x
            z[idx] += g - (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / alpha * w
            n[idx] += g * g
            gb = p - y
            zb += gb - (np.sqrt(nb + gb * gb) - np.sqrt(nb)) / alpha * wb
            nb += gb * gb
    return QualityModel(solve(z, n).astype(np.float32), float(-zb / ((beta + np.sqrt(nb)) / alpha)))


def held_out(of: int = 5, remainder: int = 0):
    """Rows never learned from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == remainder, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, quality, slots, counts`` (distinct n-gram slots of the whole text) of a bounded hash sample of the labelled, not held-out documents."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    n = known.count()
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    # Bounded by the limit, so safe to broadcast against the documents.
    picked = (
        known.where(u < min(1.0, train_docs / max(1, n)))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .limit(2 * train_docs)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text")

    def run(batches):
        memo = TokenHashes()
        for b in row_slices(batches):
            pairs = [np.unique(ngram_slots(t, memo), return_counts=True) for t in b.column(2).to_pylist()]
            slots, counts = (pa.array([p[k].astype(np.int32).tobytes() for p in pairs], pa.binary()) for k in range(2))
            yield pa.record_batch([b.column(0), b.column(1), slots, counts], names=["doc_id", "quality", "slots", "counts"])

    return rows.mapInArrow(run, "doc_id long, quality int, slots binary, counts binary")


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> QualityModel:
    rows = training_rows(docs, labels, train_docs).toPandas()
    if not len(rows):
        return QualityModel(np.zeros(1 << BITS, np.float32), 0.0)
    # A fixed, mixed order whatever the partitions.
    rows["order"] = [xxhash.xxh32_intdigest(str(d)) for d in rows["doc_id"]]
    rows = rows.sort_values(["order", "doc_id", "slots", "counts"], kind="stable")
    return ftrl([(np.frombuffer(s, np.int32), np.frombuffer(c, np.int32), int(q)) for s, c, q in zip(rows["slots"], rows["counts"], rows["quality"])])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    handle = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches):
        net, memo = QualityModel(*handle.value), TokenHashes()
        for b in row_slices(batches):
            scores = [net.score(ngram_slots(t, memo)) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
