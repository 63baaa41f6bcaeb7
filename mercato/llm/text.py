"""Words, 64-bit word and shingle hashes, and Arrow batch helpers shared by the operators.

A word is a maximal run of bytes other than space and TAB..CR, after
lower-casing A-Z only; ``bytes.lower().split()`` is exactly that rule on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
MEMO_WORDS = 1 << 19  # hashes that a task remembers, where words are hashed one by one


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes:
    """64-bit hashes of all words of a string column, computed on its bytes.

    A word's hash is a polynomial over random 64-bit values of its bytes (equal
    for either case of A-Z), taken from running sums over some texts at once and
    mixed with its length.  Words of ``CHUNK`` bytes or more, for which the running
    sums would be too long, are hashed one by one.
    """

    CHUNK = 1 << 18

    def __init__(self):
        values = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=1) for b in range(256)], dtype=np.uint64)
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
        self.values = values
        self.in_word = np.ones(256, dtype=bool)
        self.in_word[[0x20, *range(0x09, 0x0E)]] = False
        base = 0x9E3779B97F4A7C15
        self.power, self.unpower = self._powers(base), self._powers(pow(base, -1, 1 << 64))

    def _powers(self, base: int) -> np.ndarray:
        out = np.full(self.CHUNK + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def of_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, words of each text); null counts as empty."""
        col = col.fill_null("") if col.null_count else col
        wide = pa.types.is_large_string(col.type)
        off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        buffer = col.buffers()[2]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(col), np.int64)
        i = 0
        while i < len(col):
            # As many texts as fit a chunk, one at least.
            j = max(i + 1, int(np.searchsorted(off, off[i] + self.CHUNK, side="right")) - 1)
            if off[j] - off[i] <= self.CHUNK:
                h, counts[i:j] = self._chunk(data[off[i] : off[j]], off[i : j + 1] - off[i])
            else:
                h = self._long(data[off[i] : off[j]].tobytes().split())
                counts[i] = len(h)
            hashes.append(h)
            i = j
        return np.concatenate(hashes), counts

    def of(self, words: list[bytes]) -> np.ndarray:
        return self._long(words)

    def _chunk(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = self.in_word[data]
        before, after = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside
        after[:-1] = inside
        before[off], after[off] = False, False  # a text's end ends a word
        start = np.flatnonzero(inside & ~before[:-1])
        stop = np.flatnonzero(inside & ~after[1:]) + 1
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        h = (sums[stop] - sums[start]) * self.unpower[start]
        return mix64(h + (stop - start).astype(np.uint64) * _ODD[1]), np.diff(np.searchsorted(start, off))

    def _long(self, words: list[bytes]) -> np.ndarray:
        """Hashes of single words, joined to chunks."""
        out = np.zeros(len(words), dtype=np.uint64)
        at = size = 0
        for i, w in enumerate([*words, None]):
            big = w is not None and len(w) >= self.CHUNK
            if i > at and (w is None or big or size + len(w) + 1 > self.CHUNK):
                data = np.frombuffer(b" ".join(words[at:i]), dtype=np.uint8)
                out[at:i] = self._chunk(data, np.array([0, len(data)]))[0]
                at, size = i, 0
            if big:
                out[i], at = xxhash.xxh3_64_intdigest(w.lower()), i + 1
            elif w is not None:
                size += len(w) + 1
        return out


def shingle_hashes(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the ``k``-word shingles in order; the whole sequence as one when shorter; none without words."""
    n = len(h)
    if n == 0:
        return h
    if k > len(_ODD):
        raise ValueError(f"at most {len(_ODD)} words a shingle")
    if n < k:
        return mix64((h * _ODD[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    acc = h[: n - k + 1] * _ODD[0]
    for i in range(1, k):
        acc += h[i : n - k + 1 + i] * _ODD[i]
    return mix64(acc)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    if len(x) < 2:
        return x
    keep = np.empty(len(x), dtype=bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices of the incoming batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_words(batches: Iterator[pa.RecordBatch], hasher: WordHashes, column: int = 1):
    """(slice, word hashes of each of its texts)."""
    for b in row_slices(batches):
        h, counts = hasher.of_column(b.column(column))
        yield b, np.split(h, np.cumsum(counts)[:-1])


def boxed(docs: DataFrame, *names: str) -> DataFrame:
    """All columns of ``docs`` as one struct ``_doc``, beside the named ones: no column of
    the caller's can clash with one that an operator adds (``_doc.*`` gives them back)."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *names)


def beside(docs: DataFrame, *added: str) -> list[Column]:
    """The columns of ``_doc``; one that is named like an added column comes as ``input_<name>``."""
    taken = {*docs.columns, *added}
    out = []
    for c in docs.columns:
        name = c
        while name in added or (name != c and name in taken):
            name = f"input_{name}"
        taken.add(name)
        out.append(F.col("_doc")[c].alias(name))
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
