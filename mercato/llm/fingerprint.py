"""Operator 1, document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs (lines, cut again after sentence ends; what is still
long is cut at words that its own content chooses, so that an edit moves no cut
elsewhere).  The n-th occurrence of a paragraph has its own 64-bit digest, so a
text is a set of digests.  A sketch has cells in three equal parts; every digest is
added to one cell of each part as (count, digest sum, check sum).  Subtracting
two sketches leaves the digests that differ; peeling cells that hold a single
digest recovers them, with the side they are on.

A text's published sketch has ``cells_for`` cells: 1.5 to 3 for each paragraph, so two
versions of a text that share half their paragraphs can be told apart from the
sketches alone.  The number of cells in a part is a power of two and a digest's
cell its hash modulo it, so a larger sketch folds to the size of a smaller one by
adding cells, and any two sketches can be subtracted.  When peeling gets stuck, both
sketches are made again with twice the cells.  With ``d`` recovered digests the
likeness of texts of ``a`` and ``b`` digests is their Jaccard similarity
``(a + b - d) / (a + b + d)``.

``edited_report`` pairs each document with the next one in descending doc_id
by one range shuffle: bounds are existing ids, and the document at a bound is
also sent to the range before it, so every range holds the successor of its
last document.  No text meets more than its neighbours.

Defined cases: null text counts as empty; two empty texts have likeness 1, an
empty and a non-empty one 0; equal doc_ids are ordered by text; null doc_ids
come last, and rows of one id (or without one) meet in one range; a single document is its own successor; extra columns are ignored;
an empty table returns no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import MEMO_WORDS, distinct, mix64, row_slices

LEAST_PART = 8
CELLS_AT_ONCE = 1 << 16
PARAGRAPH = re.compile(r"\n+|(?<=[.!?]) ")
LONG = 100  # code points of a paragraph that is cut again
ONE_IN = 6  # of its words end a piece, on average
STRETCH = re.compile(r"\S{1,64}\s*|\s+")


def pieces(paragraph: str, known: dict[str, tuple[str, bool]]) -> list[str]:
    """A long paragraph cut behind the words whose hash says so and behind repeats of the word
    before (stretches without white space are words of 64 code points at most).  ``known``
    remembers words: without the white space behind them, and whether they end a piece."""
    out, held, before = [], [], None
    for stretch in STRETCH.findall(paragraph):
        held.append(stretch)
        found = known.get(stretch)
        if found is None:
            word = stretch.rstrip()
            found = known[stretch] = (word, xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % ONE_IN == 0)
            if len(known) > MEMO_WORDS:
                known.clear()
        if found[1] or found[0] == before:
            out.append("".join(held))
            held = []
        before = found[0]
    if held:
        out.append("".join(held))
    return out


def digests(text: str, known: dict[str, tuple[str, bool]] | None = None) -> np.ndarray:
    """Digests of the text's paragraphs, each occurrence of a repeated paragraph its own; sorted, each once
    (a digest twice in a set would fill its cells for good)."""
    known = {} if known is None else known
    seen: dict[str, int] = {}
    hashes, times = [], []
    for paragraph in PARAGRAPH.split(text):
        for p in (paragraph,) if len(paragraph) <= LONG else pieces(paragraph, known):
            if p:
                n = seen.get(p, 0)
                seen[p] = n + 1
                hashes.append(xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")))
                times.append(n)
    # The occurrence is mixed in outside the hash, whose seeds may collide on short texts.
    return distinct(mix64(np.array(hashes, dtype=np.uint64) + np.array(times, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def cells_for(paragraphs: int) -> int:
    """Cells of the published sketch of a text: three parts of the least power of two with 1.5 a paragraph."""
    return 3 * max(LEAST_PART, 1 << max(0, (paragraphs + 1) // 2 - 1).bit_length())


def check_of(keys: np.ndarray) -> np.ndarray:
    return mix64(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)


LOW = np.uint64(0xFFFFFFFF)  # check sums count modulo 2^32


def cells_of(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each key in each of the three parts (of a power of two cells)."""
    third = cells // 3
    if 3 * third != cells or third & (third - 1):
        raise ValueError("a sketch has three parts of a power of two cells")
    out = []
    for part, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        h = mix64(keys ^ np.uint64(salt))
        out.append((h & np.uint64(third - 1)).astype(np.int64) + part * third)
    return out


def fold(sketch, cells: int):
    """A sketch of fewer cells from a larger one: cells whose hashes agree modulo the smaller size are added."""
    n = len(sketch[0])
    return tuple(x.reshape(n, 3, -1, cells // 3).sum(axis=2, dtype=x.dtype).reshape(n, cells) for x in sketch)


def sketches(sets: list[np.ndarray], cells: int):
    """(count, digest sum, check sum) arrays [len(sets), cells]; sums wrap around."""
    n = len(sets)
    count, key, check = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    if n and (lengths := [len(s) for s in sets]) and sum(lengths):
        row, keys = np.repeat(np.arange(n), lengths), np.concatenate(sets)
        _add(count, key, check, row * cells, keys, np.ones(len(keys), np.int64), cells)
    return count.reshape(n, cells), key.reshape(n, cells), check.reshape(n, cells)


def _add(count, key, check, base, keys, sign, cells) -> None:
    s = sign.astype(np.uint64)  # -1 wraps, so sums subtract
    c = check_of(keys)
    for at in cells_of(keys, cells):
        np.add.at(count, base + at, sign)
        np.add.at(key, base + at, keys * s)
        np.add.at(check, base + at, c * s)


def peel(count, key, check):
    """(row, digest, side) of the digests recovered from subtracted sketches, and whether each row came out whole."""
    n, cells = count.shape
    count, key, check = count.ravel().copy(), key.ravel().copy(), check.ravel().copy()
    found = []
    touched = np.flatnonzero(count)
    while len(touched):
        # Any cell that changed may have become pure, also one whose count was zero before.
        sign = count[touched]
        k = key[touched] * sign.astype(np.uint64)
        pure = (np.abs(sign) == 1) & ((check[touched] * sign.astype(np.uint64)) & LOW == check_of(k))
        if not pure.any():
            break
        row, k, sign = touched[pure] // cells, k[pure], sign[pure]
        order = np.lexsort((k, row))
        row, k, sign = row[order], k[order], sign[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (k[1:] != k[:-1])
        row, k, sign = row[first], k[first], sign[first]
        found.append((row, k, sign))
        _add(count, key, check, row * cells, k, -sign, cells)
        touched = np.unique(np.concatenate([row * cells + at for at in cells_of(k, cells)]))
    stuck = ((count != 0) | (key != 0) | (check & LOW != 0)).reshape(n, cells).any(axis=1)
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)), ~stuck
    return tuple(np.concatenate(x) for x in zip(*found)), ~stuck


def peeled(a: list[np.ndarray], b: list[np.ndarray]):
    """(indices, (row, digest, side)) of pairs whose differences came out whole, from sketches of the size of
    the smaller published one, retried with twice the cells where peeling gets stuck; ``row`` counts in ``indices``."""
    size = np.array([cells_for(min(len(x), len(y))) for x, y in zip(a, b)], dtype=np.int64)
    todo = np.arange(len(a))
    while len(todo):
        stuck = [todo[:0]]
        for cells in np.unique(size[todo]).tolist():
            same = todo[size[todo] == cells]
            # Some rows at a time, so that the cells held stay bounded.
            step = max(1, CELLS_AT_ONCE // cells)
            for at in range(0, len(same), step):
                part = same[at : at + step]
                x, y = sketches([a[i] for i in part], cells), sketches([b[i] for i in part], cells)
                (row, keys, side), whole = peel(x[0] - y[0], x[1] - y[1], x[2] - y[2])
                stuck.append(part[~whole])
                sure = whole[row]
                yield part[whole], (np.cumsum(whole)[row[sure]] - 1, keys[sure], side[sure])
        todo = np.concatenate(stuck)
        size[todo] *= 2


def differences(a: list[np.ndarray], b: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Recovered digests in ``a[i]`` alone and in ``b[i]`` alone."""
    out: list = [None] * len(a)
    for part, (row, keys, side) in peeled(a, b):
        for j, i in enumerate(part.tolist()):
            out[i] = (keys[(row == j) & (side > 0)], keys[(row == j) & (side < 0)])
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    d = np.zeros(len(a), np.int64)
    for part, (row, _, _) in peeled(a, b):
        d[part] = np.bincount(row, minlength=len(part))
    n = np.array([len(x) + len(y) for x, y in zip(a, b)], dtype=np.int64)
    return np.where(n + d > 0, (n - d) / np.maximum(n + d, 1), 1.0)


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    """The published sketches as text: numbers of paragraphs and cells, then the cells, base64."""
    out: list = [""] * len(sets)
    size = np.array([cells_for(len(s)) for s in sets], dtype=np.int64)
    for cells in np.unique(size).tolist():
        same = np.flatnonzero(size == cells).tolist()
        step = max(1, CELLS_AT_ONCE // cells)
        for at in range(0, len(same), step):
            part = same[at : at + step]
            count, key, check = sketches([sets[i] for i in part], cells)
            count, check = count.astype("<i4"), check.astype("<u4")
            for j, i in enumerate(part):
                head = len(sets[i]).to_bytes(4, "little") + cells.to_bytes(4, "little")
                out[i] = base64.b64encode(head + count[j].tobytes() + key[j].tobytes() + check[j].tobytes()).decode()
    return out


def read_fingerprint(text: str):
    """(paragraphs, sketch) of a published fingerprint; the sketch can be folded, subtracted and peeled
    (its check sums hold 32 bits)."""
    data = base64.b64decode(text)
    n, cells = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    count = np.frombuffer(data, "<i4", cells, 8).astype(np.int64)[None]
    key = np.frombuffer(data, "<u8", cells, 8 + 4 * cells)[None]
    return n, (count, key, np.frombuffer(data, "<u4", cells, 8 + 12 * cells).astype(np.uint64)[None])


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def successor_ranges(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows dealt by descending doc_id ranges, each range sorted and followed by its successor row (``tail``)."""
    spark = docs.sparkSession
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most ``ranges`` existing ids; several ranges to a partition even out what hashing them deals.
    q = rows.agg(F.percentile_approx("doc_id", [i / (4 * ranges) for i in range(1, 4 * ranges + 1)], 100_000), F.max("doc_id")).first()
    top = q[1]
    bounds = np.array(sorted({int(x) for x in q[0] or []} | ({int(top)} if top is not None else set())), dtype=np.int64)

    def deal(batches):
        for b in row_slices(batches):
            ids, texts = b.column(0).to_pylist(), b.column(1)
            rng, src, tail = [], [], []
            for i, x in enumerate(ids):
                # Range 0 has the largest ids; the last one also takes the nulls.
                at = int(np.searchsorted(bounds, x)) if x is not None else 0
                r = max(0, len(bounds) - 1 - at)
                rng.append(r), src.append(i), tail.append(False)
                if bounds[at] == x if len(bounds) else True:
                    rng.append(r - 1 if r else max(0, len(bounds) - 1)), src.append(i), tail.append(True)
            take = pa.array(src, pa.int64())
            yield pa.record_batch(
                [pa.array(rng, pa.int32()), pa.array(tail, pa.bool_()), b.column(0).take(take), texts.take(take)],
                names=["range", "tail", "doc_id", "text"],
            )

    dealt = rows.mapInArrow(deal, "range int, tail boolean, doc_id long, text string")
    return dealt.repartition(ranges, "range").sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(), "text")


def edited_report(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""

    def pairs(batches):
        """(range, doc_id, text, following) of every document; a range without smaller ids takes the next range's."""
        held, tail_of = None, None
        for b in row_slices(batches, 512):
            out = []
            for r, tail, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if tail:
                    if held is not None and held[0] == r:
                        out.append((held[1], held[2], text))
                        held = None
                    continue
                if held is not None:
                    out.append((held[1], held[2], text))
                held = (r, doc_id, text)
            if out:
                yield out
        if held is not None:
            raise RuntimeError(f"range {held[0]} has no successor row")

    def run(batches):
        known: dict[str, tuple[str, bool]] = {}
        for rows in pairs(batches):
            own = [digests(t, known) for _, t, _ in rows]
            texts = [edited(t, f) for _, t, f in rows]
            changed = [digests(t, known) for t in texts]
            # A row's next text is mostly the following row's own.
            after = [rows[i + 1][1] is r[2] if i + 1 < len(rows) else False for i, r in enumerate(rows)]
            following = [own[i + 1] if same else digests(rows[i][2], known) for i, same in enumerate(after)]
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]),
                    pa.array(fingerprints(own)),
                    pa.array(fingerprints(changed)),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, following)),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return successor_ranges(docs, ranges).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
