"""Operator 3, language ID: a byte convolutional network trained in numpy.

Bytes are embedded, convolved with filters of several widths, max-pooled over
a fixed-length window and classified by softmax.  Training runs on the driver
over a bounded sample: at most about ``per_lang`` labelled documents of each
language (chosen by a hash of doc_id), ``windows`` windows of ``WINDOW`` bytes
each.  Scoring tiles every text whole into windows; a document's score is the
length-weighted mean of its windows' class probabilities.

At scoring time a filter of width 2..4 over embedded bytes is a sum of at most
two table rows indexed by byte pairs, so the convolution is a few gathers.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
without any labelled row everything is ``und``; rows with a null lang are never
learned from; null or repeated doc_id values are kept, one row out per row in;
extra columns are ignored; an empty table returns no rows.  Ties between
languages go to the first by code point.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from mercato.llm.text import row_slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PER_LANG = 1500
SAMPLE_WINDOWS = 2
UND = "und"
MIN_SCORE = 0.3  # a document whose best language scores less is rejected


@dataclass
class ByteCNN:
    """Embedding ``E`` [256, d], filters ``W[w]`` [w, d, F], biases and the softmax layer."""

    langs: list[str]
    E: np.ndarray
    W: list[np.ndarray]
    b: list[np.ndarray]
    U: np.ndarray
    c: np.ndarray

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width, filter responses of byte pairs: rows for the first pair and for what follows it."""
        out = []
        for w, W, b in zip(WIDTHS, self.W, self.b):
            one = [(self.E @ W[j]).astype(np.float32) for j in range(w)]
            pair = lambda p, q: (p[:, None, :] + q[None, :, :]).reshape(65536, FILTERS)
            first = pair(one[0], one[1]) + b.astype(np.float32)
            rest = None if w == 2 else one[2] if w == 3 else pair(one[2], one[3])
            out.append((first, rest))
        return out


def pooled(tables, x: np.ndarray) -> np.ndarray:
    """Max-pooled filter outputs of byte windows ``x`` [n, WINDOW]."""
    n, length = x.shape
    pairs = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
    feats = []
    for w, (first, rest) in zip(WIDTHS, tables):
        span = length - w + 1
        z = first[pairs[:, :span]]
        if w == 3:
            z += rest[x[:, 2:]]
        elif w == 4:
            z += rest[pairs[:, 2 : 2 + span]]
        feats.append(np.maximum(z.max(axis=1), 0))
    return np.concatenate(feats, axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 64, lr: float = 5e-3, seed: int = 7) -> ByteCNN:
    """Adam on the cross-entropy; the gradient reaches each filter only through its pooled position."""
    rng = np.random.default_rng(seed)
    E = rng.normal(0, 0.5, (256, EMBED))
    W = [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS]
    b = [np.zeros(FILTERS) for _ in WIDTHS]
    U = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs)))
    c = np.zeros(len(langs))
    params = [p.astype(np.float32) for p in (E, *W, *b, U, c)]
    E, W, b, U, c = params[0], params[1:4], params[4:7], params[7], params[8]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    n = len(y)
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at : at + batch]
            x, t = windows[rows], t + 1
            e = E[x]
            feats, tops = [], []
            for w, Wk, bk in zip(WIDTHS, W, b):
                span = x.shape[1] - w + 1
                z = sum((e[:, j : j + span] @ Wk[j] for j in range(1, w)), e[:, :span] @ Wk[0]) + bk
                top = z.argmax(axis=1)
                tops.append(top)
                feats.append(np.maximum(np.take_along_axis(z, top[:, None, :], axis=1)[:, 0], 0))
            f = np.concatenate(feats, axis=1)
            d = softmax(f @ U + c).astype(np.float32)
            d[np.arange(len(rows)), y[rows]] -= 1
            d /= len(rows)
            gU, gc, gf = f.T @ d, d.sum(axis=0), (d @ U.T) * (f > 0)
            gE, gW, gb = np.zeros_like(E), [], []
            for k, (w, Wk, top) in enumerate(zip(WIDTHS, W, tops)):
                g = gf[:, k * FILTERS : (k + 1) * FILTERS]
                gw = np.zeros_like(Wk)
                for j in range(w):
                    byte = np.take_along_axis(x, top + j, axis=1)
                    gw[j] = np.einsum("nfd,nf->df", E[byte], g)
                    np.add.at(gE, byte.ravel(), (g[:, :, None] * Wk[j].T[None]).reshape(-1, EMBED))
                gW.append(gw)
                gb.append(g.sum(axis=0))
            for i, (p, g) in enumerate(zip(params, [gE, *gW, *gb, gU, gc])):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p -= lr * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return ByteCNN(langs, E, W, b, U, c)


def tiles(data: bytes, size: int = WINDOW) -> np.ndarray:
    """The whole text in windows of ``size`` bytes, the last one padded with zeros."""
    n = -(-len(data) // size)
    return np.frombuffer(data.ljust(n * size, b"\0"), dtype=np.uint8).reshape(n, size)


def training_windows(docs: DataFrame, per_lang: int = PER_LANG, windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """``lang, window`` of a bounded hash sample: about ``per_lang`` documents a language, never over twice that."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return docs.sparkSession.createDataFrame([], "lang string, window binary")
    # Position of the document in hash order, as a fraction of the language's documents; the
    # text is hashed with the id, so rows of one id (or none) are drawn one by one.
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_lang / n))).otherwise(share)
    picked = learn.where(u < share).select("doc_id", "lang", "text")

    def cut(batches):
        for b in row_slices(batches):
            langs, out = [], []
            for doc_id, lang, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if not any(map(str.isalpha, text)):
                    continue
                data = text.encode("utf-8", "surrogatepass")
                x = tiles(data)
                rng = np.random.default_rng(zlib.crc32(data, zlib.crc32(str(doc_id).encode())))
                for k in sorted(rng.permutation(len(x))[:windows].tolist()):
                    langs.append(lang)
                    out.append(x[k].tobytes())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "window"])

    return picked.mapInArrow(cut, "lang string, window binary").limit(2 * per_lang * windows * len(counts))


def fit(docs: DataFrame, per_lang: int = PER_LANG, windows: int = SAMPLE_WINDOWS) -> ByteCNN | None:
    """Train on the bounded sample; ``None`` when nothing is labelled."""
    rows = training_windows(docs, per_lang, windows).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "window"], kind="stable")  # the same order whatever the partitions
    langs = sorted(rows["lang"].unique())
    x = np.frombuffer(b"".join(rows["window"]), dtype=np.uint8).reshape(-1, WINDOW)
    y = rows["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()
    return train(x, y, langs)


def held_out(of: int = 3, remainder: int = 1):
    """Rows never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == remainder, F.lit(False))


def predict_language(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``; see ``identified_documents``."""
    return identified_documents(docs, model).drop("text")


def identified_documents(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """All columns of ``docs`` (of the same names, replaced) and ``lang_pred, score`` of every whole text; only the text is read."""
    docs = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    langs = model.langs if model else [UND]
    at = docs.columns.index("text")
    handle = docs.sparkSession.sparkContext.broadcast((model.tables(), model.U, model.c) if model else None)

    def run(batches):
        net = handle.value
        for b in row_slices(batches):
            texts = b.column(at).to_pylist()
            pred, score = [UND] * len(texts), [0.0] * len(texts)
            known = [(i, t.encode("utf-8", "surrogatepass")) for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if net is not None and known:
                total = np.zeros((len(texts), len(langs)))
                for rows, x, weight in window_chunks(known):
                    p = softmax(pooled(net[0], x) @ net[1] + net[2])
                    np.add.at(total, rows, p * weight[:, None])
                for i, data in known:
                    p = total[i] / len(data)
                    pred[i], score[i] = langs[int(p.argmax())], float(min(1.0, p.max()))
            yield pa.record_batch([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def window_chunks(texts: list[tuple[int, bytes]], at_most: int = 512):
    """(row, window, bytes in the window) of all texts, ``at_most`` windows at a time."""
    rows, parts, weights, held = [], [], [], 0
    for i, data in texts:
        x = tiles(data)
        w = np.full(len(x), WINDOW)
        w[-1] = len(data) - WINDOW * (len(x) - 1)
        for k in range(0, len(x), at_most):
            part = x[k : k + at_most]
            if held + len(part) > at_most and held:
                yield np.concatenate(rows), np.concatenate(parts), np.concatenate(weights)
                rows, parts, weights, held = [], [], [], 0
            rows.append(np.full(len(part), i))
            parts.append(part)
            weights.append(w[k : k + at_most])
            held += len(part)
    if held:
        yield np.concatenate(rows), np.concatenate(parts), np.concatenate(weights)


def language_report(docs: DataFrame) -> DataFrame:
    found = predict_language(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """Documents in a learned language: neither ``und`` nor below ``MIN_SCORE``; a null ``lang`` is filled in."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_doc"), "text")
    d = identified_documents(rows, fit(docs)).where((F.col("lang_pred") != UND) & (F.col("score") >= MIN_SCORE))
    own = {"text": F.col("text"), "lang": F.coalesce("_doc.lang", "lang_pred")}
    return d.select(*[own.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])
