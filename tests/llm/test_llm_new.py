"""Periodic runs, whitening and byte BPE against brute force, numpy and the tokenizer library."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import EDGE_DOCS, LONG, SF, edge_docs, empty_docs

from mercato.llm import byte_bpe, periodic, whitening

# --- operator 11 ---


def brute_runs(w, min_words=6, min_repeats=4):
    """Every period at every place."""
    out = []
    for q in range(1, len(w) // min_repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, min_repeats * q):
                x = w[i : i + length]
                if not any(x[p:] == x[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def ids_of(words):
    ids = {}
    return np.array([ids.setdefault(x, len(ids) + 1) for x in words], dtype=np.int64)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (10, 3), (1, 2)])
def test_runs_equal_brute_force(limits):
    rng = random.Random(sum(limits))
    for _ in range(600):
        w = [rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(rng.randrange(60))]
        if w and rng.random() < 0.6:
            at, p = rng.randrange(len(w)), rng.randrange(1, 6)
            w[at:] = [w[at + i % min(p, len(w) - at)] for i in range(len(w) - at)]
            w += w[: rng.randrange(len(w))]
        assert periodic.runs_of(ids_of(w), *limits) == brute_runs(w, *limits)


def test_long_runs():
    assert periodic.runs_of(np.ones(100_000, dtype=np.int64)) == [(0, 100_000, 1)]
    assert periodic.runs_of(1 + np.arange(50_000) % 999) == [(0, 50_000, 999)]


def test_ordered_positions():
    rng = random.Random(2)
    values = rng.sample(range(100_000), 5_000)
    own = periodic.Positions(values[0])
    for v in values[1:]:
        own.add(v)
    inside = sorted(values)
    assert list(own) == inside
    for i in range(0, len(inside), 97):
        want = (inside[i - 1] if i else None, inside[i + 1] if i + 1 < len(inside) else None)
        assert own.neighbours(inside[i]) == want


def brute_report(doc_id, text):
    w = (text or "").encode().split()
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
        sha(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_runs_report_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in periodic.runs_report(docs).collect()}
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len((r["text"] or "").split()) < 1500]
    want = {brute_report(*r) for r in short}
    assert len(want) > 150 and want <= got
    assert any(r[1] for r in want)


def test_runs_edges(spark):
    rows = [(1, "a b " * 4), (None, "x " * 6), (2, None), (3, " \t\n"), (3, "é é é é é é tail"), (4, "a b a b a b a c c c c c c")]
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, runs int, collapsed string")
    by = {(r["doc_id"], r["n_words"]): r for r in periodic.find_runs(docs).collect()}
    assert [tuple(x) for x in by[1, 8]["runs"]] == [(0, 8, 2)] and by[1, 8]["collapsed"] == "a b"
    assert by[None, 6]["collapsed"] == "x" and by[2, 0]["runs"] == [] == by[3, 0]["runs"]
    assert by[3, 7]["collapsed"] == "é tail" and [tuple(x) for x in by[4, 13]["runs"]] == [(7, 6, 1)]
    assert {r["doc_id"]: r["text"] for r in periodic.collapsed_documents(docs).collect()}[1] == "a b"
    got = sorted((tuple(r) for r in periodic.runs_report(docs).collect()), key=str)
    assert got == sorted((brute_report(*r) for r in rows), key=str)
    assert len(periodic.runs_report(edge_docs(spark)).collect()) == len(EDGE_DOCS)
    assert periodic.runs_report(empty_docs(spark)).collect() == []


# --- operator 12 ---


def numpy_whitened(x, k):
    d = x - x.mean(axis=0)
    e, u = np.linalg.eigh(d.T @ d / len(x))
    e, u = e[::-1], u[:, ::-1]
    return d @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def compare(rows, vectors, k):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    want, explained = numpy_whitened(x, k)
    got = np.array([[r["whitened"] for r in sorted(g, key=lambda r: r["component"])] for g in rows])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-6
    n, total = len(x), x.sum(axis=0)
    for g, v in zip(rows, x):
        assert {r["deviation"] for r in g} == {int((((n * v - total).astype(object)) ** 2).sum())}
        assert {r["n"] for r in g} == {n} and max(r["identity_error"] for r in g) < 1e-4
        assert np.allclose([r["explained"] for r in sorted(g, key=lambda r: r["component"])], explained, rtol=1e-9)


def grouped(out, ids):
    by = {}
    for r in out.collect():
        by.setdefault(r["vec_id"], []).append(r)
    return [by[i] for i in ids]


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    compare(grouped(whitening.whitening_report(table), [r["vec_id"] for r in rows]), [r["embedding"] for r in rows], 32)


def test_whitening_of_copies_with_a_hot_vector(spark):
    rng = np.random.default_rng(1)
    some = rng.normal(size=(40, 5)).astype(np.float32)
    vectors = np.concatenate([np.repeat(some[:1], 400, axis=0), some, some[::-1], rng.normal(size=(300, 5)).astype(np.float32)])
    table = spark.createDataFrame([(i, v.tolist(), i) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, copies int")
    distinct = whitening.distinct_vectors(whitening.integer_vectors(table))
    assert distinct.agg({"copies": "sum"}).first()[0] == len(vectors) and distinct.count() < 341
    compare(grouped(whitening.whitening_report(table), range(len(vectors))), vectors, 5)
    one = whitening.fit(distinct, 3, weights="one")
    assert one.n == distinct.count() and one.components.shape == (5, 3)


def test_whitening_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -1.0]), (9, [3.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0])]
    rows += [(5, [inf, 1.0]), (6, []), (7, [1.0]), (8, [1e300, 0.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, x string")
    out = whitening.whitening_report(table).collect()
    assert sorted(str((r["vec_id"], r["component"])) for r in out) == sorted(str((i, c)) for i in (1, 1, None, 9) for c in (1, 2))
    assert whitening.whitening_report(table.limit(0)).collect() == []
    equal = whitening.whitening_report(table.where("vec_id = 1")).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in equal} == {(2, 0, None, None, None)}
    far = whitening.whitening_report(spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 1.0])], "vec_id long, embedding array<double>"))
    assert {r["deviation"] for r in far.collect()} == {None}
    assert whitening.from_mean(np.array([[1 << 55]]), 1 << 40, (3,)).tolist() == [[(1 << 95) - 3]]


# --- operator 13 ---

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.Vocabulary(byte_bpe.read_ranks(PATH)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_pieces_equal_the_library(encoder, library):
    rng, tokens = random.Random(1), list(encoder.vocabulary.ranks)
    for _ in range(8000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.choice((1, 2, 2, 3, 6))))
        table = byte_bpe.PrefixTable(encoder.vocabulary, piece)
        assert table.ids() == library._encode_single_piece(piece)
    for _ in range(3000):
        piece = bytes(rng.choice(b"aab bsse\xc3\xa9 ===--") for _ in range(rng.randrange(1, 60)))
        table = byte_bpe.PrefixTable(encoder.vocabulary, piece)
        assert table.ids() == library._encode_single_piece(piece)
        at = rng.randrange(1, len(piece) + 1)  # the table holds the encodings of all prefixes
        assert table.ids(at) == library._encode_single_piece(piece[:at])


def test_tables_follow_appends_and_edits(encoder):
    rng, v = random.Random(3), encoder.vocabulary
    for _ in range(400):
        piece = bytes(rng.choice(b"aabbsse th") for _ in range(rng.randrange(400)))
        table = byte_bpe.PrefixTable(v, piece)
        for _ in range(3):
            a = rng.randrange(len(piece) + 1)
            b, by = min(len(piece), a + rng.randrange(6)), bytes(rng.choice(b"absth ") for _ in range(rng.randrange(5)))
            table.replace(a, b, by)
            piece = piece[:a] + by + piece[b:]
            assert (table.piece, table.last) == (piece, byte_bpe.PrefixTable(v, piece).last)
    long = byte_bpe.PrefixTable(v, b"lorem ipsum dolor " * 3000)
    assert long.replace(100, 103, b"xyz") < 2 * v.longest + 10  # the rest stays


def test_texts_follow_appends_and_edits(encoder, library):
    rng = random.Random(4)
    parts = [" ", "\n", "a", "b", "the", "  ", "'s", "é", "==", "12", "　", "\x1c"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        own = byte_bpe.EncodedText(encoder, text)
        for _ in range(4):
            a = rng.randrange(len(text) + 1)
            b, by = min(len(text), a + rng.randrange(6)), "".join(rng.choice(parts) for _ in range(rng.randrange(5)))
            own.replace(a, b, by)
            text = text[:a] + by + text[b:]
            assert own.text == text and own.ids() == library.encode_ordinary(text)
        own.append("xy the end")
        assert own.ids() == library.encode_ordinary(text + "xy the end")
    long = byte_bpe.EncodedText(encoder, "some words of a text " * 500)
    assert long.replace(200, 204, "another") <= 4


def packed_sha(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_report_of_the_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in byte_bpe.round_trip_report(docs, PATH, public_tokenizers.PATTERN).collect()}
    want = set()
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), packed_sha(ids), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == want


def test_bpe_edges(spark, library):
    docs = edge_docs(spark)
    out = byte_bpe.round_trip_report(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(out) == len(EDGE_DOCS)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (3, 4)} == {0}
    assert [r["ids_sha256"] for r in out if r["doc_id"] == 7] == [packed_sha(library.encode_ordinary(LONG))]
    encoded = byte_bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    back = byte_bpe.decode_ids(encoded, PATH).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((r[1] or "").encode() for r in EDGE_DOCS)
    assert byte_bpe.round_trip_report(empty_docs(spark), PATH, public_tokenizers.PATTERN).collect() == []


def test_small_vocabularies_and_bad_input(encoder, tmp_path):
    bytes_only = {bytes([b]): b for b in range(256)}
    tiny = byte_bpe.Vocabulary(bytes_only | {b"aa": 256, b"aaa": 257, b"xyz": 258})
    assert byte_bpe.PrefixTable(tiny, b"aaaaa").ids() == [256, 257]
    # No merges make "xyz": only a piece that equals it is that token.
    own = byte_bpe.Encoder(tiny, public_tokenizers.PATTERN)
    assert own.encode("xyz") == [258] and own.encode("xyzx") == [120, 121, 122, 120]
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):
        byte_bpe.PrefixTable(encoder.vocabulary, b"abc").replace(2, 5, b"")
    file = tmp_path / "ranks"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in bytes_only.items()) + b"\n")
    assert byte_bpe.read_ranks(str(file)) == bytes_only
