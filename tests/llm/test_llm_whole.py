"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from helpers import line_shingles

from mercato.llm import decontam, jaccard_join, line_dedup, quality


def line_word_set(line):
    s = line_shingles(line, 1)
    return s and frozenset(w for t in s for w in t)


def brute_word_lines(texts):
    """Texts without the lines whose word sets an earlier line (by doc_id, line) is similar to, from all pairs."""
    seen, out = [], {}
    for d in sorted(texts):
        keep = []
        for line in texts[d].split("\n"):
            s = line_word_set(line)
            if s is None or not any(100 * len(s & e) >= 75 * len(s | e) for e in seen):
                keep.append(line)
            if s is not None:
                seen.append(s)
        out[d] = "\n".join(keep)
    return out


# ---------------------------------------------------------------- 4: quality


def test_training_reads_whole_texts(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]

    def text(tail):
        return " ".join(rng.choices(vocab, k=2100) + [tail] + rng.choices(vocab, k=20) + [tail])

    docs = [(i, text("fine" if i % 2 else "spoilt")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in docs], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sizes = {r["doc_id"]: int(np.frombuffer(r["counts"], np.int32).sum()) for r in quality.training_rows(frame, labels).collect()}
    assert len(sizes) > 30 and set(sizes.values()) == {2 * 2122 - 1}
    model = quality.fit(frame, labels)
    memo = quality.TokenHashes()
    fine, spoilt = (model.weights[quality.ngram_slots(w, memo)][0] for w in ("fine", "spoilt"))
    assert fine > 0 > spoilt


# ---------------------------------------------------------------- 5: lines


def test_lines_are_compared_by_their_words(spark):
    rng = random.Random(11)
    lines = []
    for size in (3, 4, 5, 8, 12, 20, 40):  # families of lines with some words replaced or moved
        base = [f"v{size}x{i}" for i in range(size)]
        for _ in range(12):
            x = list(base)
            for _ in range(rng.randrange(1 + size // 4)):
                x[rng.randrange(size)] = f"e{rng.randrange(9)}"
            if rng.random() < 0.3:
                rng.shuffle(x)
            lines.append(" ".join(x + ["more"] * rng.randrange(2)))
    lines += [" ".join(rng.choices(["a", "b", "c", "d", "e", "f"], k=rng.randrange(1, 9))) for _ in range(120)]
    rng.shuffle(lines)
    texts = {i: "\n".join([*lines[i::13], ""]) for i in range(13)}
    want = brute_word_lines(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.dedup_report(docs).collect()}
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    # One word of twelve replaced is five of eight shingles, and eleven of thirteen words.
    one = "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12"
    pair = spark.createDataFrame([(1, one), (2, one.replace("a6", "other"))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_report(pair).collect()} == {1: 0, 2: 1}


def test_word_lines_of_the_table(spark):
    import pandas as pd
    from helpers import SF

    from mercato.llm.text import documents

    d = pd.read_parquet(f"{SF}/documents.parquet")
    want = brute_word_lines(dict(zip(d.doc_id.tolist(), d.text)))
    got = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.dedup_report(documents(spark, SF)).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_rows_of_one_id_lose_their_own_lines(spark):
    rows = [(None, "p\nq"), (None, "r\np"), (7, "s\nt"), (7, "u\ns")]
    out = line_dedup.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = {i: sorted(x for r in out if r["doc_id"] == i for x in r["text"].split("\n") if x) for i in (None, 7)}
    assert left == {None: ["p", "q", "r"], 7: ["s", "t", "u"]}


# ---------------------------------------------------------------- 2 and 8: rows of one id


def texts_left(df):
    return sorted((str(r["doc_id"]), r["text"]) for r in df.collect())


def test_near_duplicates_of_rows_of_one_id(spark):
    x = " ".join(f"x{i}" for i in range(60))
    y, z = x.replace("x", "y"), x.replace("x", "z")
    rows = [(1, x), (1, y), (1, y), (2, y + " more"), (None, x + " end"), (None, z), (None, z + " end"), (None, ""), (None, ""), (None, None), (3, "")]
    left = texts_left(jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).fillna("null", "text"))
    want = [("1", x), ("1", y), ("3", ""), ("None", ""), ("None", "null")]
    assert left in [sorted([*want, ("None", t)]) for t in (z, z + " end")]


def test_decontamination_of_rows_of_one_id(spark):
    item = "the cat sat on the mat and then it slept all day long"
    rows = [(None, f"so {item} again"), (None, "a clean text without an id"), (1, item), (1, "a clean text of the same id"), (2, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert texts_left(decontam.clean_documents(docs, bench)) == sorted((str(i), t) for i, t in rows if "clean" in t)
