"""What the joins of op5 and op8 let through, and the tables that they leave behind."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from mercato.functions import common
from mercato.llm import jaccard_join, line_dedup
from tests.llm.helpers import brute_components


def folders(spark):
    at = common.materialized_folder(spark).removeprefix("file:")
    return set(os.listdir(at)) if os.path.exists(at) else set()


def test_settled_keeps_its_result_only(spark):
    before = folders(spark)

    def inner():
        return common.reuse_checkpointed(spark.range(10)).where("id > 3")

    def build():
        a = common.settled(inner)
        return common.reuse_checkpointed(a.select((F.col("id") * 2).alias("id"))).union(a)

    out = common.settled(build)
    assert len(folders(spark) - before) == 1
    assert sorted(r["id"] for r in out.collect()) == sorted([*range(4, 10), *range(8, 20, 2)])


def test_settled_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        common.settled(lambda: common.reuse_checkpointed(spark.range(1 // 0)))
    before = folders(spark)
    common.reuse_checkpointed(spark.range(3))
    common.settled(lambda: spark.range(3))
    assert len(folders(spark) - before) == 2


def some_docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_line_dedup_leaves_one_table(spark):
    before = folders(spark)
    d = line_dedup.dedup_documents(some_docs(spark, ["a b c d e f g h", "a b c d e f g h i", "other words of a line"]), line_dedup.WORDS)
    assert len(folders(spark) - before) == 1
    assert sorted((r["doc_id"], r["n_removed"]) for r in d.collect()) == [(0, 0), (1, 1), (2, 0)]


def test_one_of_each_leaves_one_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    before = folders(spark)
    d = jaccard_join.one_of_each(some_docs(spark, [text, text + " more", "other words of a line here"]))
    assert len(folders(spark) - before) == 1
    assert sorted(r["doc_id"] for r in d.collect()) == [0, 2]


def test_long_lines_that_differ_do_not_pair(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(1500)]
    lines = [rng.sample(vocabulary, 230) for _ in range(30)]
    near = [*lines[0][:-20], *(f"new{i}" for i in range(20))]
    made, real = [], line_dedup.verified

    def counted(docs, ranks, shingle_words, pairs, classes):
        made.append(pairs.count())
        return real(docs, ranks, shingle_words, pairs, classes)

    monkeypatch.setattr(line_dedup, "verified", counted)
    d = line_dedup.dedup_documents(some_docs(spark, [" ".join(w) for w in [*lines, near]]), line_dedup.WORDS)
    assert [r["doc_id"] for r in d.where("n_removed > 0").collect()] == [30]
    assert sum(made) < 10


def test_large_sets_that_differ_do_not_pair(spark, monkeypatch):
    shared = [f"s{i}" for i in range(300)]
    texts = [" ".join([*(f"d{k}w{i}" for i in range(700)), *shared]) for k in range(6)]
    texts.append(" ".join([*texts[0].split()[:-50], *(f"x{i}" for i in range(50))]))
    made, real = [], jaccard_join.set_pairs

    def counted(group_pairs, placed):
        made.append(group_pairs.where("ga != gb").count())
        return real(group_pairs, placed)

    monkeypatch.setattr(jaccard_join, "set_pairs", counted)
    found = jaccard_join.linked_documents(some_docs(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components(dict(enumerate(texts)))
    assert made[-1] == 0


def near_copies(n_lines, seed):
    """Lines around one text, of different sizes; only some of them are similar to each other."""
    rng = random.Random(seed)
    centre = [f"c{i}" for i in range(40)]
    lines = []
    for k in range(n_lines):
        kept = rng.sample(centre, 40 - rng.randint(2, 5))
        lines.append([*kept, *(f"l{k}w{i}" for i in range(rng.randint(0, 4)))])
    return lines


def removed_by_hand(lines):
    sets = [set(w) for w in lines]
    return [i for i, y in enumerate(sets) if any(100 * len(x & y) >= 75 * len(x | y) for x in sets[:i])]


def test_near_copies_are_settled_before_the_prefix_join(spark, monkeypatch):
    lines = near_copies(150, 3)
    made, real = [], line_dedup.verified

    def counted(docs, ranks, shingle_words, pairs, classes):
        made.append(pairs.count())
        return real(docs, ranks, shingle_words, pairs, classes)

    monkeypatch.setattr(line_dedup, "verified", counted)
    d = line_dedup.dedup_documents(some_docs(spark, [" ".join(w) for w in lines]), line_dedup.WORDS)
    assert sorted(r["doc_id"] for r in d.where("n_removed > 0").collect()) == removed_by_hand(lines)
    assert made[1] < 300


def test_prefix_pairs_by_shares(spark, monkeypatch):
    # Sizes from three words on, and lines of one document, whose order only ``verified`` knows.
    rng = random.Random(8)
    lines = []
    for k in range(60):
        words = [f"b{k}x{i}" for i in range(rng.randint(3, 60))]
        lines += [words, words[: -max(1, len(words) // rng.choice([4, 5, 8]))], [*words, f"more{k}"]]
    rng.shuffle(lines)
    texts = ["\n".join(" ".join(w) for w in lines[i : i + 2]) for i in range(0, len(lines), 2)]
    removed = removed_by_hand(lines)
    monkeypatch.setattr(line_dedup, "star_pairs", lambda classes: spark.createDataFrame([], "x long, y long"))
    written, real = [], line_dedup.share_pairs

    def counted(marked, share):
        written.append(share)
        return real(marked, share)

    monkeypatch.setattr(line_dedup, "share_pairs", counted)
    for shares in (1, 3):
        monkeypatch.setattr(line_dedup, "SHARES", shares)
        found = line_dedup.dedup_documents(some_docs(spark, texts), line_dedup.WORDS).collect()
        assert {r["doc_id"]: r["n_removed"] for r in found} == {i: sum(j // 2 == i for j in removed) for i in range(len(texts))}
    assert written == [0, 0, 1, 2]


def test_shared_shingles_by_shares(spark, monkeypatch):
    texts = [" ".join([*(f"w{i}" for i in range(60)), *(f"d{k}x{i}" for i in range(k))]) for k in range(8)]
    rows = some_docs(spark, texts).withColumn("row", F.xxhash64("text"))
    ranked = jaccard_join.frequent_shingles(rows.drop("row"))
    profile = common.reuse_checkpointed(jaccard_join.profiles(rows, ranked))
    found = []
    for shares in (1, 4):
        monkeypatch.setattr(jaccard_join, "SHARES", shares)
        parts = jaccard_join.shared_rows(profile)
        assert len(parts) == shares
        found.append(sorted(tuple(r) for part in parts for r in part.collect()))
    assert found[0] and found[0] == found[1]
