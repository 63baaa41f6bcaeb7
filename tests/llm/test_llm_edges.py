"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

from __future__ import annotations

import hashlib

import pytest
from helpers import EDGE_DOCS, LONG, edge_docs, empty_docs, rows_of, shingles

from mercato.llm import chat, decontam, fingerprint, jaccard_join, language, line_dedup, lm_score, mixing, quality, secrets

LABELS = "doc_id long, quality int, toxic int"
BENCH = "item_id long, text string"


def labels(spark, rows=((1, 1, 0), (1, 0, 0), (3, 0, 0), (None, 1, None), (7, 1, 0), (8, None, 0))):
    return spark.createDataFrame(list(rows), LABELS)


def bench(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat and then it slept all day long."), (2, None), (3, ""), (None, "one")], BENCH)


PER_DOCUMENT = {
    "fingerprints": lambda s, d: fingerprint.edited_report(d, ranges=3),
    "language": lambda s, d: language.language_report(d),
    "quality": lambda s, d: quality.quality_report(d, labels(s)),
    "lines": lambda s, d: line_dedup.dedup_report(d),
    "mixing": lambda s, d: mixing.plan_mix(d),
    "join": lambda s, d: jaccard_join.linked_documents(d),
    "secrets": lambda s, d: secrets.secrets_report(d),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_input_row(spark, name):
    out = PER_DOCUMENT[name](spark, edge_docs(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in EDGE_DOCS)


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(spark, name):
    assert PER_DOCUMENT[name](spark, empty_docs(spark)).collect() == []


def test_fingerprint_edges(spark):
    out = fingerprint.edited_report(edge_docs(spark), ranges=2).collect()
    by = {r["doc_id"]: r for r in out}
    assert by[7]["n_chars"] == len(LONG) and by[3]["n_chars"] == by[4]["n_chars"] == 0
    # 4 is followed by 3, both empty; their edited texts are empty too.
    assert by[4]["near_edited"] == by[4]["near_next"] == 1.0 and by[4]["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[4]["fingerprint"] == by[3]["fingerprint"] != by[1]["fingerprint"] == by[2]["fingerprint"]
    assert [r["near_next"] for r in out if r["doc_id"] == 2] == [1.0]


def test_fingerprint_without_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string")
    out = fingerprint.edited_report(docs).collect()
    assert sorted(r["n_chars"] for r in out) == [1, 1]


def test_language_edges(spark):
    by = {r["doc_id"]: r for r in language.language_report(edge_docs(spark)).collect()}
    for d in (3, 4, 5, 6):
        assert (by[d]["lang_pred"], by[d]["score"]) == ("und", 0.0)
    assert by[7]["lang_pred"] in ("en", "fr", "de") and 0 <= by[7]["score"] <= 1


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert rows_of(language.language_report(docs).select("lang_pred", "score")) == [("und", 0.0)]


def test_accepted_documents_keep_columns(spark):
    kept = language.accepted_documents(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert {3, 4, 5, 6}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_quality_without_labels(spark):
    out = quality.quality_report(edge_docs(spark), spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in out} == {0.5} and {r["predicted"] for r in out} == {1}


def test_decontam_edges(spark):
    out = decontam.find_matches(edge_docs(spark), bench(spark), block_items=2)
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in out.collect()) == [(1, 1), (1, 1), (2, 1), (8, 0)]
    assert decontam.find_matches(empty_docs(spark), bench(spark)).collect() == []
    assert decontam.find_matches(edge_docs(spark), spark.createDataFrame([], BENCH)).collect() == []
    clean = decontam.clean_documents(edge_docs(spark), bench(spark))
    assert clean.columns == edge_docs(spark).columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(map(str, (3, 4, 5, 6, 7, 9, None, None)))


def test_line_edges(spark):
    by = {r["doc_id"]: r for r in line_dedup.dedup_documents(edge_docs(spark)).collect()}
    assert by[2]["n_removed"] == 2 and by[2]["text"] == "" and by[1]["n_removed"] == 0
    assert by[4]["text"] is None and by[4]["n_lines"] == 0
    assert by[5]["text"] == "   \n\t \n" and by[7]["text"] == LONG
    left = line_dedup.documents_left(edge_docs(spark))
    assert 2 not in {r["doc_id"] for r in left.collect()} and left.columns == edge_docs(spark).columns


def test_equal_lines_in_one_document(spark):
    text = "a b c d e f g\nother words stand here now, six\na b c d e f g"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r["text"] for r in line_dedup.dedup_documents(docs).collect()] == [text.rsplit("\n", 1)[0]]


def test_mixing_edges(spark):
    out = mixing.plan_mix(edge_docs(spark)).collect()
    assert all(r["taken"] in {k * r["size"] for k in range(4)} for r in out)
    assert {r["size"] for r in out if r["doc_id"] in (3, 4, 5)} == {0}
    mixed = mixing.mixed_documents(edge_docs(spark))
    assert mixed.count() == sum(r["copies"] for r in out)
    assert mixed.columns == [*edge_docs(spark).columns, "size", "copy"]


def test_mixing_without_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "b", "")], "doc_id long, source string, text string")
    assert {(r["target"], r["taken"]) for r in mixing.plan_mix(docs).collect()} == {(0.0, 0)}


def test_join_edges(spark):
    out = jaccard_join.linked_documents(edge_docs(spark)).collect()
    by = {r["doc_id"]: r for r in out}
    assert by[2]["component_id"] == by[1]["component_id"] == 1
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0
    assert [by[d]["component_id"] for d in (3, 4, 5)] == [3, 4, 5]
    assert by[8]["n_shingles"] == 1 and by[7]["n_shingles"] == len(shingles(LONG))
    kept = jaccard_join.one_of_each(edge_docs(spark))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, (1, 3, 4, 5, 6, 7, 8, 9, None, None)))
    assert kept.columns == edge_docs(spark).columns


def test_lm_edges(spark):
    by = {r["doc_id"]: r for r in lm_score.score_documents(edge_docs(spark)).collect()}
    assert set(by) == {r[0] for r in EDGE_DOCS}
    assert (by[3]["n_words"], by[3]["log_score"], by[3]["mean_log"]) == (0, 0.0, None)
    assert by[1]["n_words"] == 2 * by[2]["n_words"] and by[7]["n_words"] == 80_000
    assert lm_score.score_documents(empty_docs(spark)).collect() == []


def test_chat_edges(spark):
    rows = [
        (1, 1, "user", "a <|turn|> \\ [INST]"),
        (1, 0, "system", None),
        (1, 1, "user", "a <|turn|> \\ [INST]"),
        (1, 2, "assistant", "x" * 1000 + "<" + "</s>" * 3),
        (2, None, None, "no role"),
        (None, 0, "assistant", ""),
    ]
    t = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn int, role string, text string, message string")
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold_events(chat.table_events(t)))).collect()}
    assert [tuple(x) for x in back[1]["turns"]] == [("system", ""), rows[0][2:], rows[0][2:], rows[3][2:]]
    assert back[1]["loss_text"] == rows[3][3] and back[None]["loss_text"] == ""
    assert [tuple(x) for x in back[2]["turns"]] == [("", "no role")]
    assert chat.chat_report(t.limit(0)).collect() == []


CLASHING = ["lines", "n_removed", "n_lines", "_id", "_row", "_key", "_hash", "_text", "_lines", "_doc", "score", "lang_pred", "size", "copy", "input_size", "row", "_h", "_b", "_size"]


def clashing_docs(spark):
    rows = [(*r[:5], *(f"{r[0]} {c}" for c in CLASHING)) for r in EDGE_DOCS if r[1] is not LONG]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING))


def extras(df, names):
    return sorted(str(tuple(r[c] for c in ["doc_id", *names])) for r in df.collect())


def test_clashing_columns_stay_the_callers(spark):
    docs = clashing_docs(spark)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    stages = (line_dedup.documents_left, lambda d: decontam.clean_documents(d, bench(spark)), language.accepted_documents)
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in stage(plain).collect())
        assert all(r[c] == f"{r['doc_id']} {c}" for r in out.collect() for c in CLASHING)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [{"size": "input_input_size", "copy": "input_copy"}.get(c, c) for c in docs.columns] + ["size", "copy"]
    assert all(r["input_input_size"] == f"{r['doc_id']} size" and r["input_size"] == f"{r['doc_id']} input_size" for r in mixed.collect())
    deduped = line_dedup.dedup_documents(docs)
    assert {"input_n_lines", "input_n_removed", "n_lines", "n_removed"} <= set(deduped.columns) and deduped.count() == docs.count()


def test_languages_of_rows_without_ids(spark):
    rows = [(None, f"le chat dort sur la table et mange du pain numéro {i}", "fr") for i in range(300)]
    rows += [(1, f"the cat sleeps on the table and eats bread number {i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identified_documents(docs, language.fit(docs)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) > 570


def test_texts_of_many_lines(spark):
    text = "\n".join(["the same short line of words again"] * 20_000 + ["another line"])
    docs = spark.createDataFrame([(1, text), (2, "the same short line of words again\nits own line")], "doc_id long, text string")
    by = {r["doc_id"]: r for r in line_dedup.dedup_documents(docs).collect()}
    assert by[1]["text"] == "the same short line of words again\nanother line" and by[1]["n_removed"] == 19_999
    assert by[2]["text"] == "its own line"
