"""The operators against brute force, exact round trips, SQL and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pytest
import xxhash
from helpers import SF, SF_MID, brute_components, brute_lines, brute_matches, duck, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import chat, decontam, fingerprint, jaccard_join, line_dedup, mixing, queries, secrets
from mercato.llm.text import documents


def pdocs(sf=SF):
    return pd.read_parquet(f"{sf}/documents.parquet")


def texts_of(sf=SF):
    d = pdocs(sf)
    return dict(zip(d.doc_id.tolist(), d.text))


# ---------------------------------------------------------------- 1: fingerprints


def brute_pieces(text):
    """Paragraphs; those of more than 100 code points cut behind words whose hash is a multiple of 6 or that repeat."""
    for p in re.split(r"\n+|(?<=[.!?]) ", text):
        if len(p) <= 100:
            yield from [p] if p else []
            continue
        held, before = "", None
        for word in re.findall(r"\S{1,64}\s*|\s+", p):
            held += word
            word = word.rstrip()
            if word == before or xxhash.xxh3_64_intdigest(word.encode()) % 6 == 0:
                yield held
                held = ""
            before = word
        if held:
            yield held


def multiset_jaccard(a, b):
    x, y = (Counter(brute_pieces(t)) for t in (a, b))
    both, total = sum((x & y).values()), sum((x | y).values())
    return both / total if total else 1.0


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints_of_the_table(spark, ranges):
    texts = texts_of()
    ids = sorted(texts, reverse=True)
    out = {r["doc_id"]: r for r in fingerprint.edited_report(documents(spark, SF), ranges).collect()}
    assert set(out) == set(ids)
    for d, nxt in zip(ids, ids[1:] + ids[:1]):
        t, k = texts[d], len(texts[d]) // 2
        e = t[: len(t) - k] + texts[nxt][:k]
        assert out[d]["n_chars"] == len(t) and out[d]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert out[d]["near_edited"] == pytest.approx(multiset_jaccard(t, e))
        assert out[d]["near_next"] == pytest.approx(multiset_jaccard(t, texts[nxt]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=80), st.lists(st.integers(0, 60), max_size=80))
def test_peeling_recovers_all_differences(a, b):
    x, y = (np.array([h + 1 for h in sorted(set(s))], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in (a, b))
    mine, other = fingerprint.differences([x], [y])[0]
    assert (sorted(mine.tolist()), sorted(other.tolist())) == (sorted(set(x.tolist()) - set(y.tolist())), sorted(set(y.tolist()) - set(x.tolist())))
    assert (fingerprint.fingerprints([x]) == fingerprint.fingerprints([y])) == (set(a) == set(b))


def test_published_sketches_fold_subtract_and_peel():
    rng = np.random.default_rng(1)
    whole = 0
    for _ in range(60):
        x = rng.integers(1, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64)
        y = np.concatenate([x[: len(x) // 2], rng.integers(1, 1 << 63, int(rng.integers(0, 200)), dtype=np.uint64)])
        (n, p), (m, q) = (fingerprint.read_fingerprint(f) for f in fingerprint.fingerprints([x, y]))
        assert (n, m) == (len(x), len(y))
        cells = min(p[0].shape[1], q[0].shape[1])
        p, q = fingerprint.fold(p, cells), fingerprint.fold(q, cells)
        for folded, made in zip(p[:2], fingerprint.sketches([x], cells)[:2]):
            assert (folded == made).all()
        (_, keys, side), done = fingerprint.peel(p[0] - q[0], p[1] - q[1], p[2] - q[2])
        if done[0]:
            whole += 1
            assert sorted(keys[side > 0].tolist()) == sorted(set(x.tolist()) - set(y.tolist()))
            assert sorted(keys[side < 0].tolist()) == sorted(set(y.tolist()) - set(x.tolist()))
    assert whole > 20


def test_many_differences_take_few_cells(monkeypatch):
    most = []
    made = fingerprint.sketches
    monkeypatch.setattr(fingerprint, "sketches", lambda sets, cells: most.append(cells) or made(sets, cells))
    rng = np.random.default_rng(2)
    x, y = (rng.integers(1, 1 << 63, 20_000, dtype=np.uint64) for _ in range(2))
    mine, other = fingerprint.differences([x], [y])[0]
    assert len(mine) == len(other) == 20_000 and max(most) <= 6 * 40_000


def test_half_equal_long_texts_are_alike():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(5_000)]
    text = " ".join(rng.choice(words, 400))  # no line break, no sentence end
    other = fingerprint.edited(text, " ".join(rng.choice(words, 400)))
    assert 0.2 < fingerprint.likeness([fingerprint.digests(text)], [fingerprint.digests(other)])[0] < 0.5
    assert len(fingerprint.digests("x" * 100_000)) > 1
    # Every occurrence of a short repeated paragraph has its own digest.
    for p in ("=", "ab", "abcdefg", "x" * 40):
        assert len(fingerprint.digests("\n".join([p] * 3000))) == 3000


# ---------------------------------------------------------------- 2: decontamination


def test_decontamination_of_the_table(spark):
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    items = list(zip(bench.item_id.tolist(), bench.text))[:12]
    got = decontam.find_matches(documents(spark, SF), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_matches(list(texts_of().items()), items)


def test_decontamination_of_edited_passages(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate((3, 5, 8, 20, 40, 60, 60))]
    docs = []
    for i in range(60):
        item = rng.choice(items)[1].split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            item[rng.randrange(len(item))] = "edited"
        words = rng.choices(vocab, k=rng.randrange(0, 80))
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + item + words[at:])))
    got = decontam.find_matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_items=3
    )
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute_matches(docs, items)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=decontam.RADIUS))
def test_multi_index_lists_everything_within_the_radius(value, flips):
    other = value
    for f in flips:
        other ^= 1 << f
    a, b = (np.frombuffer(x.to_bytes(8, "little"), np.uint8)[None, :] for x in (value, other))
    index = decontam.SizeClass(5, [1], [(np.zeros(1, np.uint64), np.ones(1, np.int64))], a)
    w, i, d = index.within(b)
    assert (w.tolist(), i.tolist(), d.tolist()) == ([0], [0], [len(flips)])


# ---------------------------------------------------------------- 3 and 4: classifiers


def test_language_held_out_accuracy(spark):
    out = queries.op3_language_id(spark, SF_MID).toPandas().merge(pdocs(SF_MID)[["doc_id", "lang"]])
    held = out[out.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_quality_held_out_accuracy(spark):
    labels = pd.read_parquet(f"{SF_MID}/labels.parquet")
    out = queries.op4_quality_classifier(spark, SF_MID).toPandas()
    held = out.merge(labels)[lambda x: x.held_out]
    assert len(out) == len(pdocs(SF_MID)) and (held.predicted == held.quality).mean() > 0.9
    assert held[held.quality == 1].predicted.mean() > 0.98
    assert held[held.quality == 1].score.median() > held[held.quality == 0].score.median()


# ---------------------------------------------------------------- 5: lines


def test_lines_of_the_table(spark):
    want = brute_lines(texts_of())
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_documents(documents(spark, SF)).collect()}
    assert got == want


def test_near_lines(spark):
    rng = random.Random(5)
    base = [f"t{i}" for i in range(60)]
    lines = []
    for _ in range(50):  # chains and clusters of edited lines, and lines of two to six words
        x = list(base)
        for _ in range(rng.randrange(4)):
            x[rng.randrange(60)] = f"e{rng.randrange(6)}"
        lines.append(" ".join(x))
    lines += [" ".join(rng.choices(["a", "b", "c", "d"], k=rng.randrange(2, 7))) for _ in range(60)]
    rng.shuffle(lines)
    texts = {i: "\n".join(lines[i::11]) for i in range(11)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_documents(docs).collect()}
    assert got == brute_lines(texts)


# ---------------------------------------------------------------- 6: mixing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=4), st.integers(0, 120), st.integers(0, 8))
def test_budget_fit(histogram, budget, dp_words):
    sizes, counts = np.array(sorted(histogram)), np.array([histogram[s] for s in sorted(histogram)])
    take = mixing.fit_budget(sizes, counts, budget, dp_words=max(dp_words, 1))
    assert ((0 <= take) & (take <= counts)).all()
    if budget < int((sizes * counts).sum()):
        # The dynamic program is exact for what the shares leave over.
        share = np.array([int(c) * budget // int((sizes * counts).sum()) for c in counts])
        rest = budget - int((share * sizes).sum())
        sums = (sum(k * z for k, z in zip(ks, sizes.tolist())) for ks in product(*[range(int(c) + 1) for c in counts - share]))
        best = min(abs(s - rest) for s in sums)
        exact = mixing.fit_budget(sizes, counts, budget)
        assert abs(int((exact * sizes).sum()) - budget) == best


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing_of_the_table(spark):
    d = pdocs()
    out = mixing.plan_mix(documents(spark, SF)).toPandas().merge(d[["doc_id", "source", "text"]])
    assert (out["size"] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in out.text]).all()
    by = out.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.source_size).all()
    want = brute_targets(by["size"].to_dict())
    assert all(by.target[s] == pytest.approx(t) for s, t in want.items())
    assert ((by.taken - by.target).abs() <= 0.02 * by.target + 20).all()
    assert (out.taken <= 3 * out["size"]).all()
    again = mixing.plan_mix(documents(spark, SF).repartition(5)).toPandas()
    assert again.sort_values("doc_id").taken.tolist() == out.sort_values("doc_id").taken.tolist()


def test_targets_stop_at_three_times_the_source(spark):
    sizes = {"a": 1, "b": 1000, "c": 30, None: 500, "é": 2, "z": 0}
    rows = [("s" + (s or ""), s, n) for s, n in sizes.items()]
    out = mixing.source_targets(spark.createDataFrame(rows, "source_key string, source string, source_size long"))
    got = {r["source_key"]: r["target"] for r in out.collect()}
    assert all(got["s" + (s or "")] == pytest.approx(t) for s, t in brute_targets(sizes).items())


# ---------------------------------------------------------------- 7: chat


def test_folding_of_events(spark):
    log = [
        ("c", 1, 1, "message", "user", "hello"),
        ("c", 2, 2, "open", "assistant", None),
        ("c", 4, 2, "delta", None, "lo"),
        ("c", 3, 2, "delta", None, "fal"),
        ("c", 5, 3, "message", "user", "dropped by the regeneration"),
        ("c", 6, 2, "regenerate", None, None),
        ("c", 7, 2, "delta", None, "new "),
        ("c", 8, 2, "delta", None, "text"),
        ("c", 9, 1, "edit", None, "hello?"),
        ("c", 10, 3, "message", "user", "again"),
        ("d", 1, 1, "delta", None, "only a delta"),
    ]
    ev = spark.createDataFrame(log, "conv_id string, seq long, message long, kind string, role string, text string")
    out = sorted(tuple(r) for r in chat.fold_events(ev).collect())
    assert out == [("c", 1, "user", "hello?"), ("c", 2, "assistant", "new text"), ("c", 3, "user", "again"), ("d", 1, "", "only a delta")]


CHARS = st.text(alphabet="a<|>\\/s[]INST\n", max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|x"]), CHARS), min_size=1, max_size=12))
def test_chat_round_trip(spark, turns):
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, message long, role string, text string")
    out = chat.read_back(chat.render(rows)).first()
    assert [tuple(x) for x in out["turns"]] == turns
    assert out["loss_text"] == "".join(t for r, t in turns if r == "assistant")


@pytest.mark.parametrize("name", ["op7_chat_formatting", "op10_lm_scoring"])
def test_queries_equal_their_sql(spark, name):
    got = queries.llm_queries()[name](spark, SF).toPandas()
    want = duck(SF).execute(queries.llm_oracles()[name]).df()
    key = got.columns[0]
    got, want = (x.sort_values(key).reset_index(drop=True)[sorted(x.columns)] for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


# ---------------------------------------------------------------- 8: join


def test_join_of_the_table(spark):
    texts = texts_of()
    out = {r["doc_id"]: r for r in jaccard_join.linked_documents(documents(spark, SF)).collect()}
    assert {d: r["n_shingles"] for d, r in out.items()} == {d: len(shingles(t)) for d, t in texts.items()}
    assert {d: r["component_id"] for d, r in out.items()} == brute_components(texts)


def test_join_of_chains_and_shared_passages(spark):
    rng = random.Random(8)
    base, passage = [f"b{i}" for i in range(80)], [f"p{i}" for i in range(40)]
    docs, x = {}, list(base)
    for i in range(40):  # a chain: every document links to the next ones only
        x = list(x)
        x[(7 * i) % 80] = f"n{i}"
        docs[100 - i] = " ".join(x)
    for i in range(30):  # near copies of one text
        y = list(base)
        y[rng.randrange(80)] = f"m{i}"
        docs[200 + i] = " ".join(y)
    for i in range(30):  # documents that share most of a passage with few or some words of their own
        docs[300 + i] = " ".join(passage + [f"u{i}x{j}" for j in range(rng.randrange(2, 14))])
    out = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_documents(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert out == brute_components(docs)


# ---------------------------------------------------------------- 9: secrets

SECRET_TEXTS = [
    "password=abcdefgh and PASSWD : 'abcdefghi' token=short api-key=zzzzzzzzz",
    "secret: token = abcdefgh12",
    "AKIA" + "A" * 12 + " AKIA123 " + "f" * 32 + "0" * 5 + " " + "a" * 31,
    "ASIA" + "B" * 12 + " x " + "aB3/" * 10 + " https://h.example/p",
    "aB3/" * 10 + " far away" + " ." * 400 + " ASIA" + "B" * 12,
    "https://only.example/url",
    "é " * 10 + "token=ABCDEFGHIJ",
    "",
]


def test_secrets(spark):
    docs = spark.createDataFrame(list(enumerate(SECRET_TEXTS)), "doc_id long, text string")
    by = {r["doc_id"]: r for r in secrets.secrets_report(docs).collect()}
    plain = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for d, text in enumerate(SECRET_TEXTS):
        spans = [("assign", m.start(), m.end()) for m in plain.finditer(text) if len(m[2]) >= 8]
        spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert by[d]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
        assert set(joined.split(",")) - {""} <= set(by[d]["spans"].split(","))
    # Weak parts only together: the identifier, the key and the URL of text 3.
    assert by[3]["spans"] == "key_id:0:16,secret:19:59,endpoint:60:79"
    assert by[4]["spans"] == by[5]["spans"] == ""


def test_secrets_of_the_table(spark):
    out = {r["doc_id"]: r for r in queries.op9_secret_scan(spark, SF).collect()}
    for d, text in texts_of().items():
        spans = secrets.base_spans(text)
        assert out[d]["base_sha256"] == secrets.base_digest(spans)
        assert (out[d]["n_assign"], out[d]["n_access"], out[d]["n_hex"]) == tuple(sum(s[0] == k for s in spans) for k in range(3))


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    texts, seen = texts_of(), []
    docs = documents(spark, SF)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from mercato.functions.common import reuse_checkpointed

        docs = reuse_checkpointed(stage(spark, docs, SF))
        assert docs.columns == names
        seen.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    language, lines, join, clean = seen
    assert set(language) == {d for d, t in texts.items() if any(map(str.isalpha, t))}
    cut = brute_lines(language)
    assert lines == {d: t for d, t in cut.items() if t == language[d] or t.split()}
    components = brute_components(lines)
    assert join == {d: t for d, t in lines.items() if components[d] == d}
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    bad = {d for d, _ in brute_matches(list(join.items()), list(zip(bench.item_id.tolist(), bench.text)))}
    assert clean == {d: t for d, t in join.items() if d not in bad}
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs).collect()}
    mixed = Counter(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert mixed == Counter({d: n for d, n in plan.items() if n})
