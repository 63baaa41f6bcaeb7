"""Plain-Python versions of the operators' rules, and the small tables the tests share."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 4001} and{i % 17}" for i in range(40_000))
EDGE_DOCS = [
    # doc_id, text, lang, source, n_chars, and extra columns whose names the operators use inside
    (1, "The cat sat on the mat and then it slept all day long.\nA second line of this text, rather short.", "en", "a", 1, "x", 5),
    (1, "The cat sat on the mat and then it slept all day long.\nA second line of this text, rather short.", "en", "a", 1, "x", 5),
    (2, "The cat sat on the mat and then it slept all day long.\nA second line of this text, rather short.", None, None, None, None, None),
    (3, "", "en", "b", 0, "", 0),
    (4, None, "de", "b", None, None, 1),
    (5, "   \n\t \n", None, "a", 6, "y", 2),
    (6, "1234 5678 !!! ??? ...", "en", "c", 5, "y", 2),
    (7, LONG, "en", "c", len(LONG), "z", 3),
    (8, "one", "fr", "c", 3, "z", 3),
    (None, "A document without an id, but with words in it.", "en", "a", 3, "z", 3),
    (None, None, None, None, None, None, None),
    (9, "Été \U0001f600 naïve café <|x|> \\ </s>", "fr", "d", 3, "z", 3),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, k1 int"


def edge_docs(spark):
    return spark.createDataFrame(EDGE_DOCS, EDGE_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def duck(sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def brute_components(texts):
    """Smallest doc_id reachable by links, from all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = defaultdict(list)
    for d, s in sorted(sets.items()):
        common = Counter(e for x in s for e in by_shingle[x])
        for e, c in common.items():
            if 100 * c >= 75 * (len(s) + len(sets[e]) - c):
                a, b = sorted((find(d), find(e)))
                root[b] = a
        for x in s:
            by_shingle[x].append(d)
    return {d: find(d) for d in texts}


def line_shingles(line, k=5):
    w = line.lower()
    for c in "\t\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return None
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_lines(texts):
    """Texts without the lines that an earlier line (by doc_id, line) is similar to."""
    seen, by_shingle, out = [], defaultdict(list), {}
    known = set()
    for d in sorted(texts):
        keep = []
        for line in texts[d].split("\n"):
            s = line_shingles(line)
            if s is None:
                keep.append(line)
                continue
            if s in known:
                continue
            known.add(s)
            common = Counter(e for x in s for e in by_shingle[x])
            if not any(100 * c >= 75 * (len(s) + len(seen[e]) - c) for e, c in common.items()):
                keep.append(line)
            for x in s:
                by_shingle[x].append(len(seen))
            seen.append(s)
        out[d] = "\n".join(keep)
    return out


def brute_matches(texts, items):
    """(doc, item) with a window of the item's size whose shingle multisets are similar."""
    found = set()
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(5, len(w))
        want = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
        for d, t in texts:
            x = words(t)
            if not x:
                continue
            # Shorter documents are one window; fewer than five words are one shingle.
            for s in range(max(1, len(x) - len(w) + 1)):
                part = x[s : s + len(w)]
                kk = 5 if len(part) >= 5 else len(part)
                if kk != k:
                    continue
                have = Counter(tuple(part[j : j + kk]) for j in range(len(part) - kk + 1))
                both = sum((have & want).values())
                if both >= 0.75 * (sum(have.values()) + sum(want.values()) - both):
                    found.add((d, i))
                    break
    return found
