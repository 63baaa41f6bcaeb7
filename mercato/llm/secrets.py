"""Operator 9, secret scans: multipart credential linking.

One pass finds, per document, the strong (base) spans and the weak parts of
credentials.  Weak parts are then rows ``(document, kind, start)``; an interval
join on position bins keeps a weak part only when the complementary parts lie
within ``scope`` code points of it:

* ``key_id``   (temporary access identifier)  needs a secret part in scope,
* ``secret``   (bare 40-character key)        needs an access identifier in scope,
* ``endpoint`` (URL)                          needs an identifier and a secret in scope.

The join side is aggregated per (document, kind, bin) first, so a document with
many parts makes at most nine join rows per weak part, never all pairs.

Defined cases: null text counts as empty; empty texts return zero counts and
the digest of the empty string; null or repeated ``doc_id`` values are kept,
one output row per input row; extra columns are ignored; an empty table
returns no rows.  Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed
from mercato.llm.text import row_slices

# The base patterns and their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "key_id", "secret", "endpoint")
ASSIGN_K, ACCESS_K, HEX_K, KEY_ID_K, SECRET_K, ENDPOINT_K = range(6)

# Weak parts.
KEY_ID = re.compile(r"ASIA[A-Z0-9]{12,}")
BARE_SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"https?://[^\s\"'<>]+")

SCOPE = 400

_SPAN = "array<struct<kind:int,start:int,stop:int>>"
FOUND_SCHEMA = f"doc_id long, row_key string, base {_SPAN}, parts {_SPAN}"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Strong spans as (kind, start, end), ordered by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        # Matches are taken with the plain pattern and dropped afterwards: a short one still uses up its text.
        out += [(ASSIGN_K, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(ACCESS_K, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(HEX_K, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def credential_parts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Parts that may link: strong access identifiers and assigned secrets, weak identifiers, keys and URLs."""
    out = [s for s in base if s[0] in (ACCESS_K, ASSIGN_K)]
    if "ASIA" in text:
        out += [(KEY_ID_K, m.start(), m.end()) for m in KEY_ID.finditer(text)]
    for m in BARE_SECRET.finditer(text):
        t = m[0]
        if any(c.isdigit() for c in t) and any(c.islower() for c in t) and any(c.isupper() for c in t):
            out.append((SECRET_K, m.start(), m.end()))
    if "://" in text:
        out += [(ENDPOINT_K, m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    return out


def find_parts(docs: DataFrame) -> DataFrame:
    """Per document: base spans and credential parts (only of documents with at least one weak part)."""

    def run(batches):
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
        for b in row_slices(batches):
            keys, base, parts = [], [], []
            ids = b.column(0).to_pylist()
            for doc_id, text in zip(ids, b.column(1).to_pylist()):
                text = text or ""
                strong = base_spans(text)
                found = credential_parts(text, strong)
                weak = any(s[0] >= KEY_ID_K for s in found)
                keys.append(f"{doc_id}:{xxhash.xxh3_128_hexdigest(text.encode('utf-8', 'surrogatepass'))}" if weak else None)
                base.append([dict(kind=k, start=s, stop=e) for k, s, e in strong])
                parts.append([dict(kind=k, start=s, stop=e) for k, s, e in found] if weak else [])
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(base, span), pa.array(parts, span)],
                names=["doc_id", "row_key", "base", "parts"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND_SCHEMA)


def linked_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Interval join: ``(row_key, linked)`` with the weak parts whose complements lie within ``scope``."""
    part = (
        found.where(F.col("row_key").isNotNull())
        .select("row_key", F.explode(F.array_distinct("parts")).alias("p"))
        .select("row_key", "p.kind", "p.start", "p.stop")
        .distinct()
        .withColumn("bin", F.floor(F.col("start") / scope).cast("long"))
    )
    role = (
        F.when(F.col("kind").isin(ACCESS_K, KEY_ID_K), F.lit("id"))
        .when(F.col("kind").isin(ASSIGN_K, SECRET_K), F.lit("secret"))
    )
    # Earliest and latest start per (document, role, bin) decide whether any part of the bin is in scope.
    side = (
        part.withColumn("role", role)
        .where(F.col("role").isNotNull())
        .groupBy("row_key", "role", "bin")
        .agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
        .select("row_key", "role", "lo", "hi", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)])).alias("bin"))
    )
    weak = part.where(F.col("kind") >= KEY_ID_K)
    near = (
        weak.join(side, ["row_key", "bin"])
        .where((F.col("hi") >= F.col("start") - scope) & (F.col("lo") <= F.col("start") + scope))
        .groupBy("row_key", "kind", "start", "stop")
        .agg(
            F.max((F.col("role") == "id").cast("int")).alias("has_id"),
            F.max((F.col("role") == "secret").cast("int")).alias("has_secret"),
        )
    )
    kept = near.where(
        ((F.col("kind") == KEY_ID_K) & (F.col("has_secret") == 1))
        | ((F.col("kind") == SECRET_K) & (F.col("has_id") == 1))
        | ((F.col("kind") == ENDPOINT_K) & (F.col("has_id") == 1) & (F.col("has_secret") == 1))
    )
    return kept.groupBy("row_key").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("linked"))


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """All spans per document: ``doc_id, base, spans`` as arrays of ``(start, kind, stop)`` in order."""
    found = reuse_checkpointed(find_parts(docs))
    joined = found.join(linked_parts(found, scope), "row_key", "left")

    def ordered(col):
        return F.array_sort(F.transform(col, lambda s: F.struct(s["start"], s["kind"], s["stop"])))

    none = F.array().cast(_SPAN)
    return joined.select(
        "doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", F.coalesce("linked", none))).alias("spans")
    )


def span_text(col):
    """``kind:start:end`` comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            col,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def secrets_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    s = scan_secrets(docs, scope)

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return s.select(
        "doc_id",
        count(ASSIGN_K).alias("n_assign"),
        count(ACCESS_K).alias("n_access"),
        count(HEX_K).alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def base_digest(spans: list[tuple[int, int, int]]) -> str:
    """Brute-force form of ``base_sha256`` for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
