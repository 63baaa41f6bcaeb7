"""Operator 13, byte-level BPE encoding and decoding by prefix dynamic programming.

The encoding of a piece (one match of the splitting pattern) has one property
that makes a table possible: the encoding of any byte prefix ends in exactly one
token, and dropping that token leaves the encoding of the shorter prefix.  So
``last[i]``, the last token of the first ``i`` bytes, describes the encodings of
all prefixes at once.  ``last[i]`` is the one token ``t`` that ends at ``i``, encodes
to itself, and may follow ``last[i - len(t)]``: two tokens may stand side by side
when undoing their merges never meets an earlier merge across their border.
Walking back through ``last`` gives the ids.

* ``PrefixTable`` keeps ``last`` for one piece: ``append`` fills in the new bytes
  only, ``replace`` keeps the entries before the edit and, behind it, stops as soon as
  the longest token's length of entries has come out as before, since an entry
  depends on no more than that.
* ``Encoder`` splits texts at white space into stretches that no match spans, and
  remembers the ids of short stretches and matches (bounded).  A match that is a
  token as a whole is that token, as the merges also give where they reach it.
* ``EncodedText`` holds a text's matches with their tables; ``append`` and
  ``replace`` re-encode from the stretch the edit begins in to the first later one
  whose border the edit leaves in place.

The vocabulary (ranks of byte strings) is read by the driver from a file whose
path is a parameter and broadcast; its size is the vocabulary's, not the data's.

Defined cases: null text counts as empty, an empty text has no ids; repeated
rows, null or equal ids stay one row each; extra columns are ignored, whatever
their names; a text of any length is encoded whole, in time linear in its
length; an empty table returns no rows; ids outside the vocabulary make ``decode``
raise; null ids decode to an empty text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from bisect import bisect_left

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.text import row_slices

# The code points of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
REMEMBERED = 1 << 18  # stretches, and pairs of tokens, that a task remembers at a time
SHORT = 64  # code points of a stretch that may be remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of a base64 byte string and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Tokens by id, the merge that makes each, and an automaton of the tokens that encode to themselves.

    ``parts`` (from another vocabulary of the same ranks) saves working the merges out again.
    """

    def __init__(self, ranks: dict[bytes, int], parts: dict[int, tuple[int, int]] | None = None):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts = {} if parts is None else parts  # the merge a token comes from; none for single bytes
        self.merge = {halves: i for i, halves in self.parts.items()}
        self.neighbours: dict[tuple[int, int], bool] = {}  # answers of may_follow, bounded
        if parts is None:
            for token, i in sorted(ranks.items(), key=lambda x: x[1]):
                halves = self._halves(token, i)
                if halves:
                    self.merge[halves], self.parts[i] = i, halves
        self.endings = ahocorasick.Automaton()
        for token, i in ranks.items():
            if self.encodes_itself(i):
                self.endings.add_word(token.decode("latin-1"), (i, len(token)))
        self.endings.make_automaton()

    def _halves(self, token: bytes, i: int) -> tuple[int, int] | None:
        """The one split of a token whose halves stand side by side once all earlier merges are
        made; None for single bytes, and for tokens that the merges never reach."""
        for k in range(1, len(token)):
            a, b = self.ranks.get(token[:k], i), self.ranks.get(token[k:], i)
            if a < i and b < i and self.encodes_itself(a) and self.encodes_itself(b) and self.may_follow(a, b):
                return a, b
        return None

    def encodes_itself(self, token: int) -> bool:
        return token in self.parts or len(self.bytes[token]) == 1

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side: undo the later
        merge of the two, again and again; a merge across the border that comes before the
        one just undone would have been made instead.  Of equal merges the left one is made first."""
        before = None  # merges below this rank are made while the border looks as it does now
        while True:
            across = self.merge.get((left, right))
            if across is not None and (before is None or across < before):
                return False
            x, y = self.parts.get(left), self.parts.get(right)
            if x is None and y is None:
                return True
            if y is None or (x is not None and left > right):
                before, left = left, x[1]
            else:
                # An equal merge on the border's left is made before this one on its right.
                before, right = right + 1, y[0]

    def fits(self, left: int, right: int) -> bool:
        """``may_follow``, remembered in ``neighbours``."""
        if len(self.neighbours) >= REMEMBERED:
            self.neighbours.clear()
        fits = self.neighbours[left, right] = self.may_follow(left, right)
        return fits


class PrefixTable:
    """``last[i]``: the last token of the encoding of the first ``i`` bytes of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Bytes behind the piece; entries that are there stay as they are."""
        self._fill(self.piece + more, len(self.piece), None)

    def replace(self, start: int, stop: int, by: bytes) -> int:
        """Put ``by`` for the bytes ``start:stop``; returns how many entries were worked out anew."""
        if not 0 <= start <= stop <= len(self.piece):
            raise ValueError(f"{start}:{stop} lies outside the piece of {len(self.piece)} bytes")
        piece = self.piece[:start] + by + self.piece[stop:]
        behind = self.last[stop + 1 :]
        del self.last[start + 1 :]
        return self._fill(piece, start, behind)

    def _fill(self, piece: bytes, done: int, behind: list[int] | None) -> int:
        """Entries of ``piece`` behind the first ``done``; ``behind`` are earlier entries of its last bytes."""
        v, last, n = self.vocabulary, self.last, len(piece)
        known = v.neighbours
        first_old = n + 1 if behind is None else n + 1 - len(behind)
        end, same = done, 0  # entries up to ``end`` are there; how many of the latest came out as they were
        # Tokens by their last byte, the longest (and likeliest) first; one alone fits.
        for at, (token, size) in v.endings.iter(piece.decode("latin-1"), max(0, done + 1 - v.longest)):
            if at != end:
                continue
            if size <= end:
                fits = known.get((last[end + 1 - size], token))
                if fits is None:
                    fits = v.fits(last[end + 1 - size], token)
                if not fits:
                    continue
            last.append(token)
            end += 1
            if end >= first_old:
                same = same + 1 if token == behind[end - first_old] else 0
                if same >= v.longest:
                    last += behind[end + 1 - first_old :]
                    break
        if len(last) != n + 1:
            raise ValueError("no token fits: the ranks are no byte-pair merges")
        self.piece = piece
        return end - done

    def grown(self, piece: bytes) -> "PrefixTable":
        """A table of ``piece``, which begins with this one's; this one stays as it is."""
        out = PrefixTable(self.vocabulary)
        out.piece, out.last = self.piece, self.last.copy()
        out.append(piece[len(self.piece) :])
        return out

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes (all by default)."""
        out, at = [], len(self.piece) if length is None else length
        while at:
            token = self.last[at]
            out.append(token)
            at -= len(self.vocabulary.bytes[token])
        return out[::-1]


class Encoder:
    """Texts to ids; each match of ``pattern`` is encoded separately, without special tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.matches = vocabulary, regex.compile(pattern).findall
        # White space begins a stretch: no match goes on from other characters into it.
        self.stretches = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+").findall
        self.known: dict[str | bytes, bytes] = {}  # ids of short stretches and matches
        self.before: dict[str | bytes, bytes] = {}  # those remembered before ``known`` was begun

    def remember(self, key: str | bytes, ids: bytes) -> bytes:
        if len(key) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.before, self.known = self.known, {}
            self.known[key] = ids
        return ids

    def piece_ids(self, piece: bytes) -> bytes:
        ids = self.known.get(piece) or self.before.get(piece)
        if ids is None:
            whole = self.vocabulary.ranks.get(piece)
            ids = [whole] if whole is not None else PrefixTable(self.vocabulary, piece).ids()
            ids = self.remember(piece, array("I", ids).tobytes())
        return ids

    def stretch_ids(self, stretch: str) -> bytes:
        ids = self.before.get(stretch)
        if ids is None:
            ids = b"".join([self.piece_ids(match.encode()) for match in self.matches(stretch)])
        return self.remember(stretch, ids)

    def packed(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        known, out = self.known.get, []
        for stretch in self.stretches(text or ""):
            ids = known(stretch)
            if ids is None:
                ids = self.stretch_ids(stretch)
                known = self.known.get
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


class EncodedText:
    """A text's encoding that follows appends and edits without encoding the rest again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []  # where each stretch begins
        self.tables: list[list[PrefixTable]] = []  # the tables of its matches
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, by: str) -> int:
        """Put ``by`` for the code points ``start:stop``; returns how many stretches were encoded."""
        if not 0 <= start <= stop <= len(self.text):
            raise ValueError(f"{start}:{stop} lies outside the text of {len(self.text)} code points")
        text = self.text[:start] + by + self.text[stop:]
        grown = len(text) - len(self.text)
        # The stretch that holds the code point before the edit may change, earlier ones don't.
        first = max(0, bisect_left(self.starts, start) - 1)
        begin = self.starts[first] if self.starts else 0
        # Stretches from the first old border behind the edit on stay, if the new text still has a border there.
        keep = bisect_left(self.starts, stop + 1)
        while keep < len(self.starts) and not self._border(text, self.starts[keep] + grown):
            keep += 1
        until = self.starts[keep] + grown if keep < len(self.starts) else len(text)
        starts, tables, at = [], [], begin
        old = {t.piece: t for group in self.tables[first:keep] for t in group}
        for stretch in self.encoder.stretches(text[begin:until]):
            starts.append(at)
            tables.append([self._table(m.encode(), old) for m in self.encoder.matches(stretch)])
            at += len(stretch)
        self.starts[first:] = starts + [s + grown for s in self.starts[keep:]]
        self.tables[first:keep] = tables
        self.text = text
        return len(tables)

    @staticmethod
    def _border(text: str, at: int) -> bool:
        return 0 < at < len(text) and text[at] in WHITE_SPACE and text[at - 1] not in WHITE_SPACE

    def _table(self, piece: bytes, old: dict[bytes, PrefixTable]) -> PrefixTable:
        """A table of the old text's that the piece equals or extends, else a new one."""
        if piece in old:
            return old[piece]
        base = max((t for t in old if t and piece.startswith(t)), key=len, default=None)
        return PrefixTable(self.encoder.vocabulary, piece) if base is None else old[base].grown(piece)

    def ids(self) -> list[int]:
        ranks = self.encoder.vocabulary.ranks
        return [i for group in self.tables for t in group for i in ([ranks[t.piece]] if t.piece in ranks else t.ids())]


def _broadcast(spark: SparkSession, vocabulary_path: str):
    """Ranks and merges, worked out once on the driver; their size is the vocabulary's."""
    vocabulary = Vocabulary(read_ranks(vocabulary_path))
    return spark.sparkContext.broadcast({"ranks": vocabulary.ranks, "parts": vocabulary.parts})


def _encoder(shared, pattern: str) -> Encoder:
    """The encoder of a worker process: made for its first task, its memory of stretches kept for the next."""
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = Encoder(Vocabulary(held["ranks"], held["parts"]), pattern)
    return held["encoder"]


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every row."""
    shared = _broadcast(docs.sparkSession, vocabulary_path)

    def run(batches):
        encoder = _encoder(shared, pattern)
        for b in row_slices(batches, 256):
            packed = [encoder.packed(t) for t in b.column(1).to_pylist()]
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)))
            yield pa.record_batch([b.column(0), ids], names=["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, bytes binary`` from ``doc_id, ids``."""
    shared = _broadcast(encoded.sparkSession, vocabulary_path)

    def run(batches):
        tokens = {i: t for t, i in shared.value["ranks"].items()}
        for b in row_slices(batches, 256):
            texts = [b"".join(map(tokens.__getitem__, ids or ())) for ids in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, bytes binary")


def round_trip_report(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, then decoded from the ids."""
    shared = _broadcast(docs.sparkSession, vocabulary_path)

    def run(batches):
        encoder = _encoder(shared, pattern)
        for b in row_slices(batches, 256):
            packed = [encoder.packed(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    b.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(encoder.decode(np.frombuffer(p, dtype="<u4").tolist())).hexdigest() for p in packed], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
