"""Operator 8, n-gram Jaccard join: grouped prefix join.

A document is the set of its distinct five-word shingles, as 64-bit hashes.
Two sets link when their Jaccard similarity is at least 75 %.

1. Shingles that tasks see often are ranked (a bounded table of the
   ``HOT_SHINGLES`` most frequent); every set is ordered rarest first: other
   shingles by hash, then the ranked ones.  Any fixed order gives the same
   links; this one keeps shared passages out of the prefixes.
2. Two linked sets share a shingle of their prefixes of ``n - ceil(0.75 n) + 1``
   shingles.  Documents of equal prefix and size form one group, and only
   groups enter the join.
3. Group rows meet on prefix shingles, part by part of the shingles.  First each group is paired with the
   smallest group of every shingle it shares (a star, linear in the rows) and
   those pairs are verified; their links give preliminary components.  A second
   star around the groups that have a shingle earliest joins more of them.
4. Only pairs of groups in different components can still add anything: shingles
   whose groups are all in one component are dropped, and the rest is joined
   with length and positional filters inside the join: what a linked pair shares
   first leaves enough of both sets behind it.
5. Group pairs are expanded to pairs of distinct sets.  A parity of about one bit
   a shingle bounds what two sets do not share and drops most pairs below 75 %;
   the others are verified on the whole sets, which are computed again from the
   texts of candidates only.

No link between different components is lost, while thousands of near copies of
one text cost a star instead of all pairs; exact copies are one node.

Defined cases: null or wordless text has no shingle and links with nothing;
fewer than five words are one shingle; repeated rows are equal sets, null
doc_ids are kept and never become a component id while another id is there (in
``one_of_each`` rows of one doc_id and different texts are documents of their own);
extra columns are ignored; an empty table returns no rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed, settled
from mercato.llm.components import connected_components
from mercato.llm.text import WordHashes, distinct, shingle_hashes, text_words

SHINGLE = 5
PERCENT = 75
HOT_SHINGLES = 1 << 17  # rows of the rarity table that goes to every task
HOT_COUNT = 8
FLUSH_SHINGLES = 1 << 20
SLOT_BITS = 22
SALTS = 64
SHARES = 4  # parts of the shingles whose rows are shuffled one after another: only one part's are on disk at a time
STAR_ROUNDS = 2
JOIN_LONGS = 64  # parities up to this size are carried by the rows of the pair join; longer ones are compared after it
CANDIDATE_BITS = 24  # size of the candidate bitmap: 2 MB whatever the input


def shingle_set(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes (int64 view) of a text's word hashes."""
    return distinct(shingle_hashes(words, k).view(np.int64))


def parity(s: np.ndarray) -> np.ndarray:
    """Parities of the set's shingles in hash slots, as longs; as many slots as the power of two from ``len(s)`` on (at least 64).

    A shingle that two sets do not share flips one bit, and the halves of a
    parity, added up, are the parity of half as many slots.
    """
    slots = max(64, 1 << (len(s) - 1).bit_length())
    slot = (s.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32) & np.uint64(slots - 1)
    odd = np.bincount(slot.astype(np.int64), minlength=slots).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def similar_parity(sa, sb, na, nb):
    """Sets of similarity PERCENT differ in at most (100 - PERCENT) / (100 + PERCENT) of their sizes' sum."""
    size = F.least(F.size(sa), F.size(sb))

    def xor(x, y):
        return x.bitwiseXOR(y)

    def folded(p):
        # Sizes within PERCENT are at most one power of two apart.
        return F.when(F.size(p) > size, F.zip_with(F.slice(p, 1, size), F.slice(p, size + 1, size), xor)).otherwise(p)

    apart = F.aggregate(F.zip_with(folded(sa), folded(sb), xor), F.lit(0), lambda acc, x: acc + F.bit_count(x))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (na + nb)


def set_key(s: np.ndarray) -> bytes:
    return hashlib.md5(s.tobytes()).digest()


def frequent_shingles(rows: DataFrame, at_most: int = HOT_SHINGLES) -> np.ndarray:
    """The most frequent shingles, least frequent first.  Counts leave out shingles that occur once in a block of a task."""

    def run(batches):
        held, n = [], 0

        def flush():
            s = np.concatenate(held)
            # Shingles alone in their hash slot occur once; only the others are sorted.
            slot = s.view(np.uint64) >> np.uint64(64 - SLOT_BITS)
            s = np.sort(s[np.bincount(slot.astype(np.int64), minlength=1 << SLOT_BITS)[slot.astype(np.int64)] > 1])
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
            c = np.diff(np.append(first, len(s)))
            return pa.record_batch([pa.array(s[first][c > 1]), pa.array(c[c > 1])], names=["shingle", "n"])

        for _, texts in text_words(batches, WordHashes()):
            for words in texts:
                held.append(shingle_hashes(words, SHINGLE).view(np.int64))
                n += len(held[-1])
            if n >= FLUSH_SHINGLES:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    top = (
        rows.mapInArrow(run, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= HOT_COUNT)
        .orderBy(F.col("n").desc(), "shingle")
        .limit(at_most)
        .toArrow()
    )
    return np.asarray(top.column("shingle").combine_chunks().to_numpy(zero_copy_only=False), dtype=np.int64)[::-1].copy()


class RarityOrder:
    """Orders a set's shingles: unranked ones by hash, then ranked ones, the most frequent last."""

    def __init__(self, ranked: np.ndarray):
        by_hash = np.argsort(ranked)
        self.sorted, self.rank = ranked[by_hash], by_hash
        self.slots = np.zeros(1 << 20, dtype=bool)
        self.slots[self._slot(ranked)] = True

    @staticmethod
    def _slot(s: np.ndarray) -> np.ndarray:
        return (s.view(np.uint64) >> np.uint64(44)).astype(np.int64)

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The ordered set and the number of unranked shingles (they come first)."""
        maybe = np.flatnonzero(self.slots[self._slot(s)])
        if not len(maybe):
            return s, len(s)
        at = np.minimum(np.searchsorted(self.sorted, s[maybe]), len(self.sorted) - 1)
        found = self.sorted[at] == s[maybe]
        hot, at = maybe[found], at[found]
        cold = np.ones(len(s), dtype=bool)
        cold[hot] = False
        return np.concatenate([s[cold], s[hot][np.argsort(self.rank[at])]]), len(s) - len(hot)


PROFILE = "doc_id long, n long, set_id binary, grp long, cold int, prefix array<long>, row long, bits array<long>"


def profiles(rows: DataFrame, ranked: np.ndarray) -> DataFrame:
    """Per document: set size and key, group key, the prefix and parity (once per task and group, task and set) and the row key, the third column of ``rows``."""
    handle = rows.sparkSession.sparkContext.broadcast(ranked)

    def run(batches):
        order, seen, met = RarityOrder(handle.value), set(), set()
        for b, texts in text_words(batches, WordHashes()):
            n, keys, groups, colds, prefixes, bits = [], [], [], [], [], []
            for words in texts:
                s = shingle_set(words)
                size = len(s)
                n.append(size)
                if not size:
                    keys.append(None), groups.append(None), colds.append(0), prefixes.append(None), bits.append(None)
                    continue
                ordered, cold = order(s)
                prefix = ordered[: size - -(-PERCENT * size // 100) + 1]
                grp = hashlib.md5(size.to_bytes(8, "little") + prefix.tobytes()).digest()
                if len(met) > 1 << 20:
                    seen.clear(), met.clear()
                keys.append(set_key(s)), groups.append(int.from_bytes(grp[:8], "little", signed=True)), colds.append(min(cold, len(prefix)))
                prefixes.append(None if grp in seen else prefix)
                seen.add(grp)
                bits.append(None if keys[-1] in met else parity(s))
                met.add(keys[-1])
            yield pa.record_batch(
                [
                    b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(groups, pa.int64()),
                    pa.array(colds, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), b.column(2), pa.array(bits, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "set_id", "grp", "cold", "prefix", "row", "bits"],
            )

    return rows.mapInArrow(run, PROFILE)


def shared_rows(profile: DataFrame) -> list[DataFrame]:
    """``shingle, hot, grp, n, pos, pivot, pivot_n``, share by share: group rows on shingles that several groups share."""
    return [shared_share(profile, i) for i in range(SHARES)]


def shared_share(profile: DataFrame, share: int) -> DataFrame:
    """The rows of one of ``SHARES`` parts of the shingles.

    The pivot is the smallest group of the shingle.  Ranked shingles are first
    reduced within ``SALTS`` parts, so a very frequent one is no single task's.
    """
    rows = profile.where(F.col("prefix").isNotNull()).select("grp", "n", "cold", F.posexplode("prefix").alias("pos", "shingle"))
    rows = rows.where(F.pmod("shingle", F.lit(SHARES)) == share)
    salt = F.when(F.col("pos") >= F.col("cold"), F.pmod("grp", F.lit(SALTS))).otherwise(0).cast("int")
    rows = rows.select("shingle", salt.alias("salt"), "grp", F.col("n").cast("int").alias("n"), F.col("pos"), (F.col("pos") >= F.col("cold")).alias("hot"))
    part = Window.partitionBy("shingle", "salt").orderBy("n", "grp")
    first = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "*",
        F.first(F.struct("grp", "n")).over(first).alias("pivot"),
        F.lag("grp").over(part).alias("before"),
        F.lead("grp").over(part).alias("after"),
    )
    # Copies of a group from several tasks are next to each other; singletons have no neighbour.
    rows = rows.where("before IS NULL OR before != grp").where("hot OR before IS NOT NULL OR after IS NOT NULL")
    return rows.select("shingle", "hot", "grp", "n", "pos", F.col("pivot.grp").alias("pivot"), F.col("pivot.n").alias("pivot_n"))


def likely(pairs: DataFrame) -> DataFrame:
    """Group pairs ``a, b`` from rows ``a, b, na, nb``, one per common prefix shingle: length and positional filters.

    What two sets have in common is in both prefixes or behind the prefix of one
    of them, so the common prefix shingles plus the longer rest must reach the
    overlap that 75 % needs.
    """
    def rest(n):
        return F.col(n) - prefix_length(F.col(n))

    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    c = pairs.where(fits).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("common"))
    reach = F.col("common") + F.greatest(rest("na"), rest("nb"))
    return c.where((100 + PERCENT) * reach >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def prefix_length(n):
    return n - F.ceil(n * PERCENT / 100) + 1


def star_pairs(shared: DataFrame) -> DataFrame:
    """Likely group pairs (pivot, other); for ranked shingles also the parts' pivots with each other."""
    near = shared.where(F.col("pivot") != F.col("grp"))
    near = near.select(F.col("pivot").alias("a"), F.col("grp").alias("b"), F.col("pivot_n").alias("na"), F.col("n").alias("nb"))
    tops = shared.where("hot AND pivot = grp")
    first = Window.partitionBy("shingle").orderBy("n", "grp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tops = tops.select("grp", "n", F.first(F.struct("grp", "n")).over(first).alias("p")).where(F.col("p.grp") != F.col("grp"))
    tops = tops.select(F.col("p.grp").alias("a"), F.col("grp").alias("b"), F.col("p.n").alias("na"), F.col("n").alias("nb"))
    return likely(near.union(tops))


def candidate_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set_id, shingles`` of the wanted sets (``doc_id, set_id``), computed again from the texts.

    A fixed-size bitmap of wanted doc_ids spares most other texts the work; the join on set_id decides.
    """
    bits = 1 << CANDIDATE_BITS
    slot = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(bits))
    parts = (
        wanted.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / 32768).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg((F.col("slot") % 32768)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((bits // 32768, 4096), dtype=np.uint8)
    for r in parts:
        bitmap[r["part"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    handle = rows.sparkSession.sparkContext.broadcast(bitmap.ravel())

    def run(batches):
        mask = handle.value

        def wanted_rows():
            for b in batches:
                at = b.column(2).to_numpy(zero_copy_only=False)
                hit = np.flatnonzero(mask[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                yield b.take(pa.array(hit))

        for _, texts in text_words(wanted_rows(), WordHashes()):
            sets = [shingle_set(words) for words in texts]
            if sets:
                yield pa.record_batch(
                    [pa.array([set_key(s) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["set_id", "shingles"]
                )

    found = rows.withColumn("slot", slot).mapInArrow(run, "set_id binary, shingles array<long>")
    return found.join(wanted.select("set_id").distinct(), "set_id", "left_semi")


def verified(rows: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of set ids whose whole sets have at least 75 % of their union in common."""
    return settled(lambda: linked_pairs(rows, pairs, members))


def linked_pairs(rows: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    x = members.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("pa"))
    y = members.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("pb"))
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    near = pairs.join(x, "a").join(y, "b").where(fits).where(similar_parity(F.col("pa"), F.col("pb"), F.col("na"), F.col("nb")))
    pairs = reuse_checkpointed(near.select("a", "b"))
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
    sets = candidate_sets(rows, members.join(ends, "set_id").select("doc_id", "set_id")).dropDuplicates(["set_id"])
    sets = reuse_checkpointed(sets)
    b = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb"))
    a = sets.join(pairs.select(F.col("a").alias("set_id")).distinct(), "set_id", "left_semi").select(F.col("set_id").alias("a"), F.col("shingles").alias("sa"))
    both = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)
    return pairs.join(b, "b").join(a, "a").where(linked).select("a", "b")


def sets_and_rows(profile: DataFrame) -> tuple[DataFrame, ...]:
    """(the sets with their group, least document, size and parity, the shares of ``shared_rows``)."""
    members = profile.where("n > 0").groupBy("set_id", "grp").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits", ignorenulls=True).alias("bits")
    )
    return members, *shared_rows(profile)


def set_components(rows: DataFrame, members: DataFrame, shared: DataFrame) -> DataFrame:
    """``set_id, component`` (a set id) of the sets that link with another one."""
    lead = members.groupBy("grp").agg(F.min("set_id").alias("lead"))
    crowd = members.join(lead, "grp")
    # Star: pivots' leading sets with all members, and each group's leading set with its members.
    stars = (
        star_pairs(shared)
        .join(lead.select(F.col("grp").alias("a"), "lead"), "a")
        .join(members.select(F.col("grp").alias("b"), "set_id"), "b")
        .select(F.col("lead").alias("a"), F.col("set_id").alias("b"))
        .union(crowd.where("set_id != lead").select(F.col("lead").alias("a"), F.col("set_id").alias("b")))
        .distinct()
    )
    first = settled(lambda: connected_components(verified(rows, stars, members)))
    placed, groups, left = unsettled(shared, members, first)
    # More stars around other pivots join what one pivot leaves apart, before pairs are formed.
    for seed in range(1, STAR_ROUNDS):
        more = verified(rows, set_pairs(early_star(left, seed), placed), members)
        first = settled(lambda: connected_components(hubs(first).union(more)))
        placed, groups, left = unsettled(left, members, first)
    left = left.join(groups.select("grp", "bits"), "grp")
    x, y = left.alias("x"), left.alias("y")
    cross = (
        x.join(y, "shingle")
        .where((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.grp") < F.col("y.grp"))))
        .where(100 * F.col("x.n") >= PERCENT * F.col("y.n"))
        .where(may_be_first("x", "y"))
        .where((F.col("x.lo") != F.col("y.lo")) | (F.col("x.hi") != F.col("y.hi")) | (F.col("x.lo") != F.col("x.hi")))
        # Groups of several sets, and large ones, carry no parity: their pairs are compared after the join.
        .where(F.coalesce(similar_parity(F.col("x.bits"), F.col("y.bits"), F.col("x.n"), F.col("y.n")), F.lit(True)))
        .select(F.col("x.grp").alias("ga"), F.col("y.grp").alias("gb"))
        .distinct()
    )
    within = groups.where("lo != hi").select(F.col("grp").alias("ga"), F.col("grp").alias("gb"))
    more = verified(rows, set_pairs(cross.union(within), placed), members)
    return connected_components(hubs(first).union(more)).select(F.col("node").alias("set_id"), "component")


def may_be_first(x: str, y: str):
    """The first shingle that a linked pair shares has the whole overlap at or behind its position in both sets."""
    needed = PERCENT * (F.col(f"{x}.n") + F.col(f"{y}.n"))
    return F.least(*[(100 + PERCENT) * (F.col(f"{r}.n") - F.col(f"{r}.pos")) for r in (x, y)]) >= needed


def early_star(left: DataFrame, seed: int) -> DataFrame:
    """Group pairs ``ga, gb``: every group, on each of its shingles, with the one that has it earliest; on ranked shingles with that of its part, and these with each other.

    A group with few rarer shingles of its own is near the middle of its cluster, so many others link with it.
    Groups meet different partners on different shingles, so common shingles are not counted here.
    """

    def first(rows, *keys):
        order = Window.partitionBy(*keys).orderBy("pos", F.xxhash64("grp", F.lit(seed)), "grp")
        order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("p", F.first(F.struct("grp", "n", "pos", "lo", "hi")).over(order))

    salt = F.when(F.col("hot"), F.pmod("grp", F.lit(SALTS))).otherwise(0).cast("int")
    near = first(left.withColumn("salt", salt), "shingle", "salt")
    tops = first(near.where("hot AND p.grp = grp").drop("p"), "shingle")
    near = near.unionByName(tops).where((F.col("p.grp") != F.col("grp")) & ((F.col("p.lo") != F.col("lo")) | (F.col("p.hi") != F.col("hi"))))
    near = near.select("p", F.struct("grp", "n", "pos").alias("g")).where(100 * F.least("p.n", "g.n") >= PERCENT * F.greatest("p.n", "g.n"))
    return near.where(may_be_first("p", "g")).select(F.col("p.grp").alias("ga"), F.col("g.grp").alias("gb")).distinct()


def hubs(components: DataFrame) -> DataFrame:
    """The components' edges to their smallest nodes."""
    return components.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def unsettled(shared: DataFrame, members: DataFrame, components: DataFrame):
    """(sets with their component, components of each group, the shared rows of shingles with several components).

    Components only grow, so shingles settled once stay out of later rounds.
    """
    placed = reuse_checkpointed(
        members.join(components.withColumnRenamed("node", "set_id"), "set_id", "left").select(
            "set_id", "grp", "n", "doc_id", "bits", F.coalesce("component", "set_id").alias("component")
        )
    )
    # 64 bits tell components apart as they do groups, in half the room.
    mark = F.xxhash64("component")
    groups = placed.groupBy("grp").agg(
        F.min(mark).alias("lo"), F.max(mark).alias("hi"),
        F.when(F.count("*") == 1, F.first(F.when(F.size("bits") <= JOIN_LONGS, F.col("bits")))).alias("bits"),
    )
    seen = shared.select("shingle", "hot", "grp", "n", "pos").join(groups.select("grp", "lo", "hi"), "grp")
    mixed = seen.groupBy("shingle").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least != most").select("shingle")
    return placed, groups, reuse_checkpointed(seen.join(mixed, "shingle").select("shingle", "hot", "grp", "n", "pos", "lo", "hi"))


def set_pairs(group_pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the sets of paired groups ``ga, gb`` that are in different components."""
    p = placed.select("grp", "set_id", "component")
    return (
        group_pairs.join(p.select(F.col("grp").alias("ga"), F.col("set_id").alias("a"), F.col("component").alias("ca")), "ga")
        .join(p.select(F.col("grp").alias("gb"), F.col("set_id").alias("b"), F.col("component").alias("cb")), "gb")
        .where("ca != cb")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def placed_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the documents' profiles, ``set_id, component, component_id`` of all sets with a shingle)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def prepared() -> tuple[DataFrame, ...]:
        # Prefixes and parities stay on disk no longer than until the rows made of them are written.
        whole = reuse_checkpointed(profiles(rows.withColumn("row", F.xxhash64("text")), frequent_shingles(rows)))
        return whole.select("doc_id", "n", "set_id", "row"), *sets_and_rows(whole)

    profile, members, *shares = settled(prepared)
    components = settled(lambda: set_components(rows, members, functools.reduce(DataFrame.unionByName, shares)))
    classes = profile.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    classes = classes.join(components, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    return profile, classes.join(smallest, "component").select("set_id", "component", "component_id")


def linked_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    profile, ids = placed_rows(docs)
    found = profile.select("doc_id", "n", "set_id").join(ids.select("set_id", "component_id"), "set_id", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component of sets: a row of its smallest doc_id (null only without others), of several texts the least hash.

    Rows without a shingle link with nothing: one row of each doc_id and text is kept.
    """
    def chosen_rows() -> DataFrame:
        profile, ids = placed_rows(docs)
        key = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
        linked = profile.join(ids, "set_id").groupBy("component").agg(F.min(key).alias("k"))
        linked = linked.select(F.col("k.doc_id").alias("_id"), F.col("k.row").alias("_row"))
        return linked.union(profile.where("n = 0").select("doc_id", "row").distinct())

    chosen = settled(chosen_rows)
    keyed = docs.withColumns({"_key_id": F.col("doc_id").cast("long"), "_key_row": F.xxhash64(F.col("text").cast("string"))})
    kept = keyed.join(chosen, F.col("_key_id").eqNullSafe(F.col("_id")) & (F.col("_key_row") == F.col("_row")), "left_semi")
    return kept.dropDuplicates(["_key_id", "_key_row"]).select(*docs.columns)
