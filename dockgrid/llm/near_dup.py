"""Near-duplicate classes by an exact n-gram Jaccard join with PartEnum signatures.

A document is its set of distinct word shingles. Sets are banded by size; within a band the shingle domain is dealt into parts by
hash, each part into sub-parts, and every choice of sub-parts that may stay equal gives a signature (the sum of the shingles'
hashes there; empty ones are left out). A shingle in which two sets differ spoils at most C(n2-1, r-1) signatures, a second one of
the same part at most C(n2-2, r-1) more, and so on; sets that link differ in at most H(n) shingles, which spoil most when they are
dealt evenly over the parts that a set fills. What is left of its signatures then, T, a set shares with any partner. Hence exactly: sets with fewer than T repeated signatures have no partner, and the T-1 most frequent ones of a set can be
left out of its search (what very common passages produce ends there). Candidates are verified on the shingle sets
themselves. Within a signature's bucket all sets are first compared with one hub; components that remain apart meet
again, and only their members with each other's, where they share enough of the shingles in which they differ from the hub.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dockgrid.llm.common import DEALT, DEALT_SQL, ODD, arrow, grams, groups_of, hash_words, mixed, planes, repeated, repeated_ids, row_tags, rows, settle, unplanes
from dockgrid.llm.components import components
from dockgrid.llm.substring_dedup import Block

FOUND = pa.schema([("doc_id", pa.int64()), ("band", pa.int32()), ("n", pa.int32()), ("t", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("sig", pa.int64())])
FOUND_SQL = "doc_id long, band int, n int, t int, k1 long, k2 long, sig long"
SETS = pa.schema([("doc_id", pa.int64()), ("set", pa.list_(pa.int64()))])


def shingle_sets(texts: list[str | None], n: int):
    """The sorted distinct shingle hashes of each text."""
    h, _, _, first, _ = hash_words([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    for k in range(len(texts)):
        words = h[first[k] : first[k + 1]]
        if not len(words):
            yield words
        elif len(words) < n:
            yield mixed(np.array([sum((int(w) * pow(int(ODD), i + 1, 1 << 64)) for i, w in enumerate(words)) % (1 << 64)], np.uint64) + np.uint64(len(words)))
        else:
            h_ = np.sort(grams(words, n))
            yield h_[np.concatenate(([True], h_[1:] != h_[:-1]))]


class PartEnum:
    def __init__(self, percent: int, parts: tuple[int, int]):
        self.p, (self.n2, r) = percent, parts
        self.subsets = list(combinations(range(self.n2), r))
        #: Signatures of a part that its first, second, ... differing shingle spoils at most.
        self.steps = [comb(self.n2 - j, r - 1) for j in range(1, self.n2 + 1)]

    def spoiled(self, parts: int, differ: int) -> int:
        """Most signatures that differ shingles spoil in so many filled parts."""
        return sum(step * min(parts, max(0, differ - j * parts)) for j, step in enumerate(self.steps))

    def differ(self, n: int) -> int:
        """Most shingles in which a set of n can differ from a partner: (100 - p) (n + m) / (100 + p), m at most 100 n / p."""
        return (100 - self.p) * (n + 100 * n // self.p) // (100 + self.p)

    def bands(self, n: int) -> list[int]:
        """Bands double in size; a set that may have a partner in the band below is there too."""
        band = n.bit_length() - 1
        return [band, band - 1] if band and self.p * n < 100 << band else [band]

    def parts(self, band: int) -> int:
        """Parts of the domain for a band. A sub-part holds about one shingle of the band's largest guests (1.25 times its own) in
        small bands and 2.2 in others, which leaves T well over 0 for three sub-parts and two in a signature."""
        most = (2 << band) * 100 // self.p
        each = (1.0 if most < 160 else 2.2) if len(self.subsets[0]) > 1 else (1.0 if most < 160 else 3.0 if most < 1300 else 3.4)
        return max(1, int(most / (each * self.n2)))

    def signatures(self, s: np.ndarray, band: int) -> tuple[np.ndarray, int]:
        """Non-empty signatures of a set within a band, and how many parts it fills."""
        n1 = self.parts(band)
        x = np.sort(mixed(s + np.uint64(band * 2)))
        cell = ((x >> np.uint64(32)) * np.uint64(n1 * self.n2) >> np.uint64(32)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        grid = np.zeros(n1 * self.n2, np.uint64)
        grid[cell[new]] = np.add.reduceat(x, new)
        grid = grid.reshape(n1, self.n2).T
        sums = np.concatenate([sum(grid[c] for c in chosen) for chosen in self.subsets])
        full = np.flatnonzero(sums)
        return mixed(sums[full] + full.astype(np.uint64) * ODD + np.uint64(band)), int(grid.any(axis=0).sum())

    def units(self, s: np.ndarray):
        """(band code, T, signatures) for each band in which the set is to be looked for."""
        differ = self.differ(len(s))
        for band in self.bands(len(s)):
            sigs, parts = self.signatures(s, band)
            t = len(sigs) - self.spoiled(parts, differ)
            yield band * 2, max(t, 1), sigs
            if t < 1:  # too few parts are filled to be sure: each shingle for itself, in which T is never under 1
                yield band * 2 + 1, max(len(s) - differ, 1), mixed(s + np.uint64(band * 2 + 1))


def _signatures(method: PartEnum, n_words: int, groups: int):
    """Of equal sets of a block the smallest doc_id alone is signed and named with its bands; every document is named with band -1."""

    def run(batches):
        block, members = Block(groups), []
        signed: dict[tuple[int, int], tuple[int, int, list[tuple[int, int]], list[np.ndarray]]] = {}

        def flush():
            yield from block.flush()
            if members:
                units = [(doc, code, n, t, *key) for key, (doc, n, found, _) in signed.items() for code, t in found]
                data = [planes(np.array(x, np.int64)) for x in zip(*members, *units, strict=True)]
                yield arrow({"q": [members[0][0] % groups], "sure": [None], "keys": [b"".join(data)], "more": [b""], "docs": [b""], "tags": [b""], "places": [b""]}, DEALT)
                members.clear()
                signed.clear()

        for held in rows(batches, 200_000):
            for (doc, _), s in zip(held, shingle_sets([t for _, t in held], n_words), strict=True):
                key = tuple(x - (1 << 64) if x >= 1 << 63 else x for x in (int(s.sum(dtype=np.uint64)), int(mixed(s + ODD).sum(dtype=np.uint64))))
                members.append((doc, -1, len(s), 0, *key))
                full = False
                if not len(s):
                    pass
                elif key in signed:
                    first, n, units, names = signed[key]
                    if doc < first:
                        signed[key] = doc, n, units, names
                        for docs in names:
                            docs[:] = doc
                else:
                    signed[key] = doc, len(s), [], []
                    for code, t, sigs in method.units(s):
                        signed[key][2].append((code, t))
                        full |= block.add((sigs >> np.uint64(24)).astype(np.uint32), doc, np.full(len(sigs), code), sigs)
                        signed[key][3].append(block.parts[-1][2])
                if full or len(members) >= 100_000:
                    yield from flush()
        yield from flush()

    return run


def _found(table: pa.Table) -> pa.Table:
    """A group's repeated signatures by document, and what passes through."""
    mine = table.filter(pa.compute.is_null(table["sure"]))["keys"].to_pylist()
    meta = np.concatenate([np.zeros((6, 0), np.int64), *(np.stack([unplanes(x.tobytes(), np.int64) for x in np.split(np.frombuffer(m, np.uint8), 6)]) for m in mine)], axis=1)
    docs, _, codes, keys, q, _ = repeated(table.filter(pa.compute.is_valid(table["sure"])), np.uint32)
    nothing = pa.nulls(len(docs), pa.int32())
    return pa.table(
        {
            "doc_id": np.concatenate((meta[0], docs)), "band": np.concatenate((meta[1], codes)).astype(np.int32),
            "n": pa.chunked_array([pa.array(meta[2].astype(np.int32)), nothing]), "t": pa.chunked_array([pa.array(meta[3].astype(np.int32)), nothing]),
            "k1": pa.chunked_array([pa.array(meta[4]), pa.nulls(len(docs), pa.int64())]), "k2": pa.chunked_array([pa.array(meta[5]), pa.nulls(len(docs), pa.int64())]),
            "sig": pa.chunked_array([pa.nulls(len(meta[0]), pa.int64()), pa.array(keys.astype(np.int64) + (q << 32))]),
        },
        schema=FOUND,
    )


def _sets(n_words: int):
    def run(batches):
        for held in rows(batches, 200_000):
            yield arrow({"doc_id": [d for d, _ in held], "set": [s.view(np.int64) for s in shingle_sets([t for _, t in held], n_words)]}, SETS)

    return run


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80, parts: tuple[int, int] = (3, 2)) -> DataFrame:
    """doc_id, tag, n_shingles long, component_id, stays boolean, n_verified long; one row for each row of docs with a doc_id.

    Words stand between ASCII white space, A-Z lower-cased; a document with fewer than n_words words has its whole sequence as one
    shingle, without words none, and links with nothing. Two documents link when 100 * |intersection| >= percent * |union|.
    component_id is the smallest doc_id reachable by links; of a component one row stays, one with that doc_id. n_verified counts the
    verified links between representatives of equal sets (links within a component need not all be looked at). parts: (sub-parts of a
    part, sub-parts in a signature). Null texts are empty; rows with null doc_id are left out. Rows that share a doc_id are
    documents of their own, told apart by tag (see row_tags); of rows alike in both, all or none stay.
    """
    docs = docs.filter("doc_id is not null")
    if repeated_ids(docs) is None:
        return _near(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n_words, percent, parts).select("doc_id", F.lit(0).cast("long").alias("tag"), "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("stays"), "n_verified")
    # Rows get numbers of their own for the search.
    named = row_tags(docs).withColumn("node", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = settle(_near(named.select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"]), n_words, percent, parts).withColumnRenamed("doc_id", "node"), "nodes")
    rows_ = named.select("node", "doc_id", "tag").join(found, "node")
    roots = rows_.groupBy("component_id").agg(F.min(F.struct("doc_id", "tag")).alias("root"))
    return rows_.join(roots, "component_id").select("doc_id", "tag", "n_shingles", F.col("root")["doc_id"].alias("component_id"), (F.struct("doc_id", "tag") == F.col("root")).alias("stays"), "n_verified")


def _near(docs: DataFrame, n_words: int, percent: int, parts: tuple[int, int]) -> DataFrame:
    """doc_id, n_shingles, component_id, n_verified of docs (doc_id, text) whose doc_ids are all different."""
    method, groups = PartEnum(percent, parts), groups_of(docs)
    found = settle(docs.mapInArrow(_signatures(method, n_words, groups), DEALT_SQL).groupBy("q").applyInArrow(_found, FOUND_SQL), "signatures")
    members = found.filter("sig is null AND band = -1").select("doc_id", "n", "k1", "k2")
    # Equal sets are one class: the smallest doc_id stands for it. It is the smallest of its block too, so it is signed.
    classes = members.filter("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    units = found.filter("sig is null AND band >= 0").groupBy("n", "k1", "k2", "band").agg(F.min("doc_id").alias("doc_id"), F.max("t").alias("t")).select("doc_id", "band", "n", "t")
    repeats = found.filter("sig is not null").select("doc_id", "band", "sig")
    counts = repeats.groupBy("doc_id", "band").agg(F.count("*").alias("c"))
    alive = units.join(counts, ["doc_id", "band"]).filter("c >= t").select("doc_id", "band", "n", "t")
    left = repeats.join(alive, ["doc_id", "band"])
    buckets = left.groupBy("band", "sig").agg(F.count("*").alias("size")).filter("size > 1")
    left = left.join(buckets, ["band", "sig"])
    # The T-1 most frequent signatures of a set can't be all that it shares with a partner.
    ranked = left.withColumn("rarer", F.row_number().over(Window.partitionBy("doc_id", "band").orderBy("size", "sig"))).withColumn("c", F.count("*").over(Window.partitionBy("doc_id", "band")))
    searched = settle(ranked.filter("rarer <= c - t + 1").select("band", "sig", "doc_id", "n", "c"), "searched")
    hubs = searched.groupBy("band", "sig").agg(F.max(F.struct("c", -F.col("doc_id"))).alias("h"), F.count("*").alias("size")).filter("size > 1").select("band", "sig", "size", (-F.col("h")["col2"]).alias("hub"))
    # Only pairs of a bucket with a third set can matter for sets that meet beside the hub: they keep the shingles in which they differ.
    first = settle(searched.join(hubs, ["band", "sig"]).filter("doc_id <> hub").groupBy("hub", "doc_id").agg(F.max(F.col("size") > 2).alias("crowded")), "pairs")
    sets = settle(docs.join(searched.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_sets(n_words), "doc_id long, set array<long>"), "sets")
    differ = F.when(F.col("crowded"), F.concat(F.array_except("x", "y"), F.array_except("y", "x")))
    linked = settle(_compared(first, sets, "hub", "doc_id", percent).select("hub", "doc_id", "linked", F.size("x").alias("hub_n"), F.size("y").alias("n"), differ.alias("e")), "compared")
    links = linked.filter("linked").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    comp = settle(components(links), "labels")
    rest = settle(_apart(linked, comp, percent).join(linked.select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")), ["a", "b"], "left_anti"), "pairs")
    links = settle(links.unionByName(_compared(rest, sets, "a", "b", percent).filter("linked").select("a", "b")), "links")
    comp = components(links)
    degree = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("n_verified"))
    reps = classes.join(comp, classes["rep"] == comp["node"], "left").drop("node").join(degree, F.col("rep") == degree["node"], "left").select("n", "k1", "k2", F.coalesce("label", "rep").alias("component_id"), F.coalesce("n_verified", F.lit(0)).alias("n_verified"))
    return members.distinct().join(reps, ["n", "k1", "k2"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_verified", F.lit(0)).alias("n_verified"))


def _compared(pairs: DataFrame, sets: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """pairs with both sets, x and y, and whether they link: compared whole."""
    both = pairs.join(sets.select(F.col("doc_id").alias(a), F.col("set").alias("x")), a).join(sets.select(F.col("doc_id").alias(b), F.col("set").alias("y")), b)
    return both.withColumn("c", F.size(F.array_intersect("x", "y"))).withColumn("linked", F.expr(f"100 * c >= {percent} * (size(x) + size(y) - c)"))


def _apart(linked: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of sets compared with the same hub that may link although they are in different components.

    E is the set of shingles in which a set differs from the hub; |x - y| = |Ex| + |Ey| - 2 |common of E|. Sets that link differ in at
    most H; if |Ex| + |Ey| <= H both link with the hub. So others share at least A = (|Ex| + |Ey| - H) / 2 shingles of E: a
    prefix-filtered join on E, rarest shingles first. The set with the smaller E is indexed with those of its shingles that the
    smallest possible A leaves (for a set that links with the hub only partners that do not are asked for, whose E is larger than
    H), the other one probes. Copies with edits of their own share no rare shingle of E, so a large group gives no square of pairs.
    """
    label = comp.select(F.col("node"), "label")
    named = linked.filter("e IS NOT NULL").select("hub", "doc_id", "linked", "hub_n", "n", F.size("e").alias("m")).join(label.select(F.col("node").alias("doc_id"), F.col("label").alias("l")), "doc_id", "left").join(label.select(F.col("node").alias("hub"), F.col("label").alias("hl")), "hub", "left")
    named = named.withColumn("label", F.coalesce("l", "doc_id")).withColumn("open", F.col("label") != F.coalesce("hl", "hub"))
    hubs = named.groupBy("hub").agg(F.max("open").alias("any_open"), F.count("*").alias("members")).filter("any_open AND members > 1").select("hub")
    p, q = 100 - percent, 100 + percent
    differ = f"({p} * (n + 100 * n div {percent}) div {q})"
    wide = named.join(hubs, "hub").withColumn("h", F.expr(differ))
    # The smallest number of shared shingles with a partner whose E is no smaller.
    least = F.greatest(F.lit(1), F.expr("cast(ceil(m - h / 2) AS int)"), F.when(F.col("linked"), F.expr(f"cast(floor(({q} * m - {p} * (n - hub_n)) / (2 * {q})) + 1 AS int)")))
    wide = wide.withColumn("index_n", F.col("m") - least + 1).withColumn("probe_n", F.least("m", F.col("h") + 1))
    wide = settle(wide.join(linked.select("hub", "doc_id", "e"), ["hub", "doc_id"]).select("hub", "doc_id", "label", "n", "m", "linked", "index_n", "probe_n", "e"), "differences")
    # Shingles of one label alone are in no pair asked for: they come first in the order of each E and needn't be ranked.
    common = wide.select("hub", "label", F.explode("e").alias("g")).groupBy("hub", "g").agg(F.count("*").alias("df"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("hub", "g", "df")
    mine = Window.partitionBy("hub", "doc_id")
    # Shingles of which enough of the set's others come after them to be in one of its two prefixes.
    ranked = wide.select("hub", "doc_id", F.expr("m - greatest(index_n, probe_n)").alias("over"), F.explode("e").alias("g")).join(common, ["hub", "g"]).withColumn("after", F.count("*").over(mine) - F.row_number().over(mine.orderBy("df", "g")))
    ranked = settle(ranked.filter("after >= over").select("hub", "doc_id", "g", "after"), "ranked")

    def prefix(rows: DataFrame, kind: str, where: str = "true") -> DataFrame:
        placed = rows.join(wide.drop("e"), ["hub", "doc_id"]).withColumn("place", F.col("m") - F.col("after")).filter(f"place <= {kind}_n AND ({where})")
        return placed.select("hub", "g", "doc_id", "label", "n", "m", "linked", "place", F.lit(kind == "index").alias("index"), F.lit(kind == "probe").alias("probe"))

    # Few sets have enough shingles to be indexed: the others' shingles are named only where one of another label is indexed, as they meet nothing elsewhere.
    indexed = settle(prefix(ranked, "index"), "differences")
    met = indexed.groupBy("hub", "g").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    probing = prefix(ranked.join(met, ["hub", "g"]), "probe", "label <> x OR label <> y")
    cut = settle(indexed.unionByName(probing), "differences")
    return _meetings(cut, percent).select(F.least("i_doc_id", "j_doc_id").alias("a"), F.greatest("i_doc_id", "j_doc_id").alias("b")).distinct()


def _meetings(cut: DataFrame, percent: int) -> DataFrame:
    """Indexed and probing rows (i_, j_) of cut that meet at (hub, g) with different labels and may link.

    Labels meet first, by bounds of their members, then the members of those that do: members of one label never meet each
    other, however many share a g.
    """
    p, q = 100 - percent, 100 + percent
    bounds = [F.min("m").alias("m_least"), F.max("m").alias("m_most"), F.min("n").alias("n_least"), F.max("n").alias("n_most"), F.max(F.col("m") - F.col("place")).alias("after"), F.min("linked").alias("linked")]
    labels = [cut.filter(k).groupBy("hub", "g", "label").agg(*bounds) for k in ("index", "probe")]
    i, j = (x.select("hub", "g", *[F.col(c).alias(f"{s}_{c}") for c in x.columns[2:]]) for x, s in zip(labels, "ij", strict=True))
    # As for single members below, from the bounds most in favour.
    may = f"i_label <> j_label AND i_m_least <= j_m_most AND NOT (i_linked AND j_linked) AND 100 * least(i_n_most, j_n_most) >= {percent} * greatest(i_n_least, j_n_least)"
    may += f" AND 2 * (1 + least(i_after, j_after)) >= i_m_least + j_m_least - {p} * (i_n_most + j_n_most) div {q}"
    pairs = i.join(j, ["hub", "g"]).filter(may).select("hub", "g", "i_label", "j_label")
    names = ("doc_id", "label", "n", "m", "linked", "place")
    i, j = (cut.filter(k).select("hub", "g", *[F.col(c).alias(f"{s}_{c}") for c in names]) for k, s in (("index", "i"), ("probe", "j")))
    apart = f"(i_m < j_m OR (i_m = j_m AND i_doc_id <> j_doc_id)) AND NOT (i_linked AND j_linked) AND 100 * least(i_n, j_n) >= {percent} * greatest(i_n, j_n)"
    # A pair's first common shingle leaves room for A of them after it; at later ones of a pair this may fail.
    room = f"2 * (1 + least(i_m - i_place, j_m - j_place)) >= i_m + j_m - {p} * (i_n + j_n) div {q}"
    return pairs.join(i, ["hub", "g", "i_label"]).join(j, ["hub", "g", "j_label"]).filter(f"{apart} AND {room}")
