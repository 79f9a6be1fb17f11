"""Near copies by SimHash and the Jaccard similarity of their word shingles.

Texts with equal shingle sets are one node. The SimHash of a node is the majority of the
bits of its shingles; covering masks (`simhash.bucket_links`) find all fingerprints that
differ in at most RADIUS bits, and give a spanning forest of each bucket as candidates.
Two sets of similarity 0.8 differ in 10 of 64 bits on average, which no cover of usable
size reaches, so the links beyond the radius are found by minima: a node has BANDS keys,
each made of ROWS minima of its shingles under random hashes, and nodes that share a key
are candidates too. Two sets of similarity s share no key with probability
(1 - s^ROWS)^BANDS: 4e-7 at 0.8, less above it. Every link, of either kind, is checked on
the whole shingle sets, in integers.

First each node meets its neighbours in the SimHash forests and the smallest node of its
buckets, which is linear and joins groups of copies. The nodes of buckets that still hold several components then meet by a lossless
prefix filter: with shingles in one order, rarest first, two sets of similarity 0.8 share
one of the first n - ceil(0.8 n) + 1 of the larger and of the first n - ceil(8/9 n) + 1 of
the smaller set, and what follows it must be long enough for their overlap. Under each
such shingle all larger sets meet at most 8 heads, then 64, 512, ... others among the
smaller ones; a shingle is left when its sets are in one component or all were heads. So
no link that could join two components stays unchecked, and groups of texts that resemble
each other without being similar are not paired.

Cases. Texts without a word are one node without keys. Shorter texts than a shingle are
one shingle. A null doc_id takes part; a component's id is the smallest doc_id that is
not null. Very long texts are hashed in runs. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import components, staged, text_slices
from citylake.llm.simhash import BITS, bit_counts, bucket_links, majority

SHINGLE = 5
#: Least similarity of a link, as a fraction of two integers.
SHARE, OF = 4, 5
#: Bits in which the fingerprints of candidates may differ: 15 masks, each of about 34 bits.
RADIUS = 3
#: Buckets up to this size are compared whole, larger ones masked a second time.
DIRECT = 1 << 12
BANDS = 28
ROWS = 4
#: Heads under one shingle in the first round, and how many times more there are in each next one.
HEADS = 8
SEED = 42
RUN = 1 << 12
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The different hashes of all runs of `width` words, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), stops[width - 1 :].tolist(), strict=True)
    digest, n = xxhash.xxh64_intdigest, len(words) - width + 1
    return np.unique(np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64, n))


def keys(found: np.ndarray) -> np.ndarray:
    """One key per band: a hash of the band's number and its minima."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(found), RUN):
        mixed = FACTORS[0][:, None] * found[None, at : at + RUN] + FACTORS[1][:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(m.tobytes(), b) for b, m in enumerate(bands)], np.uint64).view(np.int64)


def fingerprint(found: np.ndarray) -> int:
    """Majority of the bits of a shingle set; 0 for an empty one."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(found), RUN):
        ones += bit_counts(found[at : at + RUN])
    return majority(ones, len(found))


def prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, node, n, fp, keys): hashes of the text and of its shingle set, its size,
    SimHash and keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                sets = [shingles(t) for t in texts]
                nodes = [xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets]
                ids, rows = (batch.column(c).slice(at, len(texts)) for c in (0, 2))
                yield pa.RecordBatch.from_arrays(
                    [ids, rows, pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array([len(s) for s in sets], pa.int64())]
                    + [pa.array(np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64))]
                    + [pa.array([keys(s) for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "row", "node", "n", "fp", "keys"],
                )

    rows = docs.select(
        F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.xxhash64(text_col).alias("row")
    )
    return rows.mapInArrow(run, "doc_id long, row long, node long, n long, fp long, keys array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, found): the shingle sets of the nodes `wanted` (node, row, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                sets = pa.array([shingles(t).view(np.int64) for t in texts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), sets], ["node", "found"])

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("row")
    ).alias("t")
    same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.row") == F.col("w.row"))
    picked = texts.join(wanted.alias("w"), same).select("w.node", "t.text").dropDuplicates(["node"])
    return picked.mapInArrow(run, "node long, found array<long>")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity is at least SHARE / OF."""
    left, right = (sets.select(F.col("node").alias(c), F.col("found").alias(f"{c}_found")) for c in "ab")
    both = F.size(F.array_intersect("a_found", "b_found"))
    either = F.size("a_found") + F.size("b_found") - both
    return pairs.join(left, "a").join(right, "b").filter(OF * both >= SHARE * either).select("a", "b")


def _sizes_fit(n, m) -> F.Column:
    return OF * F.least(n, m) >= SHARE * F.greatest(n, m)


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of `nodes` (node, n, fp) that join what differs in at most RADIUS bits: the
    smallest node of a fingerprint with its others, and with those of the linked fingerprints."""
    words = nodes.filter("n > 0").select("node", "fp")
    prints = staged(words.groupBy("fp").agg(F.min("node").alias("head"), F.count("*").alias("times")), "neardup-fps")
    heads = prints.filter("times > 1").select("fp", "head")
    equal = words.join(heads, "fp").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    ends = [prints.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_head")) for c in "ab"]
    linked = bucket_links(prints.select("fp"), RADIUS, DIRECT).distinct().join(ends[0], "a").join(ends[1], "b")
    return equal.union(linked.select("a_head", "b_head"))


def roots_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, root) of the nodes that have a near copy."""
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("head"))
    buckets = staged(buckets.filter("size > 1").select("key", "head"), "neardup-buckets")
    shared = staged(
        keyed.join(buckets, "key").select("key", "node", "n", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")),
        "neardup-shared",
    )
    close = staged(simhash_pairs(nodes), "neardup-close")
    met = shared.select("node").union(close.select("a")).union(close.select("b")).distinct()
    wanted = nodes.join(met, "node", "left_semi").select("node", "at.row", "at.doc_id")
    sets = staged(shingle_sets(docs, wanted, id_col, text_col), "neardup-sets")
    first = shared.filter((F.col("node") != F.col("head")) & _sizes_fit(F.col("n"), F.col("head_n")))
    pairs = first.select(F.col("node").alias("a"), F.col("head").alias("b")).union(close).distinct()
    links = staged(similar(pairs, sets), "neardup-links")
    roots = staged(components(links), "neardup-joined")

    now = shared.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    now = staged(now, "neardup-now")
    mixed = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    members = staged(now.join(mixed, "key", "left_semi").select("node", "n").distinct(), "neardup-members")
    theirs = staged(sets.join(members, "node", "left_semi"), "neardup-theirs")
    return joined_by_prefixes(members, theirs, roots)


def prefixes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(sh, at, node, n, small): the rarest shingles of each set, as many as a similar set of
    any size must meet, and whether it can be met there as the smaller one."""
    each = members.join(sets, "node").select("node", "n", F.explode("found").alias("sh"))
    often = each.groupBy("sh").agg(F.count("*").alias("times")).filter("times > 1")
    often = staged(often, "neardup-times")
    ranked = F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(1)).alias("times"), "sh")))
    probe = F.col("n") - F.ceil(F.col("n") * SHARE / OF) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * SHARE) / (SHARE + OF)) + 1
    rows = each.join(often, "sh", "left").groupBy("node", "n").agg(ranked.alias("found"))
    rows = rows.select("node", "n", F.posexplode(F.slice("found", F.lit(1), probe.cast("int"))).alias("at", "s"))
    return rows.filter("s.times > 1").select("s.sh", "at", "node", "n", (F.col("at") < index).alias("small"))


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after further links (a, b): only the roots that they join are merged."""
    at = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab"]
    ends = links.join(at[0], "a", "left").join(at[1], "b", "left")
    merged = ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).distinct()
    merged = staged(components(merged), "neardup-merged")
    moved = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
    kept = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return kept.union(merged.join(roots, "node", "left_anti").select("node", "root"))


def joined_by_prefixes(members: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) after all links among `members` (node, n) that join two components."""
    live, rounds = staged(prefixes(members, sets), "neardup-prefixes"), 0
    while True:
        now = live.join(roots, "node", "left").select("sh", "at", "node", "n", "small", F.coalesce("root", "node").alias("root"))
        mixed = now.groupBy("sh").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("small").alias("able"))
        now = staged(now.join(mixed.filter("low <> high AND able"), "sh", "left_semi"), "neardup-live")
        if now.isEmpty():
            return roots
        part = F.pmod(F.xxhash64("node", F.lit(rounds)), F.lit(HEADS ** (rounds + 1)))
        head = F.min(F.struct("n", "node", "at", "root"))
        heads = now.filter("small").groupBy("sh", part.alias("part")).agg(head.alias("head"))
        heads = staged(heads.select("sh", *[F.col(f"head.{c}").alias(f"head_{c}") for c in ("n", "node", "at", "root")]), "neardup-heads")
        order = F.struct("head_n", "head_node") < F.struct(F.col("n").alias("head_n"), F.col("node").alias("head_node"))
        left = F.least(F.col("n") - F.col("at"), F.col("head_n") - F.col("head_at"))
        enough = left * (SHARE + OF) >= SHARE * (F.col("n") + F.col("head_n"))
        met = now.join(heads, "sh").filter(order & enough & (F.col("root") != F.col("head_root")) & _sizes_fit(F.col("n"), F.col("head_n")))
        more = staged(similar(met.select(F.col("node").alias("a"), F.col("head_node").alias("b")).distinct(), sets), "neardup-more")
        if not more.isEmpty():
            roots = staged(with_links(roots, more), "neardup-joined")
        was = heads.select("sh", F.col("head_node").alias("node"), F.lit(True).alias("was"))
        live = now.join(was, ["sh", "node"], "left").withColumn("small", F.col("small") & F.col("was").isNull())
        live, rounds = staged(live.select("sh", "at", "node", "n", "small"), "neardup-prefixes"), rounds + 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, node, root, component_id) for every row, as `simhash.near_duplicates`
    has them: root is the smallest node of the component."""
    found = staged(prints(docs, id_col, text_col), "neardup-prints")
    nodes = staged(
        found.groupBy("node").agg(
            F.min("doc_id").alias("least"),
            F.max(F.struct("row", "doc_id")).alias("at"),
            F.max("n").alias("n"),
            F.max("fp").alias("fp"),
            F.first("keys").alias("keys"),
        ),
        "neardup-nodes",
    )
    roots = roots_of(docs, nodes, id_col, text_col)
    rooted = staged(
        nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least"),
        "neardup-roots",
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = staged(rooted.join(ids, "root").select("node", "root", "component_id"), "neardup-classes")
    return found.join(of_node, "node").select("doc_id", "row", "node", "root", "component_id")
