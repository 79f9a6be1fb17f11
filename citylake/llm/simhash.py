"""SimHash near-duplicates by covering locality-sensitive hashing.

A covering code turns "differ in at most r bits" into "equal under some mask": bit i
gets the nonzero vector phi(i) of r + 1 bits, and mask v keeps the bits whose phi has an
odd product with v. Any r vectors have a nonzero v orthogonal to all of them, so for
every difference of at most r bits one of the 2^(r+1) - 1 masks hides it: no pair
within the radius is missed. Buckets beyond `direct` fingerprints are masked a second
time over the bits the first mask left free; what is then still free (12 of 64 bits at
radius 2) bounds a bucket to 4,096 different fingerprints, whatever the data.

Cases. Null or empty text, or none but separators: fingerprint zero, linked like any
other. Repeated rows and equal texts share a fingerprint and so a component. A null
doc_id takes part; a component's id is the smallest doc_id that is not null (null if it
has none). Very long texts are hashed in runs. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import components, staged, text_slices

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
DIRECT = 512
RUN = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of all shingle hashes, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    width = min(shingle, len(words))
    starts, stops = starts[: len(words) - width + 1], stops[width - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), RUN):
        spans = zip(starts[at : at + RUN].tolist(), stops[at : at + RUN].tolist(), strict=True)
        ones += bit_counts(np.array([digest(joined[i:j], seed) for i, j in spans], dtype="<u8"))
    return majority(ones, len(starts))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit `hashes` have each bit set."""
    bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int32)


def majority(ones: np.ndarray, n: int) -> int:
    """The bits that more than half of `n` hashes have set."""
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, fp): a hash of the text, and the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                fps = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
                ids, rows = (batch.column(c).slice(at, len(texts)) for c in (0, 2))
                yield pa.RecordBatch.from_arrays([ids, rows, pa.array(fps)], ["doc_id", "row", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.xxhash64(text_col).alias("row")
    )
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """2^(radius+1) - 1 masks over `bits`; any `radius` bits are all outside one of them."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << bit for i, bit in enumerate(bits) if (v & (1 + i % vectors)).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of `fps` under "at most radius bits differ"."""
    rest, links = fps.view(np.uint64), []
    while len(rest) > 1:
        reach, rest = [rest[0]], rest[1:]
        while reach and len(rest):
            node = reach.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                found = rest[near]
                links += [(int(node), int(x)) for x in found]
                reach.extend(found)
                rest = rest[~near]
    return links


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of every other fingerprint of a tree of that forest to its smallest one (as a
    signed long): the same components by shorter paths."""
    trees: dict[int, list[int]] = {}
    for a, b in forest(fps, radius):
        trees[b] = trees.setdefault(a, [a])
        trees[a].append(b)
    firsts = {id(tree): tree for tree in trees.values()}.values()
    return [(x, least) for tree in firsts for least in [min(tree, key=_signed)] for x in tree if x != least]


def bucket_links(nodes: DataFrame, radius: int = RADIUS, direct: int = DIRECT, join=forest) -> DataFrame:
    """Links (a, b) between the different fingerprints `nodes` (fp) that join the same
    components as all pairs within the radius do; `join` gives those of a bucket."""
    masks = covering_masks(list(range(BITS)), radius)
    finer = [covering_masks([b for b in range(BITS) if not m >> b & 1], radius) for m in masks]
    keyed = nodes.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(v).alias("v"),
                        F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"),
                    )
                    for v, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("fp", "k.v", "k.key")
    counts = staged(
        keyed.groupBy("v", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-buckets"
    )
    shared = staged(keyed.join(counts, ["v", "key"]), "simhash-shared")
    small = shared.filter(F.col("n") <= direct).select("fp", "v", F.lit(-1).alias("w"), "key")
    choice = F.array(
        *[F.array(*[F.lit(_signed(m | s)) for s in finer[v]]) for v, m in enumerate(masks)]
    )
    large = (
        shared.filter(F.col("n") > direct)
        .select("fp", "v", F.posexplode(F.get(choice, F.col("v"))).alias("w", "mask"))
        .select("fp", "v", "w", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    )
    groups = (
        small.union(large)
        .groupBy("v", "w", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values = lists.values.to_numpy(zero_copy_only=False)
            edges = lists.offsets.to_numpy(zero_copy_only=False).tolist()
            links = [
                pair
                for i, j in zip(edges, edges[1:], strict=False)
                for pair in join(values[i:j], radius)
            ]
            both = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return groups.mapInArrow(link, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    direct: int = DIRECT,
) -> DataFrame:
    """(doc_id, row, fp, root, component_id) for every row; component_id is the smallest doc_id
    reachable, root the smallest fingerprint, `row` a hash of the text."""
    prints = staged(fingerprints(docs, id_col, text_col), "simhash-prints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(bucket_links(nodes.select("fp"), radius, direct, stars))
    rooted = staged(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least"
        ),
        "simhash-roots",
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = staged(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash-classes")
    return prints.join(of_fp, "fp").select("doc_id", "row", "fp", "root", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", find=near_duplicates, **options
) -> DataFrame:
    """One row of each component that `find` gives: that of the smallest doc_id (ties: of the
    smallest text hash)."""
    found = staged(find(docs, id_col, text_col, **options), "simhash-found")
    chosen = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = staged(
        chosen.groupBy("root", "component_id")
        .agg(F.min("row").alias("__row"))
        .select(F.col("component_id").alias("__id"), "__row"),
        "simhash-chosen",
    )
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__row"))
    kept = docs.join(chosen, same).dropDuplicates(["__id", "__row"])
    return kept.select(*docs.columns)


def hex_digits(fp) -> F.Column:
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
