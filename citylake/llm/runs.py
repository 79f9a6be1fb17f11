"""Periodic runs of words by block convolution at dyadic scales.

A run is a stretch of words with smallest period q that no neighbour extends; it counts
when it has at least `least` words and two periods. At scale B = 1, 2, 4, ... the words are
cut into blocks of B. A run of period 2B-1 <= q < 4B-1 holds a whole block that occurs
again q words later, so every block is searched for at the distances of that range: the
sum of squared differences against the words that follow is a convolution, taken by a
number-theoretic transform modulo a prime. Zero sums are seeds (position, distance), which
comparison of the words themselves extends to both sides. A sum that is zero only modulo
the prime yields no run, and no zero sum is missed.

Two tests save work and lose nothing: a block is searched for only if each of its words
occurs again within reach, and neither a block whose window lies in a known run of period
<= B nor a seed at a multiple of a known run's period inside that run can start another.

Texts are batched end to end with separators that equal nothing, so short texts share the
transforms. Memory grows with the batch or with the longest text, never with the table.

Cases. Null and empty texts have no words, no runs and an empty collapsed text. Words are
compared byte by byte. Very long texts are taken whole. Repeated rows get equal results,
null ids pass through, an empty table gives no rows. All columns are kept; the columns
`runs` and `collapsed` are added, or replaced where there are such.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.llm.common import text_slices

LEAST = 12
BATCH = 1 << 20
#: Cells of one batch of transforms.
CELLS = 1 << 20
#: A prime of the form k * 2^27 + 1 and a generator of its unit group (fixed values).
PRIME, GENERATOR = 2013265921, 31

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RUN_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo PRIME, by doubling; n is a power of two."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), PRIME))
        out = np.concatenate((out, out * step % np.uint64(PRIME)))
    return out


def ntt(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row; the length is a power of two."""
    m, size = rows.shape
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    p, done, left = np.uint64(PRIME), 1, size
    x = rows.reshape(m, size, 1)
    while left > 1:
        left //= 2
        w = _powers(pow(root, done, PRIME), left)[None, :, None]
        a, b = x[:, :left], x[:, left:]
        x = np.stack(((a + b) % p, (a + (p - b)) % p * w % p), axis=2).reshape(m, left, 2 * done)
        done *= 2
    x = x.reshape(m, size)
    return x * np.uint64(pow(size, PRIME - 2, PRIME)) % p if inverse else x


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo PRIME, of each block (m, B) against its window
    (m, 3B - 1) at the shifts 0 .. 2B - 1."""
    m, b = blocks.shape
    size, p = 4 * b, np.uint64(PRIME)
    turned, held = np.zeros((2, m, size), np.uint64)
    turned[:, :b], held[:, : windows.shape[1]] = blocks[:, ::-1], windows
    cross = ntt(ntt(turned) * ntt(held) % p, inverse=True)[:, b - 1 : 3 * b - 1]
    squares = np.cumsum(np.pad(windows * windows % p, ((0, 0), (1, 0))), axis=1, dtype=np.uint64)
    there = (squares[:, b:] - squares[:, : 2 * b]) % p
    here = (blocks * blocks % p).sum(axis=1, dtype=np.uint64)[:, None] % p
    return (here + there + np.uint64(2) * (p - cross)) % p


def _mixed(words: np.ndarray) -> np.ndarray:
    """Pseudo-random residues of word numbers, so that different blocks rarely collide."""
    x = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) % np.uint64(PRIME)


def _reach(words: np.ndarray) -> np.ndarray:
    """Distance of every word to its next occurrence; a very large number if there is none."""
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), np.iinfo(np.int64).max)
    same = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    out[order[same]] = order[same + 1] - order[same]
    return out


def _stretch(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on, in direction `step`, equal those `distance` further right."""
    total, live, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    last = len(words) - 1
    while len(live):
        first = at[live] + step * total[live]
        held = max(1, CELLS // width)
        equal = np.empty(len(live), np.int64)
        for k in range(0, len(live), held):
            i = first[k : k + held, None] + step * np.arange(width)
            j = i + distance[live[k : k + held], None]
            inside = (i >= 0) & (j <= last)
            same = inside & (words[np.clip(i, 0, last)] == words[np.clip(j, 0, last)])
            equal[k : k + held] = np.where(same.all(axis=1), width, same.argmin(axis=1))
        total[live] += equal
        live = live[equal == width]
        width = min(2 * width, CELLS)
    return total


class _Known:
    """Runs found so far, asked whether a stretch lies in one whose period divides a number."""

    def __init__(self) -> None:
        self.runs: dict[tuple[int, int], int] = {}
        self.starts, self.ends, self.periods = (np.zeros(0, np.int64),) * 3

    def add(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        order = np.argsort(periods, kind="stable")
        for s, e, q in zip(starts[order].tolist(), ends[order].tolist(), periods[order].tolist(), strict=True):
            self.runs.setdefault((s, e), q)
        found = np.array(sorted((s, e, q) for (s, e), q in self.runs.items()), np.int64).reshape(-1, 3)
        self.starts, self.ends, self.periods = found.T

    def around(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Smallest period of the latest-starting runs around [first, stop); 0 if none is found.

        Two runs of periods p and q overlap by less than p + q words, so few can lie around
        one place; the four that start last before it are looked at."""
        out = np.zeros(len(first), np.int64)
        at = np.searchsorted(self.starts, first, side="right") - 1
        for back in range(4):
            k = at - back
            fits = (k >= 0) & (self.ends[np.maximum(k, 0)] >= stop) if len(self.starts) else np.zeros(len(first), bool)
            q = np.where(fits, self.periods[np.maximum(k, 0)] if len(self.periods) else 0, 0)
            out = np.where((q > 0) & ((out == 0) | (q < out)), q, out)
        return out


def _seeds(words: np.ndarray, values: np.ndarray, reach: np.ndarray, known: _Known, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of blocks of `b` words and the distances at which they occur again."""
    n = len(reach)
    near = reach <= 4 * b - 2
    at = b * np.flatnonzero(near[: n // b * b].reshape(-1, b).all(axis=1))
    period = known.around(at, np.minimum(at + 5 * b - 2, n))
    at = at[(period == 0) | (period > b)]
    rows, starts, distances = max(1, CELLS // (4 * b)), [at[:0]], [at[:0]]
    for k in range(0, len(at), rows):
        part = at[k : k + rows]
        blocks = values[part[:, None] + np.arange(b)]
        windows = values[part[:, None] + (2 * b - 1) + np.arange(3 * b - 1)]
        i, shift = np.nonzero(mismatches(blocks, windows) == 0)
        starts.append(part[i])
        distances.append(shift + 2 * b - 1)
    start, distance = np.concatenate(starts), np.concatenate(distances)
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    follows = np.zeros(len(start), bool)
    follows[1:] = (distance[1:] == distance[:-1]) & (start[1:] - start[:-1] == b)
    start, distance = start[~follows], distance[~follows]
    period = known.around(start, start + distance + b)
    fresh = (period == 0) | (distance % np.maximum(period, 1) != 0)
    return start[fresh], distance[fresh]


def find_runs(words: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs, by start and period.

    `words` are numbers; texts follow each other with separators of their own. `longest` is
    the number of words of the longest text."""
    reach, known, b = _reach(words), _Known(), 1
    top = 1
    while 2 * (2 * (2 * top) - 1) <= longest:
        top *= 2
    pad = np.arange(5 * top, dtype=np.int64) + (int(words.max(initial=0)) + 1)
    padded = np.concatenate((words, pad))
    values = _mixed(padded)
    while 2 * (2 * b - 1) <= longest:
        start, distance = _seeds(padded, values, reach, known, b)
        right = _stretch(words, start, distance, 1)
        left = _stretch(words, start - 1, distance, -1)
        first, length = start - left, left + right + distance
        whole = (length >= np.maximum(least, 2 * distance)) & (right > 0)
        if whole.any():
            known.add(first[whole], first[whole] + length[whole], distance[whole])
        b *= 2
    found = sorted((s, e - s, q) for (s, e), q in known.runs.items())
    return np.array(found, np.int64).reshape(-1, 3)


def runs_of_texts(texts: list[str | None], least: int = LEAST) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words and runs (start, length, period) of every text."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    seen: defaultdict[bytes | None, int] = defaultdict(count().__next__)
    flat = chain.from_iterable(chain(w, (None,)) for w in words)
    ids = np.fromiter(map(seen.__getitem__, flat), np.int64, int(sizes.sum()) + len(words))
    # equal words of different texts are different numbers, and so is every separator
    ids += np.repeat(np.arange(len(words)), sizes + 1) * len(seen)
    found = find_runs(ids, int(sizes.max(initial=0)), least)
    edges = np.concatenate(([0], np.cumsum(sizes + 1)))
    owner = np.searchsorted(edges, found[:, 0], side="right") - 1
    found[:, 0] -= edges[owner]
    cuts = np.searchsorted(owner, np.arange(len(words) + 1))
    return words, [found[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if len(runs):
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(cover)[:-1] == 0
        words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """`docs` with `runs`, an array of (start, length, period) in words, and `collapsed`, the
    text without the repetitions of its runs."""
    docs = docs.drop("runs", "collapsed")
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            for start, texts in text_slices(column, BATCH):
                words, found = runs_of_texts(texts, least)
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(f) for f in found])))
                runs = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]),
                )
                short = [collapse(w, f).decode("utf-8", "surrogatepass") for w, f in zip(words, found, strict=True)]
                rows = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, runs, pa.array(short, pa.string())], [*names, "runs", "collapsed"])

    added = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a periodic tail in the text of every id whose crc32 ends in zero; a null id
    stays as it is."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.withColumns({"__h": h, "__g": g, "__w": F.when(h % 10 == 0, words)})
    n = F.size("__w")
    docs = docs.withColumn("__a", F.when(n > 0, F.col("__g") % n))
    docs = docs.withColumn("__p", 1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8)))
    a, p = F.col("__a"), F.col("__p")
    moved = F.transform("__w", lambda w, i: F.when(i < a, w).otherwise(F.get("__w", (a + (i - a) % p).cast("int"))))
    text = F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col(text_col))
    return docs.withColumn(text_col, text).drop("__h", "__g", "__w", "__a", "__p")


def digests(docs: DataFrame, id_col: str = "doc_id", least: int = LEAST) -> DataFrame:
    """Counts, the longest run and digests of every row."""
    found = periodic_runs(docs, least=least)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    length, period = F.col("__best.length"), -F.col("__best.col3")
    return found.withColumn("__best", best).select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__best.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
