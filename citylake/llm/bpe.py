"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree are its adjacent pairs, keyed by (merge rank, position); a
node holds the smaller key of its children. The root is therefore the leftmost of the
lowest-ranked merges. A merge changes three leaves, each repaired along its path to the
root, until the root says that no pair can merge. Words of similar length share one
array, so the trees of thousands of words advance together, one merge per step.

Cases. Null text is encoded as empty; an empty text has no ids and decodes to the empty
string. Strings of special tokens in a text become those tokens, as in the vocabulary's
own library. Very long words get a tree of their own. Rows are independent: repeated
rows give repeated results and other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.normalizers import NFC, Lowercase, Sequence

from citylake.llm.common import gather, runs_of

VOCABULARY = "word_bpe_49k.json"
CELLS = 1 << 17
RUN_BYTES = 6 << 20
NEVER = np.iinfo(np.int64).max

# --- fixed values of the vocabulary file's format -------------------------------------
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
SPACE = r"[\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
WORD_END = "</w>"
# --------------------------------------------------------------------------------------


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes are themselves, the rest follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Bpe:
    """Tables of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[letters[b] + WORD_END] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([[ids[a], ids[b]] for a, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        names = ids | special
        tokens = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            tokens[i] = name
        self.tokens = pa.array(tokens)
        self.special = special
        found = sorted(map(regex.escape, special), key=len, reverse=True)
        self.split_special = regex.compile(f"({'|'.join(found)})") if found else None
        self.word, self.space = regex.compile(f"\\n|{WORD}"), regex.compile(SPACE)
        self.normal = Sequence([NFC(), Lowercase()])  # the library's Unicode version

    def pair_keys(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """rank << 32 | position of each pair, NEVER where the pair has no merge."""
        wanted = left << 32 | right
        slot = np.searchsorted(self.keys, wanted)
        found = self.ranks.take(slot, mode="clip") << 32 | position
        return np.where(self.keys.take(slot, mode="clip") == wanted, found, NEVER)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word; no word is empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        sizes = np.ones(len(words), np.int64)
        out = symbols.copy()  # a word's ids overwrite the front of its own stretch
        width = 1 << np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(np.int64)
        width[lengths == 1] = 0
        for leaves in np.unique(width[width > 0]).tolist():
            members = np.flatnonzero(width == leaves)
            step = max(1, CELLS // (2 * leaves))
            for at in range(0, len(members), step):
                part = members[at : at + step]
                starts, counts = ends[part] - lengths[part], lengths[part]
                merged, kept = self._trees(symbols, starts, counts, leaves)
                sizes[part] = kept
                spots = np.repeat(starts - (np.cumsum(kept) - kept), kept) + np.arange(len(merged))
                out[spots] = merged
        return gather(out, ends - lengths, sizes), sizes

    def _trees(
        self, symbols: np.ndarray, starts: np.ndarray, counts: np.ndarray, leaves: int
    ) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = len(starts), leaves + 1
        place = np.arange(cols)
        sym = symbols.take(starts[:, None] + place, mode="clip")
        sym[place >= counts[:, None]] = -1
        after = np.where(place + 1 < counts[:, None], place + 1, -1).astype(np.int32)
        before = np.broadcast_to((place - 1).astype(np.int32), (rows, cols)).copy()
        tree = np.full((rows, 2 * leaves), NEVER)
        tree[:, leaves:] = self.pair_keys(sym[:, :-1], sym[:, 1:], place[:-1])
        level = leaves
        while level > 1:
            level //= 2
            pairs = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(pairs[:, ::2], pairs[:, 1::2])
        tree, sym, after, before = (x.reshape(-1) for x in (tree, sym, after, before))
        depth = leaves.bit_length() - 1

        def repair(base: np.ndarray, leaf: np.ndarray, key: np.ndarray | int) -> None:
            node = leaf + leaves
            tree[base + node] = key
            for _ in range(depth):
                node >>= 1
                two = base + 2 * node
                least = np.minimum(tree.take(two), tree.take(two + 1))
                tree[base + node] = least

        base, cell = np.arange(rows) * (2 * leaves), np.arange(rows) * cols
        while True:
            root = tree.take(base + 1)
            more = np.flatnonzero(root != NEVER)
            if len(more) < len(root):
                if not len(more):
                    break
                base, cell, root = base.take(more), cell.take(more), root.take(more)
            spot = root & 0xFFFFFFFF
            here = cell + spot
            gone = after.take(here)
            following = after.take(cell + gone)
            fused = self.merged.take(root >> 32)
            sym[here] = fused
            sym[cell + gone] = -1
            after[here] = following
            linked = np.flatnonzero(following >= 0)
            if len(linked):
                before[(cell + following)[linked]] = spot[linked]
                repair(base[linked], gone[linked], NEVER)  # else `gone` ends the word
            right = sym.take(cell + following)
            right[following < 0] = -1
            repair(base, spot, self.pair_keys(fused, right, spot))
            rear = before.take(here)
            has = np.flatnonzero(rear >= 0)
            if len(has):
                rear, left = rear[has].astype(np.int64), sym.take((cell + rear)[has])
                repair(base[has], rear, self.pair_keys(left, fused[has], rear))
        sym = sym.reshape(rows, cols)
        kept = sym >= 0
        return sym[kept], kept.sum(axis=1)

    def normalised(self, lines: str) -> str:
        """Python's tables below U+0590, which no Unicode version changes, else the library's."""
        if np.frombuffer(lines.encode("utf-32-le", "surrogatepass"), np.uint32).max() >= 0x590:
            return self.normal.normalize_str(lines)
        return unicodedata.normalize("NFC", lines).replace("Σ", "σ").lower()

    def words_of(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokenised words of stretches without white space, and how many each has.

        Stretches travel as the lines of one string: no word spans a line end.
        """
        lines = "\n".join(chunks)
        lines = lines.lower() if lines.isascii() else self.normalised(lines)
        words = self.word.findall(lines)
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, words), bool, len(words)))
        counts = np.diff(np.concatenate(([-1], ends, [len(words)]))) - 1
        return [w for w in words if w != "\n"], counts

    def encode_stretches(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and edges of stretches without white space."""
        parts, fixed = chunks, {}
        if self.split_special and any("<|" in c for c in chunks):
            pieces = [self.split_special.split(c) if "<|" in c else [c] for c in chunks]
            parts = [p for ps in pieces for p in ps]
            fixed = {i: self.special[p] for i, p in enumerate(parts) if p in self.special}
            parts = ["" if i in fixed else p for i, p in enumerate(parts)]
        words, counts = self.words_of(parts)
        coded = pa.array(words, pa.string()).dictionary_encode()
        index = coded.indices.to_numpy()
        flat, sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if words:
            flat, sizes = self.merge_words(coded.dictionary.cast(pa.binary()).to_pylist())
        ids = gather(flat, (np.cumsum(sizes) - sizes)[index], sizes[index])
        upto = np.concatenate(([0], np.cumsum(sizes[index])))
        edges = upto[np.concatenate(([0], np.cumsum(counts)))]
        if fixed:  # one id in place of each special string, then parts back to stretches
            at = np.array(list(fixed))
            ids = np.insert(ids, edges[at], list(fixed.values()))
            edges = edges + np.concatenate(([0], np.cumsum(np.isin(np.arange(len(parts)), at))))
            edges = edges[np.concatenate(([0], np.cumsum([len(ps) for ps in pieces])))]
        return ids, edges

    def split(self, texts: pa.Array) -> pa.Array:
        """Lists of the stretches between white space (empty ones may occur)."""
        lists = pc.utf8_split_whitespace(texts)
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")  # white space to Arrow, not here
        if pc.any(odd).as_py():
            own = [self.space.split(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            lists = pc.if_else(odd, pa.array(own, lists.type), lists)
        return lists

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (no nulls) and the edges of each."""
        lists = self.split(texts)
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        ids, edges = self.encode_stretches(coded.dictionary.to_pylist())
        starts, sizes = edges[:-1][which], np.diff(edges)[which]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        return gather(ids, starts, sizes), upto[np.concatenate(([0], np.cumsum(counts)))]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """The file names no decoder: token strings joined by blanks, special ones included."""
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), self.tokens.take(pa.array(ids)))
        return pc.binary_join(lists, " ")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    `path` is the vocabulary file on the executors; by default the installed public one.
    ids_sha256 covers the ids as little-endian unsigned 32-bit integers, decoded_sha256
    the decoded text in UTF-8. `with_ids=False` leaves out the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path or _installed())
        for batch in batches:
            for at, size in runs_of(batch.column(1), RUN_BYTES):
                texts = pc.fill_null(batch.column(1).slice(at, size), "")
                ids, edges = bpe.encode(texts)
                ends = edges.tolist()
                packed = memoryview(ids.astype("<u4")).cast("B")
                spans = [packed[4 * i : 4 * j] for i, j in zip(ends, ends[1:])]
                columns = [
                    batch.column(0).slice(at, size),
                    pa.array(np.diff(edges)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in spans]),
                    pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in bpe.decode(ids, edges)]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    values = pa.array(ids.astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def _installed() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)
