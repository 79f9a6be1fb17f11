"""Quality rules from tokeniser fertility: characters per token, byte-fallback share and
token entropy under a public vocabulary, with bands per script.

Words are runs of anything but ASCII white space; each is tokenised on its own, so equal
words of a run of texts are tokenised once. A text is kept if it passes the base rules
and its three measures lie within the bands of its main script (most letters; ties to
the earlier row of the table).

Cases. Null and empty text: no words, base_failed. Text without letters: script "other", with a
band of its own.
Very long texts are read whole. Repeated rows give repeated results; null ids stay null;
other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import gather, runs_of

VOCABULARY = "piece_bpe_32k.model"
RUN_BYTES = 6 << 20
BLANK = " \t\n\r\x0b\x0c"

# --- fixed values: Unicode blocks of the scripts that have bands -----------------------
SCRIPT_RANGES = [
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F),
    ("thai", 0xE00, 0xE7F),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
# --------------------------------------------------------------------------------------
SCRIPTS = [name for name, _, _ in SCRIPT_RANGES] + ["other"]


class Band(NamedTuple):
    """Accepted characters per token, largest byte-fallback share, least entropy in bits."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: Measured with the default vocabulary: ordinary Latin prose of the test tables has 1.65 to 2.55
#: characters per token (a thousandth of it below 1.79) and English about 4, words of random
#: lower-case letters 1.45 to 1.64 (mostly below 1.6), of random capitals 1.32 to 1.39, base64 1.2, hex 1.1.
BANDS = {
    "latin": Band(1.6, 8.0, 0.25, 2.5),
    "greek": Band(0.5, 4.0, 0.6, 2.5),
    "cyrillic": Band(1.0, 6.0, 0.25, 2.5),
    "hebrew": Band(0.4, 4.0, 0.8, 2.5),
    "arabic": Band(0.4, 4.0, 0.8, 2.5),
    "devanagari": Band(0.3, 3.0, 0.95, 2.0),
    "thai": Band(0.3, 3.0, 0.95, 2.0),
    "kana": Band(0.3, 2.0, 0.8, 2.5),
    "han": Band(0.2, 2.0, 0.95, 2.0),
    "hangul": Band(0.2, 2.0, 0.95, 2.0),
    "other": Band(0.3, 8.0, 0.8, 2.0),
}
#: For text without any letter: numbers have 0.65 to 0.9 characters per token, symbols 1.1 to 1.2,
#: emoji are bytes.
NO_LETTERS = Band(1.5, 8.0, 0.25, 2.5)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_tokens long, script string, "
    "chars_per_token double, byte_share double, token_entropy double"
)


@functools.lru_cache(maxsize=2)
def pieces(path: str):
    """The tokeniser and, per id, whether it stands for a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.vocab_size())])


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    wide = int(ids.max()) + 1
    pair = ids[:-2] * wide + ids[1:-1]
    if wide >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, counts = np.unique(pair * wide + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def main_script(text: str) -> str:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = [
        int(((points >= low) & (points <= high)).sum()) for _, low, high in SCRIPT_RANGES
    ] if not text.isascii() else [sum(map(str.isalpha, text)) or 0]
    best = int(np.argmax(counts))
    return SCRIPTS[best] if counts[best] else "other"


def band_of(text: str, script: str) -> Band:
    if script == "other" and not any(map(str.isalpha, text)):
        return NO_LETTERS
    return BANDS[script]


def measure(texts: pa.Array, path: str) -> list[tuple]:
    """The columns after doc_id for a run of texts without nulls."""
    model, is_byte = pieces(path)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    vocabulary = coded.dictionary
    chars = pc.utf8_length(vocabulary).to_numpy().astype(np.int64)
    symbols = pc.count_substring_regex(vocabulary, "[#*$%&|<>]").to_numpy().astype(np.int64)
    encoded = model.encode(vocabulary.to_pylist(), num_threads=1) if len(vocabulary) else []
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    flat = np.fromiter((i for ids in encoded for i in ids), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    words = coded.indices.to_numpy().astype(np.int64)
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    out = []
    for k, text in enumerate(texts.to_pylist()):
        ids = words[edges[k] : edges[k + 1]]
        ids = ids[chars[ids] > 0]
        n_words, repeats = len(ids), repeated_words(ids)
        failed = n_words < 50 or 100 * repeats > 50 * n_words
        tokens = gather(flat, starts[ids], sizes[ids])
        n_tokens, word_chars = len(tokens), int(chars[ids].sum())
        script = main_script(text)
        fertility = bytes_share = entropy = None
        good = not failed
        if n_tokens:
            fertility, bytes_share = word_chars / n_tokens, float(is_byte[tokens].mean())
            share = np.unique(tokens, return_counts=True)[1] / n_tokens
            entropy = float(-(share * np.log2(share)).sum()) + 0.0
            band = band_of(text, script)
            good = (
                good
                and band.least_chars <= fertility <= band.most_chars
                and bytes_share <= band.most_bytes
                and entropy >= band.least_entropy
            )
        out.append(
            (n_words, word_chars, int(symbols[ids].sum()), duplicate_lines(text), repeats, failed)
            + (good, n_tokens, script, fertility, bytes_share, entropy)
        )
    return out


def fertility_rules(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures and verdict of every whole text; `path` is the vocabulary on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or _installed()
        for batch in batches:
            for at, size in runs_of(batch.column(1), RUN_BYTES):
                rows = measure(pc.fill_null(batch.column(1).slice(at, size), ""), where)
                columns = [batch.column(0).slice(at, size), *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW
                )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, SCHEMA)


ARROW = pa.schema(
    [
        (name, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}.get(kind, pa.string()))
        for name, kind in (field.split() for field in SCHEMA.split(", "))
    ]
)


def _installed() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)
