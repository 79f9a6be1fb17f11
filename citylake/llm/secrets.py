"""Secret scans: fixed patterns, and windowed entropy of candidate strings.

Everything is Spark functions. A pattern cuts a text into matches and the gaps before
them; running sums of their lengths, per row, give each match its place. Candidate strings
are runs of key characters. A candidate belongs to the narrowest character class that
holds all its characters, and a window of fixed length slides along it: the character that
leaves and the one that enters change two counts, and with them the sum of c * log2(c) (in
scaled integers), from which the window's Shannon entropy follows. A candidate with a
window above the bound of its class is a secret unless the allow-list names it or a
pattern's span already holds it.

Cases. Null text is empty: no spans. Null ids and repeated rows keep a row each. Texts are
scanned whole; offsets are code points. Overlaps of spans of different kinds stay. Spans
are in order of start, then kind. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.common import staged

#: Fixed patterns: kind, expression, group whose length counts, least length. A run of one
#: class that is too short can be left out of the expression; nothing else starts inside it.
PATTERNS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
ENTROPY = "entropy"
KINDS = (*(p[0] for p in PATTERNS), ENTROPY)
#: Characters of a window, and so of the shortest candidate.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
SCALE = 1 << 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made of `characters`, and the bits of a window that is too random for them.

    Twenty random characters have 3.2 bits on average if there are 16 different ones, 3.9 for
    26, 4.1 for 62 (4.32 is the most), while runs of ordinary words reach 3.7."""

    characters: str
    bits: float


CLASSES = (
    CharacterClass("0-9", math.inf),
    CharacterClass("0-9A-F", 3.0),
    CharacterClass("0-9a-fA-F", 3.0),
    CharacterClass("a-z", math.inf),
    CharacterClass("A-Za-z", 3.9),
    CharacterClass("A-Za-z0-9", 3.75),
    CharacterClass("A-Za-z0-9+/_=-", 3.85),
)
#: Candidates that are no secrets: identifiers with a fixed form, alphabets, samples, paths.
ALLOWED = (
    r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}",
    r"(?i).*(abcdefghij|0123456789|example|placeholder|changeme|your[_-]).*",
    r"(?:[A-Z]?[a-z]++[/_-]++)*+[A-Z]?[a-z]*+[/_=-]*+[0-9]{0,4}",
    r"[/_=+-]*",
)


def _parts(text: Column, kind: int, pattern: str) -> Column:
    """(kind, at, gap, found) of every match: its number, the length before it, the match."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("at"), F.length(F.get(gaps, i)).alias("gap"), x.alias("found")
        ),
    )


def windowed_entropy(text: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits, of all windows of `text`; null if it is shorter."""
    steps = [0 if not c else round(SCALE * c * math.log2(c)) for c in range(window + 1)]
    # growth[c]: change of the sum of c * log2(c) when a count grows from c to c + 1
    growth = F.array(*[F.lit(b - a).cast("long") for a, b in zip(steps, steps[1:], strict=False)])

    def least_total(chars: Column) -> Column:
        def slide(state: Column, i: Column) -> Column:
            enters, leaves = F.get(chars, i), F.get(chars, i - window)
            shared = F.slice(chars, F.greatest(i - window + 2, F.lit(1)), F.least(i, F.lit(window - 1)))
            less = F.when(i >= window, F.get(growth, F.size(F.filter(shared, lambda c: c == leaves)))).otherwise(0)
            total = state["total"] - less + F.get(growth, F.size(F.filter(shared, lambda c: c == enters)))
            least = F.when(i >= window - 1, F.least(state["least"], total)).otherwise(state["least"])
            return F.struct(total.alias("total"), least.alias("least"))

        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(None).cast("long").alias("least"))
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, slide, lambda state: state["least"])

    # a lambda variable holds the characters, so they are split once, not at every step
    least = F.get(F.transform(F.array(F.split(text, "")), least_total), F.lit(0))
    return F.lit(math.log2(window)) - least / float(SCALE * window)


def _bound(text: Column, classes: tuple[CharacterClass, ...]) -> Column:
    """The bits allowed to the narrowest class of a candidate."""
    out = F.lit(math.inf)
    for c in reversed(classes):
        out = F.when(text.rlike(f"^[{c.characters}]+$"), F.lit(c.bits)).otherwise(out)
    return out


def _allowed(text: Column, allow: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for pattern in allow:
        out = out | text.rlike(f"^(?:{pattern})$")
    return out


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    classes: tuple[CharacterClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """(id, spans) for every row: spans are (start, kind, end, base), kind an index of KINDS.

    The texts are read once and do not travel; only matches are grouped, by row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tried = [(k, pattern) for k, (_, pattern, _, _) in enumerate(PATTERNS)]
    tried.append((len(PATTERNS), CANDIDATE % window))
    found = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.concat(*[_parts(text, k, pattern) for k, pattern in tried]).alias("parts"),
        ),
        "secrets-matches",
    )
    every = found.filter(F.size("parts") > 0).select("id", "row", F.explode("parts").alias("p")).select("id", "row", "p.*")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = every.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(upto))
    placed = placed.withColumn("start", F.col("end") - F.length("found"))
    passes = F.lit(False)
    for k, (_, pattern, group, least) in enumerate(PATTERNS):
        size = F.length(F.regexp_extract("found", pattern, group)) if group else F.length("found")
        passes = F.when(F.col("kind") == k, size >= least).otherwise(passes)
    random = (
        (F.col("kind") == len(PATTERNS))
        & ~_allowed(F.col("found"), allow)
        & (windowed_entropy(F.col("found"), window) > _bound(F.col("found"), classes))
    )
    judged = placed.select("id", "row", "start", "end", "kind", passes.alias("base"), random.alias("random"))
    before = Window.partitionBy("row").orderBy("start", F.desc("base"), F.desc("end"))
    before = before.rowsBetween(Window.unboundedPreceding, 0)
    covered = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    kept = judged.withColumn("covered", F.coalesce(covered >= F.col("end"), F.lit(False)))
    span = F.struct("start", "kind", "end", "base")
    keeps = F.col("base") | (F.col("random") & ~F.col("covered"))
    grouped = kept.groupBy("row").agg(
        F.first("id").alias("id"), F.array_sort(F.collect_list(F.when(keeps, span))).alias("spans")
    )
    none = F.array().cast(grouped.schema["spans"].dataType)
    bare = found.filter(F.size("parts") == 0).select("id", none.alias("spans"))
    return grouped.select("id", "spans").union(bare).withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """The spans as `kind:start:end`, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(one, ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the patterns, a digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{p[0]}") for k, p in enumerate(PATTERNS)
    ]
    return found.select(
        id_col, *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
