"""Conversation structure repair: the cheapest edits to `(s?(ua)+)?`, by Viterbi.

A conversation is a sequence of rows with role initials. Rows are kept, given the role
user or assistant, or deleted, and empty user or assistant rows are put in between, so that
the initials match the pattern at the least cost; of equally cheap edits the string of
their initials that is least in ASCII counts. States are the places in the pattern: nothing
yet, after a system row, after a user row, after an assistant row.

Rows are dealt by ranges of (conversation, turn, ...), so a conversation that holds a large
part of the table spans many tasks, and a task cuts its rows into stretches. Costs and the
order of tied edit strings compose over stretches: from each state at its start, a stretch
is summed up by the cost to each state at its end and by the rank of the edit string.
Folding these few numbers per stretch gives the states at its two ends, and then every
stretch is decoded by itself.

Decoding keeps a tree of back pointers with reference counts. A survivor that another beats
whatever follows is given up, and a node without a survivor below it is freed; where all survivors share an ancestor, the edits up to it are emitted.
Equally cheap ways are compared on their whole unresolved edits, back to the node at which
they part. Both end with the edit of a row and hold as many of those, so neither is the
beginning of the other, and what is decided stays decided.

Cases. Null conversation ids form one conversation, null turns come first, and a null role
or text counts as one space. Rows of one turn are ordered by role, the text's first 256
characters and a hash of the text; repeated rows stay beside each other, and all but the
first are duplicates. A role counts by its first character. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import staged

SPACE = " \t\n\x0b\x0c\r"
STRETCH = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Pattern state after a user or assistant row.
AFTER = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Inserted rows after the last row, by state.
CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
EDIT_TYPE = "conv_id long, chunk long, seq long, at int, edit string, turn long, was string, role string, text string, cost long"


def _next_states(state: int, kind: str) -> list[tuple[int, int, str]]:
    """(state, cost, edits) of every way to use one row. `kind` is the row's initial and its
    fault: x must go, t is truncated, . is neither."""
    out = [(state, DELETE, "D")]
    initial, fault = kind[0], kind[1]
    if fault == "x":
        return out
    extra = TRUNCATED if fault == "t" else 0
    for before, now, cost in (("", state, 0), ("I", AFTER[state], INSERT)):
        after = AFTER[now]
        if initial == ROLE_OF[after][0]:
            out.append((after, cost + KEEP + extra, before + "K"))
        if initial == "s" and now == NOTHING:
            out.append((SYSTEM, cost + KEEP + extra, before + "K"))
        out.append((after, cost + REROLE + extra, before + "R"))
    best: dict[int, tuple[int, str]] = {}
    for after, cost, edits in out:
        best[after] = min(best.get(after, (cost, edits)), (cost, edits))
    return [(after, *way) for after, way in best.items()]


KINDS = [i + f for i in "sua?" for f in "x.t"]
WAYS = {k: [_next_states(s, k) for s in STATES] for k in KINDS}

#: LEAD[t][s]: from t, the rest of a conversation costs at most this much more than from s (put in
#: a row, or delete a system row that only s may keep). A survivor s that costs more than another,
#: t, and its lead is on no cheapest way.
LEAD = {
    NOTHING: {SYSTEM: 0, USER: INSERT, ASSISTANT: 0},
    SYSTEM: {NOTHING: 2 * INSERT, USER: INSERT, ASSISTANT: 2 * INSERT},
    USER: {NOTHING: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {NOTHING: DELETE, SYSTEM: 0, USER: INSERT},
}

Ranked = dict[int, tuple[int, int]]  # state -> (cost, rank of its edits)


def _ranked(found: dict[int, tuple]) -> Ranked:
    """Costs with the edits replaced by their rank among the survivors."""
    ranks = {text: k for k, text in enumerate(sorted({way[1:] for way in found.values()}))}
    return {s: (way[0], ranks[way[1:]]) for s, way in found.items()}


def _advance(now: Ranked, kind: str) -> Ranked:
    found: dict[int, tuple] = {}
    for state, (cost, rank) in now.items():
        for after, more, edits in WAYS[kind][state]:
            way = (cost + more, rank, edits)
            if after not in found or way < found[after]:
                found[after] = way
    return _ranked(found)


def _folded(now: Ranked, stretch: list[Ranked]) -> tuple[Ranked, dict[int, int]]:
    """Survivors after a stretch, and the state at its start that each came from."""
    found: dict[int, tuple] = {}
    origin: dict[int, int] = {}
    for state, (cost, rank) in now.items():
        for after, (more, inner) in stretch[state].items():
            way = (cost + more, rank, inner)
            if after not in found or way < found[after]:
                found[after], origin[after] = way, state
    return _ranked(found), origin


class Survivors:
    """The tree of back pointers over the states of one stretch."""

    class Node:
        __slots__ = ("below", "edits", "parent")

        def __init__(self, parent: Survivors.Node | None, edits: str) -> None:
            self.parent, self.edits, self.below = parent, edits, 0
            if parent is not None:
                parent.below += 1

    def __init__(self, state: int) -> None:
        self.root = self.Node(None, "")
        self.live = {state: (0, self.root)}
        self.held = self.peak = 0

    def _unresolved(self, a: Node, b: Node, more_a: str, more_b: str) -> bool:
        """Whether the edits down to `a`, and more, are less than those to `b`."""
        ways = ([more_a], [more_b])
        while a is not b:  # every level is a row, so both climb together
            ways[0].append(a.edits)
            ways[1].append(b.edits)
            a, b = a.parent, b.parent
        return "".join(reversed(ways[0])) < "".join(reversed(ways[1]))

    def advance(self, kind: str) -> list[str]:
        """Take a row; the edits of earlier rows that no later row can change."""
        best: dict[int, tuple[int, Survivors.Node, str]] = {}
        for state, (cost, node) in self.live.items():
            for after, more, edits in WAYS[kind][state]:
                old = best.get(after)
                total = cost + more
                if old is None or total < old[0] or (total == old[0] and self._unresolved(node, old[1], edits, old[2])):
                    best[after] = (total, node, edits)
        hopeless = [s for s in best for t in best if s != t and best[s][0] > best[t][0] + LEAD[t][s]]
        for state in set(hopeless):
            del best[state]
        before = [node for _, node in self.live.values()]
        self.live = {s: (cost, self.Node(parent, edits)) for s, (cost, parent, edits) in best.items()}
        self.held += len(self.live)
        for node in before:
            while node.below == 0 and node.parent is not None:
                node.parent.below -= 1
                self.held -= 1
                node = node.parent
        self.peak = max(self.peak, self.held)
        return self._settled()

    def _settled(self) -> list[str]:
        out: list[str] = []
        if self.root.below != 1:
            return out
        path, node = [], next(iter(self.live.values()))[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            if self.root.below != 1:
                break
            out.append(node.edits)
            node.parent, self.root = None, node
            self.held -= 1
        return out

    def finish(self, state: int) -> list[str]:
        """The edits of the rows still open, if the stretch ends in `state`."""
        out, node = [], self.live[state][1]
        while node is not self.root:
            out.append(node.edits)
            node = node.parent
        return out[::-1]


def with_faults(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, fault, key): the first fault of each, and a key that
    puts the rows of a turn in order. Fault is blank, duplicate, truncated or empty."""
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    rows = staged(
        rows.select(
            "*",
            F.struct("turn", "role", F.substring("text", 1, 256).alias("begin"), F.xxhash64("text").alias("h1"),
                     F.xxhash64(F.lit(1), "text").alias("h2"), F.monotonically_increasing_id().alias("row")).alias("key"),
        ),
        "repair-rows",
    )
    same = ["conv_id", "role", "key.h1", "key.h2"]
    first = rows.groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct("key.turn", "key.row")).alias("first"))
    first = first.filter("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "h1", "h2", "first")
    first = staged(first, "repair-repeats")
    match = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
    match = match & (F.col("key.h1") == F.col("h1")) & (F.col("key.h2") == F.col("h2"))
    later = F.col("first").isNotNull() & (F.struct("key.turn", "key.row") != F.col("first"))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(F.length(bare) == 0, "blank")
        .when(later, "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return rows.join(first, match, "left").select("conv_id", "turn", "role", "text", fault.alias("fault"), "key")


def _kind(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    what = F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", "t").otherwise(".")
    return F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("?"), what)


def stretches(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Rows in order with `chunk`, the stretch they are in, and `seq`; the last row of a
    stretch carries `sums`, cost and rank by first and last state (16 times two)."""
    order = [F.col(f"key.{c}") for c in ("turn", "role", "begin", "h1", "h2", "row")]
    ranged = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    ranged = ranged.select("conv_id", "turn", "role", "text", _kind(F.col("role"), F.col("fault")).alias("kind"), "fault")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        chunk, seq, last = part - 1, 0, object()
        now: list[Ranked] = []
        held: pa.RecordBatch | None = None
        marks: tuple[list, list, list] = ([], [], [])

        def written(sums: list) -> pa.RecordBatch:
            columns = [pa.array(marks[0], pa.int64()), pa.array(marks[1], pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*held.columns, *columns], [*held.schema.names, "chunk", "seq", "sums"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, kinds = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            chunks, seqs, sums = [], [], []
            for conv, kind in zip(ids, kinds, strict=True):
                if conv != last or seq == stretch:
                    if sums:
                        sums[-1] = _flat(now)
                    elif held is not None:
                        marks[2][-1] = _flat(now)
                    chunk, seq, last = chunk + 1, 0, conv
                    now = [{s: (0, 0)} for s in STATES]
                now = [_advance(n, kind) for n in now]
                chunks.append(chunk)
                seqs.append(seq)
                sums.append(None)
                seq += 1
            if held is not None:
                yield written(marks[2])
            held, marks = batch, (chunks, seqs, sums)
        if held is not None:
            marks[2][-1] = _flat(now)
            yield written(marks[2])

    fields = "conv_id long, turn long, role string, text string, kind string, fault string, chunk long, seq long, sums array<long>"
    return ranged.mapInArrow(run, fields)


def _flat(now: list[Ranked]) -> list[int]:
    return [x for n in now for s in STATES for x in n.get(s, (-1, -1))]


def _summary(flat: list[int]) -> list[Ranked]:
    pairs = list(zip(flat[::2], flat[1::2], strict=True))
    return [{t: pairs[4 * s + t] for t in STATES if pairs[4 * s + t][0] >= 0} for s in STATES]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, chunk, enters, leaves, last) of the cheapest edits, a row per stretch."""
    held: list[tuple[int, list[Ranked]]] = []
    last = object()

    def traced(conv) -> pa.RecordBatch:
        now, origins = {NOTHING: (0, 0)}, []
        for _, stretch in held:
            now, origin = _folded(now, stretch)
            origins.append(origin)
        state = min(now, key=lambda s: (now[s][0] + INSERT * len(CLOSING[s]), now[s][1], CLOSING[s]))
        rows = []
        for (chunk, _), origin in zip(reversed(held), reversed(origins), strict=True):
            rows.append((conv, chunk, origin[state], state, not rows))
            state = origin[state]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "chunk", "enters", "leaves", "last"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != last:
                yield traced(last)
                held = []
            last = row["conv_id"]
            held.append((row["chunk"], _summary(row["sums"])))
    if held:
        yield traced(last)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of every stretch, a row each."""
    names = [f.split()[0] for f in EDIT_TYPE.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.int32(), pa.string(), pa.int64()] + [pa.string()] * 3 + [pa.int64()]
    out: list[tuple] = []
    waiting: deque[dict] = deque()
    tree, state, chunk = None, NOTHING, None

    def applied(settled: list[str]) -> None:
        nonlocal state
        for edits in settled:
            row = waiting.popleft()
            where = (row["conv_id"], row["chunk"], row["seq"])
            for at, edit in enumerate(edits):
                if edit == "I":
                    state = AFTER[state]
                    out.append((*where, at, "I", None, None, ROLE_OF[state], "", INSERT))
                    continue
                cost, role = TRUNCATED if row["fault"] == "truncated" and edit != "D" else 0, row["role"]
                if edit == "D":
                    cost = DELETE
                elif edit == "K" and state == NOTHING and row["kind"][0] == "s":
                    state = SYSTEM
                else:
                    state = AFTER[state]
                    if edit == "R":
                        cost, role = cost + REROLE, ROLE_OF[state]
                out.append((*where, at, edit, row["turn"], row["role"], role, row["text"], cost))

    def closed(row: dict) -> None:
        nonlocal state
        applied(tree.finish(row["leaves"]))
        if row["last"]:
            for k in range(len(CLOSING[state])):
                state = AFTER[state]
                out.append((row["conv_id"], row["chunk"], row["seq"], 2 + k, "I", None, None, ROLE_OF[state], "", INSERT))

    def written() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        out.clear()
        return batch

    before = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["chunk"] != chunk:
                if before is not None:
                    closed(before)
                chunk, state, tree = row["chunk"], row["enters"], Survivors(row["enters"])
            waiting.append(row)
            applied(tree.advance(row["kind"]))
            before = row
        yield written()
    if before is not None:
        closed(before)
        yield written()


def repair(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The edits of all conversations, in the order (conv_id, chunk, seq, at): K kept, R with a
    new role, D deleted (role and text of the row as it was), I put in; the role it `was`, and what each edit costs.

    `rows` are those of `with_faults`. What remains after the deletions is the repaired
    conversation."""
    dealt = staged(stretches(rows, stretch), "repair-stretches")
    sums = dealt.filter(F.col("sums").isNotNull()).select("conv_id", "chunk", "sums")
    ends = sums.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    ends = ends.mapInArrow(_ends, "conv_id long, chunk long, enters int, leaves int, last boolean")
    ends = staged(ends.select("chunk", "enters", "leaves", "last"), "repair-ends")
    both = dealt.drop("sums").join(ends, "chunk").repartition("chunk").sortWithinPartitions("chunk", "seq")
    return both.mapInArrow(_decoded, EDIT_TYPE)


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` with one row in twenty dropped, emptied, stripped of sentence ends, repeated or
    made a user's, by a checksum of conversation and turn. Nulls become one space, except in
    the numbers themselves."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), fate.alias("fate")
    )
    return rows.withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fate", "copy")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, audit, repaired_sha256, illegal) of edits in order. Texts are hashed as they
    pass; of a conversation only the initials of its edits are held, which are part of the result."""
    conv, audit, digest, sep, before, illegal = object(), [], hashlib.sha256(), b"", None, 0

    def done() -> pa.RecordBatch:
        columns = [pa.array([conv], pa.int64()), pa.array(["".join(audit)]), pa.array([digest.hexdigest()]), pa.array([illegal], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "audit", "repaired_sha256", "illegal"])

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "was", "role", "text")), strict=True)
        for owner, edit, was, role, text in rows:
            if owner != conv:
                if audit:
                    yield done()
                conv, audit, digest, sep, before, illegal = owner, [], hashlib.sha256(), b"", None, 0
            audit.append(edit)
            if edit != "D":
                digest.update(sep + f"{role}:{text}".encode())
                sep = b"\n"
            if was is not None:
                illegal += before is not None and before + was[:1] not in ("su", "ua", "au")
                before = was[:1]
    if audit:
        yield done()


def digests(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Gaps, faults, cost, edits and a digest of every conversation of `turns` after damage.

    A digest of the whole repaired text and one string of all edits are values of one row per
    conversation, so each is made by one task, which reads the edits in order as a stream."""
    rows = staged(with_faults(damaged(turns)), "repair-faults")
    edits = staged(repair(rows, stretch), "repair-edits")
    of_fault = {f: F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")}
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = rows.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *of_fault.values())
    costs = edits.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    ordered = edits.select("conv_id", "chunk", "seq", "at", "edit", "was", "role", "text")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "seq", "at")
    hashed = ordered.mapInArrow(_hashed, "conv_id long, audit string, repaired_sha256 string, illegal long")
    every = turns.select(F.col("conv_id").cast("long")).distinct()
    for part in (counted, costs, hashed):
        every = every.unionByName(part, allowMissingColumns=True)
    numbers = ("gaps", *of_fault, "illegal", "cost")
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
