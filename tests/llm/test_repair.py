import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from citylake.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def exhaustive(kinds):
    """Cheapest edits of a short conversation, by trying all."""
    puts = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for choice in itertools.product(*[list(itertools.product(puts, "KUAD")) for _ in kinds], puts):
        cost, audit, roles = 0, "", ""
        for (put, edit), kind in zip(choice, kinds):
            cost += 2 * len(put) + {"K": 0, "D": 3}.get(edit, 2) + (edit != "D") * (kind[1] == "t")
            cost += 100 * (kind[1] == "x" and edit != "D")
            audit += "I" * len(put) + ("R" if edit in "UA" else edit)
            roles += put + {"K": kind[0], "D": ""}.get(edit, edit.lower())
        cost, audit, roles = cost + 2 * len(choice[-1]), audit + "I" * len(choice[-1]), roles + choice[-1]
        if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
    return best


def whole_strings(kinds):
    """The same by a table of (cost, whole edit string) per pattern state."""
    step = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {"": (0, "")}

    def put(table):
        out = dict(table)
        for _ in range(3):
            for state, (cost, audit) in list(out.items()):
                for role in "ua":
                    if (state, role) in step:
                        new = (cost + 2, audit + "I")
                        out[step[state, role]] = min(out.get(step[state, role], new), new)
        return out

    for initial, fault in kinds:
        new = {s: (c + 3, a + "D") for s, (c, a) in now.items()}
        if fault != "x":
            extra = fault == "t"
            # inserts are tried right before the row they serve, so strings stay comparable
            for state, (cost, audit) in put(now).items():
                for role, price, letter in ((initial, 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                    if (state, role) in step:
                        way = (cost + price + extra, audit + letter)
                        to = step[state, role]
                        new[to] = min(new.get(to, way), way)
        now = new
    ends = put(now)
    return min(ends[s] for s in ("", "a") if s in ends)


def rebuilt(audit, rows):
    """Rows after the edits; the roles follow from their order."""
    out, rows, state = [], iter(rows), ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == "u" else "user"
        out.append((role, text))
        state = role[:1]
    assert next(rows, None) is None
    return out


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def slow_digest(original, optimum=whole_strings):
    out = {}
    after = slow_damage(original)
    for conv in {r[0] for r in original}:
        rows = [r[1:] for r in after if r[0] == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, kinds, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            bare = text.rstrip(BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], {"truncated": "t", "": "."}.get(fault, "x")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = optimum(kinds)
        fixed = "\n".join(f"{r}:{t}" for r, t in rebuilt(audit, [r[1:] for r in rows]))
        digest = hashlib.sha256(fixed.encode()).hexdigest()
        out[conv] = (conv, gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def made_up(seed, conversations=60, longest=40):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            text = rng.choice([f"say {rng.randrange(9)}.", f"ask {rng.randrange(99)}?", "cut off", " \n", "Yes! ", None, "x"])
            rows.append((conv if conv else None, turn if rng.random() < 0.9 else None, role, text))
    return rows


def check(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv_id"]: tuple(r) for r in repair.digests(frame, **options).collect()}
    assert got == slow_digest(rows)
    return got


KINDS = ["s.", "u.", "a.", "st", "ut", "at", "ux", "?."]


def test_brute_forces_agree():
    for n in range(4):
        for kinds in itertools.islice(itertools.product(KINDS, repeat=n), 0, None, 1 if n < 3 else 101):
            assert exhaustive(kinds) == whole_strings(kinds), kinds


def decode(kinds, stretch):
    """The operator's pieces without Spark: sums of stretches, ends, decoding; the largest tree."""
    cuts = [kinds[i : i + stretch] for i in range(0, len(kinds), stretch)]
    now, origins = {repair.NOTHING: (0, 0)}, []
    for cut in cuts:
        sums = [{s: (0, 0)} for s in repair.STATES]
        for kind in cut:
            sums = [repair._advance(n, kind) for n in sums]
        now, origin = repair._folded(now, repair._summary(repair._flat(sums)))
        origins.append(origin)
    state = min(now, key=lambda s: (now[s][0] + 2 * len(repair.CLOSING[s]), now[s][1]))
    cost, audit, peak = now[state][0] + 2 * len(repair.CLOSING[state]), repair.CLOSING[state], 0
    for cut, origin in zip(reversed(cuts), reversed(origins)):
        tree = repair.Survivors(origin[state])
        done = [e for kind in cut for e in tree.advance(kind)]
        audit = "".join(done + tree.finish(state)) + audit
        state, peak = origin[state], max(peak, tree.peak)
    return cost, audit, peak


@pytest.mark.parametrize("stretch", [1, 2, 7, 1000])
def test_stretches_and_tree_as_whole_strings(stretch):
    rng = random.Random(stretch)
    for _ in range(400):
        pool = rng.choice([KINDS, ["u.", "a."], ["a."], ["st", "ut"], ["u.", "ux"], ["?.", "s."]])
        kinds = [rng.choice(pool) for _ in range(rng.randrange(1, 60))]
        assert decode(kinds, stretch)[:2] == whole_strings(kinds)


def test_memory_stays_bounded_when_survivors_meet():
    rng = random.Random(1)
    kinds = [("ua"[i % 2] if rng.random() < 0.9 else rng.choice("su")) + rng.choice("....tx") for i in range(30_000)]
    cost, audit, peak = decode(kinds, 1 << 20)
    assert peak < 200 and (cost, audit) == decode(kinds, 64)[:2] == whole_strings(kinds)


def test_against_brute_force(spark):
    rows = made_up(1)
    check(spark, rows)
    check(spark, rows + rows[:200], stretch=5)


def test_one_hot_conversation_spans_tasks(spark):
    rng = random.Random(2)
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"text {rng.randrange(10**6)}{rng.choice('..?!,')}") for t in range(3000)]
    rows += made_up(3, conversations=5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        dealt = repair.stretches(repair.with_faults(spark.createDataFrame(rows, SCHEMA)), 64)
        where = dealt.filter("conv_id = 7").select(F.expr("shiftright(chunk, 32)").alias("task"), "chunk").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in where}) > 1 and len(where) > 40
    check(spark, rows, stretch=64)


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()]
    got = {r["conv_id"]: tuple(r) for r in queries.QUERIES["op11_survivor_viterbi_repair"](spark, sf_dir).collect()}
    assert got == slow_digest(rows)


def test_operator_gives_the_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hi?"), (1, 3, "tool", "cut")]
    edits = repair.repair(repair.with_faults(spark.createDataFrame(rows, SCHEMA))).orderBy("chunk", "seq", "at").collect()
    assert "".join(r["edit"] for r in edits) == "IKKDR"
    kept = [(r["role"], r["text"]) for r in edits if r["edit"] != "D"]
    assert kept == [("user", ""), ("assistant", "Hello."), ("user", "Hi?"), ("assistant", "cut")]
    assert sum(r["cost"] for r in edits) == 2 + 3 + 3


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "a."), (1, None, "user", "a."), (1, 3, "", "x" * 300_000), (1, 3, "sys", "Ok.")]
    rows += [(2, t, "user", "same.") for t in range(50)] + [(3, 0, "user", " "), (3, 1, "assistant", "\x0b\x0c")]
    check(spark, rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("chunk", "seq", "key", "fault", "kind", "n")})
    assert repair.digests(frame).count() == len({r[0] for r in rows})
    assert repair.digests(frame.filter("false")).collect() == []
