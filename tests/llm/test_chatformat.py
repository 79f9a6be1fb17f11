import hashlib

import pytest

from citylake.llm.chatformat import format_conversations, parse, read_back

SAID = r"\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "user", SAID),
    (1, 1, "assistant", SAID),
    (1, 1, "assistant", None),
    (2, 1, "assistant", "b #:<\\h"),
    (2, 0, None, ""),
    (2, None, "sys: \\#", "first"),
    (3, 0, "user", "é日\n</turn>\n### x: y"),
    (None, 0, "assistant", "nobody"),
    (4, 0, "assistant", "z" * 5000),
    (4, 1, "assistant", "#" * 5000),
    (4, 2, "user", "same"),
    (4, 2, "user", "same"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def slow(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or "", role))
    out = set()
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[:4])
        body = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        loss = "".join(t[3] for t in turns if t[4] == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (body, loss)]
        out.add((conv, len(turns), digest[0], len(loss), digest[1]))
    return out


@pytest.mark.parametrize("part_bytes", [100, 4000, 32 << 20])
def test_round_trip_with_and_without_parts(spark, part_bytes):
    turns = spark.createDataFrame([(*r, 9, 9) for r in ROWS], SCHEMA + ", part int, n_turns int")
    formatted = format_conversations(turns, part_bytes=part_bytes)
    got = [tuple(r) for r in read_back(formatted).collect()]
    assert {r[:5] for r in got} == slow(ROWS) and len(got) == len(slow(ROWS))
    chars = {}
    for r in formatted.collect():
        chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["formatted"])
        turns_in = parse(r["formatted"].encode())
        assert len(turns_in) == r["n_turns"]
    assert {r[0]: r[5] for r in got} == chars


def test_no_control_string_inside_content(spark):
    turns = spark.createDataFrame(ROWS[:2], SCHEMA)
    text = format_conversations(turns).first()["formatted"]
    assert text.count("### ") == 2 and text.count("</turn>\n") == 2 and text.count(": ") >= 2


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_round_trip(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]
    out = QUERIES["op7_chat_byte_assembly"](spark, sf_dir).collect()
    assert {tuple(r)[:5] for r in out} == slow(rows) and len(out) == len(slow(rows))
