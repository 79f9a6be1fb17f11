import pytest
import xxhash

from citylake.llm.linededup import remove_repeated_lines
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def place(row):
    """Nulls last, then by id, then by Spark's hash of the text."""
    digest = xxhash.xxh64_intdigest((row[1] or "").encode("utf-8", "surrogatepass"), 42) if row[1] is not None else 42
    return row[0] is None, row[0] or 0, digest - (1 << 64) * (digest >> 63)


def slow(rows):
    """(id, text, lines lost) of rows (id, text), by dictionaries over all windows of the text
    between two empty lines."""
    first, order = {}, sorted(rows, key=place)
    cut = {r: (r[1] or "").split("\n") if r[1] is not None else [] for r in rows}
    framed = {r: ["", *x, ""] if x else [] for r, x in cut.items()}
    windows = {
        r: [(i, tuple(x[i : i + 3])) for i in range(len(x) - 2) if any(line.strip(" \t\r\x0b\x0c") for line in x[i : i + 3])]
        for r, x in framed.items()
    }
    for r in order:
        for _, w in windows[r]:
            first.setdefault(w, r)
    out = []
    for r in rows:
        covered, seen = set(), set()
        for i, w in windows[r]:
            if first[w] != r or w in seen:
                covered |= {i - 1, i, i + 1} & set(range(len(cut[r])))
            seen.add(w)
        kept = [x for i, x in enumerate(cut[r]) if i not in covered]
        out.append((r[0], None if r[1] is None else "\n".join(kept), len(covered)))
    return out


CASES = [
    (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd"), (4, "q\nq\nq\nq\nq"), (5, "\n\n\n\n"), (6, " \n\t\n \nz"),
    (7, "\n\n\n\n"), (8, "a\nb"), (9, "a\nb\nc"), (9, "a\nb\nc\nnew"), (10, ""), (11, None), (None, "a\nb\nc"),
    (None, "only\nhere\nnull"), (12, "x\na\nb\nc\nd\ny\nx\na\nb"), (12, "x\na\nb\nc\nd\ny\nx\na\nb"), (15, "one line of its own"), (16, "one line of its own"), (17, "head\nshared end"), (18, "other\nshared end"), (13, "same\nsame\nsame"), (14, "same\nsame\nsame\nsame"),
]


def test_against_brute_force(spark):
    out = remove_repeated_lines(spark.createDataFrame(CASES, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out), key=str) == sorted(slow(CASES), key=str)


def test_every_removed_line_survives_elsewhere(spark):
    rows = CASES[:15]
    out = remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = {line for r in out if r["text"] is not None for line in r["text"].split("\n")}
    assert {line for r in rows if r[1] for line in r[1].split("\n")} - {""} <= left


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    docs = rows(spark)
    out = remove_repeated_lines(docs)
    assert [c for c in out.columns if c != "lines_removed"] == docs.columns
    got = [(r["doc_id"], r["text"], r["lines_removed"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(slow([r[:2] for r in awkward_rows()]), key=str)


def test_empty_table(spark):
    assert remove_repeated_lines(empty(spark)).collect() == []
