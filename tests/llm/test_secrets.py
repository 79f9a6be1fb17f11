import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from citylake.llm import queries, secrets
from tests.llm.helpers import awkward, clashing, empty

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
MIXED = string.ascii_letters + string.digits


def entropy(text):
    best = 0
    for i in range(len(text) - 19):
        counts = Counter(text[i : i + 20]).values()
        best = max(best, -sum(c / 20 * math.log2(c / 20) for c in counts))
    return best


def slow_spans(text):
    """(start, kind, end) of the patterns and of the candidates that are too random."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    more = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        limit = next(c.bits for c in secrets.CLASSES if re.fullmatch(f"[{c.characters}]+", m[0]))
        fine = any(re.fullmatch(p, m[0]) for p in secrets.ALLOWED)
        inside = any(s <= m.start() and m.end() <= e for s, _, e in base)
        if not fine and not inside and entropy(m[0]) > limit + 1e-6:
            more.append((m.start(), 3, m.end()))
    return sorted(base), sorted(base + more)


def slow_digest(doc_id, text):
    base, every = slow_spans(text)
    line = lambda spans: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    counts = [sum(k == n for _, k, _ in base) for n in range(3)]
    return (doc_id, *counts, hashlib.sha256(line(base).encode()).hexdigest(), line(every))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def check(spark, docs):
    got = secrets.digests(secrets.find_secrets(docs)).collect()
    key = lambda r: [(x is not None, x) for x in r]
    want = sorted((slow_digest(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    return {r["doc_id"]: r["spans"] for r in got}


def made_up(rng):
    pieces = []
    for _ in range(rng.randrange(12)):
        size = rng.choice([0, 3, 11, 12, 13, 15, 16, 18, 20, 25, 60])
        pool = rng.choice([MIXED, "0123456789abcdef", "0123456789ABCDEF", string.digits, string.ascii_lowercase, "ab", MIXED + "+/_=-."])
        key = rng.choice(["", "", "token=", "API_KEY : '", 'Secret": "', "apikey=", "passwd  =  ", "AKIA", "token: secret = ", "password"])
        pieces.append(key + "".join(rng.choice(pool) for _ in range(size)))
    return rng.choice([" ", "\n", "é😀 ", "", "; "]).join(pieces)


def test_against_brute_force(spark):
    rng = random.Random(3)
    spans = check(spark, frame(spark, [made_up(rng) for _ in range(1500)]))
    found = Counter(x.split(":")[0] for s in spans.values() for x in s.split(",") if x)
    assert all(found[k] > 30 for k in secrets.KINDS)


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sorted(tuple(r) for r in queries.QUERIES["op12_windowed_entropy_secrets"](spark, sf_dir).collect())
    assert got == sorted(slow_digest(d["doc_id"], d["text"]) for d in docs)
    assert any(r[5] for r in got)


def test_random_keys_found_and_ordinary_text_left_alone(spark):
    rng = random.Random(5)
    keys = ["".join(rng.choice(MIXED) for _ in range(40)) for _ in range(200)]
    ordinary = [
        "123e4567-e89b-12d3-a456-426614174000".upper(), "some/long/path-to-a/file_name-2024", "Donaudampfschifffahrtsgesellschaft",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghij", "=" * 60, "-" * 30, "12345678901234567890123", "your_api_key_goes_here_XYZ123abc",
        "antidisestablishmentarianism", "=-" * 4000, "a-" * 20_000 + "0X",
    ]
    spans = check(spark, frame(spark, [f"see {k} here" for k in keys] + ordinary))
    assert all(spans[i] == "entropy:4:44" for i in range(len(keys)))
    assert not any("entropy" in spans[len(keys) + i] for i in range(len(ordinary)))


def test_long_candidate_is_scanned_to_its_end(spark):
    rng = random.Random(6)
    tail = "".join(rng.choice(MIXED) for _ in range(30))
    spans = check(spark, frame(spark, ["aB" * 30_000 + tail, ("fade" * 5 + " ") * 3_000]))
    assert spans[0] == f"entropy:0:{60_030}" and len(spans[1].split(",")) == 3_000


@pytest.mark.parametrize("rows", [awkward, clashing, empty])
def test_awkward_rows(spark, rows):
    docs = rows(spark).withColumns({c: F.lit(3) for c in ("spans", "row", "kind", "at", "parts", "start", "end")})
    check(spark, docs)


def test_no_python_workers_in_the_plan(spark, sf_dir):
    df = queries.QUERIES["op12_windowed_entropy_secrets"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
