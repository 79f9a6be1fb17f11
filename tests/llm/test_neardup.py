import random

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from citylake.llm import neardup
from citylake.llm.neardup import near_duplicates, shingles
from tests.llm.helpers import awkward, clashing, empty


def slow_set(text):
    words = (text or "").lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def slow_groups(texts):
    """Smallest index reachable over pairs of similarity >= 0.8; texts without a word are alike."""
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a & b and 5 * len(a & b) >= 4 * len(a | b)):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def edited_copies():
    """Families of a text and copies with one to six changed words, chains among them."""
    rng, rows = random.Random(7), []
    for family in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 400))]
        base = words
        rows.append(" ".join(words))
        for _ in range(4):
            words = list(words if family % 2 else base)
            for _ in range(rng.randrange(1, 7)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    return rows


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_planted_edited_copies(spark, sf_dir):
    texts = edited_copies()
    want = slow_groups(texts)
    found = near_duplicates(frame(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(want))
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, texts), sf_dir).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want)) and len(set(want)) < len(texts) // 2


def test_given_table_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    roots = slow_groups([d["text"] for d in docs])
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert out == {d["doc_id"]: docs[r]["doc_id"] for d, r in zip(docs, roots)}


def variants(n, words, changed, seed=3):
    """Texts of `words` words that differ from one of them in `changed` random words each."""
    rng = random.Random(seed)
    base, out = [f"w{k}" for k in range(words)], []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(words), changed):
            text[at] = f"x{i}_{at}"
        out.append(" ".join(text))
    return out


@pytest.fixture
def pairs_met(monkeypatch):
    """Counts the candidate pairs that are compared."""
    seen, compare = [], neardup.similar

    def counted(pairs, sets):
        seen.append(pairs.count())
        return compare(pairs, sets)

    monkeypatch.setattr(neardup, "similar", counted)
    return seen


@pytest.mark.parametrize("words, changed", [(30, 1), (60, 4)])
def test_many_texts_that_are_only_near(spark, pairs_met, words, changed):
    for n in (400, 2000):
        texts = variants(n, words, changed)
        pairs_met.clear()
        found = near_duplicates(frame(spark, texts)).collect()
        assert sum(pairs_met) < 40 * n  # 28 heads in the first round; all pairs would be n * n / 2
        if n == 400:
            assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(slow_groups(texts)))


def test_many_similar_texts_are_one_group(spark, pairs_met):
    found = near_duplicates(frame(spark, variants(2000, 300, 3))).collect()
    assert {r["component_id"] for r in found} == {0} and sum(pairs_met) < 40 * 2000


def test_prefix_rounds_alone_find_every_group(spark):
    texts = edited_copies() + variants(60, 40, 1)
    sets = [shingles(t) for t in texts]
    frame_of = [(i, len(s), s.view("int64").tolist()) for i, s in enumerate(sets)]
    rows = spark.createDataFrame(frame_of, "node long, n long, found array<long>")
    roots = spark.createDataFrame([], "node long, root long")
    out = neardup.joined_by_prefixes(rows.select("node", "n"), rows.select("node", "found"), roots)
    got = list(range(len(texts)))
    for r in out.collect():
        got[r["node"]] = r["root"]
    assert got == slow_groups(texts)


def slow_fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(" ".join(s), 42) for s in slow_set(text)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_alone_joins_all_similar_texts_within_its_radius(spark):
    """With no keys of minima, what remains are the covering masks and the check of the links."""
    rng = random.Random(11)
    texts = edited_copies()[:20] + [f"w{k} w{k + 1}" for k in range(40)] + ["", "tail"]
    for words in (500, 900, 1400):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        texts += [" ".join(base)] + [" ".join([*base, f"tail{k}"]) for k in range(5)]
        for k in range(12):
            base[rng.randrange(words)] = f"y{k}"
            texts.append(" ".join(base))
    docs = frame(spark, texts)
    found = neardup.prints(docs, "doc_id", "text").withColumn("keys", F.array().cast("array<long>"))
    nodes = found.select("node", "n", "fp", "keys", F.struct("row", "doc_id").alias("at"))
    ids = {r["node"]: r["doc_id"] for r in found.collect()}
    assert len(ids) == len(texts) and {r["doc_id"]: r["fp"] % (1 << 64) for r in found.collect()} == dict(enumerate(map(slow_fingerprint, texts)))

    roots, want = list(range(len(texts))), list(range(len(texts)))
    fps, sets = [slow_fingerprint(t) for t in texts], [slow_set(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and a and 5 * len(a & b) >= 4 * len(a | b):
                x, y = want[i], want[j]
                want = [min(x, y) if r in (x, y) else r for r in want]
    for r in neardup.roots_of(docs, nodes, "doc_id", "text").collect():
        roots[ids[r["node"]]] = ids[r["root"]]
    groups = lambda of: {frozenset(i for i, r in enumerate(of) if r == x) for x in of}
    assert groups(roots) == groups(want) and len(set(want)) <= len(texts) - 20


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, rows):
    docs = rows(spark).collect()
    roots = slow_groups([r["text"] for r in docs])
    assert len({r["root"] for r in near_duplicates(rows(spark)).collect()}) == len(set(roots))


def test_shingles_of_short_and_empty_texts():
    assert len(shingles(None)) == len(shingles(" \n")) == 0 and len(shingles("A b")) == 1
    assert shingles("a  B").tolist() == shingles("A\nb").tolist() and len(shingles("a b c d e f f")) == 3


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []
