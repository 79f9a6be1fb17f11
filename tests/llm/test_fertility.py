import math
import random
import re
import string
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from citylake.llm.fertility import VOCABULARY, band_of, fertility_rules, main_script
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))


def slow(model, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    tokens = [t for w in words for t in model.encode(w)]
    kept = not failed
    if tokens:
        chars, share = sum(map(len, words)) / len(tokens), sum(map(model.is_byte, tokens)) / len(tokens)
        entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in Counter(tokens).values())
        band = band_of(text, main_script(text))
        kept = kept and band.least_chars <= chars <= band.most_chars
        kept = kept and share <= band.most_bytes and entropy >= band.least_entropy
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    dup = len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed, kept, len(tokens)


NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_tokens".split()


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, model, rows):
    out = [(r["doc_id"], *[r[n] for n in NAMES]) for r in fertility_rules(rows(spark)).collect()]
    want = [(r[0], *slow(model, r[1])) for r in awkward_rows()]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_scripts():
    cases = {"abc": "latin", "été": "latin", "Привет x": "cyrillic", "日本": "han", "12 !": "other", "": "other"}
    assert {t: main_script(t) for t in cases} == cases


ENGLISH = """the tower was built by hand over many years and it stands above old harbour where ships from distant countries used
to unload their goods before railway came valley changed way that people lived worked in town every morning small boat leaves for island""".split()


def made_of(rng, pool, low, high, n=200):
    return " ".join("".join(rng.choice(pool) for _ in range(rng.randint(low, high))) for _ in range(n))


GIBBERISH = {
    "letters": (string.ascii_lowercase, 3, 8), "capitals": (string.ascii_uppercase, 3, 8), "mixed": (string.ascii_letters, 3, 8),
    "digits": (string.digits, 7, 7), "numbers": (string.digits, 1, 3), "symbols": ("#$%&*@!^~+=", 3, 8),
    "base64": (string.ascii_letters + string.digits + "+/", 20, 60), "hex": ("0123456789abcdef", 16, 32),
    "emoji": ([chr(0x1F300 + i) for i in range(600)], 9, 9),
}


def test_bands_reject_gibberish_and_keep_text(spark):
    rng = random.Random(2)
    plain = " ".join(rng.choice(ENGLISH) for _ in range(200))
    foreign = {"greek": "Ο ήλιος ανατέλλει πάνω από το λιμάνι και τα πλοία φεύγουν", "russian": "Солнце встаёт над гаванью и корабли уходят в море",
               "georgian": "მზე ამოდის ნავსადგურის თავზე და გემები მიდიან ზღვაში"}
    rows = [("plain", plain)] + [(k, " ".join(f"{w}{i % 7}" if i % 9 == 0 else w for i, w in enumerate((t + " ").split() * 12))) for k, t in foreign.items()]
    rows += [(kind, made_of(rng, *shape)) for kind, shape in GIBBERISH.items() for _ in range(20)]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in fertility_rules(docs).collect()}
    kept = Counter(kind for i, (kind, _) in enumerate(rows) if found[i]["kept"])
    assert kept["plain"] == 1 and not any(found[i]["base_failed"] for i, (kind, _) in enumerate(rows) if kind in GIBBERISH)
    assert not any(kept[kind] for kind in GIBBERISH)
    assert all(band_of(t, main_script(t)) is not None and main_script(t) != "latin" for t in foreign.values())


def test_bands_keep_the_given_prose(spark, sf_dir):
    out = fertility_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert all(r["kept"] for r in out if not r["base_failed"]) and sum(r["kept"] for r in out) > len(out) / 2


def test_empty_table(spark):
    assert fertility_rules(empty(spark)).collect() == []


def test_query_against_brute_force(spark, model, sf_dir):
    from citylake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    out = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op8_tokeniser_fertility"](spark, sf_dir).collect()}
    assert out == {d["doc_id"]: slow(model, d["text"]) for d in docs}
