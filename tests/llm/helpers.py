"""Small tables with the awkward cases that every corpus operator must survive."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} the" for i in range(40_000))
WORDS = "the quick brown fox jumps over the lazy dog while seven wizards watch from a hill".split()


def sentence(seed: int, n: int = 60) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed + i) % 13) for i in range(n))


def awkward_rows():
    near = sentence(5)
    return [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "a", 4),
        (4, LONG, "en", "a", len(LONG)),
        (5, near, "en", "a", 1),
        (6, near, "en", "b", 1),
        (6, near, "en", "b", 1),
        (7, near + " tail", "fr", "b", 1),
        (None, near, "en", "b", 1),
        (None, None, None, None, None),
        (8, "one\ntwo\nthree\nfour\none\ntwo\nthree", "de", "c", 1),
        (8, "another text of the same id", "de", "c", 1),
        (9, "日本語のテキスト <|endoftext|> ÀÉ ß ﬁ \U0001f600", "ja", "c", 1),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def clashing(spark):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = "fp root node least key n part id score lang_pred held_out n_tokens ids h1 h2 pos first rate domain copies"
    return awkward(spark).select("*", *[F.lit(7).alias(name) for name in names.split()])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
