import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; a table may have them as columns of its own.
CLASHING = ["_row", "_key", "_id", "node", "size", "u", "q", "copies", "score", "trusted", "first_id", "nth", "hash", "a.b"]


def prose(seed: int, words: int, stem: str = "") -> str:
    """Made-up words, fixed by the seed."""
    out, state = [], seed * 2654435761 % 2**32 or 1
    for _ in range(words):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(stem + "".join(chr(97 + (state >> s) % 20) for s in (4, 9, 14, 19)[: 2 + state % 3]))
    return " ".join(out)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) rows; ``clashing`` adds columns named like internal ones."""

    def build(rows, clashing=False):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(7).alias(name) for name in CLASHING])
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, one long text, other scripts."""
    long = "\n".join(prose(i, 40) for i in range(300))
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n\x0b ", "en", "a"),
        (None, "the null row", None, "a"),
        (None, "the null row", None, "a"),
        (None, None, None, None),
        (4, "one", "en", None),
        (5, "repeated row with some more words in it", "en", "b"),
        (5, "repeated row with some more words in it", "en", "b"),
        (5, "same id but another text than the other", "fr", "b"),
        (6, long, "en", "c"),
        (7, long, "en", "c"),
        (8, "Ünïcödé 中文 текст 😀 \x00 end", "de", "c"),
        (9, "1234 5678 !!! ???", "de", "c"),
    ]


@pytest.fixture(scope="session")
def labels_of(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
