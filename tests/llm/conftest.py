import public_tokenizers
import pytest

CLASHING = ["block", "shard", "slot", "node", "rank", "base", "spans", "bucket", "at", "guest", "host", "job", "unit", "known", "cluster",
            "component", "score", "accepted", "held_out", "item", "length", "piece", "start", "n", "rep", "a", "b", "count"]


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows, clashing=True):
    """documents from (doc_id, text, lang) with the other columns, and columns whose names operators may use inside."""
    df = spark.createDataFrame(
        [(i, t, g, "src0", None if t is None else len(t)) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING]) if clashing else df


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows, clashing=True: frame(spark, rows, clashing)


@pytest.fixture(scope="session")
def messy_rows():
    words = " ".join(f"word{i % 701}x{i}" for i in range(60_000))
    return [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one", "fr"), (5, "one", "fr"), (5, "one", "fr"), (None, "one", "de"),
        (None, None, None), (6, words, "en"), (7, words + " tail", "en"), (8, "été çà " * 40, "fr"), (9, "ÉTÉ 日本語 \U0001f600 " * 30, None),
        (10, "12345 67 !!", "en"), (-3, "one two three four five six seven", "en"), (2**40, "one two three four five six seven", "en"),
        (11, "\x00\x1f\x85  x", "de"),
    ]


@pytest.fixture(scope="session")
def messy(make, messy_rows):
    return make(messy_rows)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
