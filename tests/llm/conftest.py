import pytest

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix potions in old towers near cold rivers".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _row long, _mark string, spans string, _text string, _score string, fp string, id string, none string, row string, marks string"


def text(n, start=0):
    return " ".join(WORDS[(start * 7 + i * (start % 5 + 1)) % len(WORDS)] + ("" if i % 9 else ".") for i in range(n))


def rows():
    """Documents with nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash."""
    out = [
        (0, text(60)), (1, text(60)), (2, text(60) + " end"), (3, None), (4, ""), (4, ""), (5, " \n\t "), (6, "one"), (7, "two words"),
        (None, text(40, 3)), (None, None), (8, text(90, 8)), (8, text(90, 8)), (9, text(20_000, 2)), (10, "é😀ß 漢字 İ"), (11, "x" * 30_000), (100, text(80, 11)),
    ]
    out += [(20 + i, text(50 + i, 20 + i)) for i in range(30)]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src", None, 1, "m", "s", "t", "z", "f", "i", "n", "r", "k") for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("word_bpe_49k.json")
