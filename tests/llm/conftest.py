import random

import pytest

WORDS = ("the of and stone river green light house walk never over under quick brown table seven "
         "paper cloud train north small great winter summer bread water glass open close").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice([",", ".", ".\n", ""]) if r.random() < 0.2 else "") for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows, a null id, odd characters."""
    shared = prose(99, 60)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "a"), (5, prose(5, 30_000)), (6, "x" * 30_000 + "  y"), (None, prose(8, 80)),
            (9, prose(9, 50)), (9, prose(9, 50)), (10, prose(10, 50)), (11, prose(10, 50)), (12, "ÉCOLE Straße, naïve mot  é"),
            (13, "don't <|endoftext|> it's THE <|ENDOFTEXT|>"), (14, "\x01 a \x00b\x1c c"), (15, "文字 テスト。 123 45!!"),
            (16, f"{prose(16, 20)} {shared} {prose(17, 40)}"), (17, f"{shared} {prose(18, 10)}"), (18, "word " * 100),
            (19, "12 34 !!"), (20, None)]
    return rows + [(100 + k, prose(200 + k, 40 + 13 * k)) for k in range(30)]


@pytest.fixture
def edge_docs(spark, edge_rows):
    """The rows with columns whose names the operators use inside."""
    extra = [(d, t, "en", "s", 1, 2, "x", None) for d, t in edge_rows]
    schema = "doc_id long, text string, lang string, source string, block int, bucket int, fp string, ids binary"
    return spark.createDataFrame(extra, schema).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
