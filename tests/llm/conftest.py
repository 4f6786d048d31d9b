"""Documents with every awkward case, as rows and as a table with extra columns of clashing names."""

import random

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 60)) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars); ids may be null or repeated, texts null, empty, very long or equal."""
    long = prose(1, 30_000)
    near = prose(2, 120)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "b"), (4, "one", "en", None), (5, "one", None, None),
        (6, near, "en", "a"), (7, near + " tail", "en", "b"), (8, near.upper(), "fr", "a"), (9, long, "en", "c"), (10, long, "en", "c"),
        (11, "x" * 50_000, "en", "a"), (12, "word " * 5_000, "en", "a"), (None, near, "en", "a"), (None, None, None, None),
        (13, "été ñandú 漢字   nbsp joined 😀", "fr", "b"), (14, "line\nline\nline\n\nother\n", "en", "b"),
        (6, near, "en", "a"), (15, "...!!! 123", "en", "a"), (16, "a\x00b <|endoftext|> </s> ▁ \x1f", "en", "a"),
    ]
    return [(i, t, l, s, len(t or "")) for i, t, l, s in rows]


SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def edges(spark):
    """The edge rows, in several partitions, with extra columns whose names the operators use themselves."""
    table = spark.createDataFrame(edge_rows(), SHAPE).repartition(3)
    names = ["size", "kept", "score", "secrets", "taken", "shard", "component_id", "start", "id", "group", "label", "lang_pred", "copies"]
    return table.withColumns({n: F.lit(f"own {n}") for n in names})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def values(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
