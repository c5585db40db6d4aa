"""Small tables with the awkward rows that every operator must take: nulls, empty, long, tied and repeated ones."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, print string"


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and to in lo mar tin sel ver dan pol kri".split()) + rng.choice(["", "a", "o", "en"])
                    + str(rng.randrange(50)) for _ in range(n))


def texts() -> list:
    base = sentence(1, 80)
    near = base.split()
    near[40] = "changed"
    return [
        base, base, " ".join(near), base.upper(), sentence(2, 30) + " " + base, None, "", "   \n\t ", "one", "one two three",
        "one two three", sentence(3, 9), "é ü 日本語 😀 " * 12, "word " * 4000, "ab" * 3000, sentence(4, 3000),
        "x\ny\nx\n\nx", sentence(5, 60) + "\n" + sentence(5, 60), "# $ % & | < > *" * 20, "it's <|endoftext|> a\x1cb ▁ c",
        " ".join(f"w{i}" for i in range(13)), " ".join(f"w{i}" for i in range(14)), " ".join(f"w{i}" for i in range(9)),
    ]


@pytest.fixture(scope="session")
def rows():
    found = [(i, t, "en", ["a", "b", None][i % 3], None if t is None else len(t), 7, "x") for i, t in enumerate(texts())]
    # a repeated row, the same id with another text, and rows without id or source
    return [*found, found[0], (3, "another text under a known id", "en", "a", 29, 7, "x"), (None, found[0][1], None, "a", 1, 7, "x"),
            (None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
