import random

import pytest

# Extra columns named like those the operators add.
NAMES = "score shard slot n_words row_key kept spans rank id _tag _id _t _row_key _kept tag key_id row start width place hashes a.b x0 m0".split()
CLASHING = ", ".join(f"`{n}` string" for n in NAMES)
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
WORDS = [f"w{i:02d}" for i in range(60)]


def sentence(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


def edge_texts():
    """(doc_id, text): nulls, empty and blank texts, a very long text, copies, near copies, repeated rows and ids."""
    base = sentence(1, 120)
    long = sentence(2, 4_000)
    rows = [
        (1, base),
        (2, base),
        (3, base + " tail"),
        (4, ""),
        (5, None),
        (6, " \t\n\x0b "),
        (7, "one"),
        (8, "One two three ÉCOLE É"),
        (9, long),
        (10, "a " * 300),
        (11, sentence(3, 50) + "\n" + sentence(4, 40) + "\n" + sentence(3, 50)),
        (12, sentence(5, 30) + " " + sentence(1, 120) + " " + sentence(6, 30)),
        (13, sentence(7, 19)),
        (14, sentence(7, 20)),
        (15, "x" * 5000),
        (15, "x" * 5000),
        (16, "same id, first"),
        (16, sentence(8, 40)),
        (None, sentence(8, 40)),
        (None, None),
        (-9, sentence(9, 25) + " " + sentence(3, 50)),
        (17, "<|endoftext|> " + sentence(10, 12)),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_names():
    return NAMES


@pytest.fixture(scope="session")
def edge_rows():
    return edge_texts()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    data = [(i, t, None if n % 3 else "en", None, None if n % 2 else 7, *[f"its {c}" for c in NAMES]) for n, (i, t) in enumerate(edge_rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(1, 15)] + [(3, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
