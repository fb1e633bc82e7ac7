import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    return SF


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, odd scripts, one very long text."""
    words = "the quick brown fox jumps over a lazy dog while seven wizards box with joy".split()
    long = " ".join(words[(i * 7 + i // 5) % len(words)] + str(i % 97) for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "same text here"), (5, "same  text\nhere"), (6, "sametexthere"),
        (7, "repeated row"), (7, "repeated row"), (8, "x"), (None, "no id"), (None, "no id"), (9, "é ü 字 😀 ｆｕｌｌ ▁ \x1c \x85"),
        (10, "a  b   c    "), (11, long), (12, long + " tail"), (13, "<s> </s> <|endoftext|> <unk> <0x41>"),
        (14, " leading and trailing "), (15, "\n\nlines\n\nlines\n"), (16, "q" * 20_000), (17, "it's we'll THEY'RE 123 4567 ..."),
    ]


@pytest.fixture()
def odd_docs(spark, odd_rows):
    """The rows with columns whose names clash with those that operators make."""
    return spark.createDataFrame(
        [(i, t, n, "k", 1.5, True) for n, (i, t) in enumerate(odd_rows)],
        "doc_id bigint, text string, size bigint, digest string, score double, kept boolean").repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, size bigint")
