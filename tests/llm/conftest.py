import random

import pytest

#: columns of the given table, and extra ones named like the operators' own
DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, key string, row string, "
        "size bigint, spans string, root bigint, rep bigint, shard int, gone bigint, runs string, start int, k_all int")


def _prose(g, n):
    return " ".join("".join(g.choice("abcdefgh") for _ in range(g.randint(2, 8))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    g = random.Random(17)
    base = [_prose(g, n) for n in (60, 80, 120, 200)]
    texts = base + [base[0], base[1] + " extra", base[2].replace(" ", "\n"), "", " \t\n", None, "one two three", "x",
                    " ".join(_prose(g, 500) for _ in range(40)), "word " * 3000, "9" * 20000, "é" * 5000, base[3] + "\n" + base[0]]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base[0], None, None), (None, None, None, None), (3, base[1], "en", "a")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame([(*r, None, 1, "k", "r", 2, "s", 3, 4, 5, 6, "u", 7, 8) for r in messy_rows], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
