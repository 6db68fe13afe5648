import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, found int, version string, n int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a long text, near and exact copies."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base, passage = prose(80), prose(60)
    near = base.split()
    near[10] = "changed"
    rows = [(0, base), (1, " ".join(near)), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, " \t\n"), (7, "one two"),
            (8, "ONE two"), (9, "wörd " + prose(30) + " ▁ 中文 🎉"), (10, prose(20) + " " + passage + " " + prose(25)),
            (11, prose(33) + " " + passage + " " + prose(9)), (12, prose(5000)), (13, "x" * 3000), (14, "ab " * 1000)]
    rows += [(20 + i, " ".join(w if rng.random() > 0.02 else "edit%d" % i for w in base.split())) for i in range(40)]
    rows += [(100 + i, prose(rng.randint(1, 120))) for i in range(60)]
    return rows


def frame(spark, rows):
    """Rows as documents, with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t), "x", 1, "y", 2) for i, t in rows], SCHEMA
    )


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="session")
def repeated(spark, odd_rows):
    """The same with rows that repeat, one id for two texts, and rows without an id."""
    return frame(spark, [*odd_rows, (0, odd_rows[0][1]), (0, odd_rows[0][1]), (7, "another text"), (None, odd_rows[0][1]), (None, None)])


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
