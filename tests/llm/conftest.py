import random

import pytest

BASE = ("ha re sti on the of an or ing ed er th and at est ou wh ti ble sh ly in").split()


@pytest.fixture(scope="session")
def prose():
    """Seeded invented prose: ``prose(seed, n)`` has n words."""
    def make(seed, n):
        draw = random.Random(seed)
        return " ".join("".join(draw.choices(BASE, k=draw.choice((1, 1, 2, 3)))) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like inner ones."""
    rows = [(1, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, " \t\n "), (6, "one"),
            (None, prose(2, 90)), (None, prose(2, 90)), (7, prose(3, 120)), (7, prose(3, 120)),
            (7, prose(4, 60)), (8, prose(5, 30_000)), (9, "x" * 5000), (10, "naïve ▁ text  end \\n\\\n")]
    full = [(i, t, ["en", None][k % 2], ["a", "b", None][k % 3], k, k, "s", 0) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, "
                                       "id int, tie int, size string, n int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
