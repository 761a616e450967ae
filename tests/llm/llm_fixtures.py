"""The session of these tests, and tables of awkward rows."""

import pytest
from pyspark.sql import functions as F

from larkspur.llm.settings import prepared


@pytest.fixture(scope="session")
def ready(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def awkward(ready):
    """Nulls in every column, empty and blank texts, a very long text, equal rows, equal texts, and columns whose names the
    operators use themselves."""
    long = " ".join(f"w{i % 997} x{i}" for i in range(120_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.", "s", 5),
        (2, None, "s", None),
        (3, "", None, 1),
        (4, " \t\n ", "s", 1),
        (5, long, "t", 9),
        (6, long, "t", 9),
        (7, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.", None, 5),
        (7, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.", None, 5),
        (None, "a row without an id", "u", None),
        (8, "!!! ??? ...", "u", 2),
        (9, "éè 中文   x\u0000y", "u", 2),
    ]
    table = ready.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    return table.withColumns({"id": F.lit("clash"), "row": F.lit(1), "score": F.lit("x"), "key": F.lit(None).cast("int")})


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
