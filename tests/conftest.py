import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "scripts"))

from larkspur.plans.registry import Tables  # noqa: E402
from larkspur.session import local_session  # noqa: E402
from larkspur.workspace import release  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, FOLDER)


def plan_of(df) -> str:
    """The physical plan after adaptive execution has run it."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()
