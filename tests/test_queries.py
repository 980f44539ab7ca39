import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from compare import compare  # noqa: E402

from fluxmill.plans.oracles import ORACLES  # noqa: E402
from fluxmill.plans.queries import REGISTRY  # noqa: E402

ROWS_ONLY = {"run_metrics", "stream_progress"}


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(REGISTRY) - set(ORACLES) == ROWS_ONLY
    assert set(REGISTRY) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, small, name):
    good, text = compare(spark, small, name, driver.queries()[name], driver.oracle_sql().get(name))
    assert good, text


def test_entry(spark, small):
    table = driver.entry(spark)
    assert len(table.columns) == 30 and table.count() == 1500
