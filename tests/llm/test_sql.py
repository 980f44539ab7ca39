"""Queries beside their SQL on DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import compare  # noqa: E402

from fluxmill.llm.oracles import ORACLES  # noqa: E402
from fluxmill.llm.queries import REGISTRY  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    good, text = compare(spark, small, name, REGISTRY[name], ORACLES[name])
    assert good, text
