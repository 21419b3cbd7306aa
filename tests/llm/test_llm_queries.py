import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from apronflow.llm import queries  # noqa: E402
from oracle import connect, differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    extra, missing = differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name].strip())
    assert not extra and not missing
