"""Every registered query against its SQL, on the smallest tables."""

import pytest

import suite
from suite.compare import differences, duck

suite.load_all()
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(suite.CASES))
def test_same_as_sql(spark, con, name):
    diff, rows = differences(spark, con, name, SF_DIR)
    assert diff is None
    assert rows > 0 or name in {"build_finished_info", "page_links_filtered", "topic_skipped"}


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["user_t_id", "rank", "t_id", "score"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for name in suite.CASES}
    assert own <= set(entry.oracle_sql())
