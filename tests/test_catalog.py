"""Every catalogued query with an SQL twin gives the same result on the smallest tables."""
import pytest

from compare import compare, duck
from tabulon.catalog import ENTRIES

WITH_SQL = sorted(n for n, (_, sql) in ENTRIES.items() if sql)
# Fits are tested on purpose-made frames in test_learning; a few of their queries run here.
ROWS_ONLY = ["bidirectional_selection", "lasso_selection", "lasso_cross_validated", "pca_loadings", "pca_full_run",
             "preprocessing_run", "decision_tree"]


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, con, folder, name):
    fn, sql = ENTRIES[name]
    ok, note = compare(spark, con, folder, fn, sql)
    assert ok, note


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, folder, name):
    assert ENTRIES[name][0](spark, folder).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
