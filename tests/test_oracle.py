"""Every registered query against its DuckDB oracle text on the small driver tables; queries
without an oracle must run and return their declared columns and rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from scorekit.plans import catalog
from tools.oracle_check import TABLES, digest

from .conftest import SF_SMALL

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()
# scores of seeded models: contract_* queries fit the same models and check them by SQL
BY_CONTRACT = {"oof_gbt", "oof_forest", "oof_extra_trees", "oof_tree", "oof_logistic", "oof_linear_svc", "oof_perceptron", "adaboost_scores",
               "test_mean_scores", "fold_summary", "random_search", "grid_search", "repeat_cross_fit", "seed_bag", "stacked", "stack_cv",
               "importance_top", "prune_least_important"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1 and len(df.columns) > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, sdf.columns)[0] == digest(orows, ocols)[0]


def test_contracts_cover_what_is_not_run():
    assert BY_CONTRACT <= set(QUERIES) and {f"contract_{m}" for m in ("gbt", "forest", "logistic", "search", "seeds", "importance")} <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - BY_CONTRACT))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns == [c for c, _ in catalog.REGISTRY[name].schema]
    assert df.count() > 0
