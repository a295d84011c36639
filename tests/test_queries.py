import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry_point
from check_queries import as_rows, connect

from pathkin.workload.queries import QUERIES as WORKLOAD

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()
QUERIES = {k: q for k, q in entry_point.queries().items() if k in ORACLES}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert ORACLES.keys() <= entry_point.queries().keys()
    assert WORKLOAD.keys() <= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert {c: got[c].dtype.kind for c in got} == {c: want[c].dtype.kind for c in got}
    assert len(got) > 0
    assert as_rows(got) == as_rows(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["score_gold", "score_gold_dups", "gold_unmatched"])
def test_gold_pairs_are_made_once(spark, name):
    """Gold pairs come from a join of order lines; the scoring reads them several times."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_triples_are_made_once(spark, monkeypatch):
    """Triples come from a join of order lines; mutual information reads them several times."""
    import pathkin as pk

    seen, real = [], pk.mutual_information
    monkeypatch.setattr(pk, "mutual_information", lambda t, **more: seen.append(t) or real(t, **more))
    QUERIES["path_totals"](spark, FOLDER)
    plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in seen]
    assert plans and not any("l_partkey" in plan for plan in plans)
