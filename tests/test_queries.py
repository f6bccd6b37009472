"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, sql_frame
from weirflow.plans import catalog, oracle

QUERIES, ORACLE = catalog.queries(), oracle.statements()


#: What a forest predicts has no SQL meaning; tests/test_learning.py holds these to bounds.
WITHOUT_SQL = {"ml_predict", "ml_feature_importances", "ml_report", "rule_vs_model"}


def test_every_query_has_a_twin():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLE)


def test_entry(spark):
    rows = {r["alert_type"]: r["n"] for r in entry.entry(spark).collect()}
    assert len(rows) == 21 and rows["NORMAL"] == 690


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert difference(got, sql_frame(sf_dir, ORACLE[name])) is None
