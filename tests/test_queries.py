"""Every registered query on the driver tables: rows, oracle, plan shape."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools_check import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")

# Queries that fit for long; the unit tests cover them and ALL_QUERIES=1 adds them.
FITS = () if os.environ.get("ALL_QUERIES") else ("ml5", "ml6", "pip7_")
# Row-wise checks of one feature are covered by the full feature tables.
SINGLE = tuple(f"f{i:02d}_" for i in range(1, 26))
# Scalar rules and plain row operators have unit tests; ALL_QUERIES=1 adds them.
PLAIN = () if os.environ.get("ALL_QUERIES") else ("txt_", "prj", "flt", "src4", "top3", "smp1")
NAMES = [n for n in queries() if not n.startswith(PLAIN)] if PLAIN else list(queries())
NAMES = [n for n in NAMES if not n.startswith((*SINGLE, *FITS))]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    result, _ = check(spark, oracle, SF, name, queries()[name], oracle_sql().get(name))
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["entry_clean_features_by_condition", "pip1_clean_en_v1", "pip3_clean_fr_v1", "pip6_features_fr", "agg8_distribution_properties",
                                  "agg10_flag_outliers", "agg11_box_stats", "agg13_kde", "agg23_label_cooccurrence", "agg30_compare_sources", "agg31_feature_overlap",
                                  "txt1_tfidf", "txt4_near_duplicates", "tst1_ks_two_sample", "ev3_auc", "sv4_concordance", "sv5_kaplan_meier",
                                  "sum1_extractive_summary", "sum3_rouge_1"])
def test_no_nested_loop_join_and_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan, bad


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["agg11_box_stats"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan
    plan = queries()["jn2_keep_in"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "In(lang, [de,fr])" in plan or "In(lang, [fr,de])" in plan
