"""Plan-shape checks: pruning and pushdown reach the scans, ordered entity features
share one exchange, snapshot reads prune year partitions."""
import re

from pyspark.sql import functions as F

from conftest import SF
from salesplane.operators import skew
from salesplane.plans.base import base
from salesplane.sources import files
from salesplane.sources.tpch import sales_from_tpch


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_scans_read_only_needed_columns(spark):
    plan = _plan(sales_from_tpch(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
    assert "o_totalprice" not in plan and "l_discount" not in plan and "p_retailprice" not in plan


def test_ordered_features_run_on_chunks(spark):
    plan = skew.sequence_features(base(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    windows = [w for w in plan.splitlines() if re.search(r"\bWindow \[", w)]
    framed = [w for w in windows if re.search(r"lag\(|avg\(|stddev|collect_list|regr_slope", w)]
    assert framed and all("_chunk" in w for w in framed)
    assert all("_chunk" in w or "_n#" in w or "row_number" in w for w in windows)


def test_snapshot_year_filter_prunes_partitions(spark, tmp_path):
    b = base(spark, SF).drop("secondary_platform")
    files.save_snapshot(b, str(tmp_path / "snap"))
    q = files.load_snapshot(spark, str(tmp_path / "snap")).where(F.col("year") == 2000).select("store_name")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2000" in plan
    assert re.search(r"ReadSchema: struct<store_name:string>", plan)
