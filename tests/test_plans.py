"""Physical-plan properties: no Python in any registered query, pre-aggregation below the agent join,
partition pruning of the stored marts, the broadcast merge never shuffling the whole target."""

import datetime as dt
from decimal import Decimal

import pytest

from levyline.catalog import QUERIES
from levyline import schemas
from levyline.operators.merge import merge
from levyline.plans import reports
from levyline.plans.models import RevenueModels, register_views
from levyline.sources import fixtures
from tests.conftest import SF_SMALL
from tests.helpers import make


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("report_csv")])
def test_no_python_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_agent_join_sees_pre_aggregated_enumerations(spark):
    m = RevenueModels(fixtures.raw_tables(spark, SF_SMALL))
    opt = m.fct_agent_enumeration._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.index("Join LeftOuter")
    assert "Aggregate" in opt[join_at:], "enumerations must be aggregated below the join"


def test_report_prunes_day_partitions(spark, scratch):
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, d), "M", 1, Decimal("1.00")) for d in range(1, 31)],
        "payment_day date, mda string, transaction_count bigint, total_amount decimal(29,2)")
    daily.write.partitionBy("payment_day").parquet(f"{scratch}/agg")
    stored = spark.read.parquet(f"{scratch}/agg")
    rep = reports.report_mda(stored, "2024-01-20", "2024-01-26")
    plan = _plan(rep)
    assert "PartitionFilters" in plan and "payment_day" in plan
    assert rep.collect()[0]["transaction_count"] == 7


def test_small_slice_merge_does_not_shuffle_target_rows(spark):
    spec = schemas.AGENT_TRANSACTIONS
    tgt = fixtures.agent_transactions(spark, SF_SMALL)
    sl = make(spark, spec, [{"idagent_transactions": 1, "status": "Completed"}])
    plan = _plan(merge(tgt, sl, spec, dedupe_slice=False, small_slice=True))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_register_views(spark):
    m = RevenueModels(fixtures.raw_tables(spark, SF_SMALL))
    names = register_views(spark, m, ["stg_rev_sub_newcode", "agg_revenue_daily"])
    assert spark.sql("SELECT count(*) FROM stg_rev_sub_newcode").collect()[0][0] == 25
    assert set(names) <= {t.name for t in spark.catalog.listTables()}


def test_footers_answer_counts_and_ranges(spark, scratch):
    from pyspark.sql import functions as F

    from levyline.operators import profile

    spark.range(1000).select("id", F.repeat(F.lit("x"), 50).alias("s")).repartition(3).write.parquet(f"{scratch}/t")
    df = profile.footer_profile(spark, [f"{scratch}/t"], "t", "id")
    assert [tuple(r) for r in df.collect()] == [("t", 1000, 2, 0, 999)]
    plan = _plan(df)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left as it is
