"""Source extracts (rename by name, pushdown) and the streaming merge."""

import datetime as dt

from pyspark.sql import functions as F

from levyline import schemas
from levyline.operators.merge import merge
from levyline.operators.schema_ops import migrate_integral_to_string
from levyline.sources import fixtures
from levyline.sources.raw import extract, read_stored_extract
from levyline.sources.warehouse import Warehouse
from levyline.streaming.merge_stream import start_merge_stream
from tests.conftest import SF_SMALL


def _as_source(df, spec):
    return df.select(*[F.col(c).alias(spec.source_names.get(c, c)) for c in spec.column_names])


def test_extract_renames_by_name_and_pushes_slice_filter(spark, scratch):
    spec = schemas.BUS_TICKETING_TRANSACTION
    raw = fixtures.bus_ticketing_transaction(spark, SF_SMALL)
    # a stored extract in source names, columns in a different order
    src = _as_source(raw, spec)
    src.select(*reversed(src.columns)).write.parquet(f"{scratch}/bus")
    got = extract(read_stored_extract(spark, spec, f"{scratch}/bus"), spec)
    assert got.columns == spec.column_names
    assert got.exceptAll(raw).count() == 0 and raw.exceptAll(got).count() == 0
    sliced = extract(read_stored_extract(spark, spec, f"{scratch}/bus"), spec, since="2024-01-27 00:00:00")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "transDate" in plan and "GreaterThan" in plan  # pushed to the scan under the source name
    assert sliced.count() == raw.filter("trans_date > timestamp_ntz'2024-01-27 00:00:00'").count()


def test_rev_head_migration_only_when_integral(spark):
    old = spark.createDataFrame([(1, 10)], "id int, rev_head int")
    assert dict(migrate_integral_to_string(old, "rev_head").dtypes)["rev_head"] == "string"
    new = spark.createDataFrame([(1, "10")], "id int, rev_head string")
    assert migrate_integral_to_string(new, "rev_head") is new


def test_streaming_merge_equals_batch_merges(spark, scratch):
    spec = schemas.AGENT_TRANSACTIONS
    raw = fixtures.agent_transactions(spark, SF_SMALL).filter("trans_date is not null")
    first = raw.filter("trans_date <= timestamp_ntz'2024-01-28 00:00:00'").withColumn("status", F.lit("Processing"))
    second = raw.filter("trans_date > timestamp_ntz'2024-01-27 00:00:00'")
    wh = Warehouse(spark, f"{scratch}/wh")
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    first.write.parquet(f"{landing}/f1")
    # the stream reads files below the landing folder; each run takes the files that arrived since the last
    q = start_merge_stream(spark, wh, spec, f"{landing}/*", ckpt, fallback="2024-01-01 00:00:00")
    q.awaitTermination(300)
    second.write.parquet(f"{landing}/f2")
    q = start_merge_stream(spark, wh, spec, f"{landing}/*", ckpt, fallback="2024-01-01 00:00:00")
    q.awaitTermination(300)
    got = wh.read_table(spec)
    empty = spark.createDataFrame([], spec.schema)
    want = merge(merge(empty, first, spec), second, spec)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    ctl = wh.control().filter("table_name = 'agent_transactions'").collect()[0]
    assert ctl["last_loaded_at"] == raw.agg(F.max("trans_date")).collect()[0][0]
    assert ctl["rows_loaded"] == second.count()


def test_cli_daily_then_report(spark, scratch, capsys):
    import json

    from levyline.__main__ import main

    main(["daily", "--warehouse", f"{scratch}/wh", "--fixtures", SF_SMALL, "--as-of", "2024-02-03",
          "--fallback", "2024-01-01 00:00:00"])
    daily = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert daily["loads"]["agent_transactions"]["rows"] > 0 and set(daily["reports"]) == {"mda", "eticket", "bus", "agents"}
    main(["report", "--warehouse", f"{scratch}/wh", "--out", f"{scratch}/rep", "--as-of", "2024-02-03"])
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["window"] == ["2024-01-27", "2024-02-02"] and rep["rows"]["mda"] > 0
