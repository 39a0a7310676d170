from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators import calendar as C
from tidegauge.operators import catalog as K
from tidegauge.sources import scans as S
from tidegauge.sources import tables
from tidegauge.streaming import candles as X

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stream(spark, tmp_path):
    events = tables.table(spark, SF, "events")
    events.write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))


def closed(df):
    return {tuple(r) for r in df.collect()}


def test_stream_equals_batch(spark, stream, tmp_path):
    """Everything is the same but the windows that the watermark hasn't passed."""
    batch = closed(X.tumbling_candles(X.ticks(tables.table(spark, SF, "events"), None)))
    X.run_once(X.tumbling_candles(X.ticks(stream)), "candles", str(tmp_path / "c"))
    got = closed(spark.table("candles"))
    assert got <= batch and len(got) > 0.95 * len(batch)


def test_deduplication_within_the_watermark(spark, stream, tmp_path):
    t = X.ticks(stream, "60 days")
    X.run_once(X.deduplicated(t.union(t)).select("ts_id", "event_id"), "once", str(tmp_path / "c"))
    assert spark.table("once").count() == tables.table(spark, SF, "events").count()


def test_state_of_properties(spark, stream, tmp_path):
    X.run_once(X.running_properties(X.ticks(stream)), "props", str(tmp_path / "c"), "update")
    want = {r.ts_id: r.n for r in X.ticks(tables.table(spark, SF, "events"), None).groupBy("ts_id").agg(F.count("*").alias("n")).collect()}
    assert {r.ts_id: r.n for r in spark.table("props").groupBy("ts_id").agg(F.max("n").alias("n")).collect()} == want


def test_upsert_is_idempotent(spark, stream, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "ck"))
    path, batch = str(tmp_path / "out"), X.tumbling_candles(X.ticks(tables.table(spark, SF, "events"), None))
    write = X.upsert_to(path)
    write(batch, 0)
    write(batch.where("ts_id = 'crypto_view_1h'"), 1)
    write(batch.limit(0), 2)
    assert closed(S.read_candles(spark, path).select(*batch.columns)) == closed(batch)


def test_sink_prunes_months(spark, tmp_path):
    c = tables.candles_ord(spark, SF)
    S.write_candles(c, str(tmp_path / "c"))
    df = S.read_candles(spark, str(tmp_path / "c"), datetime(1997, 3, 1), datetime(1997, 4, 1))
    assert closed(df.select(*c.columns)) == closed(S.time_range(c, datetime(1997, 3, 1), datetime(1997, 4, 1)))
    assert "ym" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_landing_zone_and_known_lacks(spark, tmp_path):
    (tmp_path / "k.json").write_text('[1704067200000,"1.5","2","1","1.7","10",1704070799999,"15",7,"5","7","0"]\nnot json\n[1704070800000,"x","2","1","1.7","10",1704074399999,"15",7,"5","7","0"]\n')
    got = S.landing_json(spark, str(tmp_path / "k.json"), "crypto_btc_1h", "api").orderBy("open_time").collect()
    assert [(r.open_time, r.open, r.number_of_trades) for r in got] == [(datetime(2024, 1, 1), 1.5, 7), (datetime(2024, 1, 1, 1), None, 7)]
    assert S.known_lacks(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "l.csv").write_text("month_where_lacks,ts_id,rows_amount,data_created\n2024-01-01 00:00:00,a_1d,30,x\n")
    assert S.known_lacks(spark, str(tmp_path / "l.csv")).first().rows_amount == 30


def test_filled_grid_is_whole_and_keeps_known_points(spark):
    c = tables.candles_evt(spark, SF)
    new = C.gap_fill(c, "1h")
    both = new.select("ts_id", "open_time", "close").union(c.select("ts_id", "open_time", "close"))
    assert C.continuity(both).where("difference > 0").count() == 0
    assert new.join(c, ["ts_id", "open_time"]).count() == 0 and new.where("close IS NULL").count() == 0


def schema(**columns):
    return T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in columns.items()))


def test_schema_changes_go_up_and_down(spark, tmp_path):
    old = {"raw": schema(ts_id="string", open="double", n="int"), "dim": schema(a="boolean")}
    new = {"raw": schema(ts_id="string", open="string", n="bigint", x="array<int>"), "more": schema(b="date")}
    changes = K.compare(old, new)
    assert {(c.kind, c.table, c.column) for c in changes} == {("modify", "raw", "open"), ("add", "raw", "x"), ("add", "more", "b"), ("drop", "dim", "a")}
    up = K.apply(old, changes)
    assert not K.compare({k: v for k, v in up.items() if len(v)}, new)
    down = K.apply(up, [c.undo() for c in changes[::-1]])
    assert not K.compare({k: v for k, v in down.items() if len(v)}, old)
    with pytest.raises(ValueError):
        K.apply(old, changes + changes)
    assert "PARTITIONED BY (ym)" in K.ddl("t", old["raw"], ["ym"])
    r = K.Registry(spark, str(tmp_path / "reg"))
    assert r.version() == 0 and r.migrate(changes, datetime(2024, 1, 1), dry_run=True) and r.version() == 0
    r.migrate(changes, datetime(2024, 1, 1))
    r.migrate(changes[:1], datetime(2024, 1, 2))
    assert r.version() == 2
    assert r.rollback(datetime(2024, 1, 3)) == [changes[0].undo()] and r.version() == 1


def test_folds_have_no_leak(spark):
    c = tables.candles_ord(spark, SF).select("ts_id", "open_time")
    f = K.folds(c, 3).groupBy("ts_id", "fold").agg(F.max(F.when(F.col("role") == "train", F.col("open_time"))).alias("a"), F.min(F.when(F.col("role") == "test", F.col("open_time"))).alias("b"))
    assert f.where("a >= b").count() == 0 and f.count() == 15
