"""Registered queries against their SQL, on rows where the two could part."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkloom.plans import registry


def rows_of(spark, tables, name):
    """The query's rows and its SQL's, with the SQL's order of columns."""
    con = duckdb.connect()
    for path in tables.iterdir():
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}/*.parquet')")
    sql = con.execute(registry.ORACLES[name])
    names = [c[0] for c in sql.description]
    return sorted(map(tuple, registry.QUERIES[name](spark, str(tables)).select(*names).collect()), key=str), sorted(sql.fetchall(), key=str)


def lease_events(spark):
    """Leases and submissions whose seconds, cut or rounded, fall on both sides of a lease's end; halves go to the even second."""
    rows, at = [], 1_704_067_200_000_000
    for user, (a, b) in enumerate([(400_000, 900_600_000), (600_000, 900_400_000), (500_000, 900_500_000), (1_500_000, 902_500_000), (1_500_000, 901_500_000), (999_999, 901_499_999), (0, 900_000_000), (-600_000, 899_600_000)]):
        for kind, id, then in (("click", 0, a), ("purchase", 1, b), ("view", 2, b + 900_100_000)):
            rows.append((3 * user + id, at + then, user, kind, 1.5, "{}"))
    df = spark.createDataFrame(rows, "event_id long, us long, user_id long, event_type string, value double, props string")
    return df.select("event_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


@pytest.mark.parametrize("name", ["lease_expiry_fold", "lease_snapshots", "lease_state_machine", "lease_stream"])
def test_leases_by_rounded_seconds(spark, tmp_path, name):
    lease_events(spark).write.parquet(str(tmp_path / "events.parquet"))
    got, wanted = rows_of(spark, tmp_path, name)
    assert got == wanted and len(got) == 8


@pytest.mark.parametrize("name", ["lease_snapshots", "lease_state_machine", "lease_stream"])
def test_leases_of_repeated_events(spark, tmp_path, name):
    """Each event stands there three times: a receipt is counted once."""
    rows = lease_events(spark)
    rows.unionByName(rows).unionByName(rows).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got, wanted = rows_of(spark, tmp_path, name)
    assert got == wanted and len(got) == 8


@pytest.mark.parametrize("name", ["lease_snapshots", "lease_state_machine", "lease_stream"])
def test_leases_by_tokens_of_both_zeros(spark, tmp_path, name):
    value = F.when(F.col("event_type") == "click", F.lit(0.0)).otherwise(F.lit(-0.0))
    lease_events(spark).withColumn("value", value).write.parquet(str(tmp_path / "events.parquet"))
    got, wanted = rows_of(spark, tmp_path, name)
    assert got == wanted and len(got) == 8
