"""The stores that a stateful stream has, and keys that are null or look like the row that ends it."""

import duckdb
import pytest

from ledgerline.plans import flows
from ledgerline.plans.queries import ORACLE_SQL
from ledgerline.streaming import stateful


@pytest.mark.parametrize("query", ["stream_sessions_and_late", "stream_counters_and_late"])
def test_no_more_stores_than_groups(spark, tmp_path, monkeypatch, query):
    """Each partition's store is loaded and committed in every batch, so those that no group can be in are a cost that grows with the number of partitions alone."""
    events = spark.range(400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-14 12:00:00' + make_dt_interval(0, 0, cast(id * 41 % 400 * 4 as int)) as ts", "if(id % 9 = 4, null, id % 7 - 1) as user_id",
        "if(id % 9 = 4, null, if(id % 2 = 0, 'end', 'view')) as event_type", "cast(id as double) as value",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(stateful, "GROUPS", 3)
    monkeypatch.setattr(flows, "fresh_path", lambda spark, kind: str(tmp_path / kind))
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "11")
    try:
        found = sorted(map(str, map(tuple, getattr(flows, query)(spark, str(tmp_path)).collect())))
        assert spark.conf.get(name) == "11"
    finally:
        spark.conf.set(name, before)
    assert sorted(p.name for p in (tmp_path / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()) == ["0", "1", "2"]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        expected = sorted(map(str, db.execute(ORACLE_SQL[query]).fetchall()))
    assert found == expected and any("late" in row for row in found)
    if query == "stream_sessions_and_late":
        assert len(found) < 300  # most sessions have several events
