"""The ten metric families over events."""

from pyspark.sql import functions as F

from ledgerline.plans import queries

FOLDER = "/root/testdata/sf0.001"


def test_every_event_has_samples_of_ten_families(spark):
    """As many samples of a family for each event as a service and a database of the scenario have in a minute: 115 for five pairs; none has the labels of another."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    found = {r.metric_name.removeprefix("synthetic_"): r.samples for r in queries.metric_families(spark, FOLDER).collect()}
    assert len(found) == 10 and sum(found.values()) == events * 115 // 5
    assert found["http_requests_total"] == 6 * events and found["db_disk_usage_ratio"] == events
    samples = queries.family_samples(spark, FOLDER).groupBy("sample_time", F.get_json_object("labels_json", "$.instance").alias("instance"))
    assert samples.agg(F.count("*").alias("samples"), F.count_distinct("fingerprint").alias("series")).where("samples <> series or samples <> 23").count() == 0
