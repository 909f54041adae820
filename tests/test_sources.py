"""Table changes, staged tables and the alert rule on stored and arriving rows."""

import pathlib

import pytest
from pyspark.sql import functions as F

from wardlens.operators import ranking
from wardlens.sources import inline, maintenance, staging
from wardlens.sources.tables import load
from wardlens.streaming import rules


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(
        [(1, "F", 20.0), (2, None, 45.0), (3, "M", None)], "id int, sex string, bmi double"
    )


def test_check_split_is_complete(staff):
    accepted, rejected = maintenance.check_split(staff, F.col("sex") == "F")
    assert [r["id"] for r in accepted.collect()] == [1]
    assert sorted(r["id"] for r in rejected.collect()) == [2, 3]


def test_append_fills_missing_columns(spark, staff):
    out = maintenance.append_rows(staff, inline.inline_rows(spark, [(9, "F")], "id int, sex string"))
    assert out.columns == staff.columns
    assert out.filter("id = 9").first()["bmi"] is None


def test_parent_and_family_scans(spark, staff):
    child = staff.withColumn("pressure", F.lit(120))
    assert maintenance.parent_scan(staff, child).columns == staff.columns
    family = maintenance.family_scan(staff, child)
    assert family.count() == 6 and family.filter("pressure is null").count() == 3


def test_update_from_keeps_unmatched_and_takes_one_of_several(spark, staff):
    source = spark.createDataFrame([(1, 30.0, 1), (1, 31.0, 2), (3, None, 1)], "id int, w double, at int")
    out = maintenance.update_from(staff, source, ["id"], "bmi", F.col("w"), [F.col("at").desc()])
    assert {r["id"]: r["bmi"] for r in out.collect()} == {1: 31.0, 2: 45.0, 3: None}


def test_drop_and_add(staff):
    out = maintenance.drop_columns(maintenance.add_columns(staff, c=F.lit(1)), "bmi", "nothing")
    assert out.columns == ["id", "sex", "c"]


def test_staged_table_is_written_under_the_shared_folder(spark, staff):
    root = staging.staging_root(spark)
    staged = staging.stage(staff, "unit")
    assert all(root.removeprefix("file:") in f for f in staged.inputFiles())
    assert staged.schema == staff.schema
    assert sorted(r["id"] for r in staged.collect()) == [1, 2, 3]


def test_save_table_replaces(spark, staff):
    path = staging.staging_path(spark, "replace")
    staging.save_table(staff, path)
    assert staging.save_table(staff.limit(1), path).count() == 1


def test_stream_warns_about_the_same_rows_as_batch(spark, folder, tmp_path):
    events = load(spark, folder, "events")
    rule = F.col("value") > 100
    batch = rules.only_alerts(events, rule, "high")
    want = sorted(map(repr, batch.collect()))
    path = staging.staging_path(spark, "alerts")
    stream = rules.stream_alerts(spark, f"{folder}/events.parque[t]", events.schema, rule, "high", path)
    assert sorted(map(repr, stream.collect())) == want
    flagged = rules.flag_rows(events, rule, "high")
    assert flagged.filter("alert is not null").count() == batch.count()
    assert flagged.count() == events.count()

    # A table stored as a folder of parts; a second run on the same path adds only what is new.
    parts = str(tmp_path / "events.parquet")
    events.repartition(5).write.parquet(parts)
    path = staging.staging_path(spark, "alerts")
    files = f"{tmp_path}/events.parque[t]"
    first = rules.stream_alerts(spark, files, events.schema, rule, "high", path)
    assert sorted(map(repr, first.collect())) == want
    batch.drop("alert").limit(3).withColumn("event_id", F.col("event_id") + 10**9).write.mode("append").parquet(parts)
    second = rules.stream_alerts(spark, files, events.schema, rule, "high", path)
    assert second.count() == len(want) + 3 and second.filter(F.col("event_id") >= 10**9).count() == 3


def test_staged_tables_go_when_their_context_closes(spark, staff):
    with staging.staged(spark):
        ranked = ranking.global_rank(staff, ["bmi"], [True])
        paths = [f for f in ranked.inputFiles()]
        assert ranked.count() == 3 and paths
    kept = staging.stage(staff, "kept")
    exists = lambda f: pathlib.Path(f.removeprefix("file://")).exists()
    assert not any(exists(f) for f in paths)
    assert kept.count() == 3
