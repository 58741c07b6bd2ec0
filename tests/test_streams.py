import random
import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.sinks.upserts import KeyedTable, hashed
from souk.streaming import jobs

DAY = datetime(2024, 1, 1)


@pytest.fixture
def folder(spark, tmp_path):
    """Write each batch of rows as a file of its own, oldest first."""

    def write(batches, schema):
        path = f"{tmp_path}/in.parquet"
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return write


def test_view_counters_emit_closed_days(spark, folder, rows):
    views = [(DAY + timedelta(hours=h), "p", f"u{h % 3}", 10 + h % 2) for h in (1, 2, 3, 30)]
    later = [(DAY + timedelta(days=5), "p", "u", 1)]
    path = folder([views, later], "ts timestamp, product_id string, user_id string, view_duration int")
    got = jobs.run_append(jobs.product_view_counters(jobs.file_stream(spark, path)), "views")
    assert rows(got) == [("p", "2024-01-01T00:00:00", 3, 3, 10.67), ("p", "2024-01-02T00:00:00", 1, 1, 10.0)]


def test_complete_counters_have_the_open_days_too(spark, folder, rows):
    views = [(DAY, "p", "u", None), (DAY, "p", "u", 10), (DAY, "p", "v", 20)]
    batches = [views, [(DAY + timedelta(days=5), "p", "u", 1)], [(DAY + timedelta(days=5), "p", "u", None)]]
    path = folder(batches, "ts timestamp, product_id string, user_id string, view_duration int")
    stream = jobs.file_stream(spark, path, per_batch=1)
    got = jobs.run_complete(jobs.views_per_user(stream), "views", jobs.view_counters)
    assert rows(got) == [("p", "2024-01-01T00:00:00", 3, 2, 15.0), ("p", "2024-01-06T00:00:00", 2, 1, 1.0)]


def test_complete_sessions_have_the_open_ones_too(spark, folder, rows):
    events = [(i, DAY + timedelta(hours=h), "u") for i, h in enumerate((0, 5, 17))]
    path = folder([events], "event_id long, ts timestamp, user_id string")
    got = jobs.run_complete(jobs.sessions(jobs.file_stream(spark, path)), "sessions")
    assert rows(got) == [
        ("u", "2024-01-01T00:00:00", "2024-01-01T05:00:00", 2),
        ("u", "2024-01-01T17:00:00", "2024-01-01T17:00:00", 1),
    ]


def test_rows_after_the_watermark_are_dropped(spark, folder):
    schema = "ts timestamp, product_id string, user_id string, view_duration int"
    # The watermark of a batch applies to late rows from the batch after the next.
    batches = [[(DAY + timedelta(days=d), "p", "u", 1)] for d in (0, 9, 9, 0, 12)]
    stream = jobs.file_stream(spark, folder(batches, schema), per_batch=1)
    got = jobs.run_append(jobs.product_view_counters(stream), "views").collect()
    assert {(r.window_start, r.view_count) for r in got} == {("2024-01-01T00:00:00", 1), ("2024-01-10T00:00:00", 2)}


def test_payment_windows(spark, folder, rows):
    payments = [(DAY + timedelta(hours=h), "cash", Decimal("1.50")) for h in (0, 5, 25)]
    end = [(DAY + timedelta(days=20), "cash", Decimal("9"))]
    path = folder([payments, end], "ts timestamp, payment_method string, total decimal(18,2)")
    stream = jobs.file_stream(spark, path)
    tumbling = jobs.run_append(jobs.payment_windows(stream, "1 day"), "pay")
    assert rows(tumbling.drop("kind", "payment_method")) == [
        ("2024-01-01T00:00:00", 2, 3.0),
        ("2024-01-02T00:00:00", 1, 1.5),
    ]
    sliding = jobs.run_append(jobs.payment_windows(stream, "2 days", "1 day"), "pay")
    assert rows(sliding.drop("kind", "payment_method")) == [
        ("2023-12-31T00:00:00", 2, 3.0),
        ("2024-01-01T00:00:00", 3, 4.5),
        ("2024-01-02T00:00:00", 1, 1.5),
    ]


def test_session_windows(spark, folder, rows):
    events = [(i, DAY + timedelta(hours=h), "u") for i, h in enumerate((0, 5, 10, 17, 24))]
    end = [(9, DAY + timedelta(days=9), "v")]
    path = folder([events, end], "event_id long, ts timestamp, user_id string")
    got = jobs.run_append(jobs.sessions(jobs.file_stream(spark, path)), "sessions")
    assert rows(got) == [
        ("u", "2024-01-01T00:00:00", "2024-01-01T10:00:00", 3),
        ("u", "2024-01-01T17:00:00", "2024-01-01T17:00:00", 1),
        ("u", "2024-01-02T00:00:00", "2024-01-02T00:00:00", 1),
    ]


def test_duplicates_across_batches(spark, folder, rows):
    row, other = (1, DAY, "u"), (2, DAY + timedelta(hours=1), "u")
    path = folder([[row], [row, other], [other]], "event_id long, ts timestamp, user_id string")
    got = jobs.run_append(jobs.deduplicated(jobs.file_stream(spark, path, per_batch=1)), "dedup")
    assert rows(got.select("event_id")) == [(1,), (2,)]


def test_upsert_merges_batches_and_ignores_older_rows(spark, folder, rows):
    batches = [
        [("a", 5, "new"), ("b", 1, "b1")],
        [("a", 3, "old"), ("c", 1, "c1")],
        [("b", 2, "b2")],
    ]
    path = folder(batches, "user_id string, ts int, page string")
    got = jobs.run_upsert(jobs.file_stream(spark, path, per_batch=1), "user_id", ["ts"], "latest")
    assert rows(got) == [("a", 5, "new"), ("b", 2, "b2"), ("c", 1, "c1")]


def files(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("part-*.parquet") if not p.is_relative_to(folder / "batch")}


def stored(spark, path, part=None):
    schema = spark.createDataFrame([], "k string, v int").schema
    return KeyedTable(spark, str(path), schema, ["k"], ["v"], F.substring("k", 1, 1) if part is None else part)


def test_upsert_can_run_a_batch_again(spark, tmp_path, rows):
    table = stored(spark, tmp_path)
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    second = spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int")
    table.merge(first, 0)
    table.merge(second, 1)
    table.merge(second, 1)
    assert rows(table.read()) == [("a", 2), ("b", 1)]


def test_a_batch_rewrites_its_own_partitions_only(spark, tmp_path, rows):
    table = stored(spark, tmp_path)
    table.merge(spark.createDataFrame([("a1", 1), ("b1", 1), ("c1", 1), (None, 7)], "k string, v int"), 0)
    before = files(tmp_path / "rows")
    table.merge(spark.createDataFrame([("b1", 3), ("b2", 1), ("b2", 0)], "k string, v int"), 1)
    after = files(tmp_path / "rows")
    assert {f for f in before if "part=b" not in f} == {f for f in after if "part=b" not in f}
    assert {f for f in before if "part=b" in f}.isdisjoint(after)
    assert rows(table.read()) == sorted([("a1", 1), ("b1", 3), ("b2", 1), ("c1", 1), (None, 7)], key=str)
    table.merge(spark.createDataFrame([], "k string, v int"), 2)
    table.merge(spark.createDataFrame([(None, 8)], "k string, v int"), 3)
    assert rows(table.read().where("k IS NULL")) == [(None, 8)] and table.read().count() == 5


def test_a_batch_that_failed_half_way_is_finished(spark, tmp_path, rows, monkeypatch):
    table = stored(spark, tmp_path, hashed("k", parts=4))
    table.merge(spark.createDataFrame([(f"k{i}", 1) for i in range(20)], "k string, v int"), 0)
    write = table._write

    def fails(df, path):
        if path == table.rows_path:  # partitions are taken away and not yet replaced
            for folder in list((tmp_path / "rows").glob("part=*"))[:2]:
                shutil.rmtree(folder)
            raise OSError("lost")
        write(df, path)

    batch = spark.createDataFrame([(f"k{i}", 2) for i in range(0, 30, 2)], "k string, v int")
    monkeypatch.setattr(table, "_write", fails)
    with pytest.raises(OSError, match="lost"):
        table.merge(batch, 1)
    monkeypatch.setattr(table, "_write", write)
    touched = {row[0] for row in batch.select(hashed("k", parts=4)).distinct().collect()}
    assert touched == {0, 1, 2, 3}
    table.merge(batch, 1)
    assert rows(table.read()) == sorted([(f"k{i}", 1 if i % 2 else 2) for i in range(20)] + [(f"k{i}", 2) for i in range(20, 30, 2)])


def test_a_lookup_reads_one_folder(spark, tmp_path):
    table = stored(spark, tmp_path, hashed("k", parts=16))
    table.merge(spark.createDataFrame([(f"k{i}", i) for i in range(200)], "k string, v int"), 0)
    found = table.read((F.col("part") == hashed(F.lit("k77"), parts=16)) & (F.col("k") == "k77"))
    assert [tuple(r) for r in found.collect()] == [("k77", 77)] and len(found.inputFiles()) >= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "EqualTo(k,k77)" in plan


def test_state_is_let_go_and_windows_stay(spark, folder, rows):
    schema = "ts timestamp, payment_method string, total decimal(18,2)"
    batches = [[(DAY + timedelta(days=d, hours=h), "cash", Decimal(1 + h)) for h in (1, 2)] for d in (0, 1, 2, 9, 30, 30)]
    stream = jobs.file_stream(spark, folder(batches, schema), per_batch=1)
    daily, query = jobs.run_update(jobs.daily_payments(stream), ["payment_method"], "daily")
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) <= 3 and held[-1] == 1  # the last day alone; six batches of five days
    want = [(f"{(DAY + timedelta(days=d)):%Y-%m-%d}T00:00:00", 4 if d == 30 else 2, 10.0 if d == 30 else 5.0) for d in (0, 1, 2, 9, 30)]
    assert rows(jobs.windows_of_days(daily, 1, "tumbling").drop("payment_method", "kind")) == want
    three = {r.window_start[:10]: r.payments for r in jobs.windows_of_days(daily, 3, "sliding").collect()}
    assert three["2023-12-30"] == 2 and three["2024-01-01"] == 6 and three["2024-01-03"] == 2 and len(three) == 5 + 3 + 3


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path, rows):
    schema, path = "ts timestamp, payment_method string, total decimal(18,2)", f"{tmp_path}/in.parquet"
    for days in ((0, 1), (1, 2)):
        some = [(DAY + timedelta(days=d), "cash", Decimal(d + 1)) for d in days]
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(path)
        daily, _ = jobs.run_update(jobs.daily_payments(jobs.file_stream(spark, path)), ["payment_method"], "daily", str(tmp_path / "base"))
    assert rows(daily.select(F.date_format("window.start", "dd"), "payments", F.col("sum").cast("int"))) == [("01", 1, 1), ("02", 2, 4), ("03", 1, 3)]


def test_sessions_of_slices_are_those_of_events(spark, folder, rows):
    r = random.Random(6)
    events = [(i, DAY + timedelta(minutes=r.randrange(0, 20_000)), f"u{r.randrange(4)}") for i in range(150)]
    events += [(900, DAY, "edge"), (901, DAY + timedelta(hours=6), "edge"), (902, DAY + timedelta(hours=12, seconds=1), "edge")]
    stream = jobs.file_stream(spark, folder([events[::2], events[1::2]], "event_id long, ts timestamp, user_id string"), per_batch=2)
    slices, _ = jobs.run_update(jobs.activity(stream, 6 * 3600), ["user_id"], "slices")
    want = {}
    for _, ts, user in sorted(events, key=lambda e: e[1]):
        own = want.setdefault(user, [])
        if own and ts - own[-1][1] <= timedelta(hours=6):
            own[-1][1:] = [ts, own[-1][2] + 1]
        else:
            own.append([ts, ts, 1])
    flat = sorted((u, f"{a:%Y-%m-%dT%H:%M:%S}", f"{b:%Y-%m-%dT%H:%M:%S}", n) for u, own in want.items() for a, b, n in own)
    assert rows(jobs.sessions_of_activity(slices, 6 * 3600)) == flat


def test_stream_and_batch_agree(spark, folder):
    views = [(DAY + timedelta(minutes=37 * i), f"p{i % 5}", "u", i % 60) for i in range(400)]
    views += [(DAY + timedelta(days=40), "p0", "u", 1)]
    path = folder([views], "ts timestamp, product_id string, user_id string, view_duration int")
    streamed = jobs.run_append(jobs.product_view_counters(jobs.file_stream(spark, path)), "views")
    batch = (
        spark.read.parquet(path)
        .where(F.col("ts") < DAY + timedelta(days=30))
        .groupBy("product_id", F.date_format("ts", "yyyy-MM-dd'T'00:00:00").alias("window_start"))
        .agg(F.count("*").alias("view_count"))
    )
    both = streamed.select("product_id", "window_start", "view_count")
    assert both.exceptAll(batch).count() == 0 and batch.exceptAll(both).count() == 0
