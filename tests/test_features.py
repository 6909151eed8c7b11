import random
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sensorweave.operators import features as f
from sensorweave.operators.calibrate import calibrate
from sensorweave.operators.layout import Limits, attach, measure, spread_files
from sensorweave.operators.timestamps import normalize_timestamps

T10 = "2025-06-05T10:00:00"
START = datetime(2025, 6, 5)


def text(minutes):
    return (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S")


def column(df, name):
    return [r[name] for r in df.orderBy("row_index").collect()]


def test_calibration(readings, config):
    rows = [("s1", T10, "temperature", 25.0, 90.0), ("s1", T10, "co2", 7.0, 90.0), ("s1", T10, "humidity", None, 90.0)]
    assert column(calibrate(readings(rows), config), "value") == [pytest.approx(26.0), 7.0, None]


def test_seven_rows_not_seven_days(readings):
    rows = [("s1", text(i * 1440), "temperature", float(i + 1), 90.0) for i in range(9)]
    assert column(f.rolling_average(readings(rows)), "rolling_7d_avg") == [1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6]


def test_missing_values_take_a_place_in_the_window(readings):
    rows = [("s1", text(i), "temperature", None if i in (0, 3) else float(i), 90.0) for i in range(9)]
    got = column(f.rolling_average(readings(rows)), "rolling_7d_avg")
    assert got[0] is None and got[3] == 1.5 and got[8] == pytest.approx((2 + 4 + 5 + 6 + 7 + 8) / 6)


def test_daily_average_is_per_utc_day(readings):
    rows = [("s1", "2025-06-05T23:50:00", "t", 1.0, 9.0), ("s1", "2025-06-05T00:10:00", "t", 3.0, 9.0), ("s1", "2025-06-06T00:10:00", "t", 5.0, 9.0)]
    df = f.daily_average(readings(rows))
    assert column(df, "daily_avg") == [2.0, 2.0, 5.0]
    assert [str(d) for d in column(df, "date")] == ["2025-06-05", "2025-06-05", "2025-06-06"]


def test_rows_without_a_key_or_time_get_no_average(readings, config):
    rows = [(None, T10, "t", 1.0, 9.0), ("s1", T10, None, 1.0, 9.0), ("s1", None, "t", 4.0, 9.0), ("s1", T10, "t", 2.0, 9.0)]
    for limits in [Limits(), Limits(group_rows=1)]:
        df = f.derive_features(readings(rows), config, limits=limits)
        assert column(df, "daily_avg") == [None, None, None, 2.0]
        assert column(df, "rolling_7d_avg") == [None, None, 3.0, 2.0]


def test_anomalies(readings, config):
    rows = [("s", T10, "temperature", v, 9.0) for v in (200.0, 50.0, 0.0, -0.1, None, float("nan"))]
    rows += [("s", T10, "co2", 5000.0, 9.0), ("s", T10, "co2", None, 9.0)]
    got = column(f.flag_anomalies(readings(rows), config), "anomalous_reading")
    assert got == [True, False, False, True, True, True, False, True]


def test_missing_bounds_are_open(spark, readings):
    config = spark.sql("SELECT 'temperature' reading_type, CAST(NULL AS DOUBLE) min, 50D max, 1D multiplier, 0D offset")
    rows = [("s", T10, "temperature", v, 9.0) for v in (-1e9, 51.0)]
    assert column(f.flag_anomalies(readings(rows), config), "anomalous_reading") == [False, True]


def hot_rows(seed, n=300):
    """One sensor with most of the rows, many equal times, some missing values, and a few small sensors."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sensor = "hot" if rng.random() < 0.8 else f"s{rng.randrange(20)}"
        minute = rng.choice([rng.randrange(3 * 1440), 100, 101])
        rows.append((sensor, text(minute), "temperature", None if rng.random() < 0.1 else rng.random(), 90.0))
    return rows


def brute_rolling(rows):
    series, result = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        series.setdefault(rows[i][0], []).append(i)
    for indexes in series.values():
        for at, i in enumerate(indexes):
            window = [rows[j][3] for j in indexes[max(0, at - 6) : at + 1] if rows[j][3] is not None]
            result[i] = sum(window) / len(window) if window else None
    return [result[i] for i in range(len(rows))]


@pytest.mark.parametrize("group_rows", [12, 60])
def test_split_sensors_get_the_same_averages(readings, config, group_rows):
    rows = hot_rows(group_rows)
    df = readings(rows)
    limits = Limits(group_rows=group_rows)
    assert measure(df, limits).hot.count() >= 1
    split = f.derive_features(df, config, limits=limits).orderBy("row_index").collect()
    plain = f.derive_features(df, config).orderBy("row_index").collect()
    assert [r["row_index"] for r in split] == list(range(len(rows)))
    assert [r["rolling_7d_avg"] for r in split] == [v if v is None else pytest.approx(v) for v in brute_rolling(rows)]
    for a, b in zip(split, plain):
        assert a["daily_avg"] == pytest.approx(b["daily_avg"])
        assert a["rolling_7d_avg"] == pytest.approx(b["rolling_7d_avg"])
        assert (a["date"], a["anomalous_reading"]) == (b["date"], b["anomalous_reading"])


def test_split_sensor_with_one_single_instant(readings, config):
    rows = [("hot", T10, "temperature", float(i), 90.0) for i in range(100)]
    got = column(f.rolling_average(readings(rows), measure(readings(rows), Limits(group_rows=10))), "rolling_7d_avg")
    assert got == [sum(range(max(0, i - 6), i + 1)) / (i - max(0, i - 6) + 1) for i in range(100)]


def brute_days(rows, days=7):
    times = [datetime.fromisoformat(r[1]) for r in rows]
    result = []
    for i, row in enumerate(rows):
        window = [
            rows[j][3]
            for j in range(len(rows))
            if rows[j][0] == row[0] and times[i] - timedelta(days=days) < times[j] <= times[i] and rows[j][3] is not None
        ]
        result.append(sum(window) / len(window) if window else None)
    return result


def test_seven_days(readings):
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(2)}", text(rng.choice([0, 30, 60, 7 * 1440, rng.randrange(12 * 1440)])), "t", None if rng.random() < 0.2 else rng.random(), 9.0) for _ in range(250)]
    got = column(f.rolling_average_days(readings(rows)), "rolling_7d_avg")
    assert got == [v if v is None else pytest.approx(v) for v in brute_days(rows)]


def test_salted_join_keeps_every_row(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    stats = spark.sql("SELECT 'hot' k, 1 v UNION ALL SELECT 'other', 2")
    joined = attach(df, stats, ["k"], False, Limits(salts=7))
    assert joined.groupBy("v").count().orderBy("v").collect() == [(None, 300), (1, 700)]


def test_layout_of_empty_input(readings, spark):
    empty = readings([("s", T10, "t", 1.0, 1.0)]).limit(0)
    assert measure(empty).rows == 0 and measure(empty).by_file


@pytest.mark.parametrize(
    "given, wanted, local",
    [
        ("06/05/2025 10:00 AM", "2025-06-05T10:00:00", "2025-06-05T15:30:00"),
        ("6/5/2025 1:00 PM", "2025-06-05T13:00:00", "2025-06-05T18:30:00"),
        ("12/31/2025 12:05 AM", "2025-12-31T00:05:00", "2025-12-31T05:35:00"),
        ("2025-06-05T10:15:00", "2025-06-05T10:15:00", "2025-06-05T15:45:00"),
        ("2025-06-05 10:15:00", "2025-06-05T10:15:00", "2025-06-05T15:45:00"),
        ("2025-06-05", "2025-06-05T00:00:00", "2025-06-05T05:30:00"),
        ("2025-06-05T10:00:00.9", "2025-06-05T10:00:00", "2025-06-05T15:30:00"),
        ("2025-06-05T10:00:00+05:30", "2025-06-05T04:30:00", "2025-06-05T10:00:00"),
        ("2025-06-05T10:00:00Z", "2025-06-05T10:00:00", "2025-06-05T15:30:00"),
        ("06/05/2025 22:10", "2025-06-05T22:10:00", "2025-06-06T03:40:00"),
        ("INVALID_TS", None, None),
        ("now", None, None),
        ("12:30", None, None),
        ("2025-13-45", None, None),
        (None, None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_timestamps(spark, readings, given, wanted, local, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = normalize_timestamps(readings([("s", given, "t", 1.0, 1.0)])).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r["timestamp"], r["timestamp_ist"]) for r in rows] == ([] if wanted is None else [(wanted, local)])


def test_dropped_rows_are_counted_without_a_job(readings):
    from pyspark.sql import Observation

    seen = Observation()
    rows = [("s", t, "t", 1.0, 1.0) for t in (T10, "bad", None)]
    assert normalize_timestamps(readings(rows), dropped=seen).count() == 1
    assert seen.get == {"invalid": 2}


@pytest.mark.parametrize("limits", [Limits(group_rows=40), Limits(group_rows=40, broadcast_rows=0, salts=3)])
def test_transform_is_the_same_for_large_files_and_hot_sensors(readings, config, limits):
    from sensorweave.plans.jobs import transform

    rows = hot_rows(7) + [("hot", "06/07/2025 10:00 AM", "temperature", 900.0, 1.0), ("hot", "bad", "temperature", 1.0, 1.0)]
    rows += [(None, T10, "temperature", 1.0, 1.0)] + rows[:25] + [("h", T10, "humidity", 400.0, None)]
    df = readings(rows, "a.parquet").unionByName(readings(rows[:60], "b.parquet"))
    assert measure(df, limits).hot is not None and measure(df).by_file
    plain = transform(df, config).orderBy("file_name", "row_index").collect()
    split = transform(df, config, limits=limits).orderBy("file_name", "row_index").collect()
    assert len(plain) == len(split) > 120
    for a, b in zip(plain, split):
        a, b = a.asDict(), b.asDict()
        for name in ["value", "battery_level", "daily_avg", "rolling_7d_avg"]:
            assert a.pop(name) == pytest.approx(b.pop(name))
        assert a == b


def test_large_files_do_not_change_the_plan_of_others(spark, config, readings):
    """Ordinary files are shuffled once, whatever else is in the table, and all rows come out alike."""
    from sensorweave.operators.layout import Limits, route
    from sensorweave.plans.jobs import _transform_part, transform

    rows = lambda n, k: [(f"s{i % k}", f"2025-06-{1 + i // 24 % 28:02d}T{i % 24:02d}:00:00", "humidity", float(i * 7 % 50), 1.0) for i in range(n)]
    df = readings(rows(400, 3), "large.parquet").unionByName(readings(rows(30, 2), "a.parquet")).unionByName(readings(rows(20, 1), "b.parquet"))
    limits = Limits(group_rows=100, broadcast_rows=10, salts=3)
    parts = route(df, limits)
    assert [(own.by_file, own.largest_file, own.rows) for _, own in parts] == [(True, 30, 50), (False, 400, 400)]
    assert {r["file_name"] for r in parts[1][0].collect()} == {"large.parquet"}
    plan = _transform_part(*parts[0][:1], config, "rows", parts[0][1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file_name") == 1
    key = lambda r: (r["file_name"], r["row_index"])
    values = lambda found: [(*key(r), r["value"], pytest.approx(r["daily_avg"]), pytest.approx(r["rolling_7d_avg"])) for r in sorted(found.collect(), key=key)]
    assert values(transform(df, config, limits=limits)) == values(transform(df, config))


def test_small_chunks_share_tasks(readings, monkeypatch):
    tasks, chunks = [], []

    def watched(df, name):
        staged = STAGE(df, name)
        if name == "hot-chunks":
            tasks.append(df.rdd.getNumPartitions())
            chunks.append(staged.groupBy("_chunk").count())
        return staged

    STAGE = f.stage
    monkeypatch.setattr(f, "stage", watched)
    rows = [(f"s{i % 3}", text(i), "t", float(i * i % 17), 9.0) for i in range(400)]
    df = readings(rows)
    got = f.rolling_average(df, measure(df, Limits(group_rows=2, broadcast_rows=10, salts=2)))
    whole = f.rolling_average(df)
    assert column(got, "rolling_7d_avg") == pytest.approx(column(whole, "rolling_7d_avg"))
    assert tasks == [4]
    sizes = [r["count"] for r in chunks[0].collect()]
    assert len(sizes) >= 200 and max(sizes) <= 2


def test_parts_of_a_large_file_are_smaller_than_what_a_task_may_hold(readings):
    rows = [(f"s{i % 97}", text(i), "t", float(i), 9.0) for i in range(970)]
    df = readings(rows)
    layout = measure(df, Limits(group_rows=500, part_rows=100))
    parts = spread_files(df, layout).groupBy("_part").count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 300
    got, whole = f.daily_average(df, layout), f.daily_average(df)
    assert column(got, "daily_avg") == pytest.approx(column(whole, "daily_avg"))


def test_rows_of_one_index_and_time_follow_each_other_across_chunks(spark):
    """Each row is counted after the ones before it, whichever order equal rows take."""
    rows = [(0, "a", "s", T10, "t", float(2**i)) for i in range(6)]
    df = spark.createDataFrame(rows, "row_index long, file_name string, sensor_id string, timestamp string, reading_type string, value double")
    got = f.rolling_average(df, measure(df, Limits(group_rows=1, broadcast_rows=10, salts=2))).collect()
    averages = sorted(r["rolling_7d_avg"] for r in got)
    means = lambda values: sorted(sum(values[: n + 1]) / (n + 1) for n in range(len(values)))
    assert any(averages == pytest.approx(means(p)) for p in permutations([2.0**i for i in range(6)]))
