import math
import random
import sys

import pytest
from pyspark.sql import functions as F

from sensorweave.operators import clean as c
from sensorweave.operators.layout import Limits, measure
from sensorweave.operators.ranks import exact_median

T10 = "2025-06-05T10:00:00"


def at(i):
    return f"2025-06-05T{i // 60:02d}:{i % 60:02d}:00"


def series(values, kind="temperature", sensor="s1"):
    return [(sensor, at(i), kind, v, 90.0) for i, v in enumerate(values)]


def values(df):
    return [r["value"] for r in df.orderBy("row_index").collect()]


# One row per task at most: forces the plans meant for large files.
TINY = Limits(group_rows=1, broadcast_rows=500_000)
SALTED = Limits(group_rows=1, broadcast_rows=0, salts=4)
LIMITS = pytest.mark.parametrize("limits", [Limits(), TINY, SALTED], ids=["by_file", "large", "salted"])


def test_identical_rows_are_merged(readings, config):
    df = readings([("s1", T10, "temperature", 25.5, 90.0)] * 2)
    assert c.clean(df, config).count() == 1


@pytest.mark.parametrize("by_file", [False, True])
def test_first_row_in_file_order_is_kept(readings, by_file):
    rows = [("s1", T10, "temperature", 1.0, 90.0), ("s1", T10, "temperature", 2.0, 80.0)]
    kept = c.dedupe_first(readings(rows).orderBy(F.desc("row_index")), by_file)
    assert [(r["value"], r["battery_level"]) for r in kept.collect()] == [(1.0, 90.0)]


def test_first_row_wins_even_if_its_value_is_null(readings):
    rows = [("s1", T10, "temperature", None, None), ("s1", T10, "temperature", 2.0, 80.0)]
    assert values(c.dedupe_first(readings(rows))) == [None]


def test_first_row_is_kept_whole_with_text_columns(readings):
    rows = [("s1", T10, "temperature", 1.0, None), ("s1", T10, "temperature", 2.0, 80.0)]
    df = readings(rows).withColumn("note", F.concat(F.lit("n"), F.col("row_index")))
    kept = c.dedupe_first(df)
    assert kept.columns == df.columns
    assert [(r["value"], r["battery_level"], r["note"]) for r in kept.collect()] == [(1.0, None, "n0")]


def test_same_key_in_two_files_is_no_copy(readings):
    row = [("s1", T10, "temperature", 1.0, 90.0)]
    both = readings(row, "a.parquet").unionByName(readings(row, "b.parquet"))
    assert c.dedupe_first(both).count() == 2


def test_incomplete_keys_are_dropped(readings):
    rows = [(None, T10, "t", 1.0, 1.0), ("s", None, "t", 1.0, 1.0), ("s", T10, None, 1.0, 1.0), ("s", T10, "t", 1.0, 1.0)]
    assert c.drop_incomplete(readings(rows)).count() == 1


@LIMITS
def test_imputation_uses_the_mean_over_all_types(readings, limits):
    rows = [("s", at(0), "temperature", 10.0, 1.0), ("s", at(1), "humidity", 30.0, 3.0), ("s", at(2), "humidity", None, None)]
    df = readings(rows)
    filled = c.impute_mean(df, measure(df, limits)).orderBy("row_index").collect()
    assert [r["value"] for r in filled] == [10.0, 30.0, 20.0]
    assert [r["battery_level"] for r in filled] == [1.0, 3.0, 2.0]
    by_type = c.impute_mean(df, measure(df, limits), by_type=True)
    assert values(by_type) == [10.0, 30.0, 30.0]


@LIMITS
def test_nan_counts_as_missing(readings, limits):
    df = readings([("s", at(0), "temperature", 10.0, 1.0), ("s", at(1), "temperature", float("nan"), 1.0)])
    assert values(c.impute_mean(df, measure(df, limits))) == [10.0, 10.0]


@LIMITS
def test_a_file_without_values_stays_empty(readings, config, limits):
    df = readings(series([None] * 6))
    assert values(c.clean(df, config, limits=limits)) == [None] * 6


@LIMITS
def test_small_samples_are_clipped(readings, config, limits):
    rows = [("s", at(0), "humidity", 999.0, 1.0), ("s", at(1), "humidity", -3.0, 1.0), ("s", at(2), "humidity", 50.0, 1.0)]
    assert values(c.clean(readings(rows), config, limits=limits)) == [100.0, 0.0, 50.0]
    df = readings(rows)
    assert values(c.clip_small_samples(df, config, measure(df, limits))) == [100.0, 0.0, 50.0]


@LIMITS
def test_unconfigured_types_are_not_clipped(readings, config, limits):
    df = readings([("s", at(0), "co2", 5000.0, 1.0)])
    assert values(c.clean(df, config, limits=limits)) == [5000.0]


@LIMITS
def test_outliers_become_the_median(readings, config, limits):
    df = readings(series([1.0] * 10 + [1e6]))
    assert values(c.correct_outliers(df, measure(df, limits))) == [1.0] * 11
    assert values(c.clean(df, config, limits=limits)) == [1.0] * 11


@LIMITS
def test_nine_rows_can_have_no_outlier(readings, config, limits):
    data = [1.0] * 8 + [1e6]
    assert values(c.clean(readings(series(data)), config, limits=limits)) == data


@LIMITS
def test_constant_values_are_left_alone(readings, config, limits):
    assert values(c.clean(readings(series([0.1] * 7)), config, limits=limits)) == [0.1] * 7


def brute_clean(rows):
    """The cleaning rules in plain Python, for rows of one file."""
    low_high = {"temperature": (0, 50), "humidity": (0, 100)}
    seen, kept = set(), []
    for i, (sensor, ts, kind, value, battery) in enumerate(rows):
        key = (sensor, ts, kind)
        if None in key or key in seen:
            continue
        seen.add(key)
        kept.append([i, kind, value, battery])
    for position in (2, 3):
        known = [r[position] for r in kept if r[position] is not None]
        for r in kept:
            if r[position] is None and known:
                r[position] = sum(known) / len(known)
    for kind in {r[1] for r in kept}:
        group = [r for r in kept if r[1] == kind]
        data = sorted(r[2] for r in group)
        n = len(data)
        if n < 5:
            low, high = low_high.get(kind, (float("-inf"), float("inf")))
            for r in group:
                r[2] = min(max(r[2], low), high)
            continue
        mean = sum(data) / n
        std = (sum((v - mean) ** 2 for v in data) / n) ** 0.5
        median = (data[(n - 1) // 2] + data[n // 2]) / 2
        for r in group:
            if std > 0 and abs(r[2] - mean) / std > 3:
                r[2] = median
    return {r[0]: (r[2], r[3]) for r in kept}


@LIMITS
@pytest.mark.parametrize("seed", [1])
def test_clean_matches_brute_force(spark, readings, config, limits, seed):
    rng = random.Random(seed)
    files, expected = [], {}
    for name in ["a.parquet", "b.parquet"]:
        rows = []
        for i in range(150):
            kind = rng.choice(["temperature"] * 6 + ["humidity"] * 6 + [f"rare{rng.randrange(3)}"])
            value = None if rng.random() < 0.08 else rng.choice([rng.gauss(20, 2), round(rng.gauss(20, 2), 1)])
            if rng.random() < 0.03 and value is not None:
                value += 500.0
            sensor = None if rng.random() < 0.02 else f"s{rng.randrange(4)}"
            rows.append((sensor, at(rng.randrange(60)), kind, value, None if rng.random() < 0.1 else rng.random()))
        files.append(readings(rows, name))
        expected.update({(name, i): v for i, v in brute_clean(rows).items()})
    result = c.clean(files[0].unionByName(files[1]), config, limits=limits).collect()
    assert {(r["file_name"], r["row_index"]) for r in result} == set(expected)
    for r in result:
        value, battery = expected[(r["file_name"], r["row_index"])]
        assert r["value"] == pytest.approx(value)
        assert r["battery_level"] == pytest.approx(battery)


@pytest.mark.parametrize("group_rows", [1, 1000, 10**6])
def test_exact_median_of_large_groups(spark, group_rows):
    rng = random.Random(5)
    data = {f"g{k}": [rng.lognormvariate(0, 3) if k % 2 else float(rng.randrange(5)) for _ in range(3000 + k)] for k in range(4)}
    rows = [(g, "t", v) for g, vs in data.items() for v in vs] + [("g0", "t", None)]
    df = spark.createDataFrame(rows, "file_name string, reading_type string, value double")
    layout = measure(df.withColumn("sensor_id", F.lit("s")), Limits(group_rows=group_rows))
    medians = exact_median(df, ["file_name", "reading_type"], "value", layout).collect()
    assert len(medians) == 4
    for r in medians:
        ordered = sorted(data[r["file_name"]])
        n = len(ordered)
        assert r["median"] == (ordered[(n - 1) // 2] + ordered[n // 2]) / 2


def test_median_by_repeated_narrowing(spark, monkeypatch):
    """Whatever the distribution, ranking is left with no more rows of a group than the limit."""
    from sensorweave.operators import ranks

    rng = random.Random(2)
    most = sys.float_info.max
    groups = {
        "powers": [10.0**e for e in range(-300, 308, 50)] + [-(10.0**e) for e in range(-300, 308, 60)],
        "ends": [float("inf")] * 20 + [float("-inf")] * 20 + [most, -most, 0.0],
        "nan": [float("nan")] * 30 + [float(k) for k in range(10)],
        "equal": [7.0] * 60,
        "two": [1.0] * 30 + [2.0] * 30,
        "close": [1.0 + k * 2**-52 for k in range(64)],
        "random": [rng.gauss(0, 1) for _ in range(301)],
        "small": [3.0, 1.0],
        "none": [None],
    }
    rows = [("a", name, v) for name, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file_name string, reading_type string, value double")
    limit, ranked, original = 8, [], ranks._ranked

    def counting(values, keys):
        ranked.append(values.groupBy(keys).count().agg(F.max("count")).first()[0] or 0)
        return original(values, keys)

    monkeypatch.setattr(ranks, "BINS", 8)
    monkeypatch.setattr(ranks, "_ranked", counting)
    layout = measure(df.withColumn("sensor_id", F.lit("s")), Limits(group_rows=limit))
    found = {r["reading_type"]: r["median"] for r in exact_median(df, ["file_name", "reading_type"], "value", layout).collect()}
    for name, values in groups.items():
        ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        n = len(ordered)
        if not n:
            assert name not in found
            continue
        middle = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
        assert found[name] == middle or math.isnan(found[name]) and math.isnan(middle), name
    assert max(ranked) <= limit
