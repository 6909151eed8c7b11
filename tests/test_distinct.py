"""Merged distinct counts against plain ones."""

import random

from sensorweave.operators import distinct


def test_counts_over_sets_of_files(spark):
    rng = random.Random(3)
    rows = [(f"f{rng.randrange(12)}", rng.choice([None, "", f"s{rng.randrange(400)}"])) for _ in range(3000)] + [("only-null", None)]
    df = spark.createDataFrame(rows, "file_name string, sensor_id string")
    first = df.where("file_name < 'f5'")
    early = distinct.extend_dictionary(first, "sensor_id")
    numbers = distinct.extend_dictionary(df, "sensor_id", early)
    given = {r["value"]: r["number"] for r in numbers.collect()}
    assert len(given) == len(set(given.values())) == len({s for _, s in rows if s is not None})
    assert all(given[r["value"]] == r["number"] for r in early.collect())
    files = sorted({f for f, _ in rows})
    sets = {name: rng.sample(files, size) for name, size in [("few", 2), ("many", 9), ("all", len(files))]} | {"none": ["only-null"], "gone": ["nowhere"]}
    listed = spark.createDataFrame([(f, name) for name, own in sets.items() for f in own], "file_name string, set string")
    # Bitmaps of two batches of files, the later ones with the longer dictionary.
    bitmaps = distinct.file_bitmaps(first, "sensor_id", early).unionByName(
        distinct.file_bitmaps(df.where("file_name >= 'f5'"), "sensor_id", numbers)
    )
    wanted = {name: len({s for f, s in rows if f in own and s is not None}) for name, own in sets.items()}
    assert {r["set"]: r["distinct"] for r in distinct.distinct_over(bitmaps, listed).collect()} == wanted
    about = {r["set"]: r["distinct"] for r in distinct.estimate_over(distinct.file_sketches(df, "sensor_id"), listed).collect()}
    assert about.keys() == wanted.keys() and all(abs(about[n] - wanted[n]) <= 0.1 * wanted[n] for n in wanted)
    assert distinct.distinct_over(bitmaps, listed.limit(0)).isEmpty()
    assert distinct.extend_dictionary(df.limit(0), "sensor_id").isEmpty()
