"""Many random rows in one job, compared with plain Python over the same rows."""

import random

from pyspark.sql import functions as F

from weatherlake.functions import arrays, numbers, sky
from weatherlake.operators import alerts, filters
from weatherlake.operators.rules import MONITORED

N = 400


def random_array(rng, make, allow_null_element=True):
    if rng.random() < 0.1:
        return None
    return [None if allow_null_element and rng.random() < 0.1 else make() for _ in range(rng.randrange(6))]


def array_rows(seed):
    rng = random.Random(seed)
    return [
        (i, random_array(rng, lambda: f"t{rng.randrange(100)}", False),
         random_array(rng, lambda: rng.randrange(-800, 800) / 16),
         random_array(rng, lambda: rng.randrange(-800, 800) / 16))
        for i in range(N)
    ]


SCHEMA = "id INT, t ARRAY<STRING>, a ARRAY<DOUBLE>, b ARRAY<DOUBLE>"


def test_zip_is_python_zip(spark):
    rows = array_rows(1)
    zipped = arrays.zip_shortest(F.col("t"), a=F.col("a"), b=F.col("b"))
    found = {r.id: [tuple(e) for e in r.z] for r in spark.createDataFrame(rows, SCHEMA).select("id", zipped.alias("z")).collect()}
    assert found == {i: list(zip(t or [], a or [], b or [])) for i, t, a, b in rows}


def test_array_figures(spark):
    rows = array_rows(2)
    df = spark.createDataFrame(rows, SCHEMA).select(
        "id", arrays.array_sum(F.col("a")).alias("total"), arrays.array_mean(F.col("a")).alias("mean"),
        arrays.non_empty(F.col("a")).alias("some"))
    expected = {}
    for i, _, a, _ in rows:
        present = [x for x in a or [] if x is not None]
        total = sum(present) if present else None
        expected[i] = (total, total / len(present) if present else None, bool(a))
    assert {r.id: (r.total, r.mean, r.some) for r in df.collect()} == expected


def test_numbers_read_back_as_themselves(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randrange(-3, 15) for _ in range(N)] + [0.0, 1e-4, 9.99e-4, 1e7, -1e15]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").select(numbers.number_text(F.col("x")).alias("s"))
    texts = [r.s for r in df.collect()]
    assert all("E" not in text for text, v in zip(texts, values) if abs(v) >= 1e-4 or v == 0)
    for text, v in zip(texts, values):
        assert float(text) == v


def test_rounding_is_that_of_scaled_rint(spark):
    rng = random.Random(4)
    values = [rng.randrange(-10**6, 10**6) / 1000 for _ in range(N)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    found = [r[0] for r in df.select(numbers.round_half_even(F.col("x"), 2)).collect()]
    assert found == [round(v * 100) / 100 for v in values]


def test_every_direction_has_the_nearest_sector(spark):
    degrees = [d / 4 for d in range(0, 1440)]
    df = spark.createDataFrame([(d,) for d in degrees], "d DOUBLE").select(sky.sector_index(F.col("d")))
    for d, row in zip(degrees, df.collect()):
        away = abs((d - row[0] * 22.5 + 180) % 360 - 180)
        assert away <= 11.25


def test_alerts_are_what_a_loop_finds(spark):
    rng = random.Random(5)
    pick = lambda low, high: None if rng.random() < 0.1 else float(rng.randrange(low, high))
    rows = [(f"c{i}", str(i), pick(-20, 60), pick(0, 60), pick(0, 110)) for i in range(N)]
    df = spark.createDataFrame(rows, "city STRING, timestamp STRING, temperature DOUBLE, precipitation DOUBLE, windspeed DOUBLE")
    expected = set()
    for city, _, t, p, w in rows:
        value = {"temperature": t, "precipitation": p, "windspeed": w}
        for rule in MONITORED:
            x = value[rule.metric]
            if x is not None and (x > rule.threshold if rule.direction == "above" else x < rule.threshold):
                expected.add((city, rule.type, x, rule.threshold))
    found = [(r.city, r.alert_type, r.value, r.threshold) for r in alerts.detect(df, MONITORED).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_order_is_by_the_keys_and_loses_no_row(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.randrange(4)) for _ in range(N)]
    df = spark.createDataFrame(rows, "k STRING, v INT").repartition(4)
    assert [tuple(r) for r in filters.sort_by(df, [("k", "asc"), ("v", "desc")]).collect()] == sorted(
        rows, key=lambda r: (r[0], -r[1]))
