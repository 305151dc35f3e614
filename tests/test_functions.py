from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hearthlog.functions.event_time import day, day_label, event_time
from hearthlog.functions.fault_codes import strict_long
from hearthlog.functions.payload import payload_map, payload_value
from hearthlog.operators.newly_raised import is_bad_code, newly_raised_faults

# From the edge rows of FIXTURES.md.
RAISED = [
    ("3", "0", [1, 2]),
    ("3", "1", [2]),
    ("1", "3", []),
    ("8192", "0", [14]),
    ("2048", "0", [12]),
    ("0", "5", []),
    ("-1", "0", []),
    ("5", "-1", [1, 3]),
    ("+5", "0", [1, 3]),
    ("-0", "0", []),
    ("007", "0", [1, 2, 3]),
    ("4611686018427387904", "0", [63]),
    ("4611686018427387905", "0", [1, 63, 64]),
    ("4611686018427387905", "4611686018427387905", []),
    ("4611686018427387905", "4611686018427387904", [1, 64]),
    ("9223372036854775807", "0", list(range(1, 65))),
    ("9223372036854775807", "9223372036854775807", []),
    ("5", "-9223372036854775808", [1, 3]),
    ("１２", "+０", [3, 4]),
    ("٥", "1", [3]),
]
NO_NUMBER = [" 5 ", "5.0", "", "x", None, "9223372036854775808", "12\n", "1e3", "+", "0x1", "5 ", "Ⅻ", "²", "𝟓"]


def raised_of(spark, pairs):
    frame = spark.createDataFrame(
        [(i, *pair) for i, pair in enumerate(pairs)], "i int, new string, old string"
    )
    found = [[] for _ in pairs]
    for row in newly_raised_faults(frame, "new", "old").collect():
        found[row.i].append(int(row.fault_number))
    return found


def test_newly_raised_faults(spark):
    assert raised_of(spark, [(n, o) for n, o, _ in RAISED]) == [e for _, _, e in RAISED]


def test_codes_that_are_no_numbers_raise_nothing(spark):
    pairs = [(bad, "0") for bad in NO_NUMBER] + [("5", bad) for bad in NO_NUMBER]
    assert raised_of(spark, pairs) == [[]] * len(pairs)
    frame = spark.createDataFrame([*pairs, ("5", "0")], "new string, old string")
    bad = frame.select(F.count_if(is_bad_code("new", "old"))).first()[0]
    assert bad == len(pairs)


def faults_of(code: int) -> set[int]:
    if code <= 0:
        return set()
    numbers = {bit + 1 for bit in range(63) if code >> bit & 1}
    return numbers | {64} if code > 2**62 else numbers


def test_newly_raised_faults_equal_a_model(spark):
    rng = random.Random(5)
    special = [0, 1, -1, 2**62, 2**62 - 1, 2**62 + 1, 2**63 - 1, -(2**63)]

    def code():
        return rng.choice([rng.choice(special), rng.getrandbits(rng.randint(1, 63))])

    pairs = [(code(), code()) for _ in range(3000)]
    expected = [sorted(faults_of(new) - faults_of(old)) for new, old in pairs]
    assert raised_of(spark, [(str(n), str(o)) for n, o in pairs]) == expected


def test_strict_long(spark):
    texts = [*NO_NUMBER, "12", "+12", "-１２", "-9223372036854775808"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    values = [r[0] for r in frame.select(strict_long(F.col("t"))).collect()]
    assert values == [None] * len(NO_NUMBER) + [12, 12, -12, -(2**63)]


PAYLOADS = [
    ("k:5", "5"),
    ("a:1,k:5,b:2", "5"),
    ("k:", ""),
    ("k", None),
    ("k:1,k:2", "2"),
    ("k:1,k", None),
    ("k,k:1", "1"),
    ("k:a:b", "a:b"),
    ("k:k", "k"),
    ("k:k:5", "k:5"),
    ("k:,k:2", "2"),
    (" k:5", None),
    ("k :5", None),
    ("k: 5 ", " 5 "),
    ("lk:5", None),
    ("kk:5", None),
    ("a:k:5", None),
    ("K:5", None),
    ("k:5,", "5"),
    (",k:5", "5"),
    ("k:line\nbreak", "line\nbreak"),
    ("", None),
    (None, None),
]


def test_payload_value(spark):
    frame = spark.createDataFrame([(p,) for p, _ in PAYLOADS], "p string")
    rows = frame.select(
        payload_value(F.col("p"), "k").alias("v"), payload_map(F.col("p"))["k"].alias("m")
    ).collect()
    assert [r.v for r in rows] == [value for _, value in PAYLOADS]
    assert [r.m for r in rows] == [value for _, value in PAYLOADS]


def test_payload_value_equals_map_lookup_on_random_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("kk::,,x1\n ") for _ in range(rng.randint(0, 14))) for _ in range(20000)]
    frame = spark.createDataFrame([(t,) for t in texts], "p string").repartition(8)
    differing = frame.where(
        ~payload_value(F.col("p"), "k").eqNullSafe(payload_map(F.col("p"))["k"])
    )
    assert differing.count() == 0


@pytest.mark.parametrize("zone, expected", [("UTC", "2022-11-03"), ("Asia/Shanghai", "2022-11-04")])
def test_day_follows_the_session_zone(spark, zone, expected):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(1667491200000,), (None,)], "ms bigint")
        ts = event_time(F.col("ms"))
        days = frame.select(day_label(day(ts)).alias("d"), F.date_format(ts, "yyyy-MM-dd").alias("e"))
        assert [tuple(r) for r in days.collect()] == [(expected, expected), (None, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_outside_the_calendar_is_null(spark):
    inside = [-62135596800000, 0, 253402300799999]
    outside = [-62135596800001, 253402300800000, 1667491200000000, 2**63 - 1, -(2**63), None]
    frame = spark.createDataFrame([(ms,) for ms in inside + outside], "ms bigint")
    days = [r[0] for r in frame.select(day_label(day(event_time(F.col("ms"))))).collect()]
    assert days == ["0001-01-01", "1970-01-01", "9999-12-31"] + [None] * len(outside)


def test_day_equals_direct_formatting_across_time_and_zones(spark):
    try:
        for zone in ("UTC", "Asia/Shanghai", "America/Sao_Paulo", "Pacific/Apia"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            hours = spark.range(-200_000, 700_000, 1, 8)
            ts = event_time(F.col("id") * 3_600_000 + 1_799_999)
            direct = F.date_format(ts, "yyyy-MM-dd")
            assert hours.where(day_label(day(ts)) != direct).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
