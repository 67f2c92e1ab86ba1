from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from feira.functions.ages import age_parts, age_sums, days_and_hours, mean_age
from feira.functions.text import fit, fits

from conftest import values

HOURS = 3_600_000_000


def ages(rows, *pairs):
    df = rows("later timestamp_ntz, earlier timestamp_ntz", *pairs)
    return df.select(*[c.alias(n) for n, c in age_parts(F.col("later"), F.col("earlier")).items()])


def mean(rows, *pairs):
    df = rows("later timestamp_ntz, earlier timestamp_ntz", *pairs)
    sums = df.agg(*age_sums(F.col("later"), F.col("earlier")))
    found = sums.select(*mean_age().values(), days_and_hours(mean_age())).first()
    return tuple(found)


@pytest.mark.parametrize(
    "later, earlier, expected",
    [
        (datetime(2004, 6, 1), datetime(2004, 4, 30), (1, 1, 0)),
        (datetime(2018, 3, 1, 5), datetime(2018, 1, 31, 10), (1, 0, 19 * HOURS)),
        (datetime(2018, 1, 31, 10), datetime(2018, 3, 1, 5), (-1, 0, -19 * HOURS)),
        (datetime(2020, 3, 1), datetime(2020, 2, 29), (0, 1, 0)),
        (datetime(2019, 2, 28), datetime(2018, 2, 28), (12, 0, 0)),
        (datetime(2018, 1, 1), datetime(2018, 1, 1), (0, 0, 0)),
        (None, datetime(2018, 1, 1), (None, None, None)),
        (datetime(2018, 1, 1), None, (None, None, None)),
    ],
)
def test_age(rows, later, earlier, expected):
    assert values(ages(rows, (later, earlier))) == [expected]


def test_age_equals_other_engine(rows):
    draw = random.Random(7)
    start = datetime(2015, 1, 1)

    def moment():
        # Month ends and midnights are where days and months are borrowed.
        day = start + timedelta(days=draw.randrange(3000))
        if draw.random() < 0.4:
            day = (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=draw.randrange(3))
        return day + timedelta(microseconds=draw.choice([0, draw.randrange(86_400_000_000)]))

    pairs = [(moment(), moment()) for _ in range(3000)]
    expected = duckdb.connect().execute(
        "SELECT datepart('year', a) * 12 + datepart('month', a), datepart('day', a), "
        "datepart('hour', a) * 3600000000 + datepart('minute', a) * 60000000 + datepart('microsecond', a) "
        "FROM (SELECT age(p[1], p[2]) AS a FROM (SELECT unnest(?) AS p))",
        [[list(p) for p in pairs]],
    )
    assert values(ages(rows, *pairs)) == sorted(expected.fetchall(), key=repr)


def test_mean_does_not_carry_hours(rows):
    base = datetime(2018, 5, 1)
    pairs = [(base + timedelta(days=d, hours=23), base) for d in (10, 11)]
    assert mean(rows, *pairs) == (0, 10, 35 * HOURS, "10 days 35 hours ")


def test_mean_spreads_months_over_days(rows):
    pairs = [
        (datetime(2018, 6, 1), datetime(2018, 5, 1)),
        (datetime(2018, 5, 21), datetime(2018, 5, 1)),
    ]
    assert mean(rows, *pairs) == (0, 25, 0, "25 days 0 hours ")


def test_mean_carries_a_whole_day(rows):
    # 1 month, 1 day and four times nothing: 0.2 month = 6 days, 0.2 day; then one day more each.
    base = datetime(2018, 5, 1)
    pairs = [(datetime(2018, 6, 4), base), (base + timedelta(days=1), base), (base, base)]
    # 1/3 month = 10 days; 4 days / 3 = 1 day and a third.
    assert mean(rows, *pairs) == (0, 11, 8 * HOURS, "11 days 8 hours ")
    thirds = [(datetime(2018, 6, 3), base), (datetime(2018, 6, 1), base)] + [(base, base)] * 5
    # 2/7 month = 8.571429 days and 2/7 day: 0.857143 day of time, no day gained.
    assert mean(rows, *thirds)[:2] == (0, 8)
    sevenths = [(datetime(2018, 6, 6), base), (datetime(2018, 6, 1), base)] + [(base, base)] * 5
    # 0.571429 + 5/7 day is more than one day, which is carried.
    assert mean(rows, *sevenths)[:2] == (0, 9)


def test_negative_mean(rows):
    base = datetime(2018, 5, 1)
    assert mean(rows, (base, base + timedelta(days=3)), (base, base)) == (
        0, -1, -12 * HOURS, "-1 days -12 hours ",
    )


def test_mean_of_nothing_is_one_null_row(rows):
    df = rows("later timestamp_ntz, earlier timestamp_ntz", (None, datetime(2018, 1, 1)))
    sums = df.agg(*age_sums(F.col("later"), F.col("earlier")))
    assert values(sums.select(days_and_hours(mean_age()))) == [(None,)]


def test_text_keeps_all_but_spaces_beyond_its_width(rows):
    df = rows("t string", ("40 days 2 hours ",), ("12 days 10 hours ",), ("abcdefghijklmnopq",), (None,))
    assert values(df.select(fit(F.col("t"), 16), fits(F.col("t"), 16))) == [
        ("12 days 10 hours", True),
        ("40 days 2 hours ", True),
        ("abcdefghijklmnopq", False),
        (None, None),
    ]
