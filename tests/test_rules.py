"""Match rules on fixed inputs."""

import pytest
from pyspark.sql import functions as F

from matchlive import functions as rules


def column(spark, inputs, types, make):
    """Results of a Column function over rows of arguments, in row order."""
    names = [f"a{i}" for i in range(len(types))]
    schema = "n INT, " + ", ".join(f"{n} {t}" for n, t in zip(names, types))
    rows = [(n, *values) for n, values in enumerate(inputs)]
    frame = spark.createDataFrame(rows, schema)
    result = frame.select("n", make(*(F.col(n) for n in names)).alias("r")).orderBy("n")
    return [row.r for row in result.collect()]


def test_match_second(spark):
    inputs = [(0, 0), (1, 30), (105, 10), (60, 0), (52, 0), (None, 5), (5, None), (2**31 - 1, 0)]
    got = column(spark, inputs, ["INT", "INT"], rules.match_second)
    assert got == [0, 90, 6310, 3600, 3120, None, None, None]
    assert got[3] > got[4]


def test_clock_or_zero(spark):
    inputs = [(1, 30), (None, 5), (5, None), (None, None)]
    assert column(spark, inputs, ["INT", "INT"], rules.clock_or_zero) == [90, 5, 300, 0]


def test_minute_label(spark):
    inputs = [(32, 2), (47, 1), (93, 2), (96, 3), (45, 1), (106, 4), (121, 5), (100, None), (None, 1)]
    want = ["32", "45+2", "90+3", "90+6", "45", "105+1", "105+16", "100", None]
    assert column(spark, inputs, ["INT", "INT"], rules.minute_label) == want


def test_event_flags(spark):
    kinds = [("Shot",), ("Pass",), (None,)]
    assert column(spark, kinds, ["STRING"], rules.is_shot) == [True, False, False]
    pairs = [("Shot", "Goal"), ("Shot", "Saved"), ("Pass", None), ("Shot", None), ("Pass", "Goal")]
    goals = column(spark, pairs, ["STRING", "STRING"], rules.is_goal)
    assert goals == [True, False, False, False, False]
    kinds = [("Shot",), ("Carry",), ("Foul Committed",), (None,)]
    assert column(spark, kinds, ["STRING"], rules.is_attacking) == [True, True, False, False]


def test_safe_xg(spark):
    got = column(spark, [(0.24,), (None,), (-0.01,)], ["DOUBLE"], rules.safe_xg)
    assert got == pytest.approx([0.24, 0.0, 0.0])


def test_win_probability(spark):
    inputs = [
        (0, 0.0, 45), (1, 0.5, 45), (-1, -0.5, 5), (0, 0.6, 90), (1, 0.0, 0),
        (2, -1.0, 30), (3, 0.9, 45), (-3, -0.9, 45), (0, 2.0, 0), (0, 0.6, 200), (1, 0.0, -5), (1, 0.0, None),
    ]
    want = [0.5, 0.934, 0.0321, 0.589, 0.9707, 0.9958, 0.9996, 0.0004, 0.5, 0.589, 0.9707, None]
    got = column(spark, inputs, ["INT", "DOUBLE", "INT"], rules.win_probability)
    assert got == want


def test_win_probability_is_symmetric_and_bounded(spark):
    inputs = [(g, x / 4, m) for g in range(-4, 5) for x in range(-8, 9) for m in (0, 17, 90)]
    mirrored = [(-g, -x, m) for g, x, m in inputs]
    types = ["INT", "DOUBLE", "INT"]
    mine = column(spark, inputs, types, rules.win_probability)
    theirs = column(spark, mirrored, types, rules.win_probability)
    assert all(0 <= p <= 1 for p in mine)
    assert all(p + q == pytest.approx(1, abs=1.01e-4) for p, q in zip(mine, theirs))


def test_minutes_remaining(spark):
    inputs = [(0,), (88,), (90,), (118,), (None,)]
    assert column(spark, inputs, ["INT"], rules.minutes_remaining) == [90, 2, 0, 0, None]
