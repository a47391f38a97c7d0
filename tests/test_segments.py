import random

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import segments as s


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows belong to one key; positions have holes of several segments."""
    rng = random.Random(7)
    rows, position = [], 0
    for _ in range(900):
        position += rng.choice([1, 1, 1, 2, 55])
        rows.append((rng.choice(["hot", "hot", "hot", "hot", "a", "b"]), position, rng.randint(0, 10_000)))
    return spark.createDataFrame(rows, "k string, pos bigint, v bigint").cache()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("width", [5, 20, 10_000])
def test_running_max_equals_one_window(skewed, width, inclusive):
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    expected = skewed.withColumn("m", F.max("v").over(w))
    got = s.running_max(skewed, ["k"], "pos", F.col("v"), s.sequence_segment("pos", width), "m", inclusive)
    assert got.columns == expected.columns
    as_text = F.coalesce(F.col("m").cast("string"), F.lit("-"))
    assert rows(got, "k", "pos", as_text) == rows(expected, "k", "pos", as_text)


@pytest.mark.parametrize("width", [5, 20, 10_000])
def test_row_number_equals_one_window(skewed, width):
    expected = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    got = s.row_number_by_segment(skewed, ["k"], "pos", s.sequence_segment("pos", width), "n")
    assert rows(got, "k", "pos", "n") == rows(expected, "k", "pos", "n")


@pytest.mark.parametrize("n", [1, 4, 20])
@pytest.mark.parametrize("width", [3, 20, 10_000])
def test_history_completes_every_frame(skewed, n, width):
    total = lambda *p: F.sum("v").over(Window.partitionBy(*p).orderBy("pos").rowsBetween(-n, -1))
    as_text = F.coalesce(F.col("t").cast("string"), F.lit("-"))
    expected = skewed.withColumn("t", total("k"))
    with_rows = s.with_history(skewed, ["k"], "pos", s.sequence_segment("pos", width), n)
    got = s.without_history(with_rows.withColumn("t", total("k", s.SEGMENT)))
    assert got.count() == skewed.count()
    assert rows(got, "k", "pos", as_text) == rows(expected, "k", "pos", as_text)


def test_history_adds_at_most_n_rows_per_segment(skewed):
    extended = s.with_history(skewed, ["k"], "pos", s.sequence_segment("pos", 50), 4)
    carried = extended.filter(s.CARRIED).groupBy("k", s.SEGMENT).count()
    assert carried.agg(F.max("count")).first()[0] <= 4
