import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.operators import quantiles
from txlab.operators.quantiles import approximate_quantiles, exact_quantiles, histogram

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("ranges", [2, 50, 1024])
@pytest.mark.parametrize("shape", ["smooth", "heavy", "few", "one", "wide"])
def test_quantiles_agree_with_numpy(spark, monkeypatch, shape, ranges):
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    rng = np.random.default_rng(3)
    values = {
        "smooth": rng.normal(100, 30, 5000),
        # A third of the rows hold one value, in the middle of a wide range.
        "heavy": np.where(rng.random(5000) < 0.34, 7.0, rng.exponential(1e6, 5000)),
        "few": np.array([3.0, 1.0, 2.0]),
        "one": np.array([5.0]),
        "wide": np.concatenate((10.0 ** rng.uniform(-200, 200, 60), [-1e308, 1e308, 0.0, 0.0])),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(6)
    got = {r.q: r.value for r in exact_quantiles(df, "v", QS).collect()}
    for q in QS:
        assert got[q] == pytest.approx(float(np.percentile(values, q * 100)), rel=1e-12)


def test_values_that_are_no_numbers_are_left_out(spark):
    df = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), float("-inf"), 1.0, 3.0, None)], "v double")
    assert [(r.q, r.value) for r in exact_quantiles(df, "v", [0.5]).collect()] == [(0.5, 2.0)]


def test_approximate_quantiles(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    got = {r.q: r.value for r in approximate_quantiles(df, "v", [0.1, 0.5], 1000).collect()}
    assert got[0.1] == pytest.approx(10_000, abs=200) and got[0.5] == pytest.approx(50_000, abs=200)
    assert approximate_quantiles(df.limit(0), "v", [0.5]).collect() == []


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).collect() == []


def test_histogram_agrees_with_numpy(spark):
    # One far value leaves bins empty.
    values = np.append(np.random.default_rng(5).gamma(2.0, 300.0, 3000), 9000.0)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = sorted(histogram(df, "v", 20).collect(), key=lambda r: r.bin)
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_from for r in rows] == pytest.approx(edges[:-1].tolist())
    assert 0 in counts


def test_histogram_of_one_value(spark):
    rows = histogram(spark.createDataFrame([(4.0,), (4.0,)], "v double"), "v", 20).collect()
    assert {r.bin: r.n for r in rows if r.n} == {10: 2}


SHAPES = {
    "uniform": lambda rng, n: rng.random(n),
    "log-uniform": lambda rng, n: np.exp(rng.uniform(-20, 20, n)),
    "wide": lambda rng, n: rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-150, 150, n),
    "ties": lambda rng, n: np.floor(rng.exponential(3, n)),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize(("ranges", "most", "passes"), [(10_000, 1 << 16, 2), (1_000, 500, 4)])
def test_few_passes_on_any_distribution(spark, monkeypatch, shape, ranges, most, passes):
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    monkeypatch.setattr(quantiles, "MOST_VALUES", most)
    made, read = [], quantiles._pass
    monkeypatch.setattr(quantiles, "_pass", lambda frame: made.append(1) or read(frame))
    values = SHAPES[shape](np.random.default_rng(8), 200_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = {r.q: r.value for r in exact_quantiles(df, "v", QS).collect()}
    for q in QS:
        assert got[q] == pytest.approx(float(np.percentile(values, q * 100)), rel=1e-12)
    assert len(made) <= passes


def test_bounds_that_miss_are_widened(spark, monkeypatch):
    """As if the sketch were off by more than it says."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", 100)
    narrow, spoilt = quantiles._Rank.narrow, []

    def spoil(self, shares, values):
        narrow(self, shares, values)
        if len(spoilt) < 3:
            spoilt.append(1)
            self.low = self.high

    monkeypatch.setattr(quantiles._Rank, "narrow", spoil)
    df = spark.range(50_000).select(F.col("id").cast("double").alias("v"))
    assert {r.q: r.value for r in exact_quantiles(df, "v", [0.25, 0.5]).collect()} == {0.25: 12499.75, 0.5: 24999.5}
