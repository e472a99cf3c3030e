"""Ranking by ranges and sampling against plain windows, with hot, tiny and missing groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlab.functions.draws import uniform
from txlab.operators import sampling as SA
from txlab.operators.joins import zip_columns
from txlab.operators.ranking import mark_lowest, rank_in_group


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer holds a third of the rows, a missing one a tenth, and one day is hot."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        pick = rng.random()
        customer = 1 if pick < 0.34 else None if pick < 0.44 else rng.randrange(2, 400)
        day = "2024-01-01" if rng.random() < 0.6 else f"2024-01-{rng.randrange(2, 29):02d}"
        rows.append((f"t{i}", customer, None if rng.random() < 0.02 else day))
    return spark.createDataFrame(rows, "tx_id string, customer_id long, day string").cache()


@pytest.fixture(params=[1, 3, 40])
def parts(request, spark):
    """Rows are dealt out to so many parts, however few there are."""
    settings = {
        "spark.sql.shuffle.partitions": str(request.param),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize(
    ("by", "prefix"),
    [(["customer_id"], []), ([], []), (["customer_id", "day"], []), (["customer_id"], ["day"]), ([], ["day"]),
     # A prefix that is different in every row, also of the hot group.
     (["customer_id"], ["text"])],
)
def test_rank_is_the_plain_windows(skewed, parts, by, prefix):
    skewed = skewed.withColumn("text", F.md5("tx_id"))
    window = Window.partitionBy(*by).orderBy(*prefix, uniform("tx_id", salt="rank"), "tx_id")
    expected = skewed.withColumn("rank", F.row_number().over(window).cast("long"))
    got = rank_in_group(skewed, by, ["tx_id"], prefix=prefix)
    assert got.columns == expected.columns
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


@pytest.mark.parametrize("by", [["customer_id"], []])
@pytest.mark.parametrize("share", [(0, 1), (1, 3), (5, 6), (1, 1)])
def test_fraction_is_the_plain_windows(skewed, by, share):
    window = Window.partitionBy(*by)
    rank = F.row_number().over(window.orderBy(uniform("tx_id", salt="fraction"), "tx_id"))
    quota = F.floor(F.count(F.lit(1)).over(window) * share[0] / share[1])
    expected = skewed.withColumn("r", rank).withColumn("q", quota).filter("r <= q").drop("r", "q")
    got = SA.sample_fraction(skewed, by, *share, ["tx_id"])
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_marking_keeps_every_row(skewed):
    marked = mark_lowest(skewed, ["customer_id"], ["tx_id"], lambda n: F.lit(5), "m")
    assert marked.count() == skewed.count()
    per_group = marked.groupBy("customer_id").agg(
        F.count_if("picked").alias("k"), F.count(F.lit(1)).alias("n")
    )
    assert per_group.filter("k <> least(5, n)").count() == 0


def test_no_task_sorts_a_whole_group(skewed, parts):
    """A part holds its share of the rows, whichever groups they are of; a group has a row for each part it is in."""
    from txlab.operators import ranking

    seen = []
    stage, ranking.stage = ranking.stage, lambda df: seen.append(stage(df)) or seen[-1]
    try:
        rank_in_group(skewed, ["customer_id"], ["tx_id"])
    finally:
        ranking.stage = stage
    held = seen[0].groupBy(F.expr("_id >> 33").alias("part")).count()
    sizes = held.agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 3 * skewed.count() / parts
    assert seen[1].count() <= skewed.select("customer_id").distinct().count() + sizes[1]


def test_ranks_are_hash_aggregates(skewed):
    """One shuffle of the rows, and two of a number for each group and part."""
    from txlab.operators import ranking

    plans = []
    stage, ranking.stage = ranking.stage, lambda df: plans.append(df._jdf.queryExecution().toString()) or stage(df)
    try:
        last = rank_in_group(skewed, ["customer_id"], ["tx_id"])._jdf.queryExecution().toString()
    finally:
        ranking.stage = stage
    physical = [p.split("== Physical Plan ==")[1] for p in [*plans, last]]
    assert not any("SortAggregate" in p for p in physical)
    assert [p.count("Exchange rangepartitioning") + p.count("Exchange hashpartitioning") for p in physical] == [1, 2, 0]


def test_limits_beyond_sparks_own(skewed):
    """A limit above the one to which Spark cuts groups in each task gives the same rows."""
    for n in (999, 1500):
        window = Window.partitionBy("customer_id").orderBy(uniform("tx_id", salt="sample"), "tx_id")
        expected = skewed.withColumn("n", F.row_number().over(window)).filter(f"n <= {n}").drop("n")
        got = SA.sample_n(skewed, ["customer_id"], n, ["tx_id"])
        assert got.count() == expected.count() and got.exceptAll(expected).count() == 0


def test_seeds(skewed):
    """The default seed's rows stay, another one draws others."""
    for draw in (
        lambda seed: SA.sample_n(skewed, ["day"], 5, ["tx_id"], seed=seed),
        lambda seed: SA.sample_fraction(skewed, ["day"], 1, 4, ["tx_id"], seed=seed),
        lambda seed: SA.select_entities(skewed, "customer_id", 0.3, seed=seed),
        lambda seed: SA.sample_share(skewed, 0.3, ["tx_id"], seed=seed),
    ):
        assert draw(42).exceptAll(draw(42)).count() == 0
        assert draw(7).exceptAll(draw(42)).count() > 0


def test_share(skewed):
    assert abs(SA.sample_share(skewed, 0.25, ["tx_id"]).count() / skewed.count() - 0.25) < 0.03


def test_sample_n(skewed):
    sample = SA.sample_n(skewed, ["customer_id"], 3, ["tx_id"])
    sizes = skewed.groupBy("customer_id").count().select(F.least("count", F.lit(3))).groupBy().sum().first()[0]
    assert sample.count() == sizes
    assert sample.exceptAll(SA.sample_n(skewed.repartition(11), ["customer_id"], 3, ["tx_id"])).count() == 0
    with pytest.raises(ValueError):
        SA.sample_n(skewed, ["customer_id"], 1000, ["tx_id"], strict=True)


def test_selected_entities(skewed):
    known = skewed.filter("customer_id IS NOT NULL")
    total = known.select("customer_id").distinct().count()
    chosen = SA.select_entities(known, "customer_id", 0.3)
    assert chosen.count() == int(total * 0.3)
    member = SA.is_selected(known, "customer_id", 0.3)
    kept = known.filter(member).select("customer_id").distinct()
    assert kept.exceptAll(chosen).count() == 0 and kept.count() == chosen.count()
    assert known.filter(~member).count() + known.filter(member).count() == known.count()
    assert known.filter(SA.is_selected(known, "customer_id", 0.0)).count() == 0


def test_pool_positions_are_dense(skewed):
    pool = SA.index_pool(skewed, ["customer_id"], ["tx_id"])
    bad = pool.rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("_pos").alias("a"), F.max("_pos").alias("b"), F.count_distinct("_pos").alias("d")
    ).filter("a <> 0 OR b <> n - 1 OR d <> n")
    assert bad.count() == 0


@pytest.mark.parametrize("size", [1, 10, 1000003, 2 * 1000003, 997])
def test_distinct_positions_do_not_repeat(spark, size):
    draws = min(size, 500)
    df = spark.range(20).crossJoin(spark.range(draws).withColumnRenamed("id", "draw"))
    at = df.select("id", SA.distinct_position(F.lit(size), F.col("draw"), "id", salt="s").alias("p"))
    bad = at.groupBy("id").agg(F.count_distinct("p").alias("d"), F.min("p").alias("a"), F.max("p").alias("b"))
    assert bad.filter(f"d <> {draws} OR a < 0 OR b >= {size}").count() == 0


def test_cells_with_one_start_draw_differently(spark):
    df = spark.range(400).crossJoin(spark.range(6).withColumnRenamed("id", "draw"))
    at = df.select("id", "draw", SA.distinct_position(F.lit(50), F.col("draw"), "id", salt="s").alias("p"))
    picks = at.groupBy("id").agg(F.min_by("p", "draw").alias("start"), F.sort_array(F.collect_list("p")).alias("all"))
    again = picks.groupBy("start").agg(F.count_distinct("all").alias("n"), F.count("*").alias("cells")).filter("cells > 4")
    assert again.count() > 20 and again.filter("n < 3").count() == 0


def test_zip_pairs_by_position(skewed):
    left = skewed.select("tx_id")
    right = skewed.filter("customer_id = 1").select(F.col("tx_id").alias("other"))
    with pytest.raises(ValueError, match="rows"):
        zip_columns(left, right, ["tx_id"], ["other"])
    pairs = zip_columns(left, right, ["tx_id"], ["other"], how="full")
    assert pairs.count() == left.count() == pairs.select("tx_id").distinct().count()
    assert pairs.filter("other IS NOT NULL").select("other").distinct().count() == right.count()
    assert pairs.filter("other IS NULL").agg(F.min("position")).first()[0] == right.count() + 1
    same = zip_columns(left, left.withColumnRenamed("tx_id", "other"), ["tx_id"], ["other"])
    assert same.filter("tx_id IS NULL OR other IS NULL").count() == 0 and same.count() == left.count()


@pytest.mark.parametrize("small", [1, 40, 100_000])
def test_small_groups_have_the_same_ranks(skewed, small):
    for by in (["customer_id"], ["customer_id", "day"]):
        expected = rank_in_group(skewed, by, ["tx_id"], prefix=["day"])
        got = rank_in_group(skewed, by, ["tx_id"], prefix=["day"], small=small)
        assert got.dtypes == expected.dtypes
        assert got.count() == skewed.count()
        assert got.exceptAll(expected).count() == 0


def test_tiles_write_no_rows_of_small_groups(skewed, monkeypatch):
    from txlab.operators import ranking
    from txlab.operators.windows import tile_by_position

    written, stage = [], ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df: written.append(stage(df)) or written[-1])
    dated = skewed.selectExpr("tx_id", "customer_id", "date(day) AS tx_date", "day AS description")
    assert tile_by_position(dated, ["a", "b"], "bank").count() == skewed.count()
    assert sum(table.count() for table in written) == 0
