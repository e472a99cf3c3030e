"""Properties of the composite jobs that hold whatever was drawn."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions.draws import draw_truncated_normal
from txlab.operators import aggregates as A
from txlab.operators import joins as J
from txlab.operators import quantiles as Q
from txlab.operators import windows as W
from txlab.operators.joins import map_categories
from txlab.plans import banks as B
from txlab.plans import cases as C
from txlab.plans import catalogue as K
from txlab.plans import labels as L
from txlab.plans import months as M
from txlab.plans import report as P
from txlab.queries.jobs import CAPS
from txlab.sources import views
from txlab.sources.ledger import ledger
from txlab.sources.staging import stage

COLUMNS = ("tx_id", "customer_id", "tx_date", "category", "subcategory", "description", "amount", "tx_type")


@pytest.fixture(scope="module")
def full(spark, sf_dir):
    return stage(ledger(spark, sf_dir, (*COLUMNS, "fraud_type")))


@pytest.fixture(scope="module")
def plain(full):
    return full.filter(F.col("fraud_type") == S.NO_FRAUD).drop("fraud_type")


@pytest.fixture(scope="module")
def fraud(spark):
    # The small tables hold too few labelled rows of each kind, so take more of them.
    cases = ledger(spark, "/root/testdata/sf0.01", (*COLUMNS, "fraud_type"))
    return stage(cases.filter(F.col("fraud_type") != S.NO_FRAUD))


@pytest.fixture(scope="module")
def injected(plain, fraud):
    return stage(L.inject_labels(plain, fraud, high_per_month=0.2, other_per_month=0.1, strict=False))


def test_injection_flags_a_share_of_the_customers(plain, injected):
    customers = plain.select("customer_id").distinct().count()
    flagged = injected.filter("customer_scammed = 1").select("customer_id").distinct().count()
    assert flagged == int(customers * 0.3)
    both = injected.groupBy("customer_id").agg(F.count_distinct("customer_scammed").alias("n"))
    assert both.filter("n > 1").count() == 0


def test_injected_rows(plain, injected):
    rows = injected.filter(F.col("fraud_type") != S.NO_FRAUD)
    assert rows.count() > 0
    assert rows.filter((F.col("tx_type") != "spending") | (F.col("customer_scammed") != 1)).count() == 0
    assert rows.filter(F.col("fraud_type") == S.EXCLUDED_FRAUD_TYPE).count() == 0
    assert rows.filter("description IS NULL OR subcategory IS NULL OR amount IS NULL").count() == 0
    # Each falls on a date of the customer's own rows, and no case comes twice.
    assert rows.join(plain, ["customer_id", "tx_date"], "left_anti").count() == 0
    again = rows.groupBy("customer_id", "description", "amount", "subcategory").count()
    assert again.filter("count > 1").count() == 0
    kinds = rows.groupBy("customer_id").agg(
        F.count_distinct(F.col("fraud_type") == S.HIGH_INCOME_FRAUD_TYPE).alias("n")
    )
    assert kinds.filter("n > 1").count() == 0


def test_protected_rows_stay(plain, injected):
    protected = plain.filter(F.col("category").isin(*S.BILL_CATEGORIES))
    assert protected.join(injected, "tx_id", "left_anti").count() == 0
    assert injected.select("tx_id").distinct().count() == injected.count()


def test_removed_rows_lie_on_injected_dates(plain, injected):
    removed = plain.join(injected, "tx_id", "left_anti")
    placed = injected.filter(F.col("fraud_type") != S.NO_FRAUD)
    assert removed.count() > 0
    assert removed.join(placed, ["customer_id", "tx_date"], "left_anti").count() == 0
    sizes = placed.groupBy("customer_id").agg(F.count(F.lit(1)).alias("came"))
    gone = removed.groupBy("customer_id").agg(F.count(F.lit(1)).alias("went"))
    assert gone.join(sizes, "customer_id", "left").filter("came IS NULL OR went > came").count() == 0


def test_injection_does_not_depend_on_partitioning(plain, fraud, injected):
    again = L.inject_labels(
        plain.repartition(13), fraud.repartition(5), high_per_month=0.2, other_per_month=0.1, strict=False
    )
    assert again.exceptAll(injected).count() == 0 and injected.exceptAll(again).count() == 0


def test_injection_refuses_a_pool_that_is_too_small(plain, fraud):
    with pytest.raises(ValueError, match="fraud pool"):
        L.inject_labels(plain, fraud.limit(4), strict=False)


def test_injection_strictly(plain, fraud):
    with pytest.raises(ValueError, match="fewer rows"):
        L.inject_labels(plain, fraud, high_per_month=3, other_per_month=30)


def test_injection_at_its_defaults(spark):
    """Five rows a month for customers of high income and three for others, 0 to 2 less, against plain Python."""
    rng = random.Random(11)
    columns = "tx_id string, customer_id long, tx_date date, category string, subcategory string, description string, amount double, tx_type string"
    rows = []
    for customer in range(40):
        for month in range(1, 7):
            rows.append((f"i{customer}-{month}", customer, date(2024, month, 25), "Income", "s", "pay", 1000.0 + 7 * customer, "income"))
            for k in range(40):
                category = rng.choice(["Groceries", "Holiday", "Housing", "Utilities", None])
                day = date(2024, month, rng.randint(1, 28))
                rows.append((f"t{customer}-{month}-{k}", customer, day, category, "s", "d", rng.uniform(1, 90), "spending"))
    kinds = ["Romance"] * 150 + ["Purchase", "Investment"] * 100 + ["CEO"] * 20
    pool = [(f"c{k}", None, None, "Holiday", "f", f"fraud {k}", 50.0 + k, "spending", kind) for k, kind in enumerate(kinds)]
    ledger = spark.createDataFrame(rows, columns)
    cases = spark.createDataFrame(pool, columns + ", fraud_type string")
    out = L.inject_labels(ledger, cases).collect()
    chosen = {r.customer_id for r in out if r.customer_scammed}
    assert len(chosen) == 12
    cut = float(np.percentile([r[6] for r in rows if r[1] in chosen and r[3] == "Income"], 90))
    kind_of = {f"fraud {k}": kind for k, kind in enumerate(kinds)}
    known = {r[0]: r for r in rows}
    for customer in range(40):
        own = [r for r in out if r.customer_id == customer]
        placed = [r for r in own if r.fraud_type != S.NO_FRAUD]
        kept = {r.tx_id for r in own} - {r.tx_id for r in placed}
        gone = [r for r in rows if r[1] == customer and r[0] not in kept]
        if customer not in chosen:
            assert not placed and not gone
            continue
        high = 1000.0 + 7 * customer > cut
        total = (5 if high else 3) * 6
        dates = {r.tx_date for r in placed}
        open_rows = [r for r in rows if r[1] == customer and r[2] in dates and r[3] not in S.BILL_CATEGORIES]
        assert total - 2 <= len(placed) <= total and len(gone) == min(len(placed), len(open_rows)) > 0
        assert len({r.description for r in placed}) == len(placed)
        for r in placed:
            assert r.fraud_type == kind_of[r.description] and (r.fraud_type == "Romance") == high and r.fraud_type != "CEO"
        assert dates <= {r[2] for r in rows if r[1] == customer}
        assert all(r[2] in dates and r[3] not in S.BILL_CATEGORIES for r in gone)
        assert kept <= known.keys()
    assert {c > cut for c in (1000.0 + 7 * customer for customer in chosen)} == {True, False}


def test_replacement_removes_fewer(plain, fraud, injected):
    loose = L.inject_labels(plain, fraud, high_per_month=0.2, other_per_month=0.1, exact=False, strict=False)
    assert loose.count() > injected.count()


def test_bank_rules(full):
    banked = stage(B.assign_banks(full))
    assert banked.count() == full.count()
    cash = F.col("category") == S.CASH_WITHDRAWAL
    assert banked.filter(cash & F.col("bank_to").isNotNull()).count() == 0
    assert banked.filter(~cash & F.col("bank_to").isNull()).count() == 0
    assert banked.filter("bank_from IS NULL").count() == 0
    income = F.col("category") == S.INCOME
    utility = (F.col("category") == S.UTILITIES) & (F.col("fraud_type") == S.NO_FRAUD)
    own = banked.withColumn("own", B.draw_choice(S.BANKS, "customer_id", salt="own"))
    earned = (F.col("tx_type") == "income") & ~utility & ~cash
    assert own.filter((earned | income) & (F.col("bank_to") != F.col("own"))).count() == 0
    spent = (F.col("tx_type") == "spending") & ~income
    assert own.filter(spent & (F.col("bank_from") != F.col("own"))).count() == 0
    employers = banked.filter(income).groupBy("customer_id").agg(F.count_distinct("bank_from").alias("n"))
    assert employers.filter("n > 1").count() == 0


def test_own_account_descriptions_stay_inside(spark):
    rows = [
        ("a", 1, date(2024, 1, 5), "Transfers", "from Savings", "income", "none"),
        ("b", 1, date(2024, 1, 6), "Transfers", "Deposit", "spending", "none"),
        ("c", 1, date(2024, 1, 7), None, None, None, "none"),
    ]
    df = spark.createDataFrame(
        rows,
        "tx_id string, customer_id long, tx_date date, category string, description string, "
        "tx_type string, fraud_type string",
    )
    got = {r.tx_id: r for r in B.assign_banks(df).collect()}
    assert len(got) == 3 and got["c"].bank_to is not None
    assert got["a"].bank_to == got["a"].bank_from == got["b"].bank_to == got["b"].bank_from


def test_bills_keep_their_bank_every_month(spark):
    rows = [
        (f"{m}-{i}", c, date(2024, m, 1), f"bill {i}")
        for c in (1, 2) for m in (1, 2, 3) for i in range(5)
    ]
    df = spark.createDataFrame(rows, "tx_id string, customer_id long, tx_date date, description string")
    tiled = W.tile_by_position(df, S.BANKS, "bank_to")
    per_bill = tiled.groupBy("customer_id", "description").agg(F.count_distinct("bank_to").alias("n"))
    assert per_bill.filter("n <> 1").count() == 0 and per_bill.count() == 10


@pytest.fixture(scope="module")
def monthly(full):
    return stage(M.monthly_sample(full, CAPS))


def test_monthly_sample_keeps_to_the_caps(spark, full, monthly):
    month = F.trunc("tx_date", "MM").alias("m")
    caps = spark.createDataFrame(list(CAPS.items()), "category string, cap int")
    held = full.groupBy("customer_id", month, "category").agg(F.count(F.lit(1)).alias("held")).join(caps, "category")
    cells = monthly.groupBy("customer_id", month, "category").agg(F.count(F.lit(1)).alias("n"))
    assert held.join(cells, ["customer_id", "m", "category"], "left").filter("n IS NULL OR n <> least(held, cap)").count() == 0
    assert monthly.join(full, "tx_id", "left_anti").count() == 0


def test_recurring_bills(spark):
    rows = [("a", 1, date(2024, 2, 10), "Utilities", "gas"), ("b", 1, date(2024, 2, 12), "Income", "pay"),
            ("c", 1, date(2024, 3, 3), "Utilities", "old"), ("d", 1, date(2024, 4, 3), "Holiday", "sun"),
            ("e", 1, date(2024, 2, 2), "Holiday", "sea"), ("f", 1, None, "Utilities", "lost"), ("g", 1, None, None, None)]
    df = spark.createDataFrame(rows, "tx_id string, customer_id long, tx_date date, category string, description string")
    got = sorted(((r.tx_id, r.tx_date) for r in M.recurring_bills(df).collect()), key=str)
    expected = [
        ("a", date(2024, 2, 2)), ("a#1", date(2024, 3, 1)), ("a#2", date(2024, 4, 1)),
        ("b", date(2024, 2, 23)), ("b#1", date(2024, 3, 29)), ("b#2", date(2024, 4, 26)),
        ("d", date(2024, 4, 3)), ("e", date(2024, 2, 2)), ("f", None), ("g", None),
    ]
    assert got == sorted(expected, key=str)


def test_months_count_in_each_year(spark, fraud):
    """Two years of a month are two months."""
    rows = [(f"t{i}", 1, date(2023 + i % 2, 1, 5 + i), "Groceries", "s", "d", 5.0, "spending") for i in range(12)]
    df = spark.createDataFrame(rows, "tx_id string, customer_id long, tx_date date, category string, subcategory string, description string, amount double, tx_type string")
    placed = L.inject_labels(df, fraud, share=1.0, high_per_month=4, other_per_month=4).filter("fraud_type <> 'none'").count()
    assert placed in (6, 7, 8)


def test_carry_forward_of_one_month(spark):
    df = spark.createDataFrame(
        [("a", "Income", date(2024, 1, 5)), ("b", "Holiday", date(2024, 1, 6))],
        "tx_id string, category string, tx_date date",
    )
    assert J.carry_forward(df, S.BILL_CATEGORIES).exceptAll(df).count() == 0


def test_expanded_catalogue_stays_in_bounds(spark, sf_dir):
    texts = views.catalogue(spark, sf_dir)
    rows = ledger(spark, sf_dir, ("tx_id", "amount"))
    expanded = stage(K.expand_catalogue(texts, rows))
    assert expanded.count() == rows.filter("amount >= 1").count()
    bounds = texts.select("category", "subcategory", "description", "min", "max")
    checked = expanded.join(bounds, ["category", "subcategory", "description"])
    assert checked.count() == expanded.count()
    assert checked.filter("amount < min - 0.01 OR amount > max + 0.01").count() == 0


def test_blend_sizes(spark, sf_dir):
    cases = stage(views.cases(spark, "/root/testdata/sf0.01").filter("category <> 'Housing'"))
    mapping = {"Romance": ["Housing"], "Purchase": ["Groceries"]}
    mapped = stage(map_categories(views.texts(spark, sf_dir), mapping))
    result = stage(C.blend_descriptions(cases, mapped))
    copies = result.filter("data_ver = 'non_fraud'")
    sizes = {r["category"]: r["count"] for r in copies.groupBy("category").count().collect()}
    assert sizes == {
        "Groceries": cases.filter("category = 'Groceries'").count() // 2,
        "Housing": mapped.filter("category = 'Housing'").count(),
    }
    assert result.count() == cases.count() + copies.count()
    assert copies.filter("subcategory IS NULL").count() == 0
    housing = copies.filter("category = 'Housing'")
    assert housing.select("case_key").distinct().count() == housing.count()


def test_blend_with_too_few_cases(spark):
    """20 catalogue rows and 6 cases: an error, or with replacement 20 copies."""
    cases = [(f"k{i}", i, 5.0, "Romance", "Pets", "text") for i in range(6)]
    cases = spark.createDataFrame(cases, "case_key string, case_id long, transaction_value double, fraud_type string, category string, description string")
    mapped = [("Romance", "Housing", "s", f"rent {i}") for i in range(20)]
    mapped = spark.createDataFrame(mapped, "fraud_type string, category string, subcategory string, description string")
    with pytest.raises(ValueError, match="20 cases are to be copied, there are 6"):
        C.blend_descriptions(cases, mapped)
    copies = C.blend_descriptions(cases, mapped, replace=True).filter("data_ver = 'non_fraud'")
    assert copies.count() == 20 and copies.select("case_key").distinct().count() <= 6


def test_thinning_sizes(spark, sf_dir):
    cases = views.cases(spark, "/root/testdata/sf0.01").withColumn("subcategory", F.lit(None).cast("string"))
    texts = views.texts(spark, sf_dir).withColumn("description", F.concat(F.lit("rewritten "), "description"))
    result = stage(C.thin_and_rewrite(cases, texts, ["Groceries", "Income"]))
    for category in ("Groceries", "Income", "Housing"):
        before = cases.filter(F.col("category") == category).count()
        after = result.filter(F.col("category") == category)
        rewritten = after.filter(F.col("description").startswith("rewritten ")).count()
        kept = before // 3
        expected = (before, 0) if category == "Housing" else (kept, kept * 5 // 6)
        assert (after.count(), rewritten) == expected


def test_final_cases_drop_small_values_and_total_the_rest(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.99), ("b", 1, 1.0), ("c", 1, 1.01), ("d", 1, 2.0), ("e", None, 5.0)],
        "case_key string, case_id long, transaction_value double",
    ).withColumn("case_value", F.lit(99.0))
    got = {r.case_key: r.case_value for r in C.finalise_cases(df).collect()}
    assert got == {"c": 3.01, "d": 3.01, "e": None}


def test_anti_join_ignores_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("b",)], "tx_id string")
    gone = spark.createDataFrame([("a",), ("a",)], "tx_id string")
    assert [r.tx_id for r in J.remove_rows(df, gone, ["tx_id"]).collect()] == ["b"]


def test_rows_without_a_case_are_spread(spark):
    """Nine of ten rows have no case; no task gets them all, without adaptive execution."""
    df = spark.range(20_000).select(
        F.col("id").alias("tx_id"), F.when(F.col("id") % 10 == 0, F.col("id") % 700).alias("case_id"), F.lit(2.0).alias("amount")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = W.group_total_on_rows(df)
        parts = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        rows = got.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(parts) > 4 and max(parts) < 2 * sum(parts) / len(parts)
    assert {*got.columns} == {*df.columns, "group_total"} and len(rows) == 20_000
    sizes = {c: sum(r.case_id == c for r in rows) for c in {r.case_id for r in rows} if c is not None}
    assert all(r.group_total == (None if r.case_id is None else 2.0 * sizes[r.case_id]) for r in rows)


def test_merge_by_number(spark):
    """n equal rows and m give max(n, m), missing values being equal."""
    a = spark.createDataFrame([("x", None, 3), ("x", None, 1), ("x", None, 1), ("y", "k", 2)], "t string, b string, n int")
    b = spark.createDataFrame([("x", None, "q"), ("x", None, "p"), ("z", "k", "r"), ("z", "k", "r")], "t string, b string, m string")
    expected = [("x", None, 1, "p"), ("x", None, 1, "q"), ("x", None, 3, None), ("y", "k", 2, None), ("z", "k", None, "r"), ("z", "k", None, "r")]
    got = J.merge_matched(a, b)
    assert got.columns == ["t", "b", "n", "m"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert J.merge_common(a, b).count() == 3 * 2 + 1 + 2
    hot = spark.range(3000).select(F.lit("x").alias("t"))
    assert J.merge_matched(hot, hot.limit(1000)).count() == 3000


def test_merge_matches_missing_values(spark):
    a = spark.createDataFrame([("x", None, 1), ("y", "k", 2)], "t string, b string, n int")
    b = spark.createDataFrame([("x", None, "p"), ("z", None, "q")], "t string, b string, m string")
    got = sorted(tuple(r) for r in J.merge_common(a, b).collect())
    assert got == [("x", None, 1, "p"), ("y", "k", 2, None), ("z", None, None, "q")]


def test_customer_without_income_is_not_high(spark):
    df = spark.createDataFrame(
        [("a", 1, date(2024, 1, 1), "Income", 10.0), ("b", 2, date(2024, 1, 1), "Housing", 99.0),
         ("c", 1, date(2024, 1, 2), "Income", 5.0)],
        "tx_id string, customer_id long, tx_date date, category string, amount double",
    )
    got = {r.customer_id: (r.first_income, r.high_income) for r in W.income_rank_flag(df).collect()}
    assert got == {1: (10.0, True), 2: (None, False)}


def test_flows_leave_out_missing_banks(spark):
    df = spark.createDataFrame(
        [("A", "B"), ("A", "B"), ("A", None), ("B", "A")], "bank_from string, bank_to string"
    )
    nodes, edges = P.flow_graph(df)
    assert sorted(tuple(r) for r in nodes.collect()) == [
        (0, "sender", "A"), (1, "sender", "B"), (2, "receiver", "A"), (3, "receiver", "B"),
    ]
    assert sorted(tuple(r)[:2] + (r.n,) for r in edges.collect()) == [(0, 3, 2), (1, 2, 1)]


def test_rows_without_a_customer_stay(spark):
    rows = [
        ("a", None, date(2024, 1, 5), "Income", "pay", "income", "none"),
        ("b", None, date(2024, 1, 6), "Income", "pay", "income", "none"),
        ("c", None, date(2024, 1, 7), "Utilities", "gas", "spending", "none"),
        ("d", 1, date(2024, 1, 7), "Utilities", "gas", "spending", "none"),
    ]
    df = spark.createDataFrame(
        rows,
        "tx_id string, customer_id long, tx_date date, category string, description string, "
        "tx_type string, fraud_type string",
    )
    for source in ("own", "employer"):
        got = {r.tx_id: r for r in B.assign_banks(df, utilities_from=source).collect()}
        assert sorted(got) == ["a", "b", "c", "d"]
        assert got["a"].bank_from == got["b"].bank_from
    taken = W.first_value_broadcast(df, F.col("category") == "Income", "tx_type")
    assert taken.count() == 4


def test_rows_without_a_pool_stay(spark):
    cases = spark.createDataFrame(
        [("a", 1, 500.0, "Romance"), ("b", 1, 700.0, "Unknown")],
        "case_key string, case_id long, transaction_value double, fraud_type string",
    )
    pool = spark.createDataFrame(
        [("Romance", "Dinner", "Dining out")], "fraud_type string, description string, category string"
    )
    got = {r.case_key: r for r in C.describe_cases(cases, pool).collect()}
    assert (got["a"].transaction_value, got["a"].category) == (5.0, "Dining Out")
    assert (got["b"].transaction_value, got["b"].category) == (7.0, None)


def test_one_customer_with_a_third_of_all_rows(spark, sf_dir, fraud):
    """The jobs give the same rows of a skewed ledger, however it is dealt out."""
    tx = ledger(spark, sf_dir, COLUMNS)
    hot = F.when(F.pmod(F.hash("tx_id"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("customer_id"))
    skewed = stage(tx.withColumn("customer_id", hot.cast("long")).withColumn("fraud_type", F.lit("none")))
    share = skewed.filter("customer_id = 7").count() / skewed.count()
    assert share > 0.3
    one, other = stage(B.assign_banks(skewed)), stage(B.assign_banks(skewed.repartition(17)))
    assert one.exceptAll(other).count() == 0 and one.count() == other.count()
    injected = L.inject_labels(
        skewed.drop("fraud_type"), fraud, share=1.0, high_per_month=0.2, other_per_month=0.1, strict=False
    )
    months = skewed.select(F.trunc("tx_date", "MM")).distinct().count()
    came = injected.filter("customer_id = 7 AND fraud_type <> 'none'").count()
    assert came in {int(rate * months) - less for rate in (0.1, 0.2) for less in (0, 1, 2)}


def test_amounts_are_added_unrounded(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("amount"), F.lit("spending").alias("tx_type"), F.lit("none").alias("fraud_type"), F.lit(1).alias("case_id"))
    assert A.spend_total(small, "non-fraud").first()["spent"] == 4.0
    assert A.group_totals(small, value="amount").first()["case_value"] == pytest.approx(4.0)


def test_decimal_amounts(spark, sf_dir):
    """The ledger's operators give the same results on decimal amounts."""
    schema = S.with_decimal_amounts(S.LEDGER)
    assert "amount decimal(18,2)" in schema and "double" not in schema
    tx = ledger(spark, sf_dir)
    exact = tx.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    for label in ("fraud", "non-fraud"):
        for result in (A.spend_total, A.category_average):
            assert result(exact, label).collect() == result(tx, label).collect()
    assert B.vary_amounts(exact).count() == tx.count()
    low, high = (sorted(r.value for r in Q.exact_quantiles(x, "amount", [0.1, 0.9]).collect()) for x in (exact, tx))
    assert low == high


def test_small_things(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert tuple(A.distinct_counts(empty, ["a", "b"]).first()) == (0, 0)
    left = spark.createDataFrame([(1, date(2024, 1, 1), True)], "k int, v date, w boolean")
    right = spark.createDataFrame([(2.5, 7, "x")], "k double, v int, w string")
    got = sorted(tuple(r) for r in J.union_relaxed(left, right).collect())
    assert got == [(1.0, "2024-01-01", "true"), (2.5, "7", "x")]
    table = J.lookup(left, "k", {1: date(2020, 1, 1)}, "day")
    assert table.first()["day"] == date(2020, 1, 1)
    with pytest.raises(Exception, match="no flag for 1"):
        J.lookup(left, "k", {2: True}, "flag").collect()
    gaps = [(1, date(2024, 1, 31)), (1, date(2024, 3, 1)), (2, None), (3, date(2023, 12, 5))]
    frames = J.skeleton(spark.createDataFrame(gaps, "c long, tx_date date"), ["c"]).collect()
    assert sorted((r.c, r.month_start.isoformat(), r.month_end.day) for r in frames) == [
        (1, "2024-01-01", 31), (1, "2024-02-01", 29), (1, "2024-03-01", 31), (3, "2023-12-01", 31),
    ]
    approximate = A.approximate_distinct_counts(spark.range(5000).withColumn("n", F.lit(None).cast("int")), ["id", "n"]).first()
    assert approximate["id"] == pytest.approx(5000, rel=0.1) and approximate["n"] == 1


def test_truncated_normal_at_its_edges(spark):
    rows = spark.createDataFrame([(1, 5.0, 5.0, 5.0), (2, None, 1.0, 0.5)], "k int, low double, high double, mean double")
    drawn = rows.select(draw_truncated_normal("low", "high", "mean", "k", salt="s").alias("x")).collect()
    assert [r.x for r in drawn] == [5.0, None]
    far = rows.filter("k = 1").withColumn("high", F.lit(6.0)).withColumn("mean", F.lit(900.0))
    with pytest.raises(Exception, match="no draw between"):
        far.select(draw_truncated_normal("low", "high", "mean", "k", salt="s").alias("x")).collect()


def test_injection_with_a_written_draw_is_the_same(plain, fraud, injected):
    drawn = plain.withColumn("_drawn", L.customer_draw())
    again = L.inject_labels(
        drawn, fraud, high_per_month=0.2, other_per_month=0.1, strict=False, drawn="_drawn", written=True
    )
    assert again.columns == injected.columns
    assert again.count() == injected.count()
    assert again.exceptAll(injected).count() == 0


def test_the_final_table_writes_its_ledger_once(spark, monkeypatch):
    from txlab.plans import labels
    from txlab.queries import jobs

    written = {jobs: [], labels: []}
    for module, tables in written.items():
        monkeypatch.setattr(module, "stage", lambda df, tables=tables: tables.append(stage(df)) or tables[-1])
    rows = jobs.final_bank_data(spark, "/root/testdata/sf0.01").count()
    assert len(written[jobs]) == 1
    assert max(table.count() for table in written[labels]) < 0.5 * rows
