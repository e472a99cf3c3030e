"""Catalogue, case and customer tables derived from the ledger view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlab.functions.columns import money_mean
from txlab.sources.ledger import ledger, table
from txlab.sources.staging import stage

# Catalogue bounds are in thousands, so that some draws fall under one unit.
CATALOGUE_UNIT = 1000.0


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts with the amount bounds (min, max, mean) of their subcategory."""
    rows = ledger(spark, sf_dir, ("subcategory", "amount"))
    unit = F.lit(CATALOGUE_UNIT)
    bounds = rows.groupBy("subcategory").agg(
        (F.min("amount") / unit).alias("min"),
        (F.max("amount") / unit).alias("max"),
        (money_mean("amount") / unit).alias("mean"),
    )
    return stage(texts(spark, sf_dir).join(bounds, "subcategory"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct texts of the ledger, written once as a catalogue would be."""
    columns = ("category", "subcategory", "description")
    return stage(ledger(spark, sf_dir, columns).distinct())


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows as case rows; a case is an order, values are in pence."""
    columns = ("tx_id", "case_id", "amount", "fraud_type", "category", "description", "labelled")
    return (
        ledger(spark, sf_dir, columns)
        .filter("labelled")
        .drop("labelled")
        .withColumnsRenamed({"tx_id": "case_key", "amount": "transaction_value"})
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select(F.col("c_custkey").alias("customer_id"))


def customer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: whether any of its rows is labelled."""
    rows = ledger(spark, sf_dir, ("customer_id", "labelled"))
    return rows.groupBy("customer_id").agg(
        F.max(F.col("labelled").cast("int")).alias("customer_scammed")
    )
