"""Reports per fraud label: flows, averages, spend and customer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.functions import columns as C
from txlab.operators.aggregates import averaged_rows, bank_flows, scammed_counts
from txlab.operators.ranking import rank_in_group
from txlab.operators.rows import split_label
from txlab.sources.staging import stage


def label_summary(
    tx: DataFrame, customers: DataFrame, label: str, amount: str = "amount"
) -> dict[str, DataFrame]:
    """The four results of a label, from one pass over ``tx``.

    ``tx`` is first folded to one row per combination of the grouping columns.
    That table does not grow with the number of transactions, and flows,
    averages and spend are read off it.  ``customers``: customer_id and
    customer_scammed.
    """
    keys = ["bank_from", "bank_to", "category", "tx_type"]
    folded = stage(
        split_label(tx, label)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(C.money(amount)).alias("total"),
            F.count(amount).alias("amounts"),
        )
    )
    flows = (
        folded.filter(F.col("bank_from").isNotNull() & F.col("bank_to").isNotNull())
        .groupBy("bank_from", "bank_to")
        .agg(F.sum("rows").alias("n"))
    )
    mean = F.try_divide(F.sum("total").cast("double"), F.sum("amounts"))
    averages = (
        folded.filter(averaged_rows(label) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(mean.alias("_mean"))
        .orderBy(F.desc("_mean"), "category")
        .select("category", C.half_even("_mean").alias("average"))
    )
    spent = F.coalesce(F.sum("total").cast("double"), F.lit(0.0))
    spend = folded.filter("tx_type = 'spending'").agg(C.half_even(spent).alias("spent"))
    return {
        "flows": flows,
        "averages": averages,
        "spend": spend.withColumn("text", C.spent_text("spent")),
        "customers": scammed_counts(customers),
    }


def summary_table(summary: dict[str, DataFrame]) -> DataFrame:
    """The four results as one long table (section, item, value)."""

    def section(name: str, df: DataFrame, item, value) -> DataFrame:
        return df.select(
            F.lit(name).alias("section"), item.alias("item"), value.cast("double").alias("value")
        )

    return (
        section(
            "flows", summary["flows"], F.concat_ws(" > ", "bank_from", "bank_to"), F.col("n")
        )
        .unionByName(section("averages", summary["averages"], F.col("category"), F.col("average")))
        .unionByName(section("spend", summary["spend"], F.col("text"), F.col("spent")))
        .unionByName(
            section("customers", summary["customers"], F.col("customer_scammed"), F.col("customers"))
        )
    )


def flow_graph(tx: DataFrame, label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (node_id, side, bank) and edges (source_id, target_id, n) with dense ids.

    Senders come first, then receivers, each in name order.
    """
    flows = stage(bank_flows(tx, label))
    sides = (
        flows.select(F.lit(0).alias("_side"), F.col("bank_from").alias("bank"))
        .unionByName(flows.select(F.lit(1).alias("_side"), F.col("bank_to").alias("bank")))
        .distinct()
    )
    ranked = rank_in_group(sides, [], ["_side", "bank"], prefix=["_side", "bank"], name="_rank")
    nodes = ranked.select(
        (F.col("_rank") - 1).alias("node_id"),
        F.when(F.col("_side") == 0, "sender").otherwise("receiver").alias("side"),
        "bank",
    )

    def ids(side: str, bank: str, name: str) -> DataFrame:
        return nodes.filter(F.col("side") == side).select(
            F.col("bank").alias(bank), F.col("node_id").alias(name)
        )

    edges = (
        flows.join(ids("sender", "bank_from", "source_id"), "bank_from")
        .join(ids("receiver", "bank_to", "target_id"), "bank_to")
        .select("source_id", "target_id", "bank_from", "bank_to", "n")
    )
    return nodes, edges
