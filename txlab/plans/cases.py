"""Preparing fraud cases: descriptions, blending with ordinary texts, thinning, totals.

A case table has: case_key (unique), case_id, transaction_value, fraud_type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import columns as C
from txlab.functions.draws import SEED, draw_index
from txlab.operators.aggregates import group_totals
from txlab.operators.joins import attach_total
from txlab.operators.ranking import rank_in_group
from txlab.operators.sampling import (
    at_position,
    distinct_position,
    index_pool,
    integer_share,
    pick,
    sample_fraction,
)
from txlab.sources.staging import stage

_TEXTS = ("description", "category")


def describe_cases(
    cases: DataFrame,
    pool: DataFrame,
    key: str = "case_key",
    synonyms: Mapping[str, str] = S.CATEGORY_SYNONYMS,
    seed: int = SEED,
) -> DataFrame:
    """Pence to pounds, and a random (description, category) of the row's fraud type.

    A row whose type has no texts stays without.
    """
    indexed = index_pool(pool, ["fraud_type"], _TEXTS, salt="texts", seed=seed)
    pounds = cases.withColumn("transaction_value", F.col("transaction_value") / F.lit(100))
    described = pick(pounds, indexed, [key], "describe", _TEXTS, how="left", seed=seed)
    return described.withColumn("category", C.normalised("category", synonyms))


def blend_descriptions(
    cases: DataFrame,
    mapped: DataFrame,
    key: str = "case_key",
    mapped_key: Sequence[str] = ("fraud_type", "category", "subcategory", "description"),
    replace: bool = False,
    seed: int = SEED,
) -> DataFrame:
    """Append copies of sampled cases that carry ordinary descriptions.

    ``mapped``: catalogue rows tagged with a fraud type.  Per mapped category,
    half of the cases in it are copied; a category without cases copies as many
    random cases as the catalogue has rows for it, which is an error if there are
    fewer cases, or with ``replace`` draws cases again.  A copy takes description,
    fraud_type, category and subcategory of a random catalogue row.  All
    categories are done in one pass over the original cases.
    """
    pool = index_pool(mapped, ["category"], mapped_key, salt="mapped", seed=seed)
    # One row per mapped category, with the number of cases in it.
    sizes = cases.groupBy("category").agg(F.count(F.lit(1)).alias("_cases"))
    targets = stage(
        pool.sizes.join(sizes, "category", "left").select(
            "category", "_pool_size", F.coalesce("_cases", F.lit(0)).alias("_cases")
        )
    )
    halves = sample_fraction(
        cases.join(targets.select("category"), "category", "left_semi"), ["category"], 1, 2, [key], "blend", seed
    )
    take = ["description", "fraud_type", "subcategory"]
    copies = pick(halves.withColumn("_draw", F.lit(0).cast("long")), pool, [key, "_draw"], "blend-text", take, seed=seed)

    empty = targets.filter("_cases = 0")
    most = empty.agg(F.max("_pool_size")).first()[0]
    if most:
        everyone = index_pool(cases, [], [key], salt="cases", seed=seed)
        held = everyone.sizes.first()["_pool_size"]
        if most > held and not replace:
            raise ValueError(f"{most} cases are to be copied, there are {held}")
        # One copy for each catalogue row of the category, which its position numbers.
        wanted = pool.rows.join(empty.select("category"), "category", "left_semi").select(
            F.col("category").alias("_target"), (F.col("_pos") + 1).alias("_draw")
        )
        size = F.lit(held)
        if replace:
            position = draw_index(size, "_target", "_draw", salt="blend-any", seed=seed)
        else:
            position = distinct_position(size, F.col("_draw") - 1, "_target", salt="blend-any", seed=seed)
        drawn = at_position(wanted.withColumn("_pos", position), everyone, cases.columns)
        drawn = drawn.drop("category").withColumnRenamed("_target", "category")
        copies = copies.unionByName(pick(drawn, pool, [key, "_draw"], "blend-text", take, seed=seed))
    copies = copies.drop("_draw").withColumn("data_ver", F.lit("non_fraud"))
    return cases.unionByName(copies, allowMissingColumns=True)


def thin_and_rewrite(
    cases: DataFrame,
    texts: DataFrame,
    categories: Sequence[str] = S.REWRITE_CATEGORIES,
    key: str = "case_key",
    seed: int = SEED,
) -> DataFrame:
    """Keep a third of the rows not yet rewritten in some categories and rewrite most of that third.

    A row without a subcategory still has its first description.  Of the kept
    third floor(n / 1.2) rows, that is n * 5 div 6, the lowest in the same order,
    take a random catalogue description of their category; all other rows stay.
    """
    is_target = F.coalesce(
        F.col("category").isin(*categories) & F.col("subcategory").isNull(), F.lit(False)
    )
    # Both limits are by the same order of a category's rows, so one ranking serves them.
    sizes = stage(cases.filter(is_target).groupBy("category").agg(F.count(F.lit(1)).alias("_size")))
    ranked = rank_in_group(cases.filter(is_target), ["category"], [key], salt="thin", name="_rank", seed=seed)
    kept = F.floor(F.col("_size") / 3)
    marked = stage(
        ranked.join(sizes, "category")
        .filter(F.col("_rank") <= kept)
        .withColumn("_rewrite", F.col("_rank") <= integer_share(5, 6)(kept))
        .drop("_rank", "_size")
    )
    pool = index_pool(
        texts.filter(F.col("category").isin(*categories)),
        ["category"],
        [c for c in texts.columns if c != "category"],
        salt="rewrite-pool",
        seed=seed,
    )
    rewritten = pick(
        marked.filter("_rewrite"), pool, [key], "rewrite-text", ["description"], how="left", seed=seed
    )
    parts = (cases.filter(~is_target), marked.filter(~F.col("_rewrite")), rewritten)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part.drop("_rewrite"))
    return result


def finalise_cases(cases: DataFrame, above: float = 1.0) -> DataFrame:
    """Keep values above 1 pound and put the case's new total on each row."""
    kept = cases.drop("case_value").filter(F.col("transaction_value") > above)
    return attach_total(kept, group_totals(kept))
