"""Catalogue texts drawn for the rows of a ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.functions.draws import SEED
from txlab.operators.sampling import index_pool, pick

_TEXT_KEY = ("category", "subcategory", "description")


def expand_catalogue(
    catalogue: DataFrame,
    tx: DataFrame,
    row_key: str = "tx_id",
    amount: str = "amount",
    key: Sequence[str] = _TEXT_KEY,
    least: float = 1.0,
    origin: str = "non-fraud",
    seed: int = SEED,
) -> DataFrame:
    """Give each ledger row of at least ``least`` a catalogue text drawn with replacement.

    ``catalogue``: category, subcategory, description and the bounds min and max
    of its subcategory.  Amounts are the rows' own, brought inside the bounds of
    the text and rounded to 2 places; nothing is made up.
    """
    pool = index_pool(catalogue, [], key, salt="catalogue", seed=seed)
    rows = tx.filter(F.col(amount) >= least).select(row_key, amount)
    drawn = pick(rows, pool, [row_key], "expand", [*_TEXT_KEY, "min", "max"], seed=seed)
    inside = F.least(F.greatest(F.col(amount), F.col("min")), F.col("max"))
    rounded = F.bround(inside.cast("decimal(28,10)"), 2).cast("double")
    return drawn.withColumn(amount, rounded).drop("min", "max").withColumn("origin", F.lit(origin))
