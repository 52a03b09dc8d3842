"""Joins of a large table with a side that may be small: broadcast behind a check of its size, else shuffled with salted keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.session import materialize

#: Rows of a narrow side that are sent to all tasks.
MAX_SENT = 200_000
#: Parts of each join key of a larger side, so that a key found on a large part of all rows is no hot spot.
SALTS = 16


def meet(left: DataFrame, right: DataFrame, on: list[str], how: str, label: str | None, salts: int = SALTS) -> DataFrame:
    """left (with ``row``) joined to right, which is written down once (no label: it is already); ``salts`` = 1 where no key of left is hot."""
    right = materialize(right, label) if label else right
    if right.count() <= MAX_SENT:
        return left.join(F.broadcast(right), on, how)
    if salts == 1:
        return left.join(right, on, how)
    salted = left.withColumn("salt", F.pmod(F.hash("row"), F.lit(salts)))
    return salted.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [*on, "salt"], how).drop("salt")
