"""Term-weighting formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TF_FORMS = ("ratio", "raw")


def tf(form: str = "ratio") -> Column:
    """Term frequency over the columns ``count`` and ``word_count``."""
    if form == "ratio":
        return F.col("count") / F.col("word_count")
    if form == "raw":
        return F.col("count").cast("double")
    raise ValueError(f"unknown tf {form!r}, expected one of {TF_FORMS}")


def idf(flipped: bool = False) -> Column:
    """Inverse document frequency over ``n_docs`` and ``df``; natural log, no smoothing."""
    ratio = F.col("df") / F.col("n_docs") if flipped else F.col("n_docs") / F.col("df")
    return F.log(ratio)
