"""Test statistics as column expressions. Spark has no error function; see ``two_sided_p``."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

MAD_SCALE, P_FLOOR = 1.4826, 1e-300


def z_score(level: Column, centre: Column, spread: Column) -> Column:
    return F.when(spread > 0, (level - centre) / spread)


def z_threshold(p: float) -> float:
    """The |z| beyond which a two-sided p-value is below ``p``."""
    return NormalDist().inv_cdf(1 - p / 2)


@F.pandas_udf(DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """erfc(|z| / sqrt 2) by Arrow batches: needed only where p-values are combined or reported."""
    return z.abs().div(math.sqrt(2)).map(math.erfc, na_action="ignore")


def minus_log_p(p: Column) -> Column:
    return -F.log10(F.greatest(p, F.lit(P_FLOOR)))


def chi2_survival(s: Column, m: Column, most: int | None = None) -> Column:
    """Upper tail of chi-square with 2m degrees of freedom at 2s, for any m; ``most`` is not needed.

    That is the sum of m Poisson terms; they go by their logarithms, so a long series does not overflow.
    """
    zero = F.struct(F.lit(0.0).alias("total"), (-s).alias("term"))
    add = lambda a, i: F.struct((a["total"] + F.exp(a["term"])).alias("total"), (a["term"] + F.log(s) - F.log(i)).alias("term"))
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(m, F.lit(1)).cast("long")), zero, add, lambda a: a["total"])
    return F.when(s > 0, F.least(F.lit(1.0), total)).otherwise(1.0)
