"""z-scores (SCL1-SCL3, MTH1) with population standard deviation, as the reference's scaler.

Spark ML's ``StandardScaler`` divides by the sample deviation, so it is not used for parity.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators import stats


@dataclass(frozen=True)
class ZScoreModel:
    params: dict = field(default_factory=dict)  # column -> (mean, std_pop)

    def expr(self, c: str) -> Column:
        mean, std = self.params[c]
        std = std if std else 1.0  # a constant column is divided by 1
        return (F.col(c) - F.lit(mean)) / F.lit(std)

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: self.expr(c) for c in self.params})


def fit_zscore(df: DataFrame, cols: list[str], fit_on: Column | None = None,
               digits: int | None = None) -> ZScoreModel:
    """SCL1 (fit on all rows, ``fit_on=None``) or SCL2 (fit on a subset, applied to all).

    ``digits`` rounds the fitted mean and deviation; engines that sum in a different order then
    still scale with identical numbers (used when results are compared across engines)."""
    params = stats.moments(df, cols, fit_on)
    if digits is not None:
        params = {c: tuple(None if v is None else round(v, digits) for v in mv) for c, mv in params.items()}
    return ZScoreModel(params)


def fill_with_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """SCL3: fill a (scaled) column with its own mean."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[c])) for c in cols})
