"""Scaling and linear regression over DataFrame columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Means and deviations of columns; ``transform`` adds ``<column>_scaled``."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            f"{c}_scaled": (F.col(c).cast("double") - self.means[c])
            / F.nullif(F.lit(self.deviations[c]), F.lit(0.0))
            for c in self.means
        })


def fit_scaler(df: DataFrame, columns: list[str], population: bool = True) -> Scaler:
    """Fit in one pass. ``population`` divides by n, otherwise by n - 1."""
    deviation = F.stddev_pop if population else F.stddev_samp
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[deviation(F.col(c).cast("double")).alias(f"d{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaler(
        {c: row[f"m{i}"] for i, c in enumerate(columns)},
        {c: row[f"d{i}"] for i, c in enumerate(columns)},
    )


@dataclass(frozen=True)
class Line:
    """Coefficients of the inputs and intercept; ``transform`` adds ``prediction``."""

    inputs: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = [F.col(c).cast("double") * b for c, b in zip(self.inputs, self.coefficients)]
        return df.withColumn("prediction", sum(terms, F.lit(self.intercept)))


def fit_line(df: DataFrame, inputs: list[str], label: str) -> Line:
    """Least squares by the normal equations: one aggregate of means and co-moments, with partial results in every task.

    No row leaves the columnar scan as an object. Inputs that do not vary, or only with others, get the smallest
    coefficients. A value that is NULL or not finite is an error, as is a table without rows.
    """
    columns = [F.col(c).cast("double") for c in [*inputs, label]]
    unusable = F.lit(False)
    for c in columns:
        unusable = unusable | ~F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(unusable).alias("unusable"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    if not row["rows"] or row["unusable"]:
        raise ValueError(f"{row['unusable']} of {row['rows']} rows hold a value that is NULL or not finite, or there are no rows")
    moments = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        moments[i, j] = moments[j, i] = row[f"c{i}_{j}"]
    deviations = np.sqrt(np.diag(moments))
    scale = np.where(deviations > 0, deviations, 1.0)
    scaled = moments / np.outer(scale, scale)
    solved = np.linalg.lstsq(scaled[:-1, :-1], scaled[:-1, -1], rcond=None)[0]
    coefficients = [float(b) for b in solved * scale[-1] / scale[:-1]]
    return Line(tuple(inputs), tuple(coefficients), row[f"m{len(inputs)}"] - sum(
        b * row[f"m{i}"] for i, b in enumerate(coefficients)))
