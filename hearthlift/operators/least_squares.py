"""Ordinary least squares with intercept from one row of centred products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlift.functions.batches import map_batches
from hearthlift.functions.student import two_sided_p

# A regressor counts as following from the earlier ones if less than this share of its variation is left.
LEAST_SHARE = 1e-9


def cross_products(label: Column, regressors: Sequence[Column], prefix: str) -> list[Column]:
    """Aggregates: rows in which nothing is missing, and all centred sums of products of regressors and label."""
    values = [*regressors, label]
    whole = reduce(and_, [v.isNotNull() & ~F.isnan(v.cast("double")) for v in values])
    used = [F.when(whole, v.cast("double")) for v in values]
    out = [F.count_if(whole).alias(f"{prefix}_n")]
    for j in range(len(used)):
        for i in range(j + 1):
            product = F.covar_pop(used[i], used[j]) * F.count_if(whole)
            out.append(F.coalesce(product, F.lit(0.0)).alias(f"{prefix}_s{j}_{i}"))
    return out


def solved(products: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Slopes, standard errors (nan: none) and degrees of freedom from centred products, the label's the last.

    The products are factored into L D L'. A regressor that follows from those before it has slope 0, and then no
    regressor has an error."""
    m = len(products) - 1
    low, d = np.eye(m + 1), np.zeros(m + 1)
    for j in range(m):
        d[j] = products[j, j] - (low[j, :j] ** 2 * d[:j]).sum()
        left = products[j + 1 :, j] - low[j + 1 :, :j] @ (low[j, :j] * d[:j])
        low[j + 1 :, j] = left / d[j] if d[j] > LEAST_SHARE * products[j, j] else 0.0
    used = d[:m] > LEAST_SHARE * np.diag(products)[:m]
    slopes = np.zeros(m)
    for j in reversed(range(m)):
        slopes[j] = low[m, j] - low[j + 1 : m, j] @ slopes[j + 1 :]
    degrees = rows - 1 - m
    if not used.all() or degrees <= 0:
        return slopes, np.full(m, np.nan), degrees
    rest = max(products[m, m] - (low[m, :m] ** 2 * d[:m]).sum(), 0.0)
    inverse = np.linalg.inv(low[:m, :m])
    return slopes, np.sqrt(rest / degrees * (inverse**2 / d[:m, None]).sum(axis=0)), degrees


def fitted(row: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Adds for every prefix the arrays `{prefix}_b`, `_e` and `_p`: slopes, standard errors and p-values of the
    regressors, in order. `row` is the one row with the columns of `cross_products`; errors and p-values are
    missing where a regressor follows from others, or without degrees of freedom."""
    added = [(f"{prefix}_{part}", "array<double>") for prefix in sizes for part in "be"]
    added += [(f"{prefix}_degrees", "bigint") for prefix in sizes]
    names = [*row.columns, *[n for n, _ in added]]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                value = {n: one.column(i)[0].as_py() for i, n in enumerate(row_names)}
                arrays, degrees = [], []
                for prefix, size in sizes.items():
                    products = np.zeros((size + 1, size + 1))
                    for j in range(size + 1):
                        for i in range(j + 1):
                            products[i, j] = products[j, i] = value[f"{prefix}_s{j}_{i}"]
                    slopes, errors, free = solved(products, value[f"{prefix}_n"])
                    known = [None if np.isnan(e) else float(e) for e in errors]
                    arrays += [pa.array([slopes.tolist()]), pa.array([known], pa.list_(pa.float64()))]
                    degrees.append(pa.array([free], pa.int64()))
                yield pa.RecordBatch.from_arrays([*one.columns, *arrays, *degrees], names)

    row_names = row.columns
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in row.schema] + [f"{n} {t}" for n, t in added])

    def p_values(prefix: str) -> Column:
        both = F.arrays_zip(F.col(f"{prefix}_b").alias("b"), F.col(f"{prefix}_e").alias("e"))
        return F.transform(
            both, lambda s: two_sided_p(s["b"] / F.nullif(s["e"], F.lit(0.0)), F.col(f"{prefix}_degrees"))
        )

    return map_batches(row, run, schema).withColumns({f"{prefix}_p": p_values(prefix) for prefix in sizes})
