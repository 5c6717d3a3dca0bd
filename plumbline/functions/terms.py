"""Distribution-shift terms and p-values."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F

# Smoothing constant and the divisors of the three measures.
EPS = 1e-6
CATEGORICAL_SCALE = 20.0
NUMERICAL_SCALE = 15.0
KL_SCALE = 3.0
CARDINALITY_SCALE = 2.5
KS_TERMS = 100
# Cells of the table of paths up to which the two-sample test is exact; beyond it the
# asymptotic series is used.
KS_CELLS = 40_000
# Terms of the incomplete gamma's series and fraction below GAMMA_SPLIT, where that many
# leave less than 1e-15, and points of its integral from there on.
GAMMA_TERMS = 120
GAMMA_SPLIT = 60.0
GAMMA_POINTS = 64
# Steps by which the logarithm of the gamma function is moved into the range of its series.
GAMMA_SHIFT = 12


def _zero_to_null(x: Column) -> Column:
    return F.nullif(x.cast("double"), F.lit(0.0))


def share(part: Column, total: Column) -> Column:
    """``part / total``; null when the total is zero."""
    return part / _zero_to_null(total)


def psi_term(expected: Column, actual: Column) -> Column:
    """One category's share of the population stability index."""
    return (
        F.when((actual == 0) & (expected == 0), 0.0)
        .when(expected > EPS, (actual - expected) * F.ln((actual + EPS) / (expected + EPS)))
        .when(actual > EPS, actual * F.ln((actual + EPS) / EPS))
        .otherwise(0.0)
    )


def kl_term(expected: Column, actual: Column) -> Column:
    """One class's share of the divergence of production from reference."""
    return (
        F.when(actual < EPS, 0.0)
        .when(expected < EPS, actual * F.ln(actual / EPS))
        .otherwise(actual * F.ln((actual + EPS) / (expected + EPS)))
    )


def scaled_sum(term: Column, scale: float) -> Column:
    """Non-negative total of the terms over ``scale``; zero on no input."""
    return F.greatest(F.lit(0.0), F.coalesce(F.sum(term), F.lit(0.0))) / F.lit(float(scale))


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sided two-sample Kolmogorov p-value.

    Exact while the two sizes multiply to ``KS_CELLS`` at most, else asymptotic.
    """
    small = n.cast("bigint") * m.cast("bigint") <= KS_CELLS
    return F.when(small, ks_exact(statistic, n, m)).otherwise(ks_asymptotic(statistic, n, m))


def ks_exact(statistic: Column, n: Column, m: Column) -> Column:
    """Share of the orders of ``n`` and ``m`` rows whose statistic is at least this one.

    An order is a path over a grid. The share of the paths to a cell that have stayed
    within the statistic follows from those to the cells below and left of it, each
    by its part of all paths; cells beyond the statistic have none.
    """
    n, m = n.cast("bigint"), m.cast("bigint")
    # Differences of the two running shares are multiples of 1 / (n m).
    limit = F.round(statistic * n * m).cast("bigint")

    def cell(i: Column, j: Column, below: Column, left: Column) -> Column:
        inside = below * i / (i + j) + left * j / (i + j)
        return F.when(F.abs(i * m - j * n) >= limit, 0.0).when(i + j == 0, 1.0).otherwise(inside)

    def row(above: Column, i: Column) -> Column:
        def add(made: Column, j: Column) -> Column:
            left = F.coalesce(F.get(made, (j - 1).cast("int")), F.lit(0.0))
            return F.concat(made, F.array(cell(i, j, F.coalesce(F.get(above, j.cast("int")), F.lit(0.0)), left)))

        return F.aggregate(F.sequence(F.lit(0).cast("bigint"), m), F.expr("array()").cast("array<double>"), add)

    rows = F.sequence(F.lit(0).cast("bigint"), n)
    inside = F.aggregate(rows, F.expr("array()").cast("array<double>"), row, lambda last: F.get(last, m.cast("int")))
    return F.when((n > 0) & (m > 0), F.when(limit <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - inside)))


def ks_asymptotic(statistic: Column, n: Column, m: Column) -> Column:
    """Kolmogorov's series for large samples."""
    n, m = n.cast("double"), m.cast("double")
    z = statistic * F.sqrt(n * m / _zero_to_null(n + m))
    k = F.sequence(F.lit(1), F.lit(KS_TERMS))
    series = F.aggregate(
        k,
        F.lit(0.0),
        lambda acc, i: acc + F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * i * i * z * z),
    )
    return F.when(z < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for positive ``a``: Stirling's series, ``GAMMA_SHIFT`` further on."""
    z = a + float(GAMMA_SHIFT)
    series = 1.0 / (12.0 * z) - 1.0 / (360.0 * z**3) + 1.0 / (1260.0 * z**5) - 1.0 / (1680.0 * z**7) + 1.0 / (1188.0 * z**9)
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(GAMMA_SHIFT - 1)), F.lit(0.0), lambda acc, i: acc + F.ln(a + i))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2.0 * math.pi) + series - steps


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function of positive ``a`` and ``x``.

    For small ``a`` it is one less the series below ``a + 1``, and the continued
    fraction above. For large ``a`` the mass between ``x`` and a point where nothing is
    left is integrated by Gauss and Legendre's points. Either takes a fixed number
    of terms, and both agree to 1e-12 where they meet.
    """
    scale = F.exp(a * F.ln(x) - x - log_gamma(a))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(GAMMA_TERMS)),
        F.struct((1.0 / a).alias("term"), (1.0 / a).alias("total")),
        lambda acc, i: F.struct(
            (acc["term"] * x / (a + i)).alias("term"), (acc["total"] + acc["term"] * x / (a + i)).alias("total")
        ),
        lambda acc: acc["total"],
    )
    # x + 1 - a - 1 (1 - a) / (x + 3 - a - 2 (2 - a) / (...)), from the inside out.
    fraction = F.aggregate(
        F.sequence(F.lit(GAMMA_TERMS), F.lit(1)),
        x + (2.0 * GAMMA_TERMS + 1.0) - a,
        lambda acc, i: x + (2.0 * i - 1.0) - a - i * (i - a) / acc,
    )
    few = F.when(x < a + 1.0, 1.0 - scale * series).otherwise(scale / fraction)
    top, spread = a - 1.0, F.sqrt(F.greatest(a - 1.0, F.lit(1.0)))
    above = x > top
    far = F.when(above, F.greatest(top + 11.5 * spread, x + 6.0 * spread)).otherwise(
        F.greatest(F.lit(0.0), F.least(top - 7.5 * spread, x - 5.0 * spread))
    )
    points, weights = np.polynomial.legendre.leggauss(GAMMA_POINTS)
    nodes = F.array(*[F.struct(F.lit((p + 1) / 2).alias("p"), F.lit(w / 2).alias("w")) for p, w in zip(points.tolist(), weights.tolist())])
    peak = top * F.ln(top) - top - log_gamma(a)
    mass = F.aggregate(
        nodes,
        F.lit(0.0),
        lambda acc, v: acc + v["w"] * F.exp(top * F.ln((x + (far - x) * v["p"]) / top) - (x + (far - x) * v["p"] - top)),
    )
    mass = mass * F.abs(far - x) * F.exp(peak)
    many = F.when(above, mass).otherwise(1.0 - mass)
    return F.when(a < GAMMA_SPLIT, few).otherwise(many)


def chi_square_p_value(statistic: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution; null without a degree of freedom."""
    x, k = statistic.cast("double"), df.cast("double")
    # Both are computed once, however often the terms name them.
    tail = F.get(F.transform(F.array(F.struct((k / 2.0).alias("a"), (x / 2.0).alias("x"))), lambda v: upper_gamma(v["a"], v["x"])), F.lit(0))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail))
    return (
        F.when(x.isNull() | k.isNull() | F.isnan(x) | (k < 1), None)
        .when(x <= 0, 1.0)
        .when(x == float("inf"), 0.0)
        .otherwise(bounded)
    )
