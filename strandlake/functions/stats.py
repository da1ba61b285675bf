"""Tail probabilities as column expressions; closed forms, so no array grows with a count."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series, moved up by eight so that it holds from k = 0 (error below 1e-11)."""
    k = k.cast("double")
    z = k + 9
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    up = F.lit(0.0)
    for i in range(1, 9):
        up = up + F.log(k + i)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - up


def _horner(terms: Column, ratio) -> Column:
    """1 + r(1) (1 + r(2) (1 + ...)), the sum of running products, from the last term inwards."""
    steps = F.sequence(F.greatest(terms, F.lit(1)).cast("int"), F.lit(1), F.lit(-1))
    return F.aggregate(steps, F.lit(1.0), lambda acc, j: 1 + acc * ratio(j))


def poisson_score(k: Column, lam: Column) -> Column:
    """-log10 P(X >= k), X ~ Poisson(lam), in logs so that far tails do not underflow. Meant for k > lam."""
    k, lam = k.cast("double"), lam.cast("double")
    terms = F.greatest(F.lit(40.0), lam - k + 10 * F.sqrt(lam) + 20)
    first = k * F.log(lam) - lam - log_factorial(k)
    return -(first + F.log(_horner(terms, lambda j: lam / (k + j)))) / math.log(10)


def binomial_score(hits: Column, n: Column, p: Column) -> Column:
    """-log10 P(X >= hits), X ~ Binomial(n, p). Meant for hits > n p and 0 < p < 1."""
    h, n, p = hits.cast("double"), n.cast("double"), p.cast("double")
    terms = F.least(n - h, F.greatest(F.lit(40.0), n * p - h + 10 * F.sqrt(n * p * (1 - p)) + 20))
    first = (
        log_factorial(n) - log_factorial(h) - log_factorial(n - h) + h * F.log(p) + (n - h) * F.log(1 - p)
    )
    tail = _horner(terms, lambda j: F.greatest(n - h - j + 1, F.lit(0.0)) / (h + j) * p / (1 - p))
    return -(first + F.log(tail)) / math.log(10)
