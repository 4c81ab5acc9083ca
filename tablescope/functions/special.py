"""F and t tail probabilities from the regularised incomplete beta function."""

from __future__ import annotations

import math


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_cdf(1.0 - x, b, a)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    # Lentz evaluation of the continued fraction.
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(0, 2000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + term * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + term / (c if abs(c) > tiny else tiny)
        f *= c * d
        if i > 0 and abs(1.0 - c * d) < 1e-15:
            break
    return min(1.0, max(0.0, math.exp(log_front) * (f - 1.0) / a))


def f_tail(f: float | None, d1: float, d2: float) -> float:
    """P(F > f) for an F variable with d1 and d2 degrees of freedom."""
    if f is None or d1 <= 0 or d2 <= 0 or f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return beta_cdf(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2.0, 0.5)


def t_quantile(p: float, df: float) -> float:
    """Upper quantile of Student's t, p in (0.5, 1), by bisection."""
    lo, hi = 0.0, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if 1.0 - t_two_sided(mid, df) / 2.0 < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0
