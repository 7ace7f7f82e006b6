"""Least squares from cross products, and the distribution of the unit-root statistic."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cuadra.functions.normal import normal_cdf

# Fixed values, published by MacKinnon for one series with a constant: the polynomials whose normal
# probability is the p-value below and above the split, the ends of the range, and the response
# surfaces of the critical values over 1/n.
P_SPLIT, P_LOWEST, P_HIGHEST = -1.61, -18.83, 2.74
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


@dataclass
class Fit:
    coef: np.ndarray
    error: np.ndarray
    ssr: float


def _independent(unit: np.ndarray) -> bool:
    try:
        return np.linalg.cholesky(unit).diagonal().min() > 1e-7
    except np.linalg.LinAlgError:
        return False


def least_squares(square: np.ndarray, slots: np.ndarray, n: int) -> Fit:
    """Regress the last slot of a cross-product square on ``slots``.

    The square is scaled to a unit diagonal first. Collinear columns go to the pseudo-inverse.
    """
    xx, xy, yy = square[np.ix_(slots, slots)], square[slots, -1], square[-1, -1]
    scale = np.sqrt(np.where(np.diag(xx) > 0, np.diag(xx), 1.0))
    unit = xx / np.outer(scale, scale)
    inverse = (np.linalg.inv(unit) if _independent(unit) else np.linalg.pinv(unit, hermitian=True)) / np.outer(scale, scale)
    coef = inverse @ xy
    ssr = max(float(yy - coef @ xy), np.finfo(float).tiny)
    free = n - len(slots)
    variance = ssr / free if free > 0 else np.nan
    return Fit(coef, np.sqrt(np.maximum(variance * np.diag(inverse), 0)), ssr)


def nested_errors(square: np.ndarray, n: int) -> list[float]:
    """Sums of squared errors of the regressions of the last slot on the first slot, the first two, and so on.

    Of the triangular factor of a square, the last row shows what each further regressor explains.
    """
    slots = len(square) - 1
    diagonal = np.diag(square)
    scale = np.sqrt(np.where(diagonal > 0, diagonal, 1.0))
    unit = square / np.outer(scale, scale)
    if not _independent(unit[:slots, :slots]) or diagonal[-1] <= 0:
        return [least_squares(square, np.r_[0:k + 1], n).ssr for k in range(slots)]
    lower = np.linalg.cholesky(unit[:slots, :slots])
    explained = np.linalg.solve(lower, unit[:slots, -1]) ** 2
    return np.maximum(diagonal[-1] * (1 - np.cumsum(explained)), np.finfo(float).tiny).tolist()


def adf_p_value(tau: float) -> float:
    if tau < P_LOWEST:
        return 0.0
    if tau > P_HIGHEST:
        return 1.0
    terms = P_SMALL if tau <= P_SPLIT else P_LARGE
    return normal_cdf(sum(c * tau**i for i, c in enumerate(terms)))


def adf_critical_values(n: int) -> tuple[float, ...]:
    """At 1, 5 and 10 %."""
    return tuple(sum(c / n**i for i, c in enumerate(terms)) for terms in CRITICAL.values())
