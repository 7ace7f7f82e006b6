"""The normal distribution: cumulative probability and quantiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = NormalDist()

# The rational approximations of algorithm AS 241 (Wichura 1988), highest power first,
# numerator and denominator: around the middle, in the tails, and far out.
MIDDLE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
TAIL = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def normal_cdf(z: float) -> float:
    return _UNIT.cdf(z)


def _ratio(parts: Sequence[Sequence[float]], x: Column) -> Column:
    """The quotient of two polynomials in ``x``."""
    above, below = (reduce(lambda acc, c: acc * x + F.lit(c), part[1:], F.lit(part[0])) for part in parts)
    return above / below


def normal_quantile(p: str | Column) -> Column:
    """Inverse of the cumulative probability, to about 16 digits; null outside (0, 1). Spark has no such function."""
    p = F.col(p) if isinstance(p, str) else p
    q = p - F.lit(0.5)
    far = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.signum(q) * F.when(far <= 5, _ratio(TAIL, far - F.lit(1.6))).otherwise(_ratio(FAR, far - F.lit(5.0)))
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * _ratio(MIDDLE, F.lit(0.180625) - q * q)).otherwise(tail))
