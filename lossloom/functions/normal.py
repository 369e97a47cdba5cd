"""Normal distribution and the single-factor default model as column expressions.

Spark has no error function, so both directions use published rational approximations:
Hart's double-precision cumulative normal (as given by G. West, 2005) and
Wichura's algorithm AS 241 (PPND16) for the quantile. Both are good to about 1e-15.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bounds import clip

# Coefficients, highest power first.
CDF_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
           112.079291497871, 221.213596169931, 220.206867912376]
CDF_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
           296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
CDF_SPLIT = 7.07106781186547
ROOT_TWO_PI = 2.506628274631

Q_MID_NUM = [2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
             4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
             1.3314166789178437745e2, 3.3871328727963666080e0]
Q_MID_DEN = [5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
             2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
             4.2313330701600911252e1, 1.0]
Q_NEAR_NUM = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
              1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
              4.63033784615654529590e0, 1.42343711074968357734e0]
Q_NEAR_DEN = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
              1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
              2.05319162663775882187e0, 1.0]
Q_FAR_NUM = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
             2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
             5.46378491116411436990e0, 6.65790464350110377720e0]
Q_FAR_DEN = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
             7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
             5.99832206555887937690e-1, 1.0]

TINY = 1e-6  # probabilities are kept this far from 0 and 1


def _poly(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def _bind(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body(x)`` with ``x`` evaluated once: a lambda variable stands for it, so formulas that use
    it dozens of times do not copy its expression (or a subquery in it) dozens of times."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def normal_cdf(x: Column) -> Column:
    def tail(z: Column) -> Column:
        bell = F.exp(-z * z / 2)
        near = bell * _poly(CDF_NUM, z) / _poly(CDF_DEN, z)
        far = z + F.lit(0.65)
        for step in (4.0, 3.0, 2.0, 1.0):
            far = z + F.lit(step) / far
        far = bell / far / ROOT_TWO_PI
        return F.when(z > 37, F.lit(0.0)).when(z < CDF_SPLIT, near).otherwise(far)

    return _bind(x, lambda v: F.when(v > 0, 1 - _bind(F.abs(v), tail))
                 .otherwise(_bind(F.abs(v), tail)))


def normal_quantile(p: Column) -> Column:
    """Inverse of :func:`normal_cdf` for 0 < p < 1."""
    def centre(q: Column) -> Column:
        return _bind(F.lit(0.180625) - q * q,
                     lambda m: q * _poly(Q_MID_NUM, m) / _poly(Q_MID_DEN, m))

    def outer(r: Column) -> Column:
        near, far = r - 1.6, r - 5.0
        return F.when(r <= 5, _poly(Q_NEAR_NUM, near) / _poly(Q_NEAR_DEN, near)).otherwise(
            _poly(Q_FAR_NUM, far) / _poly(Q_FAR_DEN, far))

    def whole(v: Column) -> Column:
        q = v - 0.5
        size = _bind(F.sqrt(-F.ln(F.least(v, 1 - v))), outer)
        return F.when(F.abs(q) <= 0.425, _bind(q, centre)).when(q < 0, -size).otherwise(size)

    return _bind(p, whole)


def inside_unit(p: Column) -> Column:
    return clip(p, TINY, 1 - TINY)


def point_in_time_pd(ttc_pd: Column, z: Column, rho: float) -> Column:
    """Default probability given the systematic factor ``z`` (positive = good times)."""
    return normal_cdf((normal_quantile(inside_unit(ttc_pd)) - rho**0.5 * z) / (1 - rho) ** 0.5)


def implied_factor(observed: Column, ttc_pd: Column, rho: float) -> Column:
    """Systematic factor that explains an observed default rate."""
    return (normal_quantile(inside_unit(ttc_pd))
            - (1 - rho) ** 0.5 * normal_quantile(inside_unit(observed))) / rho**0.5
