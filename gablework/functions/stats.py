"""Statistics written as column expressions (no per-row Python).

The forms are the published ones: D'Agostino and Anscombe-Glynn for the
normality test, the Kolmogorov series, Student's pooled t, Wichura's AS 241
for the normal quantile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from gablework.functions.columns import num, ratio


def normality_k2(n: Column, skew: Column, kurt: Column) -> Column:
    """D'Agostino's K-squared from biased skewness and excess kurtosis.

    NULL below eight rows, where the test is not defined.
    """
    n = n.cast("double")
    b2 = kurt + 3.0
    y = skew * F.sqrt((n + 1) * (n + 3) / (num(6) * (n - 2)))
    beta = (
        num(3) * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(num(2) * (beta - 1)) - 1
    z_skew = F.asinh(y / F.sqrt(num(2) / (w2 - 1))) / F.sqrt(num(0.5) * F.log(w2))
    mean = num(3) * (n - 1) / (n + 1)
    var = num(24) * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - mean) / F.sqrt(var)
    s = (
        num(6)
        * (n * n - 5 * n + 2)
        / ((n + 7) * (n + 9))
        * F.sqrt(num(6) * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = num(6) + num(8) / s * (num(2) / s + F.sqrt(num(1) + num(4) / (s * s)))
    inner = (num(1) - num(2) / a) / (num(1) + x * F.sqrt(num(2) / (a - 4)))
    z_kurt = ((num(1) - num(2) / (num(9) * a)) - F.cbrt(inner)) / F.sqrt(num(2) / (num(9) * a))
    return F.when(n >= 8, z_skew * z_skew + z_kurt * z_kurt)


def normality_p(n: Column, skew: Column, kurt: Column) -> Column:
    """p-value of K-squared, chi-square with two degrees of freedom."""
    return F.exp(-normality_k2(n, skew, kurt) / 2)


KS_TERMS = 100


def ks_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    lam2 = d * d * n * m / (n + m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        num(0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(num(-2) * (k * k).cast("double") * lam2),
    )
    return F.when(d == 0, 1.0).otherwise(F.greatest(F.least(series * 2.0, num(1)), num(0)))


def pooled_t(n1: Column, m1: Column, s1: Column, n2: Column, m2: Column, s2: Column) -> Column:
    """Student's t for two groups with pooled variance (sample deviations)."""
    pooled = ratio((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2, n1 + n2 - 2)
    return ratio(m1 - m2, F.sqrt(pooled * (ratio(F.lit(1), n1) + ratio(F.lit(1), n2))))


def chi_square_2x2(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Chi-square of a 2x2 table without correction."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    cross = a * d - b * c
    return ratio(n * cross * cross, (a + b) * (c + d) * (a + c) * (b + d))


def chi_square_1df_p(x: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom: erfc(sqrt(x/2))."""
    return erfc(F.sqrt(x / 2))


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0, relative error below 1.2e-7.

    The rational Chebyshev form of Press et al., Numerical Recipes.
    """
    t = num(1) / (num(1) + z / 2)
    # Coefficients of the fit, constant term first.
    coefficients = (
        -1.26551223,
        1.00002368,
        0.37409196,
        0.09678418,
        -0.18628806,
        0.27886807,
        -1.13520398,
        1.48851587,
        -0.82215223,
        0.17087277,
    )
    return t * F.exp(-z * z + _horner(coefficients, t))


def _horner(coefficients: Sequence[float], x: Column) -> Column:
    value = num(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + num(c)
    return value


# AS 241 (PPND16), numerators and denominators, constant first.
_CENTRAL = (
    (
        3.3871328727963666080e0,
        1.3314166789178437745e2,
        1.9715909503065514427e3,
        1.3731693765509461125e4,
        4.5921953931549871457e4,
        6.7265770927008700853e4,
        3.3430575583588128105e4,
        2.5090809287301226727e3,
    ),
    (
        1.0,
        4.2313330701600911252e1,
        6.8718700749205790830e2,
        5.3941960214247511077e3,
        2.1213794301586595867e4,
        3.9307895800092710610e4,
        2.8729085735721942674e4,
        5.2264952788528545610e3,
    ),
)
_NEAR_TAIL = (
    (
        1.42343711074968357734e0,
        4.63033784615654529590e0,
        5.76949722146069140550e0,
        3.64784832476320460504e0,
        1.27045825245236838258e0,
        2.41780725177450611770e-1,
        2.27238449892691845833e-2,
        7.74545014278341407640e-4,
    ),
    (
        1.0,
        2.05319162663775882187e0,
        1.67638483018380384940e0,
        6.89767334985100004550e-1,
        1.48103976427480074590e-1,
        1.51986665636164571966e-2,
        5.47593808499534494600e-4,
        1.05075007164441684324e-9,
    ),
)
_FAR_TAIL = (
    (
        6.65790464350110377720e0,
        5.46378491116411436990e0,
        1.78482653991729133580e0,
        2.96560571828504891230e-1,
        2.65321895265761230930e-2,
        1.24266094738807843860e-3,
        2.71155556874348757815e-5,
        2.01033439929228813265e-7,
    ),
    (
        1.0,
        5.99832206555887937690e-1,
        1.36929880922735805310e-1,
        1.48753612908506148525e-2,
        7.86869131145613259100e-4,
        1.84631831751005468180e-5,
        1.42151175831644588870e-7,
        2.04426310338993978564e-15,
    ),
)


def normal_quantile(p: Column) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1."""
    q = p - 0.5
    r0 = num(0.180625) - q * q
    central = q * _horner(_CENTRAL[0], r0) / _horner(_CENTRAL[1], r0)
    r = F.sqrt(-F.log(F.least(p, num(1) - p)))
    near = _horner(_NEAR_TAIL[0], r - 1.6) / _horner(_NEAR_TAIL[1], r - 1.6)
    far = _horner(_FAR_TAIL[0], r - 5.0) / _horner(_FAR_TAIL[1], r - 5.0)
    tail = F.when(r <= 5, near).otherwise(far)
    return F.when(F.abs(q) <= 0.425, central).otherwise(F.when(q < 0, -tail).otherwise(tail))
