"""Scalar column functions used across summaries and statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def rate(column: str) -> Column:
    """Mean of a 0/1 or count column, as a double."""
    return F.avg(F.col(column).cast("double"))


def relative(change: Column, base: Column) -> Column:
    """Change as a share of the base, NULL when the base is zero."""
    return F.try_divide(change, base)


def percent_text(column: Column) -> Column:
    return F.when(column.isNotNull(), F.format_string("%.2f%%", 100 * column))


def number_text(column: Column) -> Column:
    return F.when(column.isNotNull(), F.format_string("%.4f", column))


def clamp_probability(p: Column) -> Column:
    """The probability kept off 0 and 1; NULL stays NULL."""
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6)))


# Coefficients of W. J. Cody's rational Chebyshev approximations of erf and erfc
# ("Rational Chebyshev approximation for the error function", Math. Comp. 23, 1969), constant
# term first. NEAR serves |x| <= 0.46875 (erf), MIDDLE up to 4 and FAR beyond (erfc).
ERF_NEAR_NUM = [3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02,
                3.16112374387056560e00, 1.85777706184603153e-1]
ERF_NEAR_DEN = [2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02,
                2.36012909523441209e01, 1.0]
ERFC_MIDDLE_NUM = [1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03,
                   8.81952221241769090e02, 2.98635138197400131e02, 6.61191906371416295e01,
                   8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8]
ERFC_MIDDLE_DEN = [1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03,
                   3.29079923573345963e03, 1.62138957456669019e03, 5.37181101862009858e02,
                   1.17693950891312499e02, 1.57449261107098347e01, 1.0]
ERFC_FAR_NUM = [6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1,
                3.60344899949804439e-1, 3.05326634961232344e-1, 1.63153871373020978e-2]
ERFC_FAR_DEN = [2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1,
                1.87295284992346725e00, 2.56852019228982242e00, 1.0]


def _polynomial(coefficients: list[float], x: str) -> str:
    text = f"{coefficients[-1]!r}D"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}D)"
    return text


def with_erfc(df: DataFrame, x: Column, out: str) -> DataFrame:
    """Adds the complementary error function of a non-negative column, about double precision.

    The argument and its powers become columns first: the polynomials name them dozens of times.
    """
    ready = (
        df.withColumn("_x", x)
        .withColumn("_sq", F.expr("_x * _x"))
        .withColumn("_inv", F.expr("try_divide(1D, _sq)"))
    )
    near = f"1 - _x * {_polynomial(ERF_NEAR_NUM, '_sq')} / {_polynomial(ERF_NEAR_DEN, '_sq')}"
    middle = f"exp(-_sq) * {_polynomial(ERFC_MIDDLE_NUM, '_x')} / {_polynomial(ERFC_MIDDLE_DEN, '_x')}"
    tail = f"_inv * {_polynomial(ERFC_FAR_NUM, '_inv')} / {_polynomial(ERFC_FAR_DEN, '_inv')}"
    far = f"exp(-_sq) / _x * ({1 / math.sqrt(math.pi)!r}D - {tail})"
    value = f"CASE WHEN _x <= 0.46875D THEN {near} WHEN _x <= 4D THEN {middle} ELSE {far} END"
    return ready.withColumn(out, F.expr(value)).drop("_x", "_sq", "_inv")


def with_two_sided_p(df: DataFrame, effect: str, standard_error: str, out: str = "p_value") -> DataFrame:
    """Adds the normal two-sided p-value; 1 when there is no variation to test against."""
    z = f"CASE WHEN {standard_error} = 0 THEN 0D ELSE abs({effect} / {standard_error}) END"
    return with_erfc(df, F.expr(f"({z}) / {math.sqrt(2.0)!r}D"), out)
