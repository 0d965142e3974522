"""Rating-scale arithmetic as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from knnrec.sources.ratings import RATING_HI, RATING_LO

# Similarities are rounded to this many decimals before they are ranked
# or tested against zero, so that summation order (which differs between
# tasks and engines) cannot flip a tie or turn cancellation noise into a
# neighbour.
SIM_DIGITS = 9
# Digits of reported floating results.
OUT_DIGITS = 6


def scale(x: Column, avg: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Room left on the scale: ``hi - avg`` above the average, ``avg - lo``
    below it, 1 at the average."""
    return (
        F.when(x > avg, F.lit(hi) - avg)
        .when(x < avg, avg - F.lit(lo))
        .otherwise(F.lit(1.0))
    )


def normalized_deviation(r: Column, avg: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """``(r - avg) / scale(r, avg)``, in [-1, 1] for ratings inside the scale."""
    return F.try_divide(r - avg, scale(r, avg, lo, hi))


def predicted_rating(avg: Column, wdev: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """``avg + wdev * scale(avg + wdev, avg)``: maps a deviation back onto
    the rating scale of the user."""
    return avg + wdev * scale(avg + wdev, avg, lo, hi)


def round_half_away(x: Column, digits: int) -> Column:
    """``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``: rounds the binary value
    in double arithmetic (no per-row decimal conversion, and the same
    result as ``std::round(x * 10^d) / 10^d`` in other engines; ``round``
    would instead round the shortest decimal string of ``x``). From 2^53
    units of the last digit on a double has no such digits: ``x`` stays."""
    m = float(10 ** digits)
    scaled = F.abs(x) * F.lit(m)
    rounded = F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(m)
    return F.when(scaled < F.lit(float(1 << 53)), rounded).otherwise(x)


def snap(x: Column, digits: int = SIM_DIGITS) -> Column:
    return round_half_away(x, digits)


def out(x: Column, digits: int = OUT_DIGITS) -> Column:
    """Reported floating value, rounded so engines can be compared; adding
    +0.0 turns a negative zero into zero."""
    return round_half_away(x, digits) + F.lit(0.0)


def hundredths(x: Column) -> Column:
    """A two-decimal amount as an exact integer count of hundredths, so that
    sums do not depend on the order in which tasks add them."""
    return F.round(x * F.lit(100)).cast("long")
