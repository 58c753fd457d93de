"""Column helpers for numbers. All are plain expressions that stay in codegen."""

from pyspark.sql import functions as F

# Added away from zero before rounding, so that a tie that binary arithmetic
# stored a hair too low still rounds away from zero on every engine.
TIE_NUDGE = 1e-9
# Below so many units of the last place a double is off by 1e-7 units at most, so the side of a
# tie is certain from NEAR_TIE on.
PLAIN_UNITS, NEAR_TIE = 1e9, 1e-5


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def round_stable(c, scale):
    """Round half away from zero; never returns negative zero.

    ``F.round`` takes a double through its text. A number of ordinary size that is not near a
    tie needs no digits to be rounded: its nearest whole multiple is divided by the power of ten, which
    gives the same double.
    """
    c = _col(c)
    nudged = c + F.signum(c) * F.lit(TIE_NUDGE)
    power = F.lit(10.0 ** scale)
    units = F.abs(nudged) * power
    # NaN sorts above every number, so it is no ordinary size either.
    plain = (units < PLAIN_UNITS) & (F.abs(units - F.floor(units) - 0.5) > NEAR_TIE)
    return F.when(plain, F.signum(c) * F.floor(units + 0.5) / power).otherwise(F.round(nudged, scale)) + F.lit(0.0)


def guarded_ratio(numerator, denominator):
    """numerator / denominator, null where the denominator is zero (ANSI safe)."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def pct_change(new, old, scale, when_zero=None):
    """Percentage change from ``old`` to ``new``; ``when_zero`` replaces 1/0."""
    new, old = _col(new).cast("double"), _col(old).cast("double")
    change = round_stable(guarded_ratio(new - old, old) * F.lit(100), scale)
    if when_zero is None:
        return change
    return F.when(old == 0, F.lit(float(when_zero))).otherwise(change)


def safe_double(c):
    return _col(c).try_cast("double")


def safe_long(c):
    return _col(c).try_cast("bigint")


def is_infinite(c):
    return F.abs(_col(c).try_cast("double")) == F.lit(float("inf"))


def is_missing(c, data_type=None):
    """Null, or NaN for floating point columns: both mean "no value" here."""
    c = _col(c)
    if data_type is not None and data_type not in ("double", "float"):
        return c.isNull()
    return c.isNull() | F.isnan(c)
