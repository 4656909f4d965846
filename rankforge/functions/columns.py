"""Column-expression helpers (all JVM-side, stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(x) -> Column:
    """A double literal; a bare Python float would turn some expressions decimal."""
    return F.lit(float(x)).cast("double")


def rnd(c, digits: int = DIGITS) -> Column:
    """Round a double for stable cross-engine comparison."""
    return F.round(col_(c).cast("double"), digits)


def safe_div(num, den, default: float = 0.0) -> Column:
    """Ratio, ``default`` for a zero denominator (ANSI mode raises on division by
    zero); an unknown (NULL) denominator makes the ratio unknown."""
    num, den = col_(num), col_(den)
    return F.when(den.isNull(), F.lit(None).cast("double")) \
        .when(den != 0, num.cast("double") / den.cast("double")).otherwise(dbl(default))


def clip(c, lo: float, hi: float) -> Column:
    return F.greatest(dbl(lo), F.least(dbl(hi), col_(c).cast("double")))


def floor_zero(c) -> Column:
    return F.greatest(dbl(0.0), col_(c).cast("double"))


def epoch_seconds(ts) -> Column:
    """Seconds since epoch as double for TIMESTAMP or TIMESTAMP_NTZ input (UTC)."""
    return F.unix_micros(col_(ts).cast("timestamp")) / dbl(1e6)


def from_epoch(seconds) -> Column:
    """Epoch seconds (double) to TIMESTAMP; keeps the fraction, unlike from_unixtime."""
    return F.timestamp_seconds(col_(seconds))


def ts_text(ts) -> Column:
    """Timestamp rendered as text with second precision for comparison."""
    return F.date_format(col_(ts).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def is_weekend(ts) -> Column:
    return F.when(F.dayofweek(col_(ts)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def unit_hash(*parts) -> Column:
    """Stateless uniform number in [0,1) from md5 of the parts joined by '_'.

    The first 8 hex digits of md5 read as an unsigned 32-bit integer, divided
    by 2^32.  Same value in any engine with md5, and after any restart.
    """
    key = F.concat_ws("_", *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / dbl(4294967296.0)


def rec_key(user, algorithm, n, exclude_seen) -> Column:
    """Cache key ``rec:{user}:{algorithm}:{n}:{0|1}``."""
    return F.concat_ws(":", F.lit("rec"), col_(user).cast("string"), col_(algorithm),
                       col_(n).cast("string"), col_(exclude_seen).cast("int").cast("string"))


def namespaced_sha256(namespace, ident) -> Column:
    return F.sha2(F.concat_ws(":", col_(namespace), col_(ident).cast("string")), 256)


def sorted_list_text(c) -> Column:
    """Sorted array rendered as comma-joined text (stable for hashing)."""
    return F.array_join(F.array_sort(col_(c)), ",")
