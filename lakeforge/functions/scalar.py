"""Column expressions used across the jobs.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` only,
so it stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's for identical results.
# - Surrogate keys join the parts with '-' and replace a NULL part with
#   this marker before hashing (md5), as dbt_utils.generate_surrogate_key.
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
# - Open SCD2 versions end at this high date in the versioned view.
HIGH_DATE = "9999-12-31 00:00:00"
# - Literal token treated as zero in the retail fact measures.
NA_TOKEN = "NA"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(c, ntz: bool = True) -> Column:
    """``from_unixtime(ms / 1000)`` cast to a timestamp.

    Keeps the source behaviour: milliseconds are dropped (whole seconds,
    trap T1). ``ntz`` gives a zone-free timestamp so results do not depend
    on the session time zone.
    """
    text = F.from_unixtime((_col(c) / 1000).cast("bigint"))
    return text.cast("timestamp_ntz" if ntz else "timestamp")


def epoch_ms_exact(c) -> Column:
    """Millisecond-exact alternative to :func:`epoch_ms_to_ts`."""
    return F.timestamp_millis(_col(c).cast("bigint")).cast("timestamp_ntz")


def ts_to_epoch_ms(c) -> Column:
    """Epoch milliseconds of a zone-free timestamp, read in the session time
    zone (the jobs pin it to UTC)."""
    return F.unix_millis(_col(c).cast("timestamp"))


def hash_id(*cols, sep: str = "_", length: int | None = None) -> Column:
    """``sha2(concat_ws(sep, cols), 256)``, optionally cut to ``length`` chars.

    ``concat_ws`` skips NULL parts (trap T22); use :func:`surrogate_key`
    where NULLs must stay distinguishable.
    """
    h = F.sha2(F.concat_ws(sep, *[_col(c).cast("string") for c in cols]), 256)
    return F.substring(h, 1, length) if length else h


def surrogate_key(cols: Iterable) -> Column:
    """md5 over the parts joined by '-', NULL parts replaced by a marker."""
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL_MARKER))
        for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def na_to_zero(c, strict: bool = True) -> Column:
    """``CASE WHEN c = 'NA' THEN 0 ELSE CAST(c AS DOUBLE) END`` (trap T11).

    A real NULL stays NULL. ``strict=False`` turns malformed numbers into
    NULL instead of failing the job.
    """
    c = _col(c)
    return F.when(c == F.lit(NA_TOKEN), F.lit(0.0)).otherwise(to_number(c, strict))


def to_number(c, strict: bool = True) -> Column:
    """String measure to double; ``strict=False`` uses ``try_cast``."""
    c = _col(c)
    return c.cast("double") if strict else c.try_cast("double")


def name_part(c, k: int) -> Column:
    """k-th space-separated word (1-based); a missing part gives ''."""
    return F.split_part(_col(c), F.lit(" "), F.lit(k))


def year_boundaries(start, end) -> Column:
    """Year boundaries crossed between two dates (``DATEDIFF(YEAR, …)``, T5)."""
    return F.year(_col(end)) - F.year(_col(start))


def days_between(start, end) -> Column:
    """``DATEDIFF(DAY, start, end)``: note Spark's argument order is flipped."""
    return F.datediff(_col(end), _col(start))


def iso_date_text(c) -> Column:
    """ISO ``yyyy-MM-dd`` text of a date (the intent of trap T8)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def open_end(c, high: str = HIGH_DATE) -> Column:
    """Replace an open end (NULL) by the high date, as a zone-free timestamp."""
    return F.coalesce(_col(c), F.lit(high).cast("timestamp_ntz"))


def ratio_or_null(num, den) -> Column:
    """``num / NULLIF(den, 0)`` as a double (trap T9)."""
    return _col(num).cast("double") / F.nullif(_col(den), F.lit(0))


def percent_where(cond: Column, total: Column) -> Column:
    """``100.0 * SUM(CASE WHEN cond THEN 1 ELSE 0 END) / total``."""
    return F.lit(100.0) * F.sum(F.when(cond, 1).otherwise(0)) / total
