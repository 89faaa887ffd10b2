from lakeforge.functions.scalar import (  # noqa: F401
    HIGH_DATE,
    NA_TOKEN,
    days_between,
    epoch_ms_exact,
    epoch_ms_to_ts,
    hash_id,
    iso_date_text,
    na_to_zero,
    name_part,
    open_end,
    percent_where,
    ratio_or_null,
    surrogate_key,
    to_number,
    ts_to_epoch_ms,
    year_boundaries,
)
