from lakeforge.operators.changes import (  # noqa: F401
    cdc_scd1,
    change_feed,
    insert_absent,
    scd1_merge,
    scd2_open,
    scd2_snapshot,
    unique_source,
    upsert,
    upsert_images,
    upsert_with_images,
    versioned_view,
)
from lakeforge.operators.clean import (  # noqa: F401
    add_audit,
    continent_mart,
    current_rows,
    dedup_rows,
    distinct_values,
    global_row_number,
    latest_per_key,
    lookup,
    na_to_zero_cols,
)
from lakeforge.operators.flatten import (  # noqa: F401
    explode_features,
    explode_variant,
    explode_variant_object,
    flatten_features,
    vpath,
    vpath_int_rounded,
)
from lakeforge.operators.joins import sum_over_join  # noqa: F401
from lakeforge.operators.quality import (  # noqa: F401
    CheckFailed,
    check_accepted,
    check_not_null,
    check_unique,
    duplicate_keys,
    is_null,
    not_accepted,
)
