from lakeforge.streaming.ingest import (  # noqa: F401
    apply_batch,
    backlog,
    csv_stream,
    drain,
    json_stream,
    run_cdc_stream,
    run_dedup_stream,
    run_scd1_stream,
    stream_dedup,
    stream_id,
    table_stream,
    variant_stream,
)
