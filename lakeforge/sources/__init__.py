from lakeforge.sources.files import (  # noqa: F401
    CsvDialect,
    infer_json_schema,
    list_files,
    load_csv,
    load_csv_with_lineage,
    read_csv,
    read_json,
    read_json_rescued,
    read_variant_json,
)
from lakeforge.sources.tables import (  # noqa: F401
    HistoryTable,
    KeyedTable,
    VersionedTable,
    parquet_tables,
    publish,
    reload_variant,
    replace_table,
    stored_buckets,
    stored_model,
    table_inventory,
    write_or_upsert,
)
