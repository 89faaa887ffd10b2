"""lakeforge: medallion-style data operators on PySpark DataFrames.

Packages
- ``sources``   batch / stream readers, CSV dialect, file lineage, sinks
- ``functions`` column expressions (hash ids, surrogate keys, casts)
- ``operators`` flatten, clean, dedup, joins, SCD1/SCD2, quality checks
- ``plans``     the jobs of each project, expressed on the driver tables
- ``streaming`` Structured Streaming ingest, dedup and sequenced CDC
"""

__version__ = "0.1.0"
