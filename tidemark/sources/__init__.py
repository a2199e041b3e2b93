"""Readers and writers (CSV / JSON / Parquet, dated files, evolving schemas)."""

from tidemark.sources.readers import (  # noqa: F401
    read_csv, read_dated, read_evolving, read_jdbc, read_json, write_partitioned, write_snappy,
)
