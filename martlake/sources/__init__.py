"""Readers: raw CSV with explicit schemas, written Parquet layers, JDBC, and
the mapping from the driver's test tables onto the six source tables."""

from martlake.sources.files import ingest, ingest_all, read_layer, read_source_csv
from martlake.sources.jdbc import read_jdbc

__all__ = ["ingest", "ingest_all", "read_jdbc", "read_layer", "read_source_csv"]
