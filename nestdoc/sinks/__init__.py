"""Outputs: Parquet files and tables, with a run report."""

from .writers import RunReport, persist, publish, read_clustered, write_clustered, write_parquet

__all__ = ["RunReport", "persist", "publish", "read_clustered", "write_clustered", "write_parquet"]
