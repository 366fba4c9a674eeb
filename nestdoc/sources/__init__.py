"""Inputs: fixed schemas, delimited/Parquet readers, stand-in roles."""

from .delimited import HeaderError, load_checked, load_tables, read_checked, read_delimited, read_parquet
from .schemas import SCHEMAS

__all__ = ["SCHEMAS", "HeaderError", "load_checked", "load_tables", "read_checked", "read_delimited", "read_parquet"]
