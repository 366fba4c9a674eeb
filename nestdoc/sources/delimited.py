"""Readers for the flat input tables.

Contract kept from the job being rebuilt:

* columns are bound by position to the fixed schema; header names are not read;
* the first line is always skipped as a header;
* parse mode is Spark's default (PERMISSIVE): a bad number or a missing trailing
  field gives null, extra fields are dropped, an empty field gives null and a
  single blank stays a blank;
* opening fails for a missing path, when the table is declared, not when read.

``strict=True`` is the opt-in alternative: FAILFAST parsing, and the header of
every file must equal the schema, which is checked when the table is opened.
``load_checked`` checks headers too but does not stop at bad rows: it gives
them back, line by line, in a table of their own.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import q
from .schemas import SCHEMAS

LINE = "_line"


class HeaderError(ValueError):
    """A file whose header does not name the schema's columns in their order."""


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    sep: str = ",",
    header: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Read delimited text with a fixed schema (one task per file split)."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if strict:
        if header:
            check_headers(spark, path, schema, sep=sep)
        reader = reader.option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.csv(path)


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a file, compressed or not; only its beginning is read."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def check_headers(spark: SparkSession, path: str, schema: StructType, *, sep: str = ",") -> None:
    """Raise :class:`HeaderError` unless every file's first line names the schema's columns. An empty
    file has no header and no rows, and passes."""
    wanted = [f.name for f in schema]
    wrong = []
    for file in spark.read.text(path).inputFiles():
        line = first_line(spark, file).lstrip("\ufeff")
        names = [n.strip() for n in next(csv.reader([line], delimiter=sep), [])]
        if line and names != wanted:
            wrong.append(f"{file}: {names}")
    if wrong:
        raise HeaderError(f"header is not {wanted} in " + "; ".join(wrong[:5]) + ("; ..." if len(wrong) > 5 else ""))


def read_checked(spark: SparkSession, path: str, schema: StructType, *, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows that parse, and the others as (file, line).

    A row is bad if a field does not parse as its type or if it has more or
    fewer fields than the schema. Every line that Spark reads as a record is
    in exactly one of the two, whatever columns are used later: all are parsed.
    """
    if header:
        check_headers(spark, path, schema, sep=sep)
    wide = StructType([*schema.fields, StructField(LINE, StringType())])
    rows = (
        spark.read.schema(wide).option("sep", sep).option("header", header).option("columnNameOfCorruptRecord", LINE)
        .csv(path)
    )
    # Spark parses only what a query uses, so a condition that every row meets uses all columns.
    read = F.xxhash64(*[q(f.name) for f in schema]) >= F.lit(-(1 << 63))
    good = rows.where(q(LINE).isNull() & read).drop(LINE)
    bad = rows.select("*", F.col("_metadata.file_path").alias("_path")).where(q(LINE).isNotNull() & read)
    return good, bad.select(F.col("_path").alias("file"), q(LINE).alias("line"))


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet input: columnar, with filter and column pushdown into the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def default_paths(root: str, fmt: str = "csv") -> dict[str, str]:
    ext = {"csv": "csv", "parquet": "parquet"}[fmt]
    root = root.rstrip("/")
    return {name: f"{root}/{name}.{ext}" for name in SCHEMAS}


def load_tables(
    spark: SparkSession,
    root: str | None = None,
    *,
    paths: Mapping[str, str] | None = None,
    fmt: str = "csv",
    names: Iterable[str] | None = None,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """Declare all input tables at once.

    A path that cannot be opened raises (AnalysisException) for the whole call,
    so a run never starts on half of its inputs.
    """
    if paths is None:
        if root is None:
            raise ValueError("give root or paths")
        paths = default_paths(root, fmt)
    wanted = list(names) if names is not None else list(SCHEMAS)
    missing = [n for n in wanted if n not in paths]
    if missing:
        raise ValueError(f"no path for tables: {missing}")
    tables: dict[str, DataFrame] = {}
    for name in wanted:
        schema = SCHEMAS[name]
        if fmt == "csv":
            tables[name] = read_delimited(spark, paths[name], schema, strict=strict)
        elif fmt == "parquet":
            tables[name] = read_parquet(spark, paths[name], schema)
        else:
            raise ValueError(f"unknown format {fmt!r}")
    return tables


class Checked(NamedTuple):
    """Tables of the rows that parse, and (table, file, line) of those that do not."""

    tables: dict[str, DataFrame]
    rejected: DataFrame


def load_checked(
    spark: SparkSession, root: str | None = None, *, paths: Mapping[str, str] | None = None, names: Iterable[str] | None = None
) -> Checked:
    """:func:`load_tables` of delimited text with every header checked and bad rows set aside."""
    if paths is None:
        if root is None:
            raise ValueError("give root or paths")
        paths = default_paths(root)
    wanted = list(names) if names is not None else list(SCHEMAS)
    missing = [n for n in wanted if n not in paths]
    if missing:
        raise ValueError(f"no path for tables: {missing}")
    if not wanted:
        raise ValueError("no tables wanted")
    read = {name: read_checked(spark, paths[name], SCHEMAS[name]) for name in wanted}
    sides = [bad.select(F.lit(name).alias("table"), "file", "line") for name, (_, bad) in read.items()]
    return Checked({name: good for name, (good, _) in read.items()}, reduce(DataFrame.unionByName, sides))
