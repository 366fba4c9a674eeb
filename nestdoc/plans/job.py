"""The whole job (C8): load the eight tables, build the policy document, write it.

``python -m nestdoc SOURCE TARGET`` runs it from ``spark-submit``. In the plain
form building runs only the size checks of its lookups before the write; the
paged form also counts heavy keys and writes those it finds. Errors raise (no
exit codes).
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from pyspark.sql import SparkSession

from ..sinks.writers import LEVELS, RunReport, publish, write_parquet
from ..sources.delimited import load_tables
from . import insurance
from .accounts import accounted
from .spec import DEFAULT_MAX_ITEMS, BuildOptions, build

log = logging.getLogger("nestdoc")


def paged(max_items: int = DEFAULT_MAX_ITEMS) -> BuildOptions:
    """Options of the paged form; the job's tables are file scans, so stable inputs."""
    return BuildOptions(max_items=max_items, stable_inputs=True)


def run_job(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "csv",
    strict: bool = False,
    files: int | None = None,
    as_table: bool = False,
    opts: BuildOptions | None = None,
    how_tariffs: str = "inner",
    how_participants: str = "inner",
    accounts: bool = False,
) -> RunReport:
    """Load ``source`` (a folder with policies.csv, claims.csv, ...), build the
    document and write it to ``target`` (a path, or a table name).

    The form of the document is the caller's choice, never the data's. By
    default it is one row per policy with 14 columns and whole lists;
    ``opts=paged()`` gives rows (policy, page) whose pages follow the lists'
    sort order and hold DEFAULT_MAX_ITEMS items of a list at most.

    ``accounts`` adds to the report what became of every input's rows, counted
    while the document is written (whole lists only).
    """
    opts = opts or BuildOptions()
    tables = load_tables(spark, source, fmt=fmt, strict=strict)
    spec = insurance.policy_spec(how_tariffs, how_participants)
    doc, finish = accounted(spec, tables, opts) if accounts else (build(spec, tables, opts), tuple)
    if as_table:
        report = publish(doc, target, files=files, label="policy document")
    else:
        report = write_parquet(doc, target, files=files, label="policy document")
    report = replace(report, accounts=finish())
    log.info("wrote %d documents to %s in %.1f s", report.rows, report.target, report.seconds)
    for a in report.accounts:
        log.info("%s: %d rows, %d in the document, %d without key, %d left out", a.name, a.rows, a.in_document, a.no_key, a.left_out)
    return report


def main(argv: list[str] | None = None) -> RunReport:
    p = argparse.ArgumentParser(prog="nestdoc", description="Build the policy document.")
    p.add_argument("source", help="folder holding the eight input tables")
    p.add_argument("target", help="output path (or table name with --table)")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--strict", action="store_true", help="fail on bad rows and header names")
    p.add_argument("--files", type=int, default=None, help="number of output files")
    p.add_argument("--table", action="store_true", help="publish as a table named TARGET")
    p.add_argument(
        "--max-items", type=int, default=0,
        help="page lists at this many items (0: one whole list per key)",
    )
    p.add_argument("--accounts", action="store_true", help="report what became of every input's rows")
    p.add_argument("--persist", choices=sorted(LEVELS), default=None)
    p.add_argument("--checkpoint-lists", action="store_true", help="checkpoint nested lists before the joins")
    p.add_argument("--left-tariffs", action="store_true", help="keep policies without tariff")
    p.add_argument("--left-participants", action="store_true", help="keep policies without participant")
    a = p.parse_args(argv)
    from ..session import get_spark

    spark = get_spark(app="nestdoc-job")
    opts = BuildOptions(
        max_items=a.max_items or None,
        persist=LEVELS[a.persist] if a.persist else None,
        checkpoint_lists=a.checkpoint_lists,
        stable_inputs=True,
    )
    return run_job(
        spark, a.source, a.target, fmt=a.format, strict=a.strict, files=a.files, as_table=a.table, opts=opts,
        how_tariffs="left" if a.left_tariffs else "inner",
        how_participants="left" if a.left_participants else "inner",
        accounts=a.accounts,
    )
