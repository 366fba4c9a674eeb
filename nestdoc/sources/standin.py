"""The insurance roles played by the driver's TPC-H-like tables.

Each role table carries the insurance key names (so the same document plan
runs on it) and keeps its own payload columns. Dates become ``yyyy-MM-dd``
text, as in the insurance tables. All of it is projection and filtering over
Parquet scans, so Catalyst pushes both into the reader.

| role         | source                  | key               | foreign key(s)       |
| policies     | customer                | numpoliza         |                      |
| claims       | orders                  | idsiniestro       | idpoliza             |
| payments     | lineitem                |                   | idsiniestro          |
| receipts     | events                  | idrecibo          | idpoliza             |
| tariffs      | customer, two rows each | num_poliza+tarifa | num_poliza           |
| participants | customer                |                   | numpoliza, idcliente |
| clients      | customer                | idcliente         |                      |
| accounts     | events                  | idcuenta          | idcliente            |

:func:`insurance_tables` gives the same rows with exactly the insurance columns
and types, as the delimited files of the job have them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SCHEMAS

SOURCE_TABLES = ("customer", "orders", "lineitem", "events")


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def policies(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("numpoliza"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def claims(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("idsiniestro"),
        F.col("o_custkey").alias("idpoliza"),
        _day("o_orderdate").alias("fecha_ocurs"),
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    )


def payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("idsiniestro"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        _day("l_shipdate").alias("fecha_pago"),
    )


def receipts(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("idrecibo"),
        F.col("user_id").alias("idpoliza"),
        _day("ts").alias("fecha_efecto"),
        "event_type",
        F.col("value").alias("importe_prima"),
        "props",
    )


def tariffs(customer: DataFrame) -> DataFrame:
    """Two rows per customer: TS1 carries the balance, TF1 zero."""
    two = F.array(
        F.struct(F.lit("TS1").alias("tarifa"), F.col("c_acctbal").alias("importe_prima")),
        F.struct(F.lit("TF1").alias("tarifa"), F.lit(0.0).alias("importe_prima")),
    )
    return customer.select(F.col("c_custkey").alias("num_poliza"), F.inline(two))


def participants(customer: DataFrame) -> DataFrame:
    """Every customer takes part in its own policy, so a client's accounts are copied once."""
    return customer.select(
        F.col("c_custkey").alias("idcliente"),
        F.col("c_custkey").alias("numpoliza"),
        F.col("c_mktsegment").alias("tipo_intervencio"),
    )


def clients(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("idcliente"), F.col("c_name").alias("n_name"), F.col("c_nationkey").alias("n_regionkey"))


def accounts(events: DataFrame) -> DataFrame:
    """A customer's events are its client's accounts; customers without events have none."""
    return events.select(
        F.col("event_id").alias("idcuenta"),
        F.col("user_id").alias("idcliente"),
        F.col("event_type").alias("s_name"),
        F.col("value").alias("s_acctbal"),
    )


# role -> (source table, projection)
ROLES = {
    "policies": ("customer", policies),
    "claims": ("orders", claims),
    "payments": ("lineitem", payments),
    "receipts": ("events", receipts),
    "tariffs": ("customer", tariffs),
    "participants": ("customer", participants),
    "clients": ("customer", clients),
    "accounts": ("events", accounts),
}


class Roles(Mapping):
    """The eight insurance tables, played by the driver's tables under sf_dir.

    A role is built on first use and its source table opened then (listing
    and footer read), so a query that needs two roles opens only their files.
    Roles of one source share its DataFrame.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._roles: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in ROLES:
            raise KeyError(role)
        if role not in self._roles:
            source, make = ROLES[role]
            if source not in self._sources:
                self._sources[source] = read_source(self._spark, self._dir, source)
            self._roles[role] = make(self._sources[source])
        return self._roles[role]

    def __contains__(self, role: object) -> bool:
        return role in ROLES

    def __iter__(self) -> Iterator[str]:
        return iter(ROLES)

    def __len__(self) -> int:
        return len(ROLES)


def load_roles(spark: SparkSession, sf_dir: str) -> Roles:
    """The eight insurance tables, played by the driver's tables under sf_dir."""
    return Roles(spark, sf_dir)


def insurance_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight tables with the fixed insurance schemas; what the sources do not tell is null."""
    customer, orders = read_source(spark, sf_dir, "customer"), read_source(spark, sf_dir, "orders")
    lineitem, events = read_source(spark, sf_dir, "lineitem"), read_source(spark, sf_dir, "events")
    two = F.explode(F.array(F.lit("TS1"), F.lit("TF1")))
    filled = {
        "policies": (customer, {"numpoliza": "c_custkey", "pol_estado": "c_mktsegment"}),
        "claims": (orders, {
            "idsiniestro": "o_orderkey", "idpoliza": "o_custkey", "fecha_ocurs": _day("o_orderdate"),
            "tipo_siniestro": "o_orderpriority", "estado": "o_orderstatus",
        }),
        "payments": (lineitem, {
            "idpago": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "idsiniestro": "l_orderkey", "estado": "l_linestatus",
            "fecha_pago": _day("l_shipdate"), "importe_pago": "l_extendedprice", "tipo_pago": "l_returnflag",
        }),
        "receipts": (events, {
            "idrecibo": "event_id", "fecha_efecto": _day("ts"), "idpoliza": "user_id", "situacion": "event_type", "importe_prima": "value",
        }),
        "tariffs": (customer.select("*", two.alias("t")), {
            "num_poliza": "c_custkey", "tarifa": "t", "importe_prima": F.when(F.col("t") == "TS1", F.col("c_nationkey")).otherwise(0),
        }),
        "clients": (customer, {"idcliente": "c_custkey", "nombre": "c_name"}),
        "accounts": (events, {"idcuenta": "event_id", "idcliente": "user_id", "empresa": "event_type"}),
        "participants": (customer, {"idcliente": "c_custkey", "numpoliza": "c_custkey", "tipo_intervencio": "c_mktsegment"}),
    }
    out = {}
    for name, (source, columns) in filled.items():
        cols = [columns.get(f.name, F.lit(None)) for f in SCHEMAS[name]]
        cols = [F.col(c) if isinstance(c, str) else c for c in cols]
        out[name] = source.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, SCHEMAS[name], strict=True)])
    return out
