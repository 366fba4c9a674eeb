"""Synthesis of the eight insurance tables as Spark jobs.

Every value is derived from the row id by integer arithmetic
(:func:`rnd`), so a table is the same whatever the partitioning, and any SQL
engine can compute the same rows. The ids come from a DataFrame with a column
``id`` (``spark.range`` or keys of existing tables): the work is one
projection per row, fully parallel, no shuffle (tariffs add one generator).

The rules reproduce those of the original data generator: states decide which
dates are open (``9999-12-31``) and which causes are blank, request and issue
dates are the day before the effect date, two tariffs per policy with the
second at premium 0, participants of client i on policy i + 999. Names and
addresses are derived text, not realistic ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestdoc.functions.dates import OPEN_END, as_text, days_between
from nestdoc.functions.text import clean_text, pick, slice_text

# --- fixed values: generator rules -------------------------------------------
DAY_FIRST = "2020-10-11"
DAY_LAST = "2022-07-06"
ACCOUNT_DAY_FIRST = "2000-10-11"
EXPIRY_LAST = "2030-07-06"
BIRTH_FIRST = "1922-07-06"  # age 100 on DAY_LAST
BIRTH_LAST = "2007-07-06"  # age 15 on DAY_LAST
POLICY_STATES = ["PV", "PA", "PS"]
PAYMENT_FORMS = ["A", "S", "T", "M", "U"]
END_CAUSES = ["FP", "FA", "CL", "TR"]
SUSPENSION_CAUSES = ["FP", "CL"]
CLAIM_STATES = ["AB", "CE"]
CLAIM_TYPES = ["FA", "IN", "RE"]
PAYMENT_STATES = ["AN", "CO"]
PAYMENT_TYPES = ["T", "E"]
TARIFFS = ["TS1", "TF1"]
OPEN_CLOSED = ["A", "B"]
RECEIPT_STATES = ["CO", "AN"]
RECEIPT_ORIGINS = ["MA", "AU"]
PARTICIPATION_TYPE = "AS"
PARTICIPATION_ORDER = "1"
PARTICIPANT_POLICY_OFFSET = 999
AMOUNT_MIN, AMOUNT_SPAN = 100, 99900  # 100..99999
CONSORTIUM_MIN, CONSORTIUM_SPAN = 1, 99  # 1..99
COMMISSION_MIN, COMMISSION_SPAN = 1, 34  # 1..34
# Row counts of one run of the original generator, by table.
DEFAULT_ROWS = {
    "accounts": 999,
    "clients": 999,
    "policies": 1999,
    "claims": 3999,
    "payments": 5999,
    "tariffs": 1999,  # policies; two rows each
    "receipts": 7999,
    "participants": 1000,
}
# ------------------------------------------------------------------------------

MODULUS = 2147483647
MULTIPLIER = 48271
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def stream_salts(stream: int) -> tuple[int, int]:
    return (stream * 7919 + 1) % MODULUS, (stream * 104729 + 7) % MODULUS


def rnd(id_col: Column, stream: int) -> Column:
    """Pseudo-random integer in [0, 2^31 - 1) from (id, stream).

    One multiplicative step, then a square to break linearity; every term
    stays below 2^63 for ids below 2^31.
    """
    s1, s2 = stream_salts(stream)
    r1 = F.pmod(id_col.cast("bigint") * F.lit(MULTIPLIER) + F.lit(s1), F.lit(MODULUS))
    return F.pmod(r1 * r1 + F.lit(s2), F.lit(MODULUS))


def _day(start: str, end: str, r: Column) -> Column:
    """A day in [start, end] (fixed texts)."""
    return as_text(F.date_add(F.to_date(F.lit(start)), F.pmod(r, F.lit(days_between(start, end))).cast("int")))


def _day_from(start: Column, end: str, r: Column) -> Column:
    """A day in [start, end], start a date text column."""
    d = F.to_date(start)
    span = F.datediff(F.to_date(F.lit(end)), d) + F.lit(1)
    return as_text(F.date_add(d, F.pmod(r, span).cast("int")))


def _minus_one(day: Column) -> Column:
    return as_text(F.date_sub(F.to_date(day), 1))


def _open_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, value).otherwise(F.lit(OPEN_END))


def _blank_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, value).otherwise(F.lit(" "))


def _amount(r: Column, lo: int, span: int) -> Column:
    return (F.pmod(r, F.lit(span)) + F.lit(lo)).cast("double")


def _digits(r: Column, width: int) -> Column:
    return F.lpad(r.cast("string"), width, "0")


def accounts(ids: DataFrame) -> DataFrame:
    """G1: one account per id; parts cut from the account number."""
    i = F.col("id")
    iban = F.concat(
        F.lit("ES"), _digits(F.pmod(rnd(i, 1), F.lit(100)), 2), _digits(rnd(i, 2), 10), _digits(rnd(i, 3), 10)
    )
    state = pick(OPEN_CLOSED, rnd(i, 4))
    start = _day(ACCOUNT_DAY_FIRST, DAY_LAST, rnd(i, 5))
    return ids.select(i.alias("_id"), iban.alias("iban_total"), state.alias("situacion"), start.alias("fecha_alta")).select(
        F.col("_id").cast("int").alias("idcuenta"),
        F.col("_id").cast("int").alias("idcliente"),
        slice_text("iban_total", 5, 4).alias("empresa"),
        slice_text("iban_total", 9, 4).alias("oficina"),
        slice_text("iban_total", 13, 3).alias("digcontrol"),
        slice_text("iban_total", 16).alias("contrato"),
        "situacion",
        "fecha_alta",
        _open_unless(F.col("situacion") != "A", _day_from(F.col("fecha_alta"), DAY_LAST, rnd(F.col("_id"), 6))).alias(
            "fecha_baja"
        ),
        "iban_total",
    )


def clients(ids: DataFrame) -> DataFrame:
    """Derived names; address without commas or newlines; id number upper case."""
    i = F.col("id")
    address = F.concat(
        F.lit("Calle "), (F.pmod(rnd(i, 5), F.lit(200)) + 1).cast("string"), F.lit(", "),
        (F.pmod(rnd(i, 6), F.lit(100)) + 1).cast("string"), F.lit("\n"),
        _digits(F.pmod(rnd(i, 7), F.lit(100000)), 5), F.lit(" Ciudad "), F.pmod(rnd(i, 8), F.lit(50)).cast("string"),
    )
    letter = F.substring(F.lit(LETTERS), (F.pmod(rnd(i, 10), F.lit(26)) + 1).cast("int"), 1)
    return ids.select(
        i.cast("int").alias("idcliente"),
        F.concat(F.lit("Nombre"), F.pmod(rnd(i, 1), F.lit(500)).cast("string")).alias("nombre"),
        F.concat(
            F.lit("Apellido"), F.pmod(rnd(i, 2), F.lit(300)).cast("string"),
            F.lit(" Apellido"), F.pmod(rnd(i, 3), F.lit(300)).cast("string"),
        ).alias("apellidos"),
        _day(BIRTH_FIRST, BIRTH_LAST, rnd(i, 4)).alias("fecnaci"),
        clean_text(address).alias("direccion"),
        F.upper(F.concat(_digits(F.pmod(rnd(i, 9), F.lit(100000000)), 8), letter)).alias("numdni"),
    )


def policies(ids: DataFrame) -> DataFrame:
    """The state decides which of end / suspension is open and which cause is blank."""
    i = F.col("id")
    base = ids.select(
        i.alias("_id"),
        pick(POLICY_STATES, rnd(i, 4)).alias("pol_estado"),
        _day(DAY_FIRST, DAY_LAST, rnd(i, 1)).alias("fecha_efecto"),
    )
    eff, st, j = F.col("fecha_efecto"), F.col("pol_estado"), F.col("_id")
    return base.select(
        j.cast("int").alias("numpoliza"),
        "pol_estado",
        "fecha_efecto",
        _minus_one(eff).alias("fecha_sol"),
        _day_from(eff, EXPIRY_LAST, rnd(j, 2)).alias("fecha_vencimiento"),
        pick(PAYMENT_FORMS, rnd(j, 3)).alias("formapago"),
        _open_unless(st == "PA", _day_from(eff, DAY_LAST, rnd(j, 5))).alias("fecha_baja"),
        _blank_unless(st == "PA", pick(END_CAUSES, rnd(j, 6))).alias("causa_baja"),
        _open_unless(st == "PS", _day_from(eff, DAY_LAST, rnd(j, 7))).alias("fecha_suspension"),
        _blank_unless(st == "PS", pick(SUSPENSION_CAUSES, rnd(j, 8))).alias("causa_suspen"),
    )


def claims(ids: DataFrame, n_policies: int = DEFAULT_ROWS["policies"]) -> DataFrame:
    """A policy drawn from 1..n_policies; open claims have an open closing date."""
    i = F.col("id")
    base = ids.select(
        i.alias("_id"),
        _day(DAY_FIRST, DAY_LAST, rnd(i, 3)).alias("fecha_apertura"),
        pick(CLAIM_STATES, rnd(i, 6)).alias("estado"),
    )
    j = F.col("_id")
    return base.select(
        j.cast("int").alias("idsiniestro"),
        (F.pmod(rnd(j, 1), F.lit(n_policies)) + 1).cast("int").alias("idpoliza"),
        _day(DAY_FIRST, DAY_LAST, rnd(j, 2)).alias("fecha_ocurs"),
        "fecha_apertura",
        _open_unless(F.col("estado") != "AB", _day_from(F.col("fecha_apertura"), DAY_LAST, rnd(j, 4))).alias(
            "fecha_cierre"
        ),
        pick(CLAIM_TYPES, rnd(j, 5)).alias("tipo_siniestro"),
        "estado",
    )


def payments(ids: DataFrame, n_claims: int = DEFAULT_ROWS["claims"]) -> DataFrame:
    """A claim drawn from 1..n_claims; annulled payments have an open date."""
    i = F.col("id")
    state = pick(PAYMENT_STATES, rnd(i, 2))
    return ids.select(
        i.cast("int").alias("idpago"),
        (F.pmod(rnd(i, 1), F.lit(n_claims)) + 1).cast("int").alias("idsiniestro"),
        state.alias("estado"),
        _open_unless(state != "AN", _day(DAY_FIRST, DAY_LAST, rnd(i, 3))).alias("fecha_pago"),
        _amount(rnd(i, 4), AMOUNT_MIN, AMOUNT_SPAN).alias("importe_pago"),
        pick(PAYMENT_TYPES, rnd(i, 5)).alias("tipo_pago"),
    )


def tariffs(ids: DataFrame) -> DataFrame:
    """Two rows per policy; the second tariff is the other one, at premium 0."""
    i = F.col("id")
    first = F.pmod(rnd(i, 1), F.lit(2))
    state = pick(OPEN_CLOSED, rnd(i, 2))
    rows = F.array(
        F.struct(pick(TARIFFS, first).alias("tarifa"), (F.pmod(rnd(i, 5), F.lit(AMOUNT_SPAN)) + AMOUNT_MIN).cast("string").alias("importe_prima")),
        F.struct(pick(TARIFFS, first + 1).alias("tarifa"), F.lit("0").alias("importe_prima")),
    )
    return ids.select(
        i.cast("int").alias("num_poliza"),
        state.alias("situacion"),
        _day(DAY_FIRST, DAY_LAST, rnd(i, 3)).alias("fecha_alta"),
        _open_unless(state != "A", _day(DAY_FIRST, DAY_LAST, rnd(i, 4))).alias("fecha_baja"),
        F.inline(rows),
    ).select("num_poliza", "tarifa", "situacion", "fecha_alta", "fecha_baja", "importe_prima")


def receipts(ids: DataFrame, n_policies: int = DEFAULT_ROWS["policies"]) -> DataFrame:
    """Issue date is the day before the effect date; amounts in header order."""
    i = F.col("id")
    eff = _day(DAY_FIRST, DAY_LAST, rnd(i, 1))
    return ids.select(i.alias("_id"), eff.alias("fecha_efecto")).select(
        F.col("_id").cast("int").alias("idrecibo"),
        _minus_one(F.col("fecha_efecto")).alias("fecha_emision"),
        "fecha_efecto",
        (F.pmod(rnd(F.col("_id"), 2), F.lit(n_policies)) + 1).cast("int").alias("idpoliza"),
        pick(RECEIPT_STATES, rnd(F.col("_id"), 3)).alias("situacion"),
        pick(RECEIPT_ORIGINS, rnd(F.col("_id"), 4)).alias("origen"),
        _amount(rnd(F.col("_id"), 5), AMOUNT_MIN, AMOUNT_SPAN).alias("importe_prima"),
        _amount(rnd(F.col("_id"), 6), CONSORTIUM_MIN, CONSORTIUM_SPAN).alias("importe_consorcio"),
        _amount(rnd(F.col("_id"), 7), COMMISSION_MIN, COMMISSION_SPAN).alias("importe_comision"),
    )


def participants(ids: DataFrame, offset: int = PARTICIPANT_POLICY_OFFSET) -> DataFrame:
    """Client i takes part in policy i + offset; the open end date goes with state B."""
    i = F.col("id")
    state = pick(OPEN_CLOSED, rnd(i, 1))
    return ids.select(
        i.cast("int").alias("idcliente"),
        (i + F.lit(offset)).cast("int").alias("numpoliza"),
        F.lit(PARTICIPATION_TYPE).alias("tipo_intervencio"),
        state.alias("estado"),
        _day(DAY_FIRST, DAY_LAST, rnd(i, 2)).alias("fecha_alta"),
        _open_unless(state != "B", _day(DAY_FIRST, DAY_LAST, rnd(i, 3))).alias("fecha_baja"),
        F.lit(PARTICIPATION_ORDER).alias("orden_inter"),
    )


GENERATORS = {
    "accounts": accounts,
    "clients": clients,
    "policies": policies,
    "claims": claims,
    "payments": payments,
    "tariffs": tariffs,
    "receipts": receipts,
    "participants": participants,
}


def ids_range(spark: SparkSession, n: int, start: int = 1) -> DataFrame:
    """Ids start..start+n-1 as a distributed range."""
    return spark.range(start, start + n)


def synth(spark: SparkSession, table: str, n: int | None = None, **params) -> DataFrame:
    """Synthesise ``table`` for ids 1..n (default: one run of the original generator)."""
    if table not in GENERATORS:
        raise ValueError(f"unknown table {table!r}; one of {sorted(GENERATORS)}")
    n = DEFAULT_ROWS[table] if n is None else n
    return GENERATORS[table](ids_range(spark, n), **params)


def synth_all(spark: SparkSession, rows: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """All eight tables, consistent with each other (foreign keys in range)."""
    rows = {**DEFAULT_ROWS, **(rows or {})}
    return {
        "accounts": synth(spark, "accounts", rows["accounts"]),
        "clients": synth(spark, "clients", rows["clients"]),
        "policies": synth(spark, "policies", rows["policies"]),
        "claims": synth(spark, "claims", rows["claims"], n_policies=rows["policies"]),
        "payments": synth(spark, "payments", rows["payments"], n_claims=rows["claims"]),
        "tariffs": synth(spark, "tariffs", rows["tariffs"]),
        "receipts": synth(spark, "receipts", rows["receipts"], n_policies=rows["policies"]),
        "participants": synth(spark, "participants", rows["participants"]),
    }
