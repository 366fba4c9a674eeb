"""Fixed input schemas of the eight insurance tables.

Fixed values: the column names, order and types below must equal the job being
rebuilt, because CSV columns are bound by position and the document's field
names come from them. Keys are declared not-null there; a CSV read does not
enforce it, so every field is nullable here.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

_I, _S, _D = IntegerType(), StringType(), DoubleType()


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- fixed values: table schemas (name, type) in file column order -------------
ACCOUNTS = _schema(
    ("idcuenta", _I), ("idcliente", _I), ("empresa", _S), ("oficina", _S),
    ("digcontrol", _S), ("contrato", _S), ("situacion", _S), ("fecha_alta", _S),
    ("fecha_baja", _S), ("iban_total", _S),
)
CLIENTS = _schema(
    ("idcliente", _I), ("nombre", _S), ("apellidos", _S), ("fecnaci", _S),
    ("direccion", _S), ("numdni", _S),
)
CLAIMS = _schema(
    ("idsiniestro", _I), ("idpoliza", _I), ("fecha_ocurs", _S), ("fecha_apertura", _S),
    ("fecha_cierre", _S), ("tipo_siniestro", _S), ("estado", _S),
)
PAYMENTS = _schema(
    ("idpago", _I), ("idsiniestro", _I), ("estado", _S), ("fecha_pago", _S),
    ("importe_pago", _D), ("tipo_pago", _S),
)
TARIFFS = _schema(
    ("num_poliza", _I), ("tarifa", _S), ("situacion", _S), ("fecha_alta", _S),
    ("fecha_baja", _S), ("importe_prima", _S),
)
RECEIPTS = _schema(
    ("idrecibo", _I), ("fecha_emision", _S), ("fecha_efecto", _S), ("idpoliza", _I),
    ("situacion", _S), ("origen", _S), ("importe_prima", _D),
    ("importe_consorcio", _D), ("importe_comision", _D),
)
PARTICIPANTS = _schema(
    ("idcliente", _I), ("numpoliza", _I), ("tipo_intervencio", _S), ("estado", _S),
    ("fecha_alta", _S), ("fecha_baja", _S), ("orden_inter", _S),
)
POLICIES = _schema(
    ("numpoliza", _I), ("pol_estado", _S), ("fecha_efecto", _S), ("fecha_sol", _S),
    ("fecha_vencimiento", _S), ("formapago", _S), ("fecha_baja", _S),
    ("causa_baja", _S), ("fecha_suspension", _S), ("causa_suspen", _S),
)
# --- end of fixed values --------------------------------------------------------

SCHEMAS: dict[str, StructType] = {
    "policies": POLICIES,
    "claims": CLAIMS,
    "payments": PAYMENTS,
    "receipts": RECEIPTS,
    "tariffs": TARIFFS,
    "clients": CLIENTS,
    "accounts": ACCOUNTS,
    "participants": PARTICIPANTS,
}

TABLES: tuple[str, ...] = tuple(SCHEMAS)
