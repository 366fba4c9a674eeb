"""DuckDB SQL for each registered query (the flat, independent check).

The driver registers its tables as views (customer, orders, lineitem, ...);
each statement first plays the insurance roles on them (same mapping as
:mod:`nestdoc.sources.standin`) and then computes with plain group-bys and
joins what the Spark side computes with nests and list summaries.
Integer counts are BIGINT and money sums exact DECIMAL cast to DOUBLE on both
sides, so values compare exactly.
"""

from __future__ import annotations

ROLES = """
policies AS (
  SELECT c_custkey AS numpoliza, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
claims AS (
  SELECT o_orderkey AS idsiniestro, o_custkey AS idpoliza, strftime(o_orderdate, '%Y-%m-%d') AS fecha_ocurs,
         o_orderstatus, o_orderpriority, o_totalprice
  FROM orders),
payments AS (
  SELECT l_orderkey AS idsiniestro, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS fecha_pago
  FROM lineitem),
receipts AS (
  SELECT event_id AS idrecibo, user_id AS idpoliza, strftime(ts, '%Y-%m-%d') AS fecha_efecto, event_type,
         value AS importe_prima, props
  FROM events),
tariffs AS (
  SELECT c_custkey AS num_poliza, 'TS1' AS tarifa, c_acctbal AS importe_prima FROM customer
  UNION ALL
  SELECT c_custkey, 'TF1', CAST(0 AS DOUBLE) FROM customer),
participants AS (
  SELECT c_custkey AS idcliente, c_custkey AS numpoliza, c_mktsegment AS tipo_intervencio FROM customer),
clients AS (SELECT c_custkey AS idcliente, c_name AS n_name, c_nationkey AS n_regionkey FROM customer),
accounts AS (
  SELECT event_id AS idcuenta, user_id AS idcliente, event_type AS s_name, value AS s_acctbal FROM events)
"""

LISTS = """
pay AS (
  SELECT idsiniestro, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
  FROM payments GROUP BY idsiniestro),
cl AS (
  SELECT c.idpoliza, count(*) AS n_claims, sum(coalesce(pay.n, 0)) AS n_payments,
         sum(coalesce(pay.s, 0)) AS sum_payment
  FROM claims c LEFT JOIN pay ON c.idsiniestro = pay.idsiniestro GROUP BY c.idpoliza),
rc AS (
  SELECT idpoliza, count(*) AS n_receipts, sum(CAST(importe_prima AS DECIMAL(18,2))) AS sum_receipt
  FROM receipts GROUP BY idpoliza),
tf AS (
  SELECT num_poliza, count(*) AS n_tariffs, sum(CAST(importe_prima AS DECIMAL(18,2))) AS sum_tariff
  FROM tariffs GROUP BY num_poliza),
acc AS (
  SELECT idcliente, count(*) AS n, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS s FROM accounts GROUP BY idcliente),
cli AS (SELECT c.idcliente, c.n_name, acc.n, acc.s FROM clients c LEFT JOIN acc ON c.idcliente = acc.idcliente),
pt AS (
  SELECT p.numpoliza, count(*) AS n_participants, count(cli.n_name) AS n_with_client,
         sum(coalesce(cli.n, 0)) AS n_accounts, sum(coalesce(cli.s, 0)) AS sum_accounts
  FROM participants p LEFT JOIN cli ON p.idcliente = cli.idcliente GROUP BY p.numpoliza)
"""

CLAIM_COLS = """CAST(cl.n_claims AS BIGINT) AS n_claims, CAST(cl.n_payments AS BIGINT) AS n_payments,
  CAST(cl.sum_payment AS DOUBLE) AS sum_payment"""
RECEIPT_COLS = """CAST(rc.n_receipts AS BIGINT) AS n_receipts, CAST(rc.sum_receipt AS DOUBLE) AS sum_receipt"""
TARIFF_COLS = """CAST(tf.n_tariffs AS BIGINT) AS n_tariffs, CAST(tf.sum_tariff AS DOUBLE) AS sum_tariff"""
PARTICIPANT_COLS = """CAST(pt.n_participants AS BIGINT) AS n_participants,
  CAST(pt.n_with_client AS BIGINT) AS n_with_client, CAST(pt.n_accounts AS BIGINT) AS n_accounts,
  CAST(pt.sum_accounts AS DOUBLE) AS sum_accounts"""
POLICY_COLS = "p.numpoliza, p.c_name, p.c_nationkey, p.c_acctbal, p.c_mktsegment"


def _with(body: str, lists: bool = True) -> str:
    return "WITH " + ROLES + ("," + LISTS if lists else "") + "\n" + body


POLICY_DOCUMENT = _with(
    "SELECT " + POLICY_COLS + ",\n  " + CLAIM_COLS + ",\n  " + RECEIPT_COLS + ",\n  " + TARIFF_COLS
    + ",\n  " + PARTICIPANT_COLS + """
FROM policies p
LEFT JOIN cl ON p.numpoliza = cl.idpoliza
LEFT JOIN rc ON p.numpoliza = rc.idpoliza
JOIN tf ON p.numpoliza = tf.num_poliza
JOIN pt ON p.numpoliza = pt.numpoliza"""
)

POLICY_CORE = _with(
    "SELECT " + POLICY_COLS + ",\n  " + CLAIM_COLS + ",\n  " + RECEIPT_COLS + ",\n  " + TARIFF_COLS + """
FROM policies p
LEFT JOIN cl ON p.numpoliza = cl.idpoliza
LEFT JOIN rc ON p.numpoliza = rc.idpoliza
JOIN tf ON p.numpoliza = tf.num_poliza"""
)

SQL: dict[str, str] = {
    "policy_document": POLICY_DOCUMENT,
    "parquet_sink": POLICY_DOCUMENT,
    "policy_document_paged": POLICY_DOCUMENT,
    "policy_document_unpaged": POLICY_DOCUMENT,
    "policy_core": POLICY_CORE,
    "claims_with_payments": _with("SELECT cl.idpoliza, " + CLAIM_COLS + " FROM cl"),
    "receipts_by_policy": _with("SELECT rc.idpoliza, " + RECEIPT_COLS + " FROM rc"),
    "tariffs_by_policy": _with("SELECT tf.num_poliza, " + TARIFF_COLS + " FROM tf"),
    "clients_with_accounts": _with(
        """SELECT c.idcliente, c.n_name, c.n_regionkey, CAST(acc.n AS BIGINT) AS n_accounts,
  CAST(acc.s AS DOUBLE) AS sum_accounts
FROM clients c LEFT JOIN acc ON c.idcliente = acc.idcliente"""
    ),
    "participants_by_policy": _with("SELECT pt.numpoliza, " + PARTICIPANT_COLS + " FROM pt"),
    "csv_scan": "SELECT * FROM customer",
    "dropped_policies": _with(
        """SELECT p.* FROM policies p
WHERE NOT EXISTS (SELECT 1 FROM receipts t WHERE t.idpoliza = p.numpoliza)
   OR NOT EXISTS (SELECT 1 FROM participants i WHERE i.numpoliza = p.numpoliza)""", lists=False),
    "join_inner_cols": _with(
        """SELECT c.idsiniestro, c.idpoliza AS numpoliza, c.o_totalprice, p.c_name, p.c_mktsegment
FROM claims c JOIN policies p ON c.idpoliza = p.numpoliza""", lists=False),
    "join_left_cols": _with(
        """SELECT p.*, r.idrecibo, r.event_type, r.importe_prima
FROM policies p LEFT JOIN receipts r ON p.numpoliza = r.idpoliza""", lists=False),
    "join_left_only_cols": _with(
        "SELECT p.* FROM policies p JOIN claims c ON p.numpoliza = c.idpoliza", lists=False),
    "join_expr_key": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, l_linenumber, l_quantity,
  l_extendedprice
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "join_left_anti": _with(
        """SELECT c.* FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM payments y WHERE y.idsiniestro = c.idsiniestro)""", lists=False),
    "join_right_anti": _with(
        """SELECT p.* FROM policies p
WHERE NOT EXISTS (SELECT 1 FROM receipts r WHERE r.idpoliza = p.numpoliza)""", lists=False),
    "project_all_except": _with(
        """SELECT idsiniestro, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
  l_linestatus, fecha_pago FROM payments""", lists=False),
    "pack_struct": _with(
        """SELECT idpoliza, idsiniestro, fecha_ocurs, o_orderstatus, o_orderpriority, o_totalprice
FROM claims""", lists=False),
    "rename_one": _with(
        """SELECT idrecibo, idpoliza, fecha_efecto, event_type AS tipo, importe_prima, props
FROM receipts""", lists=False),
    "rename_suffix": _with(
        """SELECT numpoliza, c_name AS c_name_n, c_nationkey, c_acctbal AS c_acctbal_n, c_mktsegment
FROM policies""", lists=False),
    "nest_one_level": _with(
        """SELECT idsiniestro,
  CAST(row_number() OVER (PARTITION BY idsiniestro ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
    l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
    l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, fecha_pago NULLS FIRST) - 1 AS BIGINT)
    AS pos,
  l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
  l_linestatus, fecha_pago
FROM payments""", lists=False),
    "nest_two_level": _with(
        """SELECT p.numpoliza, p.c_name, c.idsiniestro, c.o_totalprice, y.l_linenumber, y.l_extendedprice,
  y.fecha_pago
FROM policies p
LEFT JOIN claims c ON p.numpoliza = c.idpoliza
LEFT JOIN payments y ON c.idsiniestro = y.idsiniestro""", lists=False),
    "nest_paged": _with(
        """SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_items, true AS pages_bounded,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM payments GROUP BY l_returnflag""", lists=False),
    "nest_ordered_pages": _with(
        """SELECT l_returnflag,
  CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice NULLS FIRST, idsiniestro NULLS FIRST,
    l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
    l_discount NULLS FIRST, l_tax NULLS FIRST, l_linestatus NULLS FIRST, fecha_pago NULLS FIRST) - 1 AS BIGINT) AS pos,
  idsiniestro, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
  fecha_pago
FROM payments""", lists=False),
    "open_ended_rows": """SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus <> 'O' THEN strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d')
       ELSE '9999-12-31' END AS fecha_cierre,
  o_orderstatus = 'O' AS is_open,
  strftime(o_orderdate, '%Y-%m-%d') = '0001-01-01' AS is_open_start
FROM orders""",
    "run_date_columns": _with(
        """SELECT idsiniestro, fecha_ocurs, '2024-06-30' AS run_date, CAST(2024 AS BIGINT) AS run_year,
  '2024-06-29' AS run_day_before,
  CAST(date_diff('day', CAST(fecha_ocurs AS DATE), DATE '2024-06-30') AS BIGINT) AS days_since
FROM claims""", lists=False),
    "day_before": """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS fecha_sol FROM orders""",
    "status_dates": """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 'PA' WHEN o_orderstatus = 'P' THEN 'PS' ELSE 'PV' END AS pol_estado,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '9999-12-31' END AS fecha_baja,
  CASE WHEN o_orderstatus = 'F' THEN 'FP' ELSE ' ' END AS causa_baja,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '9999-12-31' END AS fecha_suspension,
  CASE WHEN o_orderstatus = 'P' THEN 'CL' ELSE ' ' END AS causa_suspen
FROM orders""",
    "split_account": """SELECT c_custkey, c_name, substring(c_name, 5, 4) AS empresa, substring(c_name, 9, 4) AS oficina,
  substring(c_name, 13, 3) AS digcontrol, substring(c_name, 16) AS contrato
FROM customer""",
    "clean_text": """SELECT p_partkey,
  translate(concat_ws(',', p_name, p_type), ',' || chr(10), '; ') AS texto,
  upper(translate(concat_ws(chr(10), p_name, p_brand), ',' || chr(10), '; ')) AS texto_mayus
FROM part""",
    "date_in_range": """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INTEGER), '%Y-%m-%d') AS fecha_cierre
FROM orders""",
    "pick_code": """SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'S' WHEN 2 THEN 'T' WHEN 3 THEN 'M' ELSE 'U' END AS formapago
FROM customer""",
    "integer_in_range": """SELECT l_orderkey, l_linenumber, 100 + l_partkey % 99900 AS importe, 1 + l_suppkey % 34 AS comision FROM lineitem""",
    "key_offset": """SELECT c_custkey AS idcliente, c_custkey + 999 AS numpoliza FROM customer""",
    "format_row": """SELECT c_custkey,
  concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment) AS linea,
  printf('%s|%05d', c_mktsegment, c_nationkey) AS codigo
FROM customer""",
}

_SPLIT_MATCHED = """SELECT 'matched' AS part, c.idsiniestro, c.idpoliza, c.o_totalprice, y.l_linenumber,
  y.l_extendedprice
FROM claims c JOIN payments y ON c.idsiniestro = y.idsiniestro"""
_SPLIT_LEFT = """SELECT 'left_only' AS part, c.idsiniestro, c.idpoliza, c.o_totalprice, NULL, NULL
FROM claims c WHERE NOT EXISTS (SELECT 1 FROM payments y WHERE y.idsiniestro = c.idsiniestro)"""
_SPLIT_RIGHT = """SELECT 'right_only' AS part, y.idsiniestro, NULL, NULL, y.l_linenumber, y.l_extendedprice
FROM payments y WHERE NOT EXISTS (SELECT 1 FROM claims c WHERE c.idsiniestro = y.idsiniestro)"""
_SPLIT_POLICIES = """SELECT 'matched' AS part, p.numpoliza, r.idrecibo, r.importe_prima, p.c_name
FROM receipts r JOIN policies p ON r.idpoliza = p.numpoliza
UNION ALL
SELECT 'right_only', p.numpoliza, NULL, NULL, p.c_name
FROM policies p WHERE NOT EXISTS (SELECT 1 FROM receipts r WHERE r.idpoliza = p.numpoliza)"""

SQL["join_split_left"] = _with(_SPLIT_MATCHED + "\nUNION ALL\n" + _SPLIT_LEFT, lists=False)
SQL["join_split_both"] = _with(
    _SPLIT_MATCHED + "\nUNION ALL\n" + _SPLIT_LEFT + "\nUNION ALL\n" + _SPLIT_RIGHT, lists=False
)
SQL["join_split_right"] = _with(_SPLIT_POLICIES, lists=False)


def _items(name: str, key: str, parent: str, group: str, fields: list[str], source: str) -> str:
    """Rows of one list: place by all fields in order within a group, fields as text."""
    plain = [f.lstrip("$") for f in fields]
    text = ", ".join(f"coalesce(CAST({f'CAST({f[1:]} AS DECIMAL(18,2))' if f[0] == '$' else f} AS VARCHAR), '~')" for f in fields)
    order = ", ".join(f"{f} NULLS FIRST" for f in plain)
    return f"""SELECT {key} AS numpoliza, '{name}' AS list, CAST({parent} AS BIGINT) AS parent,
  CAST(row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS BIGINT) AS pos, concat_ws('|', {text}) AS item
FROM {source}"""


SQL["document_items"] = _with(
    "\nUNION ALL\n".join(
        [
            _items(
                "datos_sin", "idpoliza", "NULL", "idpoliza",
                ["idsiniestro", "fecha_ocurs", "o_orderstatus", "o_orderpriority", "$o_totalprice"], "claims",
            ),
            _items(
                "datos_recibos", "idpoliza", "NULL", "idpoliza",
                ["idrecibo", "fecha_efecto", "event_type", "$importe_prima", "props"], "receipts",
            ),
            _items("datos_tarifa", "num_poliza", "NULL", "num_poliza", ["tarifa", "$importe_prima"], "tariffs"),
            _items(
                "datos_cliente", "numpoliza", "NULL", "numpoliza", ["idcliente", "tipo_intervencio", "n_name", "n_regionkey"],
                "(SELECT p.*, n_name, n_regionkey FROM participants p LEFT JOIN clients USING (idcliente))",
            ),
            _items(
                "datos_pago", "idpoliza", "idsiniestro", "idsiniestro",
                ["l_linenumber", "l_partkey", "l_suppkey", "$l_quantity", "$l_extendedprice", "$l_discount", "$l_tax",
                 "l_returnflag", "l_linestatus", "fecha_pago"],
                "(SELECT y.*, c.idpoliza FROM payments y JOIN claims c USING (idsiniestro))",
            ),
            _items(
                "datos_cuenta", "numpoliza", "idcliente", "numpoliza, idcliente", ["idcuenta", "s_name", "$s_acctbal"],
                "(SELECT a.*, p.numpoliza FROM accounts a JOIN participants p USING (idcliente))",
            ),
        ]
    ),
    lists=False,
)

SQL["document_bounded"] = _with(
    """SELECT p.numpoliza, CAST(cl.n_claims AS BIGINT) AS n_claims, CAST(cl.n_payments AS BIGINT) AS n_payments, true AS bounded
FROM policies p LEFT JOIN cl ON p.numpoliza = cl.idpoliza"""
)
SQL["heavy_event_keys"] = "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 66"
SQL["nest_null_key"] = _with(
    """SELECT CASE WHEN o_orderstatus <> 'F' THEN idpoliza END AS idpoliza, count(*) AS n_claims,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM claims GROUP BY 1""",
    lists=False,
)
SQL["join_split_conditions"] = """SELECT
  CASE WHEN o_orderkey IS NULL THEN 'right_only' WHEN l_orderkey IS NULL THEN 'left_only' ELSE 'matched' END AS part,
  o_orderkey, o_totalprice, l_orderkey, l_linenumber, l_quantity
FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate > CAST(o_orderdate AS DATE) + 60"""
SQL["join_split_skewed"] = """WITH b AS (
  SELECT event_type, max(value) AS top FROM events WHERE event_type <> 'click' GROUP BY event_type
  UNION ALL SELECT r_name, 0.0 FROM region)
SELECT CASE WHEN e.event_type IS NULL THEN 'right_only' WHEN b.event_type IS NULL THEN 'left_only' ELSE 'matched' END AS part,
  coalesce(e.event_type, b.event_type) AS event_type, event_id, user_id, CAST(top AS DOUBLE) AS top
FROM events e FULL JOIN b ON e.event_type = b.event_type"""

_TABLE_SUMS = {
    "policies": ("customer", "c_custkey"),
    "claims": ("orders", "o_orderkey + o_custkey"),
    "payments": ("lineitem", "l_orderkey * 10 + l_linenumber + CAST(l_extendedprice AS DECIMAL(18,2))"),
    "receipts": ("events", "event_id + CAST(value AS DECIMAL(18,2))"),
    "tariffs": (
        "(SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT c_custkey, 0 FROM customer)", "c_custkey + c_nationkey",
    ),
    "clients": ("customer", "c_custkey"),
    "accounts": ("events", "event_id + user_id"),
    "participants": ("customer", "c_custkey + c_custkey"),
}
SQL["load_all_tables"] = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", count(*) AS n, CAST(sum(CAST({total} AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(0 AS BIGINT) AS n_rejected FROM {source}"""
    for name, (source, total) in _TABLE_SUMS.items()
)
SQL["checked_scan"] = """WITH l AS (
  SELECT *, concat_ws(',', c_custkey, c_name, c_nationkey) AS good FROM customer)
SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS c_nationkey,
  CASE WHEN c_custkey % 7 <> 0 THEN NULL WHEN c_custkey % 21 = 0 THEN 'x' || good
    WHEN c_custkey % 21 = 7 THEN good || ',1' ELSE concat_ws(',', c_custkey, c_name) END AS line
FROM l"""
SQL["clustered_files"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem"
SQL["published_table"] = """SELECT c_custkey AS numpoliza, c_name, coalesce(n, 0) AS n_claims
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""
SQL["policy_job"] = _with(
    """SELECT p.numpoliza, p.c_mktsegment AS pol_estado, """ + CLAIM_COLS + """,
  CAST(rc.n_receipts AS BIGINT) AS n_receipts, CAST(tf.n_tariffs AS BIGINT) AS n_tariffs,
  CAST(pt.n_participants AS BIGINT) AS n_participants, CAST(pt.n_accounts AS BIGINT) AS n_accounts
FROM policies p
LEFT JOIN cl ON p.numpoliza = cl.idpoliza
LEFT JOIN rc ON p.numpoliza = rc.idpoliza
JOIN tf ON p.numpoliza = tf.num_poliza
JOIN pt ON p.numpoliza = pt.numpoliza"""
)
SQL["job_accounts"] = _with(
    """, kept AS (SELECT numpoliza FROM policies WHERE numpoliza >= 100),
c2 AS (SELECT idsiniestro, CASE WHEN o_orderstatus <> 'P' THEN idpoliza END AS idpoliza FROM claims),
a AS (
  SELECT 'policies' AS name, count(*) AS n_rows, (SELECT count(*) FROM kept) AS in_document, 0 AS no_key FROM policies
  UNION ALL SELECT 'datos_sin', count(*), count(*) FILTER (idpoliza IN (FROM kept)), count(*) FILTER (idpoliza IS NULL) FROM c2
  UNION ALL SELECT 'datos_sin/datos_pago', count(*), count(*) FILTER (idsiniestro IN (
    SELECT idsiniestro FROM c2 WHERE idpoliza IN (FROM kept))), count(*) FILTER (idsiniestro IS NULL) FROM payments
  UNION ALL SELECT 'datos_recibos', count(*), count(*) FILTER (idpoliza IN (FROM kept)), count(*) FILTER (idpoliza IS NULL) FROM receipts
  UNION ALL SELECT 'datos_tarifa', count(*), count(*) FILTER (num_poliza IN (FROM kept)), 0 FROM tariffs
  UNION ALL SELECT 'datos_cliente', count(*), count(*), 0 FROM kept)
SELECT name, CAST(n_rows AS BIGINT) AS n_rows, CAST(in_document AS BIGINT) AS in_document, CAST(no_key AS BIGINT) AS no_key,
  CAST(n_rows - in_document - no_key AS BIGINT) AS left_out
FROM a""",
    lists=False,
)
