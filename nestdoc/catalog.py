"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables under ``sf_dir`` (through the insurance
roles of :mod:`nestdoc.sources.standin` or directly) and runs over them whole.
Nested results are summarised row by row (sizes, exact money sums) or
exploded, so they compare with flat SQL; :mod:`nestdoc.oracle` holds the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .functions import dates as D
from .functions import numbers as N
from .functions import text as T
from .operators.heavy import COUNT, heavy_keys
from .operators.joins import Skew, join_split, join_tagged
from .operators.nest import PAGE, nest, unnest
from .plans import insurance as I
from .plans.accounts import accounted
from .plans.job import run_job
from .plans.spec import DEFAULT_MAX_ITEMS, BuildOptions, build
from .plans.summary import count_where, list_money, list_size, nested_money, nested_size
from .session import scratch_path
from .sinks.writers import publish, read_clustered, write_clustered, write_parquet
from .sources import standin
from .sources.delimited import load_checked, load_tables, read_checked, read_delimited

Query = Callable[[SparkSession, str], DataFrame]


def _roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return standin.load_roles(spark, sf_dir)


def _src(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return standin.read_source(spark, sf_dir, name)


# ---------------------------------------------------------------- summaries
def document_summary(doc: DataFrame) -> DataFrame:
    """One flat row per document: policy columns, list sizes and money sums."""
    return doc.select(
        "numpoliza", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        *_claims_cols("datos_sin"),
        *_receipt_cols("datos_recibos"),
        *_tariff_cols("datos_tarifa"),
        *_participant_cols("datos_cliente"),
    )


def _claims_cols(col: str):
    return [
        list_size(col).alias("n_claims"),
        nested_size(col, "datos_pago").alias("n_payments"),
        nested_money(col, "datos_pago", "l_extendedprice").alias("sum_payment"),
    ]


def _receipt_cols(col: str):
    return [list_size(col).alias("n_receipts"), list_money(col, "importe_prima").alias("sum_receipt")]


def _tariff_cols(col: str):
    return [list_size(col).alias("n_tariffs"), list_money(col, "importe_prima").alias("sum_tariff")]


def _participant_cols(col: str):
    return [
        list_size(col).alias("n_participants"),
        count_where(col, lambda x: x["n_name"].isNotNull()).alias("n_with_client"),
        nested_size(col, "datos_cuenta").alias("n_accounts"),
        nested_money(col, "datos_cuenta", "s_acctbal").alias("sum_accounts"),
    ]


# ---------------------------------------------------------------- documents
def policy_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the document as the job builds it (lists bounded at
    DEFAULT_MAX_ITEMS items, so a heavy policy gets more pages instead of one
    unbounded row), summarised and added up per policy."""
    doc = I.policy_document(_roles(spark, sf_dir), BOUNDED)
    return paged_document_summary(doc)


def policy_document_unpaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document in the original shape: one row per policy, unbounded lists."""
    return document_summary(I.policy_document(_roles(spark, sf_dir)))


# The stage queries build their lists bounded at DEFAULT_MAX_ITEMS items (as the
# job does) and add the page summaries up per key: one row per key, whatever
# the pages.
# The role tables are Parquet scans with row-wise filters and projections:
# stable inputs (see BuildOptions).
BOUNDED = BuildOptions(max_items=DEFAULT_MAX_ITEMS, stable_inputs=True)
_FIRST = lambda x: x[PAGE] == 0  # noqa: E731  an element continued on later pages counts on its page 0


def _summed(per_page: DataFrame, keys: list[str], counts: list[str], money: list[str]) -> DataFrame:
    return per_page.groupBy(*keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in counts],
        *[F.sum(F.col(c).cast("decimal(38,2)")).cast("double").alias(c) for c in money],
    )


def _paged_claims_cols(col: str):
    return [
        count_where(col, _FIRST).alias("n_claims"),
        nested_size(col, "datos_pago").alias("n_payments"),
        nested_money(col, "datos_pago", "l_extendedprice").alias("sum_payment"),
    ]


def _paged_participant_cols(col: str):
    return [
        count_where(col, _FIRST).alias("n_participants"),
        count_where(col, lambda x: _FIRST(x) & x["n_name"].isNotNull()).alias("n_with_client"),
        nested_size(col, "datos_cuenta").alias("n_accounts"),
        nested_money(col, "datos_cuenta", "s_acctbal").alias("sum_accounts"),
    ]


CLAIM_COUNTS, CLAIM_MONEY = ["n_claims", "n_payments"], ["sum_payment"]
RECEIPT_COUNTS, RECEIPT_MONEY = ["n_receipts"], ["sum_receipt"]
TARIFF_COUNTS, TARIFF_MONEY = ["n_tariffs"], ["sum_tariff"]
PARTY_COUNTS, PARTY_MONEY = ["n_participants", "n_with_client", "n_accounts"], ["sum_accounts"]
POLICY_COLS = ["numpoliza", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def claims_with_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.claims_with_payments(_roles(spark, sf_dir), BOUNDED)
    per_page = pages.select("idpoliza", *_paged_claims_cols("datos_sin"))
    return _summed(per_page, ["idpoliza"], CLAIM_COUNTS, CLAIM_MONEY)


def receipts_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.receipts_by_policy(_roles(spark, sf_dir), BOUNDED)
    return _summed(pages.select("idpoliza", *_receipt_cols("datos_recibos")), ["idpoliza"], RECEIPT_COUNTS, RECEIPT_MONEY)


def tariffs_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.tariffs_by_policy(_roles(spark, sf_dir), BOUNDED)
    return _summed(pages.select("num_poliza", *_tariff_cols("datos_tarifa")), ["num_poliza"], TARIFF_COUNTS, TARIFF_MONEY)


def clients_with_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.clients_with_accounts(_roles(spark, sf_dir), BOUNDED)
    per_page = pages.select(
        "idcliente", "n_name", "n_regionkey",
        list_size("datos_cuenta").alias("n_accounts"),
        list_money("datos_cuenta", "s_acctbal").alias("sum_accounts"),
    )
    return _summed(per_page, ["idcliente", "n_name", "n_regionkey"], ["n_accounts"], ["sum_accounts"])


def policy_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.policy_core(_roles(spark, sf_dir), BOUNDED)
    per_page = pages.select(
        *POLICY_COLS, *_paged_claims_cols("datos_sin"), *_receipt_cols("datos_recibos"), *_tariff_cols("datos_tarifa"),
    )
    return _summed(
        per_page, POLICY_COLS,
        CLAIM_COUNTS + RECEIPT_COUNTS + TARIFF_COUNTS, CLAIM_MONEY + RECEIPT_MONEY + TARIFF_MONEY,
    )


def participants_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.participants_by_policy(_roles(spark, sf_dir), BOUNDED)
    per_page = pages.select("numpoliza", *_paged_participant_cols("datos_cliente"))
    return _summed(per_page, ["numpoliza"], PARTY_COUNTS, PARTY_MONEY)


def policy_document_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heavy-key form under stress: every list cut into pages of at most 4
    items (rows are (policy, page)); the page summaries added up per policy
    must give the unpaged document's summary."""
    return paged_document_summary(I.policy_document(_roles(spark, sf_dir), BuildOptions(max_items=4, stable_inputs=True)))


def paged_document_summary(doc: DataFrame) -> DataFrame:
    """Summary of a paged document, one row per policy.

    Page summaries are row-local; adding them up per policy is one small
    aggregation (a few numbers per page), on the document's own partitioning
    by policy. An element continued on a later page (a claim whose payments
    span pages, a participant whose client's accounts do) counts once, on its
    page 0.
    """
    per_page = doc.select(
        *POLICY_COLS,
        *_paged_claims_cols("datos_sin"),
        *_receipt_cols("datos_recibos"),
        *_tariff_cols("datos_tarifa"),
        *_paged_participant_cols("datos_cliente"),
    )
    return _summed(
        per_page, POLICY_COLS,
        CLAIM_COUNTS + RECEIPT_COUNTS + TARIFF_COUNTS + PARTY_COUNTS,
        CLAIM_MONEY + RECEIPT_MONEY + TARIFF_MONEY + PARTY_MONEY,
    ).select(*document_summary_columns())


def document_summary_columns() -> list[str]:
    return [
        "numpoliza", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        "n_claims", "n_payments", "sum_payment", "n_receipts", "sum_receipt", "n_tariffs", "sum_tariff",
        "n_participants", "n_with_client", "n_accounts", "sum_accounts",
    ]


def dropped_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies that the inner joins leave out of a document (no tariff or no participant); the
    tariffs are played by the receipts here, which many policies lack."""
    r = _roles(spark, sf_dir)
    return I.dropped_policies(
        {"policies": r["policies"], "participants": r["participants"], "tariffs": r["receipts"].withColumnRenamed("idpoliza", "num_poliza")}
    )


def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the document (as the job writes it) written as Parquet under the
    shared folder, read back and summarised."""
    path = scratch_path(spark, "policy_document")
    write_parquet(I.policy_document(_roles(spark, sf_dir), BOUNDED), path)
    return paged_document_summary(spark.read.parquet(path))


# list -> its fields as compared by document_items; money as exact two decimals
ITEM_FIELDS = {
    "datos_sin": ["idsiniestro", "fecha_ocurs", "o_orderstatus", "o_orderpriority", "$o_totalprice"],
    "datos_pago": [
        "l_linenumber", "l_partkey", "l_suppkey", "$l_quantity", "$l_extendedprice", "$l_discount", "$l_tax", "l_returnflag",
        "l_linestatus", "fecha_pago",
    ],
    "datos_recibos": ["idrecibo", "fecha_efecto", "event_type", "$importe_prima", "props"],
    "datos_tarifa": ["tarifa", "$importe_prima"],
    "datos_cliente": ["idcliente", "tipo_intervencio", "n_name", "n_regionkey"],
    "datos_cuenta": ["idcuenta", "s_name", "$s_acctbal"],
}


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C7 item by item: every element of the document's four lists and two inner lists with its
    place and all its fields as text. The document is written once and read for each list."""
    path = scratch_path(spark, "document_items")
    write_parquet(I.policy_document(_roles(spark, sf_dir)), path)
    doc = spark.read.parquet(path)

    def text(fields: list[str]):
        parts = [F.col(f[1:]).cast("decimal(18,2)") if f[0] == "$" else F.col(f) for f in fields]
        return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])

    def items(name: str, parent: str | None = None, within: str | None = None) -> DataFrame:
        rows = doc.select("numpoliza", within or name)
        if within:
            rows = unnest(rows, within, outer=False).select("numpoliza", F.col(parent).alias("_parent"), name)
        rows = unnest(rows, name, outer=False, position="pos")
        of = F.col("_parent").cast("bigint") if within else F.lit(None).cast("bigint")
        return rows.select(
            "numpoliza", F.lit(name).alias("list"), of.alias("parent"), F.col("pos").cast("bigint").alias("pos"),
            text(ITEM_FIELDS[name]).alias("item"),
        )

    parts = [items(name) for name in ("datos_sin", "datos_recibos", "datos_tarifa", "datos_cliente")]
    parts += [items("datos_pago", "idsiniestro", "datos_sin"), items("datos_cuenta", "idcliente", "datos_cliente")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- sources
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as delimited text, read back by position with a fixed schema."""
    customer = _src(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_csv")
    customer.write.mode("overwrite").option("header", True).csv(path)
    return read_delimited(spark, path, customer.schema)


# ---------------------------------------------------------------- joins
def join_inner_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir)
    claims = r["claims"].withColumnRenamed("idpoliza", "numpoliza")
    return join_split(
        claims, r["policies"], ["numpoliza"],
        left_cols=["idsiniestro", "numpoliza", "o_totalprice"],
        right_cols=["c_name", "c_mktsegment"], mode=1,
    )


def join_left_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir)
    receipts = r["receipts"].withColumnRenamed("idpoliza", "numpoliza")
    return join_split(
        r["policies"], receipts, ["numpoliza"],
        left_cols="*", right_cols=["idrecibo", "event_type", "importe_prima"], mode=7,
    )


def join_left_only_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir)
    claims = r["claims"].withColumnRenamed("idpoliza", "numpoliza")
    return join_split(r["policies"], claims, ["numpoliza"], left_cols="*", right_cols=None, mode=1)


def join_expr_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = _src(spark, sf_dir, "orders"), _src(spark, sf_dir, "lineitem")
    return join_split(
        orders, lineitem, [orders["o_orderkey"] == lineitem["l_orderkey"]],
        left_cols=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
        right_cols=["l_linenumber", "l_quantity", "l_extendedprice"], mode=1,
    )


def _split(spark, sf_dir, mode) -> DataFrame:
    r = _roles(spark, sf_dir)
    return join_tagged(
        r["claims"], r["payments"], ["idsiniestro"],
        left_cols=["idsiniestro", "idpoliza", "o_totalprice"],
        right_cols=["l_linenumber", "l_extendedprice"], mode=mode,
    )


def join_split_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, 2)


def join_split_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, 3)


def join_split_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts and policies: many policies have no receipt."""
    r = _roles(spark, sf_dir)
    return join_tagged(
        r["receipts"].withColumnRenamed("idpoliza", "numpoliza"), r["policies"], ["numpoliza"],
        left_cols=["idrecibo", "importe_prima"], right_cols=["c_name"], mode=4,
    )


def join_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir)
    return join_split(r["claims"], r["payments"], ["idsiniestro"], mode=5)


def join_right_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir)
    receipts = r["receipts"].withColumnRenamed("idpoliza", "numpoliza")
    return join_split(receipts, r["policies"], ["numpoliza"], mode=6)


# ---------------------------------------------------------------- projections
def project_all_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.project_all_except(_roles(spark, sf_dir)["payments"], ["l_partkey", "l_suppkey", "l_tax"])


def pack_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = C.pack(_roles(spark, sf_dir)["claims"], "datos", exclude=["idpoliza"])
    return C.unpack(packed, "datos", keep=["idpoliza"])


def rename_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = _roles(spark, sf_dir)["receipts"]
    return C.rename_one(C.rename_one(receipts, "event_type", "tipo"), "no_such_column", "x")


def rename_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rename_suffix(_roles(spark, sf_dir)["policies"], ["c_name", "c_acctbal", "no_such_column"])


# ---------------------------------------------------------------- nesting (A1-A4)
def nest_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments nested by claim, exploded back with their position in the sorted list.

    Lists are bounded at DEFAULT_MAX_ITEMS items with pages in sort order, so
    a claim with more payments is never one task's list, and page number and
    place in the page still give the position in the claim's whole list. The
    payments are a Parquet projection (stable, see ``nest_paged``)."""
    payments = _roles(spark, sf_dir)["payments"]
    lists = nest(
        payments, "idsiniestro", "datos_pago", max_items=DEFAULT_MAX_ITEMS, ordered_pages=True,
        key_counts_from=payments.select("idsiniestro"), checkpoint=False,
    )
    out = unnest(lists, "datos_pago", outer=False, position="pos")
    pos = F.col(PAGE).cast("bigint") * F.lit(DEFAULT_MAX_ITEMS) + F.col("pos").cast("bigint")
    return out.withColumn("pos", pos).drop(PAGE)


def nest_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy -> claims -> payments (lists bounded as in the job), then both
    levels exploded with explode_outer: every page gives its own items, so the
    rows are the same whatever the pages."""
    doc = build(I.POLICY.with_children("datos_sin"), _roles(spark, sf_dir), BOUNDED)
    claims = unnest(doc.select("numpoliza", "c_name", "datos_sin"), "datos_sin")
    claims = claims.select("numpoliza", "c_name", "idsiniestro", "o_totalprice", "datos_pago")
    flat = unnest(claims, "datos_pago")
    return flat.select(
        "numpoliza", "c_name", "idsiniestro", "o_totalprice", "l_linenumber", "l_extendedprice", "fecha_pago"
    )


def nest_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heavy-key form of the nest: payments nested by return flag (three huge
    groups) in pages of at most 1000 items, summarised per page.

    The payments are a projection of a Parquet scan: their partitions and row
    order are fixed by the files, so a rerun numbers them the same and no
    checkpoint is needed before the page numbering; heavy keys are counted on
    the key column alone."""
    payments = _roles(spark, sf_dir)["payments"]
    pages = nest(
        payments, "l_returnflag", "datos_pago", max_items=1000,
        key_counts_from=payments.select("l_returnflag"), checkpoint=False,
    )
    return pages.groupBy("l_returnflag").agg(
        F.sum(F.size("datos_pago")).cast("bigint").alias("n_items"),
        (F.max(F.size("datos_pago")) <= 1000).alias("pages_bounded"),
        F.sum(list_money("datos_pago", "l_extendedprice").cast("decimal(38,2)")).cast("double").alias("sum_price"),
    )


def nest_ordered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments by return flag in pages of 1000 that follow the order of price (ties by all other
    fields), exploded back with each payment's place in its flag's whole list."""
    payments = _roles(spark, sf_dir)["payments"]
    lists = nest(
        payments, "l_returnflag", "datos_pago", max_items=1000, ordered_pages=True, order_by=["l_extendedprice"],
        key_counts_from=payments.select("l_returnflag"), checkpoint=False,
    )
    out = unnest(lists, "datos_pago", outer=False, position="pos")
    return out.withColumn("pos", F.col(PAGE) * 1000 + F.col("pos")).drop(PAGE)


# ---------------------------------------------------------------- dates
def _closing(orders: DataFrame) -> DataFrame:
    day = D.as_text("o_orderdate")
    return orders.select(
        "o_orderkey", "o_orderstatus",
        D.open_or(F.col("o_orderstatus") != "O", D.as_text(F.date_add(F.to_date("o_orderdate"), 30))).alias("fecha_cierre"),
        day.alias("fecha"),
    )


def open_ended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _closing(_src(spark, sf_dir, "orders"))
    return rows.select(
        "o_orderkey", "o_orderstatus", "fecha_cierre",
        D.is_open("fecha_cierre").alias("is_open"),
        D.is_open_start("fecha").alias("is_open_start"),
    )


def run_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _roles(spark, sf_dir)["claims"]
    run = D.run_date_columns("2024-06-30")
    return claims.select(
        "idsiniestro", "fecha_ocurs",
        *[v.alias(k) for k, v in run.items()],
        F.datediff(F.to_date(F.lit("2024-06-30")), D.to_day("fecha_ocurs")).cast("bigint").alias("days_since"),
    )


def day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _src(spark, sf_dir, "orders")
    return orders.select("o_orderkey", D.day_before(D.as_text("o_orderdate")).alias("fecha_sol"))


def status_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open/closed end and suspension dates and causes decided by a status code."""
    orders = _src(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    day = D.as_text("o_orderdate")
    return orders.select(
        "o_orderkey",
        F.when(st == "F", "PA").when(st == "P", "PS").otherwise("PV").alias("pol_estado"),
        D.open_or(st == "F", day).alias("fecha_baja"),
        F.when(st == "F", "FP").otherwise(" ").alias("causa_baja"),
        D.open_or(st == "P", day).alias("fecha_suspension"),
        F.when(st == "P", "CL").otherwise(" ").alias("causa_suspen"),
    )


def date_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a day up to 89 days after the order's, as its customer key says."""
    orders = _src(spark, sf_dir, "orders")
    return orders.select("o_orderkey", D.day_in_range(F.col("o_orderdate"), F.pmod("o_custkey", F.lit(90))).alias("fecha_cierre"))


def pick_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: a code picked from a list by a number."""
    customer = _src(spark, sf_dir, "customer")
    return customer.select("c_custkey", T.pick(["A", "S", "T", "M", "U"], F.col("c_nationkey")).alias("formapago"))


def integer_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """integers of a range that follow a key."""
    lines = _src(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", N.integer_in_range("l_partkey", 100, 99_999).alias("importe"),
        N.integer_in_range("l_suppkey", 1, 34).alias("comision"),
    )


def key_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the key of another table, at a fixed distance."""
    customer = _src(spark, sf_dir, "customer")
    return customer.select(F.col("c_custkey").alias("idcliente"), N.key_offset("c_custkey", 999).alias("numpoliza"))


# ---------------------------------------------------------------- text
def split_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _src(spark, sf_dir, "customer")
    parts = T.split_account("c_name")
    return customer.select("c_custkey", "c_name", *[v.alias(k) for k, v in parts.items()])


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _src(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        T.clean_text(F.concat_ws(",", "p_name", "p_type")).alias("texto"),
        T.clean_text(F.concat_ws("\n", "p_name", "p_brand"), upper=True).alias("texto_mayus"),
    )


def format_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _src(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        T.join_text(",", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("linea"),
        F.format_string("%s|%05d", F.col("c_mktsegment"), F.col("c_nationkey")).alias("codigo"),
    )


# ---------------------------------------------------------------- bounds, splits, skew
def document_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: policies with claims and payments in pages of a list weight of 12 (a claim weighs 1 and
    its payments): whatever the pages, all claims and payments, and no page over twice the bound."""
    doc = build(I.POLICY.with_children("datos_sin"), _roles(spark, sf_dir), BuildOptions(max_items=12, stable_inputs=True))
    weight = F.coalesce(F.size("datos_sin").cast("bigint") + nested_size("datos_sin", "datos_pago"), F.lit(0))
    return doc.select("numpoliza", *_paged_claims_cols("datos_sin"), weight.alias("w")).groupBy("numpoliza").agg(
        F.sum("n_claims").cast("bigint").alias("n_claims"), F.sum("n_payments").cast("bigint").alias("n_payments"),
        (F.max("w") <= 24).alias("bounded"),
    )


def heavy_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the users with more than 66 events, by the sketch and the counts of its candidates."""
    events = _src(spark, sf_dir, "events")
    found = heavy_keys(events, ["user_id"], 66)
    if found is None:
        return events.select("user_id", F.lit(0).cast("bigint").alias("n")).limit(0)
    return found.select("user_id", F.col(COUNT).alias("n"))


def nest_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: claims nested by a key that a third of them lack: the null key is a group."""
    claims = _roles(spark, sf_dir)["claims"]
    keyed = claims.withColumn("idpoliza", F.when(F.col("o_orderstatus") != "F", F.col("idpoliza")))
    return nest(keyed, "idpoliza", "datos_sin").select(
        "idpoliza", list_size("datos_sin").alias("n_claims"), list_money("datos_sin", "o_totalprice").alias("sum_price")
    )


def join_split_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 with all parts from one outer join: orders and their lines shipped over 60 days later."""
    orders, lineitem = _src(spark, sf_dir, "orders"), _src(spark, sf_dir, "lineitem")
    on = [orders["o_orderkey"] == lineitem["l_orderkey"], lineitem["l_shipdate"] > F.date_add(orders["o_orderdate"], 60)]
    return join_tagged(
        orders, lineitem, on, left_cols=["o_orderkey", "o_totalprice"], right_cols=["l_orderkey", "l_linenumber", "l_quantity"], mode=3
    )


def join_split_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 under skew: events (five types hold all rows) with one row for each type but one, and the
    regions, which match none; hot types are dealt over cells of 500 rows."""
    events = _src(spark, sf_dir, "events")
    types = events.where(F.col("event_type") != "click").groupBy("event_type").agg(F.max("value").alias("top"))
    regions = _src(spark, sf_dir, "region").select(F.col("r_name").alias("event_type"), F.lit(0.0).alias("top"))
    return join_tagged(
        events, types.unionByName(regions), "event_type", left_cols=["event_id", "user_id"], right_cols=["top"], mode=3,
        skew=Skew(500),
    )


# ---------------------------------------------------------------- loads, sinks, the job
def _csv_folder(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "csv")
    for name, df in standin.insurance_tables(spark, sf_dir).items():
        df.write.option("header", True).csv(f"{root}/{name}.csv")
    return root


_SUMS = {
    "policies": ["numpoliza"], "claims": ["idsiniestro", "idpoliza"], "payments": ["idpago", "importe_pago"],
    "receipts": ["idrecibo", "importe_prima"], "tariffs": ["num_poliza", "importe_prima"], "clients": ["idcliente"],
    "accounts": ["idcuenta", "idcliente"], "participants": ["idcliente", "numpoliza"],
}


def load_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight tables written as delimited text and loaded strictly, headers checked; rows
    and column sums of each, and what a checked load rejects."""
    root = _csv_folder(spark, sf_dir)
    tables = load_tables(spark, root, strict=True)
    rejected = load_checked(spark, root).rejected.groupBy("table").agg(F.count("*").alias("n_rejected"))
    parts = []
    for name, cols in _SUMS.items():
        total = sum((F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")), F.lit(0)) for c in cols), F.lit(0))
        parts.append(tables[name].agg(F.count("*").alias("n"), total.cast("double").alias("total")).select(F.lit(name).alias("table"), "n", "total"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(rejected, "table", "left").select("table", "n", "total", F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"))


def checked_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text of which every seventh line does not parse (no number, a field too
    many or too few, by turns): n lines in, n rows out, the bad ones with their line."""
    customer = _src(spark, sf_dir, "customer")
    schema = customer.select("c_custkey", "c_name", "c_nationkey").schema
    key = F.col("c_custkey")
    line = F.concat_ws(",", key.cast("string"), "c_name", F.col("c_nationkey").cast("string"))
    broken = F.when(key % 21 == 0, F.concat(F.lit("x"), line)).when(key % 21 == 7, F.concat(line, F.lit(",1")))
    broken = broken.otherwise(F.concat_ws(",", key.cast("string"), "c_name"))
    path = scratch_path(spark, "lines")
    customer.select(F.when(key % 7 == 0, broken).otherwise(line).alias("value")).write.text(path)
    good, bad = read_checked(spark, path, schema, header=False)
    parsed = good.select("c_custkey", "c_name", "c_nationkey", F.lit(None).cast("string").alias("line"))
    lost = bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], "line")
    return parsed.unionByName(lost)


def clustered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: payments in files by size and key range, read back through the ranges in two halves."""
    path = scratch_path(spark, "clustered_payments")
    payments = _src(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    write_clustered(payments, path, ["l_orderkey"], file_bytes=256 * 1024)
    middle = _src(spark, sf_dir, "orders").agg(F.floor(F.avg("o_orderkey")).alias("m")).collect()[0]["m"]
    low = read_clustered(spark, path, "l_orderkey", high=middle)
    return low.unionByName(read_clustered(spark, path, "l_orderkey", low=middle + 1))


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a table first published with the policies alone, then replaced by the same columns with
    the claims counted, and read by its name."""
    r = _roles(spark, sf_dir)
    root = scratch_path(spark, "published")
    database = "nestdoc_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    first = r["policies"].select("numpoliza", "c_name", F.lit(0).cast("bigint").alias("n_claims"))
    publish(first, f"{database}.policies")
    counts = r["claims"].groupBy(F.col("idpoliza").alias("numpoliza")).agg(F.count("*").alias("n"))
    second = r["policies"].join(counts, "numpoliza", "left").select("numpoliza", "c_name", F.coalesce("n", F.lit(0)).alias("n_claims"))
    publish(second, f"{database}.policies")
    return spark.table(f"{database}.policies")


def policy_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from eight delimited files to Parquet, summarised by policy."""
    target = scratch_path(spark, "job")
    run_job(spark, _csv_folder(spark, sf_dir), target)
    return spark.read.parquet(target).select(
        F.col("numpoliza").cast("bigint").alias("numpoliza"), "pol_estado",
        list_size("datos_sin").alias("n_claims"), nested_size("datos_sin", "datos_pago").alias("n_payments"),
        nested_money("datos_sin", "datos_pago", "importe_pago").alias("sum_payment"),
        list_size("datos_recibos").alias("n_receipts"), list_size("datos_tarifa").alias("n_tariffs"),
        list_size("datos_cliente").alias("n_participants"), nested_size("datos_cliente", "datos_cuenta").alias("n_accounts"),
    )


def job_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: what became of every input row of the document, counted in the write's own pass; claims
    of orders in process have no policy here, and clients under 100 no participant."""
    r = dict(_roles(spark, sf_dir))
    r["claims"] = r["claims"].withColumn("idpoliza", F.when(F.col("o_orderstatus") != "P", F.col("idpoliza")))
    r["participants"] = r["participants"].where("numpoliza >= 100")
    doc, finish = accounted(I.POLICY, r)
    doc.write.parquet(scratch_path(spark, "accounts"))
    rows = [(a.name, a.rows, a.in_document, a.no_key, a.left_out) for a in finish() if not a.copied]
    return spark.createDataFrame(rows, "name string, n_rows bigint, in_document bigint, no_key bigint, left_out bigint")


QUERIES: dict[str, Query] = {
    "policy_document": policy_document,
    "policy_document_paged": policy_document_paged,
    "policy_document_unpaged": policy_document_unpaged,
    "claims_with_payments": claims_with_payments,
    "receipts_by_policy": receipts_by_policy,
    "tariffs_by_policy": tariffs_by_policy,
    "clients_with_accounts": clients_with_accounts,
    "policy_core": policy_core,
    "participants_by_policy": participants_by_policy,
    "parquet_sink": parquet_sink,
    "document_items": document_items,
    "dropped_policies": dropped_policies,
    "csv_scan": csv_scan,
    "join_inner_cols": join_inner_cols,
    "join_left_cols": join_left_cols,
    "join_left_only_cols": join_left_only_cols,
    "join_expr_key": join_expr_key,
    "join_split_left": join_split_left,
    "join_split_both": join_split_both,
    "join_split_right": join_split_right,
    "join_left_anti": join_left_anti,
    "join_right_anti": join_right_anti,
    "project_all_except": project_all_except,
    "pack_struct": pack_struct,
    "rename_one": rename_one,
    "rename_suffix": rename_suffix,
    "nest_one_level": nest_one_level,
    "nest_two_level": nest_two_level,
    "nest_paged": nest_paged,
    "nest_ordered_pages": nest_ordered_pages,
    "open_ended_rows": open_ended_rows,
    "run_date_columns": run_date_columns,
    "day_before": day_before,
    "status_dates": status_dates,
    "date_in_range": date_in_range,
    "pick_code": pick_code,
    "integer_in_range": integer_in_range,
    "key_offset": key_offset,
    "split_account": split_account,
    "clean_text": clean_text,
    "format_row": format_row,
    "document_bounded": document_bounded,
    "heavy_event_keys": heavy_event_keys,
    "nest_null_key": nest_null_key,
    "join_split_conditions": join_split_conditions,
    "join_split_skewed": join_split_skewed,
    "load_all_tables": load_all_tables,
    "checked_scan": checked_scan,
    "clustered_files": clustered_files,
    "published_table": published_table,
    "policy_job": policy_job,
    "job_accounts": job_accounts,
}
