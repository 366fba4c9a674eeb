"""The insurance document: one row per policy with its claims (and their
payments), receipts, tariffs and participants (with client data and accounts).

The whole job is the spec :data:`POLICY`; the functions below are the stages
of that job (C1-C7) as sub-specs or single nests, so each can be run and
checked on its own. They take the eight tables as a dict (see
:func:`nestdoc.sources.delimited.load_tables`) and return DataFrames; nothing
is executed until the caller acts.

Join modes are those the original job really applies: claims and receipts
left (a policy without them keeps a null list), tariffs and participants inner
(a policy without them is not in the result). ``how_tariffs`` /
``how_participants`` switch the latter to left.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_split
from .spec import BuildOptions, Child, DocSpec, Lookup, build, nest_child

PAYMENTS = DocSpec("payments")
CLAIMS = DocSpec("claims", key="idsiniestro", children=(Child(PAYMENTS, fk="idsiniestro", out="datos_pago"),))
RECEIPTS = DocSpec("receipts")
TARIFFS = DocSpec("tariffs")
ACCOUNTS = DocSpec("accounts")
CLIENTS = DocSpec("clients", key="idcliente", children=(Child(ACCOUNTS, fk="idcliente", out="datos_cuenta"),))
PARTICIPANTS = DocSpec("participants", lookups=(Lookup(CLIENTS, on="idcliente"),))
POLICY = DocSpec(
    "policies",
    key="numpoliza",
    children=(
        Child(CLAIMS, fk="idpoliza", out="datos_sin"),
        Child(RECEIPTS, fk="idpoliza", out="datos_recibos"),
        Child(TARIFFS, fk="num_poliza", out="datos_tarifa", how="inner"),
        Child(PARTICIPANTS, fk="numpoliza", out="datos_cliente", how="inner"),
    ),
)

Tables = Mapping[str, DataFrame]


def _opts(opts: BuildOptions | None) -> BuildOptions:
    return opts or BuildOptions()


def _nest_child(tables: Tables, ch: Child, opts: BuildOptions | None) -> DataFrame:
    """The stage's list column: the child's rows nested by its foreign key
    (with a page column when ``opts.max_items`` bounds the lists)."""
    return nest_child(ch, tables, _opts(opts))


def claims_with_payments(tables: Tables, opts: BuildOptions | None = None) -> DataFrame:
    """(idpoliza, datos_sin), each claim holding its list datos_pago."""
    return _nest_child(tables, POLICY.children[0], opts)


def receipts_by_policy(tables: Tables, opts: BuildOptions | None = None) -> DataFrame:
    """(idpoliza, datos_recibos)."""
    return _nest_child(tables, POLICY.children[1], opts)


def tariffs_by_policy(tables: Tables, opts: BuildOptions | None = None) -> DataFrame:
    """(num_poliza, datos_tarifa)."""
    return _nest_child(tables, POLICY.children[2], opts)


def clients_with_accounts(tables: Tables, opts: BuildOptions | None = None) -> DataFrame:
    """C4: every client column plus datos_cuenta (null for a client without account)."""
    return build(CLIENTS, tables, _opts(opts))


def participants_by_policy(tables: Tables, opts: BuildOptions | None = None) -> DataFrame:
    """(numpoliza, datos_cliente), each participant with its client's data."""
    return _nest_child(tables, POLICY.children[3], opts)


def policy_spec(how_tariffs: str, how_participants: str, lists=None) -> DocSpec:
    """The document's spec with the join modes of tariffs and participants, and some lists only if named."""
    hows = {"datos_tarifa": how_tariffs, "datos_cliente": how_participants}
    children = tuple(replace(c, how=hows.get(c.out, c.how)) for c in POLICY.children)
    spec = replace(POLICY, children=children)
    return spec.with_children(*lists) if lists else spec


def policy_core(
    tables: Tables, opts: BuildOptions | None = None, *, how_tariffs: str = "inner"
) -> DataFrame:
    """Policy columns + datos_sin + datos_recibos + datos_tarifa."""
    spec = policy_spec(how_tariffs, "inner", ("datos_sin", "datos_recibos", "datos_tarifa"))
    return build(spec, tables, _opts(opts))


def policy_document(
    tables: Tables,
    opts: BuildOptions | None = None,
    *,
    how_tariffs: str = "inner",
    how_participants: str = "inner",
) -> DataFrame:
    """The whole document, one row per policy (per page when paged)."""
    return build(policy_spec(how_tariffs, how_participants), tables, _opts(opts))


def dropped_policies(tables: Tables) -> DataFrame:
    """Policies that the two inner joins leave out (no tariff or no participant).

    Key-only plan: the policies without a match in (tariff keys semi-joined
    with participant keys), i.e. the unmatched part of a split join; the
    lists are never built for it.
    """
    # distinct keys first: the map side folds repeated keys (a policy with a
    # mass of participants) before anything is shuffled
    tariff_keys = tables["tariffs"].select(F.col("num_poliza").alias("numpoliza")).distinct()
    party_keys = tables["participants"].select("numpoliza").distinct()
    kept = tariff_keys.join(party_keys, "numpoliza", "left_semi")
    return join_split(tables["policies"], kept, ["numpoliza"], mode="left_anti")


def policy_document_report(
    tables: Tables, opts: BuildOptions | None = None
) -> tuple[DataFrame, DataFrame]:
    """The document and, beside it, the policies it leaves out."""
    return policy_document(tables, opts), dropped_policies(tables)
