"""Stand-in ERP source tables built from the driver's TPC-H-like tables.

The warehouse jobs expect ERP-shaped raw tables (sales lines, receipts, stock
ledger, purchase orders, master data). The test data has lineitem / orders /
part / supplier / events instead, so each raw table here is a plain row-wise
projection of one driver table (master data: a DISTINCT projection): it only renames and re-types columns into the
schema the jobs read, and does none of the jobs' work (no grouping, no
dedup, no joins between facts).

Every table is declared once as ``(alias, sql_expression)`` pairs in a dialect
both Spark SQL and DuckDB accept; ``spark_table`` renders it with
``selectExpr`` (Catalyst prunes the parquet scan to the referenced columns) and
``duckdb_sql`` renders the same expressions as a DuckDB sub-query, so the
oracle sees exactly the same inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MONEY = "DECIMAL(18,2)"
QTY = "DECIMAL(18,3)"

_PRICE = f"CAST(l_extendedprice AS {MONEY})"
_QTY = f"CAST(l_quantity AS {QTY})"
_DISC = "CAST(l_discount AS DECIMAL(4,2))"
_TAX = "CAST(l_tax AS DECIMAL(4,2))"

# Unit price in cents, truncated; integer arithmetic so both engines agree exactly.
_UNIT_CENTS = (f"CAST(floor(CAST({_PRICE} * 100 AS BIGINT) / CAST(l_quantity AS BIGINT)) AS BIGINT)")
_UNIT = f"CAST(CAST({_UNIT_CENTS} AS DECIMAL(18,0)) * 0.01 AS {MONEY})"

# Operation code of a sales line: R lines are returns (202), the others are
# sales under three codes; line 7 carries a code outside the fact's list.
_SALES_OP = ("CASE WHEN l_linenumber = 7 THEN 999 WHEN l_returnflag = 'R' THEN 202 "
             "WHEN l_returnflag = 'A' THEN 800 WHEN l_linestatus = 'O' THEN 810 ELSE 820 END")


@dataclass(frozen=True)
class Key:
    """A column of its own (``expr``) that stands for ``text`` in the other columns, as ``value`` of it."""
    name: str
    expr: str
    text: str
    value: str


_PRODUCT_KEY = Key("_produto", "CAST(l_partkey AS INT)", "l_partkey", "CAST(_produto AS BIGINT)")
_STORE_KEY = Key("_loja", "CAST(l_orderkey % 10 + 1 AS INT)", "l_orderkey % 10", "CAST(_loja - 1 AS BIGINT)")


@dataclass(frozen=True)
class Part:
    """One SELECT of a stand-in table: source driver table, filter, columns.

    ``by`` names the expressions that all columns of a DISTINCT follow from:
    Spark then takes the distinct rows of these few and derives the columns
    from them, so no wide row is grouped or shuffled. A column that needs
    anything else does not resolve.
    """
    table: str
    columns: tuple[tuple[str, str], ...]
    where: str | None = None
    distinct: bool = False
    by: tuple[Key, ...] = ()


@dataclass(frozen=True)
class StandIn:
    name: str
    parts: tuple[Part, ...] = field(default_factory=tuple)


def _p(table: str, cols: list[tuple[str, str]], where: str | None = None, distinct: bool = False, by: tuple[Key, ...] = ()) -> Part:
    return Part(table, tuple(cols), where, distinct, by)


def _dialect(expr, which: int) -> str:
    """An expression is one string for both engines, or a (spark, duckdb) pair."""
    return expr[which] if isinstance(expr, tuple) else expr


# ---------------------------------------------------------------------------
# Transactional sources (grow with lineitem / orders)
# ---------------------------------------------------------------------------

SALES = StandIn("maxv_abcdistribbase", (_p("lineitem", [
    ("datahora", "l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("nrodocto", "l_orderkey * 1000 + l_partkey % 1000"),
    ("seriedocto", "l_linestatus"),
    ("checkout", "l_linenumber"),
    ("nroformapagto", "CAST(l_suppkey % 4 + 1 AS INT)"),
    ("nrosegmento", "CAST(l_orderkey % 2 + 1 AS INT)"),
    ("codgeraloper", _SALES_OP),
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("seqoperador", "CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_suppkey % 40 AS INT) END"),
    ("qtditem", f"CASE WHEN l_returnflag = 'R' THEN CAST(0 AS {QTY}) ELSE {_QTY} END"),
    ("qtddevolitem", f"CASE WHEN l_returnflag = 'R' THEN {_QTY} ELSE CAST(0 AS {QTY}) END"),
    ("vlritem", f"CASE WHEN l_returnflag = 'R' THEN CAST(0 AS {MONEY}) ELSE {_PRICE} END"),
    ("vlrdevolitem", f"CASE WHEN l_returnflag = 'R' THEN {_PRICE} ELSE CAST(0 AS {MONEY}) END"),
    ("vlrdescitem", f"CAST(ROUND({_PRICE} * {_DISC}, 2) AS {MONEY})"),
    ("vlrvendapromoc", f"CASE WHEN l_discount >= 0.08 THEN CAST(ROUND({_PRICE} * (1 - {_DISC}), 2) AS {MONEY}) END"),
    ("vlrlucro", f"CAST(ROUND({_PRICE} * {_TAX}, 2) AS {MONEY})"),
    ("ctobrutovda", f"CAST(ROUND({_PRICE} * 0.70, 2) AS {MONEY})"),
    ("vlrctoliqvda", f"CAST(ROUND({_PRICE} * (0.70 - {_TAX}), 2) AS {MONEY})"),
]),))

# A product may take its cost from another one, a store from another store (as max_empresa says).
_COST_PRODUCT = "(CASE WHEN l_partkey % 6 = 0 THEN l_partkey + 1 ELSE l_partkey END)"
_COST_STORE = "(CASE WHEN l_orderkey % 10 % 4 = 1 THEN l_orderkey % 10 ELSE l_orderkey % 10 + 1 END)"

# Sales lines before the hourly aggregation: with the discount on returned items
# and the promotion the product is in (NULL or 0: none).
SALES_RAW = StandIn("vendas_linhas", (Part("lineitem", tuple(
    (a, f"CASE WHEN l_discount < 0.02 THEN CAST(0 AS {MONEY}) WHEN l_discount >= 0.08 THEN CAST(ROUND({_PRICE} * (1 - {_DISC}), 2) AS {MONEY}) END")
    if a == "vlrvendapromoc" else (a, e) for a, e in SALES.parts[0].columns) + (
    ("vlrdescdevolitem", f"CASE WHEN l_returnflag = 'R' THEN CAST(ROUND({_PRICE} * {_DISC}, 2) AS {MONEY}) ELSE CAST(0 AS {MONEY}) END"),
    ("seqpromoc", "CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 5 < 3 THEN 0 ELSE CAST(l_suppkey AS INT) END"),
    ("dtavda", "CAST(l_shipdate AS DATE)"),
    ("nrodivisao", "CAST(l_orderkey % 3 + 1 AS INT)"),
    ("seqprodutocusto", f"CAST({_COST_PRODUCT} AS INT)"),
    ("qtdembalitem", f"CAST(CASE WHEN l_linenumber % 3 = 0 THEN 6 ELSE 1 END AS {QTY})"),
    ("vlrdescacordoverbapdv", f"CAST(ROUND({_PRICE} * {_DISC} * 0.1, 2) AS {MONEY})"),
    ("acmcompravenda", "CASE WHEN l_suppkey % 2 = 0 THEN 'S' ELSE 'N' END"),
    # what the source's function returns where no surcharge is recorded
    ("acresccustorelac", "CASE WHEN l_suppkey % 3 = 0 THEN CAST(1.01 AS DECIMAL(6,4)) END"))),))

_DAY_KEY = Key("_dia", "CAST(l_shipdate AS DATE)", "CAST(l_shipdate AS DATE)", "_dia")

# Day cost of the cost product in the cost store; line 6 of an order has none of its own.
_CP, _CS = _COST_PRODUCT, _COST_STORE
SALES_DAY_COSTS = StandIn("custo_dia", (_p("lineitem", [
    ("seqproduto", f"CAST({_CP} AS INT)"),
    ("nroempresa", f"CAST({_CS} AS INT)"),
    ("dtaentradasaida", "CAST(l_shipdate AS DATE)"),
    ("cmdiavlrnf", f"CAST({_CP} * 37 % 9000 * 0.01 + {_CS} AS DECIMAL(18,4))"),
    ("cmdiaipi", f"CAST({_CP} % 90 * 0.0125 AS DECIMAL(18,4))"),
    ("cmdiacredicms", f"CAST({_CP} % 70 * 0.0311 AS DECIMAL(18,4))"),
    ("cmdiacredpis", f"CASE WHEN {_CP} % 8 = 0 THEN NULL ELSE CAST({_CP} % 60 * 0.0165 AS DECIMAL(18,4)) END"),
    ("cmdiacredcofins", f"CAST({_CP} % 60 * 0.076 AS DECIMAL(18,4))"),
    ("cmdiacredipi", f"CASE WHEN {_CS} % 2 = 0 THEN CAST(0.0333 AS DECIMAL(18,4)) END"),
    ("cmdiaicmsst", f"CAST({_CP} % 55 * 0.0217 AS DECIMAL(18,4))"),
    ("cmdiadespnf", "CAST(0.05 AS DECIMAL(18,4))"),
    ("cmdiadespforanf", "CAST(0.02 AS DECIMAL(18,4))"),
    ("cmdiadctoforanf", f"CAST({_CP} % 40 * 0.0103 AS DECIMAL(18,4))"),
    ("qtdverbavda", f"CAST(CASE WHEN {_CP} % 4 = 0 THEN 10 ELSE 0 END AS {QTY})"),
    ("vlrverbavda", f"CAST({_CP} % 50 AS {MONEY})"),
    ("qtdvda", f"CASE WHEN {_CP} % 16 = 8 THEN NULL ELSE CAST(CASE WHEN {_CP} % 8 = 0 THEN 0 ELSE {_CP} % 40 + 5 END AS {QTY}) END"),
    ("vlrverbavdaacr", f"CASE WHEN {_CP} % 3 = 0 THEN NULL ELSE CAST({_CP} % 20 AS {MONEY}) END"),
], where="l_linenumber <> 6", distinct=True, by=(
    Key("_produto", f"CAST({_CP} AS INT)", _CP, "CAST(_produto AS BIGINT)"),
    Key("_loja", f"CAST({_CS} AS INT)", _CS, "CAST(_loja AS BIGINT)"), _DAY_KEY)),))

# Cost surcharge of related products, per product and day.
COST_SURCHARGES = StandIn("map_prodacresccustorelac", (_p("lineitem", [
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("dtamovimentacao", "CAST(l_shipdate AS DATE)"),
    ("percacresccustorelacvig", "CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(1.02 + l_partkey % 5 * 0.01 AS DECIMAL(6,4)) END"),
], where="l_partkey % 4 = 0 AND l_linenumber < 4", distinct=True, by=(_PRODUCT_KEY, _DAY_KEY)),))

# A re-sent sales window with corrected discounts and one new column.
SALES_CORRECTED = StandIn("maxv_abcdistribbase_corrigida", (Part(
    "lineitem",
    tuple((a, e) if a != "vlrdescitem" else (a, f"CAST(ROUND({_PRICE} * {_DISC} * 1.5, 2) AS {MONEY})")
          for a, e in SALES.parts[0].columns)
    + (("vlrembalagem", f"CAST(l_linenumber AS {MONEY})"),)),),)

_RECEIPT_OP = ("CASE l_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 11 WHEN 2 THEN 105 WHEN 3 THEN 107 "
               "WHEN 4 THEN 200 WHEN 5 THEN 205 ELSE 999 END")

RECEIPTS = StandIn("maxv_abcentradabase", (_p("lineitem", [
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("dtaentrada", "CAST(l_shipdate AS DATE)"),
    # issue date 6 days after .. 190 days before the receipt
    ("dtaemissao", "CAST(l_shipdate AS DATE) - (CAST(l_quantity AS INT) * 4 - 10)"),
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("nrodocto", "l_orderkey"),
    ("seqfornecedor", "CAST(l_suppkey AS INT)"),
    ("nrodocumento", "CAST(l_orderkey AS STRING)"),
    ("codgeraloper", _RECEIPT_OP),
    ("operador", "'OP' || CAST(l_linenumber AS STRING)"),
    ("qtdembalagem", f"CAST(CASE WHEN l_linenumber % 3 = 0 THEN 6 ELSE 1 END AS {QTY})"),
    ("quantidade", _QTY),
    ("vlrentrada", _PRICE),
    ("vlrcustobruto", f"CAST(ROUND({_PRICE} * (1 + {_TAX}), 2) AS {MONEY})"),
    ("vlrcustoliquido", f"CAST(ROUND({_PRICE} * (1 - {_DISC}), 2) AS {MONEY})"),
    ("vlrproduto", _PRICE),
    ("vlrtotalnf", f"CAST(ROUND({_PRICE} * (1 + {_TAX}), 2) AS {MONEY})"),
    ("vlrdescontos", f"CAST(ROUND({_PRICE} * {_DISC}, 2) AS {MONEY})"),
    ("custofiscaltotalentrada", f"CAST(ROUND({_PRICE} * (1 - {_DISC} + {_TAX}), 2) AS {MONEY})"),
    ("prazomediopag", f"CAST(l_linenumber * 7 + 14 AS {MONEY})"),
]),))

# Receipt lines before aggregation (for A12-A17): every measure of the line and,
# with the prefix d, the part of it that was returned (half of it on R lines).
_NF_PARTS = {
    "qtditem": _QTY, "vlritem": _PRICE, "vlripi": f"{_PRICE} * {_TAX} * 0.5", "vlricmsdi": f"{_PRICE} * 0.01",
    "vlrdesptributitem": f"{_PRICE} * 0.02", "vlrdespntributitem": f"{_PRICE} * 0.005", "vlrdespforanf": f"{_PRICE} * 0.003",
    "vlricmsst": f"CASE WHEN l_linenumber % 3 = 0 THEN {_PRICE} * {_TAX} * 0.25 ELSE 0 END",
    "vlrfcpst": f"CASE WHEN l_linenumber % 3 = 0 THEN {_PRICE} * 0.01 ELSE 0 END", "vlrdescitem": f"{_PRICE} * {_DISC}",
    "vlrdescfinanceiro": f"{_PRICE} * 0.011", "vlrdesctransf": f"{_PRICE} * 0.007", "vlrdescsuframa": f"{_PRICE} * 0.004",
    "vlropcontratodesc": f"{_PRICE} * 0.002", "vlrimpostopresumcusto": f"{_PRICE} * 0.006",
    "vlricmscalc": f"CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -0.03 * {_PRICE} ELSE {_PRICE} * {_TAX} END",
    "vlricms": f"CASE WHEN l_linenumber % 2 = 0 THEN {_PRICE} * 0.12 ELSE 0 END", "vlricmsantecipado": f"{_PRICE} * 0.015",
    "vlricmspresumido": f"{_PRICE} * 0.008", "vlrfcpicms": f"CASE WHEN l_linenumber = 2 THEN NULL ELSE {_PRICE} * 0.02 END",
    "vlrpis": f"{_PRICE} * 0.0165", "vlrcofins": f"{_PRICE} * 0.076", "vlrcredipi": f"{_PRICE} * {_TAX} * 0.1",
}


def _nf_part(name: str, returned: bool) -> tuple[str, str]:
    kind = QTY if name.startswith("qtd") else MONEY
    value = f"CAST(ROUND({_NF_PARTS[name]}, 2) AS {kind})"
    if returned:
        value = f"CASE WHEN l_returnflag = 'R' THEN CAST(ROUND({value} * 0.5, 2) AS {kind}) ELSE CAST(0 AS {kind}) END"
    return ("d" if returned else "") + name, value


RECEIPT_LINES = StandIn("receipt_lines", (_p("lineitem", [
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("dtaentrada", "CAST(l_shipdate AS DATE)"),
    ("dtaemissao", "CAST(l_shipdate AS DATE) - CAST(l_linenumber AS INT)"),
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("seqpessoa", "CAST(l_suppkey AS INT)"),
    ("nrodocto", "l_orderkey"),
    ("codgeraloper", _RECEIPT_OP),
    ("operador", "CASE WHEN l_linenumber = 6 THEN NULL ELSE 'op' || CAST(l_suppkey % 9 AS STRING) END"),
    ("nrosegmentoprinc", "CAST(l_orderkey % 2 + 1 AS INT)"),
    ("nrodivisao", "CAST(l_orderkey % 3 + 1 AS INT)"),
    ("lancamentost", "CASE l_partkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'C' WHEN 2 THEN NULL ELSE 'N' END"),
    ("tipocalcicmsfisci", "CASE l_partkey % 7 WHEN 0 THEN 23 WHEN 1 THEN 24 WHEN 2 THEN 27 WHEN 3 THEN NULL ELSE 25 END"),
    ("indsomafcpicmscusto", "CASE WHEN l_partkey % 2 = 0 THEN 'S' ELSE 'N' END"),
    ("prazomediopag", f"CAST(l_linenumber * 7 + 14 AS {MONEY})"),
    ("vlricmsstnf", f"CAST(ROUND({_PRICE} * 0.013, 2) AS {MONEY})"),
    *[_nf_part(n, False) for n in _NF_PARTS],
    *[_nf_part(n, True) for n in _NF_PARTS],
]),))

# What the receipt lines are joined to: product, family x division, family x
# segment, family packs (the default sales pack is marked), division, and the
# last costs of a product in a store.
RECEIPT_PRODUCTS = StandIn("nf_produto", (_p("part", [
    ("seqproduto", "CAST(p_partkey AS INT)"), ("seqfamilia", "CAST(p_partkey - p_partkey % 3 AS INT)"),
    ("seqprodutobase", "CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey + 1 AS INT) END"),
    ("percacresccustorelacvig", "CASE WHEN p_partkey % 8 = 0 THEN CAST(1.02 AS DECIMAL(6,4)) END"),
    ("seqprodutobaseantigo", "CASE WHEN p_partkey % 10 = 0 THEN CAST(p_partkey + 2 AS INT) END"),
    ("propqtdprodutobase", "CASE WHEN p_partkey % 7 = 0 THEN CAST(0.5 AS DECIMAL(9,4)) END"),
]),))
FAMILY_DIVISIONS = StandIn("map_famdivisao", tuple(
    _p("part", [("seqfamilia", "CAST(p_partkey AS INT)"), ("nrodivisao", str(d))], None if d < 3 else "p_size > 10") for d in (1, 2, 3)))
FAMILY_SEGMENTS = StandIn("mad_famsegmento", tuple(
    _p("part", [("seqfamilia", "CAST(p_partkey AS INT)"), ("nrosegmento", str(g))]) for g in (1, 2)))
FAMILY_PACKS = StandIn("map_famembalagem", (
    _p("part", [("seqfamilia", "CAST(p_partkey AS INT)"), ("qtdembalagem", "1"), ("padraovenda", "CASE WHEN p_size % 2 = 0 THEN 'S' ELSE 'N' END")]),
    _p("part", [("seqfamilia", "CAST(p_partkey AS INT)"), ("qtdembalagem", "6"), ("padraovenda", "CASE WHEN p_size % 2 = 0 THEN 'N' ELSE 'S' END")]),
))
DIVISIONS = StandIn("max_divisao", (_p("orders", [
    ("nrodivisao", "CAST(o_orderkey % 3 + 1 AS INT)"), ("utilacresccustprodrelac", "CASE WHEN o_orderkey % 3 = 1 THEN 'N' ELSE 'S' END"),
], distinct=True),))
LAST_COSTS = StandIn("nf_custo_loja", (_p("lineitem", [
    ("seqproduto", "CAST(l_partkey AS INT)"), ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("cmultcusliquidoemp", "CAST(l_partkey % 50 + 1 AS DECIMAL(18,6))"),
    ("cmultdctoforanfemp", "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(l_partkey % 13 * 3 AS DECIMAL(18,6)) END"),
], distinct=True, by=(_PRODUCT_KEY, _STORE_KEY)),))

STOCK_LEDGER = StandIn("mrl_lanctoestoque", (_p("lineitem", [
    ("tipusocgo", "CASE WHEN l_linenumber % 2 = 0 THEN 'V' ELSE 'C' END"),
    ("tiplancto", "CASE l_returnflag WHEN 'R' THEN 'e' WHEN 'A' THEN 'S' ELSE 'X' END"),
    ("motivomovto", "l_linestatus"),
    ("seqmovtoestq", "l_orderkey * 10 + l_linenumber"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("dtaentradasaida", "CAST(l_shipdate AS DATE)"),
    ("dtahorlancto", "l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR"),
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("seqprodutobase", "CAST(l_partkey AS INT)"),
    ("local", "CAST(l_linenumber % 3 + 1 AS INT)"),
    ("codgeraloper", _SALES_OP),
    ("qtdlancto", _QTY),
    ("valorvlrnf", _PRICE),
    ("nrodocumento", "CAST(l_orderkey AS STRING)"),
    ("seqloteestoque", "CAST(NULL AS INT)"),
    ("historico", "'LINHA ' || CAST(l_linenumber AS STRING)"),
    ("geralteracaoestq", "CASE WHEN l_linenumber = 3 THEN 'N' WHEN l_linenumber = 6 THEN NULL ELSE 'S' END"),
]),))

STOCK_DAILY = StandIn("mrl_custodia", (_p("lineitem", [
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("dtaentradasaida", "CAST(l_shipdate AS DATE)"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("qtdestqinicial", f"CAST(l_quantity * 3 AS {QTY})"),
    ("qtdentrada", f"CASE WHEN l_returnflag = 'R' THEN {_QTY} ELSE CAST(0 AS {QTY}) END"),
    ("qtdsaida", f"CASE WHEN l_returnflag = 'R' THEN CAST(0 AS {QTY}) ELSE {_QTY} END"),
    ("qtdcompra", f"CAST(0 AS {QTY})"),
    ("vlrtotalcompra", f"CAST(0 AS {MONEY})"),
    ("qtdvda", _QTY),
    ("vlrtotalvda", _PRICE),
    ("vlrcusliquidovda", f"CAST(ROUND({_PRICE} * 0.65, 2) AS {MONEY})"),
    ("vlrcusbrutovda", f"CAST(ROUND({_PRICE} * 0.70, 2) AS {MONEY})"),
    ("qtddevol", f"CAST(0 AS {QTY})"),
    ("vlrtotaldevol", f"CAST(0 AS {MONEY})"),
    ("vlrcusliquidodevol", f"CAST(0 AS {MONEY})"),
    ("cmdiavlrnf", _UNIT),
    ("cmdiacusliquidoemp", f"CAST(ROUND({_UNIT} * 0.65, 2) AS {MONEY})"),
]),))

ORDER_HEADERS = StandIn("msu_pedidosuprim", (_p("orders", [
    ("centralloja", "CASE WHEN o_orderkey % 11 = 0 THEN 'm' ELSE 'L' END"),
    ("tippedidosuprim", "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'C' WHEN '2' THEN 'T' "
                        "WHEN '3' THEN 'B' WHEN '4' THEN 'x' ELSE 'Z' END"),
    ("situacaoped", "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'L' ELSE 'q' END"),
    ("motivopendencia", "CASE WHEN o_orderstatus = 'P' THEN 'aguarda fornecedor' END"),
    ("observacao", "'pedido ' || CAST(o_orderkey AS STRING)"),
    ("nropedidosuprim", "o_orderkey"),
    ("nroempresa", "CAST(o_orderkey % 10 + 1 AS INT)"),
    ("seqcomprador", "CAST(o_custkey % 7 AS INT)"),
    ("seqfornecedor", "CAST(floor(o_custkey / 15) AS INT)"),
    ("seqtransportador", "CAST(o_custkey % 3 AS INT)"),
    ("dtaemissao", "CAST(o_orderdate AS DATE)"),
    ("dtaaprovacao", "CAST(o_orderdate AS DATE) + 1"),
    ("dtarecebto", "CAST(o_orderdate AS DATE) + 10"),
    ("dtalimiterecebto", "CAST(o_orderdate AS DATE) + 30"),
    ("diasprorrogacao", "CAST(o_custkey % 5 AS INT)"),
    ("nropedsuprimorig", "CAST(NULL AS BIGINT)"),
    ("nroempresaorig", "CAST(NULL AS INT)"),
    ("vlrtotpedido", f"CAST(o_totalprice AS {MONEY})"),
    ("dtaemissaooriginal", "CASE WHEN o_custkey % 6 = 0 THEN CAST(o_orderdate AS DATE) - 2 ELSE CAST(o_orderdate AS DATE) END"),
    ("dtarecebtooriginal", "CAST(o_orderdate AS DATE) + 8"),
    ("dtahorinclusao", "o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR"),
    ("usuaprovacao", "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE 'gerente ' || CAST(o_custkey % 4 AS STRING) END"),
    ("justificativaaprovacao", "CASE WHEN o_custkey % 4 = 1 THEN 'Acima da cota' END"),
    ("pzopagamento", "CAST(o_custkey % 3 * 14 + 14 AS STRING) || ' dias'"),
    ("condicaofrete", "CASE WHEN o_custkey % 2 = 0 THEN 'c' ELSE 'f' END"),
    ("txvendor", "CASE WHEN o_custkey % 5 = 0 THEN CAST(1.25 AS DECIMAL(18,6)) END"),
    ("nropedfornecedor", "CASE WHEN o_custkey % 9 <> 0 THEN 'pf-' || CAST(o_orderkey AS STRING) END"),
    ("qtdtotsolicitada", f"CAST(o_custkey % 70 + 5 AS {QTY})"),
    ("qtdtotrecebida", f"CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 70 + 5 AS {QTY}) ELSE CAST(0 AS {QTY}) END"),
    ("qtdtotcancelada", f"CAST(o_custkey % 2 AS {QTY})"),
    ("qtdtottransito", f"CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey % 7 AS {QTY}) ELSE CAST(0 AS {QTY}) END"),
    ("qtdtotaprovada", f"CAST(o_custkey % 70 + 4 AS {QTY})"),
    ("vlrtotcancelado", f"CASE WHEN o_custkey % 2 = 1 THEN CAST(o_totalprice AS {MONEY}) END"),
    ("vlrtotrecebido", f"CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS {MONEY}) ELSE CAST(0 AS {MONEY}) END"),
    ("codgeraloper", "CAST(o_custkey % 3 + 1 AS INT)"),
    ("codigopendencia", "CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey % 8 AS INT) END"),
    ("centrallojaorig", "CASE o_custkey % 4 WHEN 0 THEN 'l' WHEN 1 THEN 'M' WHEN 2 THEN 'w' END"),
    ("tipopedvenda", "lower(substr(o_orderpriority, 3, 4))"),
    ("indtransfempsec", "CASE WHEN o_custkey % 5 = 2 THEN 's' ELSE 'N' END"),
    ("nrorequisicao", "CASE WHEN o_custkey % 6 = 1 THEN o_orderkey + 1000000 END"),
]),))

ORDER_ITEMS = StandIn("msu_psitemreceber", (_p("lineitem", [
    ("centralloja", "'L'"),
    ("statusitem", "CASE l_linestatus WHEN 'O' THEN 'a' ELSE 'C' END"),
    ("motivopendencia", "CASE WHEN l_returnflag = 'R' THEN 'item em falta' END"),
    ("nropedidosuprim", "l_orderkey"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("seqproduto", "CAST(l_partkey AS INT)"),
    ("seqitem", "l_linenumber"),
    ("qtdsolicitada", _QTY),
    ("qtdsolicitadaoriginal", _QTY),
    ("qtdaprovada", _QTY),
    ("qtdtotrecebida", f"CASE WHEN l_linestatus = 'O' THEN CAST(0 AS {QTY}) ELSE {_QTY} END"),
    ("qtdtotcancelada", f"CAST(0 AS {QTY})"),
    ("qtdtottransito", f"CAST(0 AS {QTY})"),
    ("dtarecebtoitem", "CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) END"),
    ("vlrunitario", _UNIT),
    ("vlrembitem", _UNIT),
    ("qtdembalagem", f"CAST(CASE WHEN l_partkey % 4 = 0 THEN 12 ELSE 1 END AS {QTY})"),
    ("dtaaprovacao", "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) - 5 END"),
    ("vlrembipi", f"CAST(ROUND({_UNIT} * {_TAX}, 2) AS {MONEY})"),
    ("vlrembicmsst", f"CASE WHEN l_partkey % 3 = 0 THEN CAST(ROUND({_UNIT} * {_DISC}, 2) AS {MONEY}) END"),
    ("vlrembverbacompra", f"CAST(l_partkey % 5 AS {MONEY})"),
    ("estoque", f"CAST(l_partkey % 80 AS {QTY})"),
    ("observacaoitem", "CASE WHEN l_suppkey % 4 = 0 THEN 'entrega ' || lower(l_linestatus) END"),
    ("dtaalteracao", "CAST(l_shipdate AS DATE) + 3"),
    ("usualteracao", "CASE WHEN l_suppkey % 3 <> 0 THEN 'comprador ' || CAST(l_suppkey % 3 AS STRING) END"),
]),))

# ---------------------------------------------------------------------------
# Master data (grows with part / supplier / orders)
# ---------------------------------------------------------------------------

# Store master data: one row per store id seen in the orders (the sales rule
# above yields ids 1..10), attributes derived from the id.
_K = "(o_orderkey % 10)"
STORES = StandIn("max_empresa", (_p("orders", [
    ("razaosocial", f"'LOJA ' || CAST({_K} + 1 AS STRING)"),
    ("endereco", f"'RUA ' || CAST({_K} AS STRING)"),
    ("bairro", "'CENTRO'"),
    ("cidade", f"'CIDADE ' || CAST({_K} % 6 AS STRING)"),
    ("uf", f"'U' || CAST({_K} % 5 AS STRING)"),
    ("cep", f"lpad(CAST({_K} * 1000 AS STRING), 8, '0')"),
    ("status", f"CASE WHEN {_K} = 8 THEN 'I' ELSE 'A' END"),
    ("nroempresa", f"CAST({_K} + 1 AS INT)"),
    ("nrodivisao", "1"),
    ("nroempcustoabc", f"CASE WHEN {_K} % 4 = 1 THEN CAST({_K} AS INT) END"),
    ("nrocgc", f"CAST(12345678 + {_K} AS STRING)"),
    ("digcgc", f"CAST({_K} * 7 % 100 AS DECIMAL(18,0))"),
    ("nrosegmentoprinc", f"CAST({_K} % 2 + 1 AS DECIMAL(18,0))"),
    ("seqpessoaemp", f"CAST({_K} + 700 AS INT)"),
    ("inscricaoestadual", f"CASE WHEN {_K} = 5 THEN NULL ELSE 'ie' || CAST({_K} * 31 AS STRING) END"),
    ("nrometro2loja", f"CAST({_K} * 110.5 AS {MONEY})"),
    ("indabertsabado", f"CASE WHEN {_K} % 3 = 0 THEN 's' WHEN {_K} % 3 = 1 THEN 'N' END"),
    ("indabertdomingo", f"CASE WHEN {_K} % 4 = 0 THEN 'S' ELSE 'N' END"),
    ("metagermargemlucro", f"CAST({_K} + 20.25 AS {MONEY})"),
    ("metagerdiaestq", f"CAST({_K} + 30 AS {MONEY})"),
    ("dtafechafiscal", f"CASE WHEN {_K} = 8 THEN DATE '2001-05-31' END"),
    ("dtainiciomovestoque", f"DATE '1995-01-01' + CAST({_K} AS INT)"),
    ("nronsunf", f"CAST({_K} * 1000 + 1 AS INT)"),
    ("cgobaixasaidapdv", f"CAST({_K} * 10 + 0 AS INT)"),
    ("cgotransflocori", f"CAST({_K} * 10 + 1 AS INT)"),
    ("cgotransflocdest", f"CAST({_K} * 10 + 2 AS INT)"),
    ("cgobaixaproducao", f"CAST({_K} * 10 + 3 AS INT)"),
    ("cgoentrproducao", f"CAST({_K} * 10 + 4 AS INT)"),
    ("cgobaixainventario", f"CAST({_K} * 10 + 5 AS INT)"),
    ("cgoentrinventario", f"CAST({_K} * 10 + 6 AS INT)"),
    ("cgoemissnfvenda", f"CAST({_K} * 10 + 7 AS INT)"),
    ("cgoenttransf", f"CAST({_K} * 10 + 8 AS INT)"),
    ("cgodevfornec", f"CAST({_K} * 10 + 9 AS INT)"),
    ("cgoenttransfprod", f"CAST({_K} * 10 + 10 AS INT)"),
    ("cgosaitransfprod", f"CAST({_K} * 10 + 11 AS INT)"),
    ("cgobaixaperda", f"CAST({_K} * 10 + 12 AS INT)"),
    ("cgoajustecusto", f"CAST({_K} * 10 + 13 AS INT)"),
    ("cgoajustecustoredu", f"CAST({_K} * 10 + 14 AS INT)"),
], distinct=True),))

# Checkouts seen in the sales lines (checkout 7 inactive).
CHECKOUTS = StandIn("vw_pdv", (_p("lineitem", [
    ("ativo", "CASE WHEN l_linenumber = 7 THEN 'N' ELSE 'S' END"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("nrocheckout", "l_linenumber"),
    ("nrosegmento", "CAST(l_linenumber % 2 + 1 AS INT)"),
], distinct=True),))

SEGMENTS = StandIn("mad_segmento", (_p("orders", [
    ("descsegmento", "'segmento ' || CAST(o_orderkey % 5 + 1 AS STRING)"),
    ("status", "CASE WHEN o_orderkey % 5 < 3 THEN 'A' ELSE 'I' END"),
    ("nrodivisao", "1"),
    ("nrosegmento", "CAST(o_orderkey % 5 + 1 AS INT)"),
], distinct=True),))

PRODUCTS = StandIn("map_produto", (_p("part", [
    ("desccompleta", "p_name"),
    ("seqproduto", "CAST(p_partkey AS INT)"),
    ("seqfamilia", "CASE WHEN p_partkey % 101 = 100 THEN NULL ELSE CAST(p_partkey - p_partkey % 3 AS INT) END"),
    ("dtahorinclusao", "DATE '2020-01-01' + CAST(p_partkey % 365 AS INT)"),
]),))

# A product master that lags behind: goods of small sizes have not been entered yet.
PRODUCTS_ENTERED = StandIn("map_produto_incompleto", tuple(_p(part.table, list(part.columns), "p_size > 25") for part in PRODUCTS.parts))

_BRAND_ID = "CAST(substr(p_brand, 7) AS INT)"

FAMILIES = StandIn("map_familia", (_p("part", [
    ("familia", "'familia ' || CAST(p_partkey AS STRING)"),
    ("pesavel", "CASE WHEN p_size < 10 THEN 'S' ELSE 'N' END"),
    ("pmtdecimal", "CASE WHEN p_size < 5 THEN 'S' ELSE 'N' END"),
    ("seqfamilia", "CAST(p_partkey AS INT)"),
    ("seqmarca", f"CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE {_BRAND_ID} END"),
]),))

# one row per brand seen in the parts (ids are the numbers in p_brand)
BRANDS = StandIn("map_marca", (_p("part", [
    ("marca", f"'marca ' || CAST({_BRAND_ID} AS STRING)"),
    ("status", f"CASE WHEN {_BRAND_ID} % 2 = 0 THEN 'A' ELSE 'I' END"),
    ("seqmarca", _BRAND_ID),
], distinct=True),))

_CAT_N1 = ("CASE p_type WHEN 'PROMO' THEN 1978 WHEN 'ECONOMY' THEN 2001 WHEN 'STANDARD' THEN 2002 "
           "WHEN 'LARGE' THEN 2003 WHEN 'MEDIUM' THEN 2685 WHEN 'SMALL' THEN 2004 ELSE 2999 END")

_CATEGORY_COLS = [
    ("categoriacompleta", "lower(p_type) || ' > ' || lower(p_brand)"),
    ("categorian1", "lower(p_type)"),
    ("categorian2", "lower(p_brand)"),
    ("categorian3", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'tamanho ' || CAST(p_size AS STRING) END"),
    ("seqfamilia", "CAST(p_partkey AS INT)"),
    ("skcategoria", f"{_CAT_N1} * 100 + {_BRAND_ID}"),
    ("seqcategorian1", _CAT_N1),
    ("seqcategorian2", f"{_BRAND_ID} + 100"),
    ("seqcategorian3", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END"),
]

# Category rows per family: a division-1 row for most families, an extra
# division-2 row for some, and a division-3-only row for the rest.
CATEGORIES = StandIn("etlv_categoria", (
    _p("part", _CATEGORY_COLS + [("nrodivisao", "1")], "p_partkey % 4 <> 3"),
    _p("part", _CATEGORY_COLS + [("nrodivisao", "2")], "p_partkey % 3 = 0"),
    _p("part", _CATEGORY_COLS + [("nrodivisao", "3")], "p_partkey % 4 = 3"),
))

_EAN = "lpad(CAST(p_partkey AS STRING), 13, '7')"
BARCODES = StandIn("map_prodcodigo", (
    _p("part", [("tipcodigo", "'E'"), ("seqproduto", "CAST(p_partkey AS INT)"), ("qtdembalagem", "1"),
                ("codacesso", _EAN)]),
    _p("part", [("tipcodigo", "'E'"), ("seqproduto", "CAST(p_partkey AS INT)"), ("qtdembalagem", "6"),
                ("codacesso", "lpad(CAST(p_partkey * 3 AS STRING), 13, '1')")], "p_partkey % 3 = 0"),
    _p("part", [("tipcodigo", "'B'"), ("seqproduto", "CAST(p_partkey AS INT)"), ("qtdembalagem", "1"),
                ("codacesso", "CAST(p_partkey + 2000 AS STRING)")], "p_size < 10"),
    _p("part", [("tipcodigo", "'D'"), ("seqproduto", "CAST(p_partkey AS INT)"), ("qtdembalagem", "12"),
                ("codacesso", "'DUN' || CAST(p_partkey AS STRING)")], "p_partkey % 4 = 1"),
    _p("part", [("tipcodigo", "'E'"), ("seqproduto", "CAST(p_partkey AS INT)"), ("qtdembalagem", "1"),
                ("codacesso", "CAST(NULL AS STRING)")], "p_partkey % 9 = 2"),
))

FAMILY_SUPPLIERS = StandIn("map_famfornec", (
    _p("part", [("principal", "'S'"), ("indindenizavaria", "'N'"), ("seqfamilia", "CAST(p_partkey AS INT)"),
                ("seqfornecedor", "CAST(floor(p_partkey / 20) AS INT)")], "p_partkey % 7 <> 6"),
    _p("part", [("principal", "'N'"), ("indindenizavaria", "'S'"), ("seqfamilia", "CAST(p_partkey AS INT)"),
                ("seqfornecedor", "CAST(floor(p_partkey / 40) AS INT)")]),
))

PERSONS = StandIn("ge_pessoa", (_p("supplier", [
    ("nomerazao", "lower(s_name)"),
    ("fantasia", "'fantasia ' || CAST(s_suppkey AS STRING)"),
    ("status", "'A'"),
    ("fisicajuridica", "CASE WHEN s_suppkey % 10 = 9 THEN 'F' WHEN s_suppkey % 10 = 8 THEN 'X' ELSE 'J' END"),
    ("logradouro", "'rua ' || CAST(s_nationkey AS STRING)"),
    ("nrologradouro", "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey AS STRING) END"),
    ("bairro", "'bairro'"),
    ("cidade", "'cidade ' || CAST(s_nationkey % 6 AS STRING)"),
    ("cep", "lpad(CAST(s_suppkey AS STRING), 8, '0')"),
    ("uf", "'U' || CAST(s_nationkey % 5 AS STRING)"),
    ("pais", "'BRASIL'"),
    ("seqpessoa", "CAST(s_suppkey AS INT)"),
    ("nrocgccpf", "CAST(s_suppkey * 1000 + 7 AS STRING)"),
    ("digcgccpf", "CASE WHEN s_suppkey % 13 = 5 THEN NULL ELSE CAST(s_suppkey % 100 AS STRING) END"),
    ("indcontribicms", "CASE WHEN s_suppkey % 2 = 0 THEN 'S' ELSE 'N' END"),
    ("inscricaorg", "CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE 'rg' || CAST(s_suppkey AS STRING) END"),
    ("email", "'contato' || CAST(s_suppkey AS STRING) || '@exemplo.com'"),
    ("indprodrural", "CASE s_suppkey % 3 WHEN 0 THEN 's' WHEN 1 THEN 'N' END"),
    ("indcontribipi", "CASE WHEN s_suppkey % 5 = 0 THEN 'S' ELSE 'N' END"),
    ("cnae", "CASE WHEN s_suppkey % 8 = 2 THEN NULL ELSE CAST(4600000 + s_suppkey AS STRING) END"),
    ("dtainclusao", "DATE '1999-01-01' + CAST(s_suppkey AS INT)"),
]),))

# Terms per division; suppliers without division 1 may have two others, loaded at different times.
def _terms(division: int, loaded: str, where: str) -> Part:
    return _p("supplier", [
        ("statusgeral", "'A'" if division == 1 else "'I'"), ("nrodivisao", str(division)), ("seqfornecedor", "CAST(s_suppkey AS INT)"),
        ("pzomedvisitarep", f"CAST(s_suppkey % 6 + {division} AS DECIMAL(18,2))"),
        ("pzomedentrega", f"CAST(s_suppkey % {17 - 2 * division} + 5 AS DECIMAL(18,2))"),
        ("pzomedatraso", f"CAST(s_suppkey % {5 - division} AS DECIMAL(18,2))"),
        ("pzopagamento", f"'{division * 14}/60'"), ("nrocondpagdev", f"CAST(s_suppkey % 9 + {division} AS INT)"),
        ("nroformapagtodev", f"CAST(s_suppkey % 4 * {division} AS INT)"), ("_loaded_at", loaded)], where)


SUPPLIER_DIVISIONS = StandIn("maf_fornecdivisao", (
    _terms(1, "CAST(TIMESTAMP '2001-01-01 00:00:00' AS TIMESTAMP)", "s_suppkey % 3 <> 0"),
    _terms(2, "CAST(TIMESTAMP '2001-01-01 00:00:00' + (s_suppkey % 5) * INTERVAL 1 DAY AS TIMESTAMP)", "s_suppkey % 5 <> 4"),
    _terms(3, "CAST(TIMESTAMP '2001-01-03 00:00:00' AS TIMESTAMP)", "s_suppkey % 2 = 0"),
))

# Stock locations per store: 1 (shop) and 2 (warehouse); location 3 is unknown.
LOCATIONS = StandIn("mrl_local", (_p("lineitem", [
    ("local", "CASE WHEN l_linenumber % 2 = 0 THEN 'loja' ELSE 'deposito' END"),
    ("tiplocal", "CASE WHEN l_linenumber % 2 = 0 THEN 'L' ELSE 'D' END"),
    ("status", "'A'"),
    ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("seqlocal", "CAST(2 - l_linenumber % 2 AS INT)"),
], distinct=True),))

# ---------------------------------------------------------------------------
# Planning inputs typed in by people, keyed by month (one row per month of the
# data, shifted a year ahead so they cover the months being planned)
# ---------------------------------------------------------------------------

_PLAN_MONTH = "CAST(CAST(date_trunc('month', l_shipdate) AS DATE) + INTERVAL 12 MONTH AS DATE)"
_M = f"month({_PLAN_MONTH})"

TARGET_PARAMS = StandIn("meta_parametros", (_p("lineitem", [
    ("mes", _PLAN_MONTH),
    ("meta_grupo_padrao_valor", f"CAST(1000000 + {_M} * 25000 AS {MONEY})"),
    ("meta_grupo_desafio_valor", f"CASE WHEN {_M} % 4 = 0 THEN NULL ELSE CAST(1100000 + {_M} * 27500 AS {MONEY}) END"),
    ("anos_historico", f"CASE WHEN {_M} % 4 = 0 THEN NULL ELSE {_M} % 4 END"),
], distinct=True),))

# Manual store adjustments: stores 2, 5 and 6 per month, summing to zero.
STORE_ADJUSTMENTS = StandIn("meta_ajustes_loja", (_p("lineitem", [
    ("id", f"CAST(year({_PLAN_MONTH}) * 10000 + month({_PLAN_MONTH}) * 100 + l_orderkey % 10 + 1 AS BIGINT)"),
    ("mes", _PLAN_MONTH),
    ("empresa_id", "CAST(l_orderkey % 10 + 1 AS INT)"),
    ("ajuste_padrao_valor", f"CAST(CASE l_orderkey % 10 + 1 WHEN 2 THEN 5000 WHEN 5 THEN -5000 ELSE 0 END AS {MONEY})"),
    ("ajuste_desafio_valor", f"CAST(CASE l_orderkey % 10 + 1 WHEN 2 THEN 7000 WHEN 5 THEN -7000 ELSE 0 END AS {MONEY})"),
    ("participacao_loja_calculada", "CAST(NULL AS DOUBLE)"),
    ("meta_padrao_sem_ajuste", f"CAST(NULL AS DECIMAL(28,2))"),
    ("meta_desafio_sem_ajuste", f"CAST(NULL AS DECIMAL(28,2))"),
], "l_orderkey % 10 + 1 IN (2, 5, 6)", distinct=True),))

# The same table with an adjustment of the second store that the fifth does not make up for.
STORE_ADJUSTMENTS_OPEN = StandIn("meta_ajustes_abertos", (Part(
    "lineitem",
    tuple((a, e.replace("THEN -5000", "THEN -4000")) for a, e in STORE_ADJUSTMENTS.parts[0].columns),
    STORE_ADJUSTMENTS.parts[0].where, distinct=True),))

_DATA_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
# Market indicators (monthly): food inflation with a gap every June, and the
# sector's yearly sales change.
INDICATORS = StandIn("indicadores_mercado_externo", (
    _p("lineitem", [("data_referencia", _DATA_MONTH), ("indicador", "'IPCA_ALIMENTOS_BEBIDAS'"),
                    ("valor", f"CAST((month({_DATA_MONTH}) * 7 + year({_DATA_MONTH})) % 15 * 0.1 - 0.4 AS DECIMAL(18,4))"),
                    ("fonte", "'BCB'")], f"month(l_shipdate) <> 6", distinct=True),
    _p("lineitem", [("data_referencia", _DATA_MONTH), ("indicador", "'PMC_HIPER_SUPER_VAR_ANUAL'"),
                    ("valor", f"CAST((month({_DATA_MONTH}) * 5 + year({_DATA_MONTH})) % 11 * 0.5 - 1 AS DECIMAL(18,4))"),
                    ("fonte", "'IBGE'")], distinct=True),
))

# ---------------------------------------------------------------------------
# Intraday extract runs from the events stream: every event lands in the run
# of its day; a third of them are re-sent, corrected, in the next day's run.
# ---------------------------------------------------------------------------

_EVENT_DAY = "CAST(year(ts) * 1000 + dayofyear(ts) AS INT)"
_EVENT_COLS = [
    ("datahora", "CASE WHEN event_id % 101 = 7 THEN NULL ELSE ts END"),
    ("nroempresa", "CAST(user_id % 10 + 1 AS INT)"),
    ("nrodocto", "event_id"),
    ("seriedocto", "'H'"),
    ("checkout", "CAST(user_id % 7 + 1 AS INT)"),
    ("nroformapagto", "CASE WHEN event_id % 17 = 3 THEN NULL ELSE 1 END"),
    ("nrosegmento", "1"),
    ("codgeraloper", "CASE event_type WHEN 'error' THEN 999 WHEN 'click' THEN 202 ELSE 800 END"),
    ("seqproduto", "CAST(user_id AS INT)"),
    ("seqoperador", "CAST(NULL AS INT)"),
    ("qtditem", f"CAST(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS {QTY})"),
    ("qtddevolitem", f"CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS {QTY})"),
]


def _event_value(factor: str) -> list[tuple[str, str]]:
    v = f"CAST(ROUND(CAST(value AS {MONEY}) * {factor}, 2) AS {MONEY})"
    return [("vlritem", f"CASE WHEN event_type = 'click' THEN CAST(0 AS {MONEY}) ELSE {v} END"),
            ("vlrdevolitem", f"CASE WHEN event_type = 'click' THEN {v} ELSE CAST(0 AS {MONEY}) END")]


EVENT_SALES = StandIn("vendas_intradia", (
    _p("events", _EVENT_COLS + _event_value("1.00") + [("lote", _EVENT_DAY)]),
    _p("events", _EVENT_COLS + _event_value("1.10") + [("lote", f"{_EVENT_DAY} + 1")], "event_id % 3 = 0"),
))

# Two loads of one keyed table: lines 1..5, then lines 4..7 with other values and
# months. Some key parts and some months are missing.
def _load(value: str, month: str, where: str) -> Part:
    return _p("lineitem", [
        ("documento", "CASE WHEN l_partkey % 37 = 5 THEN NULL ELSE l_orderkey END"),
        ("linha", "CAST(l_linenumber AS INT)"),
        ("valor", f"CAST({value} AS {MONEY})"),
        ("mes_part", f"CASE WHEN l_suppkey % 7 = 3 THEN NULL ELSE CAST({month} AS INT) END"),
    ], where)


_SHIP_MONTH = "year(l_shipdate) * 100 + month(l_shipdate)"
FIRST_LOAD = StandIn("carga_base", (_load(_PRICE, _SHIP_MONTH, "l_linenumber <= 5"),))
SECOND_LOAD = StandIn("carga_nova", (_load(f"{_PRICE} * 2", f"CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_SHIP_MONTH} END",
                                           "l_linenumber >= 4"),))

# ---------------------------------------------------------------------------
# Landed text and JSON: a run log per day of events, registry API answers per
# supplier, and monthly indicator payloads.
# ---------------------------------------------------------------------------

_LOG_TS = ("date_format(ts, 'yyyy/MM/dd HH:mm:ss')", "strftime(ts, '%Y/%m/%d %H:%M:%S')")
_LOG_DAY = ("date_format(ts, 'yyyy/MM/dd')", "strftime(ts, '%Y/%m/%d')")


def _cat(*parts) -> tuple[str, str]:
    return tuple(" || ".join(_dialect(p, i) for p in parts) for i in (0, 1))


RUN_LOG = StandIn("run_log", (
    _p("events", [("arquivo", _LOG_DAY), ("seq", "CAST(0 AS BIGINT)"),
                  ("linha", _cat(_LOG_DAY, "' 00:00:00 - workflow_cold - Start of workflow execution'"))],
       distinct=True),
    _p("events", [("arquivo", _LOG_DAY), ("seq", "event_id + 1"),
                  ("linha", _cat(_LOG_TS, "' - '", "CASE WHEN user_id % 9 = 0 THEN 'mrl_lanctoestoque' "
                                 "ELSE 'pipe_' || CAST(user_id % 25 AS STRING) END",
                                 "' - Execution finished on a local pipeline engine'"))],
       "event_type IN ('view', 'click', 'purchase')"),
    _p("events", [("arquivo", _LOG_DAY), ("seq", "event_id + 1"),
                  ("linha", _cat(_LOG_TS, "' - pipe_x - Pipeline started'"))],
       "event_type NOT IN ('view', 'click', 'purchase')"),
))

_CNPJ = "lpad(CAST(s_suppkey * 1000 + 7 AS STRING), 12, '0') || lpad(CAST(s_suppkey % 100 AS STRING), 2, '0')"


def _registry_payload(capital: str) -> str:
    return ("'{\"situacao_cadastral\": ' || CAST(s_suppkey % 3 + 2 AS STRING) || "
            "', \"descricao_situacao_cadastral\": \"' || CASE WHEN s_suppkey % 3 = 0 THEN 'ativa' ELSE 'baixada' END || '\"' || "
            "', \"opcao_pelo_simples\": ' || CASE s_suppkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'null' ELSE 'true' END || "
            "', \"opcao_pelo_mei\": ' || CASE WHEN s_suppkey % 4 = 3 THEN 'true' ELSE 'false' END || "
            "', \"porte\": \"' || CASE WHEN s_suppkey % 2 = 0 THEN 'demais' ELSE 'micro empresa' END || '\"' || "
            "', \"descricao_porte\": ' || CASE WHEN s_suppkey % 5 = 1 THEN 'null' ELSE '\"porte da empresa\"' END || "
            "', \"data_opcao_pelo_simples\": ' || CASE WHEN s_suppkey % 4 = 0 THEN '\"2008-07-01\"' ELSE 'null' END || "
            "', \"data_opcao_pelo_mei\": ' || CASE WHEN s_suppkey % 4 = 3 THEN '\"2012-02-29\"' ELSE 'null' END || "
            f"', \"capital_social\": ' || CAST({capital} AS STRING) || "
            "', \"data_inicio_atividade\": \"' || CAST(DATE '1990-01-01' + CAST(s_suppkey * 37 AS INT) AS STRING) || '\"' || "
            "', \"cnae_fiscal\": ' || CAST(4711301 + s_suppkey % 3 AS STRING) || "
            "', \"cnae_fiscal_descricao\": \"comercio varejista\"}'")


REGISTRY_ANSWERS = StandIn("cnpj_respostas", (
    _p("supplier", [("cnpj", _CNPJ), ("fonte_api", "'minha_receita'"), ("status_http", "200"),
                    ("seq", "s_suppkey * 10 + 1"), ("payload", _registry_payload("s_suppkey * 1000"))],
       "s_suppkey % 10 NOT IN (8, 9) AND s_suppkey % 4 <> 1"),
    _p("supplier", [("cnpj", _CNPJ), ("fonte_api", "'minha_receita'"), ("status_http", "503"),
                    ("seq", "s_suppkey * 10 + 1"), ("payload", "CAST(NULL AS STRING)")],
       "s_suppkey % 10 NOT IN (8, 9) AND s_suppkey % 4 = 1"),
    _p("supplier", [("cnpj", _CNPJ), ("fonte_api", "'brasilapi'"), ("status_http", "200"),
                    ("seq", "s_suppkey * 10 + 2"), ("payload", _registry_payload("s_suppkey * 1000 + 1"))],
       "s_suppkey % 10 NOT IN (8, 9)"),
    _p("supplier", [("cnpj", _CNPJ), ("fonte_api", "'minha_receita'"), ("status_http", "200"),
                    ("seq", "s_suppkey * 10 + 5"), ("payload", _registry_payload("s_suppkey * 2000"))],
       "s_suppkey % 10 NOT IN (8, 9) AND s_suppkey % 7 = 0 AND s_suppkey % 4 <> 1"),
))

# Registry rows already stored from an earlier run (some suppliers).
REGISTRY_STORED = StandIn("cnpj_dados_receita", (_p("supplier", [
    ("cnpj", _CNPJ), ("situacao_cadastral", "'2'"), ("descricao_situacao_cadastral", "'antiga'"),
    ("opcao_pelo_simples", "CAST(NULL AS BOOLEAN)"), ("opcao_pelo_mei", "CAST(NULL AS BOOLEAN)"),
    ("data_opcao_pelo_simples", "CAST(NULL AS DATE)"), ("data_opcao_pelo_mei", "DATE '2011-01-01'"),
    ("porte", "'demais'"), ("descricao_porte", "CAST(NULL AS STRING)"), ("capital_social", "CAST(1 AS DECIMAL(18,2))"),
    ("data_inicio_atividade", "DATE '1980-01-01'"), ("cnae_fiscal", "'0000000'"),
    ("cnae_fiscal_descricao", "'antiga'"), ("fonte_api", "'brasilapi'"),
], "s_suppkey % 5 = 0"),))

_IND_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
_BCB_DATE = ("date_format(date_trunc('month', l_shipdate), 'dd/MM/yyyy')",
             "strftime(date_trunc('month', l_shipdate), '%d/%m/%Y')")
_IBGE_PERIOD = ("date_format(date_trunc('month', l_shipdate), 'yyyyMM')",
                "strftime(date_trunc('month', l_shipdate), '%Y%m')")
_IND_V = f"(month({_IND_MONTH}) * 7 + year({_IND_MONTH})) % 15"

def _bcb_payload(seq: int, shift: str, where: str) -> Part:
    """Central-bank answers of load ``seq``, a row per month."""
    return _p("lineitem", [("seq", str(seq)), ("fonte", "'BCB'"), ("serie", "'1635'"),
                           ("payload", _cat("'{\"data\": \"'", _BCB_DATE, "'\", \"valor\": \"'",
                                            f"CAST(CAST({_IND_V} * 0.1 - 0.4 + {shift} AS DECIMAL(6,2)) AS STRING)", "'\"}'"))],
              where, distinct=True)


INDICATOR_PAYLOADS = StandIn("indicadores_payload", (
    _bcb_payload(1, "0", "month(l_shipdate) <> 6"),
    # March is sent again, corrected, by a later load
    _bcb_payload(2, "0.75", "month(l_shipdate) = 3"),
    _p("lineitem", [("seq", "1"), ("fonte", "'IBGE'"), ("serie", "'8880'"),
                    ("payload", _cat("'{\"id\": \"7170\", \"resultados\": [{\"series\": [{\"serie\": {\"'",
                                     _IBGE_PERIOD, "'\": \"'",
                                     f"CASE WHEN month(l_shipdate) = 2 THEN '..' WHEN month(l_shipdate) = 3 THEN '-' "
                                     f"WHEN month(l_shipdate) = 4 THEN '' ELSE CAST(CAST({_IND_V} * 0.5 - 1 AS DECIMAL(6,2)) AS STRING) END",
                                     "'\"}}]}]}'"))],
       distinct=True),
))

# ---------------------------------------------------------------------------
# Product x store snapshot inputs: one row per (product, store) seen in the
# sales lines, prices per segment and pack, promotions (headers and items).
# ---------------------------------------------------------------------------

_PS_KEY = [("seqproduto", "CAST(l_partkey AS INT)"), ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)")]

PRODUCT_STORE = StandIn("mrl_produtoempresa", (_p("lineitem", _PS_KEY + [
    ("statuscompra", "CASE WHEN l_partkey % 9 = 0 THEN 'I' WHEN l_partkey % 9 = 1 THEN NULL ELSE 'A' END"),
    ("indgeraruptura", "CASE WHEN l_partkey % 4 = 0 THEN 'S' WHEN l_partkey % 4 = 1 THEN 'N' END"),
    ("locentrada", "1"), ("locsaida", "2"),
    ("estqloja", f"CAST(l_partkey % 50 AS {QTY})"),
    ("estqdeposito", f"CAST(l_partkey % 13 AS {QTY})"),
    ("estqempresa", f"CAST(l_partkey % 50 + l_partkey % 13 AS {QTY})"),
    ("medvdiageral", f"CASE WHEN l_partkey % 11 = 0 THEN CAST(0 AS {QTY}) WHEN l_partkey % 11 = 1 THEN NULL "
                     f"ELSE CAST((l_partkey % 7 + 1) * 0.75 AS {QTY}) END"),
    ("cmultcusliquidoemp", f"CAST(l_partkey % 90 + 0.5 AS {MONEY})"),
    ("dtaultmoventrada", "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE DATE '2001-01-01' + CAST(l_partkey % 290 AS INT) END"),
    ("dtaultcompra", "CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE DATE '2000-06-01' + CAST(l_partkey % 400 AS INT) END"),
    ("dtaultvenda", "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE DATE '2001-03-01' + CAST(l_partkey % 240 AS INT) END"),
    ("qtdultvenda", f"CAST(l_partkey % 5 + 1 AS {QTY})"),
    ("estqtroca", f"CAST(l_partkey % 3 AS {QTY})"),
    ("estqalmoxarifado", f"CASE WHEN l_partkey % 14 = 0 THEN NULL ELSE CAST(l_partkey % 6 AS {QTY}) END"),
    ("estqoutro", f"CAST(l_partkey % 2 AS {QTY})"),
    ("qtdpendpedcompra_depreciada", f"CASE WHEN l_partkey % 4 = 2 THEN CAST(l_partkey % 20 AS {QTY}) END"),
    ("qtdpendpedexped_depreciada", f"CAST(l_partkey % 8 AS {QTY})"),
    ("qtdpedrectransito_depreciada", f"CAST(l_partkey % 9 AS {QTY})"),
    ("medvdiaforapromoc", f"CASE WHEN l_partkey % 11 > 1 THEN CAST((l_partkey % 7 + 1) * 0.5 AS {QTY}) END"),
    ("cmultvlrnf", f"CAST(l_partkey % 95 + 0.75 AS {MONEY})"),
    ("dtaultmovtacao", "DATE '2001-02-01' + CAST(l_partkey % 260 AS INT)"),
    ("dtaultmovsaida", "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE DATE '2001-03-02' + CAST(l_partkey % 240 AS INT) END"),
    ("dtaultentrada", "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE DATE '2001-01-02' + CAST(l_partkey % 288 AS INT) END"),
    ("qtdultentrada", f"CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_partkey % 36 AS {QTY}) END"),
    ("qtdultcompra", f"CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(l_partkey % 48 AS {QTY}) END"),
    ("dtaultinvfisico", "CASE WHEN l_partkey % 7 <> 0 THEN DATE '2001-01-31' + CAST(l_partkey % 3 * 90 AS INT) END"),
    ("qtdultimoinventario", f"CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_partkey % 50 + 1 AS {QTY}) END"),
], distinct=True, by=(_PRODUCT_KEY, _STORE_KEY)),))


def _price_part(segment: int, pack: int) -> Part:
    return _p("lineitem", _PS_KEY + [
        ("nrosegmento", str(segment)), ("qtdembalagem", f"CAST({pack} AS {QTY})"),
        ("statusvenda", "CASE WHEN l_partkey % 10 = 0 THEN 'I' ELSE 'A' END"),
        ("precobasenormal", f"CAST(l_partkey % 100 + {segment} + {pack} - 0.01 AS {MONEY})"),
        ("precovalidnormal", f"CAST(l_partkey % 100 + {segment} + {pack} + 0.99 AS {MONEY})"),
        ("margemlucroprodempseg", f"CAST(l_partkey % 30 AS {MONEY})"),
        ("indrevisaopreco", "CASE WHEN l_partkey % 3 = 0 THEN 'S' ELSE 'N' END"),
        ("precogernormal", f"CAST(l_partkey % 100 + {segment} + {pack} + 0.49 AS {MONEY})"),
        ("precogerpromoc", f"CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey % 100 + 0.59 AS {MONEY}) END"),
        ("precovalidpromoc", f"CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey % 100 + 0.49 AS {MONEY}) END"),
        ("precoemitidopromoc", f"CASE WHEN l_partkey % 8 = 0 THEN CAST(l_partkey % 100 + 0.39 AS {MONEY}) END"),
        ("vlrcustoliqdiaprecif", f"CAST(l_partkey % 60 + 0.25 AS {MONEY})"),
        ("motivoprecobase", "CASE WHEN l_partkey % 5 <> 0 THEN 'custo ' || CAST(l_partkey % 5 AS STRING) END"),
        ("motivoprecogerado", "'margem'"),
        ("motivoprecovalido", "CASE WHEN l_partkey % 2 = 0 THEN 'concorrente' ELSE 'Tabela' END"),
        ("dtageracaopreco", "DATE '2001-05-01' + CAST(l_partkey % 150 AS INT)"),
        ("dtavalidacaopreco", "CASE WHEN l_partkey % 9 <> 0 THEN DATE '2001-05-02' + CAST(l_partkey % 150 AS INT) END"),
        ("dtaalteracao", "DATE '2001-06-01' + CAST(l_partkey % 100 AS INT)"),
        ("datahoraalteracao", "TIMESTAMP '2001-06-01 00:00:00' + (l_partkey % 500) * INTERVAL 1 HOUR"),
        ("dtahoraltstatusvda", "CASE WHEN l_partkey % 10 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' + (l_partkey % 24) * INTERVAL 1 HOUR END"),
        ("precogernormalprog", f"CASE WHEN l_partkey % 12 = 0 THEN CAST(l_partkey % 100 + 2.99 AS {MONEY}) END"),
        ("dtageracaoprecoprog", "CASE WHEN l_partkey % 12 = 0 THEN DATE '2001-12-01' END"),
        ("seqpromocao", "CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey % 40 AS INT) END"),
    ], distinct=True, by=(_PRODUCT_KEY, _STORE_KEY))


PRICES = StandIn("mrl_prodempseg", (_price_part(1, 1), _price_part(2, 1), _price_part(1, 6)))

_PROMO = "CAST(l_partkey % 40 AS INT)"
_PROMO2 = "CAST((l_partkey % 40 + 2) % 40 AS INT)"
_PROMO_SEG = "CAST(l_partkey % 2 + 1 AS INT)"

PROMO_HEADERS = StandIn("mrl_promocao", (_p("lineitem", [
    ("seqpromocao", _PROMO), ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"), ("nrosegmento", _PROMO_SEG),
    ("centralloja", "'L'"), ("promocao", "'promo ' || CAST(l_partkey % 40 AS STRING)"),
    ("dtainicio", "DATE '2001-10-01' + CAST(l_partkey % 40 % 5 AS INT)"),
    ("dtafim", "DATE '2001-11-01' + CAST(l_partkey % 40 % 7 * 2 AS INT)"),
    ("nrodivisao", "CAST(l_partkey % 40 % 3 + 1 AS INT)"),
    ("tipopromoc", "CASE WHEN l_partkey % 40 % 2 = 0 THEN 'r' ELSE 'N' END"),
    ("indprevalecepreco", "CASE l_partkey % 40 % 3 WHEN 0 THEN 's' WHEN 1 THEN 'N' END"),
    ("indsegmentoprinc", "CASE WHEN l_partkey % 40 % 4 = 0 THEN 'S' ELSE 'n' END"),
    ("seqencarte", "CASE WHEN l_partkey % 40 % 5 = 0 THEN CAST(l_partkey % 40 + 100 AS INT) END"),
    ("dtageracaopromoc", "DATE '2001-09-20' + CAST(l_partkey % 40 % 5 AS INT)"),
    ("dtahorainclusao", "TIMESTAMP '2001-09-18 00:00:00' + (l_partkey % 40) * INTERVAL 1 HOUR"),
    ("dtahoraalteracao", "CASE WHEN l_partkey % 40 % 6 = 0 THEN TIMESTAMP '2001-09-25 00:00:00' + (l_partkey % 40) * INTERVAL 1 HOUR END"),
    ("usuinclusao", "'usuario ' || CAST(l_partkey % 40 % 4 AS STRING)"),
    ("usualteracao", "CASE WHEN l_partkey % 40 % 6 = 0 THEN 'revisor' END"),
], distinct=True),))


def _promo_item(promo: str, end_shift: str, where: str | None, pack: int = 1) -> Part:
    return _p("lineitem", [
        ("seqproduto", "CAST(l_partkey AS INT)"), ("qtdembalagem", f"CAST({pack} AS {QTY})"), ("seqpromocao", promo),
        ("nroempresa", "CAST(l_orderkey % 10 + 1 AS INT)"), ("nrosegmento", _PROMO_SEG), ("centralloja", "'L'"),
        ("status", "CASE WHEN l_partkey % 8 = 0 THEN 'I' ELSE 'A' END"),
        ("precopromocional", f"CAST(l_partkey % 100 + 0.49 AS {MONEY})"),
        ("percdescpromoc", f"CAST(l_partkey % 25 AS {MONEY})"),
        ("dtainicioprom", "CASE WHEN l_partkey % 3 = 0 THEN DATE '2001-10-20' END"),
        ("dtafimprom", f"CASE WHEN l_partkey % 3 = 0 THEN DATE '2001-11-04' + {end_shift} END"),
        ("precosugerido", f"CASE WHEN l_partkey % 6 <> 0 THEN CAST(l_partkey % 100 + 0.99 AS {MONEY}) END"),
        ("qtdprevistavda", f"CAST(l_partkey % 200 AS {QTY})"),
        ("qtdtotalvda", f"CAST(l_partkey % 180 AS {QTY})"),
        ("vlrtotalvda", f"CAST(l_partkey % 180 * 3.5 AS {MONEY})"),
        ("qtdmediavdapromoc", f"CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_partkey % 180 * 0.125 AS {QTY}) END"),
        ("nroacordo", "CASE WHEN l_partkey % 10 = 3 THEN CAST(l_partkey % 500 AS INT) END"),
        ("dtainclusao", "DATE '2001-09-15' + CAST(l_partkey % 10 AS INT)"),
        ("dtageracao", "DATE '2001-09-16' + CAST(l_partkey % 10 AS INT)"),
        ("dtahoraalteracao", "CASE WHEN l_partkey % 5 = 1 THEN TIMESTAMP '2001-10-02 00:00:00' + (l_partkey % 48) * INTERVAL 1 HOUR END"),
        ("usualteracao", "CASE WHEN l_partkey % 5 = 1 THEN 'revisor ' || CAST(l_partkey % 3 AS STRING) END"),
    ], where, distinct=True, by=(_PRODUCT_KEY, _STORE_KEY))


PROMO_ITEMS = StandIn("mrl_promocaoitem", (
    _promo_item(_PROMO, "CAST(l_partkey % 5 AS INT)", None),
    _promo_item(_PROMO2, "CAST(l_partkey % 4 AS INT)", "l_partkey % 5 = 0"),
    _promo_item(_PROMO, "CAST(l_partkey % 5 AS INT)", "l_partkey % 2 = 0", pack=6),
))

# Order-module code tables.
ORDER_STATES = StandIn("madv_situacaoped", (_p("orders", [
    ("situacaoped", "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'L' ELSE 'q' END"),
    ("descsituacaoped", "'situacao ' || lower(o_orderstatus)"),
], distinct=True),))
ORDER_TYPES = StandIn("madv_tippedido", (_p("orders", [
    ("tippedido", "substr(o_orderpriority, 1, 1)"), ("desctippedido", "lower(o_orderpriority)"),
], distinct=True),))
ORDER_ORIGINS = StandIn("madv_origempedido", (_p("customer", [
    ("origempedido", "substr(c_mktsegment, 1, 2)"), ("descorigempedido", "lower(c_mktsegment)"),
], distinct=True),))

ALL = {t.name: t for t in [SALES, SALES_CORRECTED, SALES_DAY_COSTS, COST_SURCHARGES, RECEIPTS, RECEIPT_LINES, STOCK_LEDGER, STOCK_DAILY, ORDER_HEADERS,
                           ORDER_ITEMS, STORES, CHECKOUTS, SEGMENTS, PRODUCTS, PRODUCTS_ENTERED, FAMILIES, BRANDS,
                           CATEGORIES, BARCODES, FAMILY_SUPPLIERS, PERSONS, SUPPLIER_DIVISIONS,
                           LOCATIONS, TARGET_PARAMS, STORE_ADJUSTMENTS, STORE_ADJUSTMENTS_OPEN, INDICATORS, EVENT_SALES, RUN_LOG, REGISTRY_ANSWERS, REGISTRY_STORED,
                           INDICATOR_PAYLOADS, PRODUCT_STORE, PRICES, PROMO_HEADERS, PROMO_ITEMS,
                           ORDER_STATES, ORDER_TYPES, ORDER_ORIGINS, FIRST_LOAD, SECOND_LOAD, SALES_RAW,
                           RECEIPT_PRODUCTS, FAMILY_DIVISIONS, FAMILY_SEGMENTS, FAMILY_PACKS, DIVISIONS, LAST_COSTS]}


def _derived(expr: str, by: tuple[Key, ...]) -> str:
    """A column's expression over the keys; a key itself stays the plain column that the rows are distributed by."""
    for k in by:
        if expr == k.expr:
            return k.name
    for k in by:
        expr = expr.replace(k.text, k.value)
    return expr


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Render a stand-in table as a DataFrame over the driver's parquet files."""
    spec = ALL[name]
    out = None
    for part in spec.parts:
        df = driver_table(spark, sf_dir, part.table)
        if part.where:
            df = df.where(part.where)
        if part.by:  # each key is a column too, so rows that differ in the keys differ
            missing = [k.name for k in part.by if k.expr not in {expr for _, expr in part.columns}]
            if missing:
                raise ValueError(f"{name}: keys {missing} are no columns")
            df = df.selectExpr(*[f"{k.expr} AS {k.name}" for k in part.by]).distinct()
        df = df.selectExpr(*[f"{_derived(_dialect(expr, 0), part.by)} AS {alias}" for alias, expr in part.columns])
        if part.distinct and not part.by:
            df = df.distinct()
        out = df if out is None else out.unionByName(df)
    return out


def duckdb_sql(name: str) -> str:
    """The same stand-in table as a DuckDB sub-query over the registered views."""
    spec = ALL[name]
    selects = []
    for part in spec.parts:
        cols = ", ".join(f"{_dialect(expr, 1)} AS {alias}" for alias, expr in part.columns)
        where = f" WHERE {part.where}" if part.where else ""
        dist = "DISTINCT " if part.distinct else ""
        selects.append(f"SELECT {dist}{cols} FROM {part.table}{where}")
    return " UNION ALL ".join(selects)


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the named stand-in tables for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_sql(n)})" for n in names)
