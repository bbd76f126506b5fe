import datetime as dt
import os
import tempfile

import pytest

from shelfspark.operators.incremental import read_table
from shelfspark.plans import build
from shelfspark.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def test_cold_build_is_idempotent_and_guards_full_refresh(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-build-"), "wh")
    names = build.build(spark, SF, out)
    assert "fato_venda" in names and "mart_curva_abc" not in names   # monthly models skipped
    counts = {n: read_table(spark, f"{out}/gold/{n}").count() for n in names}
    build.build(spark, SF, out, select=["fato_venda", "fato_pedido_compra", "fato_estoque_movimento"])
    for n in ["fato_venda", "fato_pedido_compra", "fato_estoque_movimento"]:
        assert read_table(spark, f"{out}/gold/{n}").count() == counts[n]
    # the allocation read the stored shares; monthly marts build when selected
    assert counts["mart_meta_comercial"] > 0
    assert build.build(spark, SF, out, select=["mart_curva_abc"]) == ["mart_curva_abc"]
    with pytest.raises(ValueError):
        build.build(spark, SF, out, select=["fato_pedido_compra"], full_refresh_models=["fato_pedido_compra"])


def test_marts_read_stored_history(spark):
    """A sale kept in the stored fact but absent from the current extract still counts."""
    from pyspark.sql import functions as F
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-build2-"), "wh")
    build.build(spark, SF, out, select=["fato_venda"])
    stored = read_table(spark, f"{out}/gold/fato_venda")
    w = Warehouse(spark, SF, stored=out)
    assert w.sales_fact.count() == stored.count()
    # drop the newest month from the extract: the stored-backed view still sees it
    extract_only = Warehouse(spark, SF).sales_fact
    newest = extract_only.agg(F.max("data_venda")).first()[0]
    assert w.sales_fact.agg(F.max("data_venda")).first()[0] == newest


def test_quality_run_after_build(spark):
    from shelfspark.plans import quality
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-build3-"), "wh")
    ts = dt.datetime(2024, 1, 2, 3, 4)
    build.build(spark, SF, out, exclude_tags=(), run_ts=ts, parallelism=4)
    # every gold model is there, facts carry the load stamp, and merged tables stay as they are when merged again
    counts = {m.name: read_table(spark, f"{out}/gold/{m.name}").count() for m in build.MODELS}
    assert {"dim_produto_empresa", "dim_fornecedor_tributario", "cnpj_dados_receita", "indicadores_mercado_externo"} <= set(counts)
    assert all(counts.values()) and "carregado_em" in read_table(spark, f"{out}/gold/fato_venda").columns
    again = ["cnpj_dados_receita", "indicadores_mercado_externo", "dim_fornecedor_tributario"]
    build.build(spark, SF, out, select=again, run_ts=ts)
    assert {n: read_table(spark, f"{out}/gold/{n}").count() for n in again} == {n: counts[n] for n in again}
    res = {(r.camada, r.tabela, r.teste, r.colunas): r.violacoes for r in quality.run(spark, SF, out, ts).collect()}
    assert len(res) == len(quality.SILVER) + len(quality.GOLD) + 2
    assert not [k for k in res if "absent" in k[2]]             # every declared column is there
    # all rows of the run carry its load time
    assert all(n == 0 for (_, _, test, cols), n in res.items() if (test, cols) == ("not_null", "carregado_em"))
    assert res["gold", "dim_empresa_info", "unique", "empresa_id"] == 0
    assert res["gold", "mart_curva_abc", "unique", "empresa_id,produto_id"] == 0
    assert res["gold", "fato_venda", "accepted_values", "cod_operacao"] == 0
    # counts against the rows themselves: ledger codes outside E and S, movement ids used twice, products without family
    ledger = Warehouse(spark, SF).raw("mrl_lanctoestoque").select("seqmovtoestq", "tiplancto").toPandas()
    assert res["silver", "mrl_lanctoestoque", "accepted_values", "tip_lancto"] == (~ledger.tiplancto.str.upper().isin(["E", "S"])).sum() > 0
    twice = ledger.groupby("seqmovtoestq").size()
    assert res["silver", "mrl_lanctoestoque", "unique", "movimento_id"] == (twice > 1).sum()
    part = Warehouse(spark, SF).raw("map_produto").select("seqfamilia").toPandas()
    assert res["silver", "map_produto", "not_null", "familia_id"] == part.seqfamilia.isna().sum() > 0
    # the reconciliation and zero-sum counts agree with the registered check queries
    # (at sf0.001 a month can miss one of the adjusted stores, so neither is assumed 0)
    import __spark_entry__ as E
    assert res["silver", "meta_ajustes_loja", "zero_sum", "ajuste_padrao_valor"] == E.queries()["dq_zero_sum"](spark, SF).count()
    assert (res["gold", "mart_meta_comercial", "reconciliation", "meta_padrao_valor,meta_desafio_valor"]
            == E.queries()["dq_reconcile"](spark, SF).count())


def test_parallel_build_matches_serial(spark):
    base = tempfile.mkdtemp(prefix="shelf-build4-")
    a, b = os.path.join(base, "serial"), os.path.join(base, "parallel")
    names = build.build(spark, SF, a)
    assert sorted(build.build(spark, SF, b, parallelism=4)) == sorted(names)
    for n in ["fato_venda", "dim_produto_info", "mart_meta_comercial", "mart_meta_referencia_grupo"]:
        x, y = read_table(spark, f"{a}/gold/{n}"), read_table(spark, f"{b}/gold/{n}")
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_writeback_step_persists_and_is_stable(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-build5-"), "wh")
    build.build(spark, SF, out)
    first = read_table(spark, f"{out}/gold/meta_ajustes_loja")
    n, ids = first.count(), {r.id for r in first.select("id").collect()}
    assert first.where("meta_padrao_sem_ajuste IS NOT NULL").count() > 0
    build.build(spark, SF, out, select=["meta_ajustes_loja"])   # re-run: rows updated, none inserted again
    again = read_table(spark, f"{out}/gold/meta_ajustes_loja")
    assert again.count() == n and {r.id for r in again.select("id").collect()} == ids


def test_full_build_twice(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-build6-"), "wh")
    build.build(spark, SF, out)
    before = read_table(spark, f"{out}/gold/dim_empresa_info").count()
    build.build(spark, SF, out)     # dimensions rebuilt from the sources, marts read the stored ones
    assert read_table(spark, f"{out}/gold/dim_empresa_info").count() == before
    assert read_table(spark, f"{out}/gold/mart_meta_comercial").count() > 0
