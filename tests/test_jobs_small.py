"""Golden fixtures for the log, enrichment, write-back, seed and streaming jobs."""
import datetime as dt
import json
import os
import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfspark.operators.incremental import read_table
from shelfspark.plans import enrich, logs, targets
from shelfspark.sources import seeds
from shelfspark.streaming import hot

START = "2026/01/05 01:00:00 - wf - Start of workflow execution"


def _fin(ts, name):
    return f"2026/01/05 {ts} - {name} - Execution finished on a local pipeline engine"


def test_log_timing_from_text_files(spark):
    d = tempfile.mkdtemp(prefix="shelf-log-")
    with open(os.path.join(d, "a.log"), "w") as f:
        f.write("\n".join([START, "noise line", _fin("01:00:10", "p1"), _fin("01:00:40", "p'2"),
                           _fin("01:02:40", "p3")]) + "\n")
    with open(os.path.join(d, "b.log"), "w") as f:   # finishes but no start: nothing
        f.write(_fin("02:00:00", "orphan") + "\n")
    timing = logs.step_timing(logs.read_log_lines(spark, d), "wf")
    rows = sorted((r.pipeline_name, r.duration_seconds) for r in timing.collect())
    assert rows == [("p'2", 30), ("p1", 10), ("p3", 120)]
    top = logs.slowest_of_latest(timing, k=2).orderBy("posicao").collect()
    assert [(r.posicao, r.pipeline_name) for r in top] == [(1, "p3"), (2, "p'2")]
    assert top[0].resumo == "p3 120s; p'2 30s"


def test_registry_precedence_and_regime(spark):
    def payload(simples, mei, capital):
        return json.dumps({"situacao_cadastral": 2, "descricao_situacao_cadastral": "ativa",
                           "opcao_pelo_simples": simples, "opcao_pelo_mei": mei, "porte": "me",
                           "capital_social": capital, "data_inicio_atividade": "2001-02-03",
                           "cnae_fiscal": 4711301, "cnae_fiscal_descricao": "x"})
    answers = spark.createDataFrame([
        ("A", "brasilapi", 200, 1, payload(True, True, 1)),
        ("A", "minha_receita", 503, 2, None),              # first source failed: second wins
        ("B", "minha_receita", 200, 3, payload(True, False, 2)),
        ("B", "brasilapi", 200, 4, payload(False, False, 3)),
        ("C", "minha_receita", 200, 5, payload(None, None, 4)),
        ("C", "minha_receita", 200, 6, payload(False, None, 5)),   # re-sent: last wins
    ], "cnpj string, fonte_api string, status_http int, seq int, payload string")
    rows = {r.cnpj: r for r in enrich.registry_silver(enrich.registry_rows(answers)).collect()}
    assert rows["A"].fonte_api == "BRASILAPI" and rows["A"].regime_tributario == "MEI"
    assert rows["B"].fonte_api == "MINHA_RECEITA" and rows["B"].regime_tributario == "SIMPLES NACIONAL"
    assert rows["C"].capital_social == D("5.00") and rows["C"].regime_tributario == "REGIME NORMAL (REAL/PRESUMIDO)"
    assert rows["A"].data_inicio_atividade == dt.date(2001, 2, 3) and rows["A"].cnae_fiscal == "4711301"


def test_writeback_updates_and_inserts(spark):
    m = dt.date(2026, 3, 1)
    alloc = spark.createDataFrame([(m, 2, 1, "c", D("60.00"), D("70.00")), (m, 2, 2, "d", D("40.00"), D("50.00")),
                                   (m, 7, 1, "c", D("25.00"), D("30.00"))],
                                  "mes date, empresa_id int, categoria_id int, categoria_id_nome string, "
                                  "meta_padrao_valor decimal(18,2), meta_desafio_valor decimal(18,2)")
    params = spark.createDataFrame([(m, D("200.00"), D("250.00"), 2)],
                                   "mes date, meta_grupo_padrao_valor decimal(18,2), meta_grupo_desafio_valor decimal(18,2), anos_historico int")
    existing = spark.createDataFrame([(41, m, 2, D("10.00"), D("12.00"), None, None, None)],
                                     "id bigint, mes date, empresa_id int, ajuste_padrao_valor decimal(18,2), "
                                     "ajuste_desafio_valor decimal(18,2), participacao_loja_calculada double, "
                                     "meta_padrao_sem_ajuste decimal(28,2), meta_desafio_sem_ajuste decimal(28,2)")
    out = {r.empresa_id: r for r in targets.writeback(alloc, params, existing).collect()}
    assert (out[2].id, out[2].ajuste_padrao_valor, out[2].meta_padrao_sem_ajuste) == (41, D("10.00"), D("90.00"))
    assert out[2].participacao_loja_calculada == 0.45
    assert (out[7].id, out[7].ajuste_padrao_valor, out[7].meta_desafio_sem_ajuste) == (42, D("0.00"), D("30.00"))


def test_seed_csv_with_declared_types(spark):
    d = tempfile.mkdtemp(prefix="shelf-seed-")
    p = os.path.join(d, "feriados.csv")
    with open(p, "w") as f:
        f.write("mes,dia,nome\n" + "\n".join(f"{m},{dd},{n}" for m, dd, n in seeds.FIXED_HOLIDAYS) + "\n")
    df = seeds.read_seed_csv(spark, p, "mes INT, dia INT, nome STRING")
    assert sorted(map(tuple, df.collect())) == sorted(seeds.FIXED_HOLIDAYS)


def test_hot_path_stream_last_run_wins(spark):
    base = tempfile.mkdtemp(prefix="shelf-hot-")
    landing, target, ckpt = f"{base}/landing", f"{base}/fact", f"{base}/ckpt"
    cols = ("datahora timestamp_ntz, nroempresa int, nrodocto long, seriedocto string, checkout int, "
            "nroformapagto int, nrosegmento int, codgeraloper int, seqproduto int, seqoperador int, "
            "qtditem decimal(18,3), qtddevolitem decimal(18,3), vlritem decimal(18,2), vlrdevolitem decimal(18,2), "
            "lote int")
    t = dt.datetime(2024, 1, 2, 10)
    run1 = [(t, 2, 1, "H", 1, 1, 1, 800, 9, None, D(1), D(0), D("10.00"), D(0), 1),
            (t, 2, 2, "H", 1, 1, 1, 800, 9, None, D(1), D(0), D("20.00"), D(0), 1)]
    run2 = [(t, 2, 2, "H", 1, 1, 1, 800, 9, None, D(1), D(0), D("22.00"), D(0), 2),   # correction
            (t, 2, 3, "H", 1, 1, 1, 999, 9, None, D(1), D(0), D("5.00"), D(0), 2)]    # not a fact operation
    for rows in (run1, run2):
        spark.createDataFrame(rows, cols).write.mode("append").parquet(landing)
    hot.run_hot_path(spark, landing, target, ckpt, files_per_trigger=1)
    got = sorted((r.documento_numero, r.valor_venda) for r in read_table(spark, target).collect())
    assert got == [(1, D("10.00")), (2, D("22.00"))]
    hot.run_hot_path(spark, landing, target, ckpt)      # nothing new has landed: unchanged
    assert read_table(spark, target).count() == 2
