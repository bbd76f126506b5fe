"""The corpus pipeline and the registered queries."""
import os
import random
import tempfile

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from shelfspark.llm import queries, toxicity
from test_bpe import library
from test_decontaminate import brute
from test_exact_dedup import plain
from test_simhash import components, fingerprint

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op3_html_extraction": ["page_id", "url", "text", "n_chars"], "op4_decontamination": ["doc_id", "item_id"],
    "op5_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op7_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op8_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op9_feistel_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    "op11_phrase_mining": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]}


def test_registered():
    assert set(queries.QUERIES) == set(CONTRACT) and set(CONTRACT) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "bpe"]


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_rows_and_columns(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.columns[: len(CONTRACT[name])] == CONTRACT[name]
    # a row per overlap, phrase or piece; all others a row per document or page
    if name not in ("op4_decontamination", "op11_phrase_mining", "op13_best_fit_packing"):
        table = "pages" if CONTRACT[name][0] == "page_id" else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
        assert df.select(CONTRACT[name][0]).distinct().count() == df.count()


@pytest.mark.parametrize("sf", [SF])
def test_exact_dedup_matches_its_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(queries.ORACLE["op6_exact_dedup"])
    names = [d[0] for d in cur.description]
    got = [tuple(r) for r in queries.QUERIES["op6_exact_dedup"](spark, sf).select(*names).collect()]
    assert sorted(got) == sorted(cur.fetchall())


def corpus():
    rng = random.Random(12)
    words = [f"word{i}" for i in range(500)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    docs = [(i, text(rng.randrange(150, 300))) for i in range(160)]
    labels = []
    for i in range(160):
        bad = i % 4 == 0
        if bad:
            docs[i] = (i, docs[i][1] + " vileword nastyword vileword nastyword")
        labels.append((i, 1, int(bad)))
    docs += [(200 + i, docs[i][1].replace(" ", "  ")) for i in range(1, 20)]  # equal after normalisation
    docs += [(300 + i, docs[i][1] + " word1") for i in range(1, 20)]  # near copies
    docs += [(400 + i, text(100) + " " + items[i][1] + " " + text(100)) for i in range(5)]
    docs += [(500, None), (501, ""), (502, "\n"), (3, docs[3][1]), (None, text(50)), (None, text(50))]
    return docs, labels, items


def test_run_matches_brute_force(spark):
    docs, labels, items = corpus()
    base = tempfile.mkdtemp(prefix="run-pipeline-")
    spark.createDataFrame([(*d, "en", "s", len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long") \
         .write.parquet(os.path.join(base, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(base, "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(base, "benchmark.parquet"))
    got = sorted((tuple(r)[:2] for r in C.run(spark, base).collect()), key=str)

    frame = spark.read.parquet(os.path.join(base, "documents.parquet"))
    scorer = toxicity.fit(frame, spark.read.parquet(os.path.join(base, "labels.parquet")))
    rows = [d for d in docs if scorer.score(d[1])[0] < toxicity.THRESHOLD]
    assert all("vileword" not in (t or "") for _, t in rows) and len(rows) > 120
    first = {}
    for i, t in rows:
        key = (i is None, i or 0, plain(t))
        if plain(t) not in first or key < first[plain(t)][0]:
            first[plain(t)] = (key, (i, t))
    rows = [r for _, r in first.values()]
    group = {}
    for (i, t), g in zip(rows, components([fingerprint(t) for _, t in rows], 3)):
        group.setdefault(g, []).append((i is None, i or 0, (i, t)))
    rows = [min(g, key=lambda x: x[:2])[2] for g in group.values()]
    leaked = {d for d, _ in brute([r for r in rows if r[0] is not None], items)}
    rows = [r for r in rows if r[0] is None or r[0] not in leaked]
    from shelfspark.llm import bpe
    codec = bpe.Codec(queries.tokenizer_path())
    assert got == sorted(((i, len(library(codec, t or ""))) for i, t in rows), key=str)
    assert len(leaked) == 5
