"""Physical-plan properties the scale design relies on."""
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfspark.operators.dedup import first_per_key
from shelfspark.plans import build, marts
from shelfspark.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_filter_prunes_stored_month_partitions(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shelf-plan-"), "wh")
    build.build(spark, SF, out, select=["fato_venda"])
    w = Warehouse(spark, SF, stored=out)
    period = marts.trailing_year(w.sales_fact, "data_venda")
    plan = _plan(marts.within(w.sales_fact, period, "data_venda").select("empresa_id"))
    assert "PartitionFilters: [isnotnull(mes_part" in plan and "mes_part" in plan.split("PartitionFilters")[1][:200]


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = _plan(first_per_key(df, ["k"], [F.col("v").desc()]))
    lines = [line for line in plan.split("\n") if "WindowGroupLimit" in line or "Exchange" in line]
    kinds = ["limit" if "WindowGroupLimit" in line else "exchange" for line in lines]
    # final limit, then the exchange, then the partial limit below it
    assert kinds[:3] == ["limit", "exchange", "limit"]


def test_fact_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["delivery_time"](spark, SF))
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "l_shipdate" in line]
    # the receipts stand-in never uses the return flag or line status: they are not read
    assert scans and all("l_returnflag" not in s and "l_linestatus" not in s for s in scans)
    assert not any("CartesianProduct" in line or "BroadcastNestedLoopJoin" in line for line in plan.split("\n"))


def test_no_machine_local_checkpoint_folder_on_a_cluster():
    import pytest
    from shelfspark.session import checkpoint_dir

    class Session:
        def __init__(self, master):
            self.conf = self
            self.sparkContext = self
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

        def getCheckpointDir(self):
            return None

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,512]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session(master))
