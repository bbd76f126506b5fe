"""shelfspark: retail warehouse jobs (raw extracts -> cleaned tables -> dimensions,
incremental facts and analytic marts -> data-quality checks) written as Spark
DataFrame plans.

Layout
------
sources/    readers: driver tables, stand-in source tables, seeds, landed files
functions/  Column-level helpers (decodes, labels, safe ratios, calendar math)
operators/  reusable DataFrame operators (keyed delete+insert, upsert, prefix sum,
            first-row-per-key, share normalisation, data-quality checks)
plans/      one module per warehouse layer: silver, facts, dimensions, marts
streaming/  intraday micro-batch path (Structured Streaming + foreachBatch)
"""

__all__ = ["session"]
