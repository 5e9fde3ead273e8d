"""strata — a retail lake (ingest → bronze → silver → gold star schema → KPIs,
quality profile and data tests) written as ordinary Spark DataFrame jobs.

Sub-packages
------------
``sources``    where rows come from: test-table adapters, CSV landing/ingest,
               Parquet lake paths, catalog registration.
``functions``  column expressions (dates, money, exact rounding, labels).
``operators``  reusable relational building blocks (latest-row dedupe,
               bounded enrichment, content digests, duplicate/null profiling, top-k).
``plans``      the models of each layer, the medallion runner, KPIs, charts,
               quality reports and the query registry.
``llm``        training-data operators; optional, nothing else imports it.
"""

__all__ = ["__version__"]

__version__ = "0.1.0"
