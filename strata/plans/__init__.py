"""Logical plans of the lake: models, the medallion runner, KPIs, charts,
quality reports, lake-writing jobs and the query registry."""
