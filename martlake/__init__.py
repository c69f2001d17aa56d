"""martlake: marketplace order analytics as plain Spark DataFrame functions.

Layers (each a DataFrame -> DataFrame function, see ``operators``):

* raw CSV  -> typed source tables            (``sources.files``)
* source   -> order / item detail tables      (``operators.detail``)
* detail   -> daily and monthly aggregates    (``operators.summary``)
* summary  -> serving tables and KPIs         (``operators.serving``, ``operators.kpis``)

``plans.warehouse.build_warehouse`` runs every layer and writes each one to
Parquet, so later layers read a written table instead of a long lineage.
"""

__all__ = ["functions", "operators", "plans", "sinks", "sources"]
