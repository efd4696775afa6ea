"""stratum: medallion batch operators for PySpark.

Landing monthly file drops, picking the latest ingestion batch, splitting rows
into valid and rejected by named rules, removing repeats by key, turning text
into typed columns, projecting to a target contract and writing date-partitioned
tables -- every step a plain ``DataFrame -> DataFrame`` function over native
Spark expressions, so Catalyst plans and the cluster runs all of it.
"""

from stratum import functions, operators, plans, sinks, sources, streaming

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming"]
