"""tablewright: loading and keeping parquet tables current with Spark.

Sources and sinks, typing and quality gates, change application (flagged
merges, sequenced change feeds, snapshot comparison), ledgers, ranking,
layout and reconciliation, all as DataFrame / Spark SQL / Structured
Streaming plans.
"""

__version__ = "0.1.0"
