"""rfmlens: RFM scoring, levels and country/region preference on Spark.

Sub-packages: ``sources`` (scans, fixtures, day-partition sinks),
``functions`` (column expressions), ``operators`` (joins, aggregates,
ranks, scores), ``plans`` (the jobs and the query catalogue),
``streaming`` (incremental day runs).
"""

__version__ = "0.1.0"
