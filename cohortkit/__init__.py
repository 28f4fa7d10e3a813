"""cohortkit: customer cohorts and in-cohort product recommendations on Spark.

Sub-packages:
  sources    delimited-file and driver-table readers, sinks
  functions  Column-level helpers (number/date parsing, name resolution, labels)
  operators  DataFrame -> DataFrame building blocks (relational, quantiles,
             features, clustering, recommendation, reports)
  plans      composite jobs (ETL, clustering run, reports) and the registered
             driver-table queries
  streaming  intentionally empty: the source project has no streaming work
"""

__all__ = ["spec"]
