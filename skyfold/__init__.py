"""skyfold: forecast vs. observation analytics on Spark.

Validated JSON pulls -> typed tables -> forecast/observation merge and
per-place stats -> upserted snapshots -> dashboard queries, all as
DataFrame operations. See README.md.
"""

__version__ = "0.1.0"
