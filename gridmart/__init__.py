"""gridmart: electricity-market ELT on Spark DataFrames.

Landed text and JSON pages -> raw append tables -> staging (latest row per
grain, strict UTC typing) -> long-format marts -> keyed upsert, replica
refresh, declared metrics, checks, profiles and exports.  Everything is a
DataFrame / Spark SQL / Structured Streaming job; no RDDs, no row loops.
"""

__version__ = "0.1.0"
