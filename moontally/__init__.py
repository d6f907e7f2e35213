"""Subscriber feature engine: monthly activity snapshots in, one wide feature row per subscriber out.

Every job is an ordinary lazy Spark DataFrame plan.  No Python UDFs, no driver
collects, no broadcast hints: join strategy and skew splitting are left to
adaptive execution, and every aggregation collapses rows map-side first.
"""
