"""Reference SQL (DuckDB dialect) for every registered query.

Written row-wise, with window functions over raw rows and one grouping per range joined
full outer, so that it shares no shortcut with the Spark plans it checks.
"""
