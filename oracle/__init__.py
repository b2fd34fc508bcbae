"""Independent DuckDB SQL for every registered query.

Written separately from the Spark library (own CTEs, own metric generator),
so a fault in the library is not copied into its check. Tables are the
driver's pre-registered views (orders, lineitem, ...).
"""
