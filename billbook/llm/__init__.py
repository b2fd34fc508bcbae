"""Training-data operators: dedup, tokens, shards, filters, scans.

Nothing outside this package imports it; ``queries.py`` registers one
query per operator.
"""
