"""billbook: a Spark-native card-billing lakehouse and feature book.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame, so Catalyst sees one declarative plan per question.
"""

__version__ = "0.1.0"
