"""tickwise: Spark-native feature engineering for minute prices and news.

Batch operators live in :mod:`tickwise.operators`, table adapters and file
formats in :mod:`tickwise.sources`, column expressions in
:mod:`tickwise.functions`, named end-to-end queries in :mod:`tickwise.plans`
and Structured Streaming jobs in :mod:`tickwise.streaming`.
"""

__version__ = "0.1.0"
