"""Audience-segment metrics on Spark.

Accounts are matched against segment definitions (JSON lists of
``category / operator / value`` conditions) in one set-based Spark job; a
date-partitioned metric table keeps one row per segment and day.
"""

__all__ = ["schemas", "session"]
