"""Scriptoria: a Spark-first engine for structuring and cleaning document collections."""
