"""Spark-first engine for document chunk tables and retrieval evaluation."""
