"""Spark-first analytics for genomic insertion-site data."""
