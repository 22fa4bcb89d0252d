"""Tidemark: support and AI-product data, from raw records to trusted tables, on Spark."""
