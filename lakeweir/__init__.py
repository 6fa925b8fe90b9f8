"""Layered lake tables and stream enrichment, written as plain Spark jobs."""
