"""Readers: CSV by column name, landed Parquet partitions, path listing."""
