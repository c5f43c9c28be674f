"""Incremental ELT, data checks and review tagging as Spark DataFrame plans."""
