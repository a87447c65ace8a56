"""Operators of a training-data pipeline (packing, dedup, language, mixing, …)."""
