"""Curate daily series on Spark: parse, validate, deduplicate, merge, densify, model."""
