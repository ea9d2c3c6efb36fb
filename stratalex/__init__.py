"""Concept hierarchies from text, built on Spark DataFrames."""
