"""Electricity-market analytics as Spark DataFrame transformations."""
