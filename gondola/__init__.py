"""Retail price analytics on Spark: archives in, star schema, marts, parameterised queries."""
