"""Layered commerce and marketing warehouse on Spark: raw files -> clean tables -> star schema and marts."""
