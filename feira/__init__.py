"""Marketplace batch analytics on Spark: raw files, clean tables, sales and delivery marts."""
