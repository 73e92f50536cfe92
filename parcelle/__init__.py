"""Listing analytics on Spark: raw JSON listings in, one typed table out."""
