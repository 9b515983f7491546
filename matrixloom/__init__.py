"""Labelled-matrix analytics on Spark: lazy operators over long tables."""
