"""Data preparation and analytics on Spark, built from DataFrame-to-DataFrame functions."""
