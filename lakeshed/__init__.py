"""Catalogue and training-data operators for Spark: sources, normalisation, matching, snapshots, reports and gates."""
