"""Venue reference data, the partitioned table store and frame normalisers."""
