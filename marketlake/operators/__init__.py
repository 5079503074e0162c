"""Bars, tape, resampling, books, quality, reference data, coverage and analytics."""
