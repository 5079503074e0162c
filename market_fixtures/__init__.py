"""Venue messages and pages rendered from the test tables, the input of the frame queries."""
