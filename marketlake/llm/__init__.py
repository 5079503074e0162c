"""Operators for preparing training text: dedup, filtering, scoring, extraction and mixing.

Every operator selects the columns it needs before it works, so extra columns of any
name are harmless; null text counts as empty text unless a docstring says otherwise.
"""
