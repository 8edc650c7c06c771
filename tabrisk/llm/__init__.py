"""Operators of a training-data pipeline: near duplicates, fingerprints, scoring, extraction, packing, tokenizing.

Nothing else in the library imports this subpackage.
"""
