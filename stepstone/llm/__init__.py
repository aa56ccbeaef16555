"""Operators for training data: fingerprints, filters, scores, tokens and packing over a table of documents.

Nothing else in the library imports this subpackage.
"""
