"""Corpus operators for training-data pipelines.

One module per operator; ``catalog`` registers one query per operator. Nothing
outside this subpackage imports it.
"""
