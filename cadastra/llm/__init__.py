"""Corpus operators for training-data pipelines.

One module per operator; ``queries`` registers one query per operator. Nothing
else in the library imports this subpackage.
"""
