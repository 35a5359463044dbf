"""Operators for training-data corpora, each built on Spark by one named method.

Nothing else in the library imports this subpackage; ``llm.catalog`` holds its
registered queries and their SQL twins.
"""
