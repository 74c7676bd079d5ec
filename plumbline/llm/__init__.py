"""Operators of a training-data pipeline: cleaning, duplicates, leaks, licenses, secrets and mixing of text corpora.

Nothing outside this package imports it. ``queries`` holds the registered queries and their SQL.
"""
