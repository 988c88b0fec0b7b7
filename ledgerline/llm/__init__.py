"""Operators of a training-data pipeline: mixing, search, scoring, clean-up, archives.

Each module holds one operator with its own general interface; ``queries`` holds the thin
driver queries.  Nothing else in the library imports this subpackage.
"""
