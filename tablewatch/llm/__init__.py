"""Operators of a training-data pipeline: tokenising, de-duplication, packing, filtering, archives.

Nothing else in the library imports this subpackage.
"""
