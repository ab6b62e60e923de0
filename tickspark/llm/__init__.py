"""Operators for training-data pipelines: tokenizing, search, privacy, quality, dedup, packing.

Each module holds one operator with a general interface; ``queries`` derives the
registered queries from them. Nothing outside this subpackage imports it.
"""
