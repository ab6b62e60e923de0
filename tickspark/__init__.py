"""Tick analytics on Spark: decoding, indicators, bars, products, a star schema, and streams of them.

Every operator is a function from DataFrame to DataFrame made of native expressions.
"""
