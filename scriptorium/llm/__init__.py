"""Operators for preparing training text: each one DataFrame in, DataFrame out.

Nothing outside this package imports it. Texts are processed whole; rows with a null id, a null or
empty text, repeated rows and empty tables have a defined result, stated in each operator.
"""
