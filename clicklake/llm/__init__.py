"""Operators of a training-data pipeline over document, page and URL tables.

One module per operator; ``queries`` registers them.  Nothing outside this
subpackage imports it.
"""
