"""Operators of a training-data pipeline over text corpora.

Nothing else in the library imports this subpackage; its queries are listed in
``eventlens.llm.queries``.
"""
