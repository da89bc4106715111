"""Operators for large training-data pipelines (one module per operator).

Nothing else in the library imports this subpackage. ``queries.py`` registers
the operators as queries, ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
