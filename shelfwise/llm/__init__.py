"""Operators for preparing training text at scale.

One module per operator; ``queries`` binds them to the tables, and
``corpus_pipeline`` at the repository top chains five of them.
"""
