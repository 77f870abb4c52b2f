"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` registers one query per operator
and ``corpus_pipeline`` at the repository top chains five of them.  Nothing outside this folder
imports it.
"""
