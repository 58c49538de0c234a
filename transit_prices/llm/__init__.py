"""Operators for preparing large text corpora (language id, tokenisation,
language models, near-duplicate search, quality rules, mixing, exact top-k).

Nothing else in the library imports this subpackage.
"""
