"""Operators for preparing language-model training data at scale.

Each module holds one operator; ``queries`` and ``oracles`` hold the thin
driver queries.  Nothing outside this subpackage imports it.
"""
