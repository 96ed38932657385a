"""Operators for preparing large text corpora.

Nothing outside this subpackage imports it; ``factview.llm.queries`` holds the
registered queries and their SQL.
"""
