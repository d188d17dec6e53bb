"""Operators for preparing language-model training data, their queries and SQL.

Nothing outside this folder imports it but the pipeline at the top of the repository.
"""
