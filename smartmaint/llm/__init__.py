"""Training-data operators (packing, dedup, PII, search, chat formatting, …).

Each module holds one operator with its own general interface plus the thin
``opN_<name>`` query that derives the digest columns from it; ``queries``
collects the queries and their DuckDB SQL. Nothing else in the library
imports this package.
"""
