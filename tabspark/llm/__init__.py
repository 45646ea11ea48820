"""Training-data operators: dedup, token counts, search, quality, decontamination, sharding, scans, packing.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.SQL`` hold the registered queries and their DuckDB SQL.
"""
