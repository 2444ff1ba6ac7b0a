"""Training-data operators: token files, page extraction, decontamination, deduplication,
quality rules, chat formatting, archives, BPE and language identification.

Nothing outside this package imports it. Each module holds one operator with its own
interface; ``queries`` holds the thin registered queries and ``oracle`` their DuckDB SQL.
"""
