"""The registered queries: each operator over whole tables, with its SQL.

A module here holds `QUERIES` (name -> function of (spark, folder)) and `SQL`
(name -> equivalent DuckDB statement; absent where SQL cannot express it).
"""

from corpusforge.workloads import chat, conforming, evaluation, mixing, profiling, rewards, sources, streams, text

_MODULES = (text, rewards, conforming, chat, profiling, mixing, sources, streams, evaluation)


def queries():
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
