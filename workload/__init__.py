"""Queries over the driver's tables, each with its SQL counterpart."""

from workload import file_queries, folder_queries, function_queries, grid_queries, round_trip_queries, sink_queries

_PARTS = (file_queries, folder_queries, function_queries, grid_queries, sink_queries, round_trip_queries)


def queries() -> dict:
    return {name: run for part in _PARTS for name, (run, _) in part.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
