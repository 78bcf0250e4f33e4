"""Registered queries: the operators, run on the given tables, with SQL that must agree."""

from chartmill.catalog import clusters, encoding, learning, profiling, rows, trees, versions, workloads
from chartmill.catalog.base import Query


def catalog() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (rows, encoding, profiling, learning, trees, clusters, versions, workloads):
        clash = found.keys() & module.CATALOG.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        found.update(module.CATALOG)
    return found
