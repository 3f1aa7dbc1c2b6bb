"""The registered queries: each runs one operator over whole tables, with SQL that says the same."""

from tablelift.queries import catalogs, checks, chunks, databases, files, geopackages, runs, texts

MODULES = (texts, files, chunks, checks, runs, catalogs, databases, geopackages)


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
