"""Queries by name, each with the SQL that must give the same rows."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
