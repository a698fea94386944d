"""Where the query modules register their Spark callable and its SQL twin."""

from readsift.checks.views import with_views

QUERIES, ORACLES = {}, {}


def query(name: str, views: list = (), sql: str = None):
    """Register a callable (spark, sf_dir) -> DataFrame; `sql` runs on the named views in DuckDB.

    `sql` is either one SELECT, or more WITH members followed by one SELECT (starting with a comma).
    """

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"{with_views(list(views), materialized=True)}\n{sql}" if views else sql
        return fn

    return register
