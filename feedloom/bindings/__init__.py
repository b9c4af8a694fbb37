from feedloom.bindings import charts, pages, runs, tables, texts  # noqa: F401
from feedloom.bindings.registry import QUERIES, SQL, bound

__all__ = ["QUERIES", "SQL", "bound"]
