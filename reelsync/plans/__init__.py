"""Plans: named queries over the film-domain views, and the load plans."""

from .registry import ORACLE_SQL, QUERIES


def load_all() -> None:
    """Import every query module so the registry is complete."""
    from . import (change_queries, document_queries, sink_queries,  # noqa: F401
                   stream_queries, text_queries)


load_all()

__all__ = ["ORACLE_SQL", "QUERIES", "load_all"]
