"""Registered queries and, next to each, the SQL that must give the same rows."""

from recensio.catalog import base, checks, features, labels, language, similar, sources, summary, text, topics

__all__ = ["base", "checks", "features", "labels", "language", "similar", "sources", "summary", "text", "topics"]


def queries():
    return dict(sorted(base.QUERIES.items()))


def oracle_sql():
    return dict(sorted(base.ORACLES.items()))
