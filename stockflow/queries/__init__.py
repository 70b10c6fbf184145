"""Registered queries: name -> (DataFrame function of (spark, sf_dir), SQL twin or None)."""

from stockflow.queries import checks, live, loading, marts, planning, streams

REGISTRY = {**marts.QUERIES, **loading.QUERIES, **checks.QUERIES, **streams.QUERIES, **live.QUERIES, **planning.QUERIES}
