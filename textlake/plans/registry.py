"""Queries over the driver's tables, and their SQL."""

from . import analysis, feeds, ingest, periods, roundtrips, streams

QUERIES: dict = {}
SQL: dict = {}
for _module in (ingest, analysis, periods, feeds, roundtrips, streams):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
