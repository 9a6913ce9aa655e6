"""All core queries with their SQL."""

from . import corpus, design, general, hardware, leakage, reports

QUERIES = {**corpus.QUERIES, **design.QUERIES, **general.QUERIES, **hardware.QUERIES, **leakage.QUERIES, **reports.QUERIES}
SQL = {**corpus.SQL, **design.SQL, **general.SQL, **hardware.SQL, **leakage.SQL, **reports.SQL}
