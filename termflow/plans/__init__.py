"""Registered queries (``QUERIES``) and their SQL oracle (``ORACLE_SQL``)."""

from termflow.plans import batches as _batches
from termflow.plans import prices as _prices
from termflow.plans import topics as _topics
from termflow.plans.corpus import QUERIES as _CORPUS
from termflow.plans.oracle import CORPUS_SQL as _CORPUS_SQL

QUERIES = {**_CORPUS, **_prices.QUERIES, **_topics.QUERIES, **_batches.QUERIES}
ORACLE_SQL = {**_CORPUS_SQL, **_prices.ORACLE, **_topics.ORACLE, **_batches.ORACLE}

__all__ = ["QUERIES", "ORACLE_SQL"]
