"""All registered queries and the SQL that checks them."""

from keepwell.catalog import feature_queries, learning_queries, quality_queries, score_queries

_PARTS = (feature_queries, quality_queries, score_queries, learning_queries)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: text for part in _PARTS for name, text in part.ORACLE.items()}
