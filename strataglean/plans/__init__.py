"""The registered queries over the given tables, and the SQL that checks them."""

from strataglean.plans import clusters, explore, graphs, itemsets, ratings, sets, streams

PARTS = [explore, itemsets, sets, ratings, graphs, clusters, streams]

QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
