"""Change-data-capture warehouse on Spark: decode, route, archive, upsert, query."""
