"""Listing feeds on Spark: extraction, identity, snapshot diff, quality rules, merge, queues and statistics."""
