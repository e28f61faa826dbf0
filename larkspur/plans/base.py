"""Where queries and the SQL that gives the same rows are put together."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.sources import tables as t

QUERIES: dict = {}
ORACLES: dict = {}
FIELDS = ["title", "price", "property_type", "city", "bedrooms"]
#: The fields whose differences make a row changed, as in CHANGED; a changed row takes all FIELDS.
WATCHED = ["title", "price"]
NOW = "2024-02-01"

#: Whether two rows n and o of the feed differ, in SQL.
CHANGED = """
(CASE WHEN n.title IS NULL AND o.title IS NULL THEN false WHEN n.title IS NULL OR o.title IS NULL THEN true ELSE n.title <> o.title END
 OR abs(n.price - o.price) / o.price > 0.01)"""

#: The address of page_id p in SQL after normalization.
BARE = r"regexp_replace(regexp_replace(lower({}), '[;?#][\s\S]*$', ''), '/+$', '')"


def query(name: str, sql: str | None = None, derived: bool = True):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = (t.SQL if derived else "") + sql
        return f

    return keep


def at(when: str = NOW, kind: str = "timestamp"):
    return F.lit(when).cast(kind)
