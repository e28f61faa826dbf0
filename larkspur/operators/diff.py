"""Snapshot comparison: new, changed, missing and relisted listings, field by field."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import significance as sig


def paired(new: DataFrame, old: DataFrame, key: str, fields: list[str], kept: list[str] = ()) -> DataFrame:
    """One row for each key of either side with n_<field> and o_<field>, in_new and in_old: one full outer join. ``kept``: more
    columns of the old side, under their own names."""
    a = new.select(key, F.lit(True).alias("in_new"), *[F.col(f).alias(f"n_{f}") for f in fields])
    b = old.select(key, F.lit(True).alias("in_old"), *[F.col(f).alias(f"o_{f}") for f in fields], *kept)
    return a.join(b, key, "full").withColumns({x: F.coalesce(x, F.lit(False)) for x in ("in_new", "in_old")})


def one_each(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each key, as an update that meets the key several times leaves it: the last by ``order``, or without an order
    the one that is last as text."""
    rest = [c for c in rows.columns if c not in (key, order)]
    by = F.to_json(F.struct(*rest)) if order is None else F.col(order)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(key, "_r.*")


def any_change(fields: list[str]) -> Column:
    out = F.lit(False)
    for f in fields:
        out = out | sig.differs(f, F.col(f"n_{f}"), F.col(f"o_{f}"))
    return out


def classify(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change): new, updated, unchanged or missing."""
    rows = paired(new, old, key, fields)
    change = F.when(~F.col("in_old"), "new").when(~F.col("in_new"), "missing").when(any_change(fields), "updated").otherwise("unchanged")
    return rows.select(key, change.alias("change"))


#: Buckets of a kept snapshot, the same for all that are compared.
SNAPSHOT_BUCKETS = 32


def keep_snapshot(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A snapshot as a bucketed and sorted table of the warehouse, with ``print``, the SHA-256 of its fields as JSON.

    Written once, it is compared with any other one without a shuffle. Keys tell its rows apart.
    """
    spark, name = rows.sparkSession, f"snapshot_{uuid.uuid4().hex}"
    marked = rows.select(key, *fields, F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("print"))
    marked.repartition(SNAPSHOT_BUCKETS, key).write.bucketBy(SNAPSHOT_BUCKETS, key).sortBy(key).format("parquet").saveAsTable(name)
    return spark.table(name)


def classify_stored(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``classify`` of two kept snapshots: buckets are merged side by side, and fields compared where the prints differ."""
    rows = paired(new, old, key, [*fields, "print"])
    same = F.col("n_print") == F.col("o_print")
    change = F.when(~F.col("in_old"), "new").when(~F.col("in_new"), "missing").when(same, "unchanged").when(any_change(fields), "updated").otherwise("unchanged")
    return rows.select(key, change.alias("change"))


def field_changes(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row for each changed field of the keys of both sides: old and new as text, confidence, reason."""
    rows = paired(new, old, key, fields).where("in_new AND in_old")
    records = F.array(
        *[
            F.when(
                sig.differs(f, F.col(f"n_{f}"), F.col(f"o_{f}")),
                F.struct(
                    F.lit(f).alias("field"), F.col(f"o_{f}").cast("string").alias("old_value"), F.col(f"n_{f}").cast("string").alias("new_value"),
                    sig.confidence(f, F.col(f"n_{f}"), F.col(f"o_{f}")).cast("double").alias("confidence"),
                    F.lit(f"Field '{f}' changed").alias("reason"),
                ),
            )
            for f in fields
        ]
    )
    return rows.select(key, F.explode(F.array_compact(records)).alias("r")).select(key, "r.*")


def new_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.select(key).distinct().join(old.select(key), key, "left_anti")


def removed_keys(live: DataFrame, seen: DataFrame, sessions: DataFrame, now: Column, unseen_days: int = 3, look_back: int = 7) -> DataFrame:
    """Active rows not seen for ``unseen_days`` and absent from the completed sessions of the last ``look_back`` days; none if
    there is no such session. live: (id, status, last_seen); seen: (id, session_id); sessions: (session_id, status, created)."""
    recent = sessions.where((F.col("status") == "completed") & (F.col("created") >= F.date_sub(now, look_back))).select("session_id")
    old = live.where((F.col("status") == "active") & (F.col("last_seen") < F.date_sub(now, unseen_days))).select("id")
    present = seen.join(recent, "session_id", "left_semi").select("id")
    any_session = F.broadcast(recent.agg(F.count("*").alias("n")).where("n > 0"))
    return old.join(present, "id", "left_anti").join(any_session, F.lit(True), "left_semi")


def dedup_manifest(rows: DataFrame, key: str = "id") -> DataFrame:
    """The first entry of each key, unless it has no price and a later one has: then the first with a price."""
    order = Window.partitionBy(key).orderBy((F.coalesce("price", F.lit(0.0)) == 0).cast("int"), "seq")
    return rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def manifest_flags(manifest: DataFrame, live: DataFrame, known: DataFrame, percent: float = 1.0, amount: float = 1000.0) -> DataFrame:
    """(id, is_new, price_changed, needs_full_scrape, unknown) of deduplicated manifest rows against live and earlier manifests."""
    both = manifest.select("id", "price").join(live.select("id", F.col("price").alias("live_price"), F.lit(True).alias("l")), "id", "left")
    both = both.join(known.select("id", F.lit(True).alias("k")).distinct(), "id", "left")
    is_new = F.col("l").isNull()
    priced = (F.coalesce("price", F.lit(0.0)) != 0) & (F.coalesce("live_price", F.lit(0.0)) != 0)
    moved = ~is_new & priced & F.coalesce(sig.flags_price(F.col("live_price"), F.col("price"), percent, amount), F.lit(False))
    return both.select(
        "id", is_new.alias("is_new"), moved.alias("price_changed"), (is_new | moved).alias("needs_full_scrape"), F.col("k").isNull().alias("unknown")
    )


def manifest_price_changes(manifest: DataFrame, live: DataFrame, least: float = 0.01) -> DataFrame:
    """Relative price moves beyond ``least``; the last manifest row of an id counts; live prices of null or 0 are skipped."""
    last = manifest.where(F.coalesce("price", F.lit(0.0)) != 0).groupBy("id").agg(F.max_by("price", "seq").alias("new_price"))
    both = last.join(live.where(F.coalesce("price", F.lit(0.0)) != 0).select("id", F.col("price").alias("old_price")), "id")
    share = (F.col("new_price") - F.col("old_price")) / F.col("old_price")
    return both.where(F.abs(share) > least).select(
        "id", "old_price", "new_price", share.alias("share"), F.when(share > 0, "increase").otherwise("decrease").alias("direction")
    )


def unlisted() -> Column:
    """Whether a live row counts as gone, so that a sight of it is a relisting."""
    return F.coalesce(F.col("listing_status").isin("confirmed_removed", "sold", "likely_removed"), F.lit(False))


def relisted(manifest: DataFrame, live: DataFrame) -> DataFrame:
    gone = live.where(unlisted()).select("id")
    return manifest.select("id").distinct().join(gone, "id", "left_semi")


def entity_changes(ids: DataFrame, kind: str, session: Column) -> DataFrame:
    """One record for each id: kind (created, removed, ...), confidence and reason."""
    return ids.select(
        "id", F.lit(kind).alias("change_type"), F.lit(0.95 if kind in ("created", "removed") else 0.8).alias("confidence"),
        F.concat(F.lit(f"Property {kind} in session "), session.cast("string")).alias("reason"),
    )


def flagged_price_changes(manifest: DataFrame, live: DataFrame) -> DataFrame:
    """Manifest rows flagged as price_changed whose price differs from the live one; neither may be null or 0. percent is of the
    live price."""
    both = manifest.where("price_changed").join(live.select("id", F.col("price").alias("old_price")), "id")
    some = (F.coalesce("price", F.lit(0.0)) != 0) & (F.coalesce("old_price", F.lit(0.0)) != 0)
    return both.where(some & (F.col("price") != F.col("old_price"))).select(
        "id", "old_price", F.col("price").alias("new_price"), (F.abs(F.col("price") - F.col("old_price")) / F.col("old_price") * 100).alias("percent"), "url"
    )


def clear_flags(manifest: DataFrame, session: Column) -> DataFrame:
    """The flags of a session's manifest rows are false."""
    own = F.coalesce(F.col("session_id") == session, F.lit(False))
    return manifest.withColumns({c: F.when(own, False).otherwise(F.col(c)) for c in ("is_new", "price_changed", "needs_full_scrape")})


def push_prices(manifest: DataFrame, live: DataFrame, session: Column, now: Column) -> DataFrame:
    """Live rows take the price that a session's manifest gives for them, the last of it where there are several."""
    last = manifest.where((F.col("session_id") == session) & F.col("price").isNotNull()).groupBy("id").agg(F.max_by("price", "seq").alias("seen_price"))
    rows = live.join(last, "id", "left")
    seen = F.col("seen_price").isNotNull()
    return rows.select(
        *[c for c in live.columns if c not in ("manifest_price", "manifest_seen")],
        F.coalesce("seen_price", "manifest_price").alias("manifest_price"), F.when(seen, now).otherwise(F.col("manifest_seen")).alias("manifest_seen"),
    )
