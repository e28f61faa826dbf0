"""The workflows as pure compositions: a session into the live table, a manifest into a diff, a tier's whole run.

Nothing is written: each gives the next snapshots. Gates read tables of one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators import diff, merge, quality, queue, stats
from larkspur.plans.config import Settings


def session_ready(sessions: DataFrame, staging: DataFrame, session) -> bool:
    """Whether a session is completed and has staged rows."""
    done = sessions.where((F.col("id") == session) & (F.col("status") == "completed"))
    return not done.isEmpty() and not staging.where(F.col("session_id") == session).isEmpty()


def quality_checks(rows: DataFrame, now: Column, key: str = "id") -> DataFrame:
    """One row: duplicate_rate, freshness and diversity; a check whose columns the rows lack has its value for no rows."""
    have = set(rows.columns)
    fresh = quality.freshness("scraped_at", now) if "scraped_at" in have else F.lit(0.0)
    spread = quality.geo_diversity("city", "neighborhood", "latitude", "longitude") if {"city", "neighborhood", "latitude", "longitude"} <= have else F.lit(0.0)
    return rows.agg(quality.duplicate_rate(key).alias("duplicate_rate"), fresh.alias("freshness"), spread.alias("diversity"))


@dataclass(frozen=True)
class Synced:
    passed: bool
    why: str
    score: float
    live: DataFrame
    changes: DataFrame
    problems: DataFrame


def daily_sync(
    staging: DataFrame, live: DataFrame, now: Column, fields: list[str], removed: DataFrame | None = None, settings: Settings = Settings(),
    sessions: DataFrame | None = None, session=None,
) -> Synced:
    """Promotes a session's rows if it is completed and has rows, if the overall quality reaches one gate and the score another.

    Without ``sessions`` only the score is asked for.
    """
    rows = staging if sessions is None else staging.where(F.col("session_id") == session)
    problems = quality.errors(rows, "id")
    refused = lambda why, score: Synced(False, why, score, live, diff.field_changes(rows, live, "id", fields).limit(0), problems)
    if sessions is not None and not session_ready(sessions, staging, session):
        return refused("session", 0.0)
    score = quality.overall_score(rows, problems)
    if sessions is not None:
        overall, _ = quality.overall_quality(F.col("score"), F.col("duplicate_rate"), F.col("freshness"), F.col("diversity"))
        one = score.join(F.broadcast(quality_checks(rows, now))).select("score", overall.alias("overall")).first()
        if one.overall < settings.quality_gate:
            return refused("quality", one.score)
    else:
        one = score.first()
    if one.score < settings.score_gate:
        return refused("score", one.score)
    return Synced(True, "", one.score, merge.promote(rows, live, now, fields, removed), diff.field_changes(rows, live, "id", fields), problems)


def wanted_of(flags: DataFrame) -> DataFrame:
    return flags.where("needs_full_scrape").select(F.col("id").alias("property_id"), F.when(F.col("is_new"), "new").otherwise("price_change").alias("reason"))


def manifest_to_queue(manifest: DataFrame, live: DataFrame, known: DataFrame, pending: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """What a scan adds to the queue: new listings and price moves that are not pending yet."""
    flags = diff.manifest_flags(diff.dedup_manifest(manifest), live, known, settings.price_percent, settings.price_amount)
    return queue.enqueue(pending, wanted_of(flags), settings.backlog_cap)


@dataclass(frozen=True)
class Diff:
    new: DataFrame
    price_changes: DataFrame
    relisted: DataFrame
    candidates: DataFrame
    verdicts: DataFrame | None
    live: DataFrame


def full_diff(manifest: DataFrame, live: DataFrame, now: Column, probes: DataFrame | None = None, settings: Settings = Settings()) -> Diff:
    """All differences of a scan: new ids, price changes of flagged rows, relisted ids, candidates for removal and, with ``probes``
    (id, url, http_status, location), their verdicts; and the live table after them.

    manifest: (id, seq, price, url, price_changed); live: (id, price, status, listing_status, misses, ...). Listings that are back
    are found by the listing_status they had before. The live table is joined once with what was seen and once with what the
    probes say; the rest are columns and filters of these rows.
    """
    once = manifest.select("id", F.lit(True).alias("_seen")).distinct()
    rows = live.join(once, "id", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    rows = merge.missed(rows.withColumn("_back", F.col("_seen") & diff.unlisted()), now)
    rows = rows.withColumns({"_candidate": F.coalesce(merge.listed(rows) & (F.col("misses") >= settings.missing_before_removal), F.lit(False)), "_misses": F.col("misses")})
    verdicts = None
    if probes is not None:
        said = probes.select("id", merge.removal_verdict(F.col("url"), F.col("http_status"), F.col("location")).alias("verdict"))
        verdicts = rows.where("_candidate").select("id").join(said, "id")
        rows = rows.join(merge.by_id(said), "id", "left").withColumns({c: F.col("_candidate") & F.col(c) for c in ("_gone", "_kept")})
        rows = merge.judged(rows, now)
    rows = merge.back_again(rows, now)
    candidates = rows.where("_candidate").select("id", F.col("_misses").alias("misses"))
    after = rows.drop("_seen", "_back", "_candidate", "_misses", "_gone", "_kept")
    return Diff(diff.new_keys(manifest, live, "id"), diff.flagged_price_changes(manifest, live), rows.where("_back").select("id"), candidates, verdicts, after)


@dataclass(frozen=True)
class TierRun:
    queue: DataFrame
    live: DataFrame
    manifest: DataFrame


def wanted_by_tier(level: int, found: Diff, live: DataFrame, now: Column, settings: Settings) -> DataFrame:
    """(property_id, reason) that a tier asks for: 1 new; 2 and price changes and relisted; 3 and the stalest, half the cap at
    most; 4 the stalest and a sample of the active rows."""
    tier = next(t for t in settings.tiers if t.level == level)
    at = "full_scrape" if "full_scrape" in live.columns else "last_seen"
    ask = lambda rows, why: rows.select(F.col("id").alias("property_id"), F.lit(why).alias("reason"))
    if level == 4:
        return ask(stats.stale(live, at, now, tier.stale_days, tier.queue_cap, False), "stale").unionByName(ask(stats.sample_percent(live, "id", tier.sample_percent), "sample"))
    out = ask(found.new, "new")
    if level > 1:
        out = out.unionByName(ask(found.price_changes, "price_change")).unionByName(ask(found.relisted, "relisted"))
    if level == 3:
        out = out.unionByName(ask(stats.stale(live, at, now, tier.stale_days, tier.queue_cap // 2, False), "stale"))
    return out


def tier_run(
    level: int, manifest: DataFrame, live: DataFrame, pending: DataFrame, scraped: DataFrame, now: Column, fields: list[str],
    probes: DataFrame | None = None, session: Column | None = None, settings: Settings = Settings(), row_id: Column | None = None,
) -> TierRun:
    """A tier's run as one set-based step: diff, enqueue with addresses, drain up to the tier's cap, take over what came back.

    Tier 2 also pushes the manifest's prices, tier 3 asks the probes about removals and drops removed rows from the manifest; tiers
    1 to 3 clear the session's flags. ``scraped``: (id, url, fields), what the addresses gave. ``pending``: the queue with url.
    """
    tier = next(t for t in settings.tiers if t.level == level)
    found = full_diff(manifest, live, now, probes if level == 3 else None, settings)
    base = found.live if level in (2, 3) else live
    asked = queue.enqueue(pending, queue.resolve_urls(wanted_by_tier(level, found, base, now, settings), ids_of(manifest), ids_of(live)), settings.backlog_cap, "url")
    key = F.xxhash64("property_id", "reason") if row_id is None else row_id
    added = asked.select(key.alias("id"), "property_id", "reason", "priority", "url", F.lit("pending").alias("status"), now.alias("queued_at"), F.lit(0).alias("attempts"))
    after = queue.drain(pending.select(*added.columns).unionByName(added), scraped, tier.queue_cap, now)
    done = after.where(F.col("completed_at").isNotNull() & (F.col("status") == "completed")).select("url").distinct()
    merged = merge.sparse_upsert(scraped.join(done, "url", "left_semi"), base, fields, now)
    seen = manifest
    if level == 2 and session is not None:
        merged = diff.push_prices(manifest, merged if "manifest_price" in merged.columns else merged.withColumn("manifest_price", F.lit(None).cast("double")), session, now)
    if level == 3 and found.verdicts is not None:
        seen = seen.join(found.verdicts.where("verdict = 'removed'").select("id"), "id", "left_anti")
    if level < 4 and session is not None:
        seen = diff.clear_flags(seen, session)
    return TierRun(after, merged, seen)


def ids_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("id").alias("property_id")).agg(F.min("url").alias("url"))
