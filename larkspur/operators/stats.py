"""Statistics of listings, manifests and runs, and the schedule of the tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.merge import listed

#: Hours between the runs of each tier.
EVERY = {1: 6, 2: 24, 3: 168, 4: 720}


def property_stats(live: DataFrame, *by: str) -> DataFrame:
    """Counts, prices and mean area by property type, operation type and city, or by the given columns."""
    return live.groupBy(*(by or ("property_type", "operation_type", "city"))).agg(
        F.count("*").alias("total"), F.round(F.avg("price"), 4).alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.round(F.avg("total_area_m2"), 4).alias("avg_area"), F.count_if(F.col("status") == "active").alias("active"),
    )


def manifest_stats(rows: DataFrame, now: Column) -> DataFrame:
    """One row: entries, new, price-changed and flagged ones, mean whole days since they were seen, the latest sight."""
    days = F.floor((F.unix_timestamp(now) - F.unix_timestamp("seen_at")) / 86400)
    flagged = lambda c: F.count_if(F.col(c)).alias(f"n_{c}")
    return rows.agg(F.count("*").alias("total"), flagged("is_new"), flagged("price_changed"), flagged("needs_full_scrape"), F.round(F.avg(days), 2).alias("avg_days"), F.max("seen_at").alias("latest"))


def last_run(runs: DataFrame) -> DataFrame:
    """The latest completed run of each tier."""
    return runs.where("status = 'completed'").groupBy("tier").agg(F.max(F.struct("started_at", "event_id", "duration")).alias("r")).select("tier", "r.*")


def schedule(runs: DataFrame, now: Column, every: dict[int, int] = EVERY) -> DataFrame:
    """(tier, last, due, next): due if never run or the period is over; the next run is never in the past."""
    tiers = runs.sparkSession.createDataFrame(list(every.items()), "tier int, hours int")
    rows = F.broadcast(tiers).join(last_run(runs).select("tier", F.col("started_at").alias("last")), "tier", "left")
    due = F.coalesce(F.unix_timestamp(now) - F.unix_timestamp("last") >= F.col("hours") * 3600, F.lit(True))
    at = F.timestamp_seconds(F.unix_timestamp("last") + F.col("hours") * 3600)
    return rows.select("tier", "last", due.alias("due"), F.greatest(F.coalesce(at, now), now).alias("next"))


def sync_summary(runs: DataFrame, since: Column, every: dict[int, int] = EVERY) -> DataFrame:
    """For each tier, those without runs included: runs, successes, failures, mean duration of the successes (0 if none)."""
    tiers = runs.sparkSession.createDataFrame([(t,) for t in every], "tier int")
    per = runs.where(F.col("started_at") >= since).groupBy("tier").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "completed").alias("ok"), F.count_if(F.col("status") == "failed").alias("bad"),
        F.avg(F.when(F.col("status") == "completed", F.col("duration"))).alias("mean"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return tiers.join(per, "tier", "left").select("tier", *[zero(c).alias(c) for c in ("n", "ok", "bad")], F.round(F.coalesce("mean", F.lit(0.0)), 4).alias("mean"))


def mean_present(c: str) -> Column:
    """Mean over values that are neither null nor 0; 0 if there is none."""
    return F.coalesce(F.avg(F.when(F.col(c) != 0, F.col(c))), F.lit(0.0))


def staleness_pct(status: str, seen: str, now: Column, days: int = 30) -> Column:
    active = F.col(status) == "active"
    return 100 * F.count_if(active & (F.col(seen) < F.date_sub(now, days))) / F.greatest(F.count_if(active), F.lit(1))


def stale(live: DataFrame, seen: str, now: Column, days: int, n: int, with_never: bool = True) -> DataFrame:
    """The ``n`` active rows unseen for longest; rows never seen come first, or not at all."""
    old = F.col(seen) < F.date_sub(now, days)
    rows = live.where(listed(live) & ((F.col(seen).isNull() | old) if with_never else old))
    return rows.orderBy(F.col(seen).asc_nulls_first(), "id").limit(n)


#: Hexadecimal digits by which a pass counts hashes, and rows of one range that are sorted at most.
HASH_DIGITS, SORTED = 4, 10_000


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """A simple random sample that reruns repeat: the ``n`` least MD5 values of the key.

    A small sample is a distributed top-k. For a larger one the n-th value is selected: hashes are counted by their first
    digits, 16**HASH_DIGITS numbers, then only those of the range that holds the n-th by the next digits, until it has up to SORTED
    rows. The sample is a filter by that value, without a sort. The key tells rows apart: of a larger sample, rows that
    share the last key are all taken. Rows without a key are taken last, or not at all.
    """
    if n <= SORTED:
        return rows.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
    h, prefix, left = F.md5(F.col(key).cast("string")), "", n
    while True:
        inside = rows.where(h.startswith(prefix)) if prefix else rows
        counts = sorted(inside.groupBy(F.substring(h, len(prefix) + 1, HASH_DIGITS).alias("d")).agg(F.count("*").alias("n")).where("d IS NOT NULL").collect())
        for digits, size in counts:
            if size >= left:
                break
            left -= size
        else:
            return rows
        prefix += digits
        if size <= SORTED or len(prefix) == 32:
            break
    if size > SORTED:
        return rows.where(h <= prefix)
    last = rows.where(h.startswith(prefix)).select(h.alias("h"), F.col(key).alias("k")).orderBy("h", "k").offset(left - 1).limit(1).first()
    return rows.where((h < last["h"]) | ((h == last["h"]) & (F.col(key) <= F.lit(last["k"]))))


def miss_streaks(seen: DataFrame) -> DataFrame:
    """(id, misses): sessions since each id was last seen. seen: (id, session, present)."""
    return seen.groupBy("id").agg(F.max("session").alias("latest"), F.coalesce(F.max(F.when(F.col("present"), F.col("session"))), F.lit(0)).alias("last")).select("id", (F.col("latest") - F.col("last")).alias("misses"))


def pending_sessions(sessions: DataFrame, synced: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    recent = sessions.where((F.col("status") == "completed") & (F.unix_timestamp(now) - F.unix_timestamp("ended_at") <= hours * 3600))
    return recent.join(synced.where("sync_status = 'completed'").select("session_id"), "session_id", "left_anti")


def latest(rows: DataFrame, by: str, n: int) -> DataFrame:
    return rows.orderBy(F.col(by).desc(), F.col(rows.columns[0]).desc()).limit(n)


def last_by(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key."""
    order = Window.partitionBy(key).orderBy(F.col(seq).desc())
    return rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


COUNTERS = ["new_properties", "price_changes", "removals", "scraped"]


def _counted(status: str = "status") -> list[Column]:
    return [F.count("*").alias("n"), F.count_if(F.col(status) == "completed").alias("ok"), F.count_if(F.col(status) == "failed").alias("bad")]


def sync_totals(runs: DataFrame, since: Column, every: dict[int, int] = EVERY) -> DataFrame:
    """The totals row (tier null) and a row for each tier: runs, successes, failures, sums of the counters, mean seconds.

    Null counters and durations count as 0, and so do tiers without runs; the mean is over all runs.
    """
    recent = runs.where(F.col("started_at") >= since)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    mean = F.coalesce(F.round(F.sum(F.coalesce("duration_ms", F.lit(0))) / F.nullif(F.count("*"), F.lit(0)) / 1000, 4), F.lit(0.0)).alias("seconds")
    tiers = runs.sparkSession.createDataFrame([(t,) for t in every], "tier int")
    per = F.broadcast(tiers).join(recent.groupBy("tier").agg(*_counted(), *sums, mean), "tier", "left").na.fill(0)
    return recent.agg(*_counted(), *sums, mean).withColumn("tier", F.lit(None).cast("int")).unionByName(per)


def recent_sync_summary(syncs: DataFrame, since: Column) -> DataFrame:
    """One row: syncs, successes, failures, sums, and means over values that are neither null nor 0."""
    sums = {"total_scraped": "processed", "new_properties": "new", "updated_properties": "updated", "removed_properties": "removed"}
    return syncs.where(F.col("created_at") >= since).agg(
        F.count("*").alias("n"), F.count_if(F.col("sync_status") == "completed").alias("ok"), F.count_if(F.col("sync_status") == "failed").alias("bad"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in sums.items()],
        F.round(mean_present("data_quality_score"), 4).alias("mean_score"), F.round(mean_present("sync_duration_ms"), 4).alias("mean_ms"),
    )


def request_summary(requests: DataFrame, user: Column) -> DataFrame:
    """(status, n, latest) of one user's requests, the status that changed last first."""
    per = requests.where(F.col("user_id") == user).groupBy("status").agg(F.count("*").alias("n"), F.max("status_updated_at").alias("latest"))
    return per.orderBy(F.col("latest").desc(), "status")


def scan_sources(sources: dict[str, DataFrame], operations: dict[str, str], only: list[str] | None = None) -> DataFrame:
    """The rows of all sources, or of those in ``only``, with the name and the operation type of their source."""
    out = None
    for name, rows in sources.items():
        if only is None or name in only:
            rows = rows.withColumn("source", F.lit(name)).withColumn("operation_type", F.lit(operations[name]))
            out = rows if out is None else out.unionByName(rows)
    return out


def source_stats(rows: DataFrame, inserted: DataFrame) -> DataFrame:
    """(source, pages, scraped, inserted): ``rows`` with source, page and id; ``inserted`` with the ids that were new."""
    marked = rows.join(inserted.select("id", F.lit(1).alias("new")).distinct(), "id", "left")
    return marked.groupBy("source").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("scraped"), F.count("new").alias("inserted"))


def price_buckets(rows: DataFrame, ranges: list[tuple[float, float]], price: str = "price", key: str = "id") -> DataFrame:
    """Rows within any of the ranges, both ends included, once for each key, with the first range that holds them (from 1)."""
    at = F.coalesce(*[F.when(F.col(price).between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(ranges, 1)])
    return rows.withColumn("bucket", at).where("bucket IS NOT NULL").dropDuplicates([key])


def batch_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("n"), F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("failed"))


def session_progress(sessions: DataFrame, errors: DataFrame, properties: DataFrame, most: int = 5) -> DataFrame:
    """One row for the latest session: progress, the page to go on from, pages left, its newest errors, counts of properties."""
    last = sessions.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(1)
    pages, done, total = F.coalesce("pages_scraped", F.lit(0)), F.coalesce("last_page", F.lit(0)), F.coalesce("total_pages", F.lit(100))
    resume = F.when(F.col("status").isin("running", "paused"), F.when(done > 0, done + 1).otherwise(pages + 1)).when(F.col("status") == "failed", F.greatest(F.lit(1), done))
    recent = (
        errors.join(F.broadcast(last.select(F.col("id").alias("session_id"))), "session_id", "left_semi").orderBy(F.col("created_at").desc(), "error_id").limit(most)
        .agg(F.array_sort(F.collect_list(F.struct("created_at", "error_id", "error_type"))).alias("errors"))
    )
    return last.select(
        "id", "status", F.when(pages > 0, F.round(pages / total * 100, 1)).alias("percent"), resume.alias("resume"), (total - pages).alias("left"),
        F.coalesce("inserted", F.lit(0)).alias("inserted"), F.coalesce("updated", F.lit(0)).alias("updated"),
    ).join(F.broadcast(recent)).join(F.broadcast(properties.agg(F.count("*").alias("properties"))))


def dashboard(syncs: DataFrame, sessions: DataFrame, live: DataFrame, since: Column, n: int = 10) -> dict[str, DataFrame]:
    """Summary, the last ``n`` sessions, the trend of quality and the number of active listings."""
    recent = sessions.where(F.col("created_at") >= since)
    return {
        "summary": recent_sync_summary(syncs, since),
        "sessions": recent.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n),
        "trend": syncs.where(F.col("created_at") >= since).select("created_at", "data_quality_score", "completeness_rate"),
        "active": live.where("status = 'active'").agg(F.count("*").alias("n")),
    }


def tier_rollup(runs: DataFrame, errors: DataFrame, most: int = 5) -> DataFrame:
    """Each run with its final status, the number of its errors and the first of them joined by '; '. errors: (run_id, at, message)."""
    per = errors.groupBy("run_id").agg(F.count("*").alias("error_count"), F.array_sort(F.collect_list(F.struct("at", "message"))).alias("e"))
    said = F.array_join(F.slice(F.transform("e", lambda x: x["message"]), 1, most), "; ")
    both = runs.join(per, "run_id", "left")
    return both.select(
        *runs.columns, F.when(F.col("error_count") > 0, "failed").otherwise("completed").alias("final"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"), said.alias("error_summary"),
    )


def sample_size(live: DataFrame, percent: float) -> DataFrame:
    """One row: how many active rows are ``percent`` of them, rounded down."""
    return live.where(listed(live)).agg(F.floor(F.count("*") * percent / 100).alias("n"))


def sample_percent(live: DataFrame, key: str, percent: float) -> DataFrame:
    """``percent`` of the active rows in the order of the MD5 of their key; the size is one number that is read first."""
    n = sample_size(live, percent).first()["n"]
    return hash_sample(live.where(listed(live)), key, int(n))


def cancel_run(runs: DataFrame, tier: int, now: Column) -> DataFrame:
    """The latest running run of a tier is cancelled; other rows stay."""
    last = runs.where((F.col("tier") == tier) & (F.col("status") == "running")).orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)
    rows = runs.join(F.broadcast(last.select("run_id", F.lit(True).alias("hit"))), "run_id", "left")
    return rows.select(
        *[c for c in runs.columns if c not in ("status", "completed_at", "error_summary")],
        F.when(F.col("hit"), "cancelled").otherwise(F.col("status")).alias("status"), F.when(F.col("hit"), now).otherwise(F.col("completed_at")).alias("completed_at"),
        F.when(F.col("hit"), "Cancelled by user request").otherwise(F.col("error_summary")).alias("error_summary"),
    )
