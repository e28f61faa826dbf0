"""The refresh queue as a table: each transition takes a snapshot and gives the next one. One writer at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Priority of each reason; others have 3.
PRIORITY = {"new": 1, "price_change": 2, "relisted": 2, "verification": 3, "stale": 4, "sample": 5}


def priority_of(reason: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv]), reason), F.lit(3))


def resolve_urls(ids: DataFrame, manifest: DataFrame, live: DataFrame) -> DataFrame:
    """``ids`` with url: the manifest's address, even an empty one, else the live one; ids with neither or an empty one go."""
    m, v = manifest.select("property_id", F.col("url").alias("m")), live.select("property_id", F.col("url").alias("l"))
    return ids.join(m, "property_id", "left").join(v, "property_id", "left").select(*ids.columns, F.coalesce("m", "l").alias("url")).where("url <> ''")


def enqueue(queue: DataFrame, wanted: DataFrame, cap: int = 10_000, *more: str) -> DataFrame:
    """Rows to add: (property_id, reason, priority) and ``more`` columns of ``wanted``, without pending ones, one for each id; none
    if the backlog is at the cap."""
    pending = queue.where("status = 'pending'")
    room = F.broadcast(pending.agg(F.count("*").alias("n")).where(F.col("n") < cap))
    once = wanted.withColumn("priority", priority_of(F.col("reason"))).groupBy("property_id").agg(F.min(F.struct("priority", "reason", *more)).alias("w"))
    return once.join(pending.select("property_id"), "property_id", "left_anti").join(room, F.lit(True), "left_semi").select("property_id", "w.reason", "w.priority", *[f"w.{c}" for c in more])


def claim(queue: DataFrame, n: int, now: Column | None = None, worker: str | None = None) -> DataFrame:
    """The next ``n`` pending rows by priority, age and id, as in_progress with one attempt more: a distributed top-k. With a clock
    they also have claimed_at and claimed_by."""
    rows = queue.where("status = 'pending'").orderBy("priority", "queued_at", "id").limit(n).withColumn("status", F.lit("in_progress")).withColumn("attempts", F.col("attempts") + 1)
    return rows if now is None else rows.withColumns({"claimed_at": now, "claimed_by": F.lit(worker)})


def drain(queue: DataFrame, scraped: DataFrame, n: int, now: Column, worker: str = "drain") -> DataFrame:
    """The queue after its next ``n`` rows have been worked on at once: (columns, claimed_at, claimed_by, completed_at, last_error).

    scraped: (url, ...), what came back; a claimed address without it fails. Claims older than half an hour are released first.
    """
    free = release_stale(queue, now) if "claimed_at" in queue.columns else queue
    claimed = claim(free, n, now, worker).select("id", F.col("attempts").alias("tried"), F.lit(True).alias("hit"))
    got = scraped.select("url", F.lit(True).alias("got")).distinct()
    rows = free.join(claimed, "id", "left").join(got, "url", "left")
    hit, ok = F.col("hit").isNotNull(), F.col("got").isNotNull()
    own = lambda c: F.col(c) if c in queue.columns else F.lit(None)
    set_ = {
        "status": F.when(hit, F.when(ok, "completed").otherwise("failed")).otherwise(F.col("status")), "attempts": F.coalesce("tried", "attempts"),
        "claimed_at": F.when(hit, now).otherwise(own("claimed_at")), "claimed_by": F.when(hit, worker).otherwise(own("claimed_by")),
        "completed_at": F.when(hit, now).otherwise(own("completed_at")), "last_error": F.when(hit, F.when(~ok, "No data returned")).otherwise(own("last_error")),
    }
    return rows.select(*[c for c in queue.columns if c not in set_], *[v.alias(c) for c, v in set_.items()])


def finish(queue: DataFrame, results: DataFrame, now: Column | None = None) -> DataFrame:
    """Claimed rows become completed or failed, at ``now`` if it is given; errors keep 1000 characters. results: (id, ok, error); of
    several of an id a failure counts."""
    once = results.groupBy("id").agg(F.bool_and("ok").alias("ok"), F.max(F.when(~F.col("ok"), F.col("error"))).alias("error"))
    rows = queue.join(once, "id", "left")
    done = F.col("ok").isNotNull() & (F.col("status") == "in_progress")
    return rows.select(
        *[c for c in queue.columns if c not in ("status", "last_error")],
        F.when(done, F.when(F.col("ok"), "completed").otherwise("failed")).otherwise(F.col("status")).alias("status"),
        F.when(done & ~F.col("ok"), F.left("error", F.lit(1000))).alias("last_error"),
        *([] if now is None else [F.when(done, now).alias("completed_at")]),
    )


def _open_again(queue: DataFrame, hit: Column, fields: list[str], now: Column | None) -> DataFrame:
    """Rows that are pending again: without what ``fields`` said of the last try; a field that the queue lacks is left out."""
    hit = F.coalesce(hit, F.lit(False))
    cleared = {c: F.when(~hit, F.col(c)) for c in fields if c in queue.columns}
    touched = {} if now is None else {"updated_at": F.when(hit, now).otherwise(F.col("updated_at") if "updated_at" in queue.columns else F.lit(None))}
    return queue.withColumns({"status": F.when(hit, "pending").otherwise(F.col("status"))} | cleared | touched)


def release_stale(queue: DataFrame, now: Column, minutes: int = 30, at: str = "claimed_at") -> DataFrame:
    """Claims older than ``minutes`` are pending again and nobody's; attempts stay."""
    old = (F.col("status") == "in_progress") & (F.unix_timestamp(now) - F.unix_timestamp(at) > minutes * 60)
    return _open_again(queue, old, ["claimed_at", "claimed_by"], now)


def cancel(queue: DataFrame, reason: str) -> DataFrame:
    return queue.withColumn("status", F.when((F.col("status") == "pending") & (F.col("reason") == reason), "cancelled").otherwise(F.col("status")))


def retry(queue: DataFrame, most: int = 3, limit: int | None = None, now: Column | None = None) -> DataFrame:
    """Failed rows with fewer than ``most`` attempts are pending again, without claim, end and error; the oldest ``limit`` of them if
    it is given."""
    again, fields = (F.col("status") == "failed") & (F.col("attempts") < most), ["claimed_at", "claimed_by", "completed_at", "last_error"]
    if limit is None:
        return _open_again(queue, again, fields, now)
    some = queue.where(again).orderBy("queued_at", "id").limit(limit).select("id", F.lit(True).alias("_again"))
    return _open_again(queue.join(some, "id", "left"), F.col("_again"), fields, now).drop("_again")


def cleanup(queue: DataFrame, now: Column, days: int = 7, at: str = "completed_at") -> DataFrame:
    """Without completed and cancelled rows that ended more than ``days`` ago; those without an end and failed ones stay."""
    return queue.where(F.coalesce(~(F.col("status").isin("completed", "cancelled") & (F.col(at) < F.date_sub(now, days))), F.lit(True)))


def stats(queue: DataFrame) -> DataFrame:
    """One row: counts by status, and of the pending rows maps by priority and by reason as sorted arrays of entries."""
    per = queue.groupBy("status", "priority", "reason").agg(F.count("*").alias("n"))
    by = lambda c: per.where("status = 'pending'").groupBy(c).agg(F.sum("n").alias("n")).agg(F.array_sort(F.collect_list(F.struct(c, "n"))).alias(f"by_{c}"))
    total = per.agg(*[F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("pending", "in_progress", "completed", "failed")])
    return total.join(by("priority")).join(by("reason"))
