"""Accounts and their sessions: the generic shapes behind the application's functions, snapshots in, snapshots out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_logins(users: DataFrame, logins: DataFrame) -> DataFrame:
    """Users with their logins added and the last of them. users: (user_id, login_count, last_login); logins: (user_id, at)."""
    per = logins.groupBy("user_id").agg(F.count("*").alias("more"), F.max("at").alias("latest"))
    return users.join(per, "user_id", "left").select(
        *[c for c in users.columns if c not in ("login_count", "last_login")],
        (F.coalesce("login_count", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("login_count"), F.greatest("last_login", "latest").alias("last_login"),
    )


def valid_sessions(sessions: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Sessions that have not expired and whose user is active."""
    return sessions.where(F.col("expires_at") > now).join(users.where("is_active").select("user_id"), "user_id", "left_semi")


def drop_expired(sessions: DataFrame, now: Column) -> DataFrame:
    return sessions.where(F.col("expires_at").isNull() | (F.col("expires_at") >= now))


def with_defaults(users: DataFrame, rows: DataFrame, **defaults) -> DataFrame:
    """``rows`` and a row of defaults for each user that has none there."""
    missing = users.select("user_id").distinct().join(rows.select("user_id"), "user_id", "left_anti")
    return rows.unionByName(missing.select("user_id", *[F.lit(v).alias(k) for k, v in defaults.items()]).select(*rows.columns))


def upsert_profiles(profiles: DataFrame, told: DataFrame) -> DataFrame:
    """Profiles with what accounts told of themselves: the last event of an account overwrites its profile or opens one.

    profiles: (id, email, full_name, avatar_url, created_at, updated_at); told: (id, seq, email, full_name, avatar_url, at). Absent
    values are empty; a new profile is created at the account's first event.
    """
    fields = ["email", "full_name", "avatar_url"]
    last = told.groupBy("id").agg(F.max_by(F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in fields], "at"), "seq").alias("r"), F.min("at").alias("first_at"))
    rows = profiles.join(last, "id", "full")
    hit = F.col("r").isNotNull()
    return rows.select(
        "id", *[F.when(hit, F.col(f"r.{c}")).otherwise(F.col(c)).alias(c) for c in fields], F.coalesce("created_at", "first_at").alias("created_at"), F.when(hit, F.col("r.at")).otherwise(F.col("updated_at")).alias("updated_at"),
    )
