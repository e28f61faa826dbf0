"""Rules and scores of data quality; rules become column expressions, scores one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import populated

# Weights of the completeness of a staged row and of a live record (the latter clamped to 1).
COMPLETENESS = {
    "title": 0.2, "price": 0.2, "property_type": 0.1, "operation_type": 0.1, "city": 0.1, "address": 0.1, "bedrooms": 0.05,
    "bathrooms": 0.05, "main_image_url": 0.1,
}
RECORD = {
    "title": 0.15, "description": 0.10, "price": 0.20, "property_type": 0.10, "operation_type": 0.05, "bedrooms": 0.05,
    "bathrooms": 0.05, "address": 0.10, "city": 0.05, "latitude": 0.05, "longitude": 0.05, "main_image_url": 0.05,
    "agent_name": 0.03, "agent_phone": 0.02,
}


@dataclass(frozen=True)
class Rule:
    name: str
    field: str
    kind: str  # required, range, pattern or custom
    severity: str
    low: float | None = None
    high: float | None = None
    regex: str | None = None


# The default rules.
DEFAULT_RULES = [
    Rule("required_title", "title", "required", "error"),
    Rule("price_range", "price", "range", "warning", 1000, 50_000_000),
    Rule("bedrooms_range", "bedrooms", "range", "warning", 0, 20),
    Rule("bathrooms_range", "bathrooms", "range", "warning", 0, 10),
    Rule("valid_email", "agent_email", "pattern", "warning", regex=r"^[^@]+@[^@]+\.[^@]+$"),
    Rule("valid_latitude", "latitude", "range", "warning", -90, 90),
    Rule("valid_longitude", "longitude", "range", "warning", -180, 180),
]


def load_rules(table: DataFrame | None) -> list[Rule]:
    """The active rules of a table (rule_name, field_name, rule_type, rule_config as JSON, severity, is_active), or the default
    ones if there is no table or it lacks one of these columns. The table has a row for each rule, so it is read whole."""
    names = ["rule_name", "field_name", "rule_type", "severity"]
    if table is None or not {*names, "rule_config", "is_active"} <= set(table.columns):
        return DEFAULT_RULES
    said = F.from_json("rule_config", "min double, max double, regex string")
    rows = table.where("is_active").select(*names, said.alias("c")).orderBy("rule_name").collect()
    return [Rule(*[r[n] for n in names], *(r.c or (None,) * 3)) for r in rows]


# Fixed value: what an image address must look like.
URL_PATTERN = r"^https?://[^\s/$.?#].[^\s]*$"


def valid_rows(rows: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """Rows without a problem of severity error."""
    return rows.join(found.where("severity = 'error'").select(key), key, "left_anti")


def has_error(columns: list[str], rules: list[Rule] = DEFAULT_RULES, custom: dict | None = None) -> Column:
    """Whether a row breaks a rule of severity error."""
    out = F.lit(False)
    for r in rules:
        if r.severity == "error" and r.field in columns:
            out = out | rule_message(r, F.col(r.field), custom).isNotNull()
    return out


def report(rows: DataFrame, found: DataFrame, checks: DataFrame, rules: list[Rule] = DEFAULT_RULES, custom: dict | None = None) -> DataFrame:
    """One row: totals, scores, problems by severity and by field, scores by field, the checks and recommendations.

    ``checks``: one row with duplicate_rate and freshness; ``rules`` and ``custom`` as in ``errors``. A row is invalid by itself, whether
    or not others have its key. The rows are read once, the problems once: all else comes from one row of counts and an array with an
    entry for each severity and field.
    """
    zero, columns = F.lit(0).cast("long"), rows.columns
    one = rows.agg(F.count("*").alias("n"), F.count_if(has_error(columns, rules, custom)).alias("invalid"), F.avg(completeness(columns)).alias("c"), *[F.count_if(populated(F.col(c))).alias(f"there_{i}") for i, c in enumerate(columns)])
    broken = found.groupBy("severity", "field").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("severity", "field", "n")).alias("broken"))
    for t in (broken, checks):
        one = one.join(F.broadcast(t))
    of = lambda hit: F.aggregate(F.filter("broken", hit), zero, lambda s, x: s + x["n"])
    by = lambda c: F.array_sort(F.transform(F.array_distinct(F.transform("broken", lambda x: x[c])), lambda v: F.struct(v.alias(c), of(lambda x: x[c] == v).alias("n")))).alias(f"by_{c}")
    errors_, warnings = of(lambda x: x["severity"] == "error"), of(lambda x: x["severity"] == "warning")
    n = F.nullif(F.col("n"), F.lit(0))
    bad = lambda c: of(lambda x: (x["severity"] == "error") & (x["field"] == c))
    shares = [(c, (F.col(f"there_{i}") - bad(c)) / n) for i, c in sorted(enumerate(columns), key=lambda x: x[1])]
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.round(F.coalesce(F.greatest(F.lit(0.0), x), F.lit(1.0)), 4).alias("score")) for c, x in shares])
    one = one.select("n", "invalid", score_of(F.col("c"), errors_ / n, warnings / n).alias("score"), F.coalesce("c", F.lit(0.0)).alias("completeness"), by("severity"), by("field"), fields.alias("fields"), errors_.alias("errors"), *checks.columns)
    advice = recommendations(F.col("score"), F.col("completeness"), F.coalesce(F.col("errors") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)), F.col("duplicate_rate"), F.col("freshness"), F.col("fields"))
    return one.select("n", (F.col("n") - F.col("invalid")).alias("valid"), "invalid", "score", "completeness", "by_severity", "by_field", "fields", *checks.columns, advice.alias("recommendations"))


def rule_message(rule: Rule, value: Column, custom: dict | None = None) -> Column:
    """What is wrong with a value, or null."""
    if rule.kind == "required":
        return F.when(~populated(value), f"{rule.field} is required")
    if rule.kind == "range":
        number = value.cast("string").try_cast("double")
        out = F.when(value.isNull(), None).when(number.isNull(), f"{rule.field} is not a valid number")
        if rule.low is not None:
            out = out.when(number < rule.low, f"{rule.field} is below minimum")
        return out.when(number > rule.high, f"{rule.field} is above maximum") if rule.high is not None else out
    if rule.kind == "pattern":
        # the pattern is anchored at its start only
        return F.when(populated(value) & ~value.cast("string").rlike(f"^(?:{rule.regex})"), f"{rule.field} has a wrong format")
    return (custom or {}).get(rule.name, lambda v: F.lit(None).cast("string"))(value)


def errors(rows: DataFrame, key: str, rules: list[Rule] = DEFAULT_RULES, custom: dict | None = None) -> DataFrame:
    """One row for each broken rule: key, field, rule, message, severity, value. Rules for absent columns are skipped."""
    found = [
        F.when(
            (m := rule_message(r, F.col(r.field), custom)).isNotNull(),
            F.struct(F.lit(r.field).alias("field"), F.lit(r.name).alias("rule"), m.alias("message"), F.lit(r.severity).alias("severity"), F.col(r.field).cast("string").alias("value")),
        )
        for r in rules
        if r.field in rows.columns
    ]
    return rows.select(key, F.explode(F.array_compact(F.array(*found))).alias("e")).select(key, "e.*")


def gps_problem(gps: Column, lat: Column, lng: Column) -> Column:
    parts = F.split(gps, ",")
    x, y = (F.try_element_at(parts, F.lit(i)).try_cast("double") for i in (1, 2))
    return F.when(
        gps.isNotNull() & lat.isNotNull() & lng.isNotNull() & (F.size(parts) == 2),
        F.when(x.isNull() | y.isNull(), "coordinate_format").when((F.abs(x - lat) > 0.001) | (F.abs(y - lng) > 0.001), "coordinate_consistency"),
    )


def price_problem(price: Column, per_m2: Column, area: Column) -> Column:
    usable = (F.coalesce(price, F.lit(0.0)) != 0) & (F.coalesce(per_m2, F.lit(0.0)) != 0) & (F.coalesce(area, F.lit(0.0)) != 0)
    return F.when(usable & (F.abs(price - per_m2 * area) / F.nullif(price, F.lit(0.0)) > 0.2), "price_consistency")


def bad_urls(rows: DataFrame, key: str, urls: str) -> DataFrame:
    """(key, at, url) of elements that are no http address."""
    return rows.select(key, F.posexplode(urls).alias("at", "url")).where(~F.coalesce(F.col("url").rlike(URL_PATTERN), F.lit(False)))


def completeness(columns: list[str], weights: dict[str, float] = COMPLETENESS) -> Column:
    out = F.lit(0.0)
    for f, w in weights.items():
        if f in columns:
            out = out + F.when(populated(F.col(f)), w).otherwise(0.0)
    return F.least(F.lit(1.0), out)


def field_scores(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(field, score): populated share less the share of errors, 0 at least; one pass for all columns."""
    n = F.count("*")
    counts = rows.agg(n.alias("n"), *[F.count_if(populated(F.col(c))).alias(c) for c in rows.columns])
    long = counts.unpivot("n", rows.columns, "field", "populated")
    bad = found.where("severity = 'error'").groupBy("field").agg(F.count("*").alias("bad"))
    share = (F.col("populated") - F.coalesce("bad", F.lit(0))) / F.nullif(F.col("n"), F.lit(0))
    return long.join(F.broadcast(bad), "field", "left").select("field", F.coalesce(F.greatest(F.lit(0.0), share), F.lit(1.0)).alias("score"))


def score_of(complete: Column, errors: Column, warnings: Column) -> Column:
    """The overall score of completeness and the shares of errors and warnings; 1 where there are no rows."""
    score = 0.4 * complete + 0.4 * F.greatest(F.lit(0.0), 1 - errors) + 0.2 * F.greatest(F.lit(0.0), 1 - 0.5 * warnings)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), F.lit(1.0))


def overall_score(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row: overall score of completeness, errors and warnings; 1 for no rows."""
    a = rows.agg(F.count("*").alias("n"), F.avg(completeness(rows.columns)).alias("c"))
    b = found.agg(F.count_if(F.col("severity") == "error").alias("e"), F.count_if(F.col("severity") == "warning").alias("w"))
    n = F.nullif(F.col("n"), F.lit(0))
    return a.join(F.broadcast(b)).select(score_of(F.col("c"), F.col("e") / n, F.col("w") / n).alias("score"), "n", F.col("e").alias("errors"), F.col("w").alias("warnings"))


def duplicate_rate(key: str) -> Column:
    return F.coalesce((F.count("*") - F.count_distinct(F.col(key))) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0))


def freshness(at: str, now: Column, hours: int = 24) -> Column:
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col(at))
    return F.coalesce(F.avg(F.when(age <= hours * 3600, 1.0).otherwise(0.0)), F.lit(0.0))


def geo_diversity(city: str, hood: str, lat: str, lng: str) -> Column:
    named = lambda c: F.count_distinct(F.nullif(F.col(c), F.lit("")))
    both = (F.coalesce(lat, F.lit(0.0)) != 0) & (F.coalesce(lng, F.lit(0.0)) != 0)
    at = lambda f, c: f(F.when(both, F.col(c)))
    spread = F.when(F.count_if(both) < 2, 0.8).otherwise(F.least(F.lit(1.0), (at(F.max, lat) - at(F.min, lat) + at(F.max, lng) - at(F.min, lng)) / 2))
    return 0.4 * F.least(F.lit(1.0), named(city) / 10) + 0.4 * F.least(F.lit(1.0), named(hood) / 50) + 0.2 * spread


def overall_quality(score: Column, duplicates: Column, fresh: Column, diversity: Column) -> tuple[Column, Column]:
    """(overall quality, whether all thresholds are met)."""
    return 0.4 * score + 0.2 * (1 - duplicates) + 0.2 * fresh + 0.2 * diversity, (score >= 0.7) & (duplicates <= 0.02) & (fresh >= 0.8)


def recommendations(score: Column, complete: Column, error_share: Column, duplicates: Column, fresh: Column, fields: Column | None = None) -> Column:
    """``fields``: an array of (field, score); each below a half has a message of its own."""
    low = F.array().cast("array<string>") if fields is None else F.transform(F.filter(fields, lambda x: x["score"] < 0.5), lambda x: F.concat(F.lit("Field "), x["field"], F.lit(" has a low score.")))
    return F.concat(low, F.array_compact(
        F.array(
            F.when(score < 0.7, "Overall quality is low: review the extraction."),
            F.when(complete < 0.8, "Completeness is low: check that required fields are extracted."),
            F.when(error_share > 0.1, "Many critical errors: review the rules."),
            F.when(duplicates > 0.02, "Many duplicates: review the identity of rows."),
            F.when(fresh < 0.8, "Data is stale: refresh more often."),
        )
    ))
