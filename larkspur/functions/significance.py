"""Which differences between two snapshots count, and how sure they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import positional_similarity, strip

# Confidence of a change of each class.
CONFIDENCE = {
    "price_change": 0.9, "title_change": 0.8, "description_change": 0.6, "image_change": 0.7, "contact_change": 0.85,
    "status_change": 0.95, "location_change": 0.9, "amenities_change": 0.7, "features_change": 0.7,
}

# Monitored fields with their classes.
MONITORED = {
    "title": "title_change", "description": "description_change", "price": "price_change", "price_per_m2": "price_change",
    "bedrooms": "status_change", "bathrooms": "status_change", "total_area_m2": "status_change", "agent_name": "contact_change",
    "agent_phone": "contact_change", "agent_email": "contact_change", "agency_name": "contact_change",
    "main_image_url": "image_change", "image_urls": "image_change", "address": "location_change", "latitude": "location_change",
    "longitude": "location_change", "amenities": "amenities_change", "features": "features_change", "status": "status_change",
}

RELATIVE, NEAR, EXACT = {"price", "price_per_m2"}, {"latitude", "longitude"}, {"image_urls", "amenities", "features"}


def canonical(c: Column, kind: str = "") -> Column:
    """A value that equal nested values share: maps as sorted entries, JSON text with sorted keys, arrays as they are."""
    if kind.startswith("map"):
        return F.to_json(F.array_sort(F.map_entries(c)))
    if kind == "string":
        return F.coalesce(F.to_json(F.try_parse_json(c)), c)
    return F.to_json(c)


def differs(field: str, new: Column, old: Column, kind: str = "") -> Column:
    """Whether a field has changed by more than its tolerance; exactly one null is a change.

    Numbers that can't be read are compared as text. ``kind``: the type of a nested field, as ``dtypes`` gives it.
    """
    if field in RELATIVE | NEAR:
        a, b = (x.cast("string").try_cast("double") for x in (new, old))
        apart = F.abs(a - b) > 1e-4
        if field in RELATIVE:
            apart = F.when(b == 0, a != 0).otherwise(F.abs(a - b) / F.nullif(b, F.lit(0.0)) > 0.01)
        changed = F.when(a.isNull() | b.isNull(), new.cast("string") != old.cast("string")).otherwise(apart)
    elif field in EXACT:
        changed = canonical(new, kind) != canonical(old, kind)
    else:
        changed = strip(new.cast("string")) != strip(old.cast("string"))
    return F.when(new.isNull() & old.isNull(), False).when(new.isNull() | old.isNull(), True).otherwise(changed)


def confidence(field: str, new: Column, old: Column) -> Column:
    """How sure a change is: by its class, fields without one count as status; more for a price that moves by over a tenth."""
    base = CONFIDENCE[MONITORED.get(field, "status_change")]
    if field == "price":
        a, b = (x.cast("string").try_cast("double") for x in (new, old))
        return F.when((b != 0) & (F.abs(a - b) / F.nullif(b, F.lit(0.0)) > 0.1), min(0.95, base + 0.1)).otherwise(base)
    if field in {"title", "description"}:
        return F.when(new.isNotNull() & old.isNotNull() & (positional_similarity(new, old) > 0.9), round(base * 0.7, 4)).otherwise(base)
    return F.lit(base)


def flags_price(old: Column, new: Column, percent: float = 1.0, amount: float = 1000.0) -> Column:
    """Whether a price move is worth a refresh: any move from or to nothing, else beyond the amount or the percentage."""
    return F.when((old <= 0) | (new <= 0), old != new).otherwise((F.abs(new - old) > amount) | (F.abs(new - old) / F.nullif(old, F.lit(0.0)) * 100 > percent))
