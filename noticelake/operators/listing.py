"""The marketplace read model: vehicles, and lots that hold no vehicle, with their context.

``tables`` is a dict of frames: vehicles, lots, events, cases, records, sources,
organizations, brands, models, photos, identifiers. Small dimensions are joined plainly:
Catalyst broadcasts them by measured size and AQE falls back to a shuffle beyond it.
Joins on lots are inner or anti joins with the many side on the left, the shapes AQE can
split when one lot holds a large share of the vehicles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import county
from .dedupe import top_per_key

c = F.col

CONTEXT = [
    "lot_id", "lot_title", "lot_size", "bulk_lot", "eligibility", "storage_location", "fee_notes", "lot_vehicle_type",
    "lot_vehicle_category", "lot_car_category", "lot_registration_status", "lot_has_key", "lot_can_start", "lot_can_test",
    "lot_condition_summary", "lot_completeness", "source_id", "source_name", "source_family", "source_adapter",
    "source_record_id", "source_auid", "official_url", "official_title", "organization_name", "disposal_origin",
    "auction_status", "round_number", "auction_at", "reserve_price", "current_price", "sold_price", "deposit",
    "payment_deadline", "pickup_deadline",
]

LISTING_COLUMNS = [
    "id", "vehicle_id", "listing_entity", "source_id", "source_name", "source_family", "source_adapter",
    "source_record_id", "source_auid", "official_url", "official_title", "model_name", "brand_name",
    "manufacture_year", "manufacture_month", "displacement_cc", "vehicle_type", "vehicle_category", "car_category",
    "color", "mileage_km", "organization_name", "storage_location", "disposal_origin", "auction_status",
    "round_number", "auction_at", "reserve_price", "current_price", "sold_price", "deposit", "payment_deadline",
    "pickup_deadline", "fee_notes", "eligibility", "registration_status", "has_key", "can_start", "can_test",
    "lot_size", "bulk_lot", "condition_summary", "completeness", "primary_image_url", "plate_number", "county",
    "display_price", "has_cached_photo", "search_text",
]


def lot_context(t: dict[str, DataFrame]) -> DataFrame:
    """Every lot with its event, case, record, source and organization."""
    lots = t["lots"].select(
        c("id").alias("lot_id"), "event_id", c("title").alias("lot_title"), "lot_size", "bulk_lot", "eligibility",
        "storage_location", "fee_notes", *[c(n).alias(f"lot_{n}") for n in (
            "vehicle_type", "vehicle_category", "car_category", "registration_status", "has_key", "can_start", "can_test",
            "condition_summary", "completeness")],
    )
    events = t["events"].select(
        c("id").alias("event_id"), "case_id", "record_id", c("status").alias("auction_status"), "round_number",
        c("ends_at").alias("auction_at"), "reserve_price", "current_price", "sold_price", "deposit", "payment_deadline",
        "pickup_deadline",
    )
    cases = t["cases"].select(c("id").alias("case_id"), "organization_id", "disposal_origin")
    records = t["records"].select(
        c("id").alias("record_id"), "source_id", c("source_record_id").alias("source_auid"), "official_url",
        c("original_title").alias("official_title"),
    )
    sources = t["sources"].select(
        c("id").alias("source_id"), c("name").alias("source_name"), c("family").alias("source_family"),
        c("adapter_name").alias("source_adapter"),
    )
    organizations = t["organizations"].select(
        c("id").alias("organization_id"), c("canonical_name").alias("organization_name"))
    return (
        lots.join(events, "event_id").join(cases, "case_id").join(records, "record_id").join(sources, "source_id")
        .join(organizations, "organization_id", "left")
        .withColumn("source_record_id", c("record_id"))
        .select(*CONTEXT)
    )


def first_photos(photos: DataFrame, owner: str) -> DataFrame:
    """First cached photo of each vehicle or lot by (sort_order, id)."""
    cached = photos.filter(c("storage_path").isNotNull() & c(owner).isNotNull())
    first = top_per_key(cached.select(owner, "sort_order", "id", "source_url"), [owner], [c("sort_order"), c("id")])
    return first.select(c(owner).alias("owner_id"), c("source_url").alias("primary_image_url"))


def first_plates(identifiers: DataFrame) -> DataFrame:
    plates = identifiers.filter(c("identifier_type") == "PLATE").select("vehicle_id", "id", "normalized_value")
    first = top_per_key(plates, ["vehicle_id"], [c("id")])
    return first.select("vehicle_id", c("normalized_value").alias("plate_number"))


def _shared_columns() -> dict[str, Column]:
    return {
        "county": county(F.concat_ws(" ", "storage_location", "organization_name")),
        "display_price": display_price(),
        "has_cached_photo": c("primary_image_url").isNotNull(),
    }


def display_price() -> Column:
    return F.coalesce(c("sold_price"), c("current_price"), c("reserve_price"))


def vehicle_rows(t: dict[str, DataFrame], context: DataFrame) -> DataFrame:
    vehicles = t["vehicles"].withColumnRenamed("id", "vehicle_id")
    brands = t["brands"].select(c("id").alias("brand_id"), c("canonical_name").alias("brand_canonical"))
    models = t["models"].select(c("id").alias("model_id"), c("canonical_name").alias("model_canonical"))
    photos = first_photos(t["photos"], "vehicle_id").withColumnRenamed("owner_id", "vehicle_id")
    # the wide context comes last, so that it moves once per lot and not with each vehicle to its model, photos and plates
    joined = (
        vehicles.join(brands, "brand_id", "left").join(models, "model_id", "left")
        .join(photos, "vehicle_id", "left").join(first_plates(t["identifiers"]), "vehicle_id", "left")
        .join(context, "lot_id")
    )
    named = joined.withColumns({
        "id": c("vehicle_id"),
        "listing_entity": F.lit("vehicle"),
        "model_name": F.coalesce(c("model_canonical"), c("original_model"), c("lot_title")),
        "brand_name": F.coalesce(c("brand_canonical"), c("original_brand")),
        **_shared_columns(),
    })
    search = F.lower(F.concat_ws(
        " ", "official_title", "brand_name", "model_name", "plate_number", "organization_name", "storage_location",
        "source_auid", "vehicle_type", "vehicle_category", "car_category"))
    return named.withColumn("search_text", search).select(*LISTING_COLUMNS)


def lot_rows(t: dict[str, DataFrame]) -> DataFrame:
    """Lots without vehicles; they are told apart before their context is joined, so only theirs moves."""
    occupied = t["vehicles"].select(c("lot_id").alias("id")).distinct()
    photos = first_photos(t["photos"], "lot_id").withColumnRenamed("owner_id", "lot_id")
    empty = lot_context({**t, "lots": t["lots"].join(occupied, "id", "left_anti")}).join(photos, "lot_id", "left")
    vehicle_types = dict(t["vehicles"].dtypes)
    typed_nulls = {
        n: F.lit(None).cast(vehicle_types.get(n, "string"))
        for n in ("manufacture_year", "manufacture_month", "displacement_cc", "color", "mileage_km")
    }
    shaped = empty.withColumns({
        "id": c("lot_id"),
        "vehicle_id": F.lit(None).cast(vehicle_types["id"]),
        "listing_entity": F.lit("lot"),
        "model_name": c("lot_title"),
        "brand_name": F.lit(None).cast("string"),
        "plate_number": F.lit(None).cast("string"),
        **typed_nulls,
        **{n: c(f"lot_{n}") for n in (
            "vehicle_type", "vehicle_category", "car_category", "registration_status", "has_key", "can_start", "can_test",
            "condition_summary", "completeness")},
        **_shared_columns(),
    })
    search = F.lower(F.concat_ws(
        " ", "official_title", "lot_title", "organization_name", "storage_location", "source_auid", "vehicle_type",
        "vehicle_category", "car_category"))
    return shaped.withColumn("search_text", search).select(*LISTING_COLUMNS)


def listing_view(t: dict[str, DataFrame]) -> DataFrame:
    """All marketplace rows: one per vehicle, and one per lot without vehicles."""
    return vehicle_rows(t, lot_context(t)).unionByName(lot_rows(t))


def first_version_view(t: dict[str, DataFrame]) -> DataFrame:
    """The earlier one-row-per-vehicle view: no lots, first photo cached or not."""
    photos = t["photos"].withColumn("storage_path", F.coalesce("storage_path", F.lit("-")))
    rows = vehicle_rows({**t, "photos": photos}, lot_context(t))
    dropped = [
        "vehicle_id", "listing_entity", "source_id", "source_name", "source_family", "source_adapter", "manufacture_month",
        "vehicle_type", "vehicle_category", "car_category", "county", "display_price", "has_cached_photo", "search_text",
    ]
    return rows.drop(*dropped)


def materialize(listing: DataFrame, path: str) -> None:
    """Write the read model for scanning: folders per vehicle type, files sorted by deadline.

    Rows are range-partitioned on (type, deadline, id), so a type holding most rows is
    spread over many files and deadline filters skip row groups.
    """
    (
        listing.repartitionByRange("vehicle_type", "auction_at", "id").sortWithinPartitions("vehicle_type", "auction_at", "id")
        .write.mode("overwrite").partitionBy("vehicle_type").parquet(path)
    )


# --- photos, documents and prices of a listing ----------------------------------------
def listing_photos(photos: DataFrame) -> DataFrame:
    """Distinct stored photos per listing in display order, one row each."""
    owner = F.coalesce(c("vehicle_id"), c("lot_id"))
    entity = F.when(c("vehicle_id").isNotNull(), "vehicle").otherwise("lot")
    return (
        photos.filter(c("storage_path").isNotNull() & owner.isNotNull())
        .groupBy(owner.alias("listing_id"), entity.alias("listing_entity"), c("storage_path").alias("photo_path"))
        .agg(F.min("sort_order").alias("sort_order"))
    )


def document_links(documents: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Documents always link to the publisher; ``cached`` tells whether a private copy exists."""
    stored = artifacts.select(c("id").alias("artifact_id"), "storage_path")
    return documents.join(stored, "artifact_id", "left").select(
        "id", "record_id", "title", "document_type", c("official_url").alias("url"),
        c("storage_path").isNotNull().alias("cached"),
    )


def price_history(observations: DataFrame, payload: str = "payload") -> DataFrame:
    """Observed price points with the scale of their chart, one row per observation.

    Points stay rows; only one maximum per vehicle is aggregated (map-side first) and
    joined back, a join AQE splits when one vehicle was observed very often.
    """
    def number(name: str) -> Column:
        return F.get_json_object(c(payload), f"$.{name}").try_cast("decimal(14,2)")

    points = observations.select(
        "vehicle_id", "observed_at",
        F.get_json_object(c(payload), "$.auction_round").try_cast("int").alias("round"),
        number("reserve_price").alias("reserve_price"), number("current_price").alias("current_price"),
        number("sold_price").alias("sold_price"),
        F.coalesce(F.get_json_object(c(payload), "$.status"), F.lit("UNKNOWN")).alias("status"),
    ).withColumn("point", F.coalesce("current_price", "reserve_price", F.lit(0).cast("decimal(14,2)")))
    scale = points.groupBy("vehicle_id").agg(F.greatest(F.max("point"), F.lit(1).cast("decimal(14,2)")).alias("scale"))
    return points.join(scale, "vehicle_id")


def listing_detail(t: dict[str, DataFrame], ids: DataFrame) -> DataFrame:
    """Everything shown with a set of listings, as rows (listing_id, section, entry_id, entry).

    ``ids`` has ``id`` and ``listing_entity``. Sections: evidence, history, photo,
    duplicate, document. The two sides of a duplicate pair are two equi joins.
    """
    wanted = ids.select(c("id").alias("listing_id"), "listing_entity").distinct()

    def section(df: DataFrame, name: str, entry_id: Column, entry: Column) -> DataFrame:
        return df.select("listing_id", F.lit(name).alias("section"), entry_id.cast("string").alias("entry_id"),
                         F.to_json(entry).alias("entry"))

    evidence = t["evidence"].join(
        wanted, (c("entity_type") == c("listing_entity")) & (c("entity_id") == c("listing_id"))
    ).join(t["records"].select(c("id").alias("record_id"), "official_url"), "record_id")
    vehicles = wanted.filter(c("listing_entity") == "vehicle")
    history = t["observations"].join(vehicles, c("vehicle_id") == c("listing_id"))
    photos = listing_photos(t["photos"]).join(wanted, ["listing_id", "listing_entity"])
    pairs = t["duplicates"]
    sides = pairs.withColumns({"own": c("left_id"), "other": c("right_id")}).unionByName(
        pairs.withColumns({"own": c("right_id"), "other": c("left_id")}))
    duplicates = sides.join(vehicles, c("own") == c("listing_id"))
    documents = document_links(t["documents"], t["artifacts"]).join(
        ids.select(c("id").alias("listing_id"), c("source_record_id").alias("record_id")), "record_id")
    return (
        section(evidence, "evidence", c("id"), F.struct("field_name", "source_text", "official_url", "trust", "confidence"))
        .unionByName(section(history, "history", c("observed_at"), F.struct("observed_at", "payload")))
        .unionByName(section(photos, "photo", c("sort_order"), F.struct("photo_path", "sort_order")))
        .unionByName(section(duplicates, "duplicate", c("other"), F.struct("other", "score", "review_status")))
        .unionByName(section(documents, "document", c("id"), F.struct("title", "url", "cached")))
    )
