"""Registry-derived schema and DDL (O6) and named sources."""

from __future__ import annotations

from strata import registry as R
from strata.sources.tables import Sources, VersionedTable


def test_registry_shape():
    assert len(R.LISTINGS) == 51 and len(R.NEIGHBOURHOODS) == 6 and len(R.BRONZE_COLUMNS) == 53
    assert R.key_columns(R.LISTINGS) == ["listing_id", "website"]
    assert R.hashed_columns(R.LISTINGS) == [
        "rent", "move_in_date", "bedrooms", "bathrooms", "furnished", "heat", "water", "hydro",
        "laundry_in_unit", "parking_included",
    ]
    assert len(R.columns_with(R.LISTINGS, R.CLEAN_BOOL)) == 26
    assert R.names(R.NEIGHBOURHOODS) == ["neighbourhood", "city", "walk_score", "transit_score", "bike_score"]


def test_ranges_and_roles_are_pinned():
    """What the oracle statements take from the registry, as literals."""
    ranges = {name: (b.low, b.high, b.exclusive) for name, b in R.bounded_columns(R.LISTINGS, R.NEIGHBOURHOODS).items()}
    assert ranges == {
        "rent": (0, None, True), "latitude": (41.0, 84.0, False), "longitude": (-142.0, -52.0, False), "parking_included": (0, None, False),
        "walk_score": (0, 10, False), "transit_score": (0, 10, False), "bike_score": (0, 10, False),
    }
    role = lambda registry, merge: [c.name for c in registry if c.merge == merge]
    assert role(R.LISTINGS, R.MERGE_ALWAYS) == ["row_hash", "scraped_at"] and role(R.NEIGHBOURHOODS, R.MERGE_MANAGED) == ["loaded_at"]
    assert role(R.LISTINGS, R.MERGE_KEY) == ["listing_id", "website"] and role(R.NEIGHBOURHOODS, R.MERGE_KEY) == ["neighbourhood", "city"]
    assert R.columns_with(R.LISTINGS, R.CLEAN_STRIP) == ["title", "description", "street", "neighbourhood"]
    assert R.columns_with(R.LISTINGS, R.CLEAN_LOWER) == [
        "city", "unit_type", "agreement_type", "for_rent_by", *[c for c in ("pet_friendly", "smoking_permitted") if c in R.columns_with(R.LISTINGS, R.CLEAN_LOWER)],
    ]


def test_schema_and_ddl(spark):
    schema = R.spark_schema(R.NEIGHBOURHOODS)
    assert [f.name for f in schema.fields][-1] == "loaded_at"
    assert schema["neighbourhood"].metadata["primary_key"] is True and not schema["neighbourhood"].nullable
    ddl = R.ddl(R.NEIGHBOURHOODS, "silver_neighbourhoods")
    assert "loaded_at TIMESTAMP NOT NULL DEFAULT now()" in ddl
    assert "'primary_key' = 'neighbourhood, city'" in ddl
    spark.sql("DROP TABLE IF EXISTS silver_neighbourhoods_ddl_test")
    spark.sql(R.ddl(R.NEIGHBOURHOODS, "silver_neighbourhoods_ddl_test"))  # as generated
    spark.sql("INSERT INTO silver_neighbourhoods_ddl_test (neighbourhood, city) VALUES ('a', 'b')")
    assert spark.table("silver_neighbourhoods_ddl_test").columns == R.names(R.NEIGHBOURHOODS, managed=True)
    assert spark.table("silver_neighbourhoods_ddl_test").first().loaded_at is not None
    spark.sql("DROP TABLE silver_neighbourhoods_ddl_test")


def test_named_sources(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, R.NEIGHBOURHOODS, "neighbourhoods")
    t.create()
    src = Sources()
    src.register("silver", "neighbourhoods", t)
    assert src.source("silver", "neighbourhoods").columns == R.names(R.NEIGHBOURHOODS, managed=True)
