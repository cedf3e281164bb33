"""Incremental bronze -> silver as a stream: two drops, only new files processed."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from strata import registry as R
from strata.sources import bronze
from strata.sources.tables import VersionedTable
from strata.streaming.incremental import silver_micro_batch, start_bronze_to_silver


def _rows(spark, specs):
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in R.BRONZE_SCHEMA.fields])
    rows = []
    for lid, rent, day in specs:
        rec = {c: None for c in R.BRONZE_COLUMNS}
        rec.update(listing_id=lid, website="example", url=f"https://x/{lid}", title="t", description="d", street="s",
                   city="toronto", neighbourhood="Downtown", rent=rent, images=[], published_at=dt.datetime(2026, 3, 1),
                   scraped_at=dt.datetime(2026, 3, day))
        rows.append(tuple(rec[c] for c in R.BRONZE_COLUMNS))
    return spark.createDataFrame(rows, schema)


def test_stream_applies_new_drops(spark, scratch_dir):
    root = f"{scratch_dir}/bronze"
    listings = VersionedTable(spark, f"{scratch_dir}/silver/listings", R.LISTINGS, "rental_listings")
    hoods = VersionedTable(spark, f"{scratch_dir}/silver/hoods", R.NEIGHBOURHOODS, "neighbourhoods")
    schema = bronze.bronze_schema()
    ckpt = f"{scratch_dir}/stream-checkpoint"

    bronze.write_bronze(bronze.with_partition_columns(_rows(spark, [("1", 100.0, 1), ("2", 200.0, 1)]), source="example",
                                                      day="2026-03-01"), root)
    start_bronze_to_silver(spark, bronze_root=root, schema=schema, listings=listings, neighbourhoods=hoods,
                           checkpoint_location=ckpt).awaitTermination()
    assert listings.read().count() == 2

    bronze.write_bronze(bronze.with_partition_columns(_rows(spark, [("2", 250.0, 2), ("3", 300.0, 2)]), source="example",
                                                      day="2026-03-02"), root)
    start_bronze_to_silver(spark, bronze_root=root, schema=schema, listings=listings, neighbourhoods=hoods,
                           checkpoint_location=ckpt).awaitTermination()
    rows = {r.listing_id: r.rent for r in listings.read().collect()}
    assert rows == {"1": 100.0, "2": 250.0, "3": 300.0}
    assert hoods.read().count() == 1

    # a new checkpoint location is a new stream: its ids count from 0 again, nothing is skipped
    bronze.write_bronze(bronze.with_partition_columns(_rows(spark, [("4", 400.0, 3)]), source="example", day="2026-03-03"), root)
    start_bronze_to_silver(spark, bronze_root=root, schema=schema, listings=listings, neighbourhoods=hoods,
                           checkpoint_location=ckpt + "-new").awaitTermination()
    assert {r.listing_id: r.rent for r in listings.read().collect()} == {"1": 100.0, "2": 250.0, "3": 300.0, "4": 400.0}


def test_a_replayed_batch_is_applied_where_it_is_missing(spark, scratch_dir):
    listings = VersionedTable(spark, f"{scratch_dir}/silver/listings", R.LISTINGS, "rental_listings")
    hoods = VersionedTable(spark, f"{scratch_dir}/silver/hoods", R.NEIGHBOURHOODS, "neighbourhoods")
    batch = _rows(spark, [("1", 100.0, 1)])
    apply = silver_micro_batch(listings, hoods, stream="s")
    merge, hoods.merge = hoods.merge, lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        apply(batch, 0)
    assert listings.read().count() == 1 and hoods.read().count() == 0
    hoods.merge = merge
    version = listings.current_version()
    apply(batch, 0)
    assert hoods.read().count() == 1 and listings.current_version() == version  # the one that had it skips it
