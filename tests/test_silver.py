"""Bronze -> silver transform (O11-O21) on a minimal bronze row and its variations."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from strata import registry as R
from strata.operators import silver

BASE = {
    "listing_id": "mill-8",
    "url": "https://www.example.com/v/mill-8",
    "website": "example",
    "published_at": dt.datetime(2026, 2, 3, 4, 5),
    "title": "\u2003Loft \t",
    "description": "faces the yard",
    "street": "8 Mill Lane\n",
    "city": " ToronTO",
    "neighbourhood": "Mill Quarter",
    "rent": 1875.0,
    "bedrooms": 5,
    "bathrooms": 3,
    "size_sqft": 1040.0,
    "unit_type": "LOFT",
    "furnished": "no",
    "heat": " included ",
    "water": "NOT INCLUDED",
    "parking_included": "2",
    "walk_score": 3.5,
    "transit_score": 0.0,
    "bike_score": 10.0,
    "images": ["https://pictures.example.org/a.png"],
    "scraped_at": dt.datetime(2026, 2, 4),
}


def bronze(spark, *changes):
    rows = []
    for ch in changes or ({},):
        row = dict(BASE)
        row.update(ch)
        rows.append(tuple(row.get(c) for c in R.BRONZE_COLUMNS))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in R.BRONZE_SCHEMA.fields])
    return spark.createDataFrame(rows, schema)


def row_of(spark, **change):
    return silver.transform_to_silver(bronze(spark, change)).listings.first()


def test_base_row(spark):
    out = silver.transform_to_silver(bronze(spark))
    row = out.listings.first()
    assert (row.title, row.street, row.city, row.unit_type) == ("Loft", "8 Mill Lane", "toronto", "loft")
    assert (row.furnished, row.heat, row.water, row.parking_included) == (False, True, False, 2)
    assert row.images == BASE["images"] and out.neighbourhoods.count() == 1


def test_blank_keys_go(spark):
    for blank in (None, "", " \u00a0"):
        assert row_of(spark, listing_id=blank) is None
        assert row_of(spark, website=blank) is None
    assert row_of(spark, listing_id=" a ").listing_id == " a "  # a kept key is not stripped


def test_latest_row_wins_whatever_the_order(spark):
    times = [(3, 700.0), (9, 900.0), (5, 800.0), (None, 100.0)]
    changes = [{"rent": rent, "scraped_at": day and dt.datetime(2026, 5, day)} for day, rent in times]
    out = silver.transform_to_silver(bronze(spark, *changes)).listings.collect()
    assert [r.rent for r in out] == [900.0]


@pytest.mark.parametrize("column,value,expected", [
    ("rent", -0.5, None), ("latitude", 90.5, None), ("latitude", 43.25, 43.25), ("longitude", -142.5, None), ("parking_included", "5d", None),
    ("parking_included", "2f", None), ("parking_included", "3", 3),
])
def test_ranges(spark, column, value, expected):
    assert row_of(spark, **{column: value})[column] == expected


def test_hash_and_columns(spark):
    out = silver.transform_to_silver(bronze(spark)).listings
    assert out.columns == R.names(R.LISTINGS)
    assert len(out.first().row_hash) == 32
    assert [f.dataType for f in out.schema] == [c.dtype for c in R.LISTINGS]


def test_parking_text_hashes_as_cleaned_double(spark):
    # '0' is range-checked as a double before hashing ("0.0"), then stored as INTEGER 0
    from pyspark.sql import functions as F

    from strata.functions import row_hash

    out = silver.transform_to_silver(bronze(spark, {"parking_included": "0"})).listings.first()
    assert out.parking_included == 0
    text = "|".join(["1875.0", "", "5", "3", "false", "true", "false", "", "", "0.0"])
    expected = spark.range(1).select(F.md5(F.lit(text))).first()[0]
    assert out.row_hash == expected
    assert row_hash  # imported API stays available


def test_neighbourhoods_unique(spark):
    out = silver.transform_to_silver(bronze(spark, {"listing_id": "1"}, {"listing_id": "2"})).neighbourhoods.collect()
    assert len(out) == 1 and out[0].neighbourhood == "Mill Quarter"


def test_missing_columns_filled(spark):
    df = bronze(spark).drop("gym", "move_in_date")
    filled = silver.fill_missing_columns(df)
    assert set(R.BRONZE_COLUMNS) <= set(filled.columns)
    row = filled.first()
    assert row.gym is None and row.move_in_date is None


def test_bronze_view_spreads_narrow_rows(spark, scratch_dir):
    """The joined rows are spread by size while they are narrow, whatever the shuffle partitions are."""
    import re

    from strata.plans import fixtures

    spark.range(400).selectExpr(
        "id % 390 AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus", "CAST(id * 10 AS DOUBLE) AS o_totalprice",
        "TIMESTAMP_NTZ '1995-01-01' + make_dt_interval(id % 90) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{scratch_dir}/orders.parquet")
    spark.range(6).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "'BUILDING' AS c_mktsegment", "CAST(id * 150 - 300 AS DOUBLE) AS c_acctbal", "id % 3 AS c_nationkey",
    ).write.parquet(f"{scratch_dir}/customer.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{scratch_dir}/nation.parquet")
    new = fixtures.bronze_view(spark, scratch_dir)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    before, after = plan.split("RebalancePartitions", 1)
    assert "AS walk_score" in before and "Join" not in before
    assert "Join" in after and not re.search("AS (walk_score|street)", after)
    text = fixtures.bronze_sql("{orders}", "{customer}", "{nation}")
    old = spark.sql(text, **{t: fixtures.table(spark, scratch_dir, t) for t in ("orders", "customer", "nation")})
    assert old.schema == new.schema
    assert new.count() > 300 and old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0
