"""Column registries: one declaration per table, everything else is derived from it.

A registry is a tuple of :class:`ColumnSpec`. From it we derive the Spark schema (O6), the
cleaning projection (O13-O17), the hashed column list (O19), key columns and the merge roles
used by the upserts (O22, O23).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING = T.StringType()
BOOLEAN = T.BooleanType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
TIMESTAMP = T.TimestampType()
STRING_ARRAY = T.ArrayType(T.StringType())

# Cleaning applied on the way from bronze to silver.
CLEAN_NONE = "none"
CLEAN_STRIP = "strip"  # trim Unicode white space
CLEAN_LOWER = "lower"  # trim + lower case
CLEAN_BOOL = "bool"  # yes/included -> true, no/not included -> false

# Role of a column in a keyed merge.
MERGE_KEY = "key"  # part of the primary key, never updated
MERGE_OVERWRITE = "overwrite"  # replaced on update (guarded by the row hash for listings)
MERGE_ALWAYS = "always"  # replaced on every accepted update
MERGE_MANAGED = "managed"  # not taken from the input: set by the merge itself (batch time)


@dataclass(frozen=True)
class Bounds:
    """Valid numeric interval; values outside become null.

    ``exclusive`` makes *both* given ends strict (that is what the cleaning code does).
    """

    low: float | None = None
    high: float | None = None
    exclusive: bool = False


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    nullable: bool = True
    key: bool = False
    clean: str = CLEAN_NONE
    merge: str = MERGE_OVERWRITE
    default_sql: str | None = None
    bounds: Bounds | None = None
    hashed: bool = False
    metadata: dict = field(default_factory=dict, compare=False)


def _key(name, dtype=STRING):
    return ColumnSpec(name, dtype, nullable=False, key=True, merge=MERGE_KEY)


def _flag(name, hashed=False):
    return ColumnSpec(name, BOOLEAN, clean=CLEAN_BOOL, hashed=hashed)


# ---------------------------------------------------------------------------------------
# Table layouts that must equal the reference's column names, order, types,
# ranges and hashed flags (the hash changes with the column order).
# ---------------------------------------------------------------------------------------

NEIGHBOURHOODS: tuple[ColumnSpec, ...] = (
    _key("neighbourhood"),
    _key("city"),
    ColumnSpec("walk_score", DOUBLE, bounds=Bounds(0, 10)),
    ColumnSpec("transit_score", DOUBLE, bounds=Bounds(0, 10)),
    ColumnSpec("bike_score", DOUBLE, bounds=Bounds(0, 10)),
    ColumnSpec("loaded_at", TIMESTAMP, nullable=False, merge=MERGE_MANAGED, default_sql="now()"),
)

LISTINGS: tuple[ColumnSpec, ...] = (
    _key("listing_id"),
    _key("website"),
    ColumnSpec("url", STRING, nullable=False),
    ColumnSpec("published_at", TIMESTAMP, nullable=False),
    ColumnSpec("title", STRING, nullable=False, clean=CLEAN_STRIP),
    ColumnSpec("description", STRING, nullable=False, clean=CLEAN_STRIP),
    ColumnSpec("street", STRING, nullable=False, clean=CLEAN_STRIP),
    ColumnSpec("city", STRING, nullable=False, clean=CLEAN_LOWER),
    ColumnSpec("neighbourhood", STRING, clean=CLEAN_STRIP),
    ColumnSpec("rent", DOUBLE, bounds=Bounds(low=0, exclusive=True), hashed=True),
    ColumnSpec("move_in_date", STRING, hashed=True),
    ColumnSpec("bedrooms", INT, hashed=True),
    ColumnSpec("bathrooms", INT, hashed=True),
    ColumnSpec("size_sqft", DOUBLE),
    ColumnSpec("unit_type", STRING, clean=CLEAN_LOWER),
    ColumnSpec("agreement_type", STRING, clean=CLEAN_LOWER),
    _flag("furnished", hashed=True),
    ColumnSpec("for_rent_by", STRING, clean=CLEAN_LOWER),
    ColumnSpec("latitude", DOUBLE, bounds=Bounds(41.0, 84.0)),
    ColumnSpec("longitude", DOUBLE, bounds=Bounds(-142.0, -52.0)),
    ColumnSpec("images", STRING_ARRAY),
    _flag("elevator"),
    _flag("gym"),
    _flag("concierge"),
    _flag("security_24h"),
    _flag("pool"),
    _flag("balcony"),
    _flag("yard"),
    _flag("storage_space"),
    _flag("heat", hashed=True),
    _flag("water", hashed=True),
    _flag("hydro", hashed=True),
    _flag("internet"),
    _flag("cable_tv"),
    _flag("laundry_in_unit", hashed=True),
    _flag("laundry_in_building"),
    ColumnSpec("parking_included", INT, bounds=Bounds(low=0), hashed=True),
    _flag("dishwasher"),
    _flag("fridge_freezer"),
    ColumnSpec("pet_friendly", STRING, clean=CLEAN_LOWER),
    ColumnSpec("smoking_permitted", STRING, clean=CLEAN_LOWER),
    _flag("wheelchair_accessible"),
    _flag("barrier_free"),
    _flag("accessible_washrooms"),
    _flag("audio_prompts"),
    _flag("visual_aids"),
    _flag("braille_labels"),
    _flag("bicycle_parking"),
    _flag("air_conditioning"),
    ColumnSpec("row_hash", STRING, nullable=False, merge=MERGE_ALWAYS),
    ColumnSpec("scraped_at", TIMESTAMP, nullable=False, merge=MERGE_ALWAYS),
)

# Bronze record layout (53 fields, in the order of the scraped record model). Amenity
# fields stay raw text in bronze; the silver cleaning types them.
_BRONZE_LAYOUT = (
    ("listing_id", STRING, False),
    ("url", STRING, False),
    ("website", STRING, False),
    ("published_at", TIMESTAMP, False),
    ("title", STRING, False),
    ("description", STRING, False),
    ("street", STRING, False),
    ("city", STRING, False),
    ("neighbourhood", STRING, True),
    ("rent", DOUBLE, True),
    ("move_in_date", STRING, True),
    ("bedrooms", INT, True),
    ("bathrooms", INT, True),
    ("size_sqft", DOUBLE, True),
    ("unit_type", STRING, True),
    ("agreement_type", STRING, True),
    ("furnished", STRING, True),
    ("for_rent_by", STRING, True),
    ("latitude", DOUBLE, True),
    ("longitude", DOUBLE, True),
    ("walk_score", DOUBLE, True),
    ("transit_score", DOUBLE, True),
    ("bike_score", DOUBLE, True),
    ("images", STRING_ARRAY, False),
    ("elevator", STRING, True),
    ("gym", STRING, True),
    ("concierge", STRING, True),
    ("security_24h", STRING, True),
    ("pool", STRING, True),
    ("balcony", STRING, True),
    ("yard", STRING, True),
    ("storage_space", STRING, True),
    ("heat", STRING, True),
    ("water", STRING, True),
    ("hydro", STRING, True),
    ("internet", STRING, True),
    ("cable_tv", STRING, True),
    ("laundry_in_unit", STRING, True),
    ("laundry_in_building", STRING, True),
    ("parking_included", STRING, True),
    ("dishwasher", STRING, True),
    ("fridge_freezer", STRING, True),
    ("pet_friendly", STRING, True),
    ("smoking_permitted", STRING, True),
    ("wheelchair_accessible", STRING, True),
    ("barrier_free", STRING, True),
    ("accessible_washrooms", STRING, True),
    ("audio_prompts", STRING, True),
    ("visual_aids", STRING, True),
    ("braille_labels", STRING, True),
    ("bicycle_parking", STRING, True),
    ("air_conditioning", STRING, True),
    ("scraped_at", TIMESTAMP, False),
)

# Supported cities and run statuses.
CITIES = ("toronto", "vancouver", "london")
STATUS_SUCCESS = "success"
STATUS_ERROR = "error"
STATUS_NO_DATA = "completed_no_data"
MODE_LAST_DAYS = "last_x_days"
MODE_SPECIFIC_DATE = "specific_date"

# End of fixed values.
# ---------------------------------------------------------------------------------------

BRONZE_COLUMNS: tuple[str, ...] = tuple(name for name, _, _ in _BRONZE_LAYOUT)
BRONZE_SCHEMA = T.StructType(
    [T.StructField(name, dtype, nullable) for name, dtype, nullable in _BRONZE_LAYOUT]
)

HASH_COLUMN = "row_hash"
RECENCY_COLUMN = "scraped_at"


def names(registry, *, managed: bool = False) -> list[str]:
    """Column names in registry order; managed columns only when asked for."""
    return [c.name for c in registry if managed or c.merge != MERGE_MANAGED]


def key_columns(registry) -> list[str]:
    return [c.name for c in registry if c.key]


def hashed_columns(registry) -> list[str]:
    return [c.name for c in registry if c.hashed]


def columns_with(registry, clean: str) -> list[str]:
    return [c.name for c in registry if c.clean == clean]


def bounded_columns(*registries) -> dict[str, Bounds]:
    """Range checks of all given registries (the cleaning step applies both tables')."""
    out: dict[str, Bounds] = {}
    for registry in registries:
        for c in registry:
            if c.bounds is not None:
                out[c.name] = c.bounds
    return out


def spark_schema(registry, *, managed: bool = True) -> T.StructType:
    """The table's ``StructType``; key and default travel as field metadata."""
    fields = []
    for c in registry:
        if c.merge == MERGE_MANAGED and not managed:
            continue
        meta = dict(c.metadata)
        if c.key:
            meta["primary_key"] = True
        if c.default_sql:
            meta["default"] = c.default_sql
        fields.append(T.StructField(c.name, c.dtype, c.nullable, meta))
    return T.StructType(fields)


def ddl(registry, table: str) -> str:
    """A Spark SQL ``CREATE TABLE`` statement (Parquet) for the registry."""
    parts = []
    for c in registry:
        piece = f"  {c.name} {c.dtype.simpleString().upper()}"
        if not c.nullable:
            piece += " NOT NULL"
        if c.default_sql:
            piece += f" DEFAULT {c.default_sql}"
        parts.append(piece)
    keys = ", ".join(key_columns(registry))
    body = ",\n".join(parts)
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n{body}\n) USING parquet\n"
        f"TBLPROPERTIES ('primary_key' = '{keys}')"
    )
