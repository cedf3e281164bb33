"""Listing-page extraction as a Spark job over a pages table (O8a-O8i, O9, O10).

Input is HTML that was already fetched (fetching is outside the library): search-result
pages ``(page_id, city, html)`` and listing detail pages ``(url, html)``. Everything below
is built-in Column functions: regexp extraction of the script, typed paths into the state
document (a VARIANT, parsed once), higher-order array functions for the attribute list. No UDFs.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.functions import (
    as_timestamp,
    cents_to_amount,
    has_offset,
    on_day,
    parse_float,
    parse_int,
    parse_iso,
    within_last_days,
)

PROMOTED_ITEMS = 6

# ---------------------------------------------------------------------------------------
# Detail-page attribute names and the record field each one fills.
# ---------------------------------------------------------------------------------------
ATTRIBUTE_FIELDS = {
    "Bedrooms": "bedrooms",
    "Bathrooms": "bathrooms",
    "Size (sqft)": "size_sqft",
    "Unit Type": "unit_type",
    "Agreement Type": "agreement_type",
    "Furnished": "furnished",
    "For Rent By": "for_rent_by",
    "Elevator in Building": "elevator",
    "Gym": "gym",
    "Concierge": "concierge",
    "24 Hour Security": "security_24h",
    "Pool": "pool",
    "Balcony": "balcony",
    "Yard": "yard",
    "Storage Space": "storage_space",
    "Heat": "heat",
    "Water": "water",
    "Hydro": "hydro",
    "Internet": "internet",
    "Cable / TV": "cable_tv",
    "Laundry (In Unit)": "laundry_in_unit",
    "Laundry (In Building)": "laundry_in_building",
    "Parking Included": "parking_included",
    "Dishwasher": "dishwasher",
    "Fridge / Freezer": "fridge_freezer",
    "Pet Friendly": "pet_friendly",
    "Smoking Permitted": "smoking_permitted",
    "Wheelchair accessible": "wheelchair_accessible",
    "Barrier-free Entrances and Ramps": "barrier_free",
    "Accessible Washrooms in Suite": "accessible_washrooms",
    "Audio Prompts": "audio_prompts",
    "Visual Aids": "visual_aids",
    "Braille Labels": "braille_labels",
    "Bicycle Parking": "bicycle_parking",
    "Air Conditioning": "air_conditioning",
    "Move-In Date": "move_in_date",
}
LISTING_STATE_PREFIX = "RealEstateListing:"
STATE_SCRIPT_ID = "__NEXT_DATA__"
# End of fixed values.
# ---------------------------------------------------------------------------------------

# An attribute follows white space and its value is closed, so data-id or a longer id do not
# match; comments are removed before a script is looked for.
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_VALUE = r"""(?:"{0}"|'{0}'|{0}(?=[\s>]))"""
# The body up to the first end tag, in runs without '<' (no step back at every character).
_BODY = r"([^<]*+(?:<(?!/script>)[^<]*+)*+)</script>"
_LD_SCRIPT = r"(?i)<script(?=\s)[^>]*?\stype\s*=\s*" + _VALUE.format(r"application/ld\+json") + r"[^>]*>" + _BODY
_STATE_TAG = r"(?i)<script(?=\s)[^>]*?\sid\s*=\s*" + _VALUE.format("__NEXT_DATA__") + r"[^>]*>"
_STATE_SCRIPT = _STATE_TAG + _BODY
_FIRST_SCRIPT = r"(?i)<script\b[^>]*>" + _BODY

SEARCH_SCHEMA = T.StructType(
    [
        T.StructField(
            "itemListElement",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("position", T.LongType()),
                        T.StructField(
                            "item",
                            T.StructType([T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]),
                        ),
                    ]
                )
            ),
        )
    ]
)

# Typed views of the state document. Values whose JSON type matters (numbers that may be
# given as text, lists that may be null) stay VARIANT.
PROPS_TYPE = "struct<pageProps:struct<listingId:string,activationDate:string>>"
STATE_PATH = "$.props.pageProps.__APOLLO_STATE__"
# The entries of the state: the members of listings, then those of neighbourhoods.
STATE_TYPE = (
    "map<string,struct<title:string,description:string,activationDate:string,price:struct<amount:variant>,"
    "location:struct<address:string,coordinates:struct<latitude:variant,longitude:variant>,neighbourhoodInfo:struct<__ref:string>>,"
    "imageUrls:array<string>,attributes:struct<all:array<struct<name:string,values:array<string>>>>,"
    "name:string,scores:struct<transportation:"
    "struct<walk:struct<score:variant>,transit:struct<score:variant>,cycle:struct<score:variant>>>>>"
)
ATTRIBUTES_TYPE = "array<struct<name:string,values:array<string>>>"
# The same with lists as they are, read only where a list is missing or null.
LISTS_TYPE = "struct<attributes:struct<all:array<struct<values:variant>>>>"


def _script(html: Column, pattern: str, *, comments: bool = True) -> Column:
    """Body of the first matching script outside comments; null when absent or empty."""
    if comments:
        html = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, _COMMENT, "")).otherwise(html)
    body = F.regexp_extract(html, pattern, 1)
    return F.when(F.length(body) > 0, body)


def _number(value: Column, kind: Column) -> Column:
    """A JSON number, or text that reads as one, as a double; null for any other value (or none).

    ``kind`` is the type of the value, as a column of its own: it is read several times."""
    return F.when(kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), F.try_variant_get(value, "$", "double")).when(
        kind == "STRING", parse_float(F.try_variant_get(value, "$", "string"))
    )


def _with_state_script(pages: DataFrame, html: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and ``_script``: what ``_script(html, _STATE_SCRIPT)`` finds.

    Only the start tag is looked for by pattern. The body is cut out at its end tag, but by
    pattern too where another end tag could come first or is spelled otherwise.
    """
    text = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, _COMMENT, "")).otherwise(html)
    stage = pages.select(*keep, text.alias("_html"))
    stage = stage.select("*", F.regexp_extract("_html", _STATE_TAG, 0).alias("_tag"))
    stage = stage.select("*", F.substr("_html", F.instr("_html", F.col("_tag")) + F.length("_tag")).alias("_rest"))
    stage = stage.select("*", F.substring_index("_rest", "</script>", 1).alias("_body"))
    plain = F.contains("_rest", F.lit("</script>")) & ~F.contains("_body", F.lit("</s")) & ~F.contains("_body", F.lit("</S"))
    body = F.when(F.length("_tag") > 0, F.when(plain, F.col("_body")).otherwise(F.regexp_extract("_html", _STATE_SCRIPT, 1)))
    stage = stage.select(*keep, body.alias("_body"))
    return stage.select(*keep, F.when(F.length("_body") > 0, F.col("_body")).alias("_script"))


def _given(value: Column) -> Column:
    """Neither missing nor a JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def _nameable(key: Column) -> Column:
    """A key that a path could name, or null: it does not hold both quotation marks."""
    return F.when(~(F.contains(key, F.lit('"')) & F.contains(key, F.lit("'"))), key)


def _state_path(key: Column) -> Column:
    """Path of the state entry with that key; quoted with the mark that the key does not hold."""
    quote = F.when(~F.contains(key, F.lit('"')), F.lit('"')).when(~F.contains(key, F.lit("'")), F.lit("'"))
    return F.concat(F.lit(STATE_PATH + "["), quote, key, quote, F.lit("]"))


# ------------------------------------------------------------------ O8a, O8b, O10


def first_script(html) -> Column:
    """Body of a page's first ``<script>`` (null if none or empty)."""
    return _script(F.col(html) if isinstance(html, str) else html, _FIRST_SCRIPT, comments=False)


def search_items(pages: DataFrame, *, html_col: str = "html", keep_cols=("page_id", "city")) -> DataFrame:
    """O8a + O8b: organic items of search pages, one row each.

    The first JSON-LD script is parsed; a missing, empty or invalid document gives no
    items. The first six items of each page are promoted and skipped. ``url`` is null
    for an item without one (counted as failed). ``position`` is the 1-based place in the
    page's list.
    """
    keep = [c for c in keep_cols if c in pages.columns]
    doc = F.from_json(_script(F.col(html_col), _LD_SCRIPT), SEARCH_SCHEMA)
    items = F.coalesce(doc.getField("itemListElement"), F.array().cast(SEARCH_SCHEMA["itemListElement"].dataType))
    organic = F.slice(items, PROMOTED_ITEMS + 1, F.greatest(F.size(items), F.lit(1)))
    rows = pages.select(*keep, F.posexplode(organic).alias("_i", "_item"))
    url = F.col("_item.item.url")
    return rows.select(
        *keep,
        (F.col("_i") + PROMOTED_ITEMS + 1).cast("long").alias("position"),
        F.when(F.length(url) > 0, url).alias("url"),
    )


def page_summary(items: DataFrame, listings: DataFrame | None = None, *, page_col: str = "page_id") -> DataFrame:
    """Per page, organic items, parsed listings and failures (items without a URL
    or whose detail page was rejected)."""
    if listings is None:
        per_page = items.groupBy(page_col).agg(
            F.count(F.lit(1)).alias("organic_items"),
            F.count("url").alias("parsed"),
        )
    else:
        ok = listings.where(F.col("reject_reason").isNull()).select(page_col, "position").withColumn("_ok", F.lit(1))
        per_page = (
            items.join(ok, [page_col, "position"], "left")
            .groupBy(page_col)
            .agg(F.count(F.lit(1)).alias("organic_items"), F.count("_ok").alias("parsed"))
        )
    return per_page.withColumn("failed", F.col("organic_items") - F.col("parsed"))


# ------------------------------------------------------------------ O8c - O8i


def _attribute(name: str) -> Column:
    """First value of the *last* attribute called ``name``; null when there is none.

    Reads the columns ``_from_end`` (names, last first) and ``_values`` (lists, in page order):
    plain array look-ups, no function that is evaluated per element outside generated code.
    """
    at = F.array_position("_from_end", F.lit(name))  # 0, which is beyond the end below, if none
    return F.get(F.get("_values", (F.size("_values") - at).cast("int")), F.lit(0))


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) > 0)


def extract_listings(
    details: DataFrame,
    *,
    website: str,
    scraped_at,
    now,
    url_col: str = "url",
    html_col: str = "html",
    city_col: str | None = "city",
    keep_cols=(),
) -> DataFrame:
    """O8c-O8i: detail pages to bronze records plus ``reject_reason`` (null = accepted).

    ``now`` is the reference time for "not in the future"; ``scraped_at`` the batch time.
    Without ``city_col`` the city stays null and is not checked: a scrape takes it from the
    search page that listed the URL.
    """
    # Staged projections: every expensive step (regex over the page, the one JSON parse, each
    # typed view) is computed once into a column and later steps read the column. Whole texts
    # and documents are left behind as soon as nothing reads them.
    own = [F.col(c) for c in dict.fromkeys([url_col, *([city_col] if city_col else []), *[c for c in keep_cols if c in details.columns]])]
    stage = _with_state_script(details, F.col(html_col), own)
    stage = stage.select(*own, F.col("_script").isNotNull().alias("_found"), F.try_parse_json("_script").alias("_doc"))
    stage = stage.select("*", F.try_variant_get("_doc", "$.props", PROPS_TYPE).alias("_props"))
    page = F.col("_props.pageProps")
    stage = stage.select("*", page.getField("listingId").alias("_id"), page.getField("activationDate").alias("_page_activation"))
    key = F.when(_nonempty(F.col("_id")), F.concat(F.lit(LISTING_STATE_PREFIX), F.col("_id")))
    stage = stage.select("*", _state_path(key).alias("_path"))
    # One typed view of all entries, by a fixed path: a path of its own for each row is parsed anew
    # for each row, and a VARIANT in between would be built anew.
    stage = stage.select("*", F.when(key.isNotNull(), F.try_variant_get("_doc", STATE_PATH, STATE_TYPE)).alias("_state"))
    stage = stage.select("*", F.try_element_at("_state", _nameable(key)).alias("_l"))
    L = F.col("_l")
    loc = L.getField("location")
    ref = loc.getField("neighbourhoodInfo").getField("__ref")
    stage = stage.select(
        "*",
        # an object without any member; a title tells most apart without a look at the whole type
        (L.isNotNull() & F.when(L.getField("title").isNotNull(), F.lit(True)).otherwise(F.schema_of_variant(F.try_variant_get("_doc", F.col("_path"), "variant")) != "OBJECT<>")).alias("_has_listing"),
        F.coalesce(L.getField("attributes").getField("all"), F.array().cast(ATTRIBUTES_TYPE)).alias("_attrs"),
        F.try_element_at("_state", _nameable(F.when(_nonempty(ref), ref))).alias("_hood"),
    )
    names, values = F.col("_attrs").getField("name"), F.col("_attrs").getField("values")
    stage = stage.select("*", F.reverse(names).alias("_from_end"), values.alias("_values"))
    some_null = lambda c: F.size(F.array_compact(c)) < F.size(c)
    stage = stage.select(
        "*", some_null("_values").alias("_no_list"),
        # an attribute without a name (or none at all), or with an empty list
        (some_null("_from_end") | F.coalesce(F.array_contains("_values", F.array().cast("array<string>")), F.lit(False))).alias("_bad"),
    )
    lists = F.try_variant_get("_doc", F.col("_path"), LISTS_TYPE).getField("attributes").getField("all")
    stage = stage.select("*", F.when(F.col("_no_list"), lists).alias("_lists"))
    null_list = F.exists("_lists", lambda a: F.coalesce(F.is_variant_null(a.getField("values")), F.lit(False)))
    bad_attrs = F.col("_bad") | (F.col("_no_list") & null_list)
    hood = F.col("_hood")
    transport = hood.getField("scores").getField("transportation")

    activation = F.coalesce(
        F.when(_nonempty(L.getField("activationDate")), L.getField("activationDate")),
        F.when(_nonempty(F.col("_page_activation")), F.col("_page_activation")),
    )

    numbers = {
        "amount": L.getField("price").getField("amount"),
        "latitude": loc.getField("coordinates").getField("latitude"),
        "longitude": loc.getField("coordinates").getField("longitude"),
        "walk_score": transport.getField("walk").getField("score"),
        "transit_score": transport.getField("transit").getField("score"),
        "bike_score": transport.getField("cycle").getField("score"),
    }
    stage = stage.select(
        "*", activation.alias("_activation"), *[value.alias("_v_" + c) for c, value in numbers.items()],
        *[F.schema_of_variant(value).alias("_k_" + c) for c, value in numbers.items()],
    )
    stage = stage.select("*", *[_number(F.col("_v_" + c), F.col("_k_" + c)).alias("_n_" + c) for c in numbers])
    measured = {c: F.col("_v_" + c) for c in numbers if c != "amount"}
    # A JSON number follows the cents rule; an amount given as text is taken as it reads.
    price, amount = F.col("_v_amount"), F.col("_n_amount")
    rent = F.when(price.isNull(), F.lit(0.0)).when(F.col("_k_amount") == "STRING", amount).otherwise(cents_to_amount(amount))
    record = {
        "listing_id": F.col("_id"),
        "url": F.col(url_col),
        "website": F.lit(website),
        "published_at": parse_iso("_activation"),
        "title": L.getField("title"),
        "description": L.getField("description"),
        "street": loc.getField("address"),
        "city": F.col(city_col) if city_col else F.lit(None).cast("string"),
        "neighbourhood": hood.getField("name"),
        "rent": rent,
        **{c: F.col("_n_" + c) for c in measured},
        "images": F.coalesce(L.getField("imageUrls"), F.array().cast("array<string>")),
        "scraped_at": as_timestamp(scraped_at),
    }
    for name, field in ATTRIBUTE_FIELDS.items():
        value = _attribute(name)
        if field in ("bedrooms", "bathrooms"):
            record[field] = parse_int(value)
        elif field == "size_sqft":
            record[field] = parse_float(value)
        else:
            record[field] = value

    # the record becomes columns before the rules read it, so that no parse runs once per rule
    stage = stage.select(
        "*", *[record[c].cast(R.BRONZE_SCHEMA[c].dataType).alias("_r_" + c) for c in R.BRONZE_COLUMNS],
        *[_given(value).alias("_g_" + c) for c, value in measured.items()],
        (_given(price) & amount.isNull()).alias("_bad_amount"), has_offset("_activation").alias("_aware"), bad_attrs.alias("_bad_attrs"),
    )
    record = {c: F.col("_r_" + c) for c in R.BRONZE_COLUMNS}
    given = {c: F.col("_g_" + c) for c in measured}

    rules = [
        ("no_state_script", ~F.col("_found")),
        ("invalid_document", F.col("_props").isNull()),
        ("no_listing_id", ~_nonempty(F.col("_id"))),
        ("no_listing_data", ~F.col("_has_listing")),
        ("bad_attributes", F.col("_bad_attrs")),
        ("missing_required", reduce(lambda a, b: a | b, [record[c].isNull() for c in ("url", "title", "description", "street", *(["city"] if city_col else []))])),
        ("bad_url", ~(F.col(url_col).startswith("http://") | F.col(url_col).startswith("https://"))),
        ("bad_published_at", record["published_at"].isNull() | ~F.col("_aware") | (record["published_at"] > as_timestamp(now))),
        *([("bad_city", ~record["city"].isin(*R.CITIES))] if city_col else []),
        ("bad_rent", F.col("_bad_amount") | (record["rent"].isNotNull() & ((record["rent"] <= 0) | F.isnan(record["rent"])))),
        (
            "bad_count",
            reduce(
                lambda a, b: a | b,
                [F.coalesce(record[c] < 0, F.lit(False)) for c in ("bedrooms", "bathrooms", "size_sqft")]
                + [F.coalesce(F.isnan(record["size_sqft"]), F.lit(False))],
            ),
        ),
        ("bad_number", reduce(lambda a, b: a | b, [given[c] & record[c].isNull() for c in measured])),
        (
            "bad_score",
            reduce(
                lambda a, b: a | b,
                [
                    F.coalesce((record[c] < 0) | (record[c] > 10) | F.isnan(record[c]), F.lit(False))
                    for c in ("walk_score", "transit_score", "bike_score")
                ],
            ),
        ),
    ]
    reason = F.coalesce(*[F.when(F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules])
    keep = [c for c in keep_cols if c in details.columns]
    # One row in, one row out; a filter on the reason stays above the generator instead of
    # being pushed into the projections, where every rule would parse the page again.
    done = F.struct(*[record[c].alias(c) for c in R.BRONZE_COLUMNS], reason.alias("reject_reason"))
    return stage.select(*keep, F.inline(F.array(done)))


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reject_reason").isNotNull())


def split(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows. Each is one pass over the pages; a caller that sinks both
    stores the extraction first."""
    return accepted(extracted), rejected(extracted)


# ------------------------------------------------------------------ O9


def filter_published(df: DataFrame, *, mode: str, now=None, days: int = 7, specific_date=None, col: str = "published_at") -> DataFrame:
    """LAST_X_DAYS keeps ``published_at >= now - days``; SPECIFIC_DATE keeps the whole
    UTC day; specific mode without a date keeps everything."""
    if mode == R.MODE_LAST_DAYS:
        return df.where(within_last_days(col, now, days))
    if mode == R.MODE_SPECIFIC_DATE and specific_date:
        return df.where(on_day(col, specific_date))
    return df


class Scraped(NamedTuple):
    listings: DataFrame
    rejects: DataFrame
    summary: DataFrame


def scrape(search_pages: DataFrame, detail_pages: DataFrame, *, website: str, scraped_at, now) -> Scraped:
    """Search pages -> organic items; detail pages -> records; items joined to records on URL.

    A listing takes the city of the search page that lists it; an item whose city is not
    served counts as failed, like one whose page is missing or rejected. Of several pages
    stored for one URL the first by record content counts. Items and the URL join are
    stored once: listings, summary and counts read them. Detail pages (one per fetched URL)
    are parsed where they are read, with no shuffle; only the compact records, not the
    HTML, meet the items. A URL listed on many search pages is a hot join key on the item
    side, which adaptive execution splits.
    """
    from strata.session import materialize

    items = search_items(search_pages)
    records = extract_listings(detail_pages, website=website, scraped_at=scraped_at, now=now, city_col=None)
    good, bad = split(records)
    first = Window.partitionBy("url").orderBy("listing_id", "published_at", F.xxhash64(*[c for c in good.columns if c not in ("url", "city")]))
    good = good.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "city")
    served = F.col("city").isin(*R.CITIES)
    linked = materialize(items.join(good, "url", "left").withColumn("_ok", F.col("listing_id").isNotNull() & served), "scraped-items")
    summary = linked.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("organic_items"), F.count_if(F.coalesce("_ok", F.lit(False))).alias("parsed")
    ).withColumn("failed", F.col("organic_items") - F.col("parsed"))
    return Scraped(linked.where("_ok").select(*R.BRONZE_COLUMNS), bad.drop("city"), summary)
