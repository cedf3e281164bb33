"""Listing-shaped inputs derived from the driver's tables.

The test data holds no listings, so a deterministic *bronze view* is derived from
``orders ⋈ customer ⋈ nation``. The same SQL text runs in Spark (tables passed as
DataFrames) and in DuckDB (tables are views), so both engines see identical input; the
operators under test are then written independently on each side.

Planted cases: null and blank keys, duplicate keys (listing_id = orderkey mod 5000),
negative rents, out-of-range coordinates and scores, text in a numeric column, padded
and mixed-case text, tabs and no-break spaces, and every yes/no spelling.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from strata import registry as R

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cached(store: dict, spark: SparkSession, key: tuple, build):
    """Per-session memo of a derived frame; a frame of another (or a stopped) session is
    never handed out."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # no SparkContext (Spark Connect)
        app = None
    full = (id(spark), app, *key)
    hit = store.get(full)
    if hit is None or hit.sparkSession is not spark:
        hit = build()
        store[full] = hit
    return hit


# Boolean-like amenity columns get rotating spellings.
_BOOL_WORDS = ("'Yes'", "'  NO '", "'Included'", "'Not Included'", "'maybe'")
_FLAG_COLUMNS = tuple(c.name for c in R.LISTINGS if c.clean == R.CLEAN_BOOL)


def _flag_case(i: int, name: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(_BOOL_WORDS))
    return f"CASE (o.o_orderkey + {i}) % 6 {whens} END AS {name}"


def bronze_select(drop=()) -> str:
    """SELECT list of the bronze view (all bronze columns except ``images``)."""
    cols = {
        "listing_id": (
            "CASE WHEN o.o_orderkey % 89 = 0 THEN NULL "
            "WHEN o.o_orderkey % 97 = 0 THEN '  ' "
            "ELSE CAST(o.o_orderkey % 5000 AS STRING) END"
        ),
        "url": "'https://listings.example.com/v/' || CAST(o.o_orderkey AS STRING)",
        "website": "lower(o.o_orderpriority)",
        "published_at": "o.o_orderdate",
        "title": "chr(160) || 'Listing ' || CAST(o.o_orderkey AS STRING) || '  '",
        "description": "'Order ' || o.o_orderstatus || ' for ' || c.c_name",
        "street": "'  ' || CAST(o.o_custkey AS STRING) || ' Main St' || chr(9)",
        "city": "upper(c.c_mktsegment)",
        "neighbourhood": "'  ' || n.n_name",
        "rent": (
            "CASE WHEN o.o_orderkey % 13 = 0 THEN -(o.o_totalprice / 100) "
            "ELSE o.o_totalprice / 100 END"
        ),
        "move_in_date": (
            "CASE WHEN o.o_orderkey % 3 = 0 THEN NULL "
            "ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END"
        ),
        "bedrooms": "CAST(o.o_orderkey % 5 AS INTEGER)",
        "bathrooms": "CAST(o.o_custkey % 3 + 1 AS INTEGER)",
        "size_sqft": "o.o_totalprice / 250",
        "unit_type": (
            "CASE o.o_orderkey % 4 WHEN 0 THEN ' Condo' WHEN 1 THEN 'APARTMENT ' "
            "WHEN 2 THEN 'Basement' END"
        ),
        "agreement_type": (
            "CASE o.o_custkey % 3 WHEN 0 THEN ' 1 Year' WHEN 1 THEN 'Month-to-month' END"
        ),
        "for_rent_by": "CASE WHEN o.o_orderkey % 2 = 0 THEN 'Owner' ELSE ' Professional ' END",
        "latitude": "CAST(40 + o.o_custkey % 50 AS DOUBLE) + 0.5",
        "longitude": "CAST(o.o_orderkey % 110 AS DOUBLE) - 150.0",
        "walk_score": "c.c_acctbal / 900",
        "transit_score": "c.c_acctbal / 1000",
        "bike_score": "CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE CAST(c.c_custkey % 12 AS DOUBLE) END",
        "parking_included": (
            "CASE o.o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN '1' WHEN 2 THEN '0' "
            "WHEN 3 THEN '-1' END"
        ),
        "pet_friendly": "CASE o.o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN ' Limited' END",
        "smoking_permitted": "CASE WHEN o.o_custkey % 2 = 0 THEN ' No ' ELSE 'Outdoors ONLY' END",
        "scraped_at": "o.o_orderdate",
    }
    parts = []
    for name in R.BRONZE_COLUMNS:
        if name == "images" or name in drop:
            continue
        if name in _FLAG_COLUMNS:
            parts.append(_flag_case(_FLAG_COLUMNS.index(name), name))
        else:
            parts.append(f"{cols[name]} AS {name}")
    parts.append("o.o_orderkey AS o_orderkey")
    return ",\n  ".join(parts)


def bronze_sql(orders="orders", customer="customer", nation="nation", drop=()) -> str:
    return (
        f"SELECT\n  {bronze_select(drop)}\n"
        f"FROM {orders} o\n"
        f"JOIN {customer} c ON o.o_custkey = c.c_custkey\n"
        f"JOIN {nation} n ON c.c_nationkey = n.n_nationkey"
    )


_VIEWS: dict = {}


def bronze_view(spark: SparkSession, sf_dir: str, drop=()) -> DataFrame:
    """The derived bronze rows (plus ``o_orderkey``, the tie-breaker).

    The lazy frame is built once per session and input folder (the inputs are immutable
    files); every action still reads and derives the rows anew.
    """
    return _cached(_VIEWS, spark, (sf_dir, tuple(drop)), lambda: _bronze_view(spark, sf_dir, drop))


def _bronze_view(spark: SparkSession, sf_dir: str, drop=()) -> DataFrame:
    # The narrow joined rows are spread by size before they become wide: a task then sorts as many
    # wide rows as one partition of the advisory size holds, however large the tables are and
    # whatever the number of shuffle partitions is.
    joined = spark.sql(
        "SELECT o.*, c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, n.n_name FROM {orders} o "
        "JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey",
        **{name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation")},
    )
    text = re.sub(r"\b([ocn])\.(?=\1_)", "", bronze_select(drop))  # one table now holds the columns of all three
    return spark.sql(f"SELECT {text} FROM {{rows}}", rows=joined.hint("rebalance", "o_orderkey"))


def bronze_cte(drop=()) -> str:
    """The same view for the DuckDB oracle, as a WITH clause."""
    return f"WITH bronze AS (\n{bronze_sql(drop=drop)}\n)\n"


# --------------------------------------------------------------------------- pages
#
# Search pages: orders grouped by o_orderkey div 40 (at most 40 items per page, whatever
# the key distribution). Detail pages: one per order, a state document built with
# to_json. Faults are planted by key so the oracle can project expected rows directly.

PAGE_SIZE = 40
LISTING_URL = "https://listings.example.com/v/"
PAGE_CITIES = R.CITIES


def _city_of(c):
    from pyspark.sql import functions as F

    return F.element_at(F.array(*[F.lit(x) for x in PAGE_CITIES]), (c % len(PAGE_CITIES)).cast("int") + 1)


_SEARCH: dict = {}


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, city, html)``: JSON-LD item lists; pages with id % 17 = 0 have no
    JSON-LD, id % 19 = 0 carry broken JSON; items with key % 11 = 0 have no URL.

    Stored once per session and input folder, like :func:`detail_pages`."""
    from strata.session import materialize

    return _cached(_SEARCH, spark, (sf_dir,), lambda: materialize(_search_pages(spark, sf_dir), "search-pages"))


def _search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    o = table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    element = F.struct(
        F.lit("ListItem").alias("@type"),
        (k % PAGE_SIZE + 1).alias("position"),
        F.struct(
            F.concat(F.lit("Listing "), k.cast("string")).alias("name"),
            F.when(k % 11 != 0, F.concat(F.lit(LISTING_URL), k.cast("string"))).alias("url"),
        ).alias("item"),
    )
    pages = o.groupBy(F.expr(f"o_orderkey div {PAGE_SIZE}").alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct(k.alias("k"), element.alias("e")))).alias("items")
    )
    doc = F.to_json(
        F.struct(
            F.lit("https://schema.org").alias("@context"),
            F.lit("ItemList").alias("@type"),
            F.transform("items", lambda x: x.getField("e")).alias("itemListElement"),
        )
    )
    pid = F.col("page_id")
    head = "<!DOCTYPE html><html><head><title>Results</title></head><body>"
    html = (
        F.when(pid % 17 == 0, F.lit(head + "<p>No results</p></body></html>"))
        .when(pid % 19 == 0, F.lit(head + '<script type="application/ld+json">{"itemListElement": [</script></body></html>'))
        .otherwise(F.concat(F.lit(head + '<script type="application/ld+json">'), doc, F.lit("</script></body></html>")))
    )
    return pages.select(pid, _city_of(pid).alias("city"), html.alias("html"))


def _size_text(s):
    from pyspark.sql import functions as F

    return F.when(
        s >= 1000,
        F.concat((s / 1000).cast("long").cast("string"), F.lit(","), F.lpad((s % 1000).cast("string"), 3, "0")),
    ).otherwise(s.cast("string"))


_PAGES: dict = {}


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, city, html)``: one listing page per order (see the oracle for the faults).

    The pages stand for a stored table of fetched pages: they are generated and written
    once per session and input folder, and read back by every query that uses them.
    """
    from strata.session import materialize

    return _cached(_PAGES, spark, (sf_dir,), lambda: materialize(_detail_pages(spark, sf_dir), "detail-pages"))


def _detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    # A stored pages table spans many files; the generated one starts from a single small
    # file, so spread it over the cores (evenly: a given number is not merged by size).
    o = table(spark, sf_dir, "orders").repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    zulu = F.concat(day, F.lit("T00:00:00.000Z"))
    activation = (
        F.when(k % 4 == 0, zulu)
        .when(k % 4 == 1, F.concat(day, F.lit("T00:00:00+00:00")))
        .when(k % 4 == 2, day)
    )

    def attr(name, value):
        return F.struct(F.lit(name).alias("name"), F.array(value).alias("values"))

    size = ck % 2000 + 300
    attrs = [
        attr("Bedrooms", (k % 5).cast("string")),
        attr("Bathrooms", F.concat((ck % 3 + 1).cast("string"), F.lit(" bath"))),
        attr("Size (sqft)", F.when(k % 233 == 0, F.lit("-5")).otherwise(_size_text(size))),
        attr("Furnished", F.when(k % 2 == 0, F.lit("Yes")).otherwise(F.lit("No"))),
        attr("Unit Type", F.when(ck % 2 == 0, F.lit("Apartment")).otherwise(F.lit("Condo"))),
        attr("Parking Included", F.lit("Yes")),
        attr("Move-In Date", day),
        attr("Floor Plan", F.lit("Open")),
        F.when(k % 5 == 0, F.struct(F.lit("Heat").alias("name"), F.lit(None).cast("array<string>").alias("values")))
        .otherwise(attr("Heat", F.lit("Included"))),
        F.when(k % 113 == 0, F.struct(F.lit("Water").alias("name"), F.array().cast("array<string>").alias("values")))
        .otherwise(attr("Water", F.lit("Not Included"))),
        F.when(k % 9 == 0, attr("Bedrooms", F.lit("7"))),
    ]
    attr_list = F.filter(F.array(*attrs), lambda a: a.isNotNull())
    img = [F.concat(F.lit("https://img.example.com/"), k.cast("string"), F.lit(f"/{i}.jpg")) for i in (1, 2)]
    ref = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("Neighbourhood:"), F.col("n_nationkey").cast("string")))
    listing = F.struct(
        F.when(k % 103 != 0, F.concat(F.lit("Listing "), k.cast("string"))).alias("title"),
        F.concat(F.lit("Order "), F.col("o_orderstatus"), F.lit(" for "), F.col("c_name")).alias("description"),
        F.when(k % 107 != 0, F.struct(F.col("o_totalprice").alias("amount"))).alias("price"),
        activation.alias("activationDate"),
        F.struct(
            F.concat(ck.cast("string"), F.lit(" Main St")).alias("address"),
            F.struct(
                ((ck % 50).cast("double") + 40.5).alias("latitude"),
                ((k % 110).cast("double") - 150.0).alias("longitude"),
            ).alias("coordinates"),
            F.struct(ref.alias("__ref")).alias("neighbourhoodInfo"),
        ).alias("location"),
        F.slice(F.array(*img), 1, (k % 3).cast("int")).alias("imageUrls"),
        F.struct(attr_list.alias("all")).alias("attributes"),
    )
    acct = F.col("c_acctbal")
    hood = F.struct(
        F.col("n_name").alias("name"),
        F.struct(
            F.struct(
                F.struct((acct / 1000).alias("score")).alias("walk"),
                F.struct((acct / 2000).alias("score")).alias("transit"),
                F.struct((acct / 3000).alias("score")).alias("cycle"),
            ).alias("transportation")
        ).alias("scores"),
    )
    listing_key = F.when(k % 227 == 0, F.lit("RealEstateListing:other")).otherwise(
        F.concat(F.lit("RealEstateListing:"), k.cast("string"))
    )
    def quoted(x):  # keys and ids here are plain ASCII without quotes or backslashes
        return F.concat(F.lit('"'), x, F.lit('"'))

    # values whose JSON type differs: amounts and coordinates as text, words for numbers, a null list.
    # Words go first: a key with both faults keeps the word, which the quoting pattern leaves alone.
    # Each step is a column of its own: it is read twice by the next one.
    rows = rows.select("*", F.to_json(listing).alias("_text"))
    for every, pattern, other in (
        (131, r'"amount":[0-9.E]+', '"amount":"Please contact"'),
        (109, r'"amount":([0-9.E]+)', '"amount":"$1"'),
        (157, r'"latitude":-?[0-9.]+', '"latitude":"north"'),
        (127, r'"latitude":(-?[0-9.]+)', '"latitude":"$1"'),
        (149, r'"name":"Floor Plan","values":\["Open"\]', '"name":"Floor Plan","values":null'),
    ):
        rows = rows.withColumn("_text", F.when(k % every == 0, F.regexp_replace("_text", pattern, other)).otherwise(F.col("_text")))
    state = F.concat(
        F.lit("{"), quoted(listing_key), F.lit(": "), F.col("_text"),
        F.lit(", "), quoted(F.concat(F.lit("Neighbourhood:"), F.col("n_nationkey").cast("string"))),
        F.lit(": "), F.to_json(hood), F.lit("}"),
    )
    page_id = F.when(k % 101 != 0, k.cast("string"))
    props = F.concat(
        F.lit('{"props": {"pageProps": {'),
        F.when(page_id.isNotNull(), F.concat(F.lit('"listingId": '), quoted(page_id), F.lit(", "))).otherwise(F.lit("")),
        F.lit('"activationDate": '), quoted(zulu), F.lit(', "__APOLLO_STATE__": '), state, F.lit("}}}"),
    )
    body = (
        F.when(k % 211 == 0, F.lit("<p>gone</p>"))
        .when(k % 223 == 0, F.lit('<script id="__NEXT_DATA__" type="application/json">{"props": </script>'))
        .otherwise(F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), props, F.lit("</script>")))
    )
    # scripts that only look like the state document
    decoys = F.when(k % 137 == 0, F.lit(
        '<!-- <script id="__NEXT_DATA__">{}</script> --><script data-id="__NEXT_DATA__">{}</script><script id="__NEXT_DATA__OLD">{}</script>'
    )).otherwise(F.lit(""))
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>Listing</title></head><body>"), decoys, body, F.lit("</body></html>"))
    url = F.when(k % 229 == 0, F.concat(F.lit("ftp://listings.example.com/v/"), k.cast("string"))).otherwise(
        F.concat(F.lit(LISTING_URL), k.cast("string"))
    )
    city = F.when(ck % 31 == 0, F.lit("paris")).otherwise(_city_of(ck))
    return rows.select(url.alias("url"), city.alias("city"), html.alias("html"))
