"""Page extraction (O8-O10) on hand-written pages shaped like real listing sites."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from strata.sources import pages

NOW = "2030-01-01 00:00:00"


def search_html(items, script=True):
    doc = {"@context": "https://schema.org", "@type": "ItemList", "itemListElement": items}
    body = f'<script type="application/ld+json">{json.dumps(doc)}</script>' if script else "<p>none</p>"
    return f"<!DOCTYPE html><html><head><title>Results</title></head><body>{body}</body></html>"


def item(i, url=True):
    it = {"@type": "Residence", "name": f"Listing {i}"}
    if url:
        it["url"] = f"https://www.example.com/v/{i}"
    return {"@type": "ListItem", "position": i, "item": it}


def detail_html(listing=None, listing_id="70214", hood=None, page_activation="2027-05-04T06:07:08.000Z", script=True):
    state = {}
    if listing is not None:
        state[f"RealEstateListing:{listing_id}"] = listing
    if hood is not None:
        state["Neighbourhood:mill-17"] = hood
    props = {"activationDate": page_activation, "__APOLLO_STATE__": state}
    if listing_id is not None:
        props["listingId"] = listing_id
    doc = {"props": {"pageProps": props}}
    body = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(doc, indent=2)}</script>' if script else ""
    return f"<html><head><title>Listing</title></head><body>{body}</body></html>"


FULL = {
    "title": "Loft over the old bakery",
    "description": "Third floor, faces the yard.",
    "price": {"amount": 187500},
    "activationDate": "2027-05-04T06:07:08.000Z",
    "location": {
        "address": "8 Mill Lane",
        "coordinates": {"latitude": 51.25, "longitude": -3.5},
        "neighbourhoodInfo": {"__ref": "Neighbourhood:mill-17"},
    },
    "imageUrls": [f"https://pictures.example.org/{k}.png" for k in "abc"],
    "attributes": {"all": [{"name": n, "values": [v]} for n, v in (
        ("Move-In Date", "2026-04-01"), ("Size (sqft)", "1,040"), ("Braille Labels", "No"), ("Bathrooms", "3"), ("Bedrooms", "5"),
        ("Heat", "Included"), ("Colour of the door", "green"),
    )]},
}
HOOD = {"name": "Mill Quarter", "scores": {"transportation": {"walk": {"score": 3.5}, "transit": {"score": 0}, "cycle": {"score": 10}}}}


def extract(spark, html, url="https://www.example.com/v/70214", city="toronto"):
    df = spark.createDataFrame([(url, city, html)], "url string, city string, html string")
    return pages.extract_listings(df, website="example", scraped_at=NOW, now=NOW).first()


def test_search_page_skips_promoted(spark):
    df = spark.createDataFrame([(1, "toronto", search_html([item(i) for i in range(1, 10)]))], "page_id long, city string, html string")
    rows = pages.search_items(df).collect()
    assert [r.position for r in rows] == [7, 8, 9]
    assert all(r.url.startswith("https://") for r in rows)
    summary = pages.page_summary(pages.search_items(df)).first()
    assert (summary.organic_items, summary.parsed, summary.failed) == (3, 3, 0)


def test_search_page_without_jsonld_or_broken(spark):
    df = spark.createDataFrame(
        [(1, "toronto", search_html([], script=False)),
         (2, "toronto", '<script type="application/ld+json">{"itemListElement": [</script>'),
         (3, "toronto", '<script type="application/ld+json"></script>'),
         (4, "toronto", search_html([item(i, url=(i != 8)) for i in range(1, 10)]))],
        "page_id long, city string, html string",
    )
    rows = pages.search_items(df).collect()
    assert {r.page_id for r in rows} == {4}
    assert sum(1 for r in rows if r.url is None) == 1


def test_full_listing(spark):
    r = extract(spark, detail_html(FULL, hood=HOOD))
    assert r.reject_reason is None
    want = {
        "listing_id": "70214", "title": "Loft over the old bakery", "street": "8 Mill Lane", "city": "toronto", "neighbourhood": "Mill Quarter",
        "rent": 1875.0, "bedrooms": 5, "bathrooms": 3, "size_sqft": 1040.0, "latitude": 51.25, "longitude": -3.5, "walk_score": 3.5,
        "transit_score": 0.0, "bike_score": 10.0, "heat": "Included", "braille_labels": "No", "move_in_date": "2026-04-01", "balcony": None,
        "published_at": dt.datetime(2027, 5, 4, 6, 7, 8),
    }
    assert {k: r[k] for k in want} == want and len(r.images) == 3


def changed(**parts):
    return detail_html(dict(FULL, **parts), hood=HOOD)


def test_numbers_given_as_text(spark):
    place = lambda lat: dict(FULL["location"], coordinates={"latitude": lat, "longitude": "-3.5"})
    r = extract(spark, changed(price={"amount": "187500"}, location=place("51.25")))
    assert (r.reject_reason, r.rent, r.latitude, r.longitude) == (None, 187500.0, 51.25, -3.5)  # text is not in cents
    assert extract(spark, changed(price={"amount": "Please contact"})).reject_reason == "bad_rent"
    assert extract(spark, changed(location=place("north"))).reject_reason == "bad_number"
    odd = {"name": "X", "scores": {"transportation": {"walk": {"score": "high"}}}}
    assert extract(spark, detail_html(FULL, hood=odd)).reject_reason == "bad_number"
    assert extract(spark, changed(price={"currency": "x", "note": {"amount": "7"}, "amount": 5000})).rent == 50.0


def test_null_value_list_is_rejected(spark):
    assert extract(spark, changed(attributes={"all": [{"name": "Heat", "values": None}]})).reject_reason == "bad_attributes"
    quoted = changed(description='says "values": null')
    assert extract(spark, quoted).reject_reason is None


def test_scripts_that_only_look_alike(spark):
    good = changed()
    decoys = ['<!-- <script id="__NEXT_DATA__">{}</script> -->', '<script data-id="__NEXT_DATA__">{}</script>', '<script id="__NEXT_DATA__OLD">{}</script>']
    for decoy in decoys:
        assert extract(spark, good.replace("<body>", "<body>" + decoy)).reject_reason is None
    search = search_html([item(i) for i in range(1, 9)]).replace("<body>", '<body><script data-type="application/ld+json">{"itemListElement": []}</script>')
    df = spark.createDataFrame([(1, "toronto", search)], "page_id long, city string, html string")
    assert pages.search_items(df).count() == 2


def test_listing_without_neighbourhood(spark):
    listing = dict(FULL, price={"amount": 120000}, location={"address": "1 King St", "neighbourhoodInfo": {}})
    listing["attributes"] = {"all": [{"name": "Bedrooms", "values": ["0"]}]}
    r = extract(spark, detail_html(listing))
    assert r.reject_reason is None
    assert r.rent == 1200.0 and r.bedrooms == 0
    assert r.neighbourhood is None and r.walk_score is None and r.transit_score is None and r.bike_score is None


def test_rejects(spark):
    assert extract(spark, detail_html(FULL, script=False)).reject_reason == "no_state_script"
    assert extract(spark, detail_html(FULL, listing_id=None)).reject_reason == "no_listing_id"
    assert extract(spark, detail_html({}, hood=HOOD)).reject_reason == "no_listing_data"
    empty_values = dict(FULL, attributes={"all": [{"name": "Bedrooms", "values": []}]})
    assert extract(spark, detail_html(empty_values)).reject_reason == "bad_attributes"
    no_title = {k: v for k, v in FULL.items() if k != "title"}
    assert extract(spark, detail_html(no_title)).reject_reason == "missing_required"
    naive = dict(FULL, activationDate="2026-02-25")
    assert extract(spark, detail_html(naive)).reject_reason == "bad_published_at"
    future = dict(FULL, activationDate="2031-01-01T00:00:00Z")
    assert extract(spark, detail_html(future)).reject_reason == "bad_published_at"
    no_price = {k: v for k, v in FULL.items() if k != "price"}
    assert extract(spark, detail_html(no_price)).reject_reason == "bad_rent"
    assert extract(spark, detail_html(FULL), url="ftp://x").reject_reason == "bad_url"
    assert extract(spark, detail_html(FULL), city="paris").reject_reason == "bad_city"
    bad_hood = {"name": "X", "scores": {"transportation": {"walk": {"score": 11.0}}}}
    assert extract(spark, detail_html(FULL, hood=bad_hood)).reject_reason == "bad_score"


def test_ids_with_quotes_and_repeated_keys(spark):
    for listing_id in ("it's", 'a"b'):
        assert extract(spark, detail_html(FULL, listing_id=listing_id, hood=HOOD)).reject_reason is None
    assert extract(spark, detail_html(FULL, listing_id="a\"b'c")).reject_reason == "no_listing_data"  # no path can name it
    twice = detail_html(FULL, hood=HOOD).replace('"title": "Loft', '"title": "First", "title": "Loft')
    assert extract(spark, twice).title == "Loft over the old bakery"


def test_types_that_do_not_fit(spark):
    assert extract(spark, changed(price="12")).reject_reason == "bad_rent"
    assert extract(spark, changed(price={"amount": True})).reject_reason == "bad_rent"
    assert extract(spark, changed(price={"amount": None})).rent is None
    assert extract(spark, changed(attributes=["x"])).reject_reason is None
    assert extract(spark, changed(attributes={"all": [None]})).reject_reason == "bad_attributes"
    assert extract(spark, changed(attributes={"all": [{"name": "Heat"}, {"name": "Gym", "values": None}]})).reject_reason == "bad_attributes"
    assert extract(spark, detail_html("text")).reject_reason == "no_listing_data"


def test_every_pair_of_planted_faults(spark, scratch_dir):
    """Rows with two planted faults at once come out as the oracle says, whatever keys a scale holds."""
    import itertools
    import math

    import duckdb

    from strata.plans import catalog, fixtures

    faults = [101, 103, 107, 109, 113, 127, 131, 137, 149, 157, 211, 223, 227, 229, 233]
    keys = sorted({math.lcm(a, b) * k for a, b in itertools.combinations(faults, 2) for k in (1, 2, 3, 4, 5, 9)} | set(range(1, 40)))
    day = "TIMESTAMP_NTZ '1995-01-01' + make_dt_interval(id % 900)"
    spark.createDataFrame([(k,) for k in keys], "id long").selectExpr(
        "id AS o_orderkey", "id % 97 AS o_custkey", "'O' AS o_orderstatus", "CAST(id % 977 + 50.25 AS DOUBLE) AS o_totalprice", f"{day} AS o_orderdate"
    ).write.parquet(f"{scratch_dir}/orders.parquet")
    spark.range(97).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "CAST(id * 150 - 900 AS DOUBLE) AS c_acctbal", "id % 5 AS c_nationkey").write.parquet(f"{scratch_dir}/customer.parquet")
    spark.range(5).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{scratch_dir}/nation.parquet")
    con = duckdb.connect()
    for name in ("orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{scratch_dir}/{name}.parquet/*.parquet')")
    for name in ("listing_pages_rejects", "listing_pages_extract"):
        got = catalog.QUERIES[name](spark, scratch_dir)
        want = con.execute(catalog.ORACLE[name])
        columns = [c[0] for c in want.description]
        round_ = lambda row: tuple(round(v, 9) if isinstance(v, float) else str(v) for v in row)
        assert sorted(map(round_, got.select(*columns).collect()), key=str) == sorted(map(round_, want.fetchall()), key=str)
    assert fixtures.detail_pages(spark, scratch_dir).count() == len(keys)


def test_attribute_edge_cases(spark):
    attrs = {"all": [{"name": "Bedrooms", "values": ["3"]}, {"name": "Heat"}, {"name": "Bedrooms", "values": ["4"]},
                     {"name": "Unknown Field", "values": ["x"]}]}
    r = extract(spark, detail_html(dict(FULL, attributes=attrs)))
    assert r.reject_reason is None
    assert r.bedrooms == 4  # last duplicate wins
    assert r.heat is None  # no values -> null
    r = extract(spark, detail_html({k: v for k, v in FULL.items() if k != "attributes"}))
    assert r.reject_reason is None and r.bedrooms is None
    name_only = {"name": "Midtown"}
    r = extract(spark, detail_html(FULL, hood=name_only))
    assert r.neighbourhood == "Midtown" and r.walk_score is None
    r = extract(spark, detail_html(dict(FULL, activationDate=None)))
    assert r.published_at == dt.datetime(2027, 5, 4, 6, 7, 8)  # falls back to the page date
    r = extract(spark, detail_html(dict(FULL, price={"amount": 95})))
    assert r.rent == 95.0  # small amounts are not cents


def test_state_script_as_the_pattern_says(spark):
    tag = '<script id="__NEXT_DATA__" type="application/json">'
    texts = [
        None, "", "<p>gone</p>", f"{tag}{{}}</script>", f"{tag}</script>", f"{tag}{{}}", f"{tag}{{}}</SCRIPT>", f"{tag}a</Script>b</script>", f"{tag}a</s>b</script>c</script>",
        f"<!-- {tag}x</script> -->{tag}y</script>", f"{tag}a<!-- </script> -->b</script>", f"<SCRIPT ID='__NEXT_DATA__'>up</script>{tag}z</script>",
        '<script data-id="__NEXT_DATA__">{}</script><script id="__NEXT_DATA__OLD">{}</script>' + f"{tag}é\n1</script>", f"</script>{tag}late</script>",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, html string")
    want = frame.select("n", pages._script(F.col("html"), pages._STATE_SCRIPT).alias("_script"))
    got = pages._with_state_script(frame, F.col("html"), [F.col("n")])
    assert sorted(got.collect()) == sorted(want.collect())
    assert sum(r["_script"] is not None for r in got.collect()) == 9
    # the JVM never compiles longer methods, so Spark splits wide projections
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_scrape_composition(spark):
    search = spark.createDataFrame(
        [(1, "vancouver", search_html([item(i) for i in range(1, 10)])), (2, "atlantis", search_html([item(i) for i in range(1, 9)]))],
        "page_id long, city string, html string",
    )
    ok = lambda i: (f"https://www.example.com/v/{i}", "toronto", detail_html(FULL, listing_id=str(i), hood=HOOD))
    details = spark.createDataFrame([ok(7), ok(7), ok(8), (f"https://www.example.com/v/{1}", "toronto", "<p>gone</p>")],
                                    "url string, city string, html string")
    found = pages.scrape(search, details, website="example", scraped_at=NOW, now="2028-03-01 00:00:00")
    # a URL stored twice is one listing, and the search page's city counts
    assert sorted((r.listing_id, r.city) for r in found.listings.collect()) == [("7", "vancouver"), ("8", "vancouver")]
    got = {r.page_id: (r.organic_items, r.parsed, r.failed) for r in found.summary.collect()}
    assert got == {1: (3, 2, 1), 2: (2, 0, 2)}  # item 9 has no page; the second city is not served
    assert [r.reject_reason for r in found.rejects.collect()] == ["no_state_script"]


def test_date_filter(spark):
    now = dt.datetime(2026, 2, 26, 12, 0)
    rows = [("a", now - dt.timedelta(days=6)), ("b", now - dt.timedelta(days=10)), ("c", now - dt.timedelta(days=7) + dt.timedelta(seconds=1)),
            ("d", dt.datetime(2026, 2, 25, 14, 30)), ("e", dt.datetime(2026, 2, 25, 0, 0)),
            ("f", dt.datetime(2026, 2, 25, 23, 59, 59, 999999)), ("g", dt.datetime(2026, 2, 24, 23, 59, 59))]
    df = spark.createDataFrame(rows, "listing_id string, published_at timestamp")
    last = {r.listing_id for r in pages.filter_published(df, mode="last_x_days", now=now, days=7).collect()}
    assert {"a", "c"} <= last and "b" not in last
    day = {r.listing_id for r in pages.filter_published(df, mode="specific_date", specific_date="2026-02-25").collect()}
    assert day == {"d", "e", "f"}
    assert pages.filter_published(df, mode="specific_date").count() == len(rows)
    assert pages.filter_published(df.limit(0), mode="last_x_days", now=now, days=7).count() == 0
