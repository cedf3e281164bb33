"""Benchmark decontamination: a broadcast hash set of test n-grams probed by every window.

The benchmark's word windows are hashed and grouped (bounded, size-checked before the
broadcast); every window of every training text is hashed the same way and probes the
set inside the scan; a hit is verified word by word. Only hits (and one row a document)
reach the single shuffle, which gathers a document's hits. A set too large to broadcast
meets the windows in a shuffle of hashes and positions; hits go back to their documents,
where the words are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_words, lower_ascii, stored, text_mark, whole_text, with_window_hashes, without_texts

WINDOW = 10
#: Windows of the benchmark, and bytes of their words and item ids, up to which the set is broadcast; above it the join shuffles.
BROADCAST_WINDOWS = 1_000_000
BROADCAST_BYTES = 256 << 20


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, length, words, items): each distinct window of the items with the ids of the items that hold it."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"),
        ascii_words(lower_ascii(whole_text())).alias("words"),
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))
    return (
        items.select("item", F.explode(runs).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select(F.size("words").alias("length"), "words", "items")
    )


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: its own columns but the text, with ``n_words``, ``hits`` and ``items``.

    ``hits``: array of (start, length) of verified windows; ``items``: ids (text) of the
    items with occurring windows. Null and empty texts have no words and no hits; repeated
    rows each get their row; an empty benchmark gives no hits; items without words are
    ignored, items that repeat an id count once, an item without id marks words but is not
    counted. Columns other than ``doc_id`` and ``text``
    are not read.
    """
    grams = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    held = [F.octet_length(F.array_join(c, " ")) + 16 * F.size(c) for c in ("words", "items")]
    counted = grams.groupBy("length").agg(F.count(F.lit(1)).alias("count"), F.sum(held[0] + held[1]).alias("bytes")).collect()  # at most `window` rows
    lengths = sorted((r["length"] for r in counted), reverse=True)
    small = sum(r["count"] for r in counted) <= BROADCAST_WINDOWS and sum(r["bytes"] for r in counted) <= BROADCAST_BYTES

    docs = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        ascii_words(lower_ascii(whole_text())).alias("words"),
    )
    hashed = grams
    for n in lengths:
        hashed = with_window_hashes(hashed, "words", n, f"w{n}")
    own: Column = F.lit(None).cast("bigint")
    for n in lengths:
        own = F.when(F.col("length") == n, F.col(f"w{n}")[0]).otherwise(own)
    hashed = hashed.select(own.alias("gram"), "length", F.col("words").alias("run"), "items")
    return _probe(docs, hashed, lengths) if small else _meet(stored(docs, "benchmark-documents"), hashed, lengths)


def _window_probes(docs: DataFrame, lengths: list[int]) -> tuple[DataFrame, Column, Column]:
    """Documents with their window hashes, all hashes in one array, and the place in it where those of ``length`` begin."""
    for n in lengths:
        docs = with_window_hashes(docs, "words", n, f"w{n}")
    first: Column = F.lit(0)
    begin: Column = F.lit(None).cast("int")
    for n in lengths:
        begin = F.when(F.col("length") == n, first).otherwise(begin)
        first = first + F.greatest(F.col("n_words") - (n - 1), F.lit(0))
    return docs, F.concat(F.array().cast("array<bigint>"), *[F.col(f"w{n}") for n in lengths]), begin


def _probe(docs: DataFrame, hashed: DataFrame, lengths: list[int]) -> DataFrame:
    """Every window probes the broadcast set where it is made."""
    docs, probes, begin = _window_probes(docs.withColumn("n_words", F.size("words")), lengths)
    # One generator for all lengths; its first element stands for the document itself.
    probes = F.concat(F.array(F.lit(None).cast("bigint")), probes)
    start = F.col("at") - 1 - begin
    probed = docs.select("row", "doc_id", "words", "n_words", F.posexplode(probes).alias("at", "gram"))
    match = (F.col("p.gram") == F.col("g.gram")) & (F.slice("words", start + 1, F.col("length")) == F.col("run"))
    found = probed.alias("p").join(F.broadcast(hashed).alias("g"), match, "left").where((F.col("at") == 0) | F.col("length").isNotNull())
    return (
        found.select(
            "row", "doc_id", "items",
            F.when(F.col("at") == 0, F.col("n_words")).alias("n_words"),
            F.when(F.col("at") > 0, F.struct(start.cast("int").alias("start"), F.col("length").alias("length"))).alias("hit"),
        )
        .groupBy("row", "doc_id")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.array_sort(F.collect_set("hit")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .drop("row")
    )


def _meet(docs: DataFrame, hashed: DataFrame, lengths: list[int]) -> DataFrame:
    """The set and the windows of stored documents meet by hash: rows of (document, place, hash) are shuffled,
    no words; a document's candidate hits are gathered once and verified beside its words."""
    with_hashes, probes, begin = _window_probes(docs.withColumn("n_words", F.size("words")), lengths)
    start = F.col("at") - begin
    windows = with_hashes.select("row", "n_words", F.posexplode(probes).alias("at", "gram"))
    hits = (
        windows.join(hashed.select("gram", "length", "run"), "gram")
        .withColumn("start", start.cast("int"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
        .groupBy("row").agg(F.collect_set(F.struct("start", "length", "run")).alias("maybe"))
    )
    true = F.filter(F.col("maybe"), lambda h: F.slice("words", h["start"] + 1, h["length"]) == h["run"])
    checked = stored(docs.join(hits, "row", "left").select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), F.coalesce(F.array_sort(true), F.array()).alias("hits"),
    ), "benchmark-hits")
    runs = checked.select("row", F.explode(F.array_distinct(F.transform("hits", lambda h: h["run"]))).alias("run"))
    items = runs.join(hashed.select("run", "items"), "run").select("row", F.explode("items").alias("item"))
    items = items.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return checked.join(items, "row", "left").select(
        "doc_id", "n_words", F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length"))).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def covered_words(hits: Column) -> Column:
    """How many word positions an array of (start, length) sorted by start covers."""
    zero = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("upto"))

    def add(acc: Column, hit: Column) -> Column:
        end = (hit["start"] + hit["length"]).cast("long")
        begin = F.greatest(acc["upto"], hit["start"].cast("long"))
        return F.struct((acc["words"] + F.greatest(end - begin, F.lit(0).cast("long"))).alias("words"), F.greatest(acc["upto"], end).alias("upto"))

    return F.aggregate(hits, zero, add, lambda acc: acc["words"])


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    n_hit = covered_words(F.col("hits"))
    return scan(documents, benchmark, window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a benchmark window, row by row: a row stays or goes by its own text."""
    texts = documents.select(text_mark().alias("doc_id"), "text")
    return without_texts(documents, contamination(texts, benchmark, window).where("contaminated").select("doc_id").distinct())


# ---------------------------------------------------------------- registered query

OP3_SQL = """
WITH docs AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w,
         row_number() OVER () AS r
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), 10) AS l FROM (
    SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w
    FROM benchmark) WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT item, l, w, unnest(generate_series(1, len(w) - l + 1)) AS i FROM items)),
lens AS (SELECT DISTINCT l FROM items),
places AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT r, l, w, unnest(generate_series(1, len(w) - l + 1)) AS i FROM docs, lens WHERE len(w) >= l)),
hits AS (SELECT r, i, grams.l AS l, item FROM places JOIN grams ON places.g = grams.g AND places.l = grams.l),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + l - 1)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
