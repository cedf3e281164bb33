"""Secret scan with multipart credential linking, on Spark's own expressions.

Strong patterns (the base kinds) are reported wherever they stand. Weak parts (short
assignments, key-like words, account names, endpoints) are common in clean text, so one is
reported only when a complementary part stands in the same scope, and one of the two is a
secret. Scopes are the intervals between blank lines, rules (---, ===) and closing braces;
parts and scopes are joined as intervals, dealt out by (text, cell of positions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import spans_text, stored, whole_text

# The base patterns and the least length of what they must hold.
ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ["assign", "access", "hex"]

# Weak parts, by what they can complete. None of them counts alone. Values are read to their end.
WEAK_SECRET = r"(?i:\b(?:pwd|pass|passphrase|credential|auth|private_?key|client_?secret|access_?key)\b)[\"']?\x20*[:=]\x20*[\"']?[^\s\"',;]{6,}+"
WEAK_ID = r"(?i:\b(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|key_?id|tenant)\b)[\"']?\x20*[:=]\x20*[\"']?[^\s\"',;]{3,}+"
ENDPOINT = r"(?i:\b(?:https?|jdbc:[a-z0-9]++|postgres(?:ql)?|mysql|redis|mongodb|amqp|ftp)://)[^\s\"',;]{4,}+"

# What ends a scope: blank lines, rules of three or more marks on a line of their own, closing braces.
BOUNDARY = r"\n[\x20\t\r]*+\n|\n[\x20\t]*+(?:-{3}|={3}|_{3}|\*{3}|#{3}|~{3})[^\n]*+|\}"
#: Code points of a cell in which scopes and parts meet (results do not depend on it).
CELL = 1024
#: Matches whose positions are added up in one go.
RUN = 64


def _pairs(text: Column, pattern: str) -> Column:
    """(gap, match) pairs of all leftmost, non-overlapping matches.

    ``\\G`` ties each pair to the end of the one before, so the rest after the last match is
    scanned once.
    """
    pairs = rf"(?s)\G(.*?)({pattern})"
    gaps = F.regexp_extract_all(text, F.lit(pairs), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(pairs), F.lit(2))
    return F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("value")), lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["value"]).alias("size"), p["value"].alias("value")))


def _local(pairs: Column) -> Column:
    """Spans of a short run of pairs, counted from its start."""
    zero = F.struct(F.lit(0).alias("upto"), F.array().cast("array<struct<start:int,stop:int,value:string>>").alias("spans"))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["upto"] + pair["gap"]
        span = F.struct(start.alias("start"), (start + pair["size"]).alias("stop"), pair["value"].alias("value"))
        return F.struct((start + pair["size"]).alias("upto"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, zero, add)


def regex_spans(df: DataFrame, patterns: dict[str, Column]) -> DataFrame:
    """Add a column of spans (start, stop, value; code points, stop exclusive) for each column of pairs.

    Positions are sums over all matches before: added up in runs of ``RUN`` matches, then
    over the runs, so that a text with very many matches costs little more for each. Every
    step is a column of its own (one that a lambda refers to could be made again for each
    element).
    """
    df = df.withColumns({f"__{k}_pairs": c for k, c in patterns.items()})
    runs = lambda k: F.transform(F.sequence(F.lit(0), F.floor(F.size(f"__{k}_pairs") / RUN).cast("int")), lambda i: F.slice(f"__{k}_pairs", i * RUN + 1, F.lit(RUN)))
    df = df.withColumns({f"__{k}_runs": F.when(F.size(f"__{k}_pairs") > 0, F.transform(runs(k), _local)) for k in patterns})
    total = lambda k: F.aggregate(F.col(f"__{k}_runs"), F.array(F.lit(0)), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["upto"])))
    df = df.withColumns({f"__{k}_from": total(k) for k in patterns})
    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    moved = lambda r, at: F.transform(r["spans"], lambda s: F.struct((s["start"] + at).alias("start"), (s["stop"] + at).alias("stop"), s["value"].alias("value")))
    spans = lambda k: F.flatten(F.zip_with(f"__{k}_runs", F.slice(f"__{k}_from", F.lit(1), F.size(f"__{k}_runs")), moved))
    df = df.withColumns({k: F.coalesce(F.when(F.col(f"__{k}_runs").isNotNull(), spans(k)), none) for k in patterns})
    return df.drop(*[f"__{k}_{x}" for k in patterns for x in ("pairs", "runs", "from")])


def base_spans(documents: DataFrame) -> DataFrame:
    """row, doc_id, arrays of matches by kind, and what ends a scope where there are weak parts; stored once, without the texts."""
    text, low = F.col("__text"), F.col("__low")
    any_of = lambda *words: F.expr(" or ".join(f"contains(__low, '{w}')" for w in words))
    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole_text().alias("__text"))
    docs = docs.withColumn("__low", F.lower(text))
    found = regex_spans(docs, {
        "assigned": F.when(any_of("password", "passwd", "secret", "token", "apikey", "api_key"), _pairs(text, ASSIGN.replace("([A-Z", "(?:[A-Z"))),
        "access": F.when(F.contains(text, F.lit("AKIA")), _pairs(text, ACCESS)),
        "hex": F.when(F.regexp_like(text, F.lit(f"[0-9a-f]{{{LEAST_HEX}}}")), _pairs(text, f"[0-9a-f]{{{LEAST_HEX},}}")),
        "weak_secret": F.when(any_of("pwd", "pass", "credential", "auth", "private", "client", "access") & F.regexp_like(low, F.lit(WEAK_SECRET)), _pairs(text, WEAK_SECRET)),
        "weak_id": F.when(any_of("user", "login", "account", "client", "key", "tenant") & F.regexp_like(low, F.lit(WEAK_ID)), _pairs(text, WEAK_ID)),
        "endpoint": F.when(any_of("://"), _pairs(text, ENDPOINT)),
    })
    found = found.withColumn("access", F.filter("access", lambda s: s["stop"] - s["start"] >= LEAST_ACCESS)).withColumn("length", F.length(text))
    weak = (F.size("weak_secret") + F.size("weak_id") + F.size("endpoint") > 0) | F.exists("assigned", lambda s: F.length(s["value"]) < 2 * LEAST_VALUE + 20)
    return regex_spans(found, {"ends": F.when(weak, _pairs(text, BOUNDARY))}).drop("__text", "__low")


def _kind(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))


def linked_parts(parts: DataFrame, scopes: DataFrame) -> DataFrame:
    """The weak ones of (row, part, start, stop, weak) whose scope (row, start, stop) completes them.

    A secret is completed by an identifier or an endpoint, these by a secret; so one part of
    every link is a secret. A scope is dealt to all cells that it touches and a part to the
    cell of its start, so that each part meets its scope in one cell, and no task holds more
    of a text than one cell.
    """
    cell = lambda c: F.floor(c / F.lit(CELL))
    inside = scopes.select("row", F.col("start").alias("low"), F.col("stop").alias("high"), F.explode(F.sequence(cell(F.col("start")), cell(F.col("stop")))).alias("cell"))
    held = parts.withColumn("cell", cell(F.col("start"))).join(inside, ["row", "cell"]).where("low <= start and start < high")
    # of each scope, which classes it holds; few rows, whatever the number of parts
    classes = held.groupBy("row", "low").agg(F.max(F.col("part") == "secret").alias("has_secret"), F.max(F.col("part") != "secret").alias("has_other"))
    both = classes.where("has_secret and has_other").select("row", "low")
    return held.where("weak").join(both, ["row", "low"]).select("row", "part", "start", "stop")


def secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every document row.

    ``spans`` holds the base spans and the weak parts that linking confirms, by start, then
    kind (base kinds as listed, then secret, id, endpoint). Null and empty texts have no
    spans (sha256 of the empty text); repeated rows each get their row. Only ``doc_id`` and
    ``text`` are read.
    """
    found = stored(base_spans(documents), "secret-spans")
    value = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_VALUE, 1))
    long_value = F.filter("assigned", lambda s: value(s) >= LEAST_VALUE)
    short_value = F.filter("assigned", lambda s: (value(s) < LEAST_VALUE) & (value(s) >= 6))
    found = found.withColumn("assign", long_value).withColumn("short", short_value)
    base = F.array_sort(F.concat(*[_kind(F.col(k), k, i) for i, k in enumerate(KINDS)]))

    part = lambda c, name, weak: F.transform(F.col(c), lambda s: F.struct(F.lit(name).alias("part"), s["start"].alias("start"), s["stop"].alias("stop"), F.lit(weak).alias("weak")))
    parts = F.concat(
        part("assign", "secret", False), part("hex", "secret", False), part("access", "id", False),
        part("short", "secret", True), part("weak_secret", "secret", True), part("weak_id", "id", True), part("endpoint", "endpoint", True),
    )
    several = found.where(F.size(parts) > 1)
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e["stop"]))
    stops = F.concat(F.transform("ends", lambda e: e["start"]), F.array(F.col("length")))
    scopes = several.select("row", F.inline(F.arrays_zip(starts.alias("start"), stops.alias("stop"))))
    linked = linked_parts(several.select("row", F.inline(parts)), scopes)
    rank = F.when(F.col("part") == "secret", 3).when(F.col("part") == "id", 4).otherwise(5)
    added = linked.groupBy("row").agg(
        F.collect_set(F.struct("start", rank.alias("rank"), F.col("part").alias("kind"), "stop")).alias("added")
    )
    result = found.select("row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base")).join(added, "row", "left")
    extra = F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int>>"))
    return result.select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.concat("base", extra)).alias("spans"),
        F.size(extra).cast("long").alias("n_linked"),
    )
