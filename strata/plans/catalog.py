"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver's tables in full (or data Spark derives from them); the
matching DuckDB statement lives in ``ORACLE`` under the same name. Derived inputs
(bronze view, pages) come from ``fixtures``; subsets such as "older half" split the
whole table into overlapping batches to exercise a merge, they do not shrink the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import configure
from strata import registry as R
from strata.functions import as_timestamp, parse_float, parse_int, parse_iso, has_offset
from strata.functions import row_hash as row_hash_expr
from strata.operators import checks, gold, merge, metrics, scd2, silver
from strata.plans import fixtures
from strata.plans import oracle as O
from strata.sources import bronze, pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return wrap


# Batch times of the two runs used by merge / history queries, and the scrape "now".
T1 = "2030-01-01 00:00:00"
T2 = "2030-02-01 00:00:00"
NOW = "2030-01-01 00:00:00"
# Two overlapping runs over the whole bronze view, split by scrape time only: the stored
# state (everything before 1999) and an incoming batch (everything from 1997). Together
# they cover every row; the two shared years give equal-time and changed-hash matches.
OLDER = "scraped_at < TIMESTAMP '1999-01-01 00:00:00'"
NEWER = "scraped_at >= TIMESTAMP '1997-01-01 00:00:00'"
HOODS_FIRST = "neighbourhood < '  NATION_15'"


def _bronze(spark, sf_dir, drop=()):
    return fixtures.bronze_view(spark, sf_dir, drop)


def _silver(spark, sf_dir, where=None) -> silver.SilverFrames:
    b = _bronze(spark, sf_dir)
    if where:
        b = b.where(F.expr(where))
    return silver.transform_to_silver(b, tiebreak=["o_orderkey"])


# ------------------------------------------------------------------ silver


@query("silver_listings", O.silver_ctes() + "SELECT * FROM listings")
def silver_listings(spark, sf_dir):
    """Minimum slice: bronze view -> O11 -> O12 -> O17 -> O20 -> O19 -> O18."""
    return _silver(spark, sf_dir).listings


@query("silver_neighbourhoods", O.silver_ctes() + "SELECT * FROM hoods")
def silver_neighbourhoods(spark, sf_dir):
    """Unique (neighbourhood, city) with scores of the latest listing."""
    return _silver(spark, sf_dir).neighbourhoods


_DROPPED = ("move_in_date", "gym", "bike_score")


def _fill_sql():
    types = {f.name: f.dataType for f in R.BRONZE_SCHEMA.fields}
    cols = []
    for name in R.BRONZE_COLUMNS:
        if name in _DROPPED or name == "images":
            cols.append(f"CAST(NULL AS {O.duck_type(types[name])}) AS {name}")
        else:
            cols.append(name)
    return O.with_bronze(_DROPPED) + f"SELECT {', '.join(cols)}, o_orderkey FROM bronze"


@query("fill_missing_columns", _fill_sql())
def fill_missing_columns(spark, sf_dir):
    """Bronze rows lacking three columns get them back as typed nulls."""
    b = _bronze(spark, sf_dir, drop=_DROPPED)
    filled = silver.fill_missing_columns(b)
    return filled.select(*R.BRONZE_COLUMNS, "o_orderkey")


@query(
    "key_filter",
    O.with_bronze()
    + f"SELECT o_orderkey, listing_id, website FROM bronze WHERE {O.nonblank('listing_id')} AND {O.nonblank('website')}",
)
def key_filter(spark, sf_dir):
    """Rows whose key parts are all present and not blank; keys are not stripped."""
    b = _bronze(spark, sf_dir)
    return silver.drop_invalid_keys(b, R.key_columns(R.LISTINGS)).select("o_orderkey", "listing_id", "website")


_FLAGS = R.columns_with(R.LISTINGS, R.CLEAN_BOOL)


@query(
    "to_boolean",
    O.with_bronze() + "SELECT o_orderkey, " + ", ".join(f"{O.to_bool(c)} AS {c}" for c in _FLAGS) + " FROM bronze",
)
def to_boolean(spark, sf_dir):
    """yes/included -> true, no/not included -> false, others null (26 columns)."""
    from strata.functions import to_boolean as tb

    b = _bronze(spark, sf_dir)
    return b.select("o_orderkey", *[tb(c).alias(c) for c in _FLAGS])


_RANGED = R.bounded_columns(R.LISTINGS, R.NEIGHBOURHOODS)


@query(
    "range_validate",
    O.with_bronze()
    + "SELECT o_orderkey, "
    + ", ".join(f"{O.bounded(c, b)} AS {c}" for c, b in _RANGED.items())
    + " FROM bronze",
)
def range_validate(spark, sf_dir):
    """Lenient double cast, null outside the column's interval (text -> null)."""
    from strata.functions import in_bounds

    b = _bronze(spark, sf_dir)
    return b.select("o_orderkey", *[in_bounds(c, r).alias(c) for c, r in _RANGED.items()])


_STRIPPED = R.columns_with(R.LISTINGS, R.CLEAN_STRIP)
_LOWERED = R.columns_with(R.LISTINGS, R.CLEAN_LOWER)


@query(
    "strip_lower",
    O.with_bronze()
    + "SELECT o_orderkey, "
    + ", ".join([f"{O.strip(c)} AS {c}" for c in _STRIPPED] + [f"{O.lower_strip(c)} AS {c}" for c in _LOWERED])
    + " FROM bronze",
)
def strip_lower(spark, sf_dir):
    """Unicode-space strip; strip + lower-case."""
    from strata.functions import strip, strip_lower

    b = _bronze(spark, sf_dir)
    return b.select("o_orderkey", *[strip(c).alias(c) for c in _STRIPPED], *[strip_lower(c).alias(c) for c in _LOWERED])


@query(
    "row_hash",
    O.with_bronze() + f", c AS ({O.cleaned_select('bronze')}) SELECT o_orderkey, {O.hash_expr()} AS row_hash FROM c",
)
def row_hash(spark, sf_dir):
    """md5 over the cleaned hashed columns (registry order, '|' joined, null = '')."""
    b = silver.clean(silver.fill_missing_columns(_bronze(spark, sf_dir)))
    return b.select("o_orderkey", row_hash_expr(R.hashed_columns(R.LISTINGS), b).alias("row_hash"))


_LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query(
    "keep_latest",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_shipdate DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS LAST" for c in _LINE_TIES)
    + ") AS rn FROM lineitem) WHERE rn = 1",
)
def keep_latest(spark, sf_dir):
    """Latest line per (order, line number) by ship date; ties by the other columns."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    return silver.keep_latest(li, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"], tiebreak=list(_LINE_TIES))


# ------------------------------------------------------------------ merges


@query(
    "upsert_hash_guarded",
    O.with_bronze()
    + O.silver_block("a_", OLDER)
    + O.silver_block("b_", NEWER)
    + O.guarded_merge("a_listings", "b_listings", "merged")
    + "SELECT * FROM merged",
)
def upsert_hash_guarded(spark, sf_dir):
    """stored = silver of the older batch; incoming = newer batch with stale rows.

    The stored side is a stored table in a real run, so it is computed once here too."""
    from strata.session import materialize

    stored = materialize(_silver(spark, sf_dir, OLDER).listings)
    batch = _silver(spark, sf_dir, NEWER).listings
    return merge.upsert_hash_guarded(stored, batch)


# Stored and incoming keys overlap in part: ids that end in 0 are new, ids that end in 1 are
# not scraped again. Every row of the bronze view is on one side at least.
_STORED_KEYS = "(listing_id IS NULL OR listing_id NOT LIKE '%0')"
_SCRAPED_KEYS = "(listing_id IS NULL OR listing_id NOT LIKE '%1')"


def _rescrape_select(src: str) -> str:
    """The listings scraped again: a day earlier (stale), at the same time or a day later, by
    number of bathrooms; titles changed (not hashed), rents of three-bedroom listings
    changed (hashed)."""
    changed = {
        "title": "upper(title)",
        "scraped_at": "CASE bathrooms WHEN 1 THEN scraped_at - INTERVAL 1 DAY WHEN 2 THEN scraped_at ELSE scraped_at + INTERVAL 1 DAY END",
        "rent": "CASE WHEN bedrooms = 3 THEN rent * 1.5 ELSE rent END",
    }
    cols = [f"{changed[c]} AS {c}" if c in changed else c for c in R.BRONZE_COLUMNS if c != "images"]
    return f"SELECT {', '.join(cols)}, o_orderkey FROM {src} WHERE {_SCRAPED_KEYS}"


@query(
    "upsert_same_hash",
    O.with_bronze()
    + O.silver_block("a_", _STORED_KEYS)
    + f", rescraped AS ({_rescrape_select('bronze')})"
    + O.silver_block("b_", None, src="rescraped")
    + O.guarded_merge("a_listings", "b_listings", "merged")
    + "SELECT * FROM merged",
)
def upsert_same_hash(spark, sf_dir):
    """O22 in all its branches: kept and inserted keys, stale rows, and rows as new or newer
    with the same hash (only row_hash and scraped_at are refreshed; the title stays as
    stored) or another one (the whole row is replaced)."""
    from strata.session import materialize

    stored = materialize(_silver(spark, sf_dir, _STORED_KEYS).listings)
    rescraped = spark.sql(_rescrape_select("{bronze}"), bronze=_bronze(spark, sf_dir))
    batch = silver.transform_to_silver(rescraped, tiebreak=["o_orderkey"]).listings
    return merge.upsert_hash_guarded(stored, batch)


def _hoods_sql_with_time(src: str, ts: str) -> str:
    return f"SELECT neighbourhood, city, walk_score, transit_score, bike_score, {O.ts_lit(ts)} AS loaded_at FROM {src}"


_STORED_HOODS = "neighbourhood NOT LIKE '%A'"  # these are new in the batch
_SCRAPED_HOODS = "neighbourhood NOT LIKE '%E'"  # and these are absent from it


@query(
    "upsert_overwrite",
    O.with_bronze()
    + O.silver_block("a_", OLDER)
    + O.silver_block("b_", NEWER)
    + f", stored AS ({_hoods_sql_with_time('a_hoods', T1)} WHERE {_STORED_HOODS})"
    + f", incoming AS ({_hoods_sql_with_time('b_hoods', T2)} WHERE {_SCRAPED_HOODS})"
    + " SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.neighbourhood = s.neighbourhood "
    "AND i.city = s.city) UNION ALL SELECT * FROM incoming",
)
def upsert_overwrite(spark, sf_dir):
    """Neighbourhoods of the newer batch overwrite (nulls included), loaded_at = T2; keys
    absent from it stay, new ones are added."""
    from strata.session import materialize

    empty = spark.createDataFrame([], R.spark_schema(R.NEIGHBOURHOODS))
    stored = materialize(merge.upsert_overwrite(empty, _silver(spark, sf_dir, OLDER).neighbourhoods.where(_STORED_HOODS), batch_ts=T1))
    return merge.upsert_overwrite(stored, _silver(spark, sf_dir, NEWER).neighbourhoods.where(_SCRAPED_HOODS), batch_ts=T2)


# ------------------------------------------------------------------ SCD2

CUTOFFS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-03-01 00:00:00")  # the last is after all events
EVENT_KEYS = ("user_id", "event_type")
EVENT_COLS = ("user_id", "event_type", "value", "state", "ts")


def _event_state(events: DataFrame) -> DataFrame:
    return events.withColumn("state", F.floor(F.col("value") / 25).cast("int"))


def _scd2_snapshot_sql() -> str:
    cut = " UNION ALL ".join(f"SELECT TIMESTAMP '{c}' AS cutoff" for c in CUTOFFS)
    key = "CAST(user_id AS VARCHAR) || '~' || event_type"
    return (
        f"WITH cut AS ({cut}),\n"
        "ev AS (SELECT *, CAST(floor(value / 25) AS INTEGER) AS state FROM events),\n"
        "st AS (SELECT c.cutoff, e.user_id, e.event_type, e.value, e.state, e.ts, row_number() OVER "
        "(PARTITION BY c.cutoff, e.user_id, e.event_type ORDER BY e.ts DESC, e.event_id DESC) AS rn "
        "FROM cut c JOIN ev e ON e.ts < c.cutoff),\n"
        "s AS (SELECT * FROM st WHERE rn = 1),\n"
        "ch AS (SELECT *, lag(state) OVER (PARTITION BY user_id, event_type ORDER BY cutoff) AS prev_state, "
        "row_number() OVER (PARTITION BY user_id, event_type ORDER BY cutoff) AS k FROM s),\n"
        "v AS (SELECT * FROM ch WHERE k = 1 OR state IS DISTINCT FROM prev_state)\n"
        f"SELECT user_id, event_type, value, state, ts, {O.scd_id_sql(key, 'cutoff')} AS scd_id, "
        "cutoff AS updated_at, cutoff AS valid_from, "
        "lead(cutoff) OVER (PARTITION BY user_id, event_type ORDER BY cutoff) AS valid_to FROM v"
    )


@query("scd2_snapshot", _scd2_snapshot_sql())
def scd2_snapshot(spark, sf_dir):
    """O24 run three times: the (user, event type) state at three times, the last after all events."""
    from strata.session import materialize

    events = _event_state(fixtures.table(spark, sf_dir, "events"))
    history = None
    for i, cutoff in enumerate(CUTOFFS):
        state = silver.keep_latest(
            events.where(F.col("ts") < as_timestamp(cutoff)), list(EVENT_KEYS), order_by=["ts", "event_id"], tiebreak=[]
        ).select(*EVENT_COLS)
        history = scd2.scd2_snapshot(history, state, key_cols=EVENT_KEYS, check_cols=["state"], batch_ts=cutoff)
        if i < len(CUTOFFS) - 1:
            history = materialize(history, "history")  # each run's result is a stored version
    return history


def _scd2_log_sql() -> str:
    key = "CAST(user_id AS VARCHAR) || '~' || event_type"
    return (
        "WITH ev AS (SELECT *, CAST(floor(value / 25) AS INTEGER) AS state FROM events),\n"
        "l AS (SELECT *, lag(state) OVER w AS prev_state, row_number() OVER w AS k FROM ev "
        "WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),\n"
        "c AS (SELECT * FROM l WHERE k = 1 OR state IS DISTINCT FROM prev_state)\n"
        f"SELECT user_id, event_type, value, state, ts, {O.scd_id_sql(key, 'ts')} AS scd_id, "
        "ts AS updated_at, ts AS valid_from, "
        "lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS valid_to FROM c"
    )


@query("scd2_from_log", _scd2_log_sql())
def scd2_from_log(spark, sf_dir):
    """The whole event log as SCD2 history in one pass (per-day chunks per key)."""
    events = _event_state(fixtures.table(spark, sf_dir, "events"))
    hist = scd2.scd2_from_log(
        events, key_cols=EVENT_KEYS, ts_col="ts", check_cols=["state"], columns=EVENT_COLS, tiebreak=["event_id"]
    )
    return hist.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("scd2_append", _scd2_log_sql())
def scd2_append(spark, sf_dir):
    """O25 in two parts: the history of the events before a cut (less late ones), stored, then the
    rest of the log, in which a tenth arrives late, spliced into it."""
    from strata.session import materialize

    events = _event_state(fixtures.table(spark, sf_dir, "events"))
    late = (F.col("ts") >= F.lit(CUTOFFS[1]).cast("timestamp_ntz")) | (F.col("event_id") % 10 == 0)
    how = {"key_cols": EVENT_KEYS, "ts_col": "ts", "check_cols": ["state"], "columns": EVENT_COLS, "tiebreak": ["event_id"]}
    log, part = events.where(~late), events.where(late)
    hist = materialize(scd2.scd2_from_log(log, **how), "history")
    return scd2.scd2_append(hist, log, part, **how).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ------------------------------------------------------------------ gold


def _gold_history_sql(prefix: str = "") -> str:
    return (
        O.with_bronze()
        + O.silver_block("a_", OLDER)
        + O.silver_block("b_", NEWER)
        + O.guarded_merge("a_listings", "b_listings", "merged")
        + O.scd2_two_runs("a_listings", "merged", T1, T2, "hist", gold.HISTORY_COLUMNS, O.LISTING_KEYS)
    )


def _gold_history(spark, sf_dir) -> DataFrame:
    from strata.session import materialize

    older = materialize(_silver(spark, sf_dir, OLDER).listings)  # the stored silver table
    newer = _silver(spark, sf_dir, NEWER).listings
    merged = merge.upsert_hash_guarded(older, newer)
    keys = R.key_columns(R.LISTINGS)
    h1 = materialize(scd2.scd2_snapshot(None, older, key_cols=keys, batch_ts=T1, columns=gold.HISTORY_COLUMNS))
    return scd2.scd2_snapshot(h1, merged, key_cols=keys, batch_ts=T2, columns=gold.HISTORY_COLUMNS)


@query("fact_view", _gold_history_sql() + O.fact_select("hist"))
def fact_view(spark, sf_dir):
    """O29 over two snapshot runs: silver of the older batch at T1, merged silver at T2."""
    return gold.fact_view(_gold_history(spark, sf_dir))


def _dim_sql() -> str:
    sk = "md5(neighbourhood || '~' || city)"
    return (
        O.with_bronze()
        + O.silver_block("a_", HOODS_FIRST)
        + O.silver_block("b_")
        + f", dim AS (SELECT {sk} AS neighbourhood_sk, neighbourhood, city, walk_score, transit_score, bike_score, "
        f"{O.ts_lit(T1)} AS loaded_at FROM a_hoods)"
        + " SELECT * FROM dim UNION ALL "
        f"SELECT {sk}, neighbourhood, city, walk_score, transit_score, bike_score, {O.ts_lit(T2)} FROM b_hoods "
        f"WHERE {sk} NOT IN (SELECT neighbourhood_sk FROM dim)"
    )


def _hoods_loaded(spark, sf_dir, where, ts):
    empty = spark.createDataFrame([], R.spark_schema(R.NEIGHBOURHOODS))
    return merge.upsert_overwrite(empty, _silver(spark, sf_dir, where).neighbourhoods, batch_ts=ts)


@query("dim_insert_only", _dim_sql())
def dim_insert_only(spark, sf_dir):
    """First run loads some neighbourhoods; the second inserts only new keys."""
    from strata.session import materialize

    dim = materialize(gold.dim_insert_only(None, _hoods_loaded(spark, sf_dir, HOODS_FIRST, T1)))
    return gold.dim_insert_only(dim, _hoods_loaded(spark, sf_dir, None, T2))


# Planted violations for the data tests: a duplicated version, nulled hashes, dim gaps.
_DUP = "bedrooms = 4 AND bathrooms = 2 AND furnished"
_NULL_HASH = "bathrooms = 3 AND heat"
_DIM_GAP = "neighbourhood LIKE '%1'"


def _dq_sql() -> str:
    base = _gold_history_sql() + f", fact0 AS ({O.fact_select('hist')})"
    fact = (
        ", fact1 AS (SELECT * REPLACE (CASE WHEN " + _NULL_HASH + " THEN NULL ELSE row_hash END AS row_hash) "
        "FROM fact0 UNION ALL SELECT * FROM fact0 WHERE " + _DUP + ")"
    )
    dim = (
        O.silver_block("d_")
        + ", dim AS (SELECT md5(neighbourhood || '~' || city) AS neighbourhood_sk, neighbourhood, city, "
        f"{O.ts_lit(T1)} AS loaded_at FROM d_hoods WHERE NOT ({_DIM_GAP}))"
    )
    nn = lambda model, src, cols: " UNION ALL ".join(
        f"SELECT 'not_null' AS test, '{model}' AS model, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {src}"
        for c in cols
    )
    uq = lambda model, src, c: (
        f"SELECT 'unique', '{model}', '{c}', CAST(count(*) AS BIGINT) FROM "
        f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    )
    return (
        base + fact + dim + "\n"
        + nn("fct_rental_listings", "fact1", ["scd_id", "listing_id", "website", "row_hash", "scraped_at", "valid_from"])
        + " UNION ALL " + uq("fct_rental_listings", "fact1", "scd_id")
        + " UNION ALL SELECT 'relationships', 'fct_rental_listings', 'neighbourhood_sk', CAST(count(*) AS BIGINT) "
        "FROM fact1 f WHERE f.neighbourhood_sk IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM dim d WHERE d.neighbourhood_sk = f.neighbourhood_sk)"
        + " UNION ALL SELECT 'unique_combination', 'fct_rental_listings', 'listing_id,website,valid_from', "
        "CAST(count(*) AS BIGINT) FROM (SELECT listing_id, website, valid_from FROM fact1 "
        "GROUP BY listing_id, website, valid_from HAVING count(*) > 1)"
        + " UNION ALL " + nn("dim_neighbourhoods", "dim", ["neighbourhood_sk", "neighbourhood", "city", "loaded_at"])
        + " UNION ALL " + uq("dim_neighbourhoods", "dim", "neighbourhood_sk")
    )


@query("dq_checks", _dq_sql())
def dq_checks(spark, sf_dir):
    """O28a-d: the gold tests over a fact with a duplicated version and nulled hashes and a
    dimension with gaps; one row per test with its failure count."""
    from strata.session import materialize

    # the tested tables are stored tables in a real run: compute each once
    fact0 = materialize(gold.fact_view(_gold_history(spark, sf_dir)))
    fact = fact0.withColumn("row_hash", F.when(F.expr(_NULL_HASH), F.lit(None)).otherwise(F.col("row_hash")))
    fact = fact.unionByName(fact0.where(F.expr(_DUP)))
    hoods = _silver(spark, sf_dir).neighbourhoods.where(~F.expr(_DIM_GAP))
    dim = gold.dim_rows(hoods).select("neighbourhood_sk", "neighbourhood", "city", as_timestamp(T1).alias("loaded_at"))
    return checks.gold_tests(fact, materialize(dim))


_GATE_NULL = "bedrooms = 0 AND bathrooms = 1"


def _gate_sql() -> str:
    required = [c.name for c in R.LISTINGS if not c.nullable]
    body = O.with_bronze() + O.silver_block("b_")
    batch = f", batch AS (SELECT * REPLACE (CASE WHEN {_GATE_NULL} THEN NULL ELSE url END AS url) FROM b_listings)"
    parts = [
        f"SELECT 'not_null' AS test, 'rental_listings' AS model, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM batch"
        for c in required
    ]
    parts.append(
        "SELECT 'primary_key', 'rental_listings', 'listing_id,website', CAST(count(*) AS BIGINT) FROM "
        "(SELECT listing_id, website FROM batch GROUP BY listing_id, website HAVING count(*) > 1)"
    )
    return body + batch + " SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE failures > 0"


@query("constraint_gate", _gate_sql())
def constraint_gate(spark, sf_dir):
    """O28e/O5: what the gate raises on for a batch with planted null URLs."""
    batch = _silver(spark, sf_dir).listings
    batch = batch.withColumn("url", F.when(F.expr(_GATE_NULL), F.lit(None)).otherwise(F.col("url")))
    violations = checks.constraint_violations(batch, R.LISTINGS, "rental_listings")
    try:
        checks.gate(violations)
    except checks.GateError as error:
        return spark.createDataFrame([(v["test"], v["model"], v["column_name"], v["failures"]) for v in error.violations], violations.schema)
    return checks.failing(violations)


# ------------------------------------------------------------------ bronze

EVENT_DAYS = ("2024-01-05", "2024-01-06", "2024-01-07")
VIEW_DAY = "2024-01-20"


def _events_partitioned(spark, sf_dir) -> DataFrame:
    ev = fixtures.table(spark, sf_dir, "events")
    return ev.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


def _events_schema(ev: DataFrame):
    from pyspark.sql import types as T

    data = [f for f in ev.schema.fields if f.name not in ("event_type", "dt")]
    return T.StructType(data + [T.StructField("event_type", T.StringType()), T.StructField("dt", T.StringType())])


_EV_COLS = "event_id, ts, user_id, value, props, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt"


@query(
    "bronze_partition_scan",
    f"SELECT {_EV_COLS} FROM events WHERE (event_type = 'click' AND CAST(CAST(ts AS DATE) AS VARCHAR) IN "
    f"({', '.join(repr(d) for d in EVENT_DAYS)})) OR (event_type = 'view' AND CAST(CAST(ts AS DATE) AS VARCHAR) = '{VIEW_DAY}')",
)
def bronze_partition_scan(spark, sf_dir):
    """O2 then O1 + O31: events written by (event_type, dt); one type over three days and
    another type's single day are read back with partition pruning and unioned."""
    from strata.session import workspace

    ev = _events_partitioned(spark, sf_dir)
    root = workspace(spark, "bronze-events")
    bronze.write_bronze(ev, root, partition_cols=("event_type", "dt"))
    schema = _events_schema(ev)
    clicks = bronze.read_partitioned(spark, root, schema, event_type="click", dt=list(EVENT_DAYS))
    views = bronze.read_partitioned(spark, root, schema, event_type="view", dt=VIEW_DAY)
    return bronze.union_frames([clicks, views])


@query(
    "bronze_manifest",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, 'last_x_days' AS mode, 30 AS days, "
    "CAST(NULL AS DATE) AS specific_date, 10 AS max_pages, count(*) AS record_count, "
    f"{O.ts_lit(T1)} AS saved_at FROM events GROUP BY ALL",
)
def bronze_manifest(spark, sf_dir):
    """O3: manifest per (event_type, day) partition; also written as JSON beside the data."""
    from strata.session import materialize, workspace

    ev = _events_partitioned(spark, sf_dir)
    man = bronze.manifest(
        ev, mode=R.MODE_LAST_DAYS, days=30, max_pages=10, saved_at=T1, partition_cols=("event_type", "dt")
    )
    man = materialize(man, "manifest-rows")  # written as JSON and returned: compute once
    bronze.write_manifest(man, workspace(spark, "manifest"), partition_cols=("event_type", "dt"))
    return man


@query(
    "bronze_wanted_scan",
    f"WITH d AS (SELECT {_EV_COLS} FROM events), busiest AS (SELECT event_type, max(dt) AS dt FROM d GROUP BY event_type) "
    "SELECT d.* FROM d JOIN busiest b ON b.event_type = d.event_type AND b.dt = d.dt",
)
def bronze_wanted_scan(spark, sf_dir):
    """O1 + O4 with a computed selector: of each event type the last day that its manifest names
    is read back; the join prunes the scan while it runs."""
    from strata.session import workspace

    ev, keys = _events_partitioned(spark, sf_dir), ("event_type", "dt")
    root = workspace(spark, "bronze-wanted")
    bronze.write_bronze(ev, root, partition_cols=keys)
    bronze.write_manifest(bronze.manifest(ev, mode=R.MODE_LAST_DAYS, days=30, max_pages=10, saved_at=T1, partition_cols=keys), root, partition_cols=keys)
    last = bronze.read_manifest(spark, root, keys).groupBy("event_type").agg(F.max("dt").alias("dt"))
    return bronze.read_wanted(spark, root, last, _events_schema(ev), keys)


SELECTOR_TODAY = "2024-02-02"
SELECTOR_TYPES = ("click", "view", "purchase", "signup", "error", "refund")


@query(
    "partition_selector",
    "WITH wanted AS (SELECT 'events' AS source, t.event_type, "
    f"CAST(CAST(DATE '{SELECTOR_TODAY}' - CAST(r.range AS INTEGER) AS DATE) AS VARCHAR) AS dt, r.range AS rank "
    "FROM range(7) r, (VALUES " + ", ".join(f"('{t}')" for t in SELECTOR_TYPES) + ") t(event_type)), "
    "counts AS (SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n FROM events GROUP BY ALL) "
    "SELECT w.source, w.event_type, w.dt, w.rank, coalesce(c.n, 0) AS record_count, "
    "CASE WHEN c.n IS NULL THEN 'completed_no_data' ELSE 'success' END AS status "
    "FROM wanted w LEFT JOIN counts c ON c.event_type = w.event_type AND c.dt = w.dt",
)
def partition_selector(spark, sf_dir):
    """O4 + O33: last 7 days up to a reference date x event types (one without data),
    left-joined to the partition counts; empty partitions report completed_no_data."""
    wanted = bronze.wanted_partitions(
        spark, source="events", cities=SELECTOR_TYPES, mode=R.MODE_LAST_DAYS, days=7, today=SELECTOR_TODAY
    ).withColumnRenamed("city", "event_type")
    dates = sorted(bronze.wanted_dates(mode=R.MODE_LAST_DAYS, days=7, today=SELECTOR_TODAY))
    # the wanted days as a bound on the time itself, which reaches the scan
    inside = (F.col("ts") >= F.lit(dates[0]).cast("timestamp_ntz")) & (F.col("ts") < F.date_add(F.lit(dates[-1]).cast("date"), 1).cast("timestamp_ntz"))
    return metrics.coverage(_events_partitioned(spark, sf_dir).where(inside), wanted, ["event_type", "dt"])


@query("manifest_coverage", ORACLE["partition_selector"])
def manifest_coverage(spark, sf_dir):
    """O3 + O4 + O33: the coverage of wanted partitions from the stored manifest of a bronze layer;
    none of its data is read."""
    from strata.session import workspace

    ev, keys = _events_partitioned(spark, sf_dir), ("event_type", "dt")
    root = workspace(spark, "manifest-coverage")
    bronze.write_manifest(bronze.manifest(ev, mode=R.MODE_LAST_DAYS, days=30, max_pages=10, saved_at=T1, partition_cols=keys), root, partition_cols=keys)
    wanted = bronze.wanted_partitions(
        spark, source="events", cities=SELECTOR_TYPES, mode=R.MODE_LAST_DAYS, days=7, today=SELECTOR_TODAY
    ).withColumnRenamed("city", "event_type")
    return metrics.coverage_of(bronze.read_manifest(spark, root, keys), wanted, list(keys))


# ------------------------------------------------------------------ pages

_PAGE_ITEMS_SQL = (
    "WITH p AS (SELECT o_orderkey // 40 AS page_id, o_orderkey, row_number() OVER "
    "(PARTITION BY o_orderkey // 40 ORDER BY o_orderkey) AS position FROM orders), "
    "items AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'toronto' WHEN 1 THEN 'vancouver' ELSE 'london' END AS city, "
    f"position, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '{fixtures.LISTING_URL}' || CAST(o_orderkey AS VARCHAR) END AS url "
    "FROM p WHERE position > 6 AND page_id % 17 <> 0 AND page_id % 19 <> 0) "
)


@query("jsonld_results", _PAGE_ITEMS_SQL + "SELECT * FROM items")
def jsonld_results(spark, sf_dir):
    """O8a + O8b: organic items of JSON-LD search pages built from orders (first six of each
    page skipped; pages without or with broken JSON-LD give nothing)."""
    return pages.search_items(fixtures.search_pages(spark, sf_dir))


@query(
    "search_page_summary",
    _PAGE_ITEMS_SQL
    + "SELECT page_id, count(*) AS organic_items, count(url) AS parsed, count(*) - count(url) AS failed "
    "FROM items GROUP BY page_id",
)
def search_page_summary(spark, sf_dir):
    """Per page, organic items, items with a URL and failures."""
    return pages.page_summary(pages.search_items(fixtures.search_pages(spark, sf_dir)))


_BAD_CITY_SQL = "WHEN o_custkey % 31 = 0 THEN 'bad_city' "
_REASON_SQL = (
    "CASE WHEN o_orderkey % 211 = 0 THEN 'no_state_script' "
    "WHEN o_orderkey % 223 = 0 THEN 'invalid_document' "
    "WHEN o_orderkey % 101 = 0 THEN 'no_listing_id' "
    "WHEN o_orderkey % 227 = 0 THEN 'no_listing_data' "
    "WHEN o_orderkey % 113 = 0 OR o_orderkey % 149 = 0 THEN 'bad_attributes' "
    "WHEN o_orderkey % 103 = 0 THEN 'missing_required' "
    "WHEN o_orderkey % 229 = 0 THEN 'bad_url' "
    "WHEN o_orderkey % 4 = 2 THEN 'bad_published_at' "
    + _BAD_CITY_SQL
    + "WHEN o_orderkey % 107 = 0 OR o_orderkey % 131 = 0 THEN 'bad_rent' "
    "WHEN o_orderkey % 233 = 0 THEN 'bad_count' "
    "WHEN o_orderkey % 157 = 0 THEN 'bad_number' "
    "WHEN c_custkey % 7 <> 0 AND (c_acctbal / 1000 < 0 OR c_acctbal / 1000 > 10) THEN 'bad_score' END"
)
_DETAIL_ROWS = (
    "WITH r AS (SELECT * FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey), "
    f"x AS (SELECT *, {_REASON_SQL} AS reject_reason FROM r) "
)
_IMG = "'https://img.example.com/' || CAST(o_orderkey AS VARCHAR) || '/{i}.jpg'"


def _extract_sql() -> str:
    vals = {
        "listing_id": "CAST(o_orderkey AS VARCHAR)",
        "url": f"'{fixtures.LISTING_URL}' || CAST(o_orderkey AS VARCHAR)",
        "website": "'example'",
        "published_at": "CAST(o_orderdate AS TIMESTAMP)",
        "title": "'Listing ' || CAST(o_orderkey AS VARCHAR)",
        "description": "'Order ' || o_orderstatus || ' for ' || c_name",
        "street": "CAST(o_custkey AS VARCHAR) || ' Main St'",
        "city": "CASE o_custkey % 3 WHEN 0 THEN 'toronto' WHEN 1 THEN 'vancouver' ELSE 'london' END",
        "neighbourhood": "CASE WHEN c_custkey % 7 <> 0 THEN n_name END",
        "rent": "CASE WHEN o_totalprice > 100 AND o_orderkey % 109 <> 0 THEN o_totalprice / 100 ELSE o_totalprice END",
        "move_in_date": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
        "bedrooms": "CAST(CASE WHEN o_orderkey % 9 = 0 THEN 7 ELSE o_orderkey % 5 END AS INTEGER)",
        "bathrooms": "CAST(o_custkey % 3 + 1 AS INTEGER)",
        "size_sqft": "CAST(o_custkey % 2000 + 300 AS DOUBLE)",
        "unit_type": "CASE WHEN o_custkey % 2 = 0 THEN 'Apartment' ELSE 'Condo' END",
        "furnished": "CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
        "latitude": "CAST(o_custkey % 50 AS DOUBLE) + 40.5",
        "longitude": "CAST(o_orderkey % 110 AS DOUBLE) - 150.0",
        "walk_score": "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 1000 END",
        "transit_score": "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 2000 END",
        "bike_score": "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 3000 END",
        "images": f"CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN {_IMG.format(i=1)} "
        f"ELSE {_IMG.format(i=1)} || '|' || {_IMG.format(i=2)} END",
        "heat": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Included' END",
        "water": "'Not Included'",
        "parking_included": "'Yes'",
        "scraped_at": O.ts_lit(NOW),
    }
    cols = []
    for name in R.BRONZE_COLUMNS:
        cols.append(f"{vals.get(name, 'CAST(NULL AS VARCHAR)')} AS {name}")
    return _DETAIL_ROWS + f"SELECT {', '.join(cols)} FROM x WHERE reject_reason IS NULL"


def _extracted(spark, sf_dir):
    ex = pages.extract_listings(fixtures.detail_pages(spark, sf_dir), website="example", scraped_at=NOW, now=NOW)
    return pages.split(ex)


@query("listing_pages_extract", _extract_sql())
def listing_pages_extract(spark, sf_dir):
    """O8c-O8h: listing pages (state script -> record) back to bronze rows; images joined
    with '|' for the comparison."""
    good, _ = _extracted(spark, sf_dir)
    return good.withColumn("images", F.array_join("images", "|"))


SCRAPE_DAYS = 12_200


def _scrape_sql() -> str:
    """A listing's city is that of the search page; the page's own city does not matter."""
    select = _extract_sql().split(") SELECT ", 1)[1].rsplit(" FROM x WHERE", 1)[0]
    own = "CASE o_custkey % 3 WHEN 0 THEN 'toronto' WHEN 1 THEN 'vancouver' ELSE 'london' END AS city"
    if select.count(own) != 1:
        raise ValueError("the city column of the extraction oracle has changed")
    select = select.replace(own, "i.city AS city")
    return (
        _PAGE_ITEMS_SQL
        + ", "
        + _DETAIL_ROWS[len("WITH ") :].replace(_BAD_CITY_SQL, "")
        + f"SELECT {select}, 'example' AS source, '{NOW[:10]}' AS dt FROM x "
        f"JOIN items i ON i.url = '{fixtures.LISTING_URL}' || CAST(x.o_orderkey AS VARCHAR) "
        f"WHERE x.reject_reason IS NULL AND CAST(x.o_orderdate AS TIMESTAMP) >= {O.ts_lit(NOW)} - INTERVAL {SCRAPE_DAYS} DAY"
    )


@query("scrape_to_bronze", _scrape_sql())
def scrape_to_bronze(spark, sf_dir):
    """O30 (first layer) with O2, O3, O8-O10: search pages -> organic items -> listing
    pages -> records -> date filter -> bronze partitions (source, city, run date) plus the
    manifest; the written partition is read back with pruning."""
    from strata.plans import layers
    from strata.session import workspace

    root = workspace(spark, "scrape")
    details = fixtures.detail_pages(spark, sf_dir)
    twice = details.unionByName(details.where(F.col("url").endswith("7")))  # URLs stored twice count once
    layers.scrape_to_bronze(
        spark, fixtures.search_pages(spark, sf_dir), twice, root=root,
        source="example", mode=R.MODE_LAST_DAYS, days=SCRAPE_DAYS, now=NOW,
    )
    out = bronze.read_bronze(spark, root, source="example", dates=[NOW[:10]])
    return out.withColumn("images", F.array_join("images", "|"))


@query(
    "listing_pages_rejects",
    _DETAIL_ROWS + "SELECT reject_reason, count(*) AS n FROM x WHERE reject_reason IS NOT NULL GROUP BY ALL",
)
def listing_pages_rejects(spark, sf_dir):
    """O8i: rejected pages by first failed rule."""
    _, bad = _extracted(spark, sf_dir)
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "raw_pages_script",
    r"SELECT page_id, NULLIF(regexp_extract(html, '(?is)<script\b[^>]*>(.*?)</script>', 1), '') AS script FROM pages",
)
def raw_pages_script(spark, sf_dir):
    """O8a pattern on raw web pages: body of the first script element (whole HTML scanned)."""
    p = fixtures.table(spark, sf_dir, "pages")
    return p.select("page_id", pages.first_script("html").alias("script"))


_NUM_TEXT_SQL = (
    "SELECT p_partkey, p_size, p_retailprice, "
    "CASE p_partkey % 5 WHEN 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) "
    "WHEN 1 THEN ' ' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) || ' ' "
    "WHEN 2 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) || ' CAD' "
    "WHEN 3 THEN 'N/A' ELSE '$1,' || lpad(CAST(p_size AS STRING), 3, '0') || '.50' END AS price_text, "
    "CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS STRING) || ' sqft' "
    "WHEN 1 THEN '1,' || lpad(CAST(p_size AS STRING), 3, '0') || ' sqft' "
    "WHEN 2 THEN 'Unit #' || CAST(p_size AS STRING) WHEN 3 THEN 'no digits here' END AS size_text "
    "FROM {part}"
)


@query(
    "parse_numbers",
    "SELECT p_partkey, price_text, size_text, "
    "CASE p_partkey % 5 WHEN 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) "
    "WHEN 1 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) WHEN 4 THEN CAST(1000 + p_size AS DOUBLE) + 0.5 END AS price, "
    "CAST(CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN 1000 + p_size WHEN 2 THEN p_size END AS INTEGER) AS size "
    "FROM (" + _NUM_TEXT_SQL.format(part="part") + ")",
)
def parse_numbers(spark, sf_dir):
    """O8h: float after dropping ',' and '$'; int from all digits of the text."""
    texts = spark.sql(_NUM_TEXT_SQL, part=fixtures.table(spark, sf_dir, "part"))
    return texts.select(
        "p_partkey", "price_text", "size_text",
        parse_float("price_text").alias("price"), parse_int("size_text").alias("size"),
    )


_ISO_TEXT_SQL = (
    "SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5 "
    "WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:03:15.000Z' "
    "WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:00:00+00:00' "
    "WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
    "WHEN 3 THEN 'not-a-date' "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:00:00-05:00' END AS text FROM {orders}"
)


@query(
    "parse_iso",
    "SELECT o_orderkey, text, CASE o_orderkey % 5 "
    "WHEN 0 THEN o_orderdate + INTERVAL 8 HOUR + INTERVAL 3 MINUTE + INTERVAL 15 SECOND "
    "WHEN 1 THEN o_orderdate + INTERVAL 10 HOUR WHEN 2 THEN o_orderdate "
    "WHEN 4 THEN o_orderdate + INTERVAL 15 HOUR END AS parsed, "
    "o_orderkey % 5 IN (0, 1, 4) AS zone_aware FROM (" + _ISO_TEXT_SQL.format(orders="orders") + ")",
)
def parse_iso(spark, sf_dir):
    """O8g: ISO text with 'Z', an offset or no zone, plus garbage, to UTC timestamps."""
    from strata.functions import parse_iso as piso

    texts = spark.sql(_ISO_TEXT_SQL, orders=fixtures.table(spark, sf_dir, "orders"))
    return texts.select("o_orderkey", "text", piso("text").alias("parsed"), has_offset("text").alias("zone_aware"))


FILTER_NOW = "2024-01-31 00:00:00"
FILTER_DAY = "2024-01-15"


@query(
    "date_filter_last_days",
    f"SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '{FILTER_NOW}' - INTERVAL 7 DAY",
)
def date_filter_last_days(spark, sf_dir):
    """O9 LAST_X_DAYS: events published in the 7 days before a fixed now."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return pages.filter_published(ev, mode=R.MODE_LAST_DAYS, now=FILTER_NOW, days=7, col="ts")


@query(
    "date_filter_specific",
    f"SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '{FILTER_DAY} 00:00:00' "
    f"AND ts <= TIMESTAMP '{FILTER_DAY} 23:59:59.999999'",
)
def date_filter_specific(spark, sf_dir):
    """O9 SPECIFIC_DATE: the whole UTC day, both ends included."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return pages.filter_published(ev, mode=R.MODE_SPECIFIC_DATE, specific_date=FILTER_DAY, col="ts")


# ------------------------------------------------------------------ run metrics

RUN_SOURCE = "1-urgent"
RUN_TODAY = "1998-08-02"
RUN_DAYS = 60
RUN_CITIES = ("household", "furniture", "machinery", "building", "automobile", "nowhere")


def _run_metrics_sql() -> str:
    keyvalid = f"{O.nonblank('listing_id')} AND {O.nonblank('website')}"
    return (
        O.with_bronze()
        + ", p AS (SELECT *, website AS source, lower(city) AS pcity, CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS dt "
        "FROM bronze)"
        + ", wanted AS (SELECT '" + RUN_SOURCE + "' AS source, c.city, "
        f"CAST(CAST(DATE '{RUN_TODAY}' - CAST(r.range AS INTEGER) AS DATE) AS VARCHAR) AS dt "
        f"FROM range({RUN_DAYS}) r, (VALUES " + ", ".join(f"('{c}')" for c in RUN_CITIES) + ") c(city))"
        + f", reads AS (SELECT source, pcity AS city, dt, count(*) AS rows_read, count(*) FILTER (WHERE {keyvalid}) "
        "AS rows_valid FROM p GROUP BY ALL)"
        + ", ranked AS (SELECT source, pcity AS city, dt, "
        + O.strip("neighbourhood") + " AS nb, " + O.lower_strip("city") + " AS ncity, "
        "row_number() OVER (PARTITION BY source, pcity, dt, listing_id, website ORDER BY scraped_at DESC NULLS LAST, "
        f"o_orderkey) AS rn FROM p WHERE {keyvalid})"
        + ", loads AS (SELECT source, city, dt, count(*) AS rows_loaded, "
        "count(DISTINCT [nb, ncity]) FILTER (WHERE nb IS NOT NULL AND ncity IS NOT NULL) AS hoods "
        "FROM ranked WHERE rn = 1 GROUP BY ALL)"
        + ", m AS (SELECT w.source, w.city, w.dt, coalesce(r.rows_read, 0) AS rows_read, "
        "coalesce(l.rows_loaded, 0) AS rows_loaded, coalesce(l.hoods, 0) AS neighbourhoods_loaded, "
        "coalesce(r.rows_read - r.rows_valid, 0) AS dropped_invalid_key, "
        "coalesce(r.rows_valid - coalesce(l.rows_loaded, 0), 0) AS dropped_duplicate, "
        "CASE WHEN r.rows_read IS NULL THEN 'completed_no_data' ELSE 'success' END AS status "
        "FROM wanted w LEFT JOIN reads r ON r.source = w.source AND r.city = w.city AND r.dt = w.dt "
        "LEFT JOIN loads l ON l.source = w.source AND l.city = w.city AND l.dt = w.dt) "
    )


def _run_metrics(spark, sf_dir) -> DataFrame:
    from strata.functions import strip, strip_lower

    b = _bronze(spark, sf_dir).withColumns(
        {"source": F.col("website"), "city": F.lower("city"), "dt": F.date_format("scraped_at", "yyyy-MM-dd")}
    )
    dates = bronze.wanted_dates(mode=R.MODE_LAST_DAYS, days=RUN_DAYS, today=RUN_TODAY)
    b = b.where((F.col("source") == RUN_SOURCE) & F.col("dt").isin(dates))
    wanted = bronze.wanted_partitions(
        spark, source=RUN_SOURCE, cities=RUN_CITIES, mode=R.MODE_LAST_DAYS, days=RUN_DAYS, today=RUN_TODAY
    ).drop("rank")
    return metrics.partition_metrics(
        b, wanted,
        entity_clean={"neighbourhood": strip("neighbourhood"), "city": strip_lower("city")},
        tiebreak=["o_orderkey"],
    )


@query("run_metrics", _run_metrics_sql() + "SELECT * FROM m")
def run_metrics(spark, sf_dir):
    """Per (source, city, day) partition of a 60-day run: rows read, loaded,
    neighbourhoods, drops by key and by dedup; wanted partitions without data flagged."""
    return _run_metrics(spark, sf_dir)


def _all_metrics_sql() -> str:
    """Every partition of the table; a kept row without title makes its partition an error."""
    keyvalid = f"{O.nonblank('listing_id')} AND {O.nonblank('website')}"
    return (
        O.with_bronze()
        + ", p AS (SELECT * REPLACE (CASE WHEN o_orderkey % 1009 = 0 THEN NULL ELSE title END AS title), website AS source, "
        "lower(city) AS pcity, CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS dt FROM bronze)"
        + f", reads AS (SELECT source, pcity AS city, dt, count(*) AS n, count(*) FILTER (WHERE {keyvalid}) AS valid FROM p GROUP BY ALL)"
        + ", ranked AS (SELECT source, pcity AS city, dt, title, " + O.strip("neighbourhood") + " AS nb, " + O.lower_strip("city") + " AS ncity, "
        "row_number() OVER (PARTITION BY source, pcity, dt, listing_id, website ORDER BY scraped_at DESC NULLS LAST, o_orderkey) AS rn "
        f"FROM p WHERE {keyvalid})"
        + ", loads AS (SELECT source, city, dt, count(*) AS kept, bool_or(title IS NULL) AS bad, "
        "count(DISTINCT [nb, ncity]) FILTER (WHERE nb IS NOT NULL AND ncity IS NOT NULL) AS hoods FROM ranked WHERE rn = 1 GROUP BY ALL)"
        " SELECT r.source, r.city, r.dt, r.n AS rows_read, CASE WHEN coalesce(bad, FALSE) THEN 0 ELSE coalesce(kept, 0) END AS rows_loaded, "
        "CASE WHEN coalesce(bad, FALSE) THEN 0 ELSE coalesce(hoods, 0) END AS neighbourhoods_loaded, r.n - r.valid AS dropped_invalid_key, "
        "r.valid - coalesce(kept, 0) AS dropped_duplicate, CASE WHEN coalesce(bad, FALSE) THEN 'error' ELSE 'success' END AS status "
        "FROM reads r LEFT JOIN loads l ON l.source IS NOT DISTINCT FROM r.source AND l.city IS NOT DISTINCT FROM r.city AND l.dt IS NOT DISTINCT FROM r.dt"
    )


@query("run_metrics_all", _all_metrics_sql())
def run_metrics_all(spark, sf_dir):
    """O33 over every partition of the bronze view, with partitions that fail a constraint."""
    from strata.functions import strip, strip_lower

    b = _bronze(spark, sf_dir).withColumns({
        "source": F.col("website"), "city": F.lower("city"), "dt": F.date_format("scraped_at", "yyyy-MM-dd"),
        "title": F.when(F.col("o_orderkey") % 1009 != 0, F.col("title")),
    })
    return metrics.partition_metrics(
        b, entity_clean={"neighbourhood": strip("neighbourhood"), "city": strip_lower("city")}, tiebreak=["o_orderkey"], required=["title"],
    )


@query("table_from_ddl", O.silver_ctes() + "SELECT neighbourhood, city, walk_score, transit_score, bike_score, TRUE AS loaded FROM hoods")
def table_from_ddl(spark, sf_dir):
    """The neighbourhoods table is made by the generated DDL as it stands, filled without
    its managed column (the column's default fills it) and read back."""
    import uuid

    name = f"neighbourhoods_{uuid.uuid4().hex}"
    spark.sql(R.ddl(R.NEIGHBOURHOODS, name))
    cols = R.names(R.NEIGHBOURHOODS)
    frame = _silver(spark, sf_dir).neighbourhoods.select(*cols)
    spark.sql(f"INSERT INTO {name} ({', '.join(cols)}) SELECT * FROM {{rows}}", rows=frame)
    return spark.table(name).select(*cols, F.col("loaded_at").isNotNull().alias("loaded"))


@query(
    "named_sources",
    O.silver_ctes() + "SELECT h.neighbourhood, h.city, count(l.listing_id) AS listings, min(l.rent) AS least_rent FROM hoods h "
    "LEFT JOIN listings l ON l.neighbourhood = h.neighbourhood AND l.city = h.city GROUP BY ALL",
)
def named_sources(spark, sf_dir):
    """Stored silver tables registered as named sources and read by name, as frames and as views."""
    from strata.session import workspace
    from strata.sources.tables import Sources, VersionedTable

    frames, root = _silver(spark, sf_dir), workspace(spark, "sources")
    listings = VersionedTable(spark, f"{root}/listings", R.LISTINGS, "rental_listings")
    listings.replace(frames.listings.withColumn("inserted_at", as_timestamp(T1)) if "inserted_at" in R.names(R.LISTINGS, managed=True) else frames.listings)
    sources = Sources({("silver", "rental_listings"): listings, ("silver", "neighbourhoods"): frames.neighbourhoods})
    sources.as_views(spark)
    counted = sources.source("silver", "neighbourhoods").alias("h").join(
        spark.table("silver_rental_listings").alias("l"),
        (F.col("l.neighbourhood") == F.col("h.neighbourhood")) & (F.col("l.city") == F.col("h.city")), "left",
    )
    return counted.groupBy("h.neighbourhood", "h.city").agg(F.count("l.listing_id").alias("listings"), F.min("l.rent").alias("least_rent"))


@query(
    "run_rollup",
    _run_metrics_sql()
    + ", t AS (SELECT sum(rows_read) AS total_read, sum(rows_loaded) AS total_loaded, "
    "sum(neighbourhoods_loaded) AS total_neighbourhoods_loaded, "
    "count(*) FILTER (WHERE status = 'success') AS partitions_ok, "
    "count(*) FILTER (WHERE status = 'error') AS partitions_error, "
    "count(*) FILTER (WHERE status = 'completed_no_data') AS partitions_no_data FROM m) "
    "SELECT CASE WHEN partitions_error > 0 THEN 'error' WHEN total_read = 0 THEN 'completed_no_data' "
    "ELSE 'success' END AS status, CAST(total_read AS BIGINT) AS total_read, CAST(total_loaded AS BIGINT) AS total_loaded, "
    "CAST(total_neighbourhoods_loaded AS BIGINT) AS total_neighbourhoods_loaded, partitions_ok, partitions_error, "
    "partitions_no_data FROM t",
)
def run_rollup(spark, sf_dir):
    """Totals over the run's partitions and the overall status."""
    return metrics.rollup(_run_metrics(spark, sf_dir))


@query("run_state_rollup")
def run_state_rollup(spark, sf_dir):
    """O32 from mergeable states: each day's partitions are measured once and stored; totals by city over
    all days come from the stored states (distinct counts are estimates, so there is no SQL)."""
    from strata.functions import strip, strip_lower
    from strata.session import materialize

    b = _bronze(spark, sf_dir).withColumns({"source": F.col("website"), "dt": F.date_format("scraped_at", "yyyy-MM")})
    states = metrics.partition_states(b, entity_clean={"neighbourhood": strip("neighbourhood"), "city": strip_lower("city")})
    return metrics.merge_states(materialize(states, "partition-states"), by=["city"])


# ------------------------------------------------------------------ end to end


#: The cities of the bronze view: the customers' market segments.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("medallion_end_to_end", _gold_history_sql() + O.fact_select("hist"))
def medallion_end_to_end(spark, sf_dir):
    """O30 through files: two bronze drops (older, newer) written partitioned; each run selects its
    partitions, cleans them and merges them into the silver tables, and what changed there
    is snapshotted into gold behind the data tests."""
    from strata.plans import layers
    from strata.session import workspace
    from strata.sources.tables import VersionedTable

    root = workspace(spark, "medallion")
    view = _bronze(spark, sf_dir)
    schema = bronze.bronze_schema(data_schema=view.schema)
    listings = VersionedTable(spark, f"{root}/silver/rental_listings", R.LISTINGS, "rental_listings")
    hoods = VersionedTable(spark, f"{root}/silver/neighbourhoods", R.NEIGHBOURHOODS, "neighbourhoods")
    history = layers.History(spark, f"{root}/gold/listing_history")
    dim = VersionedTable(spark, f"{root}/gold/dim_neighbourhoods", layers.DIM_REGISTRY, "dim_neighbourhoods", evolve=True)
    result = None
    for where, ts in ((OLDER, T1), (NEWER, T2)):
        # partition folders are (source, city, dt = the run's scrape date)
        rows = bronze.with_partition_columns(view.where(F.expr(where)), source="example", day=ts[:10])
        bronze.write_bronze(rows, f"{root}/bronze")
        layers.bronze_to_silver(
            spark, bronze_root=f"{root}/bronze", listings=listings, neighbourhoods=hoods, source="example", cities=SEGMENTS,
            mode=R.MODE_SPECIFIC_DATE, specific_date=ts[:10], batch_ts=ts, schema=schema, tiebreak=["o_orderkey"],
        )
        result = layers.silver_to_gold(
            spark, listings=listings, neighbourhoods=hoods, history=history, dimension=dim,
            batch_ts=ts,
        )
    return result.fact
