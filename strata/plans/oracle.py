"""DuckDB oracle SQL for the registered queries.

Each statement re-states an operator's semantics in plain SQL over the driver's tables
(registered as views); it shares only the derived input (``fixtures``) with the Spark side.
"""

from __future__ import annotations

from strata import registry as R
from strata.plans import fixtures

# Unicode White_Space, spelled out for RE2 (its \s is ASCII only).
WS = r"[\x{0009}-\x{000D}\x{0020}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lower_strip(x: str) -> str:
    return f"lower({strip(x)})"


def to_bool(x: str) -> str:
    w = lower_strip(x)
    return f"(CASE WHEN {w} IN ('yes', 'included') THEN TRUE WHEN {w} IN ('no', 'not included') THEN FALSE END)"


def bounded(x: str, b: R.Bounds) -> str:
    v = f"TRY_CAST({x} AS DOUBLE)"
    conds = []
    if b.low is not None:
        conds.append(f"{v} {'>' if b.exclusive else '>='} {float(b.low)!r}")
    if b.high is not None:
        conds.append(f"{v} {'<' if b.exclusive else '<='} {float(b.high)!r}")
    if not conds:
        return v
    return f"(CASE WHEN {' AND '.join(conds)} THEN {v} END)"


def nonblank(x: str) -> str:
    return f"({x} IS NOT NULL AND length({strip(f'CAST({x} AS VARCHAR)')}) > 0)"


_DUCK_TYPES = {
    "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE",
    "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def duck_type(dtype) -> str:
    return _DUCK_TYPES[dtype.simpleString()]


def cleaned_select(src: str = "bronze", extra=("o_orderkey",), present=None) -> str:
    """Cleaning projection (strip / lower / boolean / ranges) over the bronze columns."""
    bounds = R.bounded_columns(R.LISTINGS, R.NEIGHBOURHOODS)
    cols = []
    for name in R.BRONZE_COLUMNS:
        spec = next((c for c in R.LISTINGS if c.name == name), None)
        if present is not None and name not in present:
            src_col = "NULL"
        elif name == "images":
            src_col = "NULL"
        else:
            src_col = name
        if name == "images":
            cols.append("CAST(NULL AS VARCHAR[]) AS images")
            continue
        if name in bounds:
            expr = bounded(src_col, bounds[name])
        elif spec is not None and spec.clean == R.CLEAN_STRIP:
            expr = strip(src_col)
        elif spec is not None and spec.clean == R.CLEAN_LOWER:
            expr = lower_strip(src_col)
        elif spec is not None and spec.clean == R.CLEAN_BOOL:
            expr = to_bool(src_col)
        else:
            expr = src_col
        cols.append(f"{expr} AS {name}")
    cols.extend(extra)
    return f"SELECT {', '.join(cols)} FROM {src}"


def text_of(name: str, dtype) -> str:
    return f"coalesce(CAST({name} AS VARCHAR), '')"


def hash_expr() -> str:
    types = {c.name: c.dtype for c in R.LISTINGS}
    # parking_included is hashed as the cleaned double
    parts = [text_of(n, types[n]) for n in R.hashed_columns(R.LISTINGS)]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def listing_columns_typed(src_alias: str = "") -> str:
    p = f"{src_alias}." if src_alias else ""
    out = []
    for c in R.LISTINGS:
        if c.name == "parking_included":
            out.append(f"CAST(round_even({p}parking_included, 0) AS INTEGER) AS parking_included")
        elif c.name in ("published_at", "scraped_at"):
            out.append(f"CAST({p}{c.name} AS TIMESTAMP) AS {c.name}")
        else:
            out.append(f"{p}{c.name} AS {c.name}")
    return ", ".join(out)


def with_bronze(drop=()) -> str:
    return fixtures.bronze_cte(drop)


def silver_block(p: str = "", where: str | None = None, drop=(), src: str = "bronze") -> str:
    """CTEs {p}keyed -> {p}cleaned -> {p}latest -> {p}listings and {p}hoods over ``src``."""
    present = set(R.BRONZE_COLUMNS) - set(drop)
    cond = f"{nonblank('listing_id')} AND {nonblank('website')}"
    if where:
        cond = f"({where}) AND {cond}"
    return (
        f", {p}keyed AS (SELECT * FROM {src} WHERE {cond})\n"
        + f", {p}cleaned AS ({cleaned_select(p + 'keyed', present=present)})\n"
        + f", {p}ranked AS (SELECT *, row_number() OVER (PARTITION BY listing_id, website "
        f"ORDER BY scraped_at DESC NULLS LAST, o_orderkey) AS rn FROM {p}cleaned)\n"
        + f", {p}latest AS (SELECT * EXCLUDE (rn) FROM {p}ranked WHERE rn = 1)\n"
        + f", {p}hashed AS (SELECT *, {hash_expr()} AS row_hash FROM {p}latest)\n"
        + f", {p}listings AS (SELECT {listing_columns_typed()} FROM {p}hashed)\n"
        + f", {p}hood_ranked AS (SELECT neighbourhood, city, walk_score, transit_score, bike_score, "
        "row_number() OVER (PARTITION BY neighbourhood, city ORDER BY scraped_at DESC NULLS LAST, "
        f"listing_id, website) AS rn FROM {p}latest WHERE neighbourhood IS NOT NULL AND city IS NOT NULL)\n"
        + f", {p}hoods AS (SELECT neighbourhood, city, walk_score, transit_score, bike_score "
        f"FROM {p}hood_ranked WHERE rn = 1)\n"
    )


def silver_ctes(drop=()) -> str:
    return with_bronze(drop) + silver_block("", None, drop)


LISTING_COLS = R.names(R.LISTINGS)
LISTING_KEYS = R.key_columns(R.LISTINGS)


def _on(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def guarded_merge(stored: str, batch: str, name: str) -> str:
    """O22 as SQL: full outer join on the key, recency guard, hash-conditional overwrite."""
    accept = "(s.listing_id IS NULL OR (i.listing_id IS NOT NULL AND i.scraped_at >= s.scraped_at))"
    take_new = (
        "(s.listing_id IS NULL OR (i.listing_id IS NOT NULL AND i.scraped_at >= s.scraped_at "
        "AND i.row_hash <> s.row_hash))"
    )
    cols = []
    for c in R.LISTINGS:
        if c.merge == R.MERGE_KEY:
            cols.append(f"coalesce(s.{c.name}, i.{c.name}) AS {c.name}")
        elif c.merge == R.MERGE_ALWAYS:
            cols.append(f"CASE WHEN {accept} THEN i.{c.name} ELSE s.{c.name} END AS {c.name}")
        else:
            cols.append(f"CASE WHEN {take_new} THEN i.{c.name} ELSE s.{c.name} END AS {c.name}")
    return (
        f", {name} AS (SELECT {', '.join(cols)} FROM {stored} s FULL OUTER JOIN {batch} i "
        f"ON {_on('s', 'i', LISTING_KEYS)})\n"
    )


def ts_lit(ts: str) -> str:
    return f"TIMESTAMP '{ts}'"


def scd_id_sql(key: str, ts: str) -> str:
    return f"md5({key} || '|' || CAST(epoch_us({ts}) AS VARCHAR))"


def scd2_two_runs(first: str, second: str, t1: str, t2: str, name: str, columns, keys, check="row_hash") -> str:
    """O24 run twice (first source at t1, second at t2) as SQL."""
    key = " || '~' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    cols = ", ".join(columns)
    hcols = ", ".join(f"h.{c}" for c in columns)
    ncols = ", ".join(f"n.{c}" for c in columns)
    T1, T2 = ts_lit(t1), ts_lit(t2)
    return (
        f", {name}_h1 AS (SELECT {cols}, {scd_id_sql(key, T1)} AS scd_id, {T1} AS updated_at, "
        f"{T1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {first})\n"
        f", {name} AS (SELECT {hcols}, h.scd_id, h.updated_at, h.valid_from, "
        f"CASE WHEN n.{keys[0]} IS NOT NULL AND h.{check} IS DISTINCT FROM n.{check} THEN {T2} END AS valid_to "
        f"FROM {name}_h1 h LEFT JOIN {second} n ON {_on('h', 'n', keys)} "
        f"UNION ALL SELECT {ncols}, {scd_id_sql(key.replace(keys[0], 'n.' + keys[0]).replace(keys[1], 'n.' + keys[1]), T2)}, "
        f"{T2}, {T2}, CAST(NULL AS TIMESTAMP) "
        f"FROM {second} n LEFT JOIN {name}_h1 h ON {_on('h', 'n', keys)} "
        f"WHERE h.{keys[0]} IS NULL OR h.{check} IS DISTINCT FROM n.{check})\n"
    )


def fact_select(hist: str) -> str:
    from strata.operators.gold import HISTORY_COLUMNS

    cols = []
    for c in HISTORY_COLUMNS:
        if c == "city":
            continue
        if c == "neighbourhood":
            cols.append("md5(neighbourhood || '~' || city) AS neighbourhood_sk")
            continue
        cols.append(c)
        if c == "move_in_date":
            cols.append("rent / NULLIF(size_sqft, 0) AS price_per_sqft")
    return (
        f"SELECT scd_id, {', '.join(cols)}, valid_from, valid_to, valid_to IS NULL AS is_current, "
        f"updated_at FROM {hist}"
    )
