"""Slowly-changing history, type 2 (O24 snapshot with a check strategy, O25 from a log).

History layout: the tracked columns, then ``scd_id``, ``updated_at``, ``valid_from``,
``valid_to`` (null while current). ``scd_id = md5(key || '|' || epoch-micros(valid_from))``
where ``key`` is the composite business key ``a || '~' || b``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import as_timestamp, business_key
from strata.operators.sequence import last_per_tie
from strata.session import materialize

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def scd_id(key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", key, F.unix_micros(valid_from.cast("timestamp")).cast("string")))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def scd2_snapshot(
    history: DataFrame | None,
    source: DataFrame,
    *,
    key_cols,
    check_cols=("row_hash",),
    batch_ts,
    columns=None,
    since=None,
    recency_col: str | None = None,
    changes_only: bool = False,
) -> DataFrame:
    """Apply one snapshot run of ``source`` to ``history`` at ``batch_ts``.

    * key not current -> new version (valid_from = updated_at = batch_ts);
    * current and check columns equal (null-safe) -> unchanged, values *not* refreshed;
    * current and different -> current version closed at batch_ts, new version opened;
    * current but absent from source -> unchanged (no hard deletes);
    * closed versions -> copied unchanged.

    ``since`` (with ``recency_col``) limits the source to rows changed since the last
    run; so does a source that is a change feed. ``changes_only`` returns the versions that
    this run closed or opened and nothing else: what a stored history has to take up.

    Current rows and source rows are each unique per key, so the join on the key columns
    cannot be skewed; closed versions never enter it. Tables that are bucketed by the key
    are joined without an exchange.
    """
    key_cols = list(key_cols)
    columns = list(columns or source.columns)
    ts = as_timestamp(batch_ts)
    src = source
    if since is not None and recency_col:
        src = src.where(F.col(recency_col) >= as_timestamp(since))
    src = src.select(*columns)
    s = src.select(*[F.col(c).alias("s__" + c) for c in src.columns], F.lit(True).alias("_s"))

    if history is None:
        joined = s.select("*", F.lit(None).cast("boolean").alias("_c"))
        cur_cols = {c: F.lit(None) for c in [*columns, *SCD_COLUMNS]}
        return _versions(joined, columns, key_cols, check_cols, ts, cur_cols, changes_only).select(*columns, *SCD_COLUMNS)

    cur = history.where(F.col("valid_to").isNull())
    c = cur.select(*[F.col(x).alias("c__" + x) for x in cur.columns], F.lit(True).alias("_c"))
    cur_cols = {x: F.col("c__" + x) for x in [*columns, *SCD_COLUMNS]}
    on = reduce(lambda x, y: x & y, [F.col("c__" + k) == F.col("s__" + k) for k in key_cols])
    # a key that is only current does not change, so without it the source side decides
    out = _versions(c.join(s, on, "right_outer" if changes_only else "full_outer"), columns, key_cols, check_cols, ts, cur_cols, changes_only)
    if changes_only:
        return out
    return history.where(F.col("valid_to").isNotNull()).select(*columns, *SCD_COLUMNS).unionByName(out)


def _versions(joined: DataFrame, columns, key_cols, check_cols, ts: Column, cur_cols: dict, changes_only: bool) -> DataFrame:
    """Kept / closed current version and the newly opened one, from one joined row."""
    c_in = F.coalesce(F.col("_c"), F.lit(False))
    s_in = F.coalesce(F.col("_s"), F.lit(False))
    same = F.lit(True)
    for col in check_cols:
        same = same & _same(cur_cols[col], F.col("s__" + col))
    changed = c_in & s_in & ~same

    old = F.when(
        changed if changes_only else c_in,
        F.struct(
            *[cur_cols[x].alias(x) for x in columns],
            cur_cols["scd_id"].alias("scd_id"),
            cur_cols["updated_at"].alias("updated_at"),
            cur_cols["valid_from"].alias("valid_from"),
            F.when(changed, ts).otherwise(cur_cols["valid_to"]).cast("timestamp").alias("valid_to"),
        ),
    )
    new = F.when(
        s_in & (~c_in | changed),
        F.struct(
            *[F.col("s__" + x).alias(x) for x in columns],
            scd_id(business_key(*["s__" + k for k in key_cols]), ts).alias("scd_id"),
            ts.alias("updated_at"),
            ts.alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
        ),
    )
    versions = joined.select(F.explode(F.array(old, new)).alias("v")).where(F.col("v").isNotNull())
    return versions.select("v.*")


#: Rows of one key on one day above which the day is cut into pieces for that key.
HOT_ROWS = 100_000


def _chunks(log: DataFrame, keys: list[str], ts_col: str, hot_rows: int) -> DataFrame:
    """Add ``_chunk`` (day, piece): a key's time line cut by day, and busy days of a key into
    pieces of about ``hot_rows`` rows at quantiles of their times. Busy days are counted
    from the key and time columns alone (map-side partial counts)."""
    day = F.date_trunc("day", F.col(ts_col))
    busy = log.groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"), F.min(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("_low"), F.max(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("_high"))
    busy = materialize(busy.where(F.col("_n") > hot_rows), "busy-days")
    if not busy.limit(1).count():
        return log.withColumn("_chunk", F.struct(day.alias("day"), F.lit(0).alias("piece")))
    # quantiles of the busy days' times only
    same = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("l._day") == F.col("b._day")])
    times = log.select(*keys, day.alias("_day"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_t"))
    held = times.alias("l").join(F.broadcast(busy.alias("b")) if busy.count() <= 100_000 else busy.alias("b"), same)
    cuts = held.groupBy(*[F.col(f"b.{k}").alias(k) for k in keys], F.col("b._day").alias("_day")).agg(
        F.approx_percentile("_t", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(1000)).alias("_cuts")
    )
    cuts = materialize(cuts, "busy-cuts")
    hint = F.broadcast(cuts.alias("b")) if cuts.count() <= 100_000 else cuts.alias("b")
    at = F.unix_micros(F.col(f"l.{ts_col}").cast("timestamp"))
    piece = F.coalesce(F.size(F.filter(F.col("b._cuts"), lambda c: c <= at)), F.lit(0))
    joined = log.withColumn("_day", day).alias("l").join(hint, same, "left")
    return joined.select(*[F.col(f"l.{c}") for c in log.columns], F.struct(F.col("l._day").alias("day"), piece.alias("piece")).alias("_chunk"))


def scd2_from_log(
    log: DataFrame,
    *,
    key_cols,
    ts_col: str,
    check_cols,
    columns,
    tiebreak=(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The history O24 would build if run once per log time, in one pass.

    A row opens a version when it is the key's first row or its check columns differ
    (null-safe) from the previous row's; ``valid_to`` is the next version's start. Rows
    sharing a key and time collapse to the last by ``tiebreak`` first (one snapshot run
    sees one row per key). Null key parts are values like any other; rows without a time
    are left out, since no version can start there.

    The rows are shuffled once, by key and chunk of time; all windows run there, and only
    rows that open a version or begin a chunk are stored. What happens across chunk edges
    is decided on one row per chunk, so a hot key is spread over many tasks.
    """
    key_cols, columns, check_cols = list(key_cols), list(columns), list(check_cols)
    tiebreak = [c for c in tiebreak if c not in (*key_cols, ts_col)]
    base = log.select(*dict.fromkeys([*key_cols, ts_col, *columns, *check_cols, *tiebreak])).where(F.col(ts_col).isNotNull())
    base = last_per_tie(_chunks(base, key_cols, ts_col, hot_rows), key_cols, "_chunk", ts_col, tiebreak)
    part = Window.partitionBy(*key_cols, "_chunk")
    forward, backward = part.orderBy(F.col(ts_col)), part.orderBy(F.col(ts_col).desc())
    checked = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(check_cols)])
    marked = base.withColumns({
        "_pos": F.row_number().over(forward), "_prev": F.lag(checked).over(forward), "_check": checked,
    })
    marked = marked.withColumn("_opens", (F.col("_pos") > 1) & ~F.col("_check").eqNullSafe(F.col("_prev")))
    marked = marked.withColumns({
        "_last": F.first("_check").over(backward),
        "_next": F.last(F.when(F.col("_opens"), F.col(ts_col)), ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1)),
    })
    # the first row of a chunk needs the chunk's last check values, which the running window
    # over descending time holds at every row
    rows = materialize(marked.where("_opens or _pos = 1").drop("_prev"), "log-versions")

    key = Window.partitionBy(*key_cols)
    onward, back = key.orderBy("_chunk"), key.orderBy(F.col("_chunk").desc())
    edges = rows.where("_pos = 1").select(*key_cols, "_chunk", F.col(ts_col).alias("_first"), "_check", "_next", F.lag("_last").over(onward).alias("_before"), F.row_number().over(onward).alias("_k"))
    edges = edges.withColumn("_begins", (F.col("_k") == 1) | ~F.col("_check").eqNullSafe(F.col("_before")))
    start = F.when(F.col("_begins"), F.col("_first")).otherwise(F.col("_next"))
    edges = edges.withColumn("_after", F.last(start, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)))
    edges = edges.select(*key_cols, "_chunk", "_begins", "_after")

    settled = rows.where("_opens and _next is not null").select("*", F.col("_next").alias("_stop"))
    same = reduce(lambda x, y: x & y, [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*key_cols, "_chunk"]])
    at_edge = rows.where("_pos = 1 or _next is null").alias("r").join(edges.alias("e"), same)
    at_edge = at_edge.where(F.col("r._opens") | F.col("e._begins")).select("r.*", F.coalesce("r._next", "e._after").alias("_stop"))
    versions = settled.unionByName(at_edge)
    key = business_key(*key_cols)
    return versions.select(
        *columns,
        scd_id(key, F.col(ts_col)).alias("scd_id"),
        F.col(ts_col).cast("timestamp").alias("updated_at"),
        F.col(ts_col).cast("timestamp").alias("valid_from"),
        F.col("_stop").cast("timestamp").alias("valid_to"),
    )


def scd2_append(history: DataFrame, log: DataFrame, part: DataFrame, *, key_cols, ts_col: str, check_cols, columns, tiebreak=(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """O25 onto a history that exists: the versions after ``part``, late rows included, joins ``log``.

    ``history`` is what :func:`scd2_from_log` made of ``log``. A key that ``part`` does not
    hold keeps its versions as they are. Of the others, what lies before the last version
    that begins before their first new row cannot change either; from the start of that
    version on the key's rows of log and part are decided again. The result equals
    ``scd2_from_log`` over both. Reads of the log are limited by key and time.
    """
    key_cols = list(key_cols)
    first = part.where(F.col(ts_col).isNotNull()).groupBy(*key_cols).agg(F.min(ts_col).alias("_first"))
    first = first.select(*[F.col(k).alias(f"p__{k}") for k in key_cols], F.col("_first").cast("timestamp").alias("_first"))

    def on(df: DataFrame, other: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [df[k].eqNullSafe(other[f"p__{k}"]) for k in key_cols])

    starts = history.join(first, on(history, first), "inner").where(F.col("valid_from") < F.col("_first"))
    starts = starts.groupBy(*[F.col(f"p__{k}") for k in key_cols]).agg(F.max("valid_from").alias("_from"))
    starts = starts.select(*[F.col(f"p__{k}").alias(f"q__{k}") for k in key_cols], "_from")
    cut = first.join(starts, reduce(lambda x, y: x & y, [F.col(f"p__{k}").eqNullSafe(F.col(f"q__{k}")) for k in key_cols]), "left")
    cut = materialize(cut.select(*[f"p__{k}" for k in key_cols], "_from"), "append-cuts")

    both = log.unionByName(part)
    rows = both.join(cut, on(both, cut), "inner").where(F.col("_from").isNull() | (F.col(ts_col) >= F.col("_from"))).select(both["*"])
    anew = scd2_from_log(rows, key_cols=key_cols, ts_col=ts_col, check_cols=check_cols, columns=columns, tiebreak=tiebreak, hot_rows=hot_rows)
    marked = cut.withColumn("_seen", F.lit(True))
    kept = history.join(marked, on(history, marked), "left").where(F.col("_seen").isNull() | (F.col("valid_from") < F.col("_from"))).select(history["*"])
    return kept.select(*anew.columns).unionByName(anew)
