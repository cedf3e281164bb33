"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The word rule of the benchmark and license scans: digits, lower-case ASCII letters and
# everything beyond ASCII are word characters.
ASCII_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5 = 0; a null id is never held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def whole_text(text: Column | str = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` is several times faster than ``translate`` and does the same unless a text
    holds an upper-case letter beyond ASCII (or a character the regular expressions do not
    know yet), so only those texts take the slow way.
    """
    other_upper = F.regexp_like(text, F.lit(r"[\p{IsUppercase}\p{IsTitlecase}\p{Cn}&&[^A-Z]]"))
    return F.when(other_upper, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def ascii_words(text: Column) -> Column:
    """Words of an (already lower-cased) text; an empty array when there are none."""
    return F.array_remove(F.split(text, ASCII_SEPARATORS), "")


def _shift(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def with_window_hashes(df: DataFrame, words: str, length: int, out: str) -> DataFrame:
    """Add ``out``: the hash of each run of ``length`` consecutive words, by start position.

    Hashes of runs of 1, 2, 4, ... words are combined pairwise, so a run of ten costs four
    passes over the positions instead of ten look-ups at each. Every pass is its own column
    that only ``zip_with`` arguments refer to (a column captured in a lambda could be
    recomputed for each element).
    """
    made, have, at = {}, 1, f"__{out}_1"
    df = df.withColumn(at, F.transform(words, lambda w: F.xxhash64(w)))
    made[1] = at
    while have * 2 <= length:
        at = f"__{out}_{have * 2}"
        df = df.withColumn(at, F.zip_with(made[have], _shift(F.col(made[have]), have), lambda a, b: F.xxhash64(a, b)))
        have *= 2
        made[have] = at
    total = have
    while total < length:
        part = max(k for k in made if total + k <= length and k in (1, 2, 4, 8, 16, 32))
        at = f"__{out}_{total + part}_"
        df = df.withColumn(at, F.zip_with(F.col(made[total]), _shift(F.col(made[part]), total), lambda a, b: F.xxhash64(a, b)))
        total += part
        made[total] = at
    n = F.greatest(F.size(words) - (length - 1), F.lit(0))
    return df.withColumn(out, F.slice(made[total], F.lit(1), n)).drop(*made.values())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute once into the shared checkpoint folder and read back (lineage cut)."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, of an array of structs (start, rank, kind, stop) in order."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )


#: Rows of whole texts that an Arrow batch holds at most, on its way to Python and back.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small: they stand in memory of both the JVM and Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: Ids up to which a set of them is broadcast (about 30 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def text_mark(text: Column | str = "text") -> Column:
    """16 bytes that stand for a text; a null text counts as empty, as the operators read it."""
    return F.unhex(F.md5(whole_text(text).cast("binary")))


def no_mark() -> Column:
    return F.lit(None).cast("binary")


def without_texts(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose text is not among the one column of ``marks`` (distinct), whatever their doc_id."""
    marks = stored(marks.select(F.col(marks.columns[0]).alias("__mark")), "marks")
    hint = F.broadcast if marks.count() <= BROADCAST_IDS else lambda x: x
    return documents.join(hint(marks), text_mark() == F.col("__mark"), "left_anti")


def with_key(documents: DataFrame, keys: DataFrame, mark: Column, how: str) -> DataFrame:
    """Rows (semi, anti) whose doc_id and ``mark`` are a row of ``keys`` (doc_id, mark; stored and distinct); nulls equal nulls."""
    keys = keys.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
    hint = F.broadcast if keys.count() <= BROADCAST_IDS else lambda x: x
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & mark.eqNullSafe(F.col("__mark"))
    return documents.join(hint(keys), same, f"left_{how}")
