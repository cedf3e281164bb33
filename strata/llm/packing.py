"""Sum-of-squares online packing of tokenized documents into windows.

Each task packs the documents it reads, in the order it reads them, and keeps an array of
levels: how many windows are filled to each level. A document goes to the level that
leaves the sum of the squared counts of partly filled windows least (opening a window is
one of the choices, filling one up is another). Whole windows are cut off the front of
longer documents first. What is open at the end of a task, or beyond ``OPEN`` windows, is
put end to end and cut at the window length; the last rest is cut into powers of two, so
no sequence needs padding.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches, whole_text

WINDOW, END = 2048, 1
#: Windows a task keeps open (8 kB each); beyond it they are closed by cutting documents.
OPEN = 2048
#: Code points in which the two tokenizer libraries agree on what a letter, a digit or a space is
#: (older blocks: the tables of newer Unicode versions add nothing there); tests compare them all.
SETTLED = re.compile(r"[\x00-ԯḀ-῿‐-‧‰-⁞₠-€]*")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Runs without a place to split, which the faster library merges in quadratic time.
UNBROKEN = re.compile(r"\S{500}|\s{500}")


class Tokens:
    """Token ids of texts by a byte-level vocabulary file.

    The file's own library splits about 3 MB a second. Merges in the order of the ids are
    what the faster byte-pair library does too, so texts of settled code points without a
    special token or an unbroken run go there, all others to the file's own library: the
    ids are the same.
    """

    def __init__(self, content: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(content)
        model = json.loads(content)
        self.special = [t["content"] for t in model.get("added_tokens", ())]
        # bytes as printable characters, as byte-level vocabularies write them
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(of[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in self.special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if SETTLED.fullmatch(text) and not UNBROKEN.search(text) and not any(s in text for s in self.special):
            found = self.fast.encode_ordinary(text)
        else:
            found = self.slow.encode(text, add_special_tokens=False).ids
        return np.asarray(found, dtype=np.uint32)


class Levels:
    """Windows by fill level; level 0 stands for a window that is not open yet."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.held: list[list[list]] = [[] for _ in range(window + 1)]
        self.open = 0

    def level_for(self, size: int) -> int:
        """The level whose window, with ``size`` tokens more, leaves the least sum of squared counts; ties to the fullest."""
        last = self.window - size
        # from h to h + size: (n_h - 1)^2 - n_h^2 + (n_h+size + 1)^2 - n_h+size^2; levels 0 and window count nothing
        change = 2 * (self.count[size : self.window + 1] - self.count[: last + 1]) + 2
        change[0] = 2 * self.count[size] + 1
        change[last] = (1 - 2 * self.count[last]) if last else 0
        change[1:][self.count[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def place(self, size: int, piece: tuple) -> list | None:
        """Put a piece into a window; the window's pieces if that fills it."""
        at = self.level_for(size)
        if at:
            self.count[at] -= 1
            window = self.held[at].pop()
        else:
            self.open += 1
            window = []
        window.append(piece)
        if at + size == self.window:
            self.open -= 1
            return window
        self.count[at + size] += 1
        self.held[at + size].append(window)
        return None

    def drain(self) -> Iterator[list]:
        """Sequences of what is open, without padding: end to end, cut at the window length, the rest at powers of two."""
        pieces = [p for level in range(self.window, 0, -1) for w in self.held[level] for p in w]
        left = sum(len(ids) for _, _, ids, _ in pieces)
        self.count[:], self.held, self.open = 0, [[] for _ in range(self.window + 1)], 0
        now, room = [], 0
        for doc, start, ids, total in pieces:
            at = 0
            while at < len(ids):
                if not room:
                    if now:
                        yield now
                    now, room = [], min(self.window, 1 << (left.bit_length() - 1))
                took = min(room, len(ids) - at)
                now.append((doc, start + at, ids[at : at + took], total))
                at, room, left = at + took, room - took, left - took
        if now:
            yield now


def _pack(batches: Iterator[pa.RecordBatch], content, window: int, end: int, most: int) -> Iterator[pa.RecordBatch]:
    tokens, levels = Tokens(content.value), Levels(window)
    first, made = TaskContext.get().partitionId() << 33, 0
    rows: list[tuple] = []

    def emit(pieces: list) -> None:
        nonlocal made
        offset = 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first + made, offset))
            offset += len(ids)
        made += 1

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PIECES.split(", ")])

    for batch in batches:
        texts = batch.column("text")
        for i, doc in enumerate(batch.column("doc_id").to_pylist()):
            ids = np.append(tokens.ids(texts[i].as_py()), np.uint32(end))
            total = len(ids)
            whole = total - total % window
            for at in range(0, whole, window):
                emit([(doc, at, ids[at : at + window], total)])
            if whole < total:
                filled = levels.place(total - whole, (doc, whole, ids[whole:].copy(), total))
                if filled:
                    emit(filled)
            if levels.open > most:
                for pieces in levels.drain():
                    emit(pieces)
            if len(rows) >= 4096:
                yield flush()
    for pieces in levels.drain():
        emit(pieces)
    if rows:
        yield flush()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packed_sequences(documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end: int = END, most: int = OPEN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: the pieces of all documents in sequences of ``window`` tokens.

    A document's tokens are the ids of its whole text (null: empty) and ``end``. Each id lies
    in exactly one piece. Rows that repeat an id, or have none, are documents of their own.
    Sequences are full but for the last few of a task, whose lengths are powers of two. A
    document shorter than a window is cut only in the windows that close a task (or that go
    beyond ``most`` open ones). An empty table gives no rows. ``vocabulary`` is read by the
    driver (a few MB) and sent to the tasks. There is no shuffle, and the same files give the
    same sequences. Reads doc_id and text.
    """
    spark = documents.sparkSession
    small_batches(spark)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(functools.partial(_pack, content=content, window=window, end=end, most=most), PIECES)
