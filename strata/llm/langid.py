"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language answers how far a string goes on as a
substring of that text. Cross-parsing cuts a text into longest matches; the fewer phrases
a text needs against a language, the closer it is to it. Phrases are normalised to bits a
symbol, phrases * log2(size of the training text) / symbols, and the least wins.

Training reads a bounded, seeded sample of labelled rows; every text is parsed whole, in
numpy, thousands of runs side by side. A run is parsed as if a phrase began with it; then the
phrase that really crosses its edge is followed until both parses begin a phrase at the
same symbol, from where on they are one. So the phrases are those of one parse from the
text's beginning, wherever it is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, small_batches

#: Bound of the training sample: rows of a language, and symbols of a language's training text.
SAMPLE_ROWS, SAMPLE_SYMBOLS = 200, 24_000
#: A text is parsed in runs of this many symbols, side by side (results do not depend on it).
RUN = 256
#: Transitions of a language up to which they are held as a table; beyond it (large alphabets) as sorted keys.
TABLE = 8_000_000


def symbols_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text; all that is not a letter becomes one break (0)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(LETTERS[np.minimum(points, len(LETTERS) - 1)], points, 0)
    if len(points):
        points = points[(points != 0) | (np.r_[1, points[:-1]] != 0)]
    return points


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


class _Lazy:
    """The letter table, made once a process when first asked for."""

    table: np.ndarray | None = None

    def __getitem__(self, at):
        if _Lazy.table is None:
            _Lazy.table = _letters()
        return _Lazy.table[at]

    def __len__(self):
        return 0x110000


LETTERS = _Lazy()


def suffix_automaton(codes: list[int], width: int) -> Moves:
    """Transitions of the minimal automaton of all substrings; state 0 is none, 1 the start."""
    following: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return Moves.of(following, width)


class Moves:
    """Transitions by (state, symbol): a table, or sorted keys where that would be large."""

    def __init__(self, width: int, table: np.ndarray | None, keys: np.ndarray | None = None, to: np.ndarray | None = None):
        self.width, self.table, self.keys, self.to = width, table, keys, to

    @classmethod
    def of(cls, following: list[dict[int, int]], width: int) -> Moves:
        keys = np.array([s * width + c for s, moves in enumerate(following) for c in sorted(moves)], dtype=np.int64)
        to = np.array([moves[c] for moves in following for c in sorted(moves)], dtype=np.int32)
        if len(following) * width > TABLE:
            return cls(width, None, keys, to)
        table = np.zeros(len(following) * width, dtype=np.int32)
        table[keys] = to
        return cls(width, table)

    def __call__(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        at = state * self.width + code
        if self.table is not None:
            return self.table[at]
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[place] == at, self.to[place], 0) if len(self.keys) else np.zeros(len(at), dtype=np.int32)


class Model:
    """Languages, their automata over a shared alphabet, and the size of each training text."""

    def __init__(self, texts: dict[str, np.ndarray]):
        self.langs = sorted(texts)
        points = np.unique(np.concatenate([np.zeros(1, np.uint32), *texts.values()]))
        self.alphabet = points[points != 0]  # every letter of the sample; break is 0, letters unseen in it the last code
        self.width = len(self.alphabet) + 2
        self.size = [max(2, len(texts[x])) for x in self.langs]
        self.moves = [suffix_automaton(self.encode(texts[x]).tolist(), self.width) for x in self.langs]

    @classmethod
    def of(cls, state: dict) -> Model:
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    def encode(self, points: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.where(points == 0, 0, self.width - 1).astype(np.int64)
        at = np.searchsorted(self.alphabet, points)
        at = np.minimum(at, len(self.alphabet) - 1)
        code = np.where(self.alphabet[at] == points, at + 1, self.width - 1)
        return np.where(points == 0, 0, code).astype(np.int64)


def phrases(runs: np.ndarray, lengths: np.ndarray, before: np.ndarray, moves: Moves) -> np.ndarray:
    """Phrases that begin in each run (a row of codes, ``lengths`` of them valid, rows by falling length).

    ``before`` names the run that a run goes on from, -1 if it begins its text. One step
    feeds the next symbol of every run to the automaton; where it cannot go on, a phrase
    begins (a symbol that the language does not have is one of its own).
    """
    columns = np.ascontiguousarray(runs.T)
    state = np.zeros(len(runs), dtype=np.int64)  # no phrase is open: the first symbol begins one
    begins = np.zeros(runs.shape[::-1], dtype=bool)
    active = np.searchsorted(-lengths, -np.arange(runs.shape[1]), side="left")  # rows longer than the step
    ones = np.ones(len(runs), dtype=np.int64)
    for step in range(runs.shape[1]):
        n = active[step]
        if not n:
            break
        code = columns[step, :n]
        to = moves(state[:n], code)
        stuck = np.flatnonzero(to == 0)
        if len(stuck):
            begins[step, stuck] = True
            to[stuck] = moves(ones[: len(stuck)], code[stuck])
        state[:n] = to
    count = begins.sum(axis=0)
    # Follow the phrase that comes in from the run before until both parses begin one at the same symbol.
    left = state.copy()  # the state in which a run is really left
    rest, todo = count.copy(), np.flatnonzero(before >= 0)
    while len(todo):
        came, row, found = left[before[todo]], todo, np.zeros(len(todo), dtype=np.int64)
        at, ended = np.arange(len(todo)), state[todo].copy()
        total, later = np.zeros(len(todo), dtype=np.int64), count[todo].copy()
        for step in range(runs.shape[1]):
            go = lengths[row] > step
            if not go.all():  # a run that ends before the parses meet
                out = at[~go]
                total[out], ended[out] = found[~go], came[~go]
                at, row, came, found = at[go], row[go], came[go], found[go]
            if not len(at):
                break
            code = columns[step, row]
            to = moves(came, code)
            stuck = to == 0
            to[stuck] = moves(ones[: int(stuck.sum())], code[stuck])
            found = found + stuck
            both = begins[step, row]
            later[at] -= both  # phrases of the run's own parse that begin after this symbol
            meet = stuck & both
            total[at[meet]] = found[meet] + later[at[meet]]
            at, row, came, found = at[~meet], row[~meet], to[~meet], found[~meet]
        else:
            total[at], ended[at] = found, came
        rest[todo] = total
        changed = todo[left[todo] != ended]
        left[todo] = ended
        follows = np.zeros(len(runs), dtype=bool)
        follows[changed] = True
        todo = np.flatnonzero((before >= 0) & follows[np.maximum(before, 0)])
    return rest


def classify(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """The language with the fewest normalised phrases, and how clearly it wins (0 to 1)."""
    parts, owner, goes_on, letters = [], [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        points = symbols_of(text or "")
        letters[i] = np.count_nonzero(points)
        if letters[i]:
            code = model.encode(points)
            parts += [code[k : k + RUN] for k in range(0, len(code), RUN)]
            goes_on += [k - 1 if k > len(owner) else -1 for k in range(len(owner), len(parts))]
            owner += [i] * (len(parts) - len(owner))
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not parts or not model.langs:
        return langs, scores
    lengths = np.array([len(p) for p in parts])
    order, owner = np.argsort(-lengths, kind="stable"), np.array(owner)
    runs = np.zeros((len(parts), lengths.max()), dtype=np.int64)
    for row, k in enumerate(order):
        runs[row, : lengths[k]] = parts[k]
    placed = np.empty(len(parts), dtype=np.int64)
    placed[order] = np.arange(len(parts))
    goes_on = np.array(goes_on)[order]
    before = np.where(goes_on >= 0, placed[goes_on], -1)
    lengths, owner = lengths[order], owner[order]
    total = np.bincount(owner, lengths, minlength=len(texts))
    cost = np.stack([np.bincount(owner, phrases(runs, lengths, before, t), minlength=len(texts)) * math.log2(n) for t, n in zip(model.moves, model.size, strict=True)])
    cost = cost / np.maximum(total, 1)
    won = np.argmin(cost, axis=0)
    rest = np.exp2(-(cost - cost.min(axis=0)) * np.minimum(total, 64))
    share = 1.0 / rest.sum(axis=0)
    for i in np.flatnonzero(letters):
        langs[i], scores[i] = model.langs[won[i]], float(share[i])
    return langs, scores


def train(documents: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_SYMBOLS) -> Model:
    """Automata from at most ``rows`` rows a language that are not held out, in hashed order, up to ``size`` symbols.

    A first pass counts the labelled ids of each language, about; a second takes those whose
    hash falls in a share of the range that holds about twice as many as asked for. An id
    that stands at many rows gives one text, of a long text at most 2 ``size`` characters
    are learned from, so what is collected is bounded.
    """
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), F.substring(F.col("text").cast("string"), 1, 2 * size).alias("text"), F.xxhash64(F.lit(7), "doc_id").alias("seeded"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("seeded").alias("n")).collect()}  # a row a language
    if not counts:
        return Model({})
    part = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * rows / max(n, 1)))])
    unit = F.shiftrightunsigned("seeded", 11) / F.lit(float(1 << 53))
    one = labelled.where(unit < part[F.col("lang")]).groupBy("lang", "seeded").agg(F.min("text").alias("text"))
    near = one.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("seeded", "text"))), 1, rows).alias("rows"))
    texts = {}
    for r in near.collect():  # at most `rows` rows a language
        points, n = [], 0
        for row in r["rows"]:
            own = symbols_of(row["text"])
            if n and n + len(own) > 2 * size:
                continue  # a row that alone would fill the sample
            points += [own, np.zeros(1, np.uint32)]
            n += len(own) + 1
            if n >= size:
                break
        texts[r["lang"]] = np.concatenate(points) if points else np.zeros(1, np.uint32)
    return Model(texts)


#: Symbols parsed side by side at most; bounds the memory of a batch.
BATCH_SYMBOLS = 2_000_000


def _predict(batches: Iterator[pa.RecordBatch], state: Broadcast) -> Iterator[pa.RecordBatch]:
    model = Model.of(state.value)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        langs, scores, k = [], [], 0
        while k < len(texts):
            n, size = 0, 0
            while k + n < len(texts) and (not n or size + len(texts[k + n] or "") <= BATCH_SYMBOLS):
                size += len(texts[k + n] or "")
                n += 1
            a, b = classify(texts[k : k + n], model)
            langs, scores, k = langs + a, scores + b, k + n
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )


def languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document row.

    ``und`` with score 0 for texts without a letter (null and empty ones among them), and
    for every text if no row is labelled. Ties go to the language that sorts first.
    Repeated rows each get their row. Labels are read from rows that are not held out
    only; reads doc_id, text and lang.
    """
    small_batches(documents.sparkSession)
    # Transitions of at most 2 * SAMPLE_SYMBOLS states a language.
    model = documents.sparkSession.sparkContext.broadcast(vars(train(documents)))
    rows = documents.select(F.col("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(lambda batches: _predict(batches, model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")

