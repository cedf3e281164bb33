"""Toxicity by weak supervision.

Many voters (word lists and patterns) look at every text: a general list of insults, lists
of words and of word beginnings that a bounded sample of labelled rows associates with
toxic texts, and hand-written patterns. A generative label model estimates from the votes
of all rows that are not held out how often toxicity occurs, how accurate each voter is,
and which voters are correlated (each voter may depend on one other, a maximum spanning
forest of conditional mutual information); known labels fix the class of their rows. Its
posterior labels train a linear classifier over the lists' words, whose score is returned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, no_mark, small_batches, stored, text_mark, without_texts

#: Bound of the labelled sample that voters are induced from and the classifier is fitted on, in hashed order.
FIT_ROWS = 10_000
#: Words and word beginnings kept as features.
VOCABULARY = 4_000
LEAST_ROWS = 4
#: Hashes by which copies among the labelled rows are known, and the likelihood ratio that a term must reach without them.
SKETCH = 8
DISTINCT_BAR = 16.0
BEGINNINGS = (4, 5, 6)
WORD_VOTERS = BEGIN_VOTERS = 5
#: Correlated voters depend on each other above this conditional mutual information (nats).
CORRELATED = 1e-3

# Insults that are insults anywhere.
INSULTS = frozenset(
    "idiot idiots idiotic moron morons moronic stupid dumb dumbass loser losers scum scumbag trash garbage worthless pathetic disgusting "
    "clown clowns imbecile cretin jerk bastard bastards bitch bitches asshole assholes fool fools retard retarded filth filthy vermin "
    "degenerate dimwit halfwit lowlife parasite subhuman creep freak whore slut prick twat wanker".split()
)
WORD = re.compile(r"[^\W\d_]+")
THREAT = re.compile(r"\b(?:kill|hurt|destroy|hang|shoot)\s+(?:you|yourself|them|him|her|all)\b|\bgo\s+to\s+hell\b|\bshut\s+up\b|\bdrop\s+dead\b")
ADDRESSED = re.compile(r"\byou(?:'re|r|\s+are|\s+all)?\s+(?:\w+\s+){0,3}?(?:" + "|".join(sorted(INSULTS)) + r")\b")
MASKED = re.compile(r"\b(?:f[*#@$]+k|s[*#@$]+t|b[*#@$]+h|a[*#@$]+e|[a-z]+[*#@$]{2,}[a-z]+)\b")


class Voters:
    """Induced lists: term -> feature, and the voter that each feature belongs to."""

    def __init__(self, terms: list[str]):
        self.at = {t: i for i, t in enumerate(terms)}
        words = [t for t in terms if not t.endswith("*")]
        begins = [t for t in terms if t.endswith("*")]
        # Terms come in the order of their association; dealing them in turn makes lists of like strength.
        self.voter = {t: i % WORD_VOTERS for i, t in enumerate(words)} | {t: WORD_VOTERS + i % BEGIN_VOTERS for i, t in enumerate(begins)}
        self.memo: dict[str, tuple[tuple[int, ...], int]] = {}

    def of_word(self, word: str) -> tuple[tuple[int, ...], int]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            hits = [t for t in terms_of(word) if t in self.at]
            votes = 0
            for t in hits:
                votes |= 1 << self.voter[t]
            found = self.memo[word] = (tuple(self.at[t] for t in hits), votes)
        return found

    def look(self, text: str | None) -> tuple[list[int], int]:
        """Features of a text and its votes, a bit for each voter that fires."""
        low = (text or "").lower()
        words = set(WORD.findall(low))
        features, votes = set(), 0
        for w in words:
            own, vote = self.of_word(w)
            if own:
                features.update(own)
                votes |= vote
        n = WORD_VOTERS + BEGIN_VOTERS
        insults = words & INSULTS
        if insults:
            votes |= 1 << n
            if len(insults) > 1:
                votes |= 1 << n + 1
            if "you" in low and ADDRESSED.search(low):
                votes |= 1 << n + 2
        if not words.isdisjoint(("kill", "hurt", "destroy", "hang", "shoot", "hell", "shut", "drop")) and THREAT.search(low):
            votes |= 1 << n + 3
        if "*" in low and MASKED.search(low):
            votes |= 1 << n + 4
        if "!!!" in low:
            votes |= 1 << n + 5
        return sorted(features), votes


N_VOTERS = WORD_VOTERS + BEGIN_VOTERS + 6  # at most 2 ** 16 different votes


def terms_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


# ------------------------------------------------------------------ voters from labelled rows


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic: Counter = Counter()
    rows: Counter = Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found = {t for w in set(WORD.findall((text or "").lower())) for t in terms_of(w)}
            rows.update(found)
            if label:
                toxic.update(found)
    terms = list(rows)
    for k in range(0, len(terms), 50_000):
        part = terms[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([toxic[t] for t in part], pa.int64()), pa.array([rows[t] for t in part], pa.int64())],
            names=["term", "toxic", "rows"],
        )


def induced_terms(sample: DataFrame, size: int = VOCABULARY) -> list[str]:
    """Terms that toxic rows of the sample hold more often than chance explains, strongest first.

    The likelihood ratio must exceed what the best of all terms tested reaches by chance;
    terms of fewer than LEAST_ROWS rows could not reach it and are not tested.
    """
    counts = stored(sample.mapInArrow(_count_terms, "term string, toxic long, rows long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows")), "toxicity-terms")
    counts = counts.where(F.col("rows") >= LEAST_ROWS)
    tested = counts.count()
    total, positive = sample.agg(F.count(F.lit(1)), F.sum(F.col("toxic"))).first()
    if not total or not positive or positive == total:
        return []
    base = positive / total
    part = lambda k, n, p: F.when(k > 0, k * F.log(k / (n * F.lit(p)))).otherwise(0.0)
    ratio = 2 * (part(F.col("toxic"), F.col("rows"), base) + part(F.col("rows") - F.col("toxic"), F.col("rows"), 1 - base))
    bar = 2 * math.log(max(tested, 2)) + 1
    chosen = counts.where(F.col("toxic") / F.col("rows") > base).withColumn("ratio", ratio).where(F.col("ratio") > bar)
    return [r["term"] for r in chosen.orderBy(F.col("ratio").desc(), "term").limit(size).collect()]  # at most `size` terms


def bottom_hashes(text: str | None, n: int = 5, keep: int = SKETCH) -> list[int]:
    """The smallest hashes of a text's distinct n-word runs; near copies share most of them."""
    words = WORD.findall((text or "").lower())
    runs = {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}
    return sorted(xxhash.xxh3_64_intdigest(r) >> 1 for r in runs)[:keep]


def distinct_rows(sketches: list[list[int]], toxic: list[int]) -> list[int]:
    """Of rows of one label that share at least half of their hashes, only the first."""
    holders: dict[tuple[int, int], list[int]] = {}
    kept = []
    for i, (hashes, label) in enumerate(zip(sketches, toxic, strict=True)):
        shared = Counter(j for h in hashes for j in holders.get((h, label), ()))
        if any(2 * k >= len(hashes) for k in shared.values()):
            continue
        kept.append(i)
        for h in hashes:
            holders.setdefault((h, label), []).append(i)
    return kept


def supported(rows: list[list[int]], toxic: list[int], size: int, bar: float) -> list[int]:
    """Terms that are associated with toxic rows when copies count once: copies of a toxic
    text would make all its words look toxic."""
    base = sum(toxic) / max(len(toxic), 1)
    bad, all_rows = np.zeros(size), np.zeros(size)
    for features, label in zip(rows, toxic, strict=True):
        all_rows[features] += 1
        bad[features] += label
    kept = []
    for term in np.flatnonzero((bad > 0) & (bad > base * all_rows)):
        k, n = bad[term], all_rows[term]
        ratio = 2 * (k * math.log(k / (n * base)) + ((n - k) * math.log((n - k) / (n * (1 - base))) if n > k else 0.0))
        if ratio > bar:
            kept.append(int(term))
    return kept


# ------------------------------------------------------------------ generative label model


class LabelModel:
    """P(toxic) and P(voter fires | toxic, one other voter) from vote patterns, by EM.

    patterns: (n, voters) 0/1; weight[n, 3]: rows of the pattern without label, labelled 0, labelled 1.
    """

    def __init__(self, patterns: np.ndarray, weight: np.ndarray, rounds: int = 60):
        self.parent = [-1] * patterns.shape[1]
        self._fit(patterns, weight, rounds)
        posterior = self.posterior(patterns)
        self.parent = self._forest(patterns, weight, posterior)
        if any(p >= 0 for p in self.parent):
            self._fit(patterns, weight, rounds)

    def _tables(self, patterns: np.ndarray, by_class: list[np.ndarray]) -> None:
        self.prior = np.array([w.sum() + 1.0 for w in by_class])
        self.prior /= self.prior.sum()
        self.fires = np.zeros((patterns.shape[1], 2, 2))  # voter, class, value of its parent
        for j, p in enumerate(self.parent):
            given = patterns[:, p] if p >= 0 else np.zeros(len(patterns), dtype=patterns.dtype)
            for y in (0, 1):
                whole = (by_class[y] @ patterns[:, j] + 0.1 + 0.4 * y) / (by_class[y].sum() + 1.0)
                for v in (0, 1):
                    own = by_class[y] * (given == v)
                    self.fires[j, y, v] = (own @ patterns[:, j] + 2 * whole) / (own.sum() + 2)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.tile(np.log(self.prior), (len(patterns), 1))
        for j, p in enumerate(self.parent):
            given = patterns[:, p] if p >= 0 else np.zeros(len(patterns), dtype=np.int64)
            for y in (0, 1):
                fire = np.clip(self.fires[j, y][given], 1e-6, 1 - 1e-6)
                logs[:, y] += np.where(patterns[:, j] == 1, np.log(fire), np.log1p(-fire))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))

    def _fit(self, patterns: np.ndarray, weight: np.ndarray, rounds: int) -> None:
        # First guess: with labels their shares, else any voter at all.
        if weight[:, 1:].sum():
            guess = (weight[:, 2] + 0.05) / (weight[:, 1] + weight[:, 2] + 1.0)
        else:
            guess = np.where(patterns.any(axis=1), 0.9, 0.02)
        for _ in range(rounds):
            toxic = weight[:, 0] * guess + weight[:, 2]
            clean = weight[:, 0] * (1 - guess) + weight[:, 1]
            self._tables(patterns, [clean, toxic])
            new = self.posterior(patterns)
            if np.abs(new - guess).max(initial=0) < 1e-6:
                break
            guess = new

    def _forest(self, patterns: np.ndarray, weight: np.ndarray, posterior: np.ndarray) -> list[int]:
        """Parents along the maximum spanning forest of the voters' dependence beyond their class."""
        m, rows = patterns.shape[1], max(weight.sum(), 1.0)
        toxic = weight[:, 0] * posterior + weight[:, 2]
        share = [(weight.sum(axis=1) - toxic) / rows, toxic / rows]
        links = []
        for i in range(m):
            for j in range(i + 1, m):
                total = 0.0
                for w in share:
                    mass = max(w.sum(), 1e-12)
                    for a in (0, 1):
                        for b in (0, 1):
                            both = (w * (patterns[:, i] == a) * (patterns[:, j] == b)).sum()
                            one, two = (w * (patterns[:, i] == a)).sum(), (w * (patterns[:, j] == b)).sum()
                            if both > 0:
                                total += both * math.log(both * mass / (one * two))
                links.append((total, i, j))
        parent, near = list(range(m)), [[] for _ in range(m)]

        def find(x: int) -> int:
            while parent[x] != x:
                x = parent[x]
            return x

        for total, i, j in sorted(links, reverse=True):
            if total > CORRELATED and find(i) != find(j):
                parent[find(i)] = find(j)
                near[i].append(j)
                near[j].append(i)
        above, seen = [-1] * m, set()
        for start in range(m):
            todo = [start] if start not in seen else []
            seen.update(todo)
            while todo:
                x = todo.pop()
                for y in near[x]:
                    if y not in seen:
                        seen.add(y)
                        above[y] = x
                        todo.append(y)
        return above


def unpack(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] >> np.arange(N_VOTERS)) & 1


# ------------------------------------------------------------------ linear classifier


def fit_linear(rows: list[list[int]], targets: np.ndarray, size: int, rounds: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features with soft targets, by full-batch Adam."""
    weights, bias = np.zeros(size), 0.0
    if not len(rows):
        return weights, -3.0
    flat = np.array([f for r in rows for f in r], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    bias = float(np.log((targets.mean() + 1e-3) / (1 - targets.mean() + 1e-3)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        margin = np.bincount(owner, weights[flat], minlength=len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - targets) / len(rows)
        slope = np.r_[np.bincount(flat, error[owner], minlength=size) + decay * weights, error.sum()]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, bias


# ------------------------------------------------------------------ the operator


def _look(batches: Iterator[pa.RecordBatch], terms: Broadcast) -> Iterator[pa.RecordBatch]:
    voters = Voters(terms.value)
    for batch in batches:
        found = [voters.look(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array([f for f, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.int32())],
            names=["doc_id", "mark", "features", "votes"],
        )


def _held(batches: Iterator[pa.RecordBatch], terms: Broadcast) -> Iterator[pa.RecordBatch]:
    voters = Voters(terms.value)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        features, hashes = [voters.look(t)[0] for t in texts], [bottom_hashes(t) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(features, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())), batch.column("toxic")], names=["features", "hashes", "toxic"])


def _score(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    weights, bias = model.value
    for batch in batches:
        features = batch.column("features")
        flat = features.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(features.offsets.to_numpy()))
        margin = np.bincount(owner, weights[flat], minlength=batch.num_rows) + bias
        score = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(score, pa.float64())], names=["doc_id", "mark", "score"])


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row.

    Labels count if doc_id and toxic are there and the row is not held out; where an id has
    several, the highest. Without usable labels the fixed voters alone carry the model.
    Null and empty texts get the score of a text without features. Repeated rows get equal
    scores. Only doc_id and text of the documents are read.
    """
    return _scored(documents, labels, no_mark()).drop("mark")


def _scored(documents: DataFrame, labels: DataFrame, mark: Column) -> DataFrame:
    """The rows of ``toxicity``, each with the ``mark`` of its document."""
    spark = documents.sparkSession
    small_batches(spark)
    kind = dict(documents.dtypes)["doc_id"]
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text"), mark.alias("mark"))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1))
    chosen = known.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(FIT_ROWS)
    # FIT_ROWS ids at most are broadcast, and an id that stands at many rows gives one of its texts
    sample = docs.drop("mark").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = stored(sample, "toxicity-sample")

    found = induced_terms(sample)
    if found:
        candidates = spark.sparkContext.broadcast(found)
        held = sample.select("text", "toxic").mapInArrow(lambda batches: _held(batches, candidates), "features array<int>, hashes array<long>, toxic int").collect()  # FIT_ROWS rows at most
        first = distinct_rows([r["hashes"] for r in held], [r["toxic"] for r in held])
        found = [found[i] for i in supported([held[i]["features"] for i in first], [held[i]["toxic"] for i in first], len(found), DISTINCT_BAR)]
    terms = spark.sparkContext.broadcast(found)
    looked = stored(docs.mapInArrow(lambda batches: _look(batches, terms), f"doc_id {kind}, mark binary, features array<int>, votes int"), "toxicity-votes")

    # Label model: rows by votes and label, over all rows that are not held out.
    with_label = looked.where(~held_out()).select("doc_id", "votes").join(known, "doc_id", "left")
    counted = with_label.groupBy("votes").agg(
        F.sum(F.col("toxic").isNull().cast("int")).alias("none"), F.sum((F.col("toxic") == 0).cast("int")).alias("clean"), F.sum((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).orderBy("votes").collect()  # at most 2 ** N_VOTERS rows
    patterns = unpack(np.array([r["votes"] for r in counted], dtype=np.int64))
    weight = np.array([[r["none"] or 0, r["clean"] or 0, r["toxic"] or 0] for r in counted], dtype=float).reshape(-1, 3)
    model = LabelModel(patterns, weight)

    # Classifier: posterior labels of the sample. The voters' bits are features too.
    size = len(terms.value) + N_VOTERS
    fit = looked.join(F.broadcast(chosen.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min(F.struct("votes", "features")).alias("one"))
    fit = fit.select("doc_id", "one.*").orderBy("doc_id").collect()  # FIT_ROWS rows at most
    if not fit:
        fit = looked.where(~held_out()).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(FIT_ROWS).collect()
    bits = unpack(np.array([r["votes"] for r in fit], dtype=np.int64))
    rows = [list(r["features"]) + [len(terms.value) + k for k in np.flatnonzero(b)] for r, b in zip(fit, bits, strict=True)]
    linear = spark.sparkContext.broadcast(fit_linear(rows, model.posterior(bits), size))
    fired = F.filter(F.transform(F.sequence(F.lit(0), F.lit(N_VOTERS - 1)), lambda k: F.when(F.expr("shiftright(votes, 0)").bitwiseAND(F.pow(F.lit(2), k).cast("int")) != 0, k + len(terms.value))), lambda k: k.isNotNull())
    scored = looked.select("doc_id", "mark", F.concat("features", fired).alias("features")).mapInArrow(lambda batches: _score(batches, linear), f"doc_id {kind}, mark binary, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "mark")


def remove_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, row by row: a row stays or goes by its own text."""
    return without_texts(documents, _scored(documents, labels, text_mark()).where("predicted = 1").select("mark").distinct())
