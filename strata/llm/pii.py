"""Personal data: base patterns, and a linear-chain conditional random field on word shapes.

The base patterns are found in linear time. The field is trained on a small labelled table
(made here by rule: sentence frames with seeded values and counter-examples) and adds what
the patterns miss: phone numbers without a leading plus, spelled-out addresses and the
like. It reads the chunks (runs without white space) around those that hold a digit, an at
sign or a spelled-out one, which every value that it may report holds; a chunk's features are its shape, its neighbours' shapes and a few cue words.
Decoding is Viterbi over padded batches in numpy.
"""

from __future__ import annotations

import heapq
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches

KINDS = ["email", "ip", "card", "phone"]
#: Tag 0 is outside; 1 + 2k begins and 2 + 2k goes on with kind k.
TAGS = 1 + 2 * len(KINDS)
#: Chunks read on either side of one that holds a digit, an at sign or a spelled-out at or dot.
AROUND = 2
#: Sentences of the labelled table, and the seed of its values.
SENTENCES, SEED = 320, 5

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the base patterns, leftmost and non-overlapping within a kind, sorted."""
    out, upto = [], 0
    at = text.find("@")
    while at >= 0:
        if at >= upto:
            start = at
            while start > upto and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append((start, 0, m.end()))
                upto = m.end()
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------------ features

CHUNK = re.compile(r"\S+")
TRIGGER = re.compile(r"[0-9@]")
# A spelled-out at sign: in brackets, or a word before a dotted name or a spelled-out dot; and that dot, so that a chain of them is read to its end.
SPELLED = re.compile(r"[(\[]\s*+at\s*+[)\]]|(?<!\S)at\s++[\w-]++(?:\.[\w-]|\s++dot(?!\S))|(?<!\S)dot(?!\S)", re.I)
RUNS = [(re.compile("[0-9]+"), "9"), (re.compile(r"[^\W\d_]+"), "a")]
CUES = frozenset("tel phone call fax mobile cell mail email e-mail contact card visa amex iban host server ip address addr reach write".split())
BUCKETS = 1 << 12
FEATURES = 9


def shape(chunk: str) -> str:
    """Letters as a, a run of digits as its length (up to 5 exactly), other characters as they are, runs of letters as one."""
    if len(chunk) > 64:
        return "long"
    out = RUNS[1][0].sub("a", chunk)
    return RUNS[0][0].sub(lambda m: f"<{len(m[0]) if len(m[0]) < 6 else 6 if len(m[0]) < 10 else 10 if len(m[0]) < 14 else 14}>", out)


def _hash(s: str) -> int:
    h = 2166136261
    for b in s.encode("utf-8", "surrogatepass"):
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % BUCKETS


_MEMO: dict[tuple, int] = {}


def _bucket(name: int, value: str) -> int:
    if len(_MEMO) > 200_000:
        _MEMO.clear()
    found = _MEMO.get((name, value))
    if found is None:
        found = _MEMO[(name, value)] = _hash(f"{name}={value}")
    return found


def features(chunks: list[str]) -> np.ndarray:
    """(chunks, FEATURES) buckets of each chunk of a run."""
    core = [c.strip(".,;:!?\"'") or c for c in chunks]
    shapes = [shape(c) for c in core]
    out = np.empty((len(chunks), FEATURES), dtype=np.int32)
    for i, c in enumerate(core):
        left, right = shapes[i - 1] if i else "^", shapes[i + 1] if i + 1 < len(shapes) else "$"
        digits = sum(ch.isdigit() for ch in c[:64])
        cue = lambda k: core[k].lower() if 0 <= k < len(core) and core[k].lower() in CUES else "-"
        out[i] = [
            _bucket(0, shapes[i]), _bucket(1, left + "|" + shapes[i]), _bucket(2, shapes[i] + "|" + right), _bucket(3, cue(i - 1) + cue(i - 2)),
            _bucket(4, f"{digits}"), _bucket(5, "@" if "@" in c else "-"), _bucket(6, f"{c[:1] if not c[:1].isalnum() else '-'}{c[-1:] if not c[-1:].isalnum() else '-'}"),
            _bucket(7, f"{c.count('.')},{c.count('-')}"), _bucket(8, c.lower() if c.lower() in CUES | {"at", "dot", "(at)", "[at]"} else "-"),
        ]
    return out


# ------------------------------------------------------------------ the labelled table


def labelled_table(count: int = SENTENCES, seed: int = SEED) -> list[tuple[list[str], list[int]]]:
    """Chunks and tags of made sentences: frames of cue and filler words around seeded values."""
    rng = random.Random(seed)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    w = lambda: "".join(rng.choice("aeinorstlhd") for _ in range(rng.randint(2, 9)))
    byte = lambda: str(rng.randint(0, 255))
    email = [lambda: [f"{w()}.{n(2)}@{w()}.{w()}.com"], lambda: [f"{w()}@{w()}.org"], lambda: [w(), "(at)", f"{w()}.com"], lambda: [f"{w()}@{w()}", "dot", "com"]]
    ip = [lambda: [".".join(byte() for _ in range(4))], lambda: [".".join(byte() for _ in range(4)) + f":{n(4)}"]]
    card = [lambda: ["4" + n(15)], lambda: [n(4), n(4), n(4), n(4)], lambda: ["-".join(n(4) for _ in range(4))]]
    phone = [
        lambda: ["+1", f"({n(3)})", f"555-{n(4)}"], lambda: [f"({n(3)})", f"{n(3)}-{n(4)}"], lambda: [f"{n(3)}-{n(3)}-{n(4)}"],
        lambda: [f"+{n(2)}", n(3), n(3), n(4)], lambda: [f"{n(3)}.{n(3)}.{n(4)}"], lambda: [f"+{n(11)}"],
    ]
    kinds = [email, ip, card, phone]
    cues = [["email", "mail", "contact"], ["ip", "host", "server"], ["card", "visa"], ["tel", "phone", "call", "fax"]]
    # What looks like it and is not: years, prices, versions, measures, hashes, keys, times, lists.
    plain = [
        lambda: str(rng.randint(1900, 2100)), lambda: f"{n(2)}.{n(2)}", lambda: f"v{n(1)}.{n(1)}.{n(2)}", lambda: f"{n(2)}:{n(2)}", lambda: f"{n(1)},{n(3)}",
        lambda: f"password={n(3)}{w()}{n(4)}", lambda: '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', lambda: f"AKIA{w().upper()}{n(2)}",
        lambda: f"{n(4)}-{n(2)}-{n(2)}", lambda: f"${n(3)}", lambda: n(rng.randint(1, 6)), lambda: f"{n(2)}%", lambda: f"/{w()}/{n(5)}", lambda: f"{n(1)}.{n(1)}.",
        lambda: f"https://{w()}.com/{n(3)}", lambda: f"#{n(4)}", lambda: f"{w()}{n(2)}", lambda: f"{n(2)}-{n(2)}", lambda: f"{n(3)}-{n(3)}", lambda: n(8), lambda: n(10), lambda: n(12),
    ]
    rows = []
    for _ in range(count):
        chunks, tags = [w() for _ in range(rng.randint(1, 4))], []
        tags = [0] * len(chunks)
        for _ in range(rng.randint(1, 2)):
            if rng.random() < 0.5:
                k = rng.randrange(len(kinds))
                if rng.random() < 0.4:
                    chunks.append(rng.choice(cues[k]) + rng.choice(["", ":"]))
                    tags.append(0)
                value = rng.choice(kinds[k])()
                tags += [1 + 2 * k] + [2 + 2 * k] * (len(value) - 1)
                if rng.random() < 0.3:
                    value[-1] += rng.choice([".", ","])
            else:
                value = [rng.choice(plain)() for _ in range(rng.randint(1, 2))]
                tags += [0] * len(value)
            chunks += value
            more = [w() + rng.choice(["", ",", "."]) for _ in range(rng.randint(1, 3))]
            chunks, tags = chunks + more, tags + [0] * len(more)
        rows.append((chunks, tags))
    return rows


# ------------------------------------------------------------------ the field


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def allowed() -> np.ndarray:
    """0 where a tag may follow another (rows: before; the last row: at the start), else a large negative number."""
    out = np.full((TAGS + 1, TAGS), 0.0)
    for b in range(TAGS):
        if b and b % 2 == 0:  # goes on: only after the same kind
            out[:, b] = -1e4
            out[b - 1, b] = out[b, b] = 0.0
    return out


def train(rows: list[tuple[list[str], list[int]]], rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (bucket, tag) and transition weights (tag or start, tag), by penalised likelihood (Adam)."""
    width = max(len(c) for c, _ in rows)
    feats = np.zeros((len(rows), width, FEATURES), dtype=np.int32)
    gold = np.zeros((len(rows), width), dtype=np.int64)
    valid = np.zeros((len(rows), width), dtype=bool)
    for i, (chunks, tags) in enumerate(rows):
        feats[i, : len(chunks)], gold[i, : len(tags)], valid[i, : len(chunks)] = features(chunks), tags, True
    emit, move, fixed = np.zeros((BUCKETS, TAGS)), np.zeros((TAGS + 1, TAGS)), allowed()
    flat, rows_at = feats[valid].ravel(), np.repeat(np.arange(int(valid.sum())), FEATURES)
    truth = np.eye(TAGS)[gold]
    state = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]
    for t in range(1, rounds + 1):
        scores = emit[feats].sum(axis=2)
        steps = move + fixed
        alpha, beta = np.empty((width, len(rows), TAGS)), np.zeros((width, len(rows), TAGS))
        alpha[0] = scores[:, 0] + steps[TAGS]
        for k in range(1, width):
            nxt = _logsum(alpha[k - 1][:, :, None] + steps[None, :TAGS], 1) + scores[:, k]
            alpha[k] = np.where(valid[:, k, None], nxt, alpha[k - 1])
        for k in range(width - 2, -1, -1):
            back = _logsum(steps[None, :TAGS] + (scores[:, k + 1] + beta[k + 1])[:, None, :], 2)
            beta[k] = np.where(valid[:, k + 1, None], back, 0.0)
        whole = _logsum(alpha[-1], 1)
        single = np.exp(np.moveaxis(alpha + beta, 0, 1) - whole[:, None, None]) * valid[:, :, None]
        slope_move = np.zeros_like(move)
        slope_move[TAGS] = (single[:, 0] - truth[:, 0]).sum(axis=0)
        for k in range(1, width):
            pair = np.exp(alpha[k - 1][:, :, None] + steps[None, :TAGS] + (scores[:, k] + beta[k])[:, None, :] - whole[:, None, None])
            real = truth[:, k - 1][:, :, None] * truth[:, k][:, None, :]
            slope_move[:TAGS] += ((pair - real) * valid[:, k, None, None]).sum(axis=0)
        error = (single - truth * valid[:, :, None])[valid]
        slope_emit = np.stack([np.bincount(flat, error[rows_at, y], minlength=BUCKETS) for y in range(TAGS)], axis=1)
        for value, slope, k in ((emit, slope_emit / len(rows) + 2e-4 * emit, 0), (move, slope_move / len(rows) + 2e-4 * move, 2)):
            state[k] = 0.9 * state[k] + 0.1 * slope
            state[k + 1] = 0.99 * state[k + 1] + 0.01 * slope**2
            value -= 0.25 * (state[k] / (1 - 0.9**t)) / (np.sqrt(state[k + 1] / (1 - 0.99**t)) + 1e-8)
    return emit, move + fixed


#: Chunks that are decoded together, about; a run is never cut, so a longer one goes alone.
CELLS = 1 << 17


def viterbi(feats: list[np.ndarray], emit: np.ndarray, steps: np.ndarray) -> list[np.ndarray]:
    """Best tags of each run of chunks; runs of like length go through together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(feats)
    order = sorted(range(len(feats)), key=lambda i: len(feats[i]))
    at = 0
    while at < len(order):
        take = order[at : at + 512]
        while len(take) > 1 and (len(feats[take[-1]]) > 2 * len(feats[take[0]]) + 8 or len(take) * len(feats[take[-1]]) > CELLS):
            take = take[: len(take) // 2]
        at += len(take)
        lengths = np.array([len(feats[i]) for i in take])
        width = int(lengths.max())
        scores = np.zeros((len(take), width, TAGS))
        for row, i in enumerate(take):
            scores[row, : lengths[row]] = emit[feats[i]].sum(axis=1)
        best = scores[:, 0] + steps[TAGS]
        back = np.zeros((width, len(take), TAGS), dtype=np.int8)
        for k in range(1, width):
            every = best[:, :, None] + steps[None, :TAGS]
            came = every.argmax(axis=1)
            new = every.max(axis=1) + scores[:, k]
            on = (k < lengths)[:, None]
            best, back[k] = np.where(on, new, best), np.where(on, came, np.arange(TAGS)[None, :])
        tag = best.argmax(axis=1)
        path = np.zeros((len(take), width), dtype=np.int64)
        for k in range(width - 1, -1, -1):
            path[:, k] = tag
            tag = back[k][np.arange(len(take)), tag]
        for row, i in enumerate(take):
            out[i] = path[row, : lengths[row]]
    return out


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of (start, stop) chunks: those within AROUND of a chunk that holds a digit, an at sign or a spelled-out one."""
    spelled = [at for m in SPELLED.finditer(text) for at in (m.start(), m.end() - 1)]
    if not spelled and not TRIGGER.search(text):
        return []
    chunks = [m.span() for m in CHUNK.finditer(text)]
    near, k = [], 0
    for at in heapq.merge((m.start() for m in TRIGGER.finditer(text)), spelled):
        while chunks[k][1] <= at:
            k += 1
        if not near or near[-1] != k:
            near.append(k)
    runs: list[list[tuple[int, int]]] = []
    begin = stop = -1
    for k in [*near, None]:
        if k is not None and stop >= 0 and k - AROUND <= stop:
            stop = min(len(chunks), k + AROUND + 1)
            continue
        if stop >= 0:
            runs.append(chunks[begin:stop])
        if k is not None:
            begin, stop = max(0, k - AROUND), min(len(chunks), k + AROUND + 1)
    return runs


# What a span of the field must hold to be personal data of its kind at all.
def holds(kind: int, value: str) -> bool:
    digits = len(NOT_DIGIT.sub("", value))
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+(?:@|\s*[(\[]?\s*at\s*[)\]]?\s*)[\w-]+(?:(?:\.|\s*dot\s*)[\w-]+)+", value, re.I))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?", value)) and all(int(p) < 256 for p in value.split(":")[0].split("."))
    if kind == 2:
        return 13 <= digits <= 19 and digits >= len(value) * 0.7 and luhn(NOT_DIGIT.sub("", value))
    return 7 <= digits <= 15 and bool(re.fullmatch(r"\+?[0-9(][0-9().\s-]*[0-9]", value))


def spans(texts: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[tuple[list, list]]:
    """For each text the base spans and those that the field adds beside them: (start, kind, stop), sorted."""
    base = [base_spans(t) if t and TRIGGER.search(t) else [] for t in texts]
    runs, owner = [], []
    for i, t in enumerate(texts):
        for run in runs_of(t or ""):
            runs.append(run)
            owner.append(i)
    found: list[list] = [[] for _ in texts]
    decoded = viterbi([features([texts[i][a:b] for a, b in run]) for run, i in zip(runs, owner, strict=True)], *model)
    for run, i, tags in zip(runs, owner, decoded, strict=True):
        k = 0
        while k < len(run):
            tag = int(tags[k])
            if not tag:
                k += 1
                continue
            kind, first = (tag - 1) // 2, k
            k += 1
            while k < len(run) and tags[k] == 2 + 2 * kind:
                k += 1
            start, stop = run[first][0], run[k - 1][1]
            value = texts[i][start:stop]
            start += len(value) - len(value.lstrip("\"'<[{,;:"))
            stop -= len(value) - len(value.rstrip("\"'>]},;:.!?"))
            if start < stop and holds(kind, texts[i][start:stop]):
                found[i].append((start, kind, stop))
    for own, more in zip(base, found, strict=True):
        more[:] = [s for s in more if not any(s[0] < b[2] and b[0] < s[2] for b in own)] if len(own) * len(more) < 10_000 else _beside(own, more)
    return list(zip(base, found, strict=True))


def _beside(own: list, more: list) -> list:
    stops = np.maximum.accumulate([b[2] for b in own])
    starts = [b[0] for b in own]
    at = np.searchsorted(starts, [s[2] for s in more])  # base spans that start before the end
    return [s for s, k in zip(more, at, strict=True) if not k or stops[k - 1] <= s[0]]


def _named(found: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _find(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            found = spans(part.column("text").to_pylist(), model.value)
            counts = [[sum(s[1] == kind for s in base) for base, _ in found] for kind in range(len(KINDS))]
            columns = [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts]]
            columns += [pa.array([_named(base) for base, _ in found], pa.string()), pa.array([_named(sorted([*base, *more])) for base, more in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(more) for _, more in found], pa.int64())], names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans", "n_field"])


def private_data(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_field of every document row.

    Counts and base_sha256 are of the base spans; ``spans`` also holds the ``n_field`` spans
    that the field adds where no base span is. Null and empty texts have none. Repeated
    rows each get their row. Only doc_id and text are read.
    """
    small_batches(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    model = documents.sparkSession.sparkContext.broadcast(train(labelled_table()))
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    found = docs.mapInArrow(lambda batches: _find(batches, model), f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string, n_field long")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_field")


def mask(text: str, found: list) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    out, upto = [], 0
    for a, k, b in found:
        if b <= upto:
            continue
        if a >= upto:
            out += [text[upto:a], f"<{KINDS[k]}>"]
        upto = b
    return "".join([*out, text[upto:]])


def _mask(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            texts = part.column("text").to_pylist()
            masked = [mask(t, sorted([*base, *more])) if base or more else t for t, (base, more) in zip(texts, spans(texts, model.value), strict=True)]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, part.schema.field(at), pa.array(masked, part.schema.field(at).type))


def mask_private(documents: DataFrame) -> DataFrame:
    """The documents with personal data masked; ``n_chars`` follows where it is a column."""
    small_batches(documents.sparkSession)
    model = documents.sparkSession.sparkContext.broadcast(train(labelled_table()))
    masked = documents.mapInArrow(lambda batches: _mask(batches, model), documents.schema)
    if "n_chars" in documents.columns:
        changed = F.length("text").cast(documents.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return masked.select(documents.columns)
