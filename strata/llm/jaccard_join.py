"""N-gram Jaccard self-join with adaptive multi-match prefixes.

1. Every text becomes its set of word n-gram hashes; equal sets share a 128-bit fingerprint
   and are one node from then on. A fixed-size sketch counts n-grams over all texts.
2. A node orders its n-grams by sketched frequency, rare ones first. The sketch is of fixed
   size, so the more texts there are the less it tells rare n-grams from common ones: the
   n-grams that nodes would begin with are counted one by one, and those of long lists go last.
   Two sets that overlap in at least t n-grams share at least l of their first
   (size - t + l): a node lengthens its prefix (l = 1, 2, ...) as long as that lowers the
   estimated cost, which is the postings read plus the candidates that Sum(postings) / l
   still lets through.
3. Postings are sorted by n-gram and streamed. A short list yields pairs; a pair is a
   candidate once it shares min(l of both) prefix n-grams of those levels. A long list (a
   family of copies) yields one edge a member instead of all pairs.
4. Candidates and edges fall into connected families. Families are cut into cells by size
   band and salt; each pair of cells that can hold links is verified exactly, and returns
   link counts and a spanning forest, never all links.
5. The forest's components are the classes.

No step collects rows, links or components to the driver; only the sketch and two bit sets go
through it, whose size is bounded.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import no_mark, small_batches, stored, text_mark, with_key

#: The sketch has 2 ** SKETCH_BITS buckets, added up in so many slices.
SKETCH_BITS, SLICES = 20, 32
MAX_LEVEL = 4
#: Relative cost of verifying a candidate, in postings read.
VERIFY_COST = 8.0
#: Postings up to this length yield pairs; longer ones edges to their first member.
SHORT_LIST = 24
#: Beyond a prefix, one n-gram in so many is counted too: they take the places of those that go last.
SPARE = 4
#: A slice of the n-grams that are counted one by one is a share of about so many n-grams of the corpus.
COUNTED_GRAMS = 2_000_000
#: A cell holds about so many n-grams and nodes.
CELL_GRAMS, CELL_NODES = 400_000, 1_500

_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ sets of n-grams


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text.

    A-Z are lower-cased, words are what ASCII white space separates; a text of fewer words
    is one n-gram of all its words; no words, no n-grams.
    """

    def __init__(self, n: int):
        self.n, self.seen = n, {}

    def words(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.seen) > 100_000:
            self.seen.clear()
        seen, out = self.seen, []
        for w in found:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text)
        if not len(words):
            return words
        n = min(self.n, len(words))
        grams = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            grams = (grams ^ words[k : len(words) - n + 1 + k]) * _MIX
            grams ^= grams >> np.uint64(29)
        return np.unique(grams)


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(grams.tobytes())
    return tuple(np.frombuffer(digest, dtype=np.int64).tolist())


def least_overlap(size, percent: int):
    """The n-grams that a set of this size shares at least with any set it is linked to."""
    return -(-percent * size // 100)


def _buckets(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _survey(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row of (doc_id, key, mark, size, fa, fb) a document, then this task's share of the sketch in slices."""
    shingle, counts = Shingler(n), np.zeros(1 << SKETCH_BITS, dtype=np.int32)
    for batch in batches:
        sizes, marks = [], []
        for text in batch.column("text").to_pylist():
            grams = shingle(text)
            np.add.at(counts, _buckets(grams), 1)
            sizes.append(len(grams))
            marks.append(fingerprint(grams))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), batch.column("key"), batch.column("mark"), pa.array(sizes, pa.int64()),
            pa.array([a for a, _ in marks], pa.int64()), pa.array([b for _, b in marks], pa.int64()),
            pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary()),
        ], names=["doc_id", "key", "mark", "size", "fa", "fb", "slice", "counts"])
    if counts.any():
        none = pa.nulls(SLICES, pa.int64())
        shares = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SLICES)]
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(SLICES, pa.binary()), none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(shares, pa.binary())], names=["doc_id", "key", "mark", "size", "fa", "fb", "slice", "counts"])


SURVEY = "doc_id long, key long, mark binary, size long, fa long, fb long, slice int, counts binary"


def _add_up(key, table: pa.Table) -> pa.Table:
    total = np.zeros((1 << SKETCH_BITS) // SLICES, dtype=np.int64)
    for share in table.column("counts"):
        total += np.frombuffer(zlib.decompress(share.as_py()), dtype=np.int32)
    counts = np.minimum(total, 2**31 - 1).astype(np.int32)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})


def sketch_of(survey: DataFrame) -> bytes:
    """The counts of all buckets; 4 bytes each, whatever the size of the corpus."""
    shares = survey.where("slice is not null").select("slice", "counts")
    added = shares.groupBy("slice").applyInArrow(lambda key, shares: _add_up(key, shares), "slice int, counts binary")
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
    per = len(counts) // SLICES
    for r in added.toLocalIterator():
        counts[r["slice"] * per : (r["slice"] + 1) * per] = np.frombuffer(r["counts"], dtype=np.int32)
    return counts.tobytes()


# ------------------------------------------------------------------ prefixes


def ordered(grams: np.ndarray, counts: np.ndarray, most: int, common: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and frequencies of the first ``most`` n-grams: rare ones first, those of the bit set ``common`` last."""
    freq = counts[_buckets(grams)].astype(np.int64)
    order = np.lexsort((grams, freq))
    if common is not None:
        late = _held(grams[order[: most + most // SPARE]], common)
        if len(late) - late.sum() < most and len(late) < len(order):
            late = _held(grams[order], common)
        order, late = order[: len(late)], late.astype(np.int64)
        freq[order] += late << 32
        order = order[np.argsort(late, kind="stable")]
    return order[:most], freq[order[:most]]


def prefix(grams: np.ndarray, counts: np.ndarray, percent: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the chosen prefix and the level at which each enters it."""
    size, t = len(grams), int(least_overlap(len(grams), percent))
    base = size - t + 1
    order, freq = ordered(grams, counts, base + MAX_LEVEL - 1, common)
    read = np.cumsum(freq.astype(np.float64))
    best, level = None, 1
    for k in range(1, min(MAX_LEVEL, t) + 1):
        cost = read[base + k - 2] * (1.0 + VERIFY_COST / k)
        if best is None or cost < best:
            best, level = cost, k
    take = order[: base + level - 1]
    return grams[take], np.maximum(1, np.arange(len(take)) - base + 2)


def _counted(batches: Iterator[pa.RecordBatch], n: int, percent: int, sketch: bytes, slices: int, short: int) -> Iterator[pa.RecordBatch]:
    """The n-grams that may enter prefixes, and how often in this task, by slice; not those that the sketch knows to be rare."""
    shingle, counts = Shingler(n), np.frombuffer(sketch, dtype=np.int32)
    last, found, held = set(), [], 0

    def send() -> pa.RecordBatch:
        grams, times = np.unique(np.concatenate(found), return_counts=True)
        part = (grams & np.uint64(0xFFFFFFFF)) % np.uint64(slices)
        order = np.argsort(part, kind="stable")
        here, first = np.unique(part[order], return_index=True)
        cut = lambda x: pa.array([p.tobytes() for p in np.split(x[order], first[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32), pa.int32()), cut(grams), cut(times.astype(np.int32))], names=["slice", "grams", "times"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            grams = shingle(text)
            if len(grams) < 2 or (mark := fingerprint(grams)) in last:
                continue
            last.add(mark)
            most = len(grams) - int(least_overlap(len(grams), percent)) + MAX_LEVEL
            order, freq = ordered(grams, counts, most + most // SPARE, None)
            found.append(grams[order[freq > short]])
            held += len(found[-1])
        if len(last) > 50_000:
            last.clear()
        if held > 2_000_000:
            yield send()
            found, held = [], 0
    if held:
        yield send()


def _long_lists(shares: pa.Table, short: int) -> pa.Table:
    """The n-grams that more than ``short`` texts may begin with."""
    joined = lambda c, kind: np.frombuffer(b"".join(shares.column(c).to_pylist()), dtype=kind)
    grams, index = np.unique(joined("grams", np.uint64), return_inverse=True)
    times = np.bincount(index, weights=joined("times", np.int32))
    return pa.table({"gram": pa.array(grams[times > short].view(np.int64), pa.int64())})


def common_grams(read: DataFrame, n: int, percent: int, sketch: bytes) -> bytes | None:
    """A bit set of n-grams whose lists would be long, None if there are none.

    Any order of n-grams that all texts share finds all links; what is in the set (others may
    seem to be) decides about cost only.
    """
    counts, short = np.frombuffer(sketch, dtype=np.int32), SHORT_LIST
    if counts.max() <= short:
        return None
    slices = 1 + int(counts.sum(dtype=np.int64)) // COUNTED_GRAMS
    shares = read.select("text").mapInArrow(
        functools.partial(_counted, n=n, percent=percent, sketch=sketch, slices=slices, short=short), "slice int, grams binary, times binary"
    )
    found = stored(shares.groupBy("slice").applyInArrow(lambda shares: _long_lists(shares, short), "gram long"), "jaccard-common")
    return bit_set(found) if found.limit(1).count() else None


def _postings(batches: Iterator[pa.RecordBatch], n: int, percent: int, sketch: bytes, common: bytes | None) -> Iterator[pa.RecordBatch]:
    shingle, counts = Shingler(n), np.frombuffer(sketch, dtype=np.int32)
    late = None if common is None else np.frombuffer(common, dtype=np.uint64)
    last: set = set()
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            out = []
            for text in batch.column("text").slice(k, 256).to_pylist():
                grams = shingle(text)
                if len(grams) < 2:  # none, or one: linked with equal sets only
                    continue
                mark = fingerprint(grams)
                if mark in last:  # copies met in this task are said once
                    continue
                last.add(mark)
                tokens, levels = prefix(grams, counts, percent, late)
                out.append((tokens, levels, len(grams), int(levels[-1]), mark))
            if len(last) > 50_000:
                last.clear()
            if out:
                rep = [len(x[0]) for x in out]
                fill = lambda at: np.repeat(np.array([at(x) for x in out], dtype=np.int64), rep)
                yield pa.RecordBatch.from_pydict({
                    "gram": np.concatenate([x[0] for x in out]).view(np.int64), "size": fill(lambda x: x[2]),
                    "level": np.concatenate([x[1] for x in out]).astype(np.int8), "levels": fill(lambda x: x[3]).astype(np.int8),
                    "fa": fill(lambda x: x[4][0]), "fb": fill(lambda x: x[4][1]),
                })


POSTINGS = "gram long, size long, level byte, levels byte, fa long, fb long"


def _meet(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From postings sorted by (gram, size, fa, fb): candidate pairs of short lists, edges of long ones.

    At most one batch and ``SHORT_LIST`` postings of the list that a batch ends in are held.
    """
    names = ["gram", "size", "level", "levels", "fa", "fb"]
    kept, head, after = None, None, None  # postings carried over; first member and gram of a long list under way

    def pairs(block: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        found, width = [], stops - starts
        for m in np.unique(width[width > 1]):  # lists of one length at a time
            at = starts[width == m][:, None]
            i, j = np.triu_indices(int(m), 1)
            a, b = block[(at + i).ravel()], block[(at + j).ravel()]
            need = np.minimum(a["levels"], b["levels"])
            ok = (np.maximum(a["level"], b["level"]) <= need) & (100 * a["size"] >= percent * b["size"]) & ((a["fa"] != b["fa"]) | (a["fb"] != b["fb"]))
            a, b, need = a[ok], b[ok], need[ok]
            found.append(_edges(a["fa"], a["fb"], b["fa"], b["fb"], need))
        return found

    kind = np.dtype([("gram", "i8"), ("size", "i8"), ("level", "i1"), ("levels", "i1"), ("fa", "i8"), ("fb", "i8")])
    for batch in batches:
        if not batch.num_rows:
            continue
        block = np.empty(batch.num_rows, dtype=kind)
        for c in names:
            block[c] = batch.column(c).to_numpy(zero_copy_only=False)
        out = []
        if after is not None:  # a long list goes on
            n = int(np.searchsorted(block["gram"] != after, True)) if (block["gram"] != after).any() else len(block)
            out.append(_star(head, block[:n]))
            if n == len(block):
                yield from _send(out)
                continue
            block, after, head = block[n:], None, None
        if kept is not None:
            block = np.concatenate([kept, block])
            kept = None
        same = np.r_[False, (block["gram"][1:] == block["gram"][:-1]) & (block["fa"][1:] == block["fa"][:-1]) & (block["fb"][1:] == block["fb"][:-1])]
        block = block[~same]  # copies from other tasks stand side by side
        edge = np.flatnonzero(np.r_[True, block["gram"][1:] != block["gram"][:-1]])
        starts, stops = edge, np.r_[edge[1:], len(block)]
        if stops[-1] - starts[-1] > SHORT_LIST:
            after, head = block["gram"][-1], block[starts[-1]].copy()
        else:
            kept = block[starts[-1] :].copy()
            starts, stops = starts[:-1], stops[:-1]
        long = stops - starts > SHORT_LIST
        for s, e in zip(starts[long], stops[long], strict=True):
            out.append(_star(block[s], block[s + 1 : e]))
        out += pairs(block, starts[~long], stops[~long])
        yield from _send(out)
    if kept is not None:
        yield from _send(pairs(kept, np.array([0]), np.array([len(kept)])))


EDGE = np.dtype([("aa", "i8"), ("ab", "i8"), ("ba", "i8"), ("bb", "i8"), ("need", "i1")])
MEET = "aa long, ab long, ba long, bb long, need byte"


def _edges(aa, ab, ba, bb, need) -> np.ndarray:
    swap = (aa > ba) | ((aa == ba) & (ab > bb))
    out = np.empty(len(ba), dtype=EDGE)
    out["aa"], out["ba"] = np.where(swap, ba, aa), np.where(swap, aa, ba)
    out["ab"], out["bb"] = np.where(swap, bb, ab), np.where(swap, ab, bb)
    out["need"] = need
    return out


def _star(head: np.void, members: np.ndarray) -> np.ndarray:
    """need 0: an edge of a family, not a candidate by itself."""
    members = members[(members["fa"] != head["fa"]) | (members["fb"] != head["fb"])]
    one = np.ones(len(members), dtype=np.int64)
    return _edges(one * head["fa"], one * head["fb"], members["fa"], members["fb"], 0)


def _send(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for x in found:
        for k in range(0, len(x), 200_000):
            part = x[k : k + 200_000]
            yield pa.RecordBatch.from_pydict({c: np.ascontiguousarray(part[c]) for c in EDGE.names})


# ------------------------------------------------------------------ families, cells, verification


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the least node that each node of (a, b) edges reaches, by large and small stars.

    Each round is two aggregations over the edges and is written to the shared folder; the
    rounds grow with the logarithm of the longest path.
    """
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        # Large star: every larger neighbour of a node goes to the node's least neighbour.
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(low.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, name)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


#: The bit set of wanted ids has about 16 bits an id, at most 2 ** MOST_BITS in all (16 MB).
MOST_BITS = 27


def _spots(ids: np.ndarray, bits: int) -> np.ndarray:
    """Four bit positions of each id."""
    mixed = (ids.astype(np.int64).view(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    return np.concatenate([((mixed * np.uint64(odd)) >> np.uint64(64 - bits)).astype(np.int64) for odd in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)])


def _set_bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
        at = np.unique(_spots(ids, bits))
        word, first = np.unique(at >> 6, return_index=True)
        value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(value.view(np.int64), pa.int64())], names=["word", "bits"])


def bit_set(ids: DataFrame) -> bytes:
    """A Bloom filter over the one column of ``ids``, its words put together in Spark; at most 16 MB."""
    bits = min(MOST_BITS, max(10, (8 * ids.count()).bit_length() + 1))
    found = ids.mapInArrow(functools.partial(_set_bits, bits=bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.tobytes()


def _held(ids: np.ndarray, field: np.ndarray) -> np.ndarray:
    """Whether each id may be in the set of these words."""
    at = _spots(ids, len(field).bit_length() + 5)
    held = (field[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
    return held.reshape(4, -1).all(axis=0)


def _wanted(batches: Iterator[pa.RecordBatch], words: bytes) -> Iterator[pa.RecordBatch]:
    """Rows whose key may be in the set: only their texts are shuffled."""
    field = np.frombuffer(words, dtype=np.uint64)
    for batch in batches:
        yield batch.filter(pa.array(_held(batch.column("key").to_numpy(zero_copy_only=False), field), pa.bool_()))


SETS = "root struct<fa:long,fb:long>, fa long, fb long, copies long, size long, grams binary"


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    shingle, names = Shingler(n), ["root", "fa", "fb", "copies", "size"]
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            grams = [shingle(text) for text in part.column("text").to_pylist()]
            marks = zip(part.column("fa").to_pylist(), part.column("fb").to_pylist(), strict=True)
            right = pa.array([fingerprint(g) == m for g, m in zip(grams, marks, strict=True)], pa.bool_())
            columns = [*[part.column(c) for c in names], pa.array([g.tobytes() for g in grams], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "grams"]).filter(right)


def verify(sets: list[np.ndarray], left: np.ndarray, inner: bool, percent: int, copies: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of the left sets with the others (and, if inner, among the left): weighted counts and a spanning forest."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    tokens, index = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(size)]
    order = np.argsort(index, kind="stable")
    held = np.repeat(np.arange(len(sets)), size)[order]  # postings, by token
    begin = np.r_[0, np.cumsum(np.bincount(index, minlength=len(tokens)))]
    links, forest, root = np.zeros(len(sets), dtype=np.int64), [], np.arange(len(sets))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in np.flatnonzero(left):
        own = index[starts[i] : starts[i + 1]]
        width = begin[own + 1] - begin[own]
        own, width = own[width > 1], width[width > 1]
        if not len(own):
            continue
        at = np.repeat(begin[own] - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
        shared = np.bincount(held[at], minlength=len(sets))
        ok = (100 + percent) * shared >= percent * (size[i] + size)
        ok &= ~left | (inner & (np.arange(len(sets)) > i))
        for j in np.flatnonzero(ok).tolist():
            links[i] += copies[j]
            links[j] += copies[i]
            a, b = find(int(i)), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                forest.append((int(i), j))
    return links, forest


LINKS = "aa long, ab long, ba long, bb long, links long"


def _cell(key, table: pa.Table, percent: int) -> pa.Table:
    """Links counted for each node of the cell, and its forest (links 0)."""
    sets = [np.frombuffer(b, dtype=np.uint64) for b in table.column("grams").to_pylist()]
    left = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
    inner = key[2].as_py() == key[3].as_py()
    links, forest = verify(sets, left, inner, percent, table.column("copies").to_numpy())
    fa, fb = table.column("fa").to_numpy(), table.column("fb").to_numpy()
    i, j = np.array(forest, dtype=np.int64).reshape(-1, 2).T
    at = np.flatnonzero(links)
    return pa.table({
        "aa": np.r_[fa[i], fa[at]], "ab": np.r_[fb[i], fb[at]], "ba": np.r_[fa[j], fa[at]], "bb": np.r_[fb[j], fb[at]],
        "links": np.r_[np.zeros(len(i), dtype=np.int64), links[at]],
    })


def node(a: str = "fa", b: str = "fb") -> Column:
    return F.struct(F.col(a).alias("fa"), F.col(b).alias("fb"))


def candidate_pairs(read: DataFrame, n: int, percent: int, sketch: bytes) -> DataFrame:
    """(a, b) nodes: pairs that share enough prefix n-grams, and the edges of long lists."""
    common = common_grams(read, n, percent, sketch)
    postings = read.select("text").mapInArrow(functools.partial(_postings, n=n, percent=percent, sketch=sketch, common=common), POSTINGS)
    met = (
        postings.repartition("gram").sortWithinPartitions("gram", "size", "fa", "fb")
        .mapInArrow(functools.partial(_meet, percent=percent), MEET)
    )
    enough = met.groupBy("aa", "ab", "ba", "bb").agg(F.count(F.lit(1)).alias("times"), F.min("need").alias("need")).where("times >= need")
    return enough.select(node("aa", "ab").alias("a"), node("ba", "bb").alias("b"))


def cells(sets: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Deal (root, fa, fb, copies, size, grams) to the cells (root, band, x, y) where its links are looked for.

    Linked sizes differ by less than a band's width, so a set meets its own and the two
    neighbouring bands. A family's bands are cut into salts: cell (band, x, y) compares
    salt x of the band with salt y of the next band, and of the same band if y > x, and
    with itself if y = x.
    """
    width = math.log(100 / percent) * 1.0001
    total = families.groupBy("root").agg(F.sum("size").alias("grams"), F.count(F.lit(1)).alias("nodes"))
    salts = total.select("root", F.greatest(F.ceil(F.col("grams") / CELL_GRAMS), F.ceil(F.col("nodes") / CELL_NODES)).cast("int").alias("salts"))
    dealt = sets.join(salts, "root").withColumn("band", F.floor(F.log(F.col("size").cast("double")) / width).cast("int"))
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("fb"), F.col("salts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    to = lambda band, x, y, left: F.struct(band.alias("band"), x.alias("x"), y.alias("y"), F.lit(left).alias("left"))
    salt, band = F.col("salt"), F.col("band")
    goes = F.concat(
        F.transform(every, lambda y: to(band, salt, y, True)),
        F.filter(F.transform(every, lambda x: to(band, x, salt, False)), lambda c: c["x"] < salt),
        F.transform(every, lambda x: to(band - 1, x, salt, False)),
    )
    return dealt.select("root", "fa", "fb", "copies", "grams", F.explode(goes).alias("cell")).select("root", "cell.*", "fa", "fb", "copies", "grams")


def jaccard_classes(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every document row.

    Two documents link when 100 * intersection >= percent * union of their n-gram sets;
    ``component_id`` is the least doc_id reachable by links (itself included), ``n_links``
    the number of other rows linked with the row. Texts without words (null, empty, only
    white space) link with nothing: their own doc_id, no links. Repeated rows are rows of
    their own, linked with each other. A null doc_id takes part; a class of null ids only
    has a null id. Only ``doc_id`` and ``text`` are read.
    """
    return _classes(documents, n, percent, no_mark()).select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("size") > 0, F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def _classes(documents: DataFrame, n: int, percent: int, mark: Column) -> DataFrame:
    """doc_id, mark, size, component, links of every document row, and the ``first`` row of its class (null without words).

    First is the least doc_id, rows without one last, then the least fingerprint and mark.
    """
    if not 50 < percent < 100:
        raise ValueError("percent must lie between 50 and 100: sets of one n-gram are taken to link with equal sets only")
    small_batches(documents.sparkSession)
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    # The key tells rows apart whose ids are equal or missing; where it falls together all the same, fingerprints do.
    read = documents.select(F.xxhash64(doc_id, text).alias("key"), text.alias("text"))
    marked = documents.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), text.alias("text"), mark.alias("mark"))
    survey = stored(marked.mapInArrow(functools.partial(_survey, n=n), SURVEY), "jaccard-survey")
    docs = survey.where("slice is null").select("doc_id", "key", "mark", "size", "fa", "fb")
    families = connected(candidate_pairs(read, n, percent, sketch_of(survey)), "jaccard-families")

    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fa", "fb", "mark")
    classes = docs.where("size > 0").groupBy("fa", "fb").agg(
        F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"), F.min(order).alias("first")
    )
    families = stored(families.select("root", "node.*").join(classes.drop("first", "doc_id"), ["fa", "fb"]), "jaccard-families")
    # One text of each set is read again; copies of a row go before they are shuffled.
    near = read.mapInArrow(functools.partial(_wanted, words=bit_set(families.select("key"))), "key long, text string")
    near = near.withColumn("mark", F.md5(F.col("text").cast("binary"))).dropDuplicates(["key", "mark"])
    texts = near.join(families, "key").select("root", "fa", "fb", "copies", "size", "text")
    sets = texts.mapInArrow(functools.partial(_sets, n=n), SETS).dropDuplicates(["fa", "fb"])
    linked = stored(
        cells(sets, families, percent).groupBy("root", "band", "x", "y").applyInArrow(lambda key, sets: _cell(key, sets, percent), LINKS), "jaccard-links"
    )
    forest = linked.where("links = 0").select(node("aa", "ab").alias("a"), node("ba", "bb").alias("b"))
    reach = connected(forest, "jaccard-classes").select("root", "node.*")
    least = classes.join(reach, ["fa", "fb"])
    least = least.join(least.groupBy("root").agg(F.min("doc_id").alias("component"), F.min("first").alias("least")), "root").select("fa", "fb", "component", "least")
    count = linked.where("links > 0").groupBy(F.col("aa").alias("fa"), F.col("ab").alias("fb")).agg(F.sum("links").alias("links"))
    per = classes.join(least, ["fa", "fb"], "left").join(count, ["fa", "fb"], "left").select(
        "fa", "fb", F.coalesce("component", "doc_id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("least", "first").alias("first")
    )
    return docs.join(per, ["fa", "fb"], "left").select("doc_id", "mark", "size", "component", "links", F.when(F.col("size") > 0, F.col("first")).alias("first"))


def one_of_each_class(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Of each class of documents that link over any number of steps one row: the least doc_id, rows without one last.

    What a row links with is decided by its own text, so rows with a repeated or no doc_id
    are not drawn along by others, and different texts under one doc_id are documents of
    their own. Texts without words link with nothing and stay, repeated rows among them.
    """
    rows = _classes(documents, n, percent, text_mark()).withColumn(
        "stays", F.col("first").isNull() | (F.col("first")["doc_id"].eqNullSafe(F.col("doc_id")) & (F.col("first")["mark"] == F.col("mark")))
    )
    gone = stored(rows.where(~F.col("stays")).select("doc_id", "mark").distinct(), "jaccard-gone")
    kept = with_key(documents, gone, text_mark(), "anti")
    # The row that stays may itself be repeated.
    repeated = rows.where(F.col("stays") & (F.col("size") > 0)).groupBy("doc_id", "mark").count()
    repeated = stored(repeated.where("count > 1").select("doc_id", "mark"), "jaccard-repeated")
    if not repeated.limit(1).count():  # the usual case: no row stands twice
        return kept
    mark = text_mark()
    others = F.to_json(F.struct(*[F.col(c) for c in documents.columns if c != "text"]))
    first = F.row_number().over(Window.partitionBy("doc_id", "__key").orderBy(others))
    one = with_key(kept, repeated, mark, "semi").withColumn("__key", mark).withColumn("__first", first).where("__first = 1").drop("__first", "__key")
    return with_key(kept, repeated, mark, "anti").unionByName(one)


# ---------------------------------------------------------------- registered query

#: Rows with equal sets are one class; classes that share an n-gram are compared, and links followed.
OP8_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)])) END AS grams
  FROM docs),
marked AS (SELECT r, doc_id, len(grams) AS size, md5(array_to_string(grams, chr(10))) AS f, grams FROM sets),
classes AS (SELECT f, any_value(grams) AS grams, any_value(size) AS size, count(*) AS copies, min(doc_id) AS least FROM marked WHERE size > 0 GROUP BY f),
grams AS (SELECT f, size, unnest(grams) AS g FROM classes),
edges AS (
  SELECT a.f AS a, b.f AS b FROM grams a JOIN grams b ON a.g = b.g AND a.f <> b.f AND 100 * b.size >= 90 * a.size AND 100 * a.size >= 90 * b.size
  GROUP BY a.f, b.f, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
reach AS (SELECT f, f AS t FROM classes UNION SELECT reach.f, edges.b FROM reach JOIN edges ON edges.a = reach.t),
component AS (SELECT reach.f, min(classes.least) AS component FROM reach JOIN classes ON classes.f = reach.t GROUP BY reach.f),
links AS (SELECT edges.a AS f, sum(classes.copies) AS n FROM edges JOIN classes ON classes.f = edges.b GROUP BY edges.a)
SELECT m.doc_id, CAST(m.size AS BIGINT) AS n_shingles, CASE WHEN m.size = 0 THEN m.doc_id ELSE component.component END AS component_id,
       CASE WHEN m.size = 0 THEN CAST(0 AS BIGINT) ELSE CAST(classes.copies - 1 + coalesce(links.n, 0) AS BIGINT) END AS n_links
FROM marked m LEFT JOIN classes USING (f) LEFT JOIN component USING (f) LEFT JOIN links USING (f)
"""
