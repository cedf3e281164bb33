"""Main text of web pages, with a suffix array per host over all that stands outside articles.

Pages are cut into blocks. Of every page the tokens outside articles go to its host: the
token streams of its pages are concatenated, a suffix array (sorted to a fixed depth) finds
long substrings that distinct pages share, covered tokens are removed as boilerplate and
the unique runs are kept. Blocks too short for a run go if enough distinct pages hold the
whole block. An exact check by markup follows: articles are whole, and menus, headers,
footers, sidebars, notices, adverts, forms and comments go even where they are unique. Pages are distinct by what they say: copies of a page count
once. A large host is cut into chunks of pages: the suffix array of a chunk counts the
pages of each run, the counts are added up over the host, and the runs that enough pages
of the host share go back to its chunks. Which chunk holds a page changes nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BROADCAST_IDS, small_batches, stored

#: A substring of at least DEPTH tokens that PAGES distinct pages of a host share is boilerplate.
DEPTH, PAGES = 8, 3
#: Pages of a host in one chunk, about.
CHUNK = 512

# Element names of HTML by what they mean here.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "head", "object", "canvas", "math"}
AWAY = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "datalist", "label", "input"}
VOID = {"br", "img", "hr", "input", "meta", "link", "source", "track", "wbr", "area", "base", "col", "embed", "param"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
    "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert"}
# Words of a class or id that name boilerplate.
NAMES = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "topbar", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "share", "sharing", "social", "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "related",
    "recommended", "widget", "toolbar", "pager", "pagination", "login", "search", "skip", "disclaimer",
}
OWN = {"article", "entry", "post", "story", "content"}  # "article-header" is the article's own

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|</?\Z", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _goes(name: str, attributes: str, inside: bool) -> bool:
    """Does this element, by its markup, hold no main text?"""
    if name in AWAY or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & NAMES and not (words & OWN and words & NAMES <= {"header"}):
                return True
        elif key == "role" and value in ROLES:
            return True
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(kind, text) of each block in page order; kind: "main", "away", or "open" where markup does not decide."""
    out: list[tuple[str, str]] = []
    buffer: list[str] = []
    article = 0  # depth of open article (or main) elements
    away, depth = "", 0  # the element that is being left out, and how often its name is open
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append(("away" if away else "main" if article else "open", text))

    for m in TAG.finditer(page):
        if m.start() < at:  # inside a script or the like
            continue
        buffer.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closes = m[2].lower(), bool(m[1])
        if name in RAW:
            if not closes and not m[3].rstrip().endswith("/"):
                found = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, at)
                if found or name != "head":
                    at = found.end() if found else len(page)
            continue
        if name in BLOCK:
            flush()
        elif name in ("br", "td", "th", "img", "wbr"):
            buffer.append(" ")
        if away == "p" and name in BLOCK and not closes:
            away = ""  # a paragraph ends where the next block begins
        elif away and name == away:
            depth += -1 if closes else name not in VOID
            if depth <= 0:
                flush()
                away = ""
                continue
        elif away and closes and name in ("article", "main", "body", "html"):
            away = ""
        if name in ("article", "main"):
            article = max(0, article - 1) if closes else article + 1
        elif not away and not closes and name not in VOID and _goes(name, m[3], article > 0):
            flush()
            away, depth = name, 1
    buffer.append(page[at:])
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", url or "")
    return m[1].lower() if m else ""


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            found = [blocks_of(x or "") for x in part.column("html").to_pylist()]
            inside = [any(kind == "main" for kind, _ in f) for f in found]
            content = [xxhash.xxh3_128_digest("\0".join(x for b in f for x in b).encode("utf-8", "surrogatepass")) for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(content, pa.binary()), part.column("page_id"), part.column("url"), pa.array([host_of(u) for u in part.column("url").to_pylist()], pa.string()),
                pa.array([[kind for kind, _ in f] for f in found], pa.list_(pa.string())), pa.array([[t for _, t in f] for f in found], pa.list_(pa.string())),
                pa.array(inside, pa.bool_()), pa.array([any(kind == "open" for kind, _ in f) for f in found], pa.bool_()),
            ], names=["content", "page_id", "url", "host", "kinds", "texts", "inside", "open"])


def ranked(streams: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of the run of ``depth`` tokens that starts there, stream) of each token; equal runs have equal ranks.

    The streams are concatenated with separators of their own and their suffixes ranked by
    doubling (1, 2, 4, ... tokens) until ``depth`` tokens are told apart.
    """
    total = sum(len(s) for s in streams)
    owner = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    if not total:
        return np.zeros(0, dtype=np.int64), owner
    tokens = np.unique(np.concatenate(streams), return_inverse=True)[1].astype(np.int64)
    # A separator after each stream, different from all tokens and from each other.
    ends = np.cumsum([len(s) + 1 for s in streams]) - 1
    rank = np.empty(total + len(streams), dtype=np.int64)
    place = np.arange(total) + owner
    rank[place] = tokens
    rank[ends] = tokens.max(initial=0) + 1 + np.arange(len(streams))
    known = 1
    while known < depth:
        step = min(known, depth - known)
        after = np.full(len(rank), -1, dtype=np.int64)
        after[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        known += step
    return rank[place], owner


def pages_of(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distinct streams of each rank."""
    many = int(owner.max(initial=0)) + 1
    return np.bincount(np.unique(own * many + owner) // many, minlength=int(own.max(initial=-1)) + 1)


def covered_by(starts: np.ndarray, streams: list[np.ndarray], depth: int) -> list[np.ndarray]:
    """For each stream: which tokens the runs of ``depth`` tokens that start at ``starts`` (a mask of all tokens) cover."""
    cover = np.zeros(len(starts) + depth + 1, dtype=np.int64)
    cover[:-depth - 1] += starts
    cover[depth:-1] -= starts
    return np.split(np.cumsum(cover)[: len(starts)] > 0, np.cumsum([len(s) for s in streams])[:-1])


def repeated(streams: list[np.ndarray], depth: int = DEPTH, pages: int = PAGES) -> list[np.ndarray]:
    """For each stream of tokens: which tokens a substring of ``depth`` tokens shared by ``pages`` streams covers."""
    own, owner = ranked(streams, depth)
    return covered_by((pages_of(own, owner) >= pages)[own], streams, depth)


def run_hashes(streams: list[np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the run of ``depth`` tokens that starts there, whether its stream holds all of it) of each token."""
    total = sum(len(s) for s in streams)
    tokens = np.concatenate([*streams, np.zeros(depth, dtype=np.uint64)]).astype(np.uint64)
    left = np.concatenate([np.zeros(0, dtype=np.int64), *[np.arange(len(s), 0, -1) for s in streams]])
    out = np.full(total, 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(depth):
        out = (out ^ tokens[k : k + total]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out.view(np.int64), left >= depth


def unique_runs(texts: list[str], covered: np.ndarray) -> list[str]:
    """Each block without its covered tokens; blocks that lose all of them are empty."""
    out, at = [], 0
    for t in texts:
        words = t.split(" ")
        keep = ~covered[at : at + len(words)]
        at += len(words)
        out.append(t if keep.all() else " ".join(w for w, k in zip(words, keep, strict=True) if k))
    return out


def _streams(texts: list[list[str]]) -> list[np.ndarray]:
    return [np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for t in ts for w in t.split(" ")], dtype=np.uint64) for ts in texts]


def short_blocks(texts: list[str], depth: int = DEPTH) -> list[int | None]:
    """The hash of each block of fewer than ``depth`` tokens (as a whole), none of longer ones."""
    return [xxhash.xxh3_64_intdigest(("block\0" + t).encode("utf-8", "surrogatepass")) if t.count(" ") + 1 < depth else None for t in texts]


def _runs(key, table: pa.Table) -> pa.Table:
    """Runs and short blocks of a chunk with the number of its pages that hold them; of a host with one chunk only the shared ones."""
    texts = table.column("texts").to_pylist()
    streams = _streams(texts)
    own, owner = ranked(streams, DEPTH)
    hashes, whole = run_hashes(streams)
    pages = pages_of(own[whole], owner[whole])
    first = np.unique(own[whole], return_index=True)
    runs, pages = hashes[whole][first[1]], pages[first[0]]
    short = np.array([h for ts in texts for h in {h for h in short_blocks(ts) if h is not None}], dtype=np.uint64)
    blocks, times = np.unique(short, return_counts=True)
    runs, pages = np.r_[runs, blocks.view(np.int64)], np.r_[pages, times]
    if key[2].as_py() == 1:
        runs, pages = runs[pages >= PAGES], pages[pages >= PAGES]
    host, chunk = (pa.array([k.as_py()] * len(runs), t) for k, t in zip(key, (pa.string(), pa.int64()), strict=False))
    return pa.table({"host": host, "chunk": chunk, "run": pa.array(runs, pa.int64()), "pages": pa.array(pages, pa.int64())})


def _host(key, table: pa.Table, shared: pa.Table) -> pa.Table:
    """Of each page the blocks outside articles that are left (less their shared runs), and how many tokens are shared."""
    places, kinds, texts = (table.column(c).to_pylist() for c in ("places", "kinds", "texts"))
    streams = _streams(texts)
    hashes, whole = run_hashes(streams)
    common = shared.column("run").to_numpy()
    starts, common = whole & np.isin(hashes, common), set(common.view(np.uint64).tolist())
    out, gone = [], []
    for i, covered in enumerate(covered_by(starts, streams, DEPTH)):
        short = short_blocks(texts[i])
        left = ["" if s in common else t for t, s in zip(unique_runs(texts[i], covered), short, strict=True)]
        gone.append(len(covered) - sum(t.count(" ") + 1 for t in left if t))
        # The check by markup: what it rules out goes although it is unique.
        out.append([{"place": at, "text": t} for at, kind, t in zip(places[i], kinds[i], left, strict=True) if t and kind != "away"])
    return pa.table({
        "host": pa.array([key[0].as_py()] * len(out), pa.string()), "content": table.column("content"), "shared": pa.array(gone, pa.int64()),
        "kept": pa.array(out, pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())]))),
    })


def cut_pages(pages: DataFrame) -> DataFrame:
    """The blocks of every page row, stored."""
    kind = dict(pages.dtypes)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = f"content binary, page_id {kind['page_id']}, url {kind['url']}, host string, kinds array<string>, texts array<string>, inside boolean, open boolean"
    return stored(rows.mapInArrow(_cut, schema), "page-blocks")


def _block_structs() -> Column:
    return F.transform("kinds", lambda k, i: F.struct(i.alias("place"), k.alias("kind"), F.get("texts", i).alias("text")))


def decided_by_hosts(cut: DataFrame) -> DataFrame:
    """host, content, shared (tokens outside articles in runs or blocks that the host repeats) and kept
    (the blocks left of them) of every distinct page, also of those whose blocks markup decides."""
    hosts = stored(cut.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "page-hosts")
    hosts = F.broadcast(hosts) if hosts.count() <= BROADCAST_IDS else hosts
    beside = F.filter(_block_structs(), lambda b: b["kind"] != "main")
    # Each content of a host once; copies go before they are shuffled.
    streams = cut.join(hosts, "host").select(
        "host", "content", "pages", *[beside.getField(c).alias(f"{c}s") for c in ("place", "kind", "text")],
    ).dropDuplicates(["host", "content"])
    chunks = F.ceil(F.col("pages") / CHUNK)
    streams = streams.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("content"), chunks)).drop("pages")
    runs = streams.select("host", "chunk", "chunks", "texts").groupBy("host", "chunk", "chunks").applyInArrow(
        lambda key, table: _runs(key, table), "host string, chunk long, run long, pages long"
    )
    runs = stored(runs, "page-runs")
    shared = runs.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= PAGES)
    shared = runs.select("host", "run", "chunk").join(shared.select("host", "run"), ["host", "run"]).select("host", "chunk", "run")
    return streams.drop("chunks").groupBy("host", "chunk").cogroup(shared.groupBy("host", "chunk")).applyInArrow(
        lambda key, table, shared: _host(key, table, shared), "host string, content binary, shared long, kept array<struct<place:int,text:string>>"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page row.

    Blocks of articles are kept as they are. Of the others, on pages with and without an
    article, the runs and the short blocks that PAGES distinct pages of their host share go,
    then what markup rules out; the rest is kept in page order, joined by empty lines.
    Copies of a page are one distinct page, however many rows hold them; each row gets its
    text. Null and empty pages have empty text; pages without a host in their url share the
    empty host. Cut-off pages end where they are cut. Reads page_id, url and html.
    """
    small_batches(pages.sparkSession)
    cut = cut_pages(pages)
    # What the hosts leave of a page and markup does not rule out, stored: pages of which nothing is left have no row.
    kept = stored(decided_by_hosts(cut).where(F.size("kept") > 0).select("host", "content", "kept"), "page-kept")
    main = F.transform(F.filter(_block_structs(), lambda b: b["kind"] == "main"), lambda b: F.struct(b["place"].alias("place"), b["text"].alias("text")))
    none = F.array().cast("array<struct<place:int,text:string>>")
    rows = cut.select("host", "content", "page_id", "url", main.alias("main")).join(kept, ["host", "content"], "left")
    rows = rows.select("page_id", "url", F.array_sort(F.concat("main", F.coalesce("kept", none))).alias("blocks"))
    text = F.array_join(F.col("blocks").getField("text"), "\n\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
