"""Main text of web pages: blocks from the markup, boilerplate by suffix arrays over each host's pages.

Blocks. A page is cut into blocks at block-level tags; white space inside a block becomes one space, character references
are decoded, and scripts, styles, comments, forms and other parts that hold no prose are left out. A block inside an
``article`` or ``main`` element is the page's own, and what it shares with others is still its text.

Suffix arrays. Every block outside articles joins its host's token stream, page after page; pages of the same blocks are
one page. A suffix array (by prefix doubling) over the stream brings repeated runs together. A run of at least ``run``
tokens (or a shorter block, whole) is boilerplate if it occurs on ``share`` of the host's distinct pages, and two at
least. The tokens that such runs cover are cut out, whatever the markup says of them; the unique runs between them stay.

Marks. Only of what runs leave of a block do marks decide: in menus, headers, footers, sidebars, notices, adverts or reader
comments (by element, role, class or id) it goes, elsewhere it stays. So a page without an article is told apart by runs
first, and a menu or notice that stands on no other page is still none of its text.

Plan. Hosts are dealt in shards of about ``shard`` pages, so that one large host is many tasks. A page falls into one shard
by its blocks, so each shard's counts of pages per run add up over the shards of a host, and a run that occurs once in each
of two is found as well. The runs found are broadcast if they number at most ``broadcast_rows``, and else joined to the
pages by host.

Defined results: a null or empty html has empty text and 0 characters; rows with a null url share the empty host; repeated
rows are extracted each; html of any length is read whole; blocks of equal text are kept each; an empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, spread

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img picture source".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav header footer aside form menu dialog button fieldset object embed canvas audio video head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
OWN = frozenset(("article", "main"))
#: Words of a class or id that mark a part as none of the article's.
MARKS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget header masthead footer copyright comment comments reply replies disqus share sharing social related recommended pagination pager toolbar search skip".split())
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[^a-z]+")
#: Elements that a new one of the same kind closes.
SIBLINGS = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())


def marked(tag: str, attrs: str) -> bool:
    """Whether an element is set apart from the article by name, role, class or id."""
    if tag in CHROME:
        return True
    if attrs:
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
                return True
            if name in ("class", "id") and not MARKS.isdisjoint(_WORD.split(value)):
                return True
    return False


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order; kind 1: the article's, 0: set apart, 2: undecided."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, inside a marked part, inside an article)
    held: list[str] = []
    apart = own = False
    at, text = 0, html or ""

    def close() -> None:
        if held:
            block = " ".join(markup.unescape("".join(held)).split())
            held.clear()
            if block:
                out.append((0 if apart else 1 if own else 2, block))

    for m in _TAG.finditer(text):
        if m.start() > at:
            held.append(text[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1] is not None and m[1].lower() == "title":
                close()
            continue
        tag = name.lower()
        if tag in INLINE:
            if not m[2] and tag not in VOID and m[4] and marked(tag, m[4]):
                close()
                stack.append((tag, apart, own))
                apart = True
            elif m[2] and stack and stack[-1][0] == tag:
                close()
                _, apart, own = stack.pop()
            continue
        if tag == "br":
            held.append(" ")
            continue
        close()
        if tag in VOID:
            continue
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    _, apart, own = stack[k]
                    del stack[k:]
                    break
            continue
        if tag == "body":
            apart = own = False
            stack.clear()
            continue
        if tag in SIBLINGS and stack and stack[-1][0] == tag:
            _, apart, own = stack.pop()
        stack.append((tag, apart, own))
        if not apart:
            if tag in OWN and not marked(tag, m[4]):
                own = True
            elif marked(tag, m[4]):
                apart = True
    if at < len(text):
        held.append(text[at:])
    close()
    return out


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``tokens`` by their first ``depth`` tokens at least, by prefix doubling."""
    _, rank = np.unique(tokens, return_inverse=True)
    n, k = len(tokens), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        second = np.full(n, -1)
        second[: n - k] = rank[k:]
        order = np.lexsort((second, rank))
        new = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(new)])
        k *= 2
        if rank.max() == n - 1:
            break
    return order


def run_key(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words).encode()) >> 1


def run_keys(words: list[str], run: int) -> list[int]:
    """63-bit keys of a block's runs of ``run`` tokens from the first on; a shorter block is one run."""
    return [run_key(words[i : i + run]) for i in range(max(1, len(words) - run + 1))] if words else []


def shard_runs(pages: list[list[list[str]]], run: int) -> dict[int, int]:
    """key -> number of pages with it, of the distinct runs of a shard; pages: blocks of words."""
    number: dict[str, int] = {}
    stream, page_of, block_end, starts = [], [], [], []
    words: list[str] = []
    fence = -1
    for page, blocks in enumerate(pages):
        for block in blocks:
            start, n = len(stream), len(block)
            stream += [number.setdefault(w, len(number)) for w in block]
            words += block
            starts += range(start, start + max(1, n - run + 1))
            # a fence of its own after each block, so that no run crosses it
            stream.append(fence)
            words.append("")
            fence -= 1
            page_of += [page] * (n + 1)
            block_end += [start + n] * n + [0]
    if not stream:
        return {}
    tokens, page_no = np.array(stream, np.int64), np.array(page_of, np.int64)
    order = suffix_array(tokens, run)
    begins = np.zeros(len(tokens), bool)
    begins[starts] = True
    order = order[begins[order]]
    size = np.minimum(run, np.array(block_end)[order] - order)
    # neighbours in the order whose common prefix reaches the run's length are the same run
    same = size[1:] == size[:-1]
    for k in range(run):
        a, b = np.minimum(order[1:] + k, len(tokens) - 1), np.minimum(order[:-1] + k, len(tokens) - 1)
        same &= (tokens[a] == tokens[b]) | (k >= size[1:])
    new = np.concatenate([[True], ~same])
    group = np.cumsum(new) - 1
    held = np.bincount(np.unique(group * len(pages) + page_no[order]) // len(pages), minlength=group[-1] + 1)
    out: dict[int, int] = {}
    for i, n, pages_with in zip(order[new].tolist(), size[new].tolist(), held.tolist()):
        key = run_key(words[i : i + n])
        out[key] = out.get(key, 0) + pages_with
    return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def repeated_runs(pages: DataFrame, scratch: Scratch, run: int = 10, shard: int = 500, share: float = 0.02) -> DataFrame:
    """(host, key): boilerplate runs outside articles. ``pages``: page_id, url, html, host."""

    def outside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(pc.binary_length(batch.column(1)), 2 << 20):
                part = batch.slice(start, n)
                cut = [blocks_of(h) for h in part.column(1).to_pylist()]
                rows = [[t.split() for kind, t in blocks if kind != 1] for blocks in cut]
                page = [xxhash.xxh64_intdigest("\n".join(t for _, t in blocks).encode()) - (1 << 63) for blocks in cut]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(page, pa.int64()), pa.array(rows, pa.list_(pa.list_(pa.string())))], names=["host", "page", "blocks"])

    streams = scratch.save(pages.select("host", "html").mapInArrow(outside, "host string, page long, blocks array<array<string>>"))
    sizes = scratch.save(streams.groupBy("host").agg(F.count_distinct("page").alias("pages")))
    dealt = streams.join(sizes, "host").select("host", F.pmod(F.xxhash64("page"), F.ceil(F.col("pages") / shard)).alias("shard"), "page", "blocks")

    def arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(host: str, rows: dict) -> pa.RecordBatch:
            found = shard_runs([*rows.values()], run)
            return pa.RecordBatch.from_arrays([pa.array([host] * len(found), pa.string()), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["host", "key", "n"])

        now, rows = None, {}
        for batch in batches:
            for host, no, page, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and now != (host, no):
                    yield done(now[0], rows)
                    rows = {}
                now = (host, no)
                rows[page] = blocks
        if now is not None:
            yield done(now[0], rows)

    runs = dealt.repartition("host", "shard").sortWithinPartitions("host", "shard").mapInArrow(arrays, "host string, key long, n long")
    found = runs.groupBy("host", "key").agg(F.sum("n").alias("n")).where("n > 1").join(sizes, "host")
    return scratch.save(found.where(F.col("n") >= F.col("pages") * share).select("host", "key"))


def text_of(html: str | None, common: set[int], run: int) -> tuple[str, int, int]:
    """(text, blocks that runs cut or shortened, blocks that marks dropped what was left of); ``common`` holds the keys of
    the host's boilerplate runs. The kept blocks are joined by line breaks."""
    kept, by_runs, by_marks = [], 0, 0
    for kind, block in blocks_of(html):
        if kind != 1:
            words = block.split()
            covered = np.zeros(len(words), bool)
            for at, key in enumerate(run_keys(words, run) if common else ()):
                if key in common:
                    covered[at : at + run] = True
            by_runs += bool(covered.any())
            block = " ".join(w for w, c in zip(words, covered) if not c) if covered.any() else block
            by_marks += bool(kind == 0 and block)
            if kind == 0 or not block:
                continue
        kept.append(block)
    return "\n".join(kept), by_runs, by_marks


def extract(pages: DataFrame, scratch: Scratch, run: int = 10, shard: int = 500, share: float = 0.02, broadcast_rows: int = 200_000) -> DataFrame:
    """(page_id, url, text, n_chars, by_runs, by_marks) of every page (page_id, url, html); the last two count its blocks
    outside articles that runs were cut from and whose rest marks dropped."""
    pages = spread(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")).withColumn("host", host_of(F.col("url")))
    common = repeated_runs(pages, scratch, run, shard, share)
    schema = "page_id long, url string, text string, n_chars long, by_runs long, by_marks long"

    def rows_of(part: pa.RecordBatch, keys: Iterable[set[int]]) -> pa.RecordBatch:
        made = [text_of(h, k, run) for h, k in zip(part.column(2).to_pylist(), keys)]
        texts = [m[0] for m in made]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in ([len(t) for t in texts], [m[1] for m in made], [m[2] for m in made]))], names=["page_id", "url", "text", "n_chars", "by_runs", "by_marks"])

    if common.count() <= broadcast_rows:
        # at most broadcast_rows keys of eight bytes, with their hosts
        by_host: dict[str, set[int]] = {}
        for r in common.groupBy("host").agg(F.collect_list("key").alias("keys")).collect():
            by_host[r["host"]] = set(r["keys"])
        sent = pages.sparkSession.sparkContext.broadcast(by_host)

        def run_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, none = sent.value, set()
            for batch in batches:
                for start, n in slices(pc.binary_length(batch.column(2)), 2 << 20):
                    part = batch.slice(start, n)
                    yield rows_of(part, (keys.get(host, none) for host in part.column(3).to_pylist()))

        return pages.select("page_id", "url", "html", "host").mapInArrow(run_all, schema)

    # the keys of each page's runs that are boilerplate, gathered by page and joined to it: bounded by the page
    def page_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(pc.binary_length(batch.column(2)), 2 << 20):
                rows = [(no, host, k) for no, host, h in zip(*(c.to_pylist() for c in batch.slice(start, n).columns)) for k in {k for kind, t in blocks_of(h) if kind != 1 for k in run_keys(t.split(), run)}]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64()))], names=["page_no", "host", "key"])

    numbered = pages.withColumn("page_no", F.xxhash64("page_id", "url", "html"))
    found = numbered.select("page_no", "host", "html").mapInArrow(page_keys, "page_no long, host string, key long").distinct().join(common, ["host", "key"])
    per_page = found.groupBy("page_no").agg(F.collect_set("key").alias("keys"))

    def run_joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(pc.binary_length(batch.column(2)), 2 << 20):
                part = batch.slice(start, n)
                yield rows_of(part, (set(k or ()) for k in part.column(3).to_pylist()))

    return numbered.join(per_page, "page_no", "left").select("page_id", "url", "html", "keys").mapInArrow(run_joined, schema)
