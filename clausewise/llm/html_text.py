"""Operator 3: main text of web pages, with a suffix array over each host.

A page becomes blocks of text, each from the article, from a part that its markup names as
something else (menus, notices, adverts, comments), or undecided.  The token streams of a host's
pages are concatenated and sorted as a suffix array to the depth of the least repeat that counts;
runs of tokens that occur on several distinct pages are covered.  Where the markup does not tell,
covered runs go and unique runs stay; what the markup names as the article stays as it is, since
the text of an article may well be printed on several pages.  A large host is cut into shards of pages, so no task grows with a host; on how many
pages a run stands is then counted over the whole host, by its hash, and told to the shards.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, lean, materialize, resolved, small_batches

#: Fixed sets of element names.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select title head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset("nav footer aside form menu dialog button label".split())
CELL = frozenset("td th br option wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",)}
LISTS = frozenset("ul ol dl table article main div section nav aside form body".split())
#: Words of class, id or role that name something other than the article.
OTHER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banner|breadcrumbs?|comments?|commentlist|complementary|consent|"
    r"contentinfo|cookies?|disqus|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|"
    r"pager|pagination|popup|promo|related|replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|"
    r"sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
#: Of these, what an article element may be that is not the article: a comment, a teaser for another page.
ASIDE = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|comments?|promo|related|replies|reply|respond|sidebar|sponsor(?:ed)?|teasers?|widget)(?:$|[\s_-])", re.I)
#: Where a name goes on with a capital or a digit (siteHeader, sidebar2).
JOINT = re.compile(r"(?<=[a-z])(?=[A-Z0-9])")
MAIN = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|post|entry)(?:[_-]?(?:content|body|text))?(?:$|\s)", re.I)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?][^>]*>|<[!?/A-Za-z][^>]*\Z",
    re.S)
_NAMES = re.compile(r"\b(class|id|role|itemprop|style|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)

ARTICLE, OTHERS, UNDECIDED = 1, 0, 2


def _kind(name: str, attributes: str, inside: bool) -> int | None:
    """What an opening tag says about its content; None: nothing."""
    if name in DROP or (name == "header" and not inside):
        return OTHERS
    if name in ("article", "main"):
        kind = ARTICLE
    else:
        kind = None
    if attributes and ("=" in attributes or "hidden" in attributes.lower()):
        said = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(attributes)}
        if _HIDDEN.search(attributes if not said else re.sub(_NAMES, "", attributes) + " " + said.get("style", "")):
            return OTHERS
        if said.get("aria-hidden", "").lower() == "true":
            return OTHERS
        words = " ".join((said.get("class", ""), said.get("id", ""), said.get("role", "")))
        if words.strip() and name not in ("html", "body"):
            parts = JOINT.sub(" ", words)
            if (OTHER.search(parts) and kind is None) or (name == "article" and ASIDE.search(parts)):
                return OTHERS
            if kind is None and (said.get("role") == "main" or said.get("itemprop", "").lower() == "articlebody" or (
                    name in ("div", "section") and MAIN.search(words))):
                kind = ARTICLE
        elif said.get("itemprop", "").lower() == "articlebody":
            kind = ARTICLE
    return kind


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order; white space is single and trimmed."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int | None]] = []
    others = article = 0
    at = 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((OTHERS if others else ARTICLE if article else UNDECIDED, text))

    def pop(to: int) -> None:
        nonlocal others, article
        while len(stack) > to:
            kind = stack.pop()[1]
            if kind == OTHERS:
                others -= 1
            elif kind == ARTICLE:
                article -= 1

    find = _TAG.search
    while m := find(page, at):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if name in RAW and not closing:
            if name == "head":
                continue  # what it holds is raw or void; a page may leave it open
            if attributes.endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if name not in ("svg", "math", "canvas"):
                held.append(" ")
            continue
        if name in CELL:
            held.append(" ")
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in BLOCK:
            # a block ends an open paragraph, a list item the one before it
            ends = CLOSES.get(name, ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] in ends:
                    pop(k)
                    break
                if stack[k][0] in LISTS:
                    break
        kind = _kind(name, attributes, article > 0)
        if name in BLOCK or kind is not None:
            if attributes.endswith("/") and name not in BLOCK:
                continue
            stack.append((name, kind))
            others += kind == OTHERS
            article += kind == ARTICLE
    if at < len(page):
        held.append(page[at:])
    flush()
    return out


def repeated(stream: np.ndarray, page: np.ndarray, depth: int, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``stream`` to ``depth`` tokens (a power of two) by prefix doubling.

    Returns a mask of tokens covered by runs of ``depth`` tokens that stand on at least ``pages``
    distinct pages, and the rank of the suffix at each token (equal ranks: equal runs).
    """
    n = len(stream)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    k = 1
    while k < depth:
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[:-k] = rank[k:] if k < n else ahead[:-k]
        pair = rank * (n + 1) + ahead + 1
        order = np.argsort(pair, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
        rank, k = new, 2 * k
    where = np.unique(rank * (int(page.max(initial=0)) + 1) + page)
    spread = np.bincount(where // (int(page.max(initial=0)) + 1), minlength=n)
    starts = spread[rank] >= pages
    cover = np.zeros(n + depth + 1, dtype=np.int64)
    np.add.at(cover, np.flatnonzero(starts), 1)
    np.add.at(cover, np.flatnonzero(starts) + depth, -1)
    return np.cumsum(cover)[:n] > 0, rank


def run_hashes(words: list[str], depth: int) -> np.ndarray:
    """Hash of the run of ``depth`` tokens from each token that has one."""
    from xxhash import xxh64_intdigest as h

    n = len(words) - depth + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    seen: dict[str, int] = {}
    for w in words:
        if w not in seen:
            seen[w] = h(w)
    each = np.fromiter((seen[w] for w in words), dtype=np.uint64, count=len(words))
    out = np.zeros(n, dtype=np.uint64)
    for k in range(depth):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
    return out


def tokens(parts: list[tuple[int, str]]) -> list[str]:
    return [w for _, text in parts for w in text.split(" ")]


def opened(raw: bytes) -> list[tuple[int, str]]:
    """Blocks from their packed form."""
    return [(int(x[0]), x[1:]) for x in raw.decode("utf-8").split("\0") if x]


def unique_runs(text: str, covered: np.ndarray, depth: int, rest: int) -> str:
    """``text`` without its covered words, and without what is left between them if it is under
    ``rest`` words (the number in a row of page links, say).  A few words at an edge that only a
    run from the next block covers stay, unless the whole block is covered."""
    if not covered.any() or covered.all():
        return "" if covered.all() else text
    words, out, at = text.split(" "), [], 0
    edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0])).tolist()
    gone = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= depth]
    if not gone:
        return text
    for a, b in [*gone, (len(words), len(words))]:
        if a - at >= rest:
            out += words[at:a]
        at = b
    return " ".join(out)


def keep_unique(pages: list[list[tuple[int, str]]], depth: int = 8, least: int = 3, known: np.ndarray | None = None, rest: int = 3) -> list[str]:
    """Main texts of the pages of one host, in the given order; for a shard of a host, ``known``
    holds the hashes of the runs that repeat on the host.  ``rest``: fewest words of a unique run
    that stays next to a covered one."""
    ids: dict[str, int] = {}
    stream: list[int] = []
    spans: list[list[tuple[int, int]]] = []
    for p, parts in enumerate(pages):
        own = []
        for _, text in parts:
            words = text.split(" ")
            own.append((len(stream), len(stream) + len(words)))
            stream.extend([ids.setdefault(w, len(ids)) for w in words])
        spans.append(own)
        stream.append(-1 - p)  # no run goes from one page into the next
    lengths = [(own[-1][1] - own[0][0] if own else 0) + 1 for own in spans]
    owner = np.repeat(np.arange(len(pages)), lengths)
    flat = np.array(stream, dtype=np.int64)
    if known is not None:
        covered = np.zeros(len(flat), dtype=bool)
        for parts, own in zip(pages, spans, strict=True):
            for i in np.flatnonzero(np.isin(run_hashes(tokens(parts), depth), known)):
                covered[own[0][0] + i : own[0][0] + i + depth] = True
    else:
        covered, _ = repeated(flat, owner, depth, least) if len(flat) else (np.zeros(0, bool), flat)
    out = []
    for parts, own in zip(pages, spans, strict=True):
        found = [(kind, unique_runs(text, covered[a:b], depth, rest) if kind == UNDECIDED else text) for (kind, text), (a, b) in zip(parts, own, strict=True)]
        words = Counter()
        for kind, text in found:
            words[kind] += len(text.split(" ")) if text else 0
        # the article is what the markup names, unless that is a teaser beside more text of the page's own
        article = UNDECIDED if words[UNDECIDED] > 2 * words[ARTICLE] else ARTICLE
        kept = []
        for kind, text in found:
            if kind == article and text:
                kept.append(text)
        out.append("\n\n".join(kept))
    return out


def main_text(pages: DataFrame, depth: int = 8, least: int = 3, shard_pages: int = 200, broadcast_hosts: int = 20_000) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    A null or empty html gives the empty text; a null url belongs to the nameless host; rows that
    repeat stay rows of their own (and count as distinct pages); a long text is read whole; an empty table gives no rows; other
    columns are not read.  Hosts of more than ``shard_pages`` pages are cut into shards by a hash
    of the page, which changes no result; the table of such hosts is broadcast only up to
    ``broadcast_hosts`` of them.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    small_batches(pages.sparkSession)
    large = materialize(
        pages.select(host.alias("host")).groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > shard_pages)
        .select("host", F.ceil(F.col("n") / shard_pages).cast("int").alias("shards")), "hosts")
    n_large = large.count()
    small_table = n_large <= broadcast_hosts

    @lean
    def parse(batches):
        import pyarrow as pa
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=3).compress
        for batch in (g for b in batches for g in byte_groups(b, 4)):
            ids, urls, hosts, salts, texts = (batch.column(i) for i in range(5))
            packed, decides = [], []
            for x in texts.to_pylist():
                parts = blocks((x or "").replace("\0", "�"))
                packed.append(squeeze("\0".join(f"{k}{t}" for k, t in parts).encode("utf-8", "replace")))
                kinds = {k for k, _ in parts}
                decides.append(UNDECIDED in kinds)
            yield pa.RecordBatch.from_arrays([ids, urls, hosts, salts, pa.array(packed, pa.binary()), pa.array(decides, pa.bool_())],
                                             names=["page_id", "url", "host", "salt", "packed", "decides"])

    parsed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"),
        F.xxhash64("page_id", "url").alias("salt"), "html"
    ).mapInArrow(parse, "page_id long, url string, host string, salt long, packed binary, decides boolean")
    joined = parsed.join(F.broadcast(large) if small_table else large, "host", "left")
    dealt = joined.withColumn("shard", F.pmod(F.col("salt"), F.coalesce("shards", F.lit(1))).cast("int"))

    def texts(part, known=None):
        import pandas as pd
        from zstandard import ZstdDecompressor

        open_up = ZstdDecompressor().decompress
        part = part.sort_values(["page_id", "url"], na_position="first", kind="stable")
        found = [opened(open_up(p)) for p in part["packed"]]
        return pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": keep_unique(found, depth, least, known)})

    schema = "page_id long, url string, text string"
    if not n_large:
        return dealt.select("page_id", "url", "host", "shard", "packed").groupBy("host", "shard").applyInPandas(lambda part: texts(part), schema)
    dealt = materialize(dealt.select("page_id", "url", "host", "shard", "packed", "decides", F.col("shards").isNotNull().alias("cut")), "pages")
    # on the other hosts no page asks for repeats: the markup of each names its article
    asking = materialize(dealt.where("cut and decides").select("host").distinct(), "asking")
    if asking.isEmpty():
        return dealt.select("page_id", "url", "host", "shard", "packed", "cut").groupBy("host", "shard").applyInPandas(
            lambda part: texts(part, np.zeros(0, dtype=np.uint64) if part["cut"].iloc[0] else None), schema)

    @lean
    def count(batches):
        import pyarrow as pa
        from zstandard import ZstdDecompressor

        open_up = ZstdDecompressor().decompress
        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            of: dict[tuple[str, int], list[np.ndarray]] = {}
            for h, s, p in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                of.setdefault((h, s), []).append(np.unique(run_hashes(tokens(opened(open_up(p))), depth)))
            for (h, s), runs in of.items():
                run, n = np.unique(np.concatenate(runs), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * len(run), pa.string()), pa.array(np.full(len(run), s, np.int32)), pa.array(run.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["host", "shard", "run", "n"])

    # pages of a host on which a run stands, over all its shards; then the shards are told
    counted = dealt.where("cut").join(F.broadcast(asking) if small_table else asking, "host", "left_semi").select("host", "shard", "packed").mapInArrow(count, "host string, shard int, run long, n long")
    repeats = counted.groupBy("host", "run").agg(F.sum("n").alias("n"), F.collect_set("shard").alias("shards")).where(
        F.col("n") >= least).select("host", "run", F.explode("shards").alias("shard"))
    told = repeats.groupBy("host", "shard").agg(F.collect_list("run").alias("runs"))  # within a shard's pages

    def shard_texts(part, runs):
        if not len(part) or not part["cut"].iloc[0]:
            return texts(part)
        known = np.array(runs["runs"].iloc[0], dtype=np.int64) if len(runs) else np.zeros(0, dtype=np.int64)
        return texts(part, known.view(np.uint64))

    return dealt.drop("decides").groupBy("host", "shard").cogroup(told.groupBy("host", "shard")).applyInPandas(shard_texts, schema)
