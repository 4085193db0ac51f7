"""Operator 7: main text of web pages with a host suffix array.

Pages of a host are cut into token streams: one token for each block tag (name and class) and one
for each word. The streams are concatenated and their suffixes sorted to a depth of ``LONG`` tokens
by prefix doubling; suffixes that share those tokens stand side by side, and where they come from
enough distinct pages every position they cover is boilerplate. Covered runs are removed, unique
runs stay. Outside an article a run is boilerplate if at least ``OUTSIDE`` of the host's pages have
it; inside ``article`` or ``main`` it takes more than ``INSIDE`` of them, because mirrored pages and
quoted passages repeat articles too. What markup itself declares to be no article (menus, headers,
footers, asides, forms, scripts, styles, notices, adverts, comments) is never text; its tokens
still serve the suffix array. Where a page has an article element, text outside it is left out.

Scale: pages are dealt by host and a hash block inside it, a block holding at most about
``BLOCK_PAGES`` pages or ``BLOCK_BYTES`` of HTML, so a host with a third of all pages fills many
tasks and no group is unbounded. The HTML is shuffled once.

Pages are counted over the whole host, whatever its size. A host of one block is counted there. For
a larger one the runs that enough of its pages have are found first (:func:`frequent_runs`): such a
run is on that share of the pages of at least one block, so blocks are sifted by suffix arrays over
four bits a token (equal runs have equal codes; others only let more through), and what may reach the
share over all blocks is counted exactly, a page at a time, without a shuffle of pages. Each block
then gets the frequent runs of its host, at most ``1 / OUTSIDE`` times the tokens of a page. Pages of
such hosts are parsed three times. Blocks of fewer than ``1 / OUTSIDE`` pages (of more than a
megabyte) pass on all their runs.

Defined results: null and empty HTML give empty text and 0 characters; a null url is a host of its
own; broken markup (unclosed elements, cut tags, stray entities) is read as far as it goes;
repeated rows are pages like others.
"""

from __future__ import annotations

import html as html_lib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, bitmap, in_bitmap, mix64, sorted_groups, word_hashes
from quire.session import materialize

LONG = 8  # tokens
OUTSIDE, OUTSIDE_PAGES = 0.2, 3
INSIDE, INSIDE_PAGES = 0.5, 20
BLOCK_PAGES, BLOCK_BYTES = 256, 8_000_000
FILTER_BITS = 25  # 2 ** 25 bits: a bitmap of 4 MB

# a quote opens a value only after an equals sign; any other one is part of a name or value, and the tag
# ends at the next ">"; an element name ends at white space, "/" or ">"; a closed svg has no content
_ATTRIBUTES = r"""(?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*?"""
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?:\s" + _ATTRIBUTES + r")?/>"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg)(?=[\s/>])" + _ATTRIBUTES + r">"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s>/]*)(?P<rest>" + _ATTRIBUTES + r")(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_HINT = re.compile(r"""\b(class|id|role|hidden|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("nav footer aside form button select menu dialog figure-menu head".split())
_SIDE_WORDS = (
    r"ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|"
    r"breadcrumbs?|header|masthead|footer|sidebar|aside|cookies?|consent|notice|notification|alert|"
    r"popup|modal|newsletter|subscribe|signup|login|comments?|respond|replies|disqus|share|sharing|"
    r"social|related|recommended|widget|complementary|contentinfo|search")
_SIDE = re.compile(rf"(?:^|[\s_-])(?:{_SIDE_WORDS})(?:$|[\s_-])", re.I)
# in an article a side word must be a whole label, or name a part of a page ("share-price" is neither)
_SIDE_INSIDE = re.compile(
    rf"(?:^|\s)(?:{_SIDE_WORDS})(?:[_-](?:area|articles|banner|bar|block|box|buttons?|container|form|links?|list|notice|"
    r"posts|section|slot|stories|unit|widget|wrapper))?(?:$|\s)", re.I)
_MAIN = re.compile(r"(?:^|\s)(?:main|articleBody|article)(?:$|\s)")


def parse(page: str) -> tuple[list[str], list[tuple[int, bool, list[str]]]]:
    """Token stream of a page, and its candidate runs: (first token, in an article, words)."""
    tokens: list[str] = []
    runs: list[tuple[int, bool, list[str]]] = []
    open_tags: list[tuple[str, bool, bool]] = []  # name, side, article
    side = article = 0
    pieces: list[str] = []

    def flush():
        if pieces:
            words = html_lib.unescape("".join(pieces)).split()
            pieces.clear()
            if words:
                if not side:
                    runs.append((len(tokens), article > 0, words))
                tokens.extend(words)

    at = 0
    for found in _MARKUP.finditer(page):
        if found.start() > at:
            pieces.append(page[at:found.start()])
        at = found.end()
        raw, end, name, rest = found.group("raw", "end", "name", "rest")
        if name is None:
            if raw:
                flush()
                tokens.append(f"<{raw.lower()}>")
            continue
        name = name.lower()
        if name in _INLINE and not (rest and open_tags_matter(rest, article > 0)):
            continue
        flush()
        if end:
            tokens.append(f"</{name}>")
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == name:
                    for _, was_side, was_article in open_tags[k:]:
                        side -= was_side
                        article -= was_article
                    del open_tags[k:]
                    break
                if open_tags[k][0] in ("article", "main", "body"):
                    break
            continue
        token, is_side, is_article = (known_tag if len(rest) <= 200 else read_tag)(name, rest, article > 0)
        tokens.append(token)
        if name not in _VOID:
            open_tags.append((name, is_side, is_article))
            side += is_side
            article += is_article
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return tokens, runs


def read_tag(name: str, rest: str, in_article: bool) -> tuple[str, bool, bool]:
    """Token of a start tag, whether it is declared to be no article, and whether it is one."""
    hints = dict(h for h in ((k.lower(), v.strip("\"'")) for k, v in _HINT.findall(rest))) if rest else {}
    label = " ".join(hints.get(k, "") for k in ("class", "id", "role"))
    is_article = name in ("article", "main") or bool(
        _MAIN.search(f"{hints.get('role', '')} {hints.get('itemprop', '')}"))
    is_side = not is_article and name != "body" and (
        name in _NEVER or "hidden" in hints or bool((_SIDE_INSIDE if in_article else _SIDE).search(label))
        or (name == "header" and not in_article))
    token = f"<{name}.{hints['class'].replace(' ', '.')}>" if hints.get("class") else f"<{name}>"
    return token, is_side, is_article


@lru_cache(4096)
def known_tag(name: str, rest: str, in_article: bool) -> tuple[str, bool, bool]:
    return read_tag(name, rest, in_article)


def open_tags_matter(rest: str, in_article: bool) -> bool:
    """Whether an inline element is declared to be no article (then it is read like a block)."""
    side = _SIDE_INSIDE if in_article else _SIDE
    return bool(rest) and any(
        k.lower() == "hidden" or (k.lower() in ("class", "id", "role") and side.search(v.strip("\"'")))
        for k, v in _HINT.findall(rest))


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` tokens (a power of two), and their ranks: equal
    ranks mean equal tokens. A suffix that ends earlier is distinct from all others."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < depth:
        following = np.full(n, -1, np.int64)
        following[:-width] = rank[width:] if width < n else following[:-width]
        key = rank * (n + 1) + following + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
        width *= 2
    return order, rank


def run_pages(codes: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """For every token of the streams: in how many pages the run of LONG tokens from it on stands (0: none in
    two pages)."""
    streams = len(offset) - 1
    page = np.repeat(np.arange(streams), np.diff(offset))
    # streams end in tokens of their own, so no run crosses two pages
    ends = np.arange(streams, dtype=np.uint64) + np.uint64(1 << 60)
    codes = np.insert(codes, offset[1:], ends)
    of = np.insert(page, offset[1:], np.arange(streams))
    if len(codes) <= LONG:
        return np.zeros(len(page), np.int64)
    order, rank = suffix_array(codes, LONG)
    # distinct pages among the suffixes of one rank: they stand side by side, pages ascending
    sorted_rank, sorted_page = rank[order], of[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_rank[1:] != sorted_rank[:-1]) | (sorted_page[1:] != sorted_page[:-1])
    pages = np.bincount(sorted_rank, weights=new).astype(np.int64)[rank]
    pages[pages < 2] = 0
    keep = np.ones(len(codes), bool)
    keep[offset[1:] + np.arange(streams)] = False
    return pages[keep]


def covered(values: np.ndarray) -> np.ndarray:
    """Maximum over the LONG runs that may cover a token (the last ones of a page have no value)."""
    width = 1
    while width < LONG:
        moved = np.zeros_like(values)
        moved[width:] = values[:-width]
        values = np.maximum(values, moved)
        width *= 2
    return values


def coded(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all streams, and the range of each stream."""
    return word_hashes([" ".join(s) for s in streams], lower=False)


def page_counts(streams: list[list[str]]) -> list[np.ndarray]:
    """For every token of every stream: in how many pages the most common of the LONG-token runs
    that cover it stands (0: none in two pages)."""
    hashes, offset = coded(streams)
    return np.split(covered(run_pages(hashes, offset)), offset[1:-1])


def places(offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens from which LONG tokens of one page go on, and the page of each."""
    page = np.repeat(np.arange(len(offset) - 1), np.diff(offset))
    n = max(0, len(page) - LONG + 1)
    at = np.flatnonzero(page[:n] == page[LONG - 1:])
    return at, page[at]


def run_hashes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of LONG tokens from each place on."""
    out = np.zeros(len(at), np.uint64)
    for k in range(LONG):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + k])
    return out


def run_codes(codes: np.ndarray, at: np.ndarray, host: np.ndarray) -> np.ndarray:
    """Hashes of the host and the LONG codes of four bits from each place on."""
    out = np.zeros(len(at), np.uint64)
    for k in range(LONG):
        out = out << np.uint64(4) | codes[at + k].astype(np.uint64)
    return mix64(out ^ host)


def packed(codes: np.ndarray) -> bytes:
    """Codes of four bits, two a byte; a last byte says whether their number is odd."""
    two = np.append(codes, np.zeros(len(codes) % 2, np.uint8)).reshape(-1, 2)
    return (two[:, 0] << 4 | two[:, 1]).tobytes() + bytes([len(codes) % 2])


def unpacked(two: bytes) -> np.ndarray:
    codes = np.frombuffer(two, np.uint8)[:-1]
    return np.stack([codes >> 4, codes & 15], 1).ravel()[:2 * len(codes) - two[-1]]


def pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair of values stands first, and how often it stands."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    firsts = np.flatnonzero(new)
    return order[firsts], np.diff(np.append(firsts, len(order)))


def frequent_in_pages(streams: list[list[str]], *frequent: np.ndarray) -> list[list[np.ndarray]]:
    """For every set of run hashes and stream: which tokens its runs cover."""
    hashes, offset = coded(streams)
    at, _ = places(offset)
    runs = run_hashes(hashes, at)
    out = []
    for known in frequent:
        hit = np.zeros(len(hashes), bool)
        hit[at] = np.isin(runs, known)
        out.append(np.split(covered(hit), offset[1:-1]))
    return out


def main_texts(pages: list[str], frequent: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """Main texts of the pages of one host; or of some of its pages, by the hashes of the runs that are boilerplate
    outside and inside articles."""
    parsed = [parse(p) for p in pages]
    streams = [tokens for tokens, _ in parsed]
    if frequent is None:
        n = len(pages)
        counts = page_counts(streams)
        outside = [seen >= max(OUTSIDE_PAGES, OUTSIDE * n) for seen in counts]
        inside = [seen >= max(INSIDE_PAGES, INSIDE * n + 1) for seen in counts]
    else:
        outside, inside = frequent_in_pages(streams, *frequent)
    out = []
    for (_, runs), *common in zip(parsed, outside, inside):
        has_article = any(a for _, a, _ in runs)
        kept: list[str] = []
        for first, in_article, words in runs:
            if has_article and not in_article:
                continue
            gone = common[in_article][first:first + len(words)]
            kept += words if not gone.any() else [w for w, c in zip(words, gone) if not c]
        out.append(" ".join(kept))
    return out


def frequent_runs(pages: DataFrame, hosts: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``(host, outside, inside)``: hashes of the runs on enough pages of a host to be boilerplate there.

    ``pages`` has ``host, block, html``, ``hosts`` their hosts with the number of pages ``n``.
    """
    pages = pages.select("host", "block", F.xxhash64("host").alias("g"), "html")

    def token_codes(batch):
        hashes, offset = coded([parse(h or "")[0] for h in batch.column("html").to_pylist()])
        low = hashes.astype(np.uint8) & 15
        return {c: batch.column(c).to_pylist() for c in ("host", "block", "g")} | {
            "codes": [packed(low[a:b]) for a, b in zip(offset[:-1], offset[1:])]}

    def sifted(batches):
        for table in sorted_groups(batches, ["host", "block"]):
            codes = [unpacked(c) for c in table.column("codes").to_pylist()]
            offset = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
            codes = np.concatenate(codes)
            # a run on fewer pages than ``least`` in every block is on too few of the host
            least = max(1, int(np.ceil(OUTSIDE * table.num_rows)))
            at, _ = places(offset)
            count = np.maximum(run_pages(codes.astype(np.uint64), offset)[at], 1)
            at, count = at[count >= least], count[count >= least]
            host = np.full(len(at), table.column("g")[0].as_py(), np.int64).view(np.uint64)
            h, first = np.unique(run_codes(codes, at, host), return_index=True)
            yield pa.RecordBatch.from_pydict({
                "host": [table.column("host")[0].as_py()], "missed": pa.array([least - 1], pa.int64()),
                "h": pa.array([h.view(np.int64)], pa.list_(pa.int64())),
                "more": pa.array([count[first] - least + 1], pa.list_(pa.int64()))})

    codes = arrow_map(pages, token_codes, "host string, block int, g long, codes binary")
    blocks = materialize(codes.repartition("host", "block").sortWithinPartitions("host", "block").mapInArrow(
        sifted, "host string, missed long, h array<long>, more array<long>"), "runs")
    # no run is on more pages than its blocks may have missed and those that it is known to be on beyond
    enough = f"greatest({OUTSIDE_PAGES}, {OUTSIDE}D * n)"
    most = materialize(blocks.groupBy("host").agg(F.sum("missed").alias("missed")).join(hosts, "host"), "hosts")
    possible = blocks.select("host", F.explode(F.arrays_zip("h", "more")).alias("x")).groupBy("host", "x.h").agg(
        F.sum("x.more").alias("more")).join(most, "host").filter(f"more + missed >= {enough}")
    marked = pages.sparkSession.sparkContext.broadcast(bitmap(possible.select("h"), bits))

    def counted(batch):
        hashes, offset = coded([parse(h or "")[0] for h in batch.column("html").to_pylist()])
        names = batch.column("host").dictionary_encode()
        host, g = names.indices.to_numpy(), batch.column("g").to_numpy().view(np.uint64)
        at, page = places(offset)
        seen = in_bitmap(marked.value, run_codes(hashes.astype(np.uint8) & 15, at, g[page]), bits)
        at, page = at[seen], page[seen]
        runs = run_hashes(hashes, at)
        once, _ = pairs(page, runs)
        found, n = pairs(host[page[once]], runs[once])
        return {"host": names.dictionary.take(pa.array(host[page[once][found]])).to_pylist(),
                "run": runs[once][found].view(np.int64), "pages": n}

    counts = arrow_map(pages, counted, "host string, run long, pages long").groupBy("host", "run").agg(
        F.sum("pages").alias("pages"))
    return counts.join(hosts, "host").filter(f"pages >= {enough}").groupBy("host").agg(
        F.collect_list("run").alias("outside"),
        F.collect_list(F.expr(f"if(pages >= greatest({INSIDE_PAGES}, {INSIDE}D * n + 1), run, null)")).alias("inside"))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url",
                      html: str = "html") -> DataFrame:
    """``(key, url, text, n_chars)`` for every row of ``pages``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[^/?#]*//([^/?#]*)", 1))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"),
                        host.alias("host"))
    size = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_PAGES),
                      F.ceil(F.sum(F.octet_length(F.coalesce("html", F.lit("")))) / BLOCK_BYTES))
    # a small table read back from its files: Spark broadcasts it if its size on disk allows
    large = materialize(rows.groupBy("host").agg(size.cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
                        .filter("blocks > 1"), "hosts")
    dealt = rows.join(large, "host", "left").withColumn(
        "block", F.pmod(F.xxhash64("key", "url", "html"), F.coalesce("blocks", F.lit(1))).cast("int"))
    boilerplate = materialize(frequent_runs(dealt.filter("blocks is not null"), large.select("host", "n")), "boilerplate")
    none = F.lit(None).cast("array<long>")
    dealt = dealt.select("host", "block", "key", "url", "html", F.col("blocks").isNotNull().alias("of_large"),
                         none.alias("outside"), none.alias("inside"))
    # a row of runs comes first in each block of a large host
    blocks = large.select("host", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")).join(boilerplate, "host")
    dealt = dealt.unionByName(blocks, allowMissingColumns=True)
    kind = pages.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([("key", to_arrow_type(pages.schema[key].dataType)), ("url", pa.string()),
                       ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for table in sorted_groups(batches, ["host", "block"]):
            frequent = None
            if table.column("of_large")[-1].as_py() is not False:
                runs = [table.column(c)[0].as_py() for c in ("outside", "inside")]
                table = table.slice(0 if runs[0] is None else 1)
                frequent = tuple(np.array(r or [], np.int64).view(np.uint64) for r in runs)
            texts = main_texts([h or "" for h in table.column("html").to_pylist()], frequent)
            yield pa.RecordBatch.from_arrays(
                [table.column("key").combine_chunks(), table.column("url").combine_chunks().cast(pa.string()),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=arrow)

    out = dealt.repartition("host", "block").sortWithinPartitions("host", "block", F.col("outside").isNull()).mapInArrow(
        run, f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
