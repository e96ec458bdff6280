"""Main text of web pages: host suffix arrays tell repeated runs from the text of a page.

Each page becomes a stream of tokens: a mark per block, then the words of the block. The streams of a host
are concatenated, their suffixes sorted as deep as a run must be long, and classes of suffixes that occur
on enough distinct pages are boilerplate; copies of a page count as one. Of a host too large for one task
the pages are sorted in parts, and what a class occurs on is counted over the whole host. Blocks mostly covered by such runs
go, the others are kept in page order. What HTML itself says about a block is an exact check on that: text
in menus, footers, asides, forms, adverts or comments never counts, and a page that marks its article is
taken at its word, so that in an article only runs on half of all pages are boilerplate.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import _ODD, mix, stored, word_hashes

RUN = 8
PAGES = 3
ARTICLE_PAGES = 5
PART_BYTES = 8_000_000
CELL_WINDOWS = 2_000_000

# Fixed values of HTML: elements without content of their own, elements that break a line, elements whose
# content is raw text, elements that are no main text, elements that may stand in a head.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
RAW = set("iframe noembed noframes noscript script style textarea title xmp".split())
OUTSIDE = set("aside audio button canvas dialog footer form head iframe menu nav noscript object search select svg template video".split())
IN_HEAD = set("base link meta noscript script style template title".split())
# Names in class, id and role that mark an element as no main text.
MARKS = set(
    "ad ads adv advert advertisement advertising adverts alert alertdialog banner bottombar breadcrumb breadcrumbs captcha comment "
    "commentlist comments complementary consent contentinfo cookie cookies dialog disclaimer disqus footer gdpr login masthead "
    "menu menubar menus modal nav navbar navi navigation newsletter notice notices notification notifications overlay pager "
    "pagination popup promo promoted promotion recommended related replies reply search share sharing sidebar sidebars signup "
    "skip skiplink social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*+>?|<[!?/][^>]*+>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
FREE, MAIN, ARTICLE, OUT = 0, 1, 2, 3


class Block(NamedTuple):
    """White-space separated text of a block, where it stands, and its element."""

    text: str
    level: int
    mark: str


def _marked(tag: str, attributes: str) -> tuple[bool, str]:
    """(the attributes say that this is no main text, class names)."""
    if not attributes or attributes.isspace():
        return False, ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "")
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True, names
    if tag in ("html", "body", "main"):
        return False, names
    words = " ".join((names, found.get("id", ""), found.get("role", "")))
    return any(w in MARKS for w in _NAME.findall(_CAMEL.sub(" ", words).lower())), names


def page_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, those that are no main text included; character references decoded."""
    out: list[Block] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, str]] = [("", FREE, "")]
    opened: dict[str, int] = {}
    said = [False]  # per open article: it had text of its own
    held: list[str] = []  # text of the block around an inline element that is no main text

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                _, level, mark = stack[-1]
                out.append(Block(text, level, mark))
                if level == ARTICLE:
                    said[-1] = True

    def pop(tag: str) -> None:
        gone = ""
        while gone != tag:
            if stack[-1][1] == OUT:
                close_block()
            gone, level, _ = stack.pop()
            opened[gone] -= 1
            if level == OUT and stack[-1][1] != OUT:
                pieces[:] = held
                held.clear()
            if gone == "article" and len(said) > 1:
                said.pop()

    def leave(tag: str) -> None:
        """Close ``tag`` if no other block lies between."""
        for name, _, _ in reversed(stack):
            if name == tag:
                pop(tag)
                return
            if name in BLOCK or not name:
                return

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            pieces.append(html.unescape(page[at:end]))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            pieces.append(" ")
        if m[1]:
            if tag in BLOCK and (opened.get(tag) or tag == "p"):
                close_block()
            if opened.get(tag):
                if tag in BLOCK:
                    pop(tag)
                else:
                    leave(tag)
            continue
        if tag in BLOCK:
            close_block()
            if opened.get("p"):
                leave("p")
            if tag in ("li", "dt", "dd", "tr", "td", "th") and stack[-1][0] == tag:
                pop(tag)
        if opened.get("head") and tag not in IN_HEAD:
            pop("head")
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = done.end() if done else n
            continue
        level = stack[-1][1]
        marked, names = _marked(tag, m[3])
        if level != OUT:
            if marked or tag in OUTSIDE or (tag == "header" and level == FREE):
                level = OUT
            elif tag == "article":
                # An article in an article that already has text is a reader's comment.
                level = OUT if level == ARTICLE and said[-1] else ARTICLE
            elif tag == "main":
                level = max(level, MAIN)
        if level == OUT and stack[-1][1] != OUT:
            held[:] = pieces
            pieces.clear()
        if tag == "article":
            said.append(False)
        stack.append((tag, level, f"{tag}.{names}"))
        opened[tag] = opened.get(tag, 0) + 1
    close_block()
    if held:  # the inline element never ended
        del stack[next(i for i, entry in enumerate(stack) if entry[1] == OUT):]
        pieces[:] = held
        close_block()
    return out


class Counted(NamedTuple):
    """Ascending window keys of a host, the groups that have each, and all groups of the host; keys left out count as 0."""

    keys: np.ndarray
    n: np.ndarray
    different: int


def window_keys(tokens: np.ndarray, run: int = RUN) -> np.ndarray:
    """64-bit key of the ``run`` tokens that begin at each token, as far as they reach."""
    n = max(len(tokens) - run + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(run):
        h = h * np.uint64(_ODD) + tokens[k:n + k].view(np.uint64)
    return mix(h).view(np.int64)


def repeated_runs(streams: list[np.ndarray], groups: np.ndarray, run: int = RUN, pages: int = PAGES, article_pages: int = ARTICLE_PAGES, known: Counted | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per stream: which tokens lie in runs of ``run`` tokens that ``pages`` different groups have, and in runs that half of them have.

    A suffix array over all streams, sorted to the depth of ``run``: ranks of the suffixes by their first 1, 2,
    4, ... tokens. Each stream ends with a token of its own. The second mask needs ``article_pages`` groups.
    If the streams are a part of a host, ``known`` has the groups of the classes in the whole host.
    """
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    n = int(starts[-1])
    tokens = np.empty(n, dtype=np.int64)
    for k, s in enumerate(streams):
        tokens[starts[k]:starts[k] + len(s)] = s
        tokens[starts[k] + len(s)] = -1 - k
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < run:
        step = min(width, run - width)
        key = rank * (n + 1)
        key[: max(n - step, 0)] += rank[step:] + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        width += step
    stream = np.repeat(np.arange(len(streams)), sizes + 1)
    own = groups[stream]
    different = int(groups.max()) + 1 if len(groups) else 0
    if known is None:
        pairs = np.unique(rank * different + own)
        count = np.bincount(pairs // different, minlength=int(rank.max()) + 1)
    else:
        different = known.different
        count = np.zeros(int(rank.max()) + 1, dtype=np.int64)
        inside = np.flatnonzero(np.arange(n) + run <= (starts[1:] - 1)[stream])
        keys = window_keys(tokens, run)[inside]
        if len(known.keys):
            at = np.minimum(np.searchsorted(known.keys, keys), len(known.keys) - 1)
            hit = known.keys[at] == keys
            count[rank[inside[hit]]] = known.n[at[hit]]
    half = max(article_pages, (different + 1) // 2)
    masks = []
    for least in (pages, half):
        # Windows that reach over the end of a stream hold its last token, which no other stream has.
        hit = np.flatnonzero(count[rank] >= least)
        edge = np.zeros(n + run + 1, dtype=np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + run, -1)
        covered = np.cumsum(edge[:n]) > 0
        masks.append([covered[starts[k]:starts[k] + len(s)] for k, s in enumerate(streams)])
    return masks[0], masks[1]


def page_streams(pages: list[list[Block]]) -> tuple[list[np.ndarray], list[str]]:
    """(tokens of each page, its longest block: pages that share it are copies)."""
    streams, longest = [], []
    for blocks in pages:
        words, counts = word_hashes([b.text.encode("utf-8", "surrogatepass") for b in blocks])
        marks = np.array([mark_token(b.mark) for b in blocks], dtype=np.int64)
        heads = np.concatenate(([0], np.cumsum(counts + 1)[:-1])) if len(blocks) else np.zeros(0, np.int64)
        stream = np.empty(len(words) + len(blocks), dtype=np.int64)
        is_head = np.zeros(len(stream), dtype=bool)
        is_head[heads] = True
        stream[is_head] = marks
        stream[~is_head] = (words >> np.uint64(8)).astype(np.int64)
        streams.append(stream)
        longest.append(max(blocks, key=lambda b: len(b.text)).text if blocks else "")
    return streams, longest


def main_level(blocks: list[Block]) -> int:
    """The level whose blocks are the main text of a page."""
    return max((b.level for b in blocks if b.level != OUT), default=FREE)


def main_texts(pages: list[list[Block]], run: int = RUN, least: int = PAGES, article_pages: int = ARTICLE_PAGES, known: Counted | None = None) -> list[tuple[str, int]]:
    """(text, blocks taken out as repeated) of the pages of one host, or of a part of a host with the counts of the whole."""
    streams, longest = page_streams(pages)
    seen: dict[str, int] = {}
    groups = np.array([seen.setdefault(text, len(seen)) for text in longest], dtype=np.int64)
    often, always = repeated_runs(streams, groups, run, least, article_pages, known)
    out = []
    for blocks, weak, strong in zip(pages, often, always):
        level = main_level(blocks)
        chosen, at = [], 0
        for block in blocks:
            size = len(block.text.encode("utf-8", "surrogatepass").split()) + 1
            mask = (strong if level else weak)[at + 1:at + size]
            at += size
            if block.level == level:
                chosen.append((block.text, len(mask), 2 * int(mask.sum()) > len(mask)))
        gone = sum(words for _, words, repeated in chosen if repeated)
        if level and 2 * gone > sum(words for _, words, _ in chosen):
            chosen = [(text, words, False) for text, words, _ in chosen]  # a copied article, not boilerplate
        out.append(("\n\n".join(text for text, _, repeated in chosen if not repeated), sum(r for _, _, r in chosen)))
    return out


def mark_token(mark: str) -> int:
    """Token of a block's beginning: above all word tokens."""
    return (1 << 57) + (xxhash.xxh3_64_intdigest(mark.encode("utf-8", "surrogatepass")) >> 8)


def host_of(url):
    """The host of a URL in lower case; "" for null and what has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def _parsed(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[Block]]]]:
    """(rows, their blocks), 64 rows at a time."""
    for batch in batches:
        for begin in range(0, len(batch), 64):
            own = batch.slice(begin, 64)
            yield own, [page_blocks(value.as_py()) for value in own.column(column)]


def _copy_key(longest: str) -> int:
    return xxhash.xxh3_64_intdigest(longest.encode("utf-8", "surrogatepass")) - (1 << 63)


def large_hosts(rows: DataFrame, part_bytes: int) -> DataFrame:
    """(host, parts, n_pages, n_groups, least) of the hosts of ``rows`` (host, page, ...) with more than ``part_bytes``.

    ``least`` is how many groups a run needs before any page of the host can ask for it: ``PAGES`` if some page has
    main text that no markup tells, else half of all groups, as in an article.
    """
    sizes = rows.groupBy("host").agg(F.sum(F.octet_length("page")).alias("bytes")).where(F.col("bytes") > part_bytes)
    # Written, so that the planner knows its size before it chooses the join.
    large = stored(sizes.select("host", F.ceil(F.col("bytes") / part_bytes).alias("parts")), "large_hosts")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, found in _parsed(batches, 1):
            keys = [_copy_key(text) for text in page_streams(found)[1]]
            free = [main_level(p) == FREE and any(b.level == FREE for b in p) for p in found]
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(keys, pa.int64()), pa.array(free, pa.bool_())], ["host", "own", "free"])

    told = rows.join(large, "host").select("host", "page").mapInArrow(tell, "host string, own long, free boolean")
    groups = told.groupBy("host", "own").agg(F.count("*").alias("n"), F.max("free").alias("free"))
    hosts = groups.groupBy("host").agg(F.sum("n").alias("n_pages"), F.count("*").alias("n_groups"), F.max("free").alias("free"))
    least = F.when(F.col("free"), F.lit(PAGES)).otherwise(F.greatest(F.lit(ARTICLE_PAGES), F.ceil(F.col("n_groups") / 2)))
    return stored(large.join(hosts, "host").select("host", "parts", "n_pages", "n_groups", "free", least.cast("long").alias("least")), "host_counts")


def host_windows(rows: DataFrame, large: DataFrame) -> DataFrame:
    """(host, part, window, n, n_groups): the windows of the parts of ``large`` hosts that ``least`` groups of the whole host have.

    Where only windows of half of all groups count, each task first names those that stand on as large a share of
    the pages it sees: a window that does so in no task can't do so in all. They alone are counted exactly, by
    distinct (group, window); on hosts with pages without markup every window is.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, list] = {}
        held = 0

        def frequent() -> Iterator[pa.RecordBatch]:
            for host, (n_pages, least, windows) in cells.items():
                keys, n = np.unique(np.concatenate(windows), return_counts=True)
                keys = keys[n * n_pages >= least * len(windows)]
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(keys), pa.string()), pa.array(keys)], ["host", "window"])

        for own, found in _parsed(batches, 1):
            for host, n_pages, least, stream in zip(own.column(0).to_pylist(), own.column(2).to_pylist(), own.column(3).to_pylist(), page_streams(found)[0]):
                windows = np.unique(window_keys(stream))
                cells.setdefault(host, [n_pages, least, []])[2].append(windows)
                held += len(windows) + 1
            if held > CELL_WINDOWS:
                yield from frequent()
                cells.clear()
                held = 0
        yield from frequent()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for own, found in _parsed(batches, 2):
            streams, longest = page_streams(found)
            asked = []
            for host, part, wanted, stream, text in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), own.column(3), streams, longest):
                windows = np.unique(window_keys(stream))
                if wanted.is_valid:
                    windows = windows[np.isin(windows, wanted.values.to_numpy())]
                row = (host, part, _copy_key(text), xxhash.xxh3_128_digest(windows))
                if len(windows) and row not in seen:  # copies say nothing new
                    seen.add(row)
                    asked.append((*row[:3], windows))
            if len(seen) > CELL_WINDOWS // 20:
                seen.clear()
            columns = list(zip(*asked)) if asked else [[]] * 4
            types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["host", "part", "own", "windows"])

    marked = rows.join(large.where(~F.col("free")), "host").select("host", "page", "n_pages", "least")
    named = marked.mapInArrow(name, "host string, window long").groupBy("host").agg(F.collect_set("window").alias("wanted"))
    asking = rows.join(large.select("host", "free"), "host").join(stored(named, "frequent_windows"), "host", "left").where("free or wanted is not null")
    asked = asking.select("host", "part", "page", "wanted").mapInArrow(ask, "host string, part long, own long, windows array<long>")
    # A page is one row here: the windows of boilerplate are the same on many and compress.
    each = asked.repartition("host", "own").select("host", "part", "own", F.explode("windows").alias("window"))
    groups = each.groupBy("host", "own", "window").agg(F.collect_set("part").alias("parts"))
    counts = groups.groupBy("host", "window").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set("parts"))).alias("parts"))
    enough = counts.join(large.select("host", "n_groups", "least"), "host").where("n >= least")
    return enough.select("host", F.explode("parts").alias("part"), "window", "n", "n_groups")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", part_bytes: int = PART_BYTES) -> DataFrame:
    """(page_id, url, text, n_repeated) of every row: the main text, and how many blocks were taken out as repeated.

    White space in a block becomes one space, blocks are joined by two line feeds. Pages of one host are
    compared with each other; a host of more than ``part_bytes`` is split by a hash of its pages into
    parts of about that size, each with its own array, whose classes are counted over all parts: the results don't
    depend on ``part_bytes``. So memory is bounded whatever a host holds. Null and empty pages give ""; null and malformed URLs share the
    host "". Repeated rows come out repeatedly and count as one page. Empty table: no rows. Other columns are not read.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(page), F.lit("")).alias("page"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    large = large_hosts(rows, part_bytes)
    # Parts of hosts that are whole have the number -1.
    part = F.coalesce(F.pmod(F.xxhash64(F.coalesce("page_id", F.lit(-1)), F.coalesce("url", F.lit(""))), F.col("parts")), F.lit(-1)).alias("part")
    rows = rows.join(large.select("host", "parts"), "host", "left").select("host", part, "page_id", "url", "page")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, found in _parsed(batches, 4):
            columns = [*own.columns[:4], pa.array([[b.text for b in p] for p in found], pa.list_(pa.string())),
                       pa.array([[b.level for b in p] for p in found], pa.list_(pa.int8())), pa.array([[b.mark for b in p] for p in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "part", "page_id", "url", "texts", "levels", "marks"])

    def extract(table: pa.Table, windows: pa.Table) -> pa.Table:
        known = None
        if table.column("part")[0].as_py() >= 0:
            windows = windows.sort_by("window")
            different = windows.column("n_groups")[0].as_py() if len(windows) else 0
            known = Counted(windows.column("window").to_numpy(), windows.column("n").to_numpy(), different)
        texts, levels, marks = (table.column(c).to_pylist() for c in ("texts", "levels", "marks"))
        found = main_texts([list(map(Block, *page)) for page in zip(texts, levels, marks)], known=known)
        columns = [table.column("page_id"), table.column("url"), pa.array([t for t, _ in found], pa.string()), pa.array([r for _, r in found], pa.int64())]
        return pa.Table.from_arrays(columns, ["page_id", "url", "text", "n_repeated"])

    blocks = rows.mapInArrow(parse, "host string, part long, page_id long, url string, texts array<string>, levels array<tinyint>, marks array<string>")
    windows = host_windows(rows.select("host", "part", "page"), large)
    return blocks.groupBy("host", "part").cogroup(windows.groupBy("host", "part")).applyInArrow(extract, "page_id long, url string, text string, n_repeated long")


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
