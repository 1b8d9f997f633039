"""HTML extraction with a site style tree."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import stored

_ATTRIBUTES = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRIBUTES})>|<(/?)([a-z][^\s/>]*)([^>]*)>|<[!?][^>]*>|<(/?[a-z!][^>]*)\Z",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Elements of HTML by what they mean here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li "
    "main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table article section div body main aside nav header footer form blockquote".split())
_NOISE_TAGS = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea dialog menu head title".split())
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar aside notice cookie cookies consent gdpr popup modal newsletter subscribe subscription signup login search form "
    "comment comments reply replies disqus share sharing social related recommended pagination pager widget copyright".split()
)


@dataclass(frozen=True)
class Style:
    """A branch is unimportant below ``least``, if ``pages`` different pages of its host have it and it does not hold ``most`` of
    the host's text. ``gamma`` weighs the presentation against the content."""

    least: float = 0.25
    pages: int = 8
    most: float = 0.5
    gamma: float = 0.9


@dataclass
class _Node:
    tag: str
    path: str
    noise: bool
    inside: bool  # within article or main
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Blocks (path, within an article, noise by its markup, text) and the branches with their presentations."""

    blocks: list[tuple[str, bool, bool, str]]
    branches: list[tuple[str, str]]


def parsed(source: str) -> Page:
    """Reads a page as browsers do: what is not closed ends with what holds it; stray end tags are left out."""
    root = _Node("", "", False, False)
    stack, blocks, branches, words = [root], [], [], []

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            holder = next(n for n in reversed(stack) if n.tag not in _INLINE)
            blocks.append((holder.path, holder.inside, holder.noise, text))

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag not in _INLINE:
                flush()
                node = stack.pop()
                branches.append((node.path, " ".join(node.children)))
            else:
                stack.pop()

    def last(tags: set[str] | frozenset[str], until: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in until:
                return 0
        return 0

    at = 0
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            words.append(html.unescape(source[at : m.start()]))
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        tag, ending = name.lower(), bool(m[2] or m[5])
        if ending:
            depth = last({tag}, frozenset() if tag not in _INLINE else _ENDS_PARAGRAPH)
            if depth:
                close(depth)
            elif tag in _ENDS_PARAGRAPH:
                flush()
            continue
        if tag in _ENDS_PARAGRAPH and (depth := last({"p"}, _SCOPE)):
            close(depth)
        if tag in _OWN_KIND and (depth := last(_OWN_KIND[tag], _SCOPE - {"div"})):
            close(depth)
        if tag == "br":
            words.append(" ")
        elif tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _VOID:
            continue
        attributes = m[4] if m[3] else m[7]
        if tag in _INLINE and not (attributes and _NAMED.search(attributes)):
            stack.append(_Node(tag, stack[-1].path, stack[-1].noise, stack[-1].inside))
            continue
        flush()
        named = " ".join(x for g in _NAMED.findall(attributes or "") for x in g if x).lower() if attributes else ""
        noise = tag in _NOISE_TAGS or (bool(named) and tag not in ("body", "html", "article", "main") and not _NOISE_NAMES.isdisjoint(re.split(r"[^a-z]+", named)))
        key = tag + ("." + ".".join(sorted(set(re.sub(r"\d+", "0", named).split()))) if named else "")
        parent = stack[-1]
        if not parent.children or parent.children[-1] != key:
            parent.children.append(key)
        if tag in _INLINE:  # an inline element with a name of its own is a branch, too
            tag = f"{tag} "
        stack.append(_Node(tag, f"{parent.path}/{key}", parent.noise or noise, parent.inside or tag in ("article", "main")))
    if at < len(source):
        words.append(html.unescape(source[at:]))
    close(1)
    flush()
    return Page(blocks, branches)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pages of a host have a branch (kind n, and its text's length), a branch with a presentation (p) and a text below a branch
    (c). Added up before it leaves the task, as far as a batch goes."""
    for batch in batches:
        pages: Counter[tuple[str, str, str, int]] = Counter()
        sizes: Counter[tuple[str, str]] = Counter()
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = parsed(source)
            seen: set[tuple[str, str, str, int]] = set()
            for path, _, noise, text in page.blocks:
                if noise:
                    continue
                feature = _hash(text)
                while path:
                    seen |= {(host, path, "c", feature), (host, path, "n", 0)}
                    sizes[host, path] += len(text)
                    path = path.rpartition("/")[0]
                sizes[host, ""] += len(text)
            seen |= {(host, path, "p", _hash(shown)) for path, shown in page.branches if (host, path, "n", 0) in seen}
            seen.add((host, "", "n", 0))
            pages.update(seen)
        columns = list(zip(*((*k, n, sizes[k[0], k[1]] if k[2] == "n" else 0) for k, n in pages.items()))) or [()] * 6
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["host", "path", "kind", "feature", "pages", "chars"])


def unimportant(pages: DataFrame, style: Style = Style()) -> DataFrame:
    """``host, paths``: the branches of each host's style tree that carry little importance.

    ``pages`` has ``host`` and ``html``. Entropies are taken to the base of the branch's number of pages: that of its presentations, and for its
    content one less the mean entropy of the texts below it, so what stands on every page has none and what stands on one page has all.
    """
    counted = pages.mapInArrow(_counted, "host string, path string, kind string, feature bigint, pages bigint, chars bigint")
    features = counted.groupBy("host", "path", "kind", "feature").agg(F.sum("pages").alias("d"), F.sum("chars").alias("chars"))
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    d, logs = F.col("d"), F.col("d") * F.log("d")
    branches = features.groupBy("host", "path").agg(
        of("n", d).alias("m"), of("n", F.col("chars")).alias("chars"), of("c", d).alias("texts"), of("c", logs).alias("text_logs"),
        of("p", d).alias("shown"), of("p", logs).alias("shown_logs"), of("p", F.lit(1)).alias("kinds"),
    )
    whole = branches.where("path = ''").select("host", F.col("chars").alias("all_chars"))
    base = F.log("m")
    content = 1 - F.col("text_logs") / F.col("texts") / base
    presentation = (F.log("shown") - F.col("shown_logs") / F.col("shown")) / base
    share = F.pow(F.lit(style.gamma), F.greatest(F.col("kinds"), F.lit(1)))
    importance = (1 - share) * F.coalesce(presentation, F.lit(0.0)) + share * F.coalesce(content, F.lit(1.0))
    return (
        branches.where((F.col("path") != "") & (F.col("m") >= style.pages))
        .join(whole, "host")
        .where((importance < style.least) & (F.col("chars") < style.most * F.col("all_chars")))
        .groupBy("host")
        .agg(F.collect_list("path").alias("paths"))
    )


def article(source: str, paths: list[str] | None) -> str:
    """The blocks of the page that its markup does not name as anything but content and whose branch matters: those of its
    articles if it has any."""
    page, low = parsed(source), set(paths or ())
    blocks = [b for b in page.blocks if not b[2]]
    if any(b[1] for b in blocks):
        blocks = [b for b in blocks if b[1]]
    if low:
        blocks = [b for b in blocks if not any(b[0] == p or b[0].startswith(f"{p}/") for p in low)]
    return "\n\n".join(b[3] for b in blocks)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [article(s, p) for s, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        lens = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lens], ["page_id", "url", "text", "n_chars"])


def extracted(
    pages: DataFrame, style: Style = Style(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page, one row per row of ``pages``.

    The pages of a host form a style tree: branches with the same path of elements and names are one branch. Two passes: the
    first counts, per host and branch, presentations and texts, and finds the branches of low importance
    (``unimportant``); the second takes from each page the blocks of its articles, without those branches and without what the markup itself names as
    menus, headers, footers, adverts and the like. Small hosts are judged by the markup alone, and a branch that holds most of a
    host's text always stays, so copies of one article do not remove it. A host may have a third of all pages: only counts meet by host and branch.

    Blocks keep page order and are joined by two line feeds; white space inside a block is one space; references are decoded; unclosed and
    cut-off markup is read as browsers do. Null html: empty text. Null url: a host of its own, with others like it. Empty table: no rows. Extra
    columns play no part.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
        F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("")).alias("host"),
    )
    low = stored(unimportant(rows.select("host", "html"), style), "style-tree")
    return rows.join(low, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(
        _extracted, "page_id bigint, url string, text string, n_chars bigint"
    )
