"""Main text of web pages by site style trees.

The DOMs of one host are merged: elements with the same path of tags and classes are one node of the site's
style tree.  A node's presentation importance is the entropy of the child sequences it has on its pages, its
content importance is one minus the mean entropy of its text blocks over the pages (a block on every page has
entropy 1, one that stands on a single page 0); both use logarithms to the base of the number of pages, so a node
seen on one page has importance 1.  The tree also knows how much text a node has on a page.

On each page, a branch's importance is that of its most important node (a branch is noise if all in it is) times a factor that
grows with its share of the text beside it: r / (r + SHARE), r its text over that of the greatest branch beside it.  Branches of low
importance are removed from the top down; inside the element that holds the running text itself the factor is 1.
Article and main elements weigh more, classes and ids that speak of adverts, notices, comments and the like weigh less;
elements and roles that are menus, footers, sidebars or forms by definition are no text at all.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches, text_of
from graphloom.session import cut

#: share of the content in a node's importance, and the importance under which a branch is removed
GAMMA, LEAST = 0.9, 0.4
#: share of the text beside it at which a branch has half its importance
SHARE = 0.2
#: weight of the text in an article or main element, and of that under a name that speaks of no content
LANDMARK_WEIGHT, NAME_WEIGHT = 1000.0, 0.01
#: nodes up to this number are broadcast (some 30 bytes each); beyond it they are joined by host
BROADCAST_NODES = 100_000

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template textarea title iframe svg math object select option datalist canvas audio video".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
NO_CONTENT = frozenset("nav aside footer form button menu dialog head fieldset label".split()) | SILENT
LANDMARK = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li blockquote pre table thead tbody tr td th dl dt dd figure figcaption section div".split())
#: a start tag on the left ends an open element on the right
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NO_CONTENT_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar "
    "sidenav widget widgets footer masthead topbar comment comments commentlist disqus respond replies share sharing social related "
    "recommended recommendations pagination pager toolbar hidden disclaimer copyright skip".split())

_TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^<]+|<(?!/?[a-zA-Z])", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_PARTS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]+")


class Block:
    """A run of text without a block boundary in it.

    ``path`` names its node in the style tree, ``branch`` the nearest element around it that is more than running text.
    """

    __slots__ = ("path", "branch", "silent", "named", "running", "text")

    def __init__(self, path: int, branch: int, silent: bool, named: bool, running: bool, text: str) -> None:
        self.path, self.branch, self.silent, self.named, self.running, self.text = path, branch, silent, named, running, text


class Element:
    """An open element, with what holds for all text in it."""

    __slots__ = ("tag", "path", "branch", "silent", "named", "landmark", "running", "holder")

    def __init__(self, tag: str, path: int, branch: int, silent: bool, named: bool, landmark: bool, running: bool) -> None:
        self.tag, self.path, self.branch, self.silent, self.named = tag, path, branch, silent, named
        self.landmark, self.running, self.holder = landmark, running, self


def _attributes(tag: str) -> dict[str, str]:
    name = _NAME.match(tag)
    found: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(tag[name.end():].rstrip("/>")):
        found.setdefault(key.lower(), html.unescape(a or b or c))
    return found


def _is_no_content(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """By definition of the element, its role, or because it is not shown."""
    if tag in NO_CONTENT or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    return (attributes.get("role", "").lower() in NO_CONTENT_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower())


def _speaks_of_no_content(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ("body", "html") or tag in LANDMARK:
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return not NO_CONTENT_NAMES.isdisjoint(_PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower()))


def _node(parent: int, style: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent} {style}") >> 1


def parse(source: str) -> tuple[list[Block], dict[int, str], dict[int, tuple[int, bool, bool]]]:
    """(text blocks in page order, child sequence by path, branches) of a page, however broken its markup.

    A branch is (parent branch, is an article or main, its name speaks of no content), parents first.  Time and memory
    grow with the page's length, whatever its nesting: paths are chained hashes, and open elements are known by tag.
    """
    stack = [Element("", 0, 0, False, False, False, False)]
    places: dict[str, list[int]] = {}  # where in the stack elements of a tag are open
    blocks: list[Block] = []
    children: dict[int, list[str]] = {}
    branches: dict[int, tuple[int, bool, bool]] = {0: (-1, False, False)}
    words: list[str] = []
    holder = stack[0]

    def end_block() -> None:
        if words:
            text = " ".join("".join(words).split())
            if text:
                blocks.append(Block(holder.path, holder.branch, holder.silent, holder.named, holder.running, text))
            words.clear()

    def close(upto: int) -> None:
        nonlocal holder
        if any(e.tag in BLOCKS for e in stack[upto:]):
            end_block()
        for e in reversed(stack[upto:]):
            places[e.tag].pop()
        del stack[upto:]
        holder = stack[-1].holder

    def find(names: tuple[str, ...], bounds: tuple[str, ...] = ()) -> int:
        """Place of the innermost open element of these names, 0 if there is none inside the innermost of ``bounds``."""
        last = max((places[n][-1] for n in names if places.get(n)), default=0)
        return last if last and last > max((places[n][-1] for n in bounds if places.get(n)), default=0) else 0

    at, size = 0, len(source)
    while at < size:
        token = _TOKENS.match(source, at)
        if token is None:
            break  # a tag with a quote that the page never closes
        at = token.end()
        token = token[0]
        if token[0] != "<" or token == "<":
            words.append(html.unescape(token))
            continue
        if token[1] in "!?":
            continue
        if not token.endswith(">"):
            break  # a tag that the page's end cut off
        name = _NAME.match(token)[1].lower()
        if token[1] == "/":
            if name == "br":
                words.append(" ")
            elif name not in VOID and (i := find((name,), () if name in LANDMARK or name in ("body", "html") else ("article", "main", "td", "th"))):
                close(i)
            continue
        if name == "br":
            words.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                end_block()
            continue
        if name in BLOCKS and (i := find(("p",), ("article", "main", "td", "th", "li", "button"))):
            close(i)
        if name in ENDS and (i := find(ENDS[name], SCOPE[name])):
            close(i)
        if name in LANDMARK and (i := find(("head", "nav", "header", "aside"))):
            close(i)  # a menu that was never closed does not swallow the article
        if name == "body" and (i := find(("head",))):
            close(i)
        attributes = _attributes(token) if " " in token or "\n" in token or "\t" in token else {}
        around = stack[-1]
        if name in BLOCKS:
            end_block()
        style = ".".join([name, *sorted(set(attributes.get("class", "").lower().split()))])
        path, branch = around.path, around.branch
        silent = around.silent or _is_no_content(name, attributes, around.landmark)
        here = bool(attributes) and _speaks_of_no_content(name, attributes)
        block = name in BLOCKS or name in NO_CONTENT
        if block:
            children.setdefault(path, []).append(style)
            style = _DIGITS.sub("#", style)
            path = _node(path, style)
            if style not in PLAIN or here:
                branch = _node(branch, f"{style} {here}")
                branches.setdefault(branch, (around.branch, name in LANDMARK, here))
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = stop.end() if stop else size
            continue
        if token.endswith("/>") and name in ("svg", "path"):
            continue
        landmark = around.landmark or name in LANDMARK
        running = name in LANDMARK or around.running and (not block or style in PLAIN)
        entry = Element(name, path, branch, silent, around.named or here, landmark, running)
        if block or silent and not around.silent:
            if silent and not holder.silent:
                end_block()
            holder = entry
        else:
            entry.holder = around.holder
        places.setdefault(name, []).append(len(stack))
        stack.append(entry)
    end_block()
    return blocks, {k: " ".join(dict.fromkeys(v)) for k, v in children.items()}, branches


def _host() -> Column:
    """Lower-cased host of the address; pages without one share the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_FEATURES = "host string, page long, seen array<struct<path: long, kind: string, feature: long>>"


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> (host, page, seen): text blocks and child sequences by path; ``page`` is the hash of all text that may be content."""
    for batch in row_batches(batches, rows=200):
        keys, ends, flat = [], [0], []
        for source in batch.column("html").to_pylist():
            blocks, children, _ = parse(source)
            chars = dict.fromkeys(children, 0)
            for b in blocks:
                chars[b.path] = chars.get(b.path, 0) + len(b.text)
            found = {(b.path, "text", xxhash.xxh3_64_intdigest(b.text) >> 1) for b in blocks}
            found |= {(path, "style", xxhash.xxh3_64_intdigest(style) >> 1) for path, style in children.items()}
            found |= {(path, "page", n) for path, n in chars.items()}
            flat += sorted(found)
            ends.append(len(flat))
            keys.append(xxhash.xxh3_64_intdigest("\n".join(f"{b.path} {b.text}" for b in blocks if not (b.silent or b.named))) >> 1)
        entries = pa.StructArray.from_arrays(
            [pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.string()), pa.array([f[2] for f in flat], pa.int64())],
            names=["path", "kind", "feature"])
        yield pa.record_batch([batch.column("host"), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)],
                              names=["host", "page", "seen"])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance, chars) of every node with text, from (host, html); ``chars``: mean length of its text.

    Pages of one host with the same text are copies and count once: a copy says nothing about what a site repeats.
    """
    # of copies, the one with the least features: the same on any partitioning
    counted = pages.mapInArrow(_observe, _FEATURES).groupBy("host", "page").agg(F.min("seen").alias("seen")) \
        .select("host", F.inline("seen")).groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    text, style, page = F.col("kind") == "text", F.col("kind") == "style", F.col("kind") == "page"
    nodes = counted.groupBy("host", "path").agg(
        F.sum(F.when(page, F.col("n"))).alias("pages"),
        F.sum(F.when(page, F.col("n") * F.col("feature"))).alias("chars"),
        F.avg(F.when(text, F.log("n"))).alias("block_log"),  # entropy of a block on n pages, before the base
        F.sum(F.when(style, F.col("n"))).alias("styled"),
        F.sum(F.when(style, F.col("n") * F.log("n"))).alias("style_log"))
    base = F.log("pages")
    many = F.col("pages") > 1
    content = F.when(many, 1 - F.col("block_log") / base).otherwise(1.0)
    # -sum p log p with p = n / styled
    spread = (F.log("styled") - F.col("style_log") / F.col("styled")) / base
    presentation = F.when(F.col("styled").isNull(), content).when(many, spread).otherwise(1.0)
    return nodes.filter("block_log is not null").select(
        "host", "path", "pages", ((1 - GAMMA) * presentation + GAMMA * content).alias("importance"), (F.col("chars") / F.col("pages")).alias("chars"))


def main_text(source: str, site: dict[int, tuple[float, float]] | None = None, tree_alone: bool = False) -> str:
    """Text of a page's main content; ``site``: (importance, mean length of text) by path on its host, where known.

    Plain running text of an article or main element stays where a site repeats it (a story printed twice).
    ``tree_alone`` leaves elements, roles and names aside, so that the style tree alone decides.
    """
    blocks, _, branches = parse(source)
    if not tree_alone:
        blocks = [b for b in blocks if not b.silent]
    site = site or {}
    own: dict[int, float] = {}
    holds: dict[int, int] = {}
    for b in blocks:
        own[b.path], holds[b.path] = own.get(b.path, 0.0) + len(b.text), b.branch
    direct, best = dict.fromkeys(branches, 0.0), dict.fromkeys(branches, 0.0)
    for path, chars in own.items():
        importance, usual = site.get(path, (1.0, chars))
        direct[holds[path]] += usual
        best[holds[path]] = max(best[holds[path]], importance)
    # from the leaves up: parents come first in ``branches``
    total = direct.copy()
    greatest = dict.fromkeys(branches, 0.0)
    for branch in reversed(branches):
        parent, landmark, named = branches[branch]
        if not tree_alone:
            total[branch] *= (LANDMARK_WEIGHT if landmark else 1.0) * (NAME_WEIGHT if named else 1.0)
        if parent >= 0:
            total[parent] += total[branch]
            best[parent] = max(best[parent], best[branch])
            greatest[parent] = max(greatest[parent], total[branch])

    def share(text: float, beside: float) -> float:
        r = text / beside if beside else 0.0
        return r / (r + SHARE)

    kept, content = {0: True}, {}
    for branch, (parent, landmark, named) in branches.items():
        if parent >= 0:
            beside = max(direct[parent], greatest[parent])
            factor = 1.0 if content[parent] and (tree_alone or not named) else share(total[branch], beside)
            kept[branch] = kept[parent] and best[branch] * factor >= LEAST
        content[branch] = parent >= 0 and content[parent] or landmark and not tree_alone or direct[branch] >= greatest[branch]
    out = []
    for b in blocks:
        if not kept[b.branch]:
            continue
        if not content[b.branch] and share(direct[b.branch], max(direct[b.branch], greatest[b.branch])) < LEAST:
            continue
        if site.get(b.path, (1.0, 0.0))[0] >= LEAST or b.running and not tree_alone:
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars.

    Blocks of the main content in page order, joined by newlines, white space inside a block as one space; an
    empty text where there is none, as for null or empty html.  Pages without an address share one host.  A host
    with one page is judged by that page.  Copies of a page on its host count as one page there, and all get their text.  Very long pages are read whole;
    an empty table gives an empty one; other columns play no part.
    """
    rows = in_small_batches(pages).select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), text_of(html_column).alias("html")).withColumn("host", _host())
    # a node seen on one page says nothing that the page does not say itself
    sites = style_tree(rows.select("host", "html")).filter(F.col("pages") > 1).groupBy("host").agg(
        F.collect_list(F.struct("path", F.col("importance").cast("float").alias("importance"), F.col("chars").cast("float").alias("chars"))).alias("site"))
    # written, as two readers follow; its size is checked before it is broadcast
    sites = cut(sites)
    total = sites.agg(F.sum(F.size("site"))).first()[0] or 0
    sites = F.broadcast(sites) if total <= BROADCAST_NODES else sites
    kind = pages.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in row_batches(batches):
            hosts, column, texts = batch.column("host").to_pylist(), batch.column("site"), []
            for i, source in enumerate(batch.column("html").to_pylist()):
                if hosts[i] not in known:
                    if len(known) >= 64:
                        known.clear()
                    known[hosts[i]] = {n["path"]: (n["importance"], n["chars"]) for n in column[i].as_py() or ()}
                texts.append(main_text(source, known[hosts[i]]))
            yield pa.record_batch([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["id", "url", "text", "n_chars"])

    return rows.join(sites, "host", "left").select("id", F.col("url").cast("string").alias("url"), "host", "html", "site").mapInArrow(
        run, f"id {kind}, url string, text string, n_chars bigint")
