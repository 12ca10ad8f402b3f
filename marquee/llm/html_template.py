"""HTML extraction by template deduction from pages of the same host.

A page is a sequence of tokens: its tags, told apart by their path of open elements,
and its text nodes. Over all pages of a host a token has an occurrence vector, its
count on every page; tokens with equal vectors form an equivalence class. Vectors
are never built: each page adds ``count * mix(page)`` to a 64-bit sum per (host,
token), so equal sums are equal vectors, tasks pre-aggregate, and a host with a
third of all pages is still a few rows per task.

The root class in page order is the host's template: of the classes of tags that never
stand twice on a page, that on the most pages. Other classes are nested in the
slots between two root tokens that hold them.
Text that stands on at least half of the pages of a host outside its main element is
part of the template, too. What remains of a page are its slots; the main text are
the slots inside the template's main element (``article`` or ``main``), or with no such
element all slots, without elements whose name, class or id marks them as menus,
headers, footers, sidebars, notices, adverts, forms or comments. A page that does
not follow its host's template, or whose host has fewer than ``MIN_PAGES`` pages, is
read by the element rules alone.

Defined results: null html is empty and gives an empty text; a null url, or one
without ``://``, has the empty host; repeated rows each get their text; extra columns
pass through, and columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from decimal import Decimal
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_map, blocks, lookup_join, stored
from marquee.llm.url_filter import host_of

MIN_PAGES = 3
SUPPORT = 0.5                # share of a host's pages that a token of the template is on
BLOCK_BYTES = 4 << 20
PARTIAL_ROWS = 200_000       # (host, token) sums a task holds before it passes them on

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style template noscript iframe object svg math head title".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody "
                  "td tfoot th thead tr ul".split())
SIDE = frozenset("nav aside footer header form button select textarea menu dialog".split()) | HIDDEN
MAIN = frozenset(("article", "main"))
# Words of a class or id that mark an element as not part of the article.
SIDE_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
                       "cookies consent footer header masthead menu nav navbar navigation newsletter notice popup "
                       "promo related share sharing sidebar social sponsor sponsored subscribe widget".split())

SCAN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
                  r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-z][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


class Node:
    """An open element: name, path, and whether it or an ancestor is main or beside the article."""
    __slots__ = ("name", "path", "main", "side")

    def __init__(self, name: str, marks: str, parent: Node | None):
        label = f"{name}.{marks}" if marks else name
        self.name = name
        self.path = f"{parent.path}/{label}" if parent else label
        self.main = name in MAIN or bool(parent and parent.main)
        inside = parent is not None and parent.main
        side = (name in SIDE and not (inside and name == "header")
                or name not in ("html", "body", "article", "main") and bool(
                    SIDE_WORDS.intersection(re.split(r"[^a-z]+", marks))))
        self.side = side or bool(parent and parent.side)


def tokens(html: str) -> Iterator[tuple[str, Node | None, str]]:
    """(token, node, text): a tag token has its path and no text, a text token is ``=`` and its text."""
    stack: list[Node] = []
    for m in SCAN.finditer(html):
        _, slash, name, attributes, text = m.groups()
        if text is not None:
            if not text.isspace():
                yield "=", stack[-1] if stack else None, text
            continue
        if name is None:
            continue                                  # comment, doctype, script, style
        name = name.lower()
        if slash:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if at is not None:
                node = stack[at]
                del stack[at:]
                yield f"/{node.path}", stack[-1] if stack else None, ""
            continue
        if name in BLOCK:
            _close_implied(stack, name)
        marks = " ".join(v.strip("\"'").lower() for v in MARKS.findall(attributes)) if attributes else ""
        node = Node(name, marks, stack[-1] if stack else None)
        yield node.path, node, ""
        if name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)


def _close_implied(stack: list[Node], name: str) -> None:
    """End tags that HTML lets a page leave out: of p before a block, of li, dt, dd, tr, td, th, option."""
    ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"),
            "th": ("td", "th")}.get(name, ()) + ("p",)
    bounds = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(name, ())
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].name in ends:
            del stack[i:]
            return
        if stack[i].name in bounds or stack[i].name in ("article", "main", "body", "div", "section", "td", "table"):
            return


def token_key(token: str, text: str) -> int:
    """Signed 64-bit hash of a tag path or of a text node."""
    raw = f"{token}\0{' '.join(text.split())}".encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _page_mix(html: str, url: str | None) -> int:
    raw = f"{url}\0{html}".encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little") | 1


SUMS = "host string, token long, is_text boolean, main long, pages long, total long, vector long, place double"
_SUMS_ARROW = pa.schema([("host", pa.string()), ("token", pa.int64()), ("is_text", pa.bool_()), ("main", pa.int64()),
                         ("pages", pa.int64()), ("total", pa.int64()), ("vector", pa.int64()), ("place", pa.float64())])


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (host, token) of a task: pages, occurrences, vector sum, sum of first places.

    Token 0 stands for the page itself. ``main`` is 1 for an opening main element, 2 for
    its end, 0 otherwise.
    """
    sums: dict = {}
    for block in blocks(batches, "html", BLOCK_BYTES):
        d = block.to_pydict()
        for host, url, html in zip(d["host"], d["url"], d["html"]):
            html = html or ""
            mix = _page_mix(html, url)
            count: Counter = Counter({(0, False, 0): 1})
            first: dict = {}
            for place, (token, node, text) in enumerate(tokens(html), 1):
                if text and node is not None and node.main:
                    continue                          # text of the main element is never template
                main = 0 if text else _main_mark(token)
                key = (token_key(token, text), bool(text), main)
                count[key] += 1
                first.setdefault(key, place)
            for key, n in count.items():
                row = sums.setdefault((host, *key), [0, 0, 0, 0.0])
                row[0] += 1
                row[1] += n
                row[2] += n * mix
                row[3] += first.get(key, 0)
        if len(sums) >= PARTIAL_ROWS:
            yield _sum_batch(sums)
            sums = {}
    if sums:
        yield _sum_batch(sums)


def _main_mark(token: str) -> int:
    name = token.rpartition("/")[2].partition(".")[0]
    return 0 if name not in MAIN else 2 if token.startswith("/") else 1


def _sum_batch(sums: dict) -> pa.RecordBatch:
    signed = lambda v: ((v + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)
    rows = [{"host": h, "token": t, "is_text": x, "main": m, "pages": v[0], "total": v[1], "vector": signed(v[2]),
             "place": v[3]} for (h, t, x, m), v in sums.items()]
    return pa.RecordBatch.from_pylist(rows, schema=_SUMS_ARROW)


def templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per host with enough pages: the root class in page order, the classes nested
    in it, and the text nodes of the template.

    ``root`` array<struct<token, main>>, ``nested`` array<array<long>> (one array per class),
    ``fixed`` array<long>.
    """
    # The sum of vectors may wrap around: added as decimals, then cut back to 64 bits.
    sums = arrow_map(pages.select("host", "url", "html"), _partial_sums, SUMS)
    wide = "decimal(38,0)"
    totals = sums.groupBy("host", "token", "is_text", "main").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum(F.col("vector").cast(wide)).alias("v"),
        F.sum("place").alias("place"))
    totals = totals.withColumn("vector", F.pmod("v", F.lit(Decimal(1 << 64)).cast(wide))).drop("v")
    totals = stored(totals.filter(F.col("token").eqNullSafe(0) | (F.col("pages") >= MIN_PAGES)), "token-sums")
    hosts = totals.filter("token = 0").select("host", F.col("pages").alias("in_host"))
    kept = totals.filter("token <> 0").join(hosts, "host").filter(
        (F.col("in_host") >= MIN_PAGES) & (F.col("pages") >= support * F.col("in_host")))
    fixed = kept.filter("is_text").groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("fixed"))
    # A class of a host holds at most its pages' tags: few, as each is on a share of all pages.
    classes = kept.filter("NOT is_text").groupBy("host", "vector", "pages", "total").agg(
        F.array_sort(F.collect_list(F.struct("place", "token", "main"))).alias("c"))
    classes = classes.withColumn("is_root", F.row_number().over(Window.partitionBy("host").orderBy(
        (F.col("total") == F.col("pages")).desc(), F.desc("pages"), F.desc(F.size("c")), "vector")) == 1)
    both = classes.groupBy("host").agg(
        F.max(F.when(F.col("is_root") & (F.col("total") == F.col("pages")), F.transform("c", lambda x: F.struct(
            x["token"].alias("token"), x["main"].alias("main"))))).alias("root"),
        F.sort_array(F.collect_list(F.when(~F.col("is_root") | (F.col("total") > F.col("pages")), F.transform(
            "c", lambda x: x["token"])))).alias("nested"))
    return both.join(fixed, "host", "full_outer")


def main_slots(root: list[tuple[int, int]]) -> set[int] | None:
    """Numbers of the slots inside the template's main element; None if it has none."""
    inside, depth = set(), 0
    for i, (_, main) in enumerate(root):
        depth += {1: 1, 2: -1}.get(main, 0)
        if depth > 0:
            inside.add(i)
    return inside or None


def extract(html: str | None, root: list[tuple[int, int]] | None = None, nested: list[list[int]] | None = None,
            fixed: frozenset = frozenset()) -> str:
    """The main text of a page by its host's template (element rules alone without one)."""
    if not html:
        return ""
    page = list(tokens(html))
    slots = main_slots(root) if root else None
    slot_of = _slots(page, root, nested or []) if slots else None
    if slot_of is not None:
        wanted = [slot in slots for slot in slot_of]
    else:
        has_main = any(node is not None and node.name in MAIN for token, node, text in page if not text)
        wanted = [not has_main or node is not None and node.main for _, node, _ in page]
    out: list[str] = []
    block: list[str] = []

    def close():
        text = " ".join(unescape("".join(block)).split())
        if text:
            out.append(text)
        block.clear()

    for (token, node, text), inside in zip(page, wanted):
        if text:
            if inside and not (node is not None and node.side) and not (
                    fixed and not (node is not None and node.main) and token_key(token, text) in fixed):
                block.append(text)
            continue
        name = token.rpartition("/")[2].partition(".")[0]
        if name == "br":
            block.append(" ")
        elif name in BLOCK:
            close()
    close()
    return "\n\n".join(out)


def _slots(page: list, root: list[tuple[int, int]], nested: list[list[int]]) -> list[int] | None:
    """Slot number of every token: i between the root tokens i and i + 1; None if the page
    does not have the root tokens in the template's order, or a nested class is torn:
    its tokens do not stand equally often in each slot."""
    number = {token: i for i, (token, _) in enumerate(root)}
    of_class = {token: c for c, members in enumerate(nested) for token in members}
    seen: dict = defaultdict(Counter)
    at, out = -1, []
    for token, _, text in page:
        if not text:
            key = token_key(token, "")
            i = number.get(key)
            if i is not None:
                if i != at + 1:
                    return None
                at = i
            elif key in of_class:
                seen[of_class[key], at][key] += 1
        out.append(at)
    if at != len(root) - 1:
        return None
    for (c, _), counts in seen.items():
        if len(counts) != len(nested[c]) or len(set(counts.values())) != 1:
            return None
    return out


def _extracted(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "html", BLOCK_BYTES):
        d = block.select(["html", "root", "nested", "fixed"]).to_pydict()
        texts = []
        held: dict = {}
        for html, root, nested, fixed in zip(d["html"], d["root"], d["nested"], d["fixed"]):
            if root is not None:
                root = [(r["token"], r["main"]) for r in root]
            fixed = frozenset(fixed or ())
            texts.append(extract(html, root, nested, held.setdefault(fixed, fixed)))
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in keep), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])


def main_text(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but the html by default) plus text and n_chars of every row of ``pages``."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars", html)]
    source = pages.select(host_of(F.col(url)).alias("host"), F.col(url).alias("url"), F.col(html).alias("html"))
    known = stored(templates(source), "host-templates")
    rows = pages.select(*keep, F.col(html).alias("_html"), host_of(F.col(url)).alias("_host"))
    joined = lookup_join(rows, known.withColumnRenamed("host", "_host"), ["_host"], bound_rows=20_000)
    joined = joined.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)),
                           F.col("_html").alias("html"), "root", "nested", "fixed")
    names = [f"k{i}" for i in range(len(keep))]
    schema = T.StructType([*(T.StructField(n, pages.schema[c].dataType) for n, c in zip(names, keep)),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return arrow_map(joined, lambda it: _extracted(it, names), schema).toDF(*keep, "text", "n_chars")
