"""Main text of web pages by a site style tree.

Pages of one host are merged into a tree of style nodes, a node being the path of block elements with
their classes.  Over the pages that hold a node, the entropy of its child sequences (presentation) and
of its texts (content) give its importance; branches of low importance are cut from each page.  Fixed
element and class names mark what no main text is made of, so a host with one page is cleaned as well.  A name
counts as a whole token (``with-sidebar`` is not ``sidebar``; a number at its end is dropped) and never marks the
page, its article or a heading; about doubtful names the tree decides.

The counts per (host, node, value) are pre-aggregated before any shuffle.  A node is cut if its importance is
low while the pages around it differ: the longest text of a page outside the node has an entropy of at least
``AROUND`` over the node's pages.  So a branch of a copied article stays, whatever its tags and the size of
the host.  The cut nodes meet the distinct pages by (host, node), salted, and each page gets its own list.

Defined cases: null or empty html gives an empty text; a null url is a host of its own; repeated rows
give repeated results; unclosed elements end with their parent; article and main are never cut; a node on
fewer than ``MIN_PAGES`` pages is no evidence and stays; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.sources.scratch import materialised

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_NUMBER = re.compile(r"[-_]*[0-9]+\Z")

BLOCKS = frozenset(
    "address article aside blockquote body br button center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html iframe li main menu nav noscript ol option p pre script section select style summary "
    "svg table tbody td template textarea tfoot th thead title tr ul video audio canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
NOISE_TAGS = frozenset(
    "aside audio button canvas dialog fieldset footer form head header iframe menu nav noscript object option script select style "
    "svg template textarea title video".split())
NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header menu "
    "modal nav navbar navigation newsletter notice notices popup promo related share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split())
ROOTS = frozenset(("article", "main"))
#: no name makes these noise
NEVER_BY_NAME = ROOTS | frozenset("html body h1 h2 h3 h4 h5 h6".split())
CLOSES = {"p": ("p",), "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
SCOPES = frozenset("article section div ul ol table dl main body html blockquote nav aside footer header form".split())

MIN_PAGES, LOW, AROUND, CONTENT_WEIGHT, SALTS = 10, 0.1, 0.5, 0.9, 16


@dataclass
class Node:
    tag: str
    path: str
    noise: bool
    root: bool
    children: list[str] = field(default_factory=list)


def host_of(column) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(column, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def parse(html: str | None) -> tuple[list[Node], list[tuple[list[Node], str]]]:
    """The block nodes of a page, and its pieces of text with the chain of nodes that hold each."""
    html = html or ""
    top = Node("", "", False, False)
    nodes, stack, pieces, at = [top], [top], [], 0

    def text(upto: int) -> None:
        if upto > at:
            pieces.append((list(stack), entities.unescape(html[at:upto])))

    while found := _TOKEN.search(html, at):
        text(found.start())
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                    if tag == "p" and stack[i].tag in SCOPES:
                        break
                pieces.append((list(stack), " "))
            continue
        names: set[str] = set()
        noisy = False
        for name in _NAMES.findall(found[3]):
            value = "".join(name).lower()
            names.update(_SPLIT.split(value))
            noisy = noisy or tag not in NEVER_BY_NAME and any(_NUMBER.sub("", token) in NOISE_NAMES for token in value.split())
        names.discard("")
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            pieces.append((list(stack), " "))
            continue
        if tag not in BLOCKS and not noisy:
            continue
        if tag in VOID:
            pieces.append((list(stack), " "))
            continue
        closes = CLOSES.get(tag, ("p",) if tag in BLOCKS else ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closes:
                del stack[i:]
                break
            if stack[i].tag in SCOPES:
                break
        above = stack[-1]
        style = tag + "".join(f".{n}" for n in sorted(names))
        above.children.append(style)
        node = Node(tag, f"{above.path}/{style}", tag in NOISE_TAGS or noisy, tag in ROOTS)
        nodes.append(node)
        if tag in BLOCKS:
            pieces.append((list(stack), " "))
            stack.append(node)
        else:  # an inline element with a telling name holds text up to its own end tag
            end = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, at)
            at = end.end() if end else at
    text(len(html))
    return nodes, pieces


def main_text(html: str | None, cut: frozenset[str] = frozenset()) -> str:
    """The text of the article when the page marks one, else of the whole body, without cut branches."""
    nodes, pieces = parse(html)
    inside = any(n.root and not n.noise for n in nodes)

    def kept(chain: list[Node], cut: frozenset[str]) -> bool:
        if any(n.noise for n in chain) or inside and not any(n.root for n in chain):
            return False
        return not any(n.path in cut and not n.root for n in chain)

    out = " ".join("".join(t if kept(c, cut) else " " for c, t in pieces).split())
    if not out and cut:  # the whole page repeats across its site: only the fixed names count
        out = " ".join("".join(t if kept(c, frozenset()) else " " for c, t in pieces).split())
    return out


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")) >> 1


def _values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, html in zip(batch["host"], batch["html"], strict=True):
            nodes, pieces = parse(html)
            texts: dict[str, list[str]] = {}
            shape: dict[str, list[str]] = {}
            for node in nodes:
                if not node.noise:
                    shape.setdefault(node.path, []).append(" ".join(node.children))
            for chain, piece in pieces:
                for node in chain:
                    if node.path in shape:
                        texts.setdefault(node.path, []).append(piece)
            longest = sorted(((" ".join(t.split()), {n.path for n in c}) for c, t in pieces if not t.isspace() and not any(n.noise for n in c)), key=lambda x: (-len(x[0]), x[0]))
            for path, children in shape.items():
                content = " ".join("".join(texts.get(path, ())).split())
                around = next((t for t, paths in longest if path not in paths), "")
                for kind, value in ((0, "|".join(children)), (1, content), (2, around)):
                    rows.append((host, path, kind, _hash(value)))
        yield pd.DataFrame(rows, columns=["host", "path", "kind", "value"])


def _held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, page, html in zip(batch["host"], batch["page"], batch["html"], strict=True):
            rows += [(host, page, _hash(path)) for path in {n.path for n in parse(html)[0] if not n.noise}]
        yield pd.DataFrame(rows, columns=["host", "page", "node"])


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, path, pages, presentation, content, around, importance: the merged tree with its entropies in [0, 1]."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).mapInPandas(_values, "host string, path string, kind int, value long")
    counted = rows.groupBy("host", "path", "kind", "value").agg(F.count("*").cast("double").alias("n"))
    entropy = counted.groupBy("host", "path", "kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("s")).select(
        "host", "path", "kind", "n", F.when(F.col("n") > 1, 1 - F.col("s") / (F.col("n") * F.log("n"))).otherwise(1.0).alias("h"))
    tree = entropy.groupBy("host", "path").agg(
        F.max("n").alias("pages"), F.max(F.when(F.col("kind") == 0, F.col("h"))).alias("presentation"), F.max(F.when(F.col("kind") == 1, F.col("h"))).alias("content"),
        F.max(F.when(F.col("kind") == 2, F.col("h"))).alias("around"))
    return tree.withColumn("importance", (1 - CONTENT_WEIGHT) * F.col("presentation") + CONTENT_WEIGHT * F.col("content"))


def cut_nodes(tree: DataFrame) -> DataFrame:
    """host, path: the style nodes of low importance on pages that differ around them."""
    return tree.where((F.col("path") != "") & (F.col("importance") < LOW) & (F.col("around") >= AROUND) & (F.col("pages") >= MIN_PAGES)).select("host", "path")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url and the main text, one row per page."""
    node_id = F.udf(_hash, "long")
    low = materialised(cut_nodes(style_tree(pages, url, html)).withColumn("node", node_id("path")), "cut-nodes")  # its written size decides how it joins
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.md5(html).alias("page"), F.col(html).alias("html"))
    held = rows.select("host", "page", "html").mapInPandas(_held, "host string, page string, node long").distinct()
    salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = held.withColumn("salt", F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int"))
    cut = held.join(salted, ["host", "node", "salt"]).groupBy("host", "page").agg(F.collect_list("path").alias("cut"))  # at most the nodes of one page

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, frozenset(c) if c is not None else frozenset()) for h, c in zip(htmls, cuts, strict=True)], dtype=object)

    return rows.join(cut, ["host", "page"], "left").select(key, "url", text_of("html", "cut").alias("text"))


@query("op1_site_style_tree")
def op1(spark, folder):
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))
