"""Main text of web pages by deduced templates (operator 2).

Pages of a host come from a template. A page is read once, as its elements, known by their paths of tags and classes,
and its text blocks, known by path and text. Both are tokens; a token's occurrence vector is how often each page of the
host has it, and tokens of equal vectors make an equivalence class. A vector is carried as a sum of hashes of
(page, count), which partial sums build before anything is shuffled, so a host with very many pages is no group that
must meet in a task. Classes of enough pages and tokens are valid: their tokens are the host's template, and text blocks
of it on half of the host's pages are fixed text.

Template elements nest by their paths. The main slot is the innermost one, if any below the body, that holds
``SLOT_SHARE`` of the host's free text, which is neither fixed nor in an element that is rejected. A page's text is what its slots hold, in page order:
all of the main slot, so that copies of an article within a host stay whole, and free text of the other slots. Names
only reject: menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments, by element, role and class
words; and, where articles or main elements hold most of a host's free text, what lies outside them. A host with too few
pages for a class has no template; there, in pages without a host, and in those without the main slot, names alone decide.

Defined results: null and empty pages have an empty text; very long pages are read whole, one to a batch if need be, and
elements nested more than ``DEPTH`` deep share the path at that depth; every row gets one row, repeated rows alike; of
slots as deep as each other none can tie, as one alone holds such a share; an empty table gives an empty result; null
ids and urls are kept. Columns beyond id, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table
from pairloom.llm.url_filter import parsed

#: Pages and tokens that a valid class needs at least.
SUPPORT, CLASS_SIZE = 3, 2
#: Share of a host's pages from which on a template's text is fixed; of its free text that the main slot holds; and that articles hold where what is outside is rejected.
FIXED_SHARE, SLOT_SHARE, ARTICLE_SHARE = 0.5, 0.9, 0.5
#: Elements in a path.
DEPTH = 64
#: Hosts up to which their table, some 40 bytes each, is broadcast; beyond, pages are joined by host.
BROADCAST_HOSTS = 500_000
#: Path and token of a page as such.
PAGE = 1

# Element names and class words.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td template tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp svg math".split())
CLOSED_BY_BLOCK = frozenset("p b i em strong span a u s small font code mark sub sup".split())
DROPPED = frozenset("nav footer aside form script style noscript template button select textarea iframe svg math head menu dialog search object canvas audio video input option xmp noembed noframes".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary form search dialog alert alertdialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription comment comments commentlist respond reply replies disqus sidebar sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs"
    " masthead footer share sharing social related recommended recommendations toolbar pagination pager login signup search form".split()
)
#: What a class name that says something of an element's surroundings starts with.
MODIFIERS = ("has-", "with-", "no-", "without-")
HEADER_WORDS = frozenset("header topbar site-header".split())
MAIN = frozenset(["article", "main"])
ROOTS = frozenset(["html", "body"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|iframe|noembed|noframes|xmp|svg|math)(?P<rawattrs>(?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)?)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z0-9]+")


#: Elements that a worker remembers.
KNOWN_ELEMENTS = 20_000
_ALL = (1 << 64) - 1


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


class Element:
    __slots__ = ("chain", "dropped", "main", "node", "tag")

    def __init__(self, tag: str, attrs: str, above: Element | None) -> None:
        from xxhash import xxh64_intdigest

        named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)} if "=" in attrs else {}
        names = [n for n in f"{named.get('class', '')} {named.get('id', '')}".split() if not n.startswith(MODIFIERS)]
        # an article, or what stands in a sentence, is rejected by a whole name only: compound ones say what it is about
        words = set(names if tag == "article" or tag not in BLOCKS else _WORD.findall(" ".join(names)))
        inside = above is not None and above.main
        root = tag in ROOTS or tag == "main"
        self.tag = tag
        chain = above.chain if above is not None else (PAGE,)
        if len(chain) < DEPTH:
            chain = (*chain, _signed(xxh64_intdigest(" ".join([tag, *sorted(set(named.get("class", "").split()))]), chain[-1] & _ALL)))
        self.chain, self.node = chain, chain[-1]
        unwanted = tag in DROPPED or named.get("role") in DROPPED_ROLES or (not root and bool(words & DROPPED_WORDS))
        if not inside and not root and tag != "article" and (tag == "header" or words & HEADER_WORDS):
            unwanted = True
        self.dropped = unwanted or (above is not None and above.dropped)
        self.main = not self.dropped and (inside or tag in MAIN or named.get("role") == "main")


_TOP = Element("", "", None)
_TOP.chain, _TOP.node = (PAGE,), PAGE


class Page:
    """How often each element's path occurs, and the text blocks that aren't rejected with the elements that they are in."""

    def __init__(self, html: str, known: dict[tuple, Element] | None = None) -> None:
        self.elements: Counter[int] = Counter()
        self.roots: set[int] = set()
        self.blocks: list[tuple[Element, str]] = []
        known = {} if known is None else known
        stack: list[Element] = []
        parts: list[str] = []
        at = 0

        def end_block() -> None:
            if stack and stack[-1].dropped:
                parts.clear()
                return
            text = " ".join(unescape("".join(parts)).split())
            if text:
                self.blocks.append((stack[-1] if stack else _TOP, text))
            parts.clear()

        def opened(tag: str, attrs: str) -> Element:
            above = stack[-1] if stack else None
            key = (tag, attrs, above.chain, above.dropped, above.main) if above is not None else (tag, attrs)
            element = known.get(key)
            if element is None:
                if len(known) >= KNOWN_ELEMENTS:
                    known.clear()
                element = known[key] = Element(tag, attrs, above)
            self.elements[element.node] += 1
            if tag in ROOTS:
                self.roots.add(element.node)
            return element

        for m in _TOKEN.finditer(html):
            if m.start() > at:
                parts.append(html[at : m.start()])
            at = m.end()
            if m["raw"]:
                opened(m["raw"].lower(), m["rawattrs"] or "")
                continue
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            changes = tag in BLOCKS
            if changes:
                end_block()
            if m["close"]:
                at_open = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
                if at_open is not None:
                    if not changes and any(e.dropped != stack[-1].dropped or e.main != stack[-1].main for e in stack[max(0, at_open - 1) : at_open]):
                        end_block()
                    del stack[at_open:]
                continue
            if changes and tag not in VOID:
                while stack and stack[-1].tag in CLOSED_BY_BLOCK and not stack[-1].dropped:
                    stack.pop()
            attrs = m["attrs"] or ""
            element = opened(tag, attrs)
            if tag not in VOID and not attrs.endswith("/"):
                if not changes and element.dropped != (stack[-1].dropped if stack else False):
                    end_block()
                stack.append(element)
        parts.append(html[at:])
        end_block()

    def main_text(self) -> str:
        """The text where there is no template: that of articles and main elements, or all if there are none."""
        inside = [t for e, t in self.blocks if e.main]
        return " ".join(inside or [t for _, t in self.blocks])


def text_token(node: int, text: str) -> int:
    """Hash of a text block in an element as a signed long."""
    from xxhash import xxh64_intdigest

    return _signed(xxh64_intdigest(text, node & _ALL))


_BLOCK = pa.struct([("chain", pa.list_(pa.int64())), ("token", pa.int64()), ("main", pa.bool_()), ("text", pa.string())])
_TOKENS = pa.struct([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("chars", pa.int64()), ("article", pa.int64()), ("text", pa.bool_())])  # article: of a text, its characters in articles; of an element, whether it is a root
_PAGE = "blocks array<struct<chain:array<bigint>,token:bigint,main:boolean,text:string>>, tokens array<struct<token:bigint,node:bigint,n:int,chars:bigint,article:bigint,text:boolean>>"


def read_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page, blocks, tokens) for every row; host is null where the url has none."""
    bound_batches(pages.sparkSession)
    host = parsed(F.col("url"))[0]
    ready = distinct_names(pages, "page_id", "url", "html").select("page_id", "url", F.when(host != "", F.xxhash64(host)).alias("host"), F.xxhash64("page_id", "url", "html").alias("page"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, Element] = {}
        for batch in batches:
            blocks, tokens = [], []
            for html in batch.column(4):
                page = Page(html.as_py() or "", known)
                own = [{"chain": e.chain, "token": text_token(e.node, t), "main": e.main, "text": t} for e, t in page.blocks]
                of = {b["token"]: [b["token"], b["chain"][-1], 0, 0, 0, True] for b in own}
                for b in own:
                    o, n = of[b["token"]], len(b["text"])
                    o[2] += 1
                    o[3] += n
                    o[4] += n * b["main"]
                blocks.append(own)
                names = _TOKENS.names
                tokens.append([dict(zip(names, o, strict=True)) for o in [[PAGE, PAGE, 1, 0, 1, False], *([e, e, n, 0, int(e in page.roots), False] for e, n in page.elements.items() if e != PAGE), *of.values()]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(blocks, pa.list_(_BLOCK)), pa.array(tokens, pa.list_(_TOKENS))], names=["page_id", "url", "host", "page", "blocks", "tokens"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return ready.mapInArrow(run, f"page_id {id_type}, url string, host long, page long, {_PAGE}")


def deduced(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of every host with a template (host, slot, in_article, template_tokens), slot null if no element holds enough; and fixed text (host, token)."""
    tokens = read.filter("host IS NOT NULL").select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    seen = tokens.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"), F.first("node").alias("node"), F.sum("chars").alias("chars"), F.sum("article").alias("article"), F.first("text").alias("text")
    )
    seen = cut_lineage(seen)
    common = seen.filter(F.col("pages") >= SUPPORT)
    valid = common.groupBy("host", "vector", "pages").agg(F.count("*").alias("size")).filter(F.col("size") >= CLASS_SIZE)
    template = cut_lineage(common.join(valid.drop("size"), ["host", "vector", "pages"], "left_semi"))
    of_host = seen.filter(F.col("token") == PAGE).select("host", F.col("pages").alias("of"))
    fixed = cut_lineage(template.filter("text").join(of_host, "host").filter(F.col("pages") >= FIXED_SHARE * F.col("of")).select("host", "token"))
    # a text on fewer pages than a class needs is free without a look-up
    free = seen.filter(F.col("text") & (F.col("pages") < SUPPORT)).select("host", "node", "chars", "article")
    free = free.unionByName(common.filter("text").join(fixed, ["host", "token"], "left_anti").select("host", "node", "chars", "article"))
    free = free.groupBy("host", "node").agg(F.sum("chars").alias("chars"), F.sum("article").alias("article"))
    chains = read.filter("host IS NOT NULL").select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: b["chain"]))).alias("chain"))
    chains = chains.groupBy("host", F.element_at("chain", -1).alias("node")).agg(F.first("chain").alias("chain"))
    held = free.join(chains, ["host", "node"]).select("host", "chars", "article", F.posexplode("chain").alias("depth", "node"))
    held = cut_lineage(held.groupBy("host", "node").agg(F.sum("chars").alias("chars"), F.sum("article").alias("article"), F.max("depth").alias("depth")))
    whole = held.filter((F.col("node") == PAGE) & (F.col("chars") > 0)).select("host", F.col("chars").alias("all"), (F.col("article") >= ARTICLE_SHARE * F.col("chars")).alias("in_article"))
    elements = template.filter("NOT text AND article = 0").select("host", F.col("token").alias("node"))
    slots = elements.join(held, ["host", "node"]).join(whole, "host").filter(F.col("chars") >= SLOT_SHARE * F.col("all")).groupBy("host").agg(F.max_by("node", "depth").alias("slot"))
    sizes = template.groupBy("host").agg(F.count("*").cast("int").alias("template_tokens"))
    # where all text is fixed none is taken as such
    return cut_lineage(whole.join(sizes, "host").join(slots, "host", "left").select("host", "slot", "in_article", "template_tokens")), fixed.join(whole.select("host"), "host", "left_semi")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, template_tokens) for every row; template_tokens is the size of the host's template."""
    read = cut_lineage(read_pages(pages))
    hosts, fixed = deduced(read)
    few = hosts.count() <= BROADCAST_HOSTS
    df = read.select("page_id", "url", "host", "page", "blocks").join(F.broadcast(hosts) if few else hosts, "host", "left")
    articles = F.coalesce("in_article", F.lit(True)) & F.exists("blocks", lambda b: b["main"])
    in_slot = lambda b: F.coalesce(F.array_contains(b["chain"], F.col("slot")), F.lit(False))
    df = df.withColumn("_slotted", F.exists("blocks", in_slot)).withColumn("_articles", articles)
    inside: Column = F.coalesce(F.array_contains(F.col("_chain"), F.col("slot")), F.lit(False))
    loose = df.filter((F.col("_slotted") | ~F.col("_articles")) & F.col("template_tokens").isNotNull()).select("page", "host", "slot", F.explode("blocks").alias("b")).select("page", "host", F.col("b.token").alias("token"), F.col("b.chain").alias("_chain"), "slot")
    drops = cut_lineage(loose.filter(~inside).select("page", "host", "token").distinct().join(fixed, ["host", "token"]).groupBy("page").agg(F.collect_set("token").alias("_drops")))
    if drops.isEmpty():
        df = df.withColumn("_drops", F.lit(None).cast("array<bigint>"))
    else:
        df = df.join(drops, "page", "left")
    free = lambda b: in_slot(b) | F.col("_drops").isNull() | ~F.array_contains("_drops", b["token"])
    kept = F.filter("blocks", lambda b: (~F.col("_articles") | b["main"]) & (free(b) | (F.col("_articles") & ~F.col("_slotted"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return df.withColumn("text", text).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.coalesce("template_tokens", F.lit(0)).alias("template_tokens"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(read_table(spark, sf_dir, "pages"))
