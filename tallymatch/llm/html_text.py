"""Main text of web pages by equivalence classes of template tokens.

A token is an element with its place in the page (the path of elements, with classes).  Its
occurrence vector says how often each page of a host has it.  Tokens of one host with equal
vectors form an equivalence class: they were written by one piece of the template.  A class
is valid if it nests: outside the class its elements have one parent, in one other class or at the
root.  Valid classes, nested into each other, are the template; what stands between their tokens
are slots.  Slots that hold the same text on every page, mostly links, or that lie in menus, headers,
footers, sidebars, notices, adverts, forms, scripts or comments are furniture; the slots left
are extracted, in page order.  The template judges articles (and main elements) like the rest of a
page, but for links, as headlines of articles are often links.  Where anything is left of a page's
articles, what stands outside of them is furniture too.

Paragraphs of one parent are one token, so its first and its last text are slots of their own: a
licence or a call to subscribe in a plain paragraph is the same at the end of every article.

Names (classes, ids, roles) tell furniture only if all their words do: ``site-header``, but not
``entry-header`` or ``has-sidebar``.  Never judged by names are html, body, main, articles and headings,
nor what holds an article, unless the page has another article in no furniture (cards of
articles in a list of related ones).  A form that holds an article, a headline or all text of the page
is no furniture.

Vectors are compared by a 64-bit fingerprint that is summed up over the pages, so a host that
holds a third of all pages is aggregated before anything is shuffled.  A template has a row for each
role of a host: few, unless ids or classes differ from page to page.

A page is parsed twice, for the vectors and for its text, which costs less than to store or shuffle
what the first pass finds.

Defined cases: a null or empty page has the empty text; a page without elements is one
block of text; a null url is a host of its own; a host with fewer than ``PAGES`` pages is judged by
names and structure alone; repeated rows are extracted each for itself; a slot is only called the
same on all pages if at least ``PAGES`` pages of different texts have it, so copies of a page are
no evidence of a template; an empty table gives an empty one; only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, ship, stored, table

#: Fixed names of HTML: elements without an end, with raw text, and inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|object|canvas|annotation|annotation-xml"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br img "
    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that end an open paragraph, and those that end an open one of their kind.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_OWN = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
FURNITURE_TAGS = frozenset("head nav footer aside form button select dialog menu".split())
#: Words of names that tell furniture, and words that may stand beside them.
WORDS_OF_FURNITURE = (
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?|"
    r"header|masthead|footer|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|"
    r"login|search|share|sharing|social|related|recommend\w*|widgets?|comments?|disqus|replies|respond|pager|"
    r"pagination|toolbar|skip|copyright|legal)"
)
BESIDE = (
    r"(?:site|global|top|bottom|left|right|main|primary|secondary|sub|mobile|desktop|sticky|fixed|the|wp|js|"
    r"area|bar|block|box|button|buttons|col|column|container|form|group|icon|icons|inner|item|items|link|links|list|"
    r"panel|section|slot|unit|wrap|wrapper|articles|posts|stories|\d+)"
)
FURNITURE = re.compile(
    rf"(?:{BESIDE}[-_]+)*{WORDS_OF_FURNITURE}(?:[-_]+(?:{BESIDE}|{WORDS_OF_FURNITURE}))*", re.IGNORECASE
)
HEADER = re.compile(rf"(?:{BESIDE}[-_]+)*header(?:[-_]+{BESIDE})*", re.IGNORECASE)
UNNAMED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: Elements that a form holds only if it is there for the whole page.
WHOLE = frozenset("article main h1 header nav".split())
ARTICLE = frozenset(("article", "main"))
PAGES = 3
LINKS = 0.5

#: Attributes up to a slash that is not part of a value.
ATTRIBUTES = r"(?:\s+[^\s=>\"'/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+(?=\s)))?)*\s*"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<closed>" + RAW + r")" + ATTRIBUTES + r"/>(?![^<]*</(?P=closed)[\s>])"
    r"|<(?P<raw>" + RAW + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?](?:[^>]*)>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

#: Distinct pages are counted by so many masks of 64 bits: never too many, and three pages are taken
#: for fewer with a chance of 2 in 10^11.
MASKS = 8

ROLES = (
    "host string, page_id long, role string, n int, chars long, link_chars long, text_hash long, "
    "first_hash long, last_hash long, page_hash long"
)
TEXT = "page_id long, url string, text string"

#: Behind a role: its first, or its last text on a page.
FIRST, LAST = "\n^", "\n$"
PARTS = (("first", FIRST), ("last", LAST))


def _label(tag: str, rest: str) -> tuple[str, str]:
    """How an element is written in a path, and what makes it furniture: its ``tag``, its ``name``, a ``header``."""
    names = []
    if rest and "=" in rest:
        for m in NAMED.finditer(rest):
            names += (m[2] or m[3] or m[4] or "").split()
    label = ".".join([tag, *(re.sub(r"\d+", "0", n) for n in names)])
    if tag in FURNITURE_TAGS:
        return label, "tag"
    found = () if tag in UNNAMED else [n for n in names if FURNITURE.fullmatch(n)]
    if any(not HEADER.fullmatch(n) for n in found):
        return label, "name"
    return label, "header" if found or tag == "header" else ""


class Element:
    """``why``: what makes it furniture; ``outer``: the element around it that is no inline one."""

    __slots__ = ("tag", "role", "why", "link", "outer", "holds", "whole", "chars", "kind")

    def __init__(self, tag: str, role: str, why: str, link: bool, outer: Element | None):
        self.tag, self.role, self.why, self.link, self.outer = tag, role, why, link, outer
        self.holds = self.whole = False
        self.chars, self.kind = 0, ""


def _kinds(elements: list[Element]) -> None:
    for e in elements:
        outer = e.outer.kind if e.outer else "plain"
        named = e.why == "name" or (e.why == "header" and outer != "article")
        if outer == "furniture" or (e.why == "tag" and not e.whole) or (named and not e.holds):
            e.kind = "furniture"
        else:
            e.kind = "article" if outer == "article" or e.tag in ARTICLE else "plain"


def _judge(elements: list[Element]) -> None:
    """Sets the kind of all elements, given in page order; a few passes, whatever the depth."""
    holds: set[Element] = set()
    wraps: set[Element] = set()
    for e in reversed(elements[1:]):
        if e.tag in ARTICLE or e in holds:
            holds.add(e.outer)
        if e.tag in WHOLE or e in wraps:
            wraps.add(e.outer)
    forms = [e for e in elements if e.tag == "form"]
    for e in forms:
        e.whole = e in wraps
    clear: set[Element] = set()  # those around which nothing is furniture by its tag or names
    for e in elements:
        if e.outer is None or (e.outer in clear and (not e.outer.why or e.outer.whole)):
            clear.add(e)
    if not any(e.tag in ARTICLE and e in clear for e in elements):
        for e in holds:
            e.holds = True
    if any(not e.whole for e in forms):  # does all text that is no furniture lie in one of them?
        whole = [e for e in forms if not e.whole]
        for e in whole:
            e.whole = True
        _kinds(elements)
        said = {e: e.chars if e.kind != "furniture" else 0 for e in elements}
        for e in reversed(elements[1:]):
            said[e.outer] += said[e]
        for e in whole:
            e.whole = 0 < said[e] == said[elements[0]]
    _kinds(elements)


def blocks(page: str) -> Iterator[tuple[str, str, str, int] | tuple[str, str, None, int]]:
    """(role, kind, text, characters in links) of every block, and (role, kind, None, 0) of every element.

    kind: ``article`` inside an article, ``furniture`` by tags and names, else ``plain``.
    """
    found = _parsed(page)
    root = found[0][0]
    _judge([e for e, text, _ in found if text is None])
    return ((e.role, e.kind, text, linked) for e, text, linked in found if e is not root or text is not None)


def _parsed(page: str) -> list[tuple[Element, str | None, int]]:
    """Elements, the root first, and blocks with the element that holds them."""
    root = Element("", "", "", False, None)
    stack = [root]
    found: list[tuple[Element, str | None, int]] = [(root, None, 0)]
    text: list[str] = []
    links = 0
    labels: dict[tuple[str, str], tuple[str, str]] = {}

    def block() -> None:
        nonlocal links
        if not text:
            return
        joined, linked = " ".join(entities.unescape("".join(text)).split()), links
        text.clear()
        links = 0
        if joined:
            holder = next(e for e in reversed(stack) if e.tag not in INLINE)
            holder.chars += len(joined)
            found.append((holder, joined, linked))

    def close(until: int) -> None:
        if any(e.tag not in INLINE for e in stack[until:]):
            block()
        del stack[until:]

    for m in TOKEN.finditer(page):
        chars = m["text"]
        if chars is not None:
            text.append(chars)
            if stack[-1].link:
                links += len(chars)
            continue
        tag = m["tag"]
        if tag is None:
            continue  # a comment, a declaration, or an element with raw text
        tag = tag.lower()
        if m["end"]:
            at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if at:
                close(at)
            continue
        if tag in INLINE:
            if tag == "br" or tag == "img":
                text.append(" ")
            elif not m["rest"].endswith("/"):
                top = stack[-1]
                stack.append(Element(tag, top.role, "", top.link or tag == "a", None))
            continue
        ends = ENDS_OWN.get(tag, ()) or ("p",) if tag in ENDS_P or tag in ENDS_OWN else ()
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ends:
                close(k)
                break
            if stack[k].tag not in INLINE and stack[k].tag not in ("p", "tr", "td", "th"):
                break
        block()
        key = (tag, m["rest"])
        if key not in labels:
            labels[key] = _label(tag, m["rest"])
        label, why = labels[key]
        parent = next(e for e in reversed(stack) if e.tag not in INLINE)
        element = Element(tag, f"{parent.role}/{label}", why, parent.link, parent)
        found.append((element, None, 0))
        if tag not in VOID and not m["rest"].endswith("/"):
            stack.append(element)
    block()
    return found


def _digest(texts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) - (1 << 63)


def roles_of(pages: DataFrame) -> DataFrame:
    """For each page, how often each token occurs, the texts of its slot, and those of the whole page."""
    ship(pages.sparkSession)
    schema = ROLES.replace("role string,", "role string, kind string,")
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                rows = []
                for row in batch.slice(low, 200).to_pylist():
                    seen: dict[tuple[str, str], list] = {}
                    said: dict[str, list[str]] = {}
                    for role, kind, text, linked in blocks(row["html"] or ""):
                        entry = seen.setdefault((role, kind), [0, 0, 0, []])
                        if text is None:
                            entry[0] += 1
                        else:
                            entry[1] += len(text)
                            entry[2] += linked
                            entry[3].append(text)
                            said.setdefault(kind, []).append(text)
                    # What tells pages apart is their longer part: copies differ in dates and adverts.
                    inside, outside = said.get("article", []), said.get("plain", [])
                    whole = _digest(inside if sum(map(len, inside)) >= sum(map(len, outside)) else outside)
                    for (role, kind), (n, chars, linked, texts) in seen.items():
                        parts = (texts, texts[:1], texts[-1:]) if len(texts) > 1 else (texts,) * 3
                        hashes = [_digest(part) for part in parts] if texts else [None] * 3
                        rows.append((row["host"], row["page_id"], role, kind, n, chars, linked, *hashes, whole))
                columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                    names=re.findall(r"(\w+) \w+(?:, |$)", schema),
                )

    return pages.select("host", "page_id", "html").mapInArrow(run, schema)


def templates(pages: DataFrame, folder: str) -> DataFrame:
    """(host, role, kind, class, parent_class, valid, furniture, first, last) of every token of every host.

    ``class`` is the fingerprint of the occurrence vector, ``parent_class`` that of the class a token's
    class lies in.  ``first`` and ``last``: these texts of the token are furniture, whatever the others are.
    """
    tokens = stored(
        roles_of(pages)
        .groupBy("host", "role", "kind")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("n").alias("n"),
            # Equal for tokens with the same number of occurrences on every page.  Hashes of 44
            # bits with sign, so that their sum fits a long for any number of pages there is.
            F.expr("sum(shiftright(xxhash64(page_id, n), 20))").alias("class"),
            F.sum("chars").alias("chars"),
            F.sum("link_chars").alias("link_chars"),
            F.count("text_hash").alias("texts"),
            *(
                f(f"{part}_hash").alias(f"{name}_{part}")
                for part in ("text", "first", "last")
                for name, f in (("least", F.min), ("most", F.max))
            ),
            F.greatest(
                *(
                    F.expr(f"bit_count(bit_or(shiftleft(1L, cast(shiftright(page_hash, {6 * k}) & 63 as int))))")
                    for k in range(MASKS)
                )
            ).alias("distinct"),
        )
        .withColumn("parent", F.expr("regexp_replace(role, '/[^/]*$', '')")),
        f"{folder}/tokens",
    )
    parents = tokens.groupBy("host", F.col("role").alias("parent")).agg(F.min("class").alias("owner"))
    owned = stored(
        tokens.join(parents, ["host", "parent"], "left").withColumn("outside", ~F.col("owner").eqNullSafe(F.col("class"))),
        f"{folder}/owned",
    )
    classes = stored(
        owned.groupBy("host", "class").agg(
            F.count(F.lit(1)).alias("members"),
            F.min(F.when(F.col("outside"), F.coalesce("owner", F.lit(0)))).alias("parent_class"),
            (
                F.coalesce(F.min(F.when(F.col("outside"), F.coalesce("owner", F.lit(0)))), F.lit(0))
                == F.coalesce(F.max(F.when(F.col("outside"), F.coalesce("owner", F.lit(0)))), F.lit(0))
            ).alias("valid"),
        ),
        f"{folder}/classes",
    )
    # Where all pages have one text in a slot, pages of different texts differ in the rest.  It belongs to
    # the template where its token is part of a valid class.
    settled = (F.col("distinct") >= PAGES) & (F.col("texts") == F.col("pages")) & F.col("valid")
    constant, first, last = (
        settled & (F.col("kind") != "furniture") & (F.col(f"least_{part}") == F.col(f"most_{part}"))
        for part in ("text", "first", "last")
    )
    linked = (F.col("chars") > 0) & (F.col("link_chars") > LINKS * F.col("chars"))
    plain = F.col("kind") == "plain"
    return owned.join(classes, ["host", "class"]).select(
        "host",
        "role",
        "kind",
        "class",
        "parent_class",
        "members",
        "valid",
        "pages",
        "chars",
        ((F.col("kind") == "furniture") | constant | (plain & linked)).alias("furniture"),
        first.alias("first"),
        last.alias("last"),
    )


def slots_of(template: DataFrame) -> DataFrame:
    """For each host, the roles outside of furniture that are dropped on its pages, whole or in part."""
    role = F.col("role")
    whole = F.when(F.col("furniture"), role)
    parts = [F.when(~F.col("furniture") & F.col(name), F.concat(role, F.lit(mark))) for name, mark in PARTS]
    return (
        template.where((F.col("kind") != "furniture") & (F.col("chars") > 0))
        .select("host", F.explode(F.array_compact(F.array(whole, *parts))).alias("slot"))
        .groupBy("host")
        .agg(F.collect_set("slot").alias("dropped"))
    )


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", "html").withColumn("host", host)


def main_text(page: str, dropped: set[str]) -> str:
    """The blocks of a page that are not furniture, joined by line breaks."""
    found = [b for b in blocks(page) if b[2] is not None and b[1] != "furniture"]
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for k, (role, *_) in enumerate(found):
        first.setdefault(role, k)
        last[role] = k
    kept = [
        (kind, text)
        for k, (role, kind, text, _) in enumerate(found)
        if role not in dropped
        and not (first[role] == k and role + FIRST in dropped)
        and not (last[role] == k and role + LAST in dropped)
    ]
    wanted = "article" if any(kind == "article" for kind, _ in kept) else "plain"
    return "\n".join(text for kind, text in kept if kind == wanted)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    spark = pages.sparkSession
    folder = fresh_folder(spark)
    hosted = with_host(pages)
    slots = stored(slots_of(templates(hosted, folder)), f"{folder}/slots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                rows = part.select(["html", "dropped"]).to_pylist()
                texts = [main_text(r["html"] or "", set(r["dropped"] or ())) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, type=pa.string())],
                    names=["page_id", "url", "text"],
                )

    # Hosts are matched to their slots: few where names of elements are, but not bounded.  A host with a third of all pages is split by adaptive execution.
    return hosted.join(slots, "host", "left").select("page_id", "url", "html", "dropped").mapInArrow(run, TEXT)


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of all pages."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op10_html_text": html_text}
SQL: dict[str, str] = {}
