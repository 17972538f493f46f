"""Main text of web pages, with site templates removed.

1. Each page is read once to hash its element subtrees (tag, class, text, children's hashes), within the main content and outside of it,
   and its shells: the tag, class, id and role of elements that stand beside the main content, or whose names say that they aren't text.
2. Spark counts, per host, the pages that hold each hash. Hashes of ``min_pages`` pages or more, and of a share of the host's pages that depends on
   their kind (``SHARES``), are templates; so a host has at most 1 / share times the elements of a page.
3. Each page is read again. Template subtrees are deleted, as are what stands beside the main content in a shell that recurs, and elements with a telling name
   in a shell that recurs. Elements that HTML itself sets apart (scripts, styles, navigation, forms, asides, footers, hidden ones) go too. The rest becomes blocks.
   ``article`` elements are the main content, else ``main``; these and the elements around them are no templates. Inside them only containers that most
   pages of the host share are deleted, and no paragraphs: a passage that many articles quote is text.

Counts say nothing about hosts of fewer than ``min_pages`` pages. There names alone decide, and where a page has main content only that is taken.

Nulls: null html is an empty page, whose text is empty; pages with a null url or one without a host have no host, so names decide. Repeated pages and ids (ties) each
get a row. Only the columns in ``keep`` are passed on, so others can't clash. An empty table gives an empty result; a page may have any length, and is read in a time
that grows with it, however it is broken: tags that never end are text, comments that never end take the rest, a tag whose quotes never close ends at its first ``>``,
end tags of elements that aren't open mean nothing, and elements that are never closed end with the page.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, run_dir, small_batches, stored

#: A hash is a template from this many pages of a host on, and from a share of the host's pages on, by kind, which are a hash's last two bits:
MIN_PAGES = 10
OUTSIDE, INSIDE, BESIDE, NAMED = range(4)
#: containers outside the main content; containers in it, and paragraphs and the like outside of it; shells beside it; shells with a telling name.
SHARES = (0.05, 0.5, 0.5, 0.05)
#: Templates and hosts that are sent to every task at most (16 bytes and a host name each); more are joined by a shuffle.
BROADCAST_TEMPLATES = 50_000

TEXT = re.compile(r"[^<]++")
COMMENT = re.compile(r"<!--(?:.*?-->|.*)", re.S)
WHOLE_TAG = re.compile(r"""<[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
TAG_START = re.compile(r"<[a-zA-Z/!?]")
QUOTE = re.compile(r"[\"']")
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea", "xmp", "noembed", "noframes", "iframe")}

# Element names of HTML by how they are laid out or closed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr li dd dt".split())
SAME_LEVEL = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
# What is never article text.
NOT_TEXT = frozenset("script style head title noscript template iframe object embed svg canvas map nav aside footer form button select option input textarea dialog menu audio video applet frameset search datalist math".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NOT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay sidebar comment comments disqus respond newsletter subscribe subscription signup login share sharing social breadcrumb breadcrumbs menu navbar nav navigation related recommended pagination pager footer masthead widget widgets toolbar skip disclaimer".split())
#: Elements that may be deleted inside the main content.
CONTAINERS = frozenset("div section aside figure details ul ol dl table center".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ZEROS = re.compile(r"&#0+(?=[0-9])")
BEYOND = re.compile(r"&#[0-9]{8,};?")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def decoded(text: str) -> str:
    """Text with its character references replaced; numbers beyond Unicode, however long, stand for U+FFFD."""
    return entities.unescape(BEYOND.sub("\ufffd", ZEROS.sub("&#", text))) if "&" in text else text


def refused(tag: str, attrs: dict[str, str], inside: int) -> bool:
    """Whether HTML itself says that an element isn't article text."""
    if tag in NOT_TEXT or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    return attrs.get("role", "").lower() in NOT_ROLES or "hidden" in attrs or bool(HIDDEN.search(attrs.get("style", "")))


def telling(tag: str, attrs: dict[str, str], inside: int) -> bool:
    """Whether an element's class or id suggests that it isn't article text."""
    if not attrs or tag in ("html", "body", "main"):
        return False
    names = re.split(r"[^a-z0-9]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return not NOT_WORDS.isdisjoint(names) or not inside and "header" in names


def hashed(kind: int, *parts: str) -> int:
    return (xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)) & ~3 | kind


@dataclass(slots=True)
class Open:
    """An open element: the zone it is in (0 body, 1 main, 2 article), whether its text is refused, the blocks and elements of main content before it, the parts of its
    hash, its shell and those of the outermost finished elements in it."""

    name: str
    kind: str = ""
    zone: int = 0
    no: bool = False
    before: int = 0
    mains: int = 0
    shell: int = 0
    parts: deque[str] = field(default_factory=deque)
    beside: list[int] = field(default_factory=list)


class Page:
    """One pass over a page. ``blocks``: [zone, text, whether in a recurring shell beside main content]; ``hashes``: what to count.

    With ``templates`` None names decide, as counts say nothing; else what is in ``templates`` goes."""

    def __init__(self, source: str, templates: frozenset[int] | None = frozenset()):
        self.templates, self.hashes = templates, set()
        self.blocks: list[list] = []
        #: Numbers of the blocks that aren't in a recurring shell, and for each name how deep its open elements are, both ascending.
        self.plain: list[int] = []
        self.depths: dict[str, list[int]] = {}
        self.words: list[str] = []
        self.seen = [True, False, False]
        self.mains = 0
        self.open: list[Open] = [Open("")]
        self.last, self.lost = source.rfind(">"), []
        at, n = 0, len(source)
        while at < n:
            if source[at] != "<":
                begin, at = at, TEXT.match(source, at).end()
                self.data(source[begin:at])
            elif source.startswith("<!--", at):
                at = COMMENT.match(source, at).end()
            elif not TAG_START.match(source, at) or at > self.last:
                self.data("<")
                at += 1
            else:
                begin, at = at, self.tag_end(source, at)
                if t := TAG.match(source, begin, at):
                    name = t[1].lower()
                    if source[begin + 1] == "/":
                        self.close(name)
                        continue
                    self.start(name, source[t.end() : at - 1])
                    if raw := RAW.get(name):
                        e = raw.search(source, at)
                        if name in ("xmp",):
                            self.data(source[at : e.start() if e else n])
                        at = e.start() if e else n
        self.pop(1)
        self.flush()
        if self.mains:
            self.hashes.update(self.open[0].beside)

    def tag_end(self, source: str, at: int) -> int:
        """Where the tag at ``at`` ends: after its first ``>`` outside quotes, else, where there is none, after its first ``>``.

        ``lost`` are searches that came to the end of the page, each as a place and the quote that is open there. One that is outside quotes at ``at`` has seen what a new search would
        see. A quote moves searches between the three states without ever joining two, so there are at most three of them."""
        for x in self.lost:
            for q in QUOTE.findall(source, x[0], at):
                x[1] = q if not x[1] else "" if x[1] == q else x[1]
            x[0] = at
        if all(quote for _, quote in self.lost):
            if m := WHOLE_TAG.match(source, at):
                return m.end()
            self.lost.append([at, ""])
        return source.index(">", at) + 1

    def data(self, text: str) -> None:
        if not self.open[-1].no:
            self.words.append(decoded(text))
        if self.templates is not None:
            self.open[-1].parts.append(text)

    def flush(self) -> None:
        if self.words:
            if text := " ".join("".join(self.words).split()):
                self.plain.append(len(self.blocks))
                self.blocks.append([self.open[-1].zone, text, False])
            self.words = []

    def start(self, name: str, rest: str) -> None:
        if name in CLOSES_P:
            self.until({"p"}, {"button", "td", "th", "li", "div", "article", "section", "main", "aside", "blockquote", "body"})
        if name in SAME_LEVEL:
            self.until(*SAME_LEVEL[name])
        if name == "br":
            self.data(" ")
            return
        if name in BLOCK:
            self.flush()
        if name in VOID:
            return
        attrs = {a.lower(): decoded(x or y or z or "") for a, x, y, z in ATTRIBUTE.findall(rest)} if "=" in rest or "hidden" in rest else {}
        zone = self.open[-1].zone
        shell = (name, *sorted(attrs.get("class", "").split()), attrs.get("id", ""), attrs.get("role", ""))
        no = self.open[-1].no or refused(name, attrs, zone)
        if not no and telling(name, attrs, zone):
            no = self.templates is None or (h := hashed(NAMED, *shell)) in self.templates
            if not no:
                self.hashes.add(h)
        if not no:
            zone = max(zone, 2 if name == "article" else 1 if name == "main" or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody" else 0)
            self.seen[zone] = True
        self.open.append(Open(name, attrs.get("class", ""), zone, no, len(self.blocks), self.mains, 0 if zone or self.templates is None else hashed(BESIDE, *shell)))
        self.depths.setdefault(name, []).append(len(self.open) - 1)
        self.mains += zone > 0

    def close(self, name: str) -> None:
        if depths := self.depths.get(name):
            self.pop(depths[-1])
        elif name == "p":
            self.flush()

    def until(self, names: set[str], border: set[str]) -> None:
        """Close the outermost open element of ``names`` that is above any of ``border``."""
        there = [x for name in names if (x := self.depths.get(name))]
        if there:
            edge = max((x[-1] for name in border - names if (x := self.depths.get(name))), default=0)
            if found := [x[k] for x in there if (k := bisect_right(x, edge)) < len(x)]:
                self.pop(min(found))

    def pop(self, depth: int) -> None:
        while len(self.open) > depth:
            x = self.open[-1]
            if x.name in BLOCK:
                self.flush()
            self.open.pop()
            self.depths[x.name].pop()
            if self.templates is None:
                continue
            over = self.open[-1]
            if not x.zone and self.mains > x.mains:  # around main content: what stands beside it, or in another element around it, stays known
                if len(over.beside) < len(x.beside):  # their order means nothing
                    over.beside, x.beside = x.beside, over.beside
                over.beside += x.beside
                continue
            if x.zone and not over.zone:  # main content itself
                continue
            if x.name not in BLOCK:  # as text of the element around it; the longer of the two is kept
                if len(over.parts) < len(x.parts):
                    over.parts, x.parts = x.parts, over.parts
                    over.parts.extendleft(reversed(x.parts))
                else:
                    over.parts.extend(x.parts)
                continue
            content = " ".join("".join(x.parts).split())
            kind = OUTSIDE if not x.zone and x.name in CONTAINERS else INSIDE
            h = hashed(kind, x.name, x.kind, content)
            over.parts.append(f"<{h}>")
            if not content or x.zone and x.name not in CONTAINERS or x.name in ("html", "body", "article", "main"):
                continue
            self.hashes.add(h)
            if h in self.templates:
                del self.blocks[x.before :]
                self.take(x.before)
            elif not x.zone:
                over.beside.append(x.shell)
                if x.shell in self.templates:
                    for k in self.take(x.before):
                        self.blocks[k][2] = True

    def take(self, before: int) -> list[int]:
        """The numbers in ``plain`` from ``before`` on, which leave it."""
        k = len(self.plain)
        while k and self.plain[k - 1] >= before:
            k -= 1
        out = self.plain[k:]
        del self.plain[k:]
        return out

    def text(self) -> str:
        """Where names decide, the blocks of the main content; else all that no template took, without those beside main content in recurring shells."""
        zone = max(z for z in (0, 1, 2) if self.seen[z]) if self.templates is None else 0
        return "\n\n".join(t for z, t, beside in self.blocks if z >= zone and not (beside and self.mains))


def templates(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """(host, hashes): the templates of each host of ``min_pages`` pages or more."""
    small_batches(pages.sparkSession)
    base = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).filter("host != ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(Page(x.as_py() or "").hashes) for x in b.column(1)], pa.list_(pa.int64()))], ["host", "hashes"])

    found = base.mapInArrow(frugal(run), "host string, hashes array<long>")
    counted = found.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    sizes = base.groupBy("host").agg(F.count("*").alias("all")).filter(F.col("all") >= min_pages)
    share = F.element_at(F.array(*map(F.lit, shares)), (F.col("hash").bitwiseAND(3) + 1).cast("int"))
    kept = counted.join(sizes, "host").filter(F.col("pages") >= share * F.col("all")).groupBy("host").agg(F.collect_list("hash").alias("hashes"))
    return sizes.select("host").join(kept, "host", "left").select("host", F.coalesce("hashes", F.array().cast("array<long>")).alias("hashes"))


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), **limits) -> DataFrame:
    """The columns in ``keep``, and ``text``."""
    spark = pages.sparkSession
    found = stored(templates(pages, url_col=url_col, html_col=html_col, **limits), f"{run_dir(spark, 'templates')}/templates")
    rows = pages.select(*keep, F.col(html_col).alias("_html"), host(F.col(url_col)).alias("_host"))
    n, known = len(keep), None
    if found.agg(F.coalesce(F.sum(F.size("hashes") + 1), F.lit(0))).first()[0] <= BROADCAST_TEMPLATES:
        known = {r["host"]: frozenset(r["hashes"]) for r in found.collect()}
        rows = rows.withColumn("_templates", F.lit(None).cast("array<long>"))
    else:
        rows = rows.join(found.withColumnsRenamed({"host": "_host", "hashes": "_templates"}).hint("merge"), "_host", "left").select(*keep, "_html", "_host", "_templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for b in batches:
            texts = []
            for source, at, array in zip(b.column(n), b.column(n + 1).to_pylist(), b.column(n + 2), strict=True):
                if known is not None:
                    own = known.get(at)
                elif last != at:  # pages of a host come one after the other
                    last, own = at, frozenset(array.as_py()) if array.is_valid else None
                texts.append(Page(source.as_py() or "", own).text())
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(texts, pa.string())], [*keep, "text"])

    return rows.mapInArrow(frugal(run), T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType(), False)]))
