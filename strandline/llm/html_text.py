"""Main text of web pages: a style tree of each host weighs branches by entropy, and mark-up says what else is no article."""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Elements that end a block of text, those without content, those whose content is no mark-up.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea xmp svg math object".split())
#: Elements that a start tag closes implicitly, and how far up.
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Elements, roles, and words in class or id that mark what is no article.
NO_ARTICLE = frozenset("head nav footer aside form button select dialog menu".split()) | RAW
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "dropdown footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond responses share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that say where or what kind of part something is, and nothing about its content.
PART_WORDS = frozenset("area bar block bottom box buttons card center container content inline inner item items left link links list panel posts right section slot stories top unit wrapper zone".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Up to so many keys of unimportant branches (8 bytes each) are broadcast; beyond that pages meet them by host and part.
BROADCAST_KEYS, HOST_PARTS = 200_000, 64
#: So many pages of full importance are added to an element's own: at a threshold of 0.1, four equal pages tell.
PRIOR = 0.4
_HEADER_WORDS = frozenset({"header"})
#: Stands among the words of an element of which a whole class or id is such words.
_ONLY = "="
_MARK = frozenset({_ONLY})


class Page:
    """Elements as (parent, tag, words, role, key) and blocks as lists of (element, text).

    key: a hash of the path of tags and names, so that same-named siblings and the same places of other pages merge."""

    def __init__(self, source: str):
        self.elements: list[tuple[int, str, frozenset[str], str, int]] = [(-1, "", frozenset(), "", 0)]
        self.blocks: list[list[tuple[int, str]]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, block, at = [0], [], 0
        elements, blocks = self.elements, self.blocks
        while True:
            found = _TOKEN.search(source, at)
            text = source[at : found.start() if found else len(source)]
            if text:
                block.append((stack[-1], htmllib.unescape(text) if "&" in text else text))
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "br":
                block.append((stack[-1], " "))
                continue
            if tag in BLOCKS and block:
                blocks.append(block)
                block = []
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if elements[stack[k]][1] == tag:
                        del stack[k:]
                        break
                continue
            if tag in BLOCKS:
                self._close(stack, "p", ("table", "td", "li", "div", "article", "section", "main"))
            if tag in CLOSES:
                self._close(stack, *CLOSES[tag])
            words, role, names = frozenset(), "", ""
            if attributes:
                for kind, *values in _NAMES.findall(attributes):
                    value = "".join(values)
                    names += f" {kind.lower()}={value.lower()}"
                    if kind.lower() == "role":
                        role = value.strip().lower()
                    else:
                        for name in value.split():
                            parts = _name_words(name)
                            words |= frozenset(parts)
                            if not NO_ARTICLE_WORDS.isdisjoint(parts) and all(x in NO_ARTICLE_WORDS or x in PART_WORDS or x.isdecimal() for x in parts[:-1]):
                                words |= _MARK
            parent = stack[-1]
            key = xxhash.xxh64_intdigest(f"{elements[parent][4]}/{tag}{names}") >> 1
            elements.append((parent, tag, words, role, key))
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif tag not in VOID:
                stack.append(len(elements) - 1)
        if block:
            blocks.append(block)

    def _close(self, stack: list[int], tags: str, until: tuple[str, ...]) -> None:
        tags = tags.split()
        for k in range(len(stack) - 1, 0, -1):
            tag = self.elements[stack[k]][1]
            if tag in tags:
                del stack[k:]
                return
            if tag in until:
                return

    def under(self, of: set[int]) -> list[bool]:
        """For each element, whether it or an element above it is one of these."""
        out: list[bool] = []
        for k, (parent, *_) in enumerate(self.elements):
            out.append(k in of or parent >= 0 and out[parent])
        return out


def _name_words(name: str) -> list[str]:
    """The words of a class or id, parted by hyphens, underscores or capitals; names that say what a page has or lacks mark
    nothing."""
    words = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower().replace("_", "-").split("-")
    return [] if words[0] in ("has", "with", "no", "without", "is") else [*words, "".join(words)]


def clean(text: str) -> str:
    return " ".join(text.split())


def main_text(page: Page, noise: frozenset[int] = frozenset()) -> str:
    """The blocks of a page that are its article. noise: keys of branches that the host's style tree found unimportant."""
    elements = page.elements
    no_tag = {k for k, e in enumerate(elements) if e[1] in NO_ARTICLE or e[3] in NO_ARTICLE_ROLES}
    gone = page.under(no_tag)
    comment = {"comment", "comments"}
    bodies = {k for k, e in enumerate(elements) if not gone[k] and (e[1] == "article" and not e[2] & comment)}
    bodies = bodies or {k for k, e in enumerate(elements) if not gone[k] and (e[1] == "main" or e[3] == "main")}
    inside = page.under(bodies)
    holds: set[int] = set()
    for k in bodies:
        while k >= 0:
            holds.add(k)
            k = elements[k][0]
    # inside an article a name must say nothing else: "notice", not "related-work"
    named = {k for k, e in enumerate(elements) if k not in holds and e[1] not in ("html", "body") and (_ONLY in e[2] if inside[k] else e[2] & NO_ARTICLE_WORDS or e[1] == "header" or e[2] & _HEADER_WORDS)}
    gone = page.under(no_tag | named)

    def text(gone: list[bool]) -> list[str]:
        kept = (clean("".join(t for k, t in block if not gone[k] and (inside[k] or not bodies))) for block in page.blocks)
        return [x for x in kept if x]

    out = text(gone)
    if noise:
        weak = {k for k, e in enumerate(elements) if e[4] in noise and k not in holds}
        if weak:
            # a branch with most of the page's text is its article, however often it was copied; all of it stays
            size = [0] * len(elements)
            for block in page.blocks:
                for k, t in block:
                    if not gone[k] and (inside[k] or not bodies):
                        size[k] += len(clean(t))
            whole = sum(size)
            for k in range(len(elements) - 1, 0, -1):
                size[elements[k][0]] += size[k]
            spared = page.under({k for k in weak if 2 * size[k] >= whole})
            return "\n".join(text(page.under(no_tag | named | {k for k in weak if not spared[k]})))
    return "\n".join(out)


def _tree_rows(pages: list[tuple[str, str]]) -> list[tuple[str, int, int, int, int, float]]:
    """Sums for the style tree from some pages: (host, element, kind, feature, occurrences, sum of c ln c over pages).

    kind 0: an inner element's sequence of child tags; 1: a leaf's block of text; 2: the pages that have the element, feature
    0; 3: an element at or above it, as feature."""
    count: Counter = Counter()
    logs: Counter = Counter()
    for host, source in pages:
        page = Page(source)
        own: Counter = Counter()
        children: dict[int, list[str]] = {}
        for parent, tag, *_ in page.elements[1:]:
            children.setdefault(parent, []).append(tag)
        for k, tags in children.items():
            own[k, 0, xxhash.xxh64_intdigest(" ".join(tags)) >> 1] += 1
        for block in page.blocks:
            text = clean("".join(t for _, t in block))
            if text:
                own[block[0][0], 1, xxhash.xxh64_intdigest(text) >> 1] += 1
        seen: set[int] = set()
        merged: Counter = Counter()
        for (k, kind, feature), c in own.items():
            key = page.elements[k][4]
            merged[key, kind, feature] += c
            if key not in seen:
                seen.add(key)
                count[host, key, 2, 0] += 1
                while k >= 0:
                    count[host, key, 3, page.elements[k][4]] = 1
                    k = page.elements[k][0]
        for (key, kind, feature), c in merged.items():
            count[host, key, kind, feature] += c
            logs[host, key, kind, feature] += c * math.log(c)
    return [(*k, n, float(logs.get(k, 0.0))) for k, n in count.items()]


def style_tree(pages: DataFrame, least_pages: int = 2, threshold: float = 0.1) -> DataFrame:
    """host, noise: the keys of each host's unimportant branches, from pages with columns host and html.

    The pages of a host are merged by the paths of their elements. With m pages, a feature's entropy over pages to the
    base m is (ln T - sum(c ln c) / T) / ln m, for T occurrences, c of them in a page. A leaf's content importance is one
    less the mean entropy of its texts, by occurrence; an inner element's presentation importance is the entropy of its
    sequences of child tags. A branch is noise if its top and all below it are under `threshold`. Few pages tell little: PRIOR pages of
    importance 1 are added to those that have an element. Hosts with fewer than `least_pages` pages give no row, and with the prior and a threshold of 0.1 a branch that all pages share is unimportant from four pages on. All sums are combined before they are shuffled, so a large host is
    no large group anywhere.
    """
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
    names = ["host", "key", "kind", "feature", "n", "s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _tree_rows(list(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows = pages.filter("host <> ''").select("host", "html").mapInArrow(run, "host string, key long, kind int, feature long, n long, s double")
    stats = materialise(rows.groupBy("host", "key", "kind", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "style-tree")
    kind = lambda k, c: F.sum(F.when(F.col("kind") == k, c))
    n_log_n = F.col("n") * F.log("n")
    per = stats.groupBy("host", "key").agg(
        kind(1, n_log_n - F.col("s")).alias("content"), kind(1, F.col("n")).alias("texts"), kind(0, n_log_n).alias("styles_log"), kind(0, F.col("n")).alias("styles"), kind(2, F.col("n")).alias("pages")
    )
    base = F.log(F.col("pages"))
    content = F.when(F.col("texts") > 0, 1 - F.col("content") / (F.col("texts") * base))
    style = F.when(F.col("styles") > 0, (F.log("styles") - F.col("styles_log") / F.col("styles")) / base)
    per = per.filter(F.col("pages") >= max(2, least_pages)).select("host", "key", ((F.greatest(content, style) * F.col("pages") + PRIOR) / (F.col("pages") + PRIOR)).alias("importance"))
    # an element in enough pages has everything above it in as many; those below it that are rarer count as important
    above = stats.filter("kind = 3").select("host", "key", F.col("feature").alias("top"))
    below = above.join(per, ["host", "key"], "left").groupBy("host", "top").agg(F.max(F.coalesce("importance", F.lit(1.0))).alias("most"))
    return below.filter(F.col("most") < threshold).groupBy("host").agg(F.collect_list("top").alias("noise"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url"), least_pages: int = 2, threshold: float = 0.1) -> DataFrame:
    """The carried columns, and text: the article of every whole page; n_chars: its code points.

    Removed from a page: branches that its host's style tree finds unimportant; what mark-up says is no article (elements,
    roles, words in class and id); and where a page has article elements, or else a main element, all outside of them.
    Branches that hold an article or main element, and those with most of the page's text, are never removed by name or
    weight. Character references are decoded, white space inside a block becomes one space (a line break is white space,
    inline mark-up is nothing), blocks are joined by one line break. A null html is empty, and so is the text of a page
    without an article. A page without a host (null or odd url) is judged by its mark-up alone. Rows are independent,
    so null and repeated ids are carried as they are; other columns are left out. An empty table gives no rows.
    """
    host = F.coalesce(F.regexp_extract(F.lower(pages[url_col]), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    held = F.struct(*[pages[c].alias(c) for c in carry])
    rows = pages.select(held.alias("row"), host.alias("host"), F.coalesce(pages[html_col], F.lit("")).alias("html"))
    noise = materialise(style_tree(rows, least_pages, threshold), "noise")
    if (noise.agg(F.sum(F.size("noise"))).first()[0] or 0) <= BROADCAST_KEYS:
        joined = rows.join(F.broadcast(noise), "host", "left")
    else:  # pages go to their host's keys in several parts each, so a large host is not one task
        part = F.pmod(F.xxhash64("html"), F.lit(HOST_PARTS))
        copies = noise.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(HOST_PARTS - 1).cast("bigint"))))
        joined = rows.withColumn("part", part).join(copies, ["host", "part"], "left")
    joined = joined.select("row", "html", "noise")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(Page(h), frozenset(n or ())) for h, n in zip(batch.column("html").to_pylist(), batch.column("noise").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["row", "text", "n_chars"])

    out = joined.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_chars long")
    return out.select("row.*", "text", "n_chars")
