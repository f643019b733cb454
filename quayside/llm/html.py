"""Main text of web pages by tag-path ratios.

Each page is read in one pass. Text blocks are the text between block-level tags; a block's path is the chain of
block-level tags from the root to it (inline tags do not count). Blocks inside elements that are boilerplate by name,
role, or class (menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are
out: a class or id counts as such where it is such a word, one joined with other such or neutral words, or one that begins
or ends with a strong one (comments, cookies, adverts) and tells no state. Names that only contain one (`has-sidebar`,
`comments-open`) are weak: blocks inside stay where their paths, which are kept apart from other paths, are content, or
beside such a block. A form is out unless it wraps the page: it holds the article, the main element or the first heading,
or paragraphs with half of the page's text. Lists of three or more items that are nothing but links are out anywhere. Text length and punctuation are aggregated by path; both ratios, per block of the path, are smoothed over the
blocks in page order with a short Gaussian, fused by product, and paths whose mean reaches half a standard deviation are
content. The article is the enclosing `article` or `main` element of the content blocks, or else their common ancestor
less the blocks that neither have a content path nor stand beside such a block. Of several `article` elements, one with
less than a fifth of the text of the largest is a teaser, and out.

Character references are decoded once, white space inside a block becomes one space, blocks are trimmed and joined by
one space in page order; nothing is capped.

Defined cases: a null or empty page, or one without content, has an empty text; unclosed and misnested tags are closed
as browsers do for paragraphs, list items and table cells; an unterminated comment or script runs to the end; equal rows
are treated alike; an empty table gives an empty result; columns of the input named text or n_chars give way.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .text import slices, without

_OUTPUTS = ("text", "n_chars")

# Element names of the HTML standard, by role.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math canvas object".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
CLOSED_BY = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
}
STOPS = frozenset("ul ol dl table div article section body html select".split())
# Boilerplate by element, by word of class or id, and by role.
OUT_TAGS = frozenset("head nav footer aside fieldset label legend button select option datalist menu dialog audio video map".split())
OUT_WORDS = frozenset(
    "nav navbar navigation menu menus topbar breadcrumb breadcrumbs sidebar sidebars aside footer masthead banner ad ads adv "
    "advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion popup modal overlay cookie "
    "cookies consent gdpr notice notices alert newsletter subscribe subscription signup login signin share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond widget widgets toolbar "
    "pagination pager search copyright skip tags rail discussion discussions".split()
)
# Words that make boilerplate of a name they begin or end, and words of names that tell a page's state.
STRONG_WORDS = frozenset(
    "comment comments commentlist discussion discussions disqus reviews cookie cookies consent gdpr advert adverts advertisement "
    "advertisements sponsored newsletter sidebar navbar breadcrumb breadcrumbs".split()
)
STATES = frozenset("has have with without no not is open opened closed enabled disabled allow allowed free on off supports".split())
# Words that leave a compound with one of the above what it is.
NEUTRAL = frozenset(
    "main site page top bottom primary secondary global mobile desktop box bar wrap wrapper container inner outer list area block "
    "section group item items link links button buttons icon icons title heading header body text post posts entry article "
    "left right center column col row".split()
)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HEADER = frozenset({"header"})

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"""[^>"']*+(?:"[^"<]*+"[^>"']*+|'[^'<]*+'[^>"']*+)*+>""")
# One attribute after another, so that values are passed over.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_JOINTS = re.compile(r"[^a-z0-9]+")
_HUMPS = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Element:
    __slots__ = ("name", "out", "path", "parent", "article", "weak", "form", "link")

    def __init__(self, name: str, parent: _Element | None, out: bool, article: bool, weak: bool = False):
        self.name, self.parent, self.out, self.article = name, parent, out, article
        self.path = (parent.path if parent else "") + ("" if name in INLINE else "/" + name) + ("~" if weak else "")
        self.weak = weak or (parent is not None and parent.weak)
        self.form = self if name == "form" else parent.form if parent else None
        self.link = name == "a" or (parent is not None and parent.link and name in INLINE)


def _strong(word: str) -> bool:
    return word in STRONG_WORDS or word.startswith("comments") or word.endswith("comments")


def _named(value: str, words: frozenset[str]) -> bool | None:
    """Whether names of a class or id are boilerplate; None: a name has such a word, but says something else too."""
    weak = False
    for name in value.split():
        parts = [x for x in _JOINTS.split(_HUMPS.sub("-", name).lower()) if x and not x[0].isdigit()]
        if not parts:
            continue
        strong = _strong(parts[0]) or _strong(parts[-1])
        if strong or not words.isdisjoint(parts):
            if words.union(NEUTRAL).issuperset(parts) or (strong and STATES.isdisjoint(parts)):
                return True
            weak = True
    return None if weak else False


def _boilerplate(name: str, attributes: str, in_article: bool) -> bool | None:
    """Whether an element is boilerplate; None if its names are weak."""
    if name in OUT_TAGS or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body"):
        return False
    own: dict[str, str] = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        own.setdefault(key.lower(), next((v for v in values if v), ""))
    if own.get("role", "").strip().lower() in OUT_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(own.get("style", "")):
        return True
    named = [_named(own[key], OUT_WORDS if in_article else OUT_WORDS | HEADER) for key in ("class", "id") if key in own]
    return True if True in named else None if None in named else False


def blocks(page: str) -> list[tuple[_Element, str]]:
    """Text blocks outside boilerplate, in page order, with the block-level element each stands in."""
    found: list[tuple[_Element, str]] = []
    wraps: set[_Element] = set()
    linked: list[bool] = []
    here = _Element("", None, False, False)
    pending: list[tuple[str, bool]] = []

    def close_block() -> None:
        if pending:
            text = " ".join("".join(t for t, _ in pending).split())
            only_links = all(link for t, link in pending if t.strip())
            pending.clear()
            if text:
                element = here
                while element.name in INLINE:
                    element = element.parent
                found.append((element, text))
                linked.append(only_links)

    at, n = 0, len(page)
    while at < n:
        tag = _TAG.search(page, at)
        to = tag.start() if tag else n
        if to > at and not here.out:
            pending.append((html.unescape(page[at:to]), here.link))
        if not tag:
            break
        if tag[1]:
            end = page.find("-->", tag.end())
            at = n if end < 0 else end + 3
            continue
        rest = _REST.match(page, tag.end())
        end = rest.end() if rest else page.find(">", tag.end()) + 1
        at = end if end > 0 else n
        if tag[2]:
            continue
        name, attributes = tag[4].lower(), page[tag.end() : at - 1]
        if name in RAW and not tag[3]:
            if not attributes.endswith("/"):
                finish = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = finish.end() if finish else n
            continue
        if name == "br":
            pending.append((" ", True))
            continue
        if name not in INLINE:
            close_block()
        if tag[3]:
            element = here
            while element.parent and element.name != name:
                if name in INLINE and element.name not in INLINE:
                    break
                element = element.parent
            if element.name == name:
                here = element.parent
            continue
        if name in VOID:
            continue
        closes = CLOSED_BY.get(name) or (frozenset({"p"}) if name in CLOSES_P else None)
        if closes:
            element = here
            while element.parent and element.name not in closes and element.name not in STOPS:
                element = element.parent
            if element.name in closes:
                here = element.parent
                while name == "tr" and here.name in closes:
                    here = here.parent
        article = here.article or name in ("article", "main")
        in_article = here.article or name == "article"
        out = here.out or _boilerplate(name, attributes, in_article and _inside(here, "article"))
        here = _Element(name, here, bool(out), article, out is None)
        if here.form and not out and name in ("article", "main", "h1"):
            wraps.add(here.form)
    close_block()
    return _without_link_lists(*_without_forms(found, linked, wraps))


def _without_forms(
    found: list[tuple[_Element, str]], linked: list[bool], wraps: set[_Element]
) -> tuple[list[tuple[_Element, str]], list[bool]]:
    """The blocks outside forms and inside those that wrap the page."""
    if all(e.form is None for e, _ in found):
        return found, linked
    whole = sum(len(t) for _, t in found)
    told: dict[_Element, int] = defaultdict(int)
    for element, text in found:
        if element.form and element.name == "p":
            told[element.form] += len(text)
    wraps = wraps | {form for form, n in told.items() if 2 * n >= whole}
    keep = [i for i, (e, _) in enumerate(found) if e.form is None or e.form in wraps]
    return [found[i] for i in keep], [linked[i] for i in keep]


def _without_link_lists(found: list[tuple[_Element, str]], linked: list[bool]) -> list[tuple[_Element, str]]:
    """The blocks but for lists of three or more items that are nothing but links."""
    lists: dict[_Element, list[bool]] = defaultdict(list)
    for (element, _), only_links in zip(found, linked, strict=True):
        if element.name == "li" and element.parent:
            lists[element.parent].append(only_links)
    menus = {parent for parent, items in lists.items() if len(items) > 2 and all(items)}
    return [(e, t) for e, t in found if e.name != "li" or e.parent not in menus]


def _inside(element: _Element | None, name: str) -> bool:
    while element:
        if element.name == name:
            return True
        element = element.parent
    return False


def _smooth(values: list[float]) -> list[float]:
    """Gaussian of radius 2, its weights renewed at the ends."""
    kernel = (0.0545, 0.2442, 0.4026, 0.2442, 0.0545)
    out = []
    for i in range(len(values)):
        pairs = [(kernel[k + 2], values[i + k]) for k in range(-2, 3) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    return out


def content_paths(found: list[tuple[_Element, str]]) -> set[str]:
    """Paths whose fused, smoothed ratios of text and punctuation reach the threshold."""
    chars: dict[str, int] = defaultdict(int)
    marks: dict[str, int] = defaultdict(int)
    count: dict[str, int] = defaultdict(int)
    for element, text in found:
        chars[element.path] += len(text)
        marks[element.path] += len(_PUNCTUATION.findall(text))
        count[element.path] += 1
    lengths = _smooth([chars[e.path] / count[e.path] for e, _ in found])
    points = _smooth([(1 + marks[e.path]) / count[e.path] for e, _ in found])
    fused = [a * b for a, b in zip(lengths, points, strict=True)]
    mean = sum(fused) / len(fused)
    limit = 0.5 * (sum((x - mean) ** 2 for x in fused) / len(fused)) ** 0.5
    totals: dict[str, float] = defaultdict(float)
    for (element, _), x in zip(found, fused, strict=True):
        totals[element.path] += x
    return {p for p, total in totals.items() if total / count[p] >= limit}


def _ancestors(element: _Element) -> list[_Element]:
    out = []
    while element:
        out.append(element)
        element = element.parent
    return out[::-1]


def _without_teasers(found: list[tuple[_Element, str]]) -> list[tuple[_Element, str]]:
    """The blocks but for those of articles with less than a fifth of the text of the largest."""
    sizes: dict[_Element, int] = defaultdict(int)
    outermost = []
    for element, text in found:
        own = next((a for a in _ancestors(element) if a.name == "article"), None)
        outermost.append(own)
        if own:
            sizes[own] += len(text)
    if len(sizes) < 2:
        return found
    most = max(sizes.values())
    return [x for x, own in zip(found, outermost, strict=True) if own is None or 5 * sizes[own] >= most]


def main_text(page: str | None) -> str:
    """The main text of one page."""
    found = blocks(page) if page else []
    if not found:
        return ""
    found = _without_teasers(found)
    paths = content_paths(found)
    chosen = [e for e, _ in found if e.path in paths]
    common = _ancestors(chosen[0])
    for element in chosen[1:]:
        chain = _ancestors(element)
        k = 0
        while k < min(len(chain), len(common)) and chain[k] is common[k]:
            k += 1
        common = common[:k]
    article = next((e for e in common if e.name == "article"), None) or next((e for e in common if e.name == "main"), None)
    beside = {id(e.parent) for e in chosen}

    def stays(e: _Element) -> bool:
        return not e.weak or e.path in paths or id(e.parent) in beside

    if article is None:
        articles = {id(a) for e in chosen for a in _ancestors(e) if a.name in ("article", "main")}
        inside = [t for e, t in found if stays(e) and any(id(a) in articles for a in _ancestors(e))]
        if articles and sum(map(len, inside)) * 2 > sum(len(t) for e, t in found if e.path in paths):
            return " ".join(inside)
        root = next((e for e in common[::-1] if e.name not in ("p", "li", "pre", "blockquote", "td", "h1", "h2", "h3", "h4", "h5", "h6")), common[0])
        kept = [t for e, t in found if root in _ancestors(e) and (e.path in paths or id(e.parent) in beside)]
    else:
        kept = [t for e, t in found if article in _ancestors(e) and stays(e)]
    return " ".join(kept)


def _extractor(column: str, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            texts = [main_text(x) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*columns, *_OUTPUTS],
            )

    return work


def extract_text(pages: DataFrame, *, column: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` (default: all) of pages with text and n_chars."""
    base = without(pages, [n for n in _OUTPUTS if n != column.lower()])
    carry = [c for c in base.columns if c.lower() not in _OUTPUTS] if carry is None else carry
    schema = T.StructType([*(T.StructField(c, base.schema[c].dataType) for c in carry), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return base.select(*dict.fromkeys([*carry, column])).mapInArrow(_extractor(column, carry), schema)
