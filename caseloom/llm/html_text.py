"""Main text of web pages by tag-path ratios.

A page is read into text leaves, each with its path of tags from the root. Over a path's leaves the length of the text and its
punctuation are summed; the ratios to the number of leaves are smoothed along the page, fused into one score, and
a threshold relative to the page's own mean selects paths. Elements that say what they are (menus, headers, footers, sidebars, forms,
notices, adverts, reader comments: by tag, role, class or id) have score zero. What stands between the selected paths,
below their common ancestor, is content as well, so short headings and paragraphs stay. A link belongs to the path of its block if
that is prose (a paragraph, a heading), or if the block, or the list or table it is in, has words outside of links as well.

The whole page is read in linear time, however deep its elements are; unclosed and stray tags, quotes and comments are as browsers would roughly have them.
Null and empty pages, and pages without any text, give an empty text. White space is what Unicode says it is.
Repeated rows get equal results, empty tables give no rows. A column named `main_text` that is there already is replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import table

#: Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
#: Elements whose text isn't shown, or not as text; those of them that hold no blocks of text, but for what is in FOREIGN.
HIDDEN = frozenset("svg math object canvas select datalist option optgroup".split())
NO_BLOCKS = ("svg", "math", "select", "datalist")
FOREIGN = ("foreignobject", "desc", "annotation-xml")
#: What is in these ends nothing outside.
SCOPES = ("object", "canvas", *FOREIGN)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img label".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: A paragraph outside of these is not ended by what is inside.
HOLDS_P = frozenset("button td th caption table html".split()) | {*SCOPES}
#: Elements that a start tag ends, if open below the nearest of those after the bar.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Elements, and words in a role, class or id, that aren't the article; words that say an element is.
ASIDE_TAGS = frozenset("nav footer aside form button menu dialog head fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert sidebar side rail nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs pagination pager footer header masthead topbar comment comments disqus replies respond share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar search complementary contentinfo".split()
)
#: What begins a name that only tells of such an element elsewhere; whose header is the article's own.
ABOUT_WORDS = frozenset("has no with without".split())
OWN_WORDS = frozenset("article post story entry".split())
#: Blocks whose links are always part of their text; what groups items.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dl table".split())
KEPT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li blockquote pre td th dd dt figcaption article main".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+)>")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_SAYS = re.compile(r"[^\W_]")
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？]")
_END = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}
_BOTH = {t: re.compile(f"<(/?){t}(?=[\\s/>])", re.I) for t in ("object", "canvas")}

#: Weights of a path's neighbours in smoothing; the share of the mean score that selects a path.
NEIGHBOUR, THRESHOLD = 0.1, 0.3


class _Path:
    """Tags from the root, each path once on a page; `order` is its place among them, after its parent's."""

    __slots__ = ("tag", "parent", "below", "order", "article")

    def __init__(self, tag: str, parent: _Path | None, order: int) -> None:
        self.tag, self.parent, self.order = tag, parent, order
        self.below: dict[str, _Path] = {}
        self.article = tag in ("article", "main") or bool(parent and parent.article)


def speaks_against(attrs: str) -> bool:
    """Whether a name in a role, class or id says that the element isn't part of the article; each of several names counts by itself."""
    for m in _ATTR.finditer(attrs):
        for name in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _WORDS.findall(name)]
            against = ASIDE_WORDS.intersection(words)
            if against and words[0] not in ABOUT_WORDS and not (against == {"header"} and not OWN_WORDS.isdisjoint(words)):
                return True
    return False


class _Element:
    __slots__ = ("tag", "path", "aside", "named", "article", "block", "items", "prose", "link", "says")

    def __init__(self, tag: str, parent: _Element | None, attrs: str, path: _Path) -> None:
        self.tag, self.path = tag, path
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        self.aside = bool(parent and parent.aside) or tag in ASIDE_TAGS or tag in HIDDEN or tag == "header" and not self.article
        # What only its name speaks against is told apart: if nothing else is left on the page, it stays.
        self.named = bool(parent and parent.named)
        if attrs and tag not in ("html", "body", "main", "article") and not (self.aside or self.named):
            self.named = speaks_against(attrs)
        inline = tag in INLINE
        #: The nearest block and list, whether in prose or a link; of blocks and lists, whether they have words outside of links.
        self.block = parent.block if inline and parent else self
        self.items = self if tag in LISTS or not parent else parent.items
        self.prose = tag in PROSE or bool(parent and parent.prose)
        self.link = tag == "a" or inline and bool(parent and parent.link)
        self.says = False

    def running(self) -> bool:
        """A link's words are part of a text."""
        return self.prose or self.block.says or self.items.tag != "" and self.items.says


def leaves(page: str) -> tuple[list[tuple[_Path, bool, bool, str]], list[_Path]]:
    """Text leaves in page order: path, whether not article by tag, by name, and the text (a space at each end of a block); all paths by `order`."""
    out: list[tuple[_Element, str]] = []
    paths = [_Path("", None, 0)]
    stack: list[_Element] = [_Element("", None, "", paths[0])]
    #: Where in the stack the elements of each tag are, so that none is searched for.
    places: dict[str, list[int]] = {}
    with_end: dict[str, set[int]] = {}
    at, n = 0, len(page)

    def below(path: _Path, tag: str) -> _Path:
        if tag not in path.below:
            paths.append(path.below.setdefault(tag, _Path(tag, path, len(paths))))
        return path.below[tag]

    def ended(tag: str) -> set[int]:
        """Where those start that have an end tag of their own."""
        if tag not in with_end:
            with_end[tag], begun = set(), []
            for m in _BOTH[tag].finditer(page):
                if not m[1]:
                    begun.append(m.start())
                elif begun:
                    with_end[tag].add(begun.pop())
        return with_end[tag]

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def end_from(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()

    broken = False  # no comment is closed from here on

    def text(s: str) -> None:
        if s:
            e = stack[-1]
            out.append((e, s := html.unescape(s) if "&" in s else s))
            if not (e.link or e.block.says and e.items.says) and _SAYS.search(s):
                e.block.says = e.items.says = True

    def gap() -> None:
        if out and not out[-1][1].endswith(" "):
            out.append((stack[-1], " "))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        if page.startswith("<!--", lt):
            end = -1 if broken else page.find("-->", lt + 4)
            broken = broken or end < 0
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            # A lone "<" is text; an unclosed tag at the end is dropped.
            if page[lt + 1 : lt + 2].isalpha() or page[lt + 1 : lt + 2] == "/":
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                text("<")
                at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if tag not in INLINE:
            gap()
        if m[1]:
            if k := nearest((tag,)):
                end_from(k)
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            # A slash in the tag doesn't end these.
            end = _END[tag].search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = n if close < 0 else close + 1
            continue
        if tag in HIDDEN:
            # One that holds blocks and is never ended would hide what comes after it.
            if m[3].endswith("/") or tag in SCOPES and lt not in ended(tag):
                continue
        if (tag in CLOSES_P or tag in ENDS and tag != "option") and (k := nearest(NO_BLOCKS)) > nearest(FOREIGN):
            end_from(k)
        if tag in CLOSES_P and (k := nearest(("p",))) > nearest(HOLDS_P):
            end_from(k)
        if tag in ENDS and (k := nearest(ENDS[tag][0])) > max(nearest(ENDS[tag][1]), nearest(SCOPES)):
            end_from(k)
        if m[3].endswith("/") and tag in INLINE:
            continue
        up = stack[-1]
        places.setdefault(tag, []).append(len(stack))
        stack.append(_Element(tag, up, m[3], up.path if tag in INLINE else below(up.path, tag)))
    return [(below(e.path, "a") if e.link and not e.running() else e.path, e.aside, e.named, s) for e, s in out], paths


def _common(found: set[_Path], paths: list[_Path]) -> _Path:
    """The longest path that all of found begin with."""
    n = [0] * len(paths)
    for p in found:
        n[p.order] = 1
    for p in reversed(paths):
        if n[p.order] == len(found):
            return p
        if p.parent:
            n[p.parent.order] += n[p.order]
    return paths[0]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, every = leaves(page)
    use = [x for x in found if not x[1] and not x[2]]
    if not any(x[3].strip() for x in use):
        use = [x for x in found if not x[1]]
    stats: dict[_Path, list[int]] = {}
    for path, _, _, s in use:
        if s.strip():
            row = stats.setdefault(path, [0, 0, 0])
            row[0] += len(s)
            row[1] += len(_PUNCT.findall(s))
            row[2] += 1
    if not stats:
        return ""
    paths = list(stats)
    ratio = [[stats[p][k] / stats[p][2] for p in paths] for k in (0, 1)]
    smooth = [[(r[i] + NEIGHBOUR * sum(r[j] for j in (i - 1, i + 1) if 0 <= j < len(r))) / (1 + NEIGHBOUR * sum(0 <= j < len(r) for j in (i - 1, i + 1))) for i in range(len(r))] for r in ratio]
    # A path of links is mostly for going elsewhere.
    score = {p: t * (1 + math.log1p(q)) * (0.25 if p.tag == "a" else 2.0 if p.article else 1.0) for p, t, q in zip(paths, *smooth)}
    chars = sum(v[0] for v in stats.values())
    mean = sum(score[p] * stats[p][0] for p in paths) / chars
    chosen = {p for p in paths if score[p] >= THRESHOLD * mean}
    best = max(chosen, key=lambda p: (score[p] * stats[p][0], p.order))
    strip = best.parent if best.tag in KEPT_BLOCKS - {"article", "main"} | {"a"} else best
    root = _common({strip} | {p for p in chosen if stats[p][0] >= 0.1 * stats[best][0] and p is not best}, every)
    inside = root.tag not in ("", "html", "body")
    under = [False] * len(every)
    for p in every:
        under[p.order] = p is root or p.parent is not None and under[p.parent.order]
    kept = {p for p in paths if p in chosen or under[p.order] and (inside or p.tag in KEPT_BLOCKS)}
    # A heading beside the best path's blocks is theirs.
    kept |= {p for p in paths if p.tag in HEADINGS and p.parent is best.parent}
    # What is not a link and stands between selected texts stays even where the paths meet only at the page's body.
    at = [i for i, x in enumerate(use) if x[0] in chosen and x[3].strip()]
    between = lambda i, p: at[0] < i < at[-1] and under[p.order] and p.tag != "a"
    return " ".join("".join(s if path in kept or not s.strip() or between(i, path) else " " for i, (path, _, _, s) in enumerate(use)).split())


def with_main_text(pages: DataFrame) -> DataFrame:
    """pages with `main_text`."""

    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    return pages.withColumn("main_text", extract(F.col("html")))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
