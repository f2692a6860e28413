"""Main text of HTML pages by tree scoring.

Each block of text passes points (one, one per comma, and for its length) to its container and,
less, to the containers above; points are discounted by a container's link density. The container with
the most points, or the article around it, or else the widest container around it whose text is mostly outside links,
is kept with its siblings, however short, unless most of their text is in links. So are lists of links in an article. A header
inside an article or main element is part of it. Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are known by tag, role, class or id and never score. A class or
id, or a form, does not leave out a container of blocks with more than half of the page's text
outside links and all its articles, nor an article or main element in it; reader comments stay left out unless an article of
that name has so much of the text, or the main element is among them. Names that only state
a trait (no-sidebar, comments-open) do not count. A page without a text by these rules is read again without
names and forms.

Defined results: null, empty, text-free and unparsable pages give an empty text; unclosed and misnested tags
and cut-off pages are read as far as they go; repeated rows each get a row; null ids and urls
stay null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices

# Fixed values of HTML: elements without an end tag, and elements that part blocks of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr "
    "ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNWANTED = frozenset(
    "aside audio button canvas dialog embed footer head iframe input menu "
    "meta nav noscript object script select style svg template textarea title video".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search".split())
# Elements an opening tag closes when they are still open in the same container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("article aside body div dl footer form header main nav ol section table td th "
                  "ul".split())
MAIN = frozenset(("article", "main"))
COMMENTS = re.compile(r"(?i)(^|[\s_-])(comments?|commentlist|disqus|replies|respond)([\s_-]|$)")
CLUTTER = re.compile(
    r"(?i)(^|[\s_-])(ads?|advert\w*|adsense|banner|breadcrumbs?|byline-share|consent|cookies?|"
    r"footer|gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|notification|"
    r"outbrain|pager|pagination|popup|promo\w*|recommend\w*|related|share|sharing|sidebar|signup|"
    r"social|sponsor\w*|subscribe|taboola|teaser|toolbar|widget)([\s_-]|$)")
# Parts of a class that say what a page has or lacks, or are a page builder's name for any element.
TRAIT = re.compile(
    r"(?i)(?<!\S)((no|not|has|have|with|without)[-_]\S+(?!\S)|"
    r"\S+[-_](open|opened|closed|enabled|disabled|on|off)(?!\S)|elementor-widget(-|(?!\S)))")
CUT_OFF = re.compile(r"<(!--(?!.*-->)|[a-zA-Z/!?][^<>]*$).*\Z", re.DOTALL)
# What holds more of its text in links, and three links or more, is a menu (outside article and main elements).
LINK_DENSITY = 0.5
LINKS_IN_LIST = 3
CLIMB = 5


class _Page(HTMLParser):
    """Flat tree: parallel lists by node, parents before children, and blocks of text."""

    def __init__(self, left_out: list[bool] | None = None):
        """``left_out``: by node, from a first reading; without it, all text is read that no tag
        leaves out."""
        super().__init__(convert_charrefs=True)
        self.left_out = left_out
        self.tag, self.parent, self.why, self.skip = ["#root"], [-1], [""], [False]
        self.plain = [0]  # characters outside links
        self.stack = [0]
        # places on the stack of the open elements: by tag, of scopes and of blocks
        self.open: dict[str, list[int]] = {}
        self.scopes, self.open_blocks, self.mains = [], [0], 0
        self.links = [0]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.text: list[str] = []
        self.linked = self.depth_in_link = 0

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.holder(), text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def holder(self) -> int:
        return self.stack[self.open_blocks[-1]]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCK:
            self.flush()
            self.close_for(tag)
        if tag in VOID:
            return
        node, up = len(self.tag), self.stack[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.links.append(int(tag == "a"))
        self.plain.append(0)
        if self.left_out is None:
            self.why.append(self.reason(tag, dict(attrs)))
            self.skip.append(self.skip[up] or self.why[node] == "tag")
        else:
            self.skip.append(self.left_out[node])
        at = len(self.stack)
        self.stack.append(node)
        self.open.setdefault(tag, []).append(at)
        if tag in SCOPE:
            self.scopes.append(at)
        if tag in BLOCK:
            self.open_blocks.append(at)
        self.mains += tag in MAIN
        self.depth_in_link += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((places[-1] for places in map(self.open.get, tags) if places), default=0)

    def close_for(self, tag: str) -> None:
        closing = CLOSES.get(tag, ())
        may_close = {"p", *closing, *(HEADINGS if tag in HEADINGS else ())}
        while True:
            at = self.last(may_close)
            if not at or (self.scopes and at < self.scopes[-1]):
                return
            paragraph = self.tag[self.stack[at]] == "p"
            self.pop(at)
            if not (paragraph and closing):
                return

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        at = self.last((tag,))
        if at and (tag in SCOPE or not self.scopes or at > self.scopes[-1]):
            self.pop(at)  # an inline or paragraph end does not close containers

    def pop(self, at: int) -> None:
        for node in reversed(self.stack[at:]):
            tag = self.tag[node]
            self.open[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            if tag in BLOCK:
                self.open_blocks.pop()
            self.mains -= tag in MAIN
            self.depth_in_link -= tag == "a"
        del self.stack[at:]

    def reason(self, tag: str, attrs: dict) -> str:
        """Why the node may be left out: by "tag", "form", "comments", "clutter", or not ("")."""
        names = TRAIT.sub(" ", f"{attrs.get('class') or ''} {attrs.get('id') or ''}")
        style = (attrs.get("style") or "").replace(" ", "").lower()
        named = tag not in ("body", "html")
        if named and COMMENTS.search(names):
            return "comments"
        if tag in MAIN:
            return ""
        if (tag in UNWANTED or (tag == "header" and not self.mains) or "hidden" in attrs or "display:none" in style
                or (attrs.get("role") or "").lower() in ROLES
                or (attrs.get("aria-hidden") or "").lower() == "true"):
            return "tag"
        if tag == "form":
            return "form"
        return "clutter" if named and CLUTTER.search(names) else ""

    def choose(self) -> list[bool]:
        """By node, whether it is left out, by the reasons and the texts below the nodes."""
        n = len(self.tag)
        plain, holds_main = list(self.plain), [t == "main" for t in self.tag]
        for node in range(n - 1, 0, -1):
            plain[self.parent[node]] += plain[node]
            holds_main[self.parent[node]] |= holds_main[node]
        mains, blocks = [0] * n, [0] * n  # in the subtree: main elements with a text, blocks
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            mains[node] += (self.tag[node] in MAIN and plain[node] > 0 and not self.why[node]
                            and not self.skip[node])
            mains[up] += mains[node]
            blocks[up] += blocks[node] + (self.tag[node] in BLOCK)
        out = [""] * n
        for node in range(1, n):
            why, above = self.why[node], out[self.parent[node]]
            large = (2 * plain[node] > plain[0] and mains[node] == mains[0]
                     and blocks[node] > 0)
            main = self.tag[node] in MAIN
            if above in ("tag", "comments"):
                out[node] = above
            elif why == "comments":
                out[node] = "" if holds_main[node] or (main and large) else why
            elif why == "tag":
                out[node] = why
            elif not main:
                out[node] = above or ("" if large else why)
        return [bool(x) for x in out]

    def handle_data(self, data):
        if not self.skip[self.stack[-1]]:
            if self.left_out is None:
                if not self.depth_in_link:
                    self.plain[self.stack[-1]] += len(" ".join(data.split()))
                return
            self.text.append(data)
            if self.depth_in_link:
                self.linked += len(" ".join(data.split()))


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks, one a line."""
    if not html or not html.strip():
        return ""
    html = CUT_OFF.sub("", html) if html.rfind("<") > html.rfind(">") else html
    first = read(html)
    left_out = first.choose()
    text = scored(read(html, left_out))
    if not text and left_out != first.skip:
        text = scored(read(html, first.skip))
    return text


def read(html: str, left_out: list[bool] | None = None) -> _Page:
    page = _Page(left_out)
    page.feed(html)
    page.close()
    page.flush()
    return page


def scored(page: _Page) -> str:
    """The blocks of the best container and what belongs to it."""
    n = len(page.tag)
    length, linked, points = [0] * n, [0] * n, [0.0] * n
    links = list(page.links)
    for node, text, in_links in page.blocks:
        length[node] += len(text)
        linked[node] += in_links
        own = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
        up = node if page.tag[node] not in ("p", "li", "td", "pre", "blockquote", *HEADINGS) \
            else page.parent[node]
        for level in range(CLIMB):
            if up < 0:
                break
            points[up] += own if level == 0 else own / (2 if level == 1 else 3 * level)
            up = page.parent[up]
    for node in range(n - 1, 0, -1):
        length[page.parent[node]] += length[node]
        linked[page.parent[node]] += linked[node]
        links[page.parent[node]] += links[node]
    if not length[0]:
        return ""
    density = [linked[i] / length[i] if length[i] else 0.0 for i in range(n)]
    score = [points[i] * (1 - density[i]) for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    up = best
    while up > 0 and page.tag[up] not in MAIN:
        up = page.parent[up]
    best = up if up > 0 else best
    while (best > 0 and page.tag[best] not in MAIN and page.parent[best] > 0
           and page.tag[page.parent[best]] != "body" and density[page.parent[best]] <= LINK_DENSITY):
        best = page.parent[best]
    kept, left_out, in_main = [False] * n, [False] * n, [False] * n
    kept[best] = True
    for i in range(1, n):
        if i != best and best and page.parent[i] == page.parent[best]:
            kept[i] = page.tag[i] in HEADINGS or density[i] <= LINK_DENSITY
    for i in range(1, n):
        up = page.parent[i]
        kept[i] = kept[i] or kept[up]
        in_main[i] = in_main[up] or page.tag[i] in MAIN
        left_out[i] = left_out[up] or (
            page.tag[i] in ("ul", "ol", "table", "div", "section", "dl") and i != best and not in_main[i]
            and links[i] >= LINKS_IN_LIST and density[i] > LINK_DENSITY)
    return "\n".join(t for node, t, _ in page.blocks if kept[node] and not left_out[node])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    def run(batches):
        for batch in slices(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"),
                         F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string"))
