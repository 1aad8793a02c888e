"""Main text of HTML pages by tag-path ratios.

A page becomes its sequence of text blocks, each with the root-to-leaf path of
the block element that holds it (tag names with classes). Per path, text length
and punctuation are added up over its blocks and divided by the tags seen on
it; the two ratios are fused and discounted by the share of linked text, and
smoothed along the page with a Gaussian. A path's value is the geometric mean of
its own ratio and the smoothed one around its blocks; paths from ``SHARE`` of the
best value on are selected and give the content nodes.

Two structural rules complete the ratios, which alone lose short paragraphs and
titles: blocks under elements that never hold main text (menus, page headers,
footers, asides, scripts, forms, and elements with a class token, id or role that
names an advert, notice, sidebar, menu or comments and no state such as "no-" or
"-enabled") are out, but neither a name nor a form puts out the element that holds
the chief ``article`` or ``main`` or, on pages without, most of the page's text; where an ``article`` or
``main`` element holds most of the selected text, all its other blocks are in,
else headings and blocks beside selected ones are.

Character references are decoded, white space in a block (``br`` included) is
one space, blocks are trimmed, empty ones dropped, and the rest joined by a
line break in page order. Tags left open and stray end tags are tolerated: an end
tag ends its innermost open element at any depth, and a new list item, table row
or cell, term or description the open one of its list or table.

Edge cases: null or empty html gives an empty text; a page without main text
gives an empty text; plain text without tags is one block and is kept; repeated
rows give repeated results; a null page_id or url is kept; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal, text_slices, texts
from weft.session import ship_package

#: Width of the smoothing, in blocks, and the share of the best path's value from
#: which a path is selected.
SMOOTHING, SHARE = 1.0, 0.45

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset("nav footer aside menu dialog button select option svg object head search fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
SAME_CLOSES = frozenset("li dd dt tr td th option p".split())
# Start tags that end the nearest open element of their kin, and all open in it,
# unless a list, table or section of the page lies between.
_SECTIONS = "article aside body blockquote footer form header main nav section"
KIN = {t: k.split() for k in ("li", "dd dt", "tr", "td th") for t in k.split()}
LIMITS = {"li": f"ul ol menu dir dl table td th {_SECTIONS}", "dd": f"dl ul ol table td th {_SECTIONS}", "tr": "table", "td": "tr table"}
LIMITS = {t: LIMITS[next(k for k in KIN[t] if k in LIMITS)].split() for t in KIN}
BOILERPLATE = re.compile(
    r"(?:ads?|advert\w*|adverti[sz]ement\w*|banner|breadcrumbs?|comments?|comentarios?|commentaires?|cookies?|consent|copyright|discussions?|disqus|feedback|footer|header|kommentare?|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|rail|reactions?|related|repl(?:y|ies)|responses?|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)"
)
# Words that make a name tell a state or layout of its element, not its part.
STATES = frozenset("has have no not with without is hide hides hidden show shows enable enabled disable disabled on off open opened closed active layout wrapper".split())
#: Share of a page's unlinked text from which a boilerplate name is not believed;
#: shorter blocks than PROSE without any punctuation do not count.
MOST, PROSE = 0.75, 40
_ATTRIBUTES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…。，、；：！？]")
_STOP = re.compile("[\"'>]")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")


def names_boilerplate(names: str) -> bool:
    """Whether one of the class tokens, ids or roles names boilerplate."""
    for name in names.lower().split():
        words = re.findall("[a-z]+", name)
        if not STATES.intersection(words) and any(BOILERPLATE.fullmatch(w) for w in words):
            return True
    return False


class _Page:
    """Blocks of one page with the number of their path."""

    def __init__(self) -> None:
        self.nodes: dict[tuple[int, str], int] = {}
        self.parent, self.tag, self.out, self.main = [-1], [""], [False], [-1]
        self.tags = [0]  # tags seen on each path
        self.named, self.opened = [False], [1]  # by a boilerplate name; elements of each path
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.at: dict[str, list[int]] = {}  # places in the stack by tag, ascending
        self.blocks: list[tuple[int, str, int]] = []  # path, text, linked characters
        self.text: list[str] = []
        self.linked = 0
        self.links = 0

    def flush(self) -> None:
        if self.text:
            text = " ".join(html_lib.unescape("".join(self.text)).split())
            if text:
                self.blocks.append((self.stack[-1][1], text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def add(self, text: str) -> None:
        self.text.append(text)
        if self.links:
            self.linked += len(text.strip())

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self._implied(tag)
            here = self.stack[-1][1]
            marks = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTES.findall(attributes)} if "=" in attributes else {}
            # a form may be the layout around a whole page: it is judged like a name
            aside = tag == "form" or bool(marks) and tag not in ("html", "body") and tag not in MAIN and names_boilerplate(" ".join(marks.values()))
            label = tag + "".join("." + c for c in marks.get("class", "").split()) + "!" * aside
            node = self.nodes.get((here, label))
            if node is None:
                node = self.nodes[here, label] = len(self.parent)
                inside = self.main[here] >= 0
                out = self.out[here] or tag in NEVER or (tag == "header" and not inside)
                self.parent.append(here)
                self.tag.append(tag)
                self.out.append(out)
                self.main.append(self.main[here] if inside else node if tag in MAIN and not out else -1)
                self.tags.append(0)
                self.named.append(aside)
                self.opened.append(0)
            self.tags[node] += 1
            self.opened[node] += 1
            if tag not in VOID:
                self._push(tag, node)
        elif tag == "br":
            self.text.append("\n")
            self.tags[self.stack[-1][1]] += 1
        else:
            self.tags[self.stack[-1][1]] += 1
            if tag == "a":
                self.links += 1
            elif tag in NEVER:
                self.flush()
                here = self.stack[-1][1]
                node = self.nodes.setdefault((here, tag), len(self.parent))
                if node == len(self.parent):
                    self.parent.append(here)
                    self.tag.append(tag)
                    self.out.append(True)
                    self.main.append(self.main[here])
                    self.tags.append(0)
                    self.named.append(False)
                    self.opened.append(1)
                self._push(tag, node)

    def _push(self, tag: str, node: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))

    def _cut(self, place: int) -> None:
        """Ends the open elements from a place of the stack on."""
        while len(self.stack) > place:
            self.at[self.stack.pop()[0]].pop()

    def _innermost(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 without one."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _implied(self, tag: str) -> None:
        """A start tag that ends an open element of its kin, or a paragraph."""
        if tag in KIN and (kin := self._innermost(KIN[tag])) > self._innermost(LIMITS[tag]):
            self._cut(kin)
        elif self.stack[-1][0] == "p" or (tag in SAME_CLOSES and self.stack[-1][0] == tag):
            self._cut(len(self.stack) - 1)

    def close(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCKS or tag in NEVER:
            self.flush()
            if place := self._innermost((tag,)):
                self._cut(place)


    def exclude_named(self) -> None:
        """Puts elements with boilerplate names out, but for those that hold the
        page's chief article or, without any, ``MOST`` of its text: there the
        ratios decide."""
        if not any(self.named):
            return
        mass = [0] * len(self.parent)
        for path, text, linked in self.blocks:
            if not self.out[path] and (len(text) >= PROSE or _PUNCTUATION.search(text)):
                mass[path] += len(text) - linked
        for node in range(len(mass) - 1, 0, -1):
            mass[self.parent[node]] += mass[node]
        holds = [-1] * len(mass)  # nearest article or main around each path
        chief = -1
        for node in range(1, len(mass)):
            up = self.parent[node]
            holds[node] = up if self.tag[up] in MAIN else holds[up]
            if self.tag[node] in MAIN and not self.out[node] and mass[node]:
                least = mass[chief] / self.opened[chief] / (2 if holds[node] == chief else 1) if chief >= 0 else 0
                chief = node if mass[node] / self.opened[node] > least else chief
        kept = set()
        node = chief
        while node > 0:
            kept.add(node)
            node = self.parent[node]
        for node in range(1, len(mass)):
            spared = node in kept if chief >= 0 else mass[node] > MOST * mass[0]
            self.out[node] = self.out[node] or self.out[self.parent[node]] or (self.named[node] and not spared)


def tag_end(html: str, at: int) -> int:
    """Place of the ``>`` that ends the tag whose name ends at ``at``; -1 without
    one. A quoted value (a quote after ``=``) may hold any characters and be of any
    length; a quote that nothing closes counts as none. Each character is looked
    at once, as after a quote without its like there is no second one to look for."""
    while stop := _STOP.search(html, at):
        if (mark := stop.group()) == ">":
            return stop.start()
        at = stop.end()
        if html[max(0, stop.start() - 64) : stop.start()].rstrip().endswith("="):
            shut = html.find(mark, at)
            at = shut + 1 if shut >= 0 else at
    return -1


def page_blocks(html: str) -> _Page:
    page, at, n = _Page(), 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0 or lt + 1 >= n:
            page.add(html[at:])
            break
        if lt > at:
            page.add(html[at:lt])
        after = html[lt + 1]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if after in "!?":
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        name = _NAME.match(html, lt + 1 + closing)
        if not name:
            page.add("<")
            at = lt + 1
            continue
        end = tag_end(html, name.end())
        if end < 0:
            break
        tag, at = name.group().lower(), end + 1
        if closing:
            page.close(tag)
            continue
        if tag in RAW:
            shut = re.compile(f"</{re.escape(tag)}[\\s/>]", re.IGNORECASE).search(html, at)
            at = n if shut is None else max(html.find(">", shut.start()) + 1, shut.end())
            continue
        page.open(tag, html[name.end() : end])
    page.flush()
    page.exclude_named()
    return page


def path_values(page: _Page, smoothing: float = SMOOTHING) -> np.ndarray:
    """The fused and smoothed ratio of each path: text length per tag times
    punctuation per tag, less the linked share, and its smoothed value around the
    path's blocks (weighted by their length), by their geometric mean."""
    blocks, n = page.blocks, len(page.parent)
    chars, marks, linked = np.zeros(n), np.zeros(n), np.zeros(n)
    for path, text, link in blocks:
        chars[path] += len(text)
        marks[path] += len(_PUNCTUATION.findall(text))
        linked[path] += link
    tags = np.maximum(np.array(page.tags), 1)
    fused = (chars / tags) * (1 + marks / tags) * (1 - linked / np.maximum(chars, 1))
    fused[np.array(page.out)] = 0
    of = np.array([b[0] for b in blocks])
    reach = max(1, int(3 * smoothing))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / smoothing) ** 2)
    smooth = np.convolve(fused[of], kernel / kernel.sum(), mode="full")[reach : reach + len(blocks)]
    weight = np.array([len(b[1]) for b in blocks], float)
    around = np.bincount(of, smooth * weight, n) / np.maximum(np.bincount(of, weight, n), 1)
    return np.sqrt(fused * around)


def select_blocks(page: _Page, smoothing: float = SMOOTHING, share: float = SHARE) -> list[str]:
    """Texts of the content blocks in page order."""
    blocks = page.blocks
    kept = [i for i, (path, _, _) in enumerate(blocks) if not page.out[path]]
    if not kept:
        return []
    value = path_values(page, smoothing)
    best = max(value[blocks[i][0]] for i in kept)
    selected = {blocks[i][0] for i in kept if value[blocks[i][0]] >= share * best and (best == 0 or value[blocks[i][0]] > 0)}
    mass: dict[int, int] = {}
    for i in kept:
        if blocks[i][0] in selected:
            mass[page.main[blocks[i][0]]] = mass.get(page.main[blocks[i][0]], 0) + len(blocks[i][1])
    holder = max((m for m in mass if m >= 0), key=lambda m: mass[m], default=-1)
    if holder >= 0 and 2 * mass[holder] >= sum(mass.values()):
        return [blocks[i][1] for i in kept if page.main[blocks[i][0]] == holder]
    beside = {page.parent[p] for p in selected}
    return [blocks[i][1] for i in kept if blocks[i][0] in selected or (page.tag[blocks[i][0]] in HEADINGS | {"p", "li"} and page.parent[blocks[i][0]] in beside)]


def main_text(html: str) -> str:
    return "\n".join(select_blocks(page_blocks(html)))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``."""
    ship_package(pages.sparkSession)

    def task(batches):
        for batch in batches:
            for part in text_slices(batch, "html"):
                found = [main_text(h) for h in texts(part.column("html"))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return wanted.mapInArrow(frugal(task), "page_id long, url string, text string, n_chars long")
