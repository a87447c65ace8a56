"""HTML extraction by tag-path ratios (operator 5).

A page becomes a list of text nodes, each with its root-to-leaf tag path
(tags with their class names). Per path, text length, punctuation and link
text are summed over its nodes; the mean length and the mean punctuation of
a node are the path's two ratios. Every node takes its path's ratios, they
are smoothed along the page with a Gaussian window (a short heading among
long paragraphs rises, a lone notice does not reach far) and fused by their
product, weighed down by the share of link text and by class or id names
that boilerplate has (a feature of the score, no cut). Nodes above a threshold
drawn from the page's own mean and deviation are content. If one article or main
element holds them all, it is read in full; else the deepest container of most
of them, the containers of the others, what lies between and the headings before:
all blocks in page order, except elements that are no article by tag or role,
elements of doubtful name whose weighed score stays below half the threshold, and
runs of blocks that are all links, unless they stand below a heading. Headings
stay, links or not.

Defined cases: null and empty html give the empty text; a page without any node
above the threshold gives the text of its whole body without boilerplate; a cut
or unclosed page is read to its end; time and memory of a page grow with its
length alone, however broken or deep it is; repeated rows are extracted again;
null page_id and url stay null; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import html as html_entities
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import quoted
from tidemark.session import ship_by_value

# --- fixed values: element names of the HTML standard ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option optgroup".split())
WRAPS = INLINE | CLOSED_BY_SAME | frozenset("h1 h2 h3 h4 h5 h6 pre blockquote ul ol dl table tbody thead tfoot figure".split())
SCOPE = frozenset("article aside body div html main nav ol section table td th ul blockquote form".split())
# --- fixed values: what an article does not consist of ---
SKIPPED = frozenset("head script style noscript template svg math iframe object embed canvas audio video textarea "
                    "select button form nav footer aside menu dialog noembed noframes xmp title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
                  "comments commentlist consent cookie cookies copyright disqus footer gdpr header masthead menu modal "
                  "nav navbar navigation newsletter notice notices notification pagination pager paywall popup promo promotion "
                  "recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored "
                  "subscribe teaser toolbar widget widgets".split())
# --- fixed values: words beside those above in names such as ad-box or comments-list ---
PLAIN = frozenset("area bar block body bottom box col column container content count form global group head inner item items left "
                  "link links list main message outer page panel post posts primary right row secondary section site slot text "
                  "thread title top unit wrap wrapper zone".split())
# --- parameters ---
DOUBT = 0.125         # weight of the score below an element with such a name
DOUBT_TEXT = 0.75     # the same where a paragraph of an article has it itself
SMOOTH = 1.0          # nodes, deviation of the smoothing window
SPREAD = 0.3          # the threshold is the mean plus this part of the deviation, at most the mean of long nodes
LINK_SHARE = 0.6      # blocks with more of their text in links are lines of links
COVER = 0.8           # share of the content's text that its container holds at least

# a quoted value ends before the next "<", so that an unclosed quote is not searched for to the end of the page
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"'<]+|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OWN_TEXT = HEADINGS | frozenset("p blockquote pre".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")


class Element:
    """An open tag: its path as a number, and what holds for all below it."""
    __slots__ = ("tag", "path", "parent", "cut", "weight", "heading", "article", "number", "depth")

    def __init__(self, tag: str, path: int, parent: Element | None, number: int):
        self.tag, self.path, self.parent, self.number = tag, path, parent, number
        self.cut, self.weight, self.heading, self.article, self.depth = False, 1.0, tag in HEADINGS, None, 0
        if parent:
            self.cut, self.weight, self.depth = parent.cut, parent.weight, parent.depth + 1
            self.heading = self.heading or parent.heading
            # the innermost: an article in an article is one of its own
            self.article = self if tag in ("article", "main") else parent.article


def doubtful(value: str) -> bool:
    """Whether a class or id value has a name of boilerplate: its last word, or
    one of its words beside plain ones."""
    for name in value.split():
        words = WORD.findall(name)
        if words and (words[-1] in NOISE or NOISE.intersection(words) and all(w in NOISE or w in PLAIN for w in words)):
            return True
    return False


def kind_of(tag: str, attributes: str, article: bool) -> tuple[bool, float, str]:
    """Of an element inside or outside an article: is it none by tag or role, the
    weight of its score, its class names for the path. A header inside an article is the article's own."""
    if tag in SKIPPED:
        return True, 1.0, ""
    label, cut, weight = "", tag == "header" and not article, 1.0
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "class":
            label = ".".join(sorted(value.split()))
        if name in ("class", "id"):
            if tag not in ("body", "html", "main", "article") and not (article and "header" in WORD.findall(value)) and doubtful(value):
                weight = DOUBT_TEXT if article and tag in OWN_TEXT else DOUBT
        elif name == "role":
            cut = cut or value in ROLES
        else:
            cut = cut or value == "true"
    return cut, weight, label


Node = tuple[Element, str, int, int]  # element, text, block, number of the link it is in (0: none)


def text_nodes(page: str) -> tuple[list[Node], list[Element]]:
    """The text nodes of a page and its elements, in order."""
    root = Element("#", 0, None, 0)
    stack, nodes, elements, block = [root], [], [root], 0
    paths: dict[tuple[int, str, str], int] = {}
    open_tags: dict[str, int] = {}
    links: list[int] = []  # open ones
    at, end, last_cdata = 0, len(page), True

    def close(i: int) -> None:
        for e in stack[i:]:
            open_tags[e.tag] -= 1
            if e.tag == "a":
                links.pop()
        del stack[i:]

    def text(piece: str) -> None:
        if piece and not stack[-1].cut:
            nodes.append((stack[-1], html_entities.unescape(piece), block, links[-1] if links else 0))

    while at < end:
        start = page.find("<", at)
        if start < 0 or page.find(">", start) < 0 and not page.startswith("<!--", start):
            text(page[at:])  # no tag ends from here on
            break
        text(page[at:start])
        at = start
        if page.startswith("<!--", at):
            found = page.find("-->", at + 4)
            at = found + 3 if found >= 0 else end
            continue
        if last_cdata and page.startswith("<![CDATA[", at):
            found = page.find("]]>", at)
            if found >= 0:
                at = found + 3
                continue
            last_cdata = False  # none ends from here on
        if page.startswith(("<!", "<?"), at):
            at = page.find(">", at) + 1
            continue
        m = TAG.match(page, at)
        if m is None:
            text("<")
            at += 1
            continue
        at = m.end()
        closing, attributes, tag = m.group(1) or m.group(4), m.group(3) or m.group(6) or "", (m.group(2) or m.group(5)).lower()
        if tag not in INLINE and (tag not in VOID or tag in ("br", "hr")):
            block += 1
        if closing:
            for i in range(len(stack) - 1, 0, -1) if open_tags.get(tag) else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in SCOPE and (tag in INLINE or tag == "p"):
                    break
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in CLOSED_BY_SAME:
            ends = {"p"} if tag in CLOSES_P else {tag}
            ends |= {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th", "tr") else set()
            for i in range(len(stack) - 1, 0, -1) if any(open_tags.get(t) for t in ends) else ():
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        parent = stack[-1]
        cut, weight, label = kind_of(tag, attributes, parent.article is not None)
        element = Element(tag, paths.setdefault((parent.path, tag, label), len(paths) + 1), parent, len(elements))
        element.cut, element.weight = element.cut or cut, min(element.weight, weight)
        elements.append(element)
        stack.append(element)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if tag == "a":
            links.append(element.number)
        if tag in RAW and not attributes.endswith("/"):  # its content is text up to the end tag
            found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            close(len(stack) - 1)
            at = found.end() if found else end
    return nodes, elements


def content_score(nodes: list[Node]) -> np.ndarray:
    """Smoothed, fused and weighed ratios of every node's path."""
    paths: dict[int, list[float]] = {}
    for element, text, _, link in nodes:
        length = len(text.strip())
        sums = paths.setdefault(element.path, [0.0, 0.0, 0.0, 0.0])
        sums[0] += 1
        sums[1] += length
        sums[2] += len(PUNCTUATION.findall(text))
        sums[3] += length * bool(link)
    ratio = {p: (chars / n, marks / n, 1 - linked / chars if chars else 0.0) for p, (n, chars, marks, linked) in paths.items()}
    lengths, marks, plain = np.array([ratio[e.path] for e, *_ in nodes]).T
    reach = np.arange(-3, 4)
    window = np.exp(-0.5 * (reach / SMOOTH) ** 2)
    weight = np.convolve(np.ones(len(nodes)), window, "same")[:len(nodes)] if len(nodes) >= 7 else None

    def smooth(x):
        if weight is not None:
            return np.convolve(x, window, "same") / weight
        far = np.exp(-0.5 * (np.subtract.outer(np.arange(len(x)), np.arange(len(x))) / SMOOTH) ** 2)
        return far @ x / far.sum(axis=1)

    return smooth(lengths) * (1 + smooth(marks)) * plain * np.array([e.weight for e, *_ in nodes])


def around(element: Element, known: dict[Element, Element]) -> Element:
    """The article around an element, else what holds heading and neighbours of a lone paragraph, quote, list or table."""
    if element.article is not None:
        return element.article
    passed = []
    while element.parent is not None and element.tag in WRAPS and element not in known:
        passed.append(element)
        element = element.parent
    top = known.get(element, element)
    known.update((e, top) for e in passed)
    return top


def held(nodes: list[Node], elements: list[Element], chosen: np.ndarray) -> np.ndarray:
    """Which nodes are read, from the chosen ones (positions in ``nodes``)."""
    sizes = [0] * len(elements)
    for i in chosen:
        sizes[nodes[i][0].number] += max(len(nodes[i][1].strip()), 1)
    for element in reversed(elements[1:]):  # children come after their parents
        sizes[element.parent.number] += sizes[element.number]
    total, known = sizes[0], {}
    common = max((e for e in elements if sizes[e.number] == total), key=lambda e: e.depth)
    inside = np.zeros(len(nodes), bool)
    if around(common, known).tag in ("article", "main"):
        whole = {around(common, known)}
    else:
        core = around(max((e for e in elements if sizes[e.number] >= COVER * total), key=lambda e: (e.depth, -e.number)), known)
        outer, element = set(), core.parent
        while element is not None:
            outer.add(element)
            element = element.parent
        whole = {core} | ({around(nodes[i][0], known) for i in chosen} - outer)
        inside[chosen[0]:chosen[-1] + 1] = True
    read = [False] * len(elements)
    for element in elements:
        read[element.number] = element in whole or element.parent is not None and read[element.parent.number]
    return inside | np.array([read[e.number] for e, *_ in nodes], bool)


def with_headings(nodes: list[Node], inside: np.ndarray) -> np.ndarray:
    """Headings before what is read, with the lines (by whom, when) between; not past a line of links."""
    size, linked = {}, {}
    for _, text, block, link in nodes:
        size[block] = size.get(block, 0) + len(text.strip())
        linked[block] = linked.get(block, 0) + len(text.strip()) * bool(link)
    first = at = int(np.argmax(inside))
    for i in range(at - 1, -1, -1):
        element, text, block, _ = nodes[i]
        if text.strip() and element.heading:
            first = i
        elif linked[block] > LINK_SHARE * size[block]:
            break
    inside[first:at] = True
    return inside


def without_link_runs(lines: list[tuple[str, bool, bool, int]]) -> list[str]:
    """Lines (text, mostly links, heading, number of links) without runs of lines
    that hold two links or more, unless the run stands below a heading."""
    out, i, below_heading = [], 0, False
    while i < len(lines):
        line, linked, heading, _ = lines[i]
        end = i + 1
        if linked and not heading:
            while end < len(lines) and lines[end][1] and not lines[end][2]:
                end += 1
            if below_heading or sum(x[3] for x in lines[i:end]) < 2:
                out += [x[0] for x in lines[i:end]]
        else:
            out.append(line)
        below_heading, i = heading, end
    return out


def main_text(page: str | None) -> str:
    """The article of a page as one line of text."""
    nodes, elements = text_nodes(page or "")
    full = [i for i, n in enumerate(nodes) if n[1].strip()]
    if not full:
        return ""
    score = content_score([nodes[i] for i in full])
    limit = min(score.mean() + SPREAD * score.std(), score.max())
    inside = with_headings(nodes, held(nodes, elements, np.array(full)[score >= limit]))
    for i, own in zip(full, score):
        inside[i] &= nodes[i][0].weight == 1 or own >= limit / 2
    blocks: dict[int, list[tuple[str, int, bool]]] = {}
    for (element, text, block, link), read in zip(nodes, inside):
        if read:
            blocks.setdefault(block, []).append((text, link, element.heading))
    lines = []
    for pieces in blocks.values():
        line = " ".join("".join(t for t, *_ in pieces).split())
        if line:
            linked = sum(len(t.strip()) for t, link, _ in pieces if link)
            lines.append((line, linked > LINK_SHARE * len(line), any(h for *_, h in pieces), len({link for _, link, _ in pieces if link})))
    return " ".join(without_link_runs(lines))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship_by_value(sys.modules[__name__])
    rows = pages.select(quoted(page_id).alias("page_id"), quoted(url).alias("url"), quoted(html).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
