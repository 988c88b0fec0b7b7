"""HTML extraction by a tree-structured graphical model.

A page becomes a tree of nodes (block-level elements, and any element whose class or id tells its
role), each content or not.  A node's own evidence (tag, class and id words, length and link share
of its text) and a parent-child potential are learned from labelled pages; sum-product messages pass
up and down the tree once each, and a node's text is kept if its marginal is at least one half.

Training pages are the written ones below (``TRAINING_PAGES``, ``c`` marks content nodes) and a bounded
sample (about ``sample_rows``, drawn by hash) of the pages given, labelled by their own article and main elements.

Text inside a block has its character references decoded and its white space made one space; blocks
are joined in page order by one space.  Scripts, styles, the head and form controls hold no text of
the page; formulas, drawings and fallback text belong to the block they stand in.  A class or id counts as a
hint at boilerplate only if nothing else is named in it.  Defined cases: a null or empty html gives an empty text; broken markup is read as far as it
goes (an unclosed element ends with its parent, an unclosed tag or comment with the page); repeated
rows each get their result; the whole html is read whatever its length; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 400
PRIOR = 0.1  # pseudo-count of every feature and transition
SEED = 5

# Element roles of HTML.
INLINE = frozenset(
    "a abbr acronym annotation audio b bdi bdo big canvas cite code data del dfn em font i img ins kbd label map mark math meter mfrac "
    "mi mn mo mover mrow ms mspace msqrt mstyle msub msubsup msup mtext munder nobr noscript object output picture q rp rt ruby s samp "
    "semantics small span strike strong sub sup svg time tspan tt u var video wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea|template|iframe"  # what they hold is no text of the page
CONTROLS = frozenset("button select option datalist".split())  # parts of forms; one that is not closed ends with its parent
CLOSES = {  # an opening tag ends an open element of these
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"},
}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
SCOPES = frozenset("article aside body div footer form header html main nav section table td th li ul ol blockquote".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie "
    "cookies copyright disqus dialog disclaimer footer foot gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pagination paywall popup popover promo promoted promotion recommend recommended related reply replies respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget alert".split()
)
# Words that say nothing by themselves: a name made of these and of boiler words is a boiler name.
NEUTRAL_WORDS = frozenset(
    "area articles aside bar block body bottom box btn button buttons class col column container content div el element first form global group "
    "header home id inner item items js last layout left links list main module more new news outer page panel post posts primary right "
    "row section secondary site small stories text the thread top user users wrap wrapper".split()
)
CONTENT_WORDS = frozenset("article articlebody body content entry main mainbody maincontent post postbody story storybody text".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b[^>]*?(?:/>|>.*?(?:</\1\b[^>]*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
HINTS = re.compile(r"""\b(class|id|role|data-c)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
ROLES = frozenset("article main nav aside footer header form".split())
TOP = frozenset(("page", "html", "body"))
SPLIT = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

TRAINING_PAGES = (  # fixed values: labelled pages
    '<body><header class="site-header"><div>Daily Paper</div><nav><ul><li><a href=1>Home</a></li><li><a href=2>World</a></li></ul></nav></header>'
    '<main data-c=1><article data-c=1><h1 data-c=1>A long title about the news</h1><p data-c=1>The first paragraph tells what happened, and where.</p>'
    '<p data-c=1>The second one, with a <a href=3>link</a> in it, goes on at some length about the same matter.</p>'
    '<aside class="related"><h3>Related</h3><ul><li><a href=4>Another story</a></li></ul></aside><blockquote data-c=1><p data-c=1>What was said.</p></blockquote>'
    '<ul data-c=1><li data-c=1>One point of the list.</li><li data-c=1>Another point of it.</li></ul></article></main>'
    '<section class="comments" id="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with any of this, said a reader.</p></div>'
    '<form><p>Write a comment</p></form></section><div><p>Offers of our partners this week</p></div><footer><p>Copyright the paper</p></footer></body>',
    '<body><header><h1>The site</h1><h2>A motto</h2><ul><li><a href=9>x</a></li></ul></header><div id="cookie-notice"><p>We use cookies to make this site work.</p></div><div class="menu"><ul><li><a href=1>Start</a></li></ul></div>'
    '<div id="content" data-c=1><div class="post" data-c=1><h2 data-c=1>Notes of a journey</h2><div data-c=1>Plain text in a division, which runs on for a while.</div>'
    '<p data-c=1>Then a paragraph.</p><div class="ad">Buy this now</div><p data-c=1>And one more, at the end of it.</p><table data-c=1><tr data-c=1><td data-c=1>1 kg</td></tr></table>'
    '</div></div><div class="sidebar"><p>About the author, in some words.</p></div><div id="footer"><h3>Contact</h3><p>All rights reserved</p><ul><li>x</li></ul></div></body>',
    '<body><nav><a href=1>a</a> <a href=2>b</a></nav><p>You are here.</p><aside><h1>Aside</h1><p>A note at the side of the page.</p></aside><article data-c=1><header><p>By someone, in May</p></header>'
    '<h1 data-c=1>Title</h1><section data-c=1><h2 data-c=1>Part one</h2><p data-c=1>Text of the part.</p><figure data-c=1><figcaption data-c=1>A caption.</figcaption></figure></section>'
    '<section data-c=1><p data-c=1>More of it.</p><pre data-c=1>x = 1</pre></section><form class="newsletter"><p>Sign up for our letter</p></form>'
    '<footer><p>Filed under things</p></footer></article><div role="alert"><p>This site will be down on Monday.</p></div></body>',
    '<body><div data-c=1><div data-c=1><p data-c=1>A bare page has only paragraphs that hold some sentences each.</p><p data-c=1>Nothing else tells their role, but they are long.</p></div></div></body>',
)


class Node:
    __slots__ = ("parent", "tag", "hints", "label", "kids", "length", "links")

    def __init__(self, parent: int, tag: str, hints: frozenset[str], label: bool):
        self.parent, self.tag, self.hints, self.label = parent, tag, hints, label
        self.length = self.links = 0


def boiler_name(value: str) -> bool:
    """Whether one of the names in a class or id says boiler and nothing else: ``cookie-notice``, ``site-footer``,
    ``ad``; not ``ad-hoc``, ``comment-on-law``."""
    for name in value.split():
        words = {w for w in SPLIT.split(CAMEL.sub(" ", name).lower()) if w}
        if words & BOILER_WORDS and words <= BOILER_WORDS | NEUTRAL_WORDS:
            return True
    return False


def _hints(attributes: str) -> tuple[frozenset[str], bool]:
    found, label = set(), False
    for name, value in HINTS.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "data-c":
            label = True
            continue
        words = set(SPLIT.split(CAMEL.sub(" ", value).lower()))
        if name == "role":
            found |= {"boiler"} if words & BOILER_ROLES else {"content"} if words & {"main", "article"} else set()
        else:
            found |= ({"boiler"} if boiler_name(value) else set()) | ({"content"} if words & CONTENT_WORDS else set())
    return frozenset(found), label


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (parents first; node 0 is the page) and pieces (node, text) in page order.
    Block boundaries come as (node, None) pieces."""
    nodes, pieces = [Node(-1, "page", frozenset(), False)], []
    stack: list[tuple[str, int]] = [("page", 0)]  # open nodes
    controls = "<button" in (low := page.lower()) or "<select" in low or "<option" in low or "<datalist" in low
    links, hidden, at = 0, 0, 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not hidden and not (controls and any(t in CONTROLS for t, _ in stack)):
            pieces.append((stack[-1][1], page[at : m.start()], links > 0))
        at = m.end()
        if m[3] is None and m[6] is None:
            continue
        closing, tag, rest = (m[2], m[3], m[4]) if m[3] is not None else (m[5], m[6], m[7])
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "head":
                hidden = 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pieces.append((stack[depth][1], None, False)) if tag not in INLINE else None
                    del stack[depth:]
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break  # an inline end tag does not close a block
            continue
        if tag == "head":
            hidden = 1
            continue
        if tag in ("body", "article", "main", "div", "p"):
            hidden = 0
        if tag in INLINE and tag != "a" and "=" not in rest:
            continue
        if tag in VOID:
            if tag not in INLINE:
                pieces.append((stack[-1][1], None, False))
            continue
        if tag == "a":
            links += 1
        hints, label = _hints(rest) if "=" in rest else (frozenset(), False)
        if tag in INLINE and not hints:
            continue
        ends = CLOSES.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else set())
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in ends:
                del stack[depth:]
                break
            if stack[depth][0] in SCOPES:
                break
        if tag not in INLINE:
            links = 0
            pieces.append((stack[-1][1], None, False))
        nodes.append(Node(stack[-1][1], tag, hints, label))
        stack.append((tag, len(nodes) - 1))
    if at < len(page) and not hidden and not any(t in CONTROLS for t, _ in stack):
        pieces.append((stack[-1][1], page[at:], links > 0))
    for node, text, linked in pieces:
        if text:
            n = len(text) - text.count(" ") if len(text) < 200 else len(text)
            nodes[node].length += n
            nodes[node].links += n if linked else 0
    for i in range(len(nodes) - 1, 0, -1):  # subtree sums for link shares
        nodes[nodes[i].parent].links += nodes[i].links
        nodes[nodes[i].parent].length += nodes[i].length
    return nodes, pieces


def features(node: Node) -> tuple[str, ...]:
    share = 0 if not node.length else min(3, int(4 * node.links / node.length))
    size = 0 if not node.length else min(4, int(math.log(node.length + 1, 5)))
    return ("tag=" + node.tag, f"text={size}/{share}", *("hint=" + h for h in node.hints))


def kinds(nodes: list[Node]) -> list[int]:
    """How a node hangs on its parent: 0 in a role of its own, 1 plainly, 2 plainly at the top of a page
    that has an article or main element, 3 at the top of one that has none."""
    main = any(node.tag in ("article", "main") for node in nodes)
    return [
        0 if node.tag in ROLES or node.hints else 1 if nodes[node.parent].tag not in TOP else 1 if node.tag in TOP else 2 if main else 3
        for node in nodes
    ]


class TreeModel:
    """Log-odds of features, and potentials of a child's state given its kind and its parent's state."""

    def __init__(self, pages: Iterable[list[Node]]):
        seen = [Counter(), Counter()]
        states = [PRIOR, PRIOR]
        steps = [[[PRIOR, PRIOR], [PRIOR, PRIOR]] for _ in range(4)]
        for nodes in pages:
            for node, kind in zip(nodes[1:], kinds(nodes)[1:], strict=True):
                state = int(node.label)
                states[state] += 1
                steps[kind][int(nodes[node.parent].label)][state] += 1
                seen[state].update(features(node))
        self.odds = {
            f: math.log((seen[1][f] + PRIOR) / states[1]) - math.log((seen[0][f] + PRIOR) / states[0]) for f in set(seen[0]) | set(seen[1])
        }
        self.steps = [[[x / sum(row) for x in row] for row in table] for table in steps]
        self.known: dict[tuple[str, ...], float] = {}

    def evidence(self, node: Node) -> float:
        """exp(log-odds) of content, held within e-12 and e12."""
        key = features(node)
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            odds = sum(self.odds.get(f, 0.0) for f in key)
            if "hint=boiler" in key and "hint=content" not in key:
                odds = min(odds, -4.0)
            self.known[key] = math.exp(max(-12.0, min(12.0, odds)))
        return self.known[key]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of every node: messages from the leaves up, then from the root down."""
        n, kind = len(nodes), kinds(nodes)
        up0, up1 = [1.0] * n, [1.0] * n  # evidence below and at the node
        to0, to1 = [1.0] * n, [1.0] * n  # message to the parent
        for i in range(n - 1, 0, -1):
            b0, b1 = up0[i], up1[i] * self.evidence(nodes[i])
            s = b0 + b1
            b0, b1 = b0 / s, b1 / s
            up0[i], up1[i] = b0, b1
            (t00, t01), (t10, t11) = self.steps[kind[i]]
            m0, m1 = t00 * b0 + t01 * b1, t10 * b0 + t11 * b1
            to0[i], to1[i] = m0, m1
            p = nodes[i].parent
            up0[p] *= m0
            up1[p] *= m1
            if up0[p] + up1[p] < 1e-200:
                up0[p], up1[p] = up0[p] * 1e150, up1[p] * 1e150
        out = [0.0] * n  # the page itself is not content; its children hang under state 0
        for i in range(1, n):
            p = nodes[i].parent
            if p == 0:
                q0, q1 = 1.0, 0.0
            else:  # the parent's belief without this child's message
                q1, q0 = out[p] / max(to1[i], 1e-300), (1 - out[p]) / max(to0[i], 1e-300)
                s = q0 + q1
                q0, q1 = q0 / s, q1 / s
            (t00, t01), (t10, t11) = self.steps[kind[i]]
            b0, b1 = up0[i] * (q0 * t00 + q1 * t10), up1[i] * (q0 * t01 + q1 * t11)
            out[i] = b1 / (b0 + b1)
        return out


def extract(page: str | None, model: TreeModel) -> str:
    if not page:
        return ""
    nodes, pieces = parse(page)
    kept = [x >= 0.5 for x in model.marginals(nodes)]
    out = []
    for node, text, _ in pieces:
        if text is None:
            out.append(" ")
        elif kept[node]:
            out.append(entities.unescape(text) if "&" in text else text)
        else:
            out.append(" ")
    return " ".join("".join(out).split())


def label_by_structure(nodes: list[Node]) -> bool:
    """Label nodes inside article and main elements; False if the page has none."""
    off = {"nav", "header", "footer", "aside", "form", "head"}
    for node in nodes[1:]:
        parent = nodes[node.parent]
        out = node.tag in off or "boiler" in node.hints
        node.label = not out and (node.tag in ("article", "main") or (parent.label and node.parent != 0))
    return any(node.label for node in nodes)


def train(sample: Iterable[str]) -> TreeModel:
    written = [parse(page)[0] for page in TRAINING_PAGES] * 5
    given = [nodes for nodes in (parse(page)[0] for page in sample) if label_by_structure(nodes)]
    return TreeModel(written + given)


def extract_pages(pages: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", "html")
    share = sample_rows / max(rows.count(), 1)
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "page_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = rows.where("html is not null").where(drawn).orderBy("page_id", F.xxhash64("html")).select("html").limit(2 * sample_rows)  # a draw of about sample_rows by hash
    model = train(r["html"] for r in sample.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, model) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
