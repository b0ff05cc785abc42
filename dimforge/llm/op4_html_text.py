"""HTML extraction: boosted trees over block nodes, decoded along the tree.

A page is parsed into a tree of block-level elements; inline elements belong to the
block around them.  Each node has features of its tag, attributes, position, subtree
and siblings.  Boosted trees give a log-odds of being part of the article.  Decoding
keeps the set of nodes of greatest total score in which no node is kept under a dropped
ancestor.  Text runs of kept nodes, in page order, are the article.

The trees learn from two bounded sets: generated pages of many layouts, and at most
about ``SAMPLE_PAGES`` pages of the table that name their article by an element of that
meaning (drawn by a hash of id and html; equal rows count once).

Defined results: NULL or text-free html gives an empty text; broken or cut-off markup is
read as far as it goes; repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches
from dimforge.llm.gbt import train_trees, tree_logits

SAMPLE_PAGES = 300
GENERATED_PAGES = 400

# HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())  # their content is no markup; without an end tag they reach the page's end
UNSEEN = frozenset("noscript template title svg iframe object textarea select canvas annotation".split())
MATH = frozenset("""math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mtable
mtr mtd mstyle mspace mpadded mphantom menclose mfenced mmultiscripts mprescripts none""".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()) | MATH
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead select body html".split())
GOOD = frozenset("article articlebody main content maincontent entry post postbody body story text page prose blog".split())
BAD = frozenset("""nav navbar navigation menu header masthead footer foot sidebar side aside ad ads advert advertisement
adbox sponsor sponsored promo banner cookie cookies consent notice alert popup modal overlay comment comments reply
replies disqus discussion share sharing social related recommended recommend more newsletter subscribe subscription
signup login form search breadcrumb breadcrumbs crumbs widget tags pagination pager legal copyright disclaimer toolbar
skip hidden gdpr paywall rating teaser""".split())
BAD_TAGS = frozenset("nav header footer aside form menu dialog button".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>?|<[!?][^>]*+>?""", re.S)
_NAMED = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_TAGS = {t: i for i, t in enumerate("div section article main p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd td th tr table blockquote pre figure figcaption body nav header footer aside form".split(), 1)}
_END_RAW: dict[str, re.Pattern] = {}


class Node:
    __slots__ = ("tag", "parent", "depth", "kids", "words", "hidden", "own", "linked", "start", "blocks")

    def __init__(self, tag, parent, words, hidden, start):
        self.tag, self.parent, self.words, self.hidden, self.start = tag, parent, words, hidden, start
        self.depth = parent.depth + 1 if parent else 0
        self.kids, self.own, self.linked, self.blocks = [], 0, 0, 0


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block nodes in page order (parents first) and text runs (node, text)."""
    root = Node("html", None, (), False, 0)
    nodes, runs = [root], []
    stack: list[tuple[str, Node]] = [("html", root)]  # open elements, inline ones with the block around them
    pieces: list[str] = []
    links = at = 0
    linked = 0
    no_end: dict[str, bool] = {}

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                node = stack[-1][1]
                if node is root:  # text outside every element is a block of its own
                    node = Node("p", root, (), False, at)
                    root.kids.append(node)
                    nodes.append(node)
                node.own += len(text)
                node.blocks += 1
                node.linked += min(linked, len(text))
                runs.append((node, text))
            pieces, linked = [], 0

    def text_until(end):
        nonlocal linked
        if end > at:
            text = html_lib.unescape(page[at:end])
            pieces.append(text)
            if links:
                linked += len(text.strip())

    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text_until(size)
            break
        text_until(m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag == "br":
                pieces.append(" ")
            elif depth:
                if tag in INLINE and any(t not in INLINE for t, _ in stack[depth + 1:]):
                    continue  # an inline end tag does not close blocks
                if any(t not in INLINE for t, _ in stack[depth:]):
                    flush()
                links -= sum(t == "a" for t, _ in stack[depth:])
                del stack[depth:]
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                pieces.append(" " if tag == "br" else "")
            continue
        if tag in RAW or tag in UNSEEN:
            closed = tag in UNSEEN and m[0].endswith("/>")  # <svg .../>
            # a later end tag of its own kind; looked for once where the page has none
            end = None if closed or no_end.get(tag) else _END_RAW.setdefault(tag, re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)).search(page, at)
            if not closed and end is None:
                no_end[tag] = True
            if end:
                at = end.end()
            elif tag in RAW:
                at = size
            continue  # an unseen element without an end tag hides nothing
        if tag in INLINE:
            links += tag == "a"
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        closing = {"p"} if tag in CLOSES_P else PEERS.get(tag, set())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in closing:
                links -= sum(t == "a" for t, _ in stack[k:])
                del stack[k:]
                if tag not in PEERS:
                    break
            elif k < len(stack) and stack[k][0] in SCOPES or (stack[k][0] not in INLINE and tag in CLOSES_P):
                break
        words, hidden = (), False
        if m[3] and len(m[3]) > 1:
            words = tuple(w.lower() for g in _NAMED.findall(m[3]) for w in _SPLIT.split(next(filter(None, g), "")) if w)
            low = m[3].lower()
            hidden = "display:none" in low.replace(" ", "") or re.search(r"\shidden(\s|=|$)", low) is not None
        node = Node(tag, stack[-1][1], words, hidden, m.start())
        node.parent.kids.append(node)
        nodes.append(node)
        stack.append((tag, node))
    flush()
    return nodes, runs


def node_features(nodes: list[Node], size: int) -> np.ndarray:
    """One feature row per node."""
    n = len(nodes)
    place = {id(v): i for i, v in enumerate(nodes)}
    length, linked, count = [v.own for v in nodes], [v.linked for v in nodes], [1] * n
    blocks = [v.blocks for v in nodes]
    for i in range(n - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        length[up] += length[i]
        linked[up] += linked[i]
        count[up] += count[i]
        blocks[up] += blocks[i]
    # place among the siblings, and siblings per tag, for all children of a parent at once
    spot, alike = [0] * n, [1] * n
    for v in nodes:
        tags = Counter(p.tag for p in v.kids)
        for k, p in enumerate(v.kids):
            spot[place[id(p)]], alike[place[id(p)]] = k, tags[p.tag]
    rows = []
    inherited = [(0, 0, 0, 0)] * n
    total = max(1, length[0])
    for i, v in enumerate(nodes):
        good, bad = sum(w in GOOD for w in v.words), sum(w in BAD for w in v.words) + 2 * v.hidden
        up = place[id(v.parent)] if v.parent else 0
        g, b, t, a = inherited[up] if v.parent else (0, 0, 0, 0)
        mine = (g + good, b + bad, t + (v.tag in BAD_TAGS), a + (v.tag in ("article", "main")))
        inherited[i] = mine
        peers = v.parent.kids if v.parent else [v]
        rows.append((
            _TAGS.get(v.tag, 0), v.depth, good, bad, *mine, np.log1p(length[i]), np.log1p(v.own), linked[i] / max(1, length[i]),
            length[i] / count[i], length[i] / max(1, blocks[i]), length[i] / total, np.log1p(count[i]), spot[i], len(peers), alike[i],
            v.start / max(1, size), length[up] / total, linked[up] / max(1, length[up]), length[up] / max(1, count[up]), len(v.kids)))
    return np.array(rows, np.float64)


def decode(nodes: list[Node], logits: np.ndarray) -> np.ndarray:
    """Kept flags of greatest total score with no kept node under a dropped one."""
    place = {id(v): i for i, v in enumerate(nodes)}
    worth = logits * np.array([1 + np.sqrt(v.own) for v in nodes])
    worth[0] = 0.0  # the page itself
    best = worth.copy()
    for i in range(len(nodes) - 1, 0, -1):
        best[place[id(nodes[i].parent)]] += max(0.0, best[i])
    kept = np.zeros(len(nodes), bool)
    kept[0] = True
    for i in range(1, len(nodes)):
        kept[i] = kept[place[id(nodes[i].parent)]] and best[i] > 0
    return kept


def article_text(parsed, logits: np.ndarray) -> str:
    nodes, runs = parsed
    keep = {id(v) for v, k in zip(nodes, decode(nodes, logits)) if k}
    if len(nodes) == len(runs) + 1 and all(v.parent is nodes[0] and v.start for v, _ in runs) and not any(v.words for v in nodes):
        keep |= {id(v) for v, _ in runs} if len(runs) == 1 else set()  # a page of one plain text is that text
    return "\n\n".join(t for v, t in runs if id(v) in keep)


def _inside(node: Node, test) -> bool:
    while node is not None:
        if test(node):
            return True
        node = node.parent
    return False


def named_labels(nodes: list[Node]) -> list[int] | None:
    """Labels of a page that names exactly one article element; None for others."""
    tops = [v for v in nodes if v.tag in ("article", "main") and not _inside(v.parent, lambda u: u.tag in ("article", "main"))]
    if len(tops) != 1:
        return None
    bad = lambda u: u.tag in BAD_TAGS or u.hidden or any(w in BAD for w in u.words)
    above = set()
    up = tops[0].parent
    while up is not None:
        above.add(id(up))
        up = up.parent
    return [1 if id(v) in above or (_inside(v, lambda u: u is tops[0]) and not _inside(v, bad)) else 0 for v in nodes]


def generated_page(rng: random.Random) -> str:
    """A page of a random layout; elements of the article carry the attribute ``data-main``."""
    word = lambda: "".join(rng.choice("th er on an in re le que ion ent de ra el os ga".split()) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda n, tag="li": "".join(f'<{tag}><a href="/{word()}">{words(1, 3)}</a></{tag}>' for _ in range(n))
    named = lambda *names: f'{rng.choice(["class", "id"])}="{rng.choice(names)}"'
    main = lambda tag, inner, extra="": f"<{tag} data-main {extra}>{inner}</{tag}>"

    def paragraph():
        kind = rng.random()
        text = words(3, 120) + "."
        if kind < 0.1:
            return f"<ul data-main>{''.join(main('li', words(2, 15)) for _ in range(rng.randint(2, 6)))}</ul>"
        if kind < 0.16:
            return main("blockquote", main("p", text))
        if kind < 0.26:
            return main(rng.choice(["h2", "h3"]), words(1, 8))
        if kind < 0.3:
            return f"<table data-main><tr data-main>{main('td', words(1, 6))}{main('td', words(1, 6))}</tr></table>"
        if kind < 0.45:
            cut = text.split(" ", 3)
            text = f'{cut[0]} <a href="/x">{" ".join(cut[1:3])}</a> {" ".join(cut[3:])}'
        return f"<p data-main>{'<b>' if rng.random() < 0.2 else ''}{text}" + ("</p>" if rng.random() < 0.9 else "<br>")

    body = main("h1", words(2, 12)) + "".join(paragraph() for _ in range(rng.choice([1, 2, 3, 5, 9, 15])))
    if rng.random() < 0.25:
        spot = rng.choice(["ad", "advert", "promo", "related", "share", "newsletter"])
        body += f'<div class="{spot}">{rng.choice([words(2, 20), links(4, "p")])}</div>' + paragraph()
    holder = rng.choice(["article", "article", "main", "div", "div", "section"])
    body = main(holder, body, "" if holder in ("article", "main") and rng.random() < 0.6 else named("content", "post", "entry-content", "article-body", "main", "story", "text", "x7", "wrap"))
    page = []
    if rng.random() < 0.8:
        page.append(rng.choice(["<nav><ul>%s</ul></nav>", "<nav>%s</nav>", '<div class="menu"><ul>%s</ul></div>', '<div id="navbar">%s</div>', "<header><ul>%s</ul></header>"]) % links(rng.randint(3, 9)))
    if rng.random() < 0.4:
        page.append(f"<header {named('top', 'masthead', 'site-header')}><h1>{words(1, 4)}</h1><p>{words(2, 10)}</p></header>")
    if rng.random() < 0.3:
        page.append(f"<div {named('cookie-banner', 'notice', 'consent', 'alert')}><p>{words(5, 40)}</p><button>{word()}</button></div>")
    if rng.random() < 0.6:
        page.append(f"<div {named('ad', 'ads', 'advert', 'sponsored', 'banner-ad')}>{words(2, 30)}</div>")
    if rng.random() < 0.4:
        page.append(f"<aside><h3>{words(1, 3)}</h3><ul>{links(rng.randint(2, 8))}</ul><p>{words(3, 30)}</p></aside>")
    if rng.random() < 0.2:
        page.append(f"<div {named('sidebar', 'widget')}><p>{words(4, 40)}</p>{links(4, 'p')}</div>")
    if rng.random() < 0.25:
        page.append(f"<form action='/s'><label>{words(1, 5)}</label><input><p>{words(2, 12)}</p></form>")
    rng.shuffle(page)
    cut = rng.randint(0, len(page))
    after = [f"<{t} {named('comments', 'replies', 'comment-list', 'discussion')}><h3>{words(1, 3)}</h3>" + "".join(
        f'<div class="comment"><p>{words(3, 60)}</p></div>' for _ in range(rng.randint(1, 6))) + f"</{t}>" for t in [rng.choice(["div", "section", "ul"])] if rng.random() < 0.45]
    if rng.random() < 0.85:
        after.append(rng.choice(["<footer>%s</footer>", "<footer><p>%s</p></footer>", '<div class="footer"><p>%s</p></div>']) % ("&copy; " + words(2, 25)))
    inner = "".join(page[:cut]) + body + "".join(page[cut:]) + "".join(after)
    if rng.random() < 0.4:
        inner = f"<div data-main {named('page', 'wrapper', 'container')}>{inner}</div>"
    return f"<html><body data-main>{inner}</body></html>"


def generated_labels(page: str, nodes: list[Node]) -> list[int]:
    return [1 if v.parent is None or page[v.start:page.find(">", v.start)].find("data-main") >= 0 else 0 for v in nodes]


def train(sample: list[str]) -> dict:
    """Trees from generated pages and from those sample pages that name their article."""
    rng = random.Random(4)
    rows, labels, weights = [], [], []
    for k, page in enumerate([generated_page(rng) for _ in range(GENERATED_PAGES)] + sample):
        nodes, _ = parse(page)
        y = generated_labels(page, nodes) if k < GENERATED_PAGES else named_labels(nodes)
        if y is not None:
            rows.append(node_features(nodes, len(page)))
            labels += y
            weights += [1 + np.sqrt(v.own) / 10 for v in nodes]
    return train_trees(np.concatenate(rows), np.array(labels, float), np.array(weights))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages(page_id, url, html)``."""
    bounded_batches(pages.sparkSession)
    share = min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    draw = F.xxhash64(F.col("page_id").cast("long"), "html", F.lit(4))
    drawn = pages.filter("html is not null").select(draw.alias("draw"), "html").filter(F.shiftrightunsigned("draw", 11) / float(1 << 53) < share)
    # about SAMPLE_PAGES pages; rows that repeat a page or an id are drawn once or apart
    sample = sorted(r.html for r in drawn.groupBy("draw").agg(F.first("html").alias("html")).collect())
    shared = pages.sparkSession.sparkContext.broadcast(train(sample))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = []
            for a in range(0, batch.num_rows, 32):
                pages = [p.as_py() or "" for p in batch.column(2)[a:a + 32]]
                parsed = [parse(p) for p in pages]
                x = [node_features(nodes, len(p)) for (nodes, _), p in zip(parsed, pages)]
                scores = np.split(tree_logits(model, np.concatenate(x)), np.cumsum([len(v) for v in x])[:-1])
                texts += [article_text(d, s) for d, s in zip(parsed, scores)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string")
