"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements are inner nodes, runs of text between block
borders are leaves. Every node is in the main content (1) or not (0). A node's
features (tag, words of class, id and role, sizes, link share, place) give its own
potential, and each edge a parent-child potential by the child's kind. Sum-product
message passing, upward and downward once, level by level over many pages at a time,
gives every node's exact marginal; a leaf is text of the page if its marginal reaches
one half.

The model is trained from labelled pages: pages whose author marks the content by one
``article`` or ``main`` element. A bounded sample of them (``n_pages`` different
ones, chosen by hash) is brought to the driver, and each is learned as it stands and in
``n_variants`` layouts made from it: the content in another element, with or without a
telling class, and menus, headers, sidebars, notices, adverts, forms, comments and
footers around and inside it, whose words come from other labelled pages. So the model
learns structure and not only the mark. Weights follow the exact gradient of the
labels' likelihood, which is what the marginals are for.

Blocks: a block ends at every tag that is not of a phrase (``INLINE``); a line break is
white space. Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by a line feed; nothing is capped.

Defined cases: a null or empty html gives the empty text; broken markup is read like
browsers do (implied ends, unclosed elements, stray ends); elements nested deeper than
512 are attached at that depth; repeated rows are extracted each; an empty table gives an
empty result; without a labelled page every block counts as content; extra columns are
ignored; ties at one half are content.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.flat import slices
from tidemark.llm.sample import rows_of

# Fixed values of HTML: elements without content, with raw text, in phrases, and what
# ends an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins
    kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section
    summary table ul""".split())
#: An opening tag ends the nearest of these, not looking beyond the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
TAGS = {t: k for k, t in enumerate("""#text #root #other html head body div section article main
    header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead
    tfoot tr td th caption blockquote pre figure figcaption address details summary button select
    option dialog noscript menu hr center object video audio canvas svg template""".split())}
MAX_DEPTH = 512

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)
     (?P<more>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.S | re.X)
_ATTRS = re.compile(r"(?i)\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_RAW_END = {t: re.compile(rf"(?i)</{t}\b[^>]*>") for t in RAW}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_HASHED = 2048
_SIZES = 24  # bins of one number
_OFFSETS = {name: _HASHED + len(TAGS) + k * _SIZES for k, name in enumerate((
    "length", "links", "share", "place", "parent", "stops", "before", "after", "leaves", "bias"))}
_PARENT_TAG = _HASHED + len(TAGS) + 10 * _SIZES
N_FEATURES = _PARENT_TAG + len(TAGS)


class Page:
    """A page's tree; node 0 is the root and parents come before their children."""

    def __init__(self, html: str):
        self.parent, self.tag, self.attrs, self.depth = [-1], ["#root"], [""], [0]
        self.text, self.linked = [""], [0]
        self._read(html)

    def _node(self, parent: int, tag: str, attrs: str = "", text: str = "", linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.depth.append(self.depth[parent] + 1)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = []  # (name, node); phrases have no node of their own
        held: list[str] = []  # text of the open block
        links = linked = 0

        def here():
            return next((n for _, n in reversed(stack) if n >= 0), 0)

        def add(raw):
            nonlocal linked
            held.append(raw)
            if links:
                linked += len(raw)

        def flush():
            nonlocal linked
            if held:
                text = "".join(held)
                text = " ".join((unescape(text) if "&" in text else text).split())
                if text:
                    self._node(here(), "#text", "", text, min(linked, len(text)))
                held.clear()
            linked = 0

        def close(k):
            nonlocal links
            links -= sum(name == "a" for name, _ in stack[k:])
            del stack[k:]

        at, size = 0, len(html)
        while at < size:
            m = _TOKEN.search(html, at)
            if m is None:
                add(html[at:])
                break
            if m.start() > at:
                add(html[at:m.start()])
            at, name = m.end(), m["name"]
            if name is None:
                continue
            name = name.lower()
            inline = name in INLINE
            if not inline:
                flush()
            if m["end"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
                    if inline and stack[k][1] >= 0:
                        break  # the end of a phrase does not end blocks
                    if stack[k][0] == "table" and name != "table":
                        break
                continue
            if inline:
                if name in ("br", "img", "wbr"):
                    add(" " if name == "br" else "")
                else:
                    stack.append((name, -1))
                    links += name == "a"
                continue
            if name in ENDS_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][1] >= 0:
                        break
            elif name in ENDS:
                ended, border = ENDS[name]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in border:
                        break
                    if stack[k][0] in ended:
                        close(k)
                        if name in ("li", "dt", "dd", "option", "td", "th"):
                            break
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else size
            elif name not in VOID:
                own = here()
                if self.depth[own] < MAX_DEPTH:
                    own = self._node(own, name, m["more"])
                stack.append((name, own))
        flush()


@lru_cache(maxsize=20_000)
def _named(attrs: str) -> tuple[int, ...]:
    """Hashed words of class, id and role, and whether the element is hidden."""
    out = set()
    for key, value in _ATTRS.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            for part in _PARTS.findall(value):
                part = part.lower()
                part = part[:-1] if len(part) > 3 and part[-1] == "s" else part
                out.add(part)
                if len(part) > 4:
                    out.add(part[:4] + "-")
        elif (key == "hidden" or (key == "aria-hidden" and value.lower() == "true")
              or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("!hidden")
    return tuple(zlib.crc32(w.encode()) % _HASHED for w in sorted(out))


def _size(n: int) -> int:
    """A run's length in bins by doubling, the first and the last open."""
    return min(max(n.bit_length(), 4), 9)


def features(page: Page) -> list[list[int]]:
    """The indices of every node's features, all of weight one. Numbers go to few bins, the
    last of them open, so that every bin is met in training."""
    n = len(page.parent)
    size, linked, leaves = [len(t) for t in page.text], page.linked[:], [1 if t else 0 for t in page.text]
    for k in range(n - 1, 0, -1):
        p = page.parent[k]
        size[p] += size[k]
        linked[p] += linked[k]
        leaves[p] += leaves[k]
    total, seen, out, o = max(size[0], 1), 0, [], _OFFSETS
    runs = [k for k in range(n) if page.text[k]]
    order = {k: i for i, k in enumerate(runs)}
    for k in range(n):
        text = page.text[k]
        tag = TAGS.get(page.tag[k], TAGS["#other"])
        f = [_HASHED + tag, o["bias"] + (1 if text else 0),
             o["length"] + (12 + _size(size[k]) if text else min(size[k].bit_length() // 2, 4)),
             o["links"] + (12 if text else 0) + int(10 * linked[k] / max(size[k], 1)),
             o["place"] + (12 if text else 0) + int(10 * seen / total)]
        if text:
            i = order[k]
            words = text.count(" ") + 1
            stops = sum(text.count(c) for c in ".!?,;:")
            f += [_PARENT_TAG + TAGS.get(page.tag[page.parent[k]], TAGS["#other"]),
                  o["stops"] + min(int(20 * stops / words), 4),
                  o["parent"] + (text[-1] in ".!?…\"”»") + 2 * ("©" in text),
                  o["before"] + (_size(size[runs[i - 1]]) if i else 10),
                  o["after"] + (_size(size[runs[i + 1]]) if i + 1 < len(runs) else 10)]
            seen += len(text)
        else:
            f += [o["share"] + min(int(10 * size[k] / total), 3), o["leaves"] + min(leaves[k].bit_length(), 3)]
            f += _named(page.attrs[k]) if page.attrs[k] else ()
        out.append(f)
    return out


class Forest:
    """The trees of many pages, level by level, with their features."""

    def __init__(self, pages: list[Page]):
        parent, depth, kind, flat, sizes, self.first = [], [], [], [], [], [0]
        for p in pages:
            base = len(parent)
            parent += [base + q if q >= 0 else -1 for q in p.parent]
            depth += p.depth
            kind += [TAGS.get(t, TAGS["#other"]) for t in p.tag]
            for f in features(p):
                flat += f
                sizes.append(len(f))
            self.first.append(len(parent))
        self.n = len(parent)
        self.parent, self.kind = np.array(parent, np.int64), np.array(kind, np.int64)
        self.index, self.owner = np.array(flat, np.int64), np.repeat(np.arange(self.n), sizes)
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis))


class Model:
    """``unary``: log-odds of content by feature; ``edge[kind, parent's state, own state]``."""

    def __init__(self):
        self.unary = np.zeros(N_FEATURES)
        self.edge = np.zeros((len(TAGS), 2, 2))

    def marginals(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """``(node, edge)``: P(state) of every node, P(parent's, own) of every node but roots."""
        own = np.zeros((f.n, 2))
        own[:, 1] = np.bincount(f.owner, self.unary[f.index], f.n)
        edge = self.edge[f.kind]
        up = np.zeros((f.n, 2))  # to the parent, by the parent's state
        for level in reversed(f.levels[1:]):  # own holds what all children have sent
            up[level] = _lse(edge[level] + own[level][:, None, :], 2)
            for s in (0, 1):
                own[:, s] += np.bincount(f.parent[level], up[level, s], f.n)
        down = np.zeros((f.n, 2))
        both = np.zeros((f.n, 2, 2))
        for level in f.levels[1:]:
            p = f.parent[level]
            rest = own[p] + down[p] - up[level]
            joint = rest[:, :, None] + edge[level] + own[level][:, None, :]
            joint -= _lse(joint.reshape(len(level), 4), 1)[:, None, None]
            both[level] = np.exp(joint)
            down[level] = _lse(rest[:, :, None] + edge[level], 1)
        node = own + down
        node = np.exp(node - _lse(node, 1)[:, None])
        return node, both

    def gradient(self, f: Forest, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean log-likelihood of the nodes' ``state``."""
        node, both = self.marginals(f)
        unary = np.bincount(f.index, (state - node[:, 1])[f.owner], N_FEATURES)
        edge = np.zeros_like(self.edge)
        inner = f.parent >= 0
        kinds, own, above = f.kind[inner], state[inner], state[f.parent[inner]]
        np.add.at(edge, (kinds, above, own), 1.0)
        np.add.at(edge, kinds, -both[inner])
        return unary / f.n, edge / f.n


def states(page: Page) -> np.ndarray:
    """Labels of a marked page: inside its ``article`` or ``main`` and in none of the
    elements that are never content."""
    never = {"nav", "aside", "footer", "form", "header", "noscript", "button", "select", "menu"}
    out = np.zeros(len(page.parent), np.int64)
    mark = next((t for t in ("article", "main") if page.tag.count(t) == 1), None)
    for k in range(1, len(out)):
        # A layout of :func:`variant` marks what it adds by an attribute that no feature reads.
        if page.tag[k] in never or "data-other" in page.attrs[k]:
            continue
        out[k] = page.tag[k] == mark or "data-content" in page.attrs[k] or out[page.parent[k]]
    return out


#: Names that pages give their parts.
ROLES = {
    "content": "content article post entry main story body text article-body post-content",
    "menu": "menu nav navbar navigation topnav breadcrumbs main-menu links toc",
    "header": "header masthead banner site-header top branding logo page-header",
    "footer": "footer copyright colophon bottom site-footer legal credits",
    "sidebar": "sidebar side widget related rail column-right recommended popular see-also more",
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal newsletter subscribe "
              "paywall message warning toast overlay disclaimer",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsense teaser",
    "form": "form search login signup contact subscribe-form search-form",
    "comments": "comments comment discussion responses replies disqus comment-list reviews feedback",
    "share": "share social share-buttons tags meta byline pagination pager",
}
_WRAPPED = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside",
            "form": "form", "content": "article"}


def _box(rng: random.Random, role: str, inside: str, mark: str) -> str:
    """``inside`` in an element for ``role``: the fitting tag, a named box, or both."""
    named = rng.choice(ROLES[role].split())
    key = rng.choice(("class", "class", "id"))
    tag = _WRAPPED.get(role, "section" if rng.random() < 0.3 else "div")
    if role == "content" and rng.random() < 0.7:
        tag = rng.choice(("div", "div", "section", "main", "td"))
        if rng.random() < 0.4:  # nothing tells it but what it holds
            return f"<{tag} {mark}>{inside}</{tag}>"
    elif rng.random() < 0.5:
        tag = "div"
    elif tag not in ("div", "section") and rng.random() < 0.5:
        return f"<{tag} {mark}>{inside}</{tag}>"
    return f'<{tag} {key}="{named}" {mark}>{inside}</{tag}>'


def variant(rng: random.Random, blocks: list[str], others: list[str]) -> str:
    """Another page with the content ``blocks`` (texts) and parts made of ``others``."""
    def some(least, most):
        return [escape(rng.choice(others)) for _ in range(rng.randint(least, most))]

    def short(n):
        return [" ".join(t.split()[:rng.randint(1, 6)]) for t in some(n, n)]

    def part(role):
        if role in ("menu", "share"):
            items = "".join(f'<li><a href="/x">{t}</a></li>' for t in short(rng.randint(2, 9)))
            inside = f"<ul>{items}</ul>"
        elif role == "header":
            inside = rng.choice(("<h1><a href='/'>{}</a></h1><p>{}</p>", "<h1>{}</h1><p>{}</p>",
                                 "<h1>{}</h1><ul><li><a href='/'>{}</a></li></ul>", "<h2>{}</h2>{}",
                                 "<a href='/'>{}</a> {}")).format(*short(2))
        elif role == "footer":
            inside = f"&copy; {short(1)[0]} &middot; " + rng.choice(some(1, 1))
        elif role == "sidebar":
            inside = rng.choice((
                "<h3>" + short(1)[0] + "</h3>" + "".join(f"<p>{t}</p>" for t in some(1, 3)),
                "<ul>" + "".join(f'<li><a href="/x">{t}</a></li>' for t in short(5)) + "</ul>"))
        elif role == "form":
            inside = (f"<label>{short(1)[0]} <input name='q'></label>"
                      f"<p>{some(1, 1)[0]}</p><button>{short(1)[0]}</button>")
        elif role == "comments":
            inside = "".join(
                f'<div class="{rng.choice(("comment", "reply", "c"))}"><p>{short(1)[0]}</p><p>{t}</p></div>'
                for t in some(1, 5))
            inside = f"<h3>{short(1)[0]}</h3>" + inside
        else:
            said = rng.choice((some, lambda a, b: short(1)))(1, 1)[0]
            inside = rng.choice(("<p>{}</p>", "{}", "<a href='/x'>{}</a>")).format(said)
        return _box(rng, role, inside, "data-other")

    body = []
    how = rng.random()
    if how < 0.15 and len(blocks) > 1:  # a page of few, long blocks
        blocks = [blocks[0], " ".join(blocks[1:])]
    elif how < 0.3:  # a page of many, short blocks
        words = " ".join(blocks).split(" ")[:240]
        step = rng.randint(1, 8)
        blocks = [" ".join(words[k:k + step]) for k in range(0, len(words), step)]
    for k, t in enumerate(blocks):
        t = escape(t)
        words = t.split(" ")
        if len(words) > 6 and rng.random() < 0.3:  # a link or stress in the text
            i = rng.randrange(len(words) - 2)
            words[i] = rng.choice(('<a href="/y">{}</a>', "<b>{}</b>", "<em>{}</em>")).format(words[i])
            t = " ".join(words)
        if k == 0 and rng.random() < 0.7:
            body.append(f"<h1>{t}</h1>")
        else:
            body.append(rng.choice(("<p>{}</p>",) * 8 + ("<p>{}", "<div>{}</div>", "<h2>{}</h2>",
                        "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>")).format(t))
    for role in ("ad", "ad", "sidebar", "notice", "share", "form"):
        if rng.random() < 0.25:
            body.insert(rng.randint(0, len(body)), part(role))
    if rng.random() < 0.3:
        body.append(part("comments"))
    content = _box(rng, "content", "".join(body), "data-content")
    if content.startswith("<td"):
        content = f"<table><tr>{content}</tr></table>"
    before = [part(r) for r in ("header", "menu", "notice", "ad", "form", "sidebar") if rng.random() < 0.5]
    after = [part(r) for r in ("comments", "sidebar", "share", "ad", "notice", "footer") if rng.random() < 0.5]
    inner = "".join(before) + content + "".join(after)
    for _ in range(rng.randint(0, 2)):
        inner = f'<div class="{rng.choice(("wrapper", "page", "container", "row", "site", "inner"))}">{inner}</div>'
    return f"<html><head><title>{escape(blocks[0]) if blocks else ''}</title></head><body>{inner}</body></html>"


def labelled(html: str) -> tuple[Page, np.ndarray] | None:
    """A page and its labels, if its author marks the content."""
    page = Page(html)
    state = states(page)
    return (page, state) if any(state[k] and page.text[k] for k in range(len(state))) else None


def fit(examples: list[tuple[Page, np.ndarray]], *, epochs: int = 40, batch: int = 48,
        rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> Model:
    """Weights by Adam on the exact gradient of the labels' likelihood."""
    model, rng = Model(), np.random.default_rng(seed)
    weights = [model.unary, model.edge]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    groups = [examples[k:k + batch] for k in range(0, len(examples), batch)]
    ready = [(Forest([p for p, _ in g]), np.concatenate([s for _, s in g])) for g in groups]
    step = 0
    for epoch in range(epochs):
        for g in rng.permutation(len(ready)):
            step += 1
            now = rate * (1 - epoch / epochs)
            for w, grad, m, v in zip(weights, model.gradient(*ready[g]), first, second):
                grad = grad - decay * w
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                w += now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def train(pages: DataFrame, *, n_pages: int = 240, n_variants: int = 5, seed: int = 7) -> Model | None:
    """The model learned from at most ``n_pages`` different labelled ``pages`` (``html``) and
    ``n_variants`` layouts of each; None if no page is labelled."""
    rows = pages.select(F.col("html").cast("string").alias("html")).where(
        F.col("html").rlike(r"(?i)<(article|main)\b")).withColumn("key", F.xxhash64("html"))
    keys = [r["key"] for r in rows.select("key").distinct().orderBy("key").limit(n_pages).collect()]
    chosen = rows.where(F.col("key").isin(keys)).dropDuplicates(["key"]).orderBy("key")
    examples = [e for e in (labelled(r["html"]) for r in rows_of(chosen, "labelled-pages")) if e]
    if not examples:
        return None
    contents = [[t for t, s in zip(p.text, state) if t and s] for p, state in examples]
    rng = random.Random(seed)
    others = [t for blocks in contents for t in blocks]
    for blocks in contents:
        for _ in range(n_variants):
            examples.append(labelled(variant(rng, blocks, others)))
    return fit([e for e in examples if e])


def texts(model: Model | None, htmls: list[str]) -> list[str]:
    """The main text of each page."""
    pages = [Page(h) for h in htmls]
    if model is None:
        return ["\n".join(t for t in p.text if t) for p in pages]
    forest = Forest(pages)
    content = model.marginals(forest)[0][:, 1] >= 0.5
    return ["\n".join(t for t, c in zip(p.text, content[a:]) if t and c)
            for p, a in zip(pages, forest.first)]


def extract(pages: DataFrame, model: Model | None) -> DataFrame:
    """``(page_id, url, text)`` of every row of ``pages`` (``page_id``, ``url``, ``html``)."""
    held = pages.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for b in batches:
            for first, part in slices(b.column(2), 1_000_000):
                found = texts(own, part.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(first, len(part)) for k in (0, 1)),
                     pa.array(found, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string")
