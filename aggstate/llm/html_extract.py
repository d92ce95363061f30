"""Main text of HTML pages by a tree-structured graphical model.

The page becomes a DOM; every element that can matter by itself (blocks, and inline elements that say something about
themselves) is a variable, content or not.  Parent and child are joined by a potential, and each node has evidence from
its tag, the words of its class, id and role, the length of its text and the share of it in links.  The potential
depends on whether the parent is the page's shell and whether the child is a nameless element of general use.  All potentials are
counted from labelled pages (``labelled_pages``; any others can be given).  Sum-product messages run upward from the
leaves and downward from the root; they are exact on a tree and give each node's marginal.  Text of nodes with a marginal
over one half is kept.

A block's white space becomes one space; blocks are joined in page order by an empty line.  Elements outside ``BLOCK``,
unknown ones among them, stand inside their block and part it no more than a word.  Null and empty pages, and
pages without content, give the empty text.  Broken markup never fails: what is no tag is text, open elements end with
their parents or the page; the time is linear in the page, however deep or unbalanced it is.  Repeated rows are answered
each; only the named columns are read, and one in keep that is named like a column of the result is left out.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrays_batch, portions, table

_words = lambda s: frozenset(s.split())
# Fixed values of HTML: elements without content, those whose content isn't shown as text, blocks, and those whose start ends an open one.
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style textarea title iframe select")
SPEAKING = _words("button label output")
ENDS_PARAGRAPH = _words("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul")
BLOCK = ENDS_PARAGRAPH | _words("html head body li dt dd caption thead tbody tfoot tr td th legend center frameset noframes title script style textarea select option optgroup")
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th", "tbody": "tr td th thead tbody", "thead": "tr td th", "tfoot": "tr td th thead tbody"}
SIBLINGS = {k: _words(v) for k, v in SIBLINGS.items()}
SCOPES = _words("ul ol dl table select article section div aside nav main body html td th blockquote footer header form")
SHELL = _words("#page html head body")
#: Elements that, unless they have names, say little beside what their parent is.
GENERIC = _words("p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption blockquote pre figure figcaption div section hgroup details summary center address a span b i em strong small code label")
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_INLINE_SCOPES, _PARAGRAPH_SCOPES = frozenset(ENDS_PARAGRAPH - {"p"}), frozenset(SCOPES | {"button"})
_SIBLING_SCOPES = frozenset({"ul", "ol", "dl", "table", "select"})
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@functools.cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I)


class Node:
    __slots__ = ("block", "chars", "evidence", "label", "link", "parent", "tag")

    def __init__(self, tag: str, parent: int, block: bool, evidence: list[str], label: int | None) -> None:
        self.tag, self.parent, self.block, self.evidence, self.label, self.chars, self.link = tag, parent, block, evidence, label, 0, 0


def parse(page: str) -> tuple[list[Node], list[tuple[int, int, str]]]:
    """Nodes (a parent before its children) and pieces of text: node, number of the block, text."""
    nodes = [Node("#page", -1, True, [], None)]
    pieces: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]  # tag, node, whether in a link
    places: dict[str, list[int]] = {}  # where the open elements of each tag stand on the stack
    block = at = 0
    last_close: dict[str, int] = {}

    def text(raw: str) -> None:
        if raw:
            _, node, link = stack[-1]
            pieces.append((node, block, html.unescape(raw)))
            n = len(raw.strip())
            nodes[node].chars += n
            nodes[node].link += n * link

    def pop(to: int) -> None:
        nonlocal block
        for tag, _, _ in stack[to:]:
            places[tag].pop()
            if tag in BLOCK:
                block += 1
        del stack[to:]

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def end(tags: Iterable[str], scopes: frozenset = SCOPES) -> None:
        """Ends the nearest open element of tags, unless a scope stands before it."""
        k = nearest(tags)
        if k and k >= nearest(scopes):
            pop(k)

    while True:
        found = _TAG.search(page, at)
        text(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, rest = tag.lower(), found[3] if found[2] else found[6]
        if found[1] or found[4]:
            end((tag,), frozenset() if tag in BLOCK else _INLINE_SCOPES)
            continue
        if tag in ENDS_PARAGRAPH:
            end(("p",), _PARAGRAPH_SCOPES)
        if tag in SIBLINGS:
            end(SIBLINGS[tag], _SIBLING_SCOPES)
        if tag == "br":
            text(" ")
            continue
        said, label = [], None
        for name, a, b, c in _ATTRIBUTE.findall(rest):
            name = name.lower()
            if name in ("class", "id", "role"):
                said += ["w:" + w.lower() for w in _PART.findall(a or b or c)]
            elif name == "hidden" or (name == "style" and "display:none" in (a or b or c).replace(" ", "")):
                said.append("w:hidden")
            elif name == "data-y":
                label = int(a or b or c)
        inline = tag not in BLOCK
        if not inline:
            block += 1
        if tag in RAW and not rest.endswith("/"):
            if last_close.get(tag, at) < 0:  # no end tag follows any more
                close = None
            else:
                close = _end_of(tag).search(page, at)
                last_close[tag] = -1 if close is None else close.end()
            at = close.end() if close else len(page)
            continue
        if tag in VOID or (rest.endswith("/") and tag not in SCOPES):
            continue
        node, link = stack[-1][1], stack[-1][2] or tag == "a"
        if not inline or said or tag in SPEAKING or label is not None:
            nodes.append(Node(tag, node, not inline, ["t:" + tag, *dict.fromkeys(said)], label))
            node = len(nodes) - 1
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, link))
    return nodes, pieces


def _evidence(nodes: list[Node]) -> None:
    """Adds what a node's text says."""
    for node in nodes:
        if node.chars:
            share = node.link / node.chars
            node.evidence.append(f"n:{min(4, int(math.log10(node.chars) * 2))}")
            node.evidence.append("a:" + ("all" if share > 0.9 else "half" if share > 0.3 else "some" if share else "none"))


def _kind(nodes: list[Node], node: Node) -> int:
    """Which potential joins a node with its parent."""
    general = node.tag in GENERIC and not any(e[0] == "w" for e in node.evidence)
    return (nodes[node.parent].tag in SHELL) * 2 + general


def train(pages: Sequence[str], smoothing: float = 0.3) -> dict:
    """Log potentials from pages whose elements carry data-y (1: content; children inherit it)."""
    pair = [[[smoothing, smoothing], [smoothing, smoothing]] for _ in range(4)]
    prior, seen, totals = [1.0, 1.0], defaultdict(lambda: [0.0, 0.0]), defaultdict(lambda: [0.0, 0.0])
    for page in pages:
        nodes, pieces = parse(page)
        _evidence(nodes)
        own = []
        for node in nodes:
            own.append(node.label if node.label is not None else own[node.parent] if node.parent >= 0 else 0)
        good, total = [0] * len(nodes), [0] * len(nodes)
        for k, _, text in pieces:
            n = len(text.strip())
            while k >= 0:
                total[k] += n
                k = nodes[k].parent
        for k, _, text in pieces:
            n, up = len(text.strip()) * own[k], k
            while up >= 0:
                good[up] += n
                up = nodes[up].parent
        state = [int(g * 2 > t) if t else o for g, t, o in zip(good, total, own, strict=True)]
        prior[state[0]] += 1
        for k, node in enumerate(nodes):
            if k:
                pair[_kind(nodes, node)][state[node.parent]][state[k]] += 1
            for e in node.evidence:
                seen[e][state[k]] += 1
                totals[e[0]][state[k]] += 1
    kinds = defaultdict(int)
    for e in seen:
        kinds[e[0]] += 1
    evidence = {e: tuple(math.log((n[y] + smoothing) / (totals[e[0]][y] + smoothing * (kinds[e[0]] + 1))) for y in (0, 1)) for e, n in seen.items()}
    return {"prior": [math.log(p / sum(prior)) for p in prior], "pair": [[[math.log(v / sum(row)) for v in row] for row in one] for one in pair], "evidence": evidence}


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """Each node's probability of being content, by messages up and down the tree."""
    known, pair = model["evidence"], model["pair"]
    n = len(nodes)
    low, high = [0.0] * n, [0.0] * n
    for k, node in enumerate(nodes):
        for e in node.evidence:
            if e in known:
                a, b = known[e]
                low[k] += a
                high[k] += b
    low[0] += model["prior"][0]
    high[0] += model["prior"][1]
    up = [(0.0, 0.0)] * n
    joined = [pair[_kind(nodes, node)] if k else None for k, node in enumerate(nodes)]
    for k in range(n - 1, 0, -1):  # a parent comes before its children
        (p00, p01), (p10, p11) = joined[k]
        a, b = low[k], high[k]
        up[k] = to0, to1 = _add(p00 + a, p01 + b), _add(p10 + a, p11 + b)
        low[nodes[k].parent] += to0
        high[nodes[k].parent] += to1
    out = [0.0] * n
    for k in range(n):  # low and high now hold all but the message from above
        if k:
            parent, ((p00, p01), (p10, p11)) = nodes[k].parent, joined[k]
            a, b = low[parent] - up[k][0], high[parent] - up[k][1]
            low[k] += _add(p00 + a, p10 + b)
            high[k] += _add(p01 + a, p11 + b)
        gap = low[k] - high[k]
        out[k] = 1 / (1 + math.exp(gap)) if gap < 700 else 0.0
    return out


def extract(page: str | None, model: dict) -> str:
    if not page:
        return ""
    nodes, pieces = parse(page)
    _evidence(nodes)
    content = marginals(nodes, model)
    blocks: dict[int, list[str]] = {}
    for node, block, text in pieces:
        if content[node] > 0.5:
            blocks.setdefault(block, []).append(text)
    return "\n\n".join(t for t in (" ".join("".join(b).split()) for b in blocks.values()) if t)


# ---- labelled pages


def labelled_pages(count: int = 160, seed: int = 5) -> list[str]:
    """Pages made by a grammar of common layouts, content marked by data-y="1".  Their words are random letters, so only structure is learned."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randint(1, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    one = rng.choice

    def named(tag: str, names: str, inner: str, y: int | None = None) -> str:
        name = one(names.split()) if names else ""
        said = f' {one(["class", "class", "id"])}="{name}"' if name and rng.random() < 0.85 else ""
        mark = "" if y is None else f' data-y="{y}"'
        return f"<{tag}{said}{mark}>{inner}</{tag}>"

    links = lambda a, b: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(rng.randint(a, b)))
    menu = lambda: named(one(["nav", "nav", "div", "ul"]), "menu nav navigation main-menu navbar breadcrumb breadcrumbs site-nav topnav", f"<ul>{links(2, 8)}</ul>", 0)
    advert = lambda: named(one(["div", "div", "aside", "section", "span"]), "ad ads advert advertisement ad-box sponsor sponsored promo banner promotion", one([f"<p>{words(3, 20)}</p>", words(3, 25)]), 0)
    notice = lambda: named(one(["div", "section", "aside", "p"]), "notice cookie cookies cookie-notice consent alert warning gdpr privacy-notice newsletter subscribe popup modal", one([words(4, 25), f"<p>{words(4, 25)}</p><button>{words(1, 2)}</button>"]), 0)
    side = lambda: named(one(["aside", "div", "aside"]), "sidebar side widget related related-posts recommended aside trending popular social share tags meta author-box", one([f"<h3>{words(1, 4)}</h3><ul>{links(2, 6)}</ul>", f"<p>{words(5, 40)}</p>", words(4, 30)]), 0)
    form = lambda: f'<form data-y="0" action="/{word()}"><label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button>{one(["", f"<p>{words(3, 15)}</p>", f"<div>{words(2, 9)}</div>"])}</form>'
    header = lambda: named("header", "header masthead site-header top page-header", one([f"<h1>{words(1, 4)}</h1>{menu()}", f'<a href="/">{words(1, 3)}</a><p>{words(2, 10)}</p>', f"<p>{words(2, 14)}</p>", f"<h2>{words(1, 6)}</h2>"]), 0)
    footer = lambda: named(one(["footer", "footer", "div"]), "footer site-footer bottom copyright legal colophon", one([f"&copy; {words(2, 20)}", f"<p>{words(4, 30)}</p>", f"<p>{words(3, 12)}</p><ul>{links(2, 5)}</ul>"]), 0)

    def comments() -> str:
        each = "".join(named(one(["div", "li", "article", "p"]), "comment comment-body reply reader-comment user-comment response", one([f"<p>{words(5, 60)}</p>", words(5, 60), f"<b>{word()}</b> {words(5, 40)}"])) for _ in range(rng.randint(1, 5)))
        return named(one(["section", "div", "ol", "ul"]), "comments comment-list discussion responses reader-comments replies disqus", f"<h3>{words(1, 3)}</h3>{each}", 0)

    def passage() -> str:
        text = words(1, one([6, 30, 120]))
        if rng.random() < 0.25:
            text += f' <a href="/{word()}">{words(1, 4)}</a> {words(1, 12)}'
        if rng.random() < 0.2:
            text = f"<b>{text}" + one(["</b>", ""])
        if rng.random() < 0.15:
            text += f"<br>{words(2, 20)}"
        return text

    def part() -> str:
        kind = rng.random()
        if kind < 0.72:
            return f"<p>{passage()}" + one(["</p>", "</p>", ""])
        if kind < 0.82:
            return f"<h{rng.randint(2, 4)}>{words(1, 8)}</h{2}>".replace("</h2>", "</h2></h3></h4>")
        if kind < 0.89:
            return f"<{one(['ul', 'ol'])}>" + "".join(f"<li>{passage()}</li>" for _ in range(rng.randint(2, 5))) + "</ul></ol>"
        if kind < 0.93:
            return f"<blockquote>{one([words(5, 40), f'<p>{words(5, 40)}</p>'])}</blockquote>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>"
        if kind < 0.98:
            return f"<pre>{words(3, 20)}</pre>"
        return f"<figure><img src=x><figcaption>{words(3, 12)}</figcaption></figure>"

    def article() -> str:
        inner = f"<h1>{words(2, 10)}</h1>" if rng.random() < 0.8 else ""
        for _ in range(rng.randint(1, 12)):
            inner += part()
            if rng.random() < 0.12:
                inner += one([advert, notice, side, form, menu])()
        if rng.random() < 0.15:
            inner = header() + inner
        if rng.random() < 0.15:
            inner += footer()
        if rng.random() < 0.12:
            inner += comments()
        if rng.random() < 0.3:
            inner = f"<{one(['div', 'section'])}>{inner}</div></section>"
        if rng.random() < 0.75:
            return f'<article data-y="1">{inner}</article>'
        return named(one(["article", "main", "div", "section"]), "content article post entry main story article-body post-content entry-content text body", inner, 1)

    out = []
    for _ in range(count):
        before = [f() for f in (header, menu, notice, advert, side, form) if rng.random() < 0.4]
        after = [f() for f in (comments, advert, side, footer, form, notice) if rng.random() < 0.4]
        rng.shuffle(before)
        core = article()
        if rng.random() < 0.2:
            core = f"<main>{core}</main>"
        if rng.random() < 0.25:
            core = named("div", "container wrapper page wrap row layout site", core + one(["", side(), comments()]))
        out.append(f'<html><head><title>{words(1, 6)}</title></head><body>{"".join(before)}{core}{"".join(after)}</body></html>')
    return out


@functools.cache
def default_model() -> dict:
    return train(labelled_pages())


def main_text(df: DataFrame, *, html_col: str = "html", keep: Sequence[str] = (), model: dict | None = None) -> DataFrame:
    """The columns in keep, text and n_chars for each row of df.  The model is a few thousand numbers."""
    shared = df.sparkSession.sparkContext.broadcast(model or default_model())
    keep = [k for k in keep if k not in ("text", "n_chars")]
    chosen = df.select(F.col(html_col), *keep).toDF("__html", *[f"__k{i}" for i in range(len(keep))])

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "__html")):
            texts = [extract(p, shared.value) for p in batch.column("__html").to_pylist()]
            yield arrays_batch({f.name: batch.column(f.name) for f in batch.schema if f.name != "__html"} | {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__html"]
    return chosen.mapInArrow(run, ", ".join([*schema, "text string", "n_chars bigint"])).toDF(*keep, "text", "n_chars")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"), keep=("page_id", "url"))


QUERIES = {"op7_html_extraction": op7_html_extraction}
