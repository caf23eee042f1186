"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 1000   # labelled pages the model is fitted on (written by ``labelled_pages``)

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]*)(\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
NAME = re.compile(r"[a-z]+|[0-9]+")
# fixed values: elements whose content is characters up to their closing tag, elements that are not shown, and others by their part in a page
RAW = frozenset("script style title textarea iframe".split())
HIDDEN = frozenset("template noscript object svg math select canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td "
                  "tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html button label option caption tbody td tfoot th thead tr legend".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("table ul ol dl article section main body div nav aside header footer form".split())
SECTIONS = frozenset("article main section aside nav header footer form dialog".split())


@dataclass(slots=True)
class LeafBlock:
    """Text between two block boundaries with what stands above it."""
    text: str
    tags: frozenset[str]
    near: str
    names: frozenset[str]
    leaf: str
    linked: int


@dataclass(slots=True)
class _Node:
    """An open element and what its ancestors and itself come to; equal sets are shared."""
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    leaf: str
    near: str
    hidden: bool


def _attribute_words(page: str, at: int) -> tuple[int, str]:
    """(position behind a tag that goes on at ``at``, words of its class, id and role). Quotes count
    around a value only; one that no other follows is a character."""
    words = []
    while True:
        m = ATTRIBUTE.match(page, at)
        end = m.end()
        if m[2] and m[1].lower() in ("class", "id", "role"):
            words.append(m[3] or m[4] or m[5] or "")
        if end == at or end >= len(page):   # no attribute here: the tag ends
            close = page.find(">", end)
            return (close + 1 if close >= 0 else len(page)), " ".join(words)
        at = end
        if page[at] == ">":
            return at + 1, " ".join(words)


def _tokens(page: str):
    """(kind, name or text, attribute words) of a page in one pass; kinds are "text", "open" and "close".
    Comments, declarations and the content of raw elements are left out."""
    at, n, last_end = 0, len(page), page.rfind(">")
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt > last_end and not page.startswith("<!--", lt):   # no tag can end any more
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        following = page[lt + 1: lt + 2]
        if following in ("!", "?"):
            end = page.find("-->", lt + 4) if page.startswith("<!--", lt) else page.find(">", lt)
            at = n if end < 0 else page.index(">", end) + 1
            continue
        m = TAG_NAME.match(page, lt + 1 + (following == "/"))
        if m is None:
            yield "text", "<", ""
            at = lt + 1
            continue
        tag = m[0].lower()
        if following == "/":
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
            yield "close", tag, ""
            continue
        at, words = _attribute_words(page, m.end())
        shut = page[at - 2: at] == "/>"
        if tag in RAW:
            if not shut:
                end = _raw_end(tag).search(page, at)
                at = end.end() if end else n
            continue
        yield ("empty" if shut else "open"), tag, words


@lru_cache(None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|</{tag}\Z", re.I)


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[LeafBlock]:
    """The leaf blocks of a page in order. Broken markup is read as far as it goes: unclosed elements
    end with the element around them, closing tags without an opening one are ignored, and an
    element that would be hidden but is never closed hides nothing. Of ancestor tags and names only
    those in ``known`` are kept, where it is given. Takes time in proportion to the page."""
    tokens = list(_tokens(page))
    closed: set[int] = set()      # the hidden elements that are closed somewhere
    waiting: dict[str, list[int]] = {}
    for i, (kind, tag, _) in enumerate(tokens):
        if kind == "open" and tag in HIDDEN:
            waiting.setdefault(tag, []).append(i)
        elif kind == "close" and waiting.get(tag):
            closed.add(waiting[tag].pop())

    blocks: list[LeafBlock] = []
    top = _Node("", frozenset(), frozenset(), "", "", False)
    stack: list[_Node] = [top]
    # places in the stack, by tag and by kind
    places: dict[str, list[int]] = {}
    kinds = {"block": BLOCK, "scope": SCOPE, "own": SCOPE - {"div"}}
    of_kind: dict[str, list[int]] = {k: [] for k in kinds}
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                here = stack[-1]
                blocks.append(LeafBlock(text, here.tags, here.near, here.names, here.leaf, linked))
            parts.clear()
        linked = 0

    def push(tag: str, words: str, hidden: bool) -> None:
        above = stack[-1]
        own = frozenset(w.rstrip("s") or w for w in NAME.findall(words.lower())) if words else above.names
        if known is not None:
            own &= known
        place = len(stack)
        places.setdefault(tag, []).append(place)
        for kind, members in kinds.items():
            if tag in members:
                of_kind[kind].append(place)
        fresh = tag not in above.tags and (known is None or tag in known)
        stack.append(_Node(tag, above.tags | {tag} if fresh else above.tags, above.names if own <= above.names else above.names | own,
                           tag if tag in BLOCK else above.leaf, tag if tag in SECTIONS else above.near, above.hidden or hidden))

    def close(tags: tuple[str, ...], kind: str | None) -> None:
        """Ends the last open element of ``tags``, unless one of ``kind`` is open inside it."""
        place = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if not place or kind and of_kind[kind] and of_kind[kind][-1] > place:
            return
        while len(stack) > place:
            tag = stack.pop().tag
            places[tag].pop()
            for kind, members in kinds.items():
                if tag in members:
                    of_kind[kind].pop()

    for i, (kind, tag, words) in enumerate(tokens):
        if kind == "text":
            if not stack[-1].hidden:
                text = html.unescape(tag)
                parts.append(text)
                if places.get("a"):
                    linked += len(text.strip())
            continue
        if kind == "close":
            if tag in BLOCK:
                flush()
                close((tag,), None)
            else:
                close((tag,), "block" if tag not in HIDDEN else None)
            continue
        if tag == "head":
            continue
        if tag == "br":
            if not stack[-1].hidden:
                parts.append(" ")
            continue
        if tag in HIDDEN:
            if i in closed:
                push(tag, words, True)
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                close(("p",), "scope")
            if tag in SAME_CLOSES:
                close(SAME_CLOSES[tag], "own")
        if tag not in VOID and not (kind == "empty" and tag not in BLOCK):
            push(tag, words, False)
    flush()
    return blocks


def _bucket(x: int, edges: tuple[int, ...]) -> int:
    return sum(x >= e for e in edges)


def block_features(blocks: list[LeafBlock]) -> list[list[str]]:
    """Names of the features of each block: ancestor tags and class words, and what its text looks like."""
    out, total = [], len(blocks)
    for i, b in enumerate(blocks):
        t, size = b.text, len(b.text)
        density = b.linked / size if size else 0
        f = ["bias", f"leaf={b.leaf}", f"size={_bucket(size, (10, 25, 60, 120, 250))}", f"link={_bucket(int(density * 100), (1, 30, 60, 90))}",
             f"ends={t[-1] if t[-1] in '.!?:;,' else 'x'}", f"commas={min(t.count(','), 3)}", f"words={_bucket(t.count(' ') + 1, (2, 4, 8, 16, 40))}",
             f"where={min(4 * i // max(total, 1), 3)}"]
        f.append(f"near={b.near}")
        f += [f"in={x}" for x in b.tags]
        f += [f"name={x}" for x in b.names]
        if "©" in t or "|" in t or "»" in t or "·" in t:
            f.append("signs")
        if i and blocks[i - 1].text == t:
            f.append("repeats")
        out.append(f)
    return out


# --- labelled pages -------------------------------------------------------------------------

MAIN, REST = "\ue000", "\ue001"   # marks at the start of every text of a labelled page


class _Writer:
    """Random pages whose texts are marked as main text or not."""

    def __init__(self, rng: random.Random):
        self.r = rng

    def pick(self, *choices):
        return self.r.choice(choices)

    def word(self) -> str:
        w = "".join(self.r.choice("bcdfghjklmnprstvwxyz") + self.r.choice("aeiouéüñ") for _ in range(self.r.randint(1, 4)))
        return w.capitalize() if self.r.random() < 0.15 else w

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() + ("," if self.r.random() < 0.08 else "") for _ in range(self.r.randint(lo, hi)))

    def sentences(self, n: int) -> str:
        one = lambda: self.words(2, 18).capitalize() + self.pick(".", ".", ".", "!", "?")
        s = " ".join(one() for _ in range(n))
        return s.upper().replace(" ", "!! ") if self.r.random() < 0.05 else s

    def attrs(self, *names: str) -> str:
        name = self.pick(*names)
        name = self.pick(name, name, f"{name}-{self.pick('box', 'wrap', 'area', 'list', 'inner', 'block', 'x')}", f"{self.pick('site', 'page', 'main', 'top', 'js')}-{name}")
        return f' {self.pick("class", "class", "id")}="{name}"'

    def link(self, text: str) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{text}</a>'

    # main text
    def para(self) -> str:
        text = self.sentences(self.r.randint(1, 6)) if self.r.random() < 0.8 else self.words(1, 6) + self.pick("", ".")
        if self.r.random() < 0.2:
            text += " " + self.link(self.words(1, 4)) + " " + self.sentences(1)
        if self.r.random() < 0.15:
            text = f"<b>{text}" + self.pick("</b>", "", "<br>")
        return f"<p>{MAIN}{text}" + self.pick("</p>", "</p>", "</p>", "")

    def main_parts(self) -> list[str]:
        parts = [f"<h1>{MAIN}{self.words(1, 10)}</h1>"] if self.r.random() < 0.8 else []
        same = self.para()
        for _ in range(self.pick(1, 2, 3, 5, 8, 14, 24)):
            x = self.r.random()
            if x < 0.7:
                parts.append(same if self.r.random() < 0.15 else self.para())
            elif x < 0.78:
                parts.append(f"<h{self.pick(2, 3, 4)}>{MAIN}{self.words(1, 8)}</h2>")
            elif x < 0.85:
                items = "".join(f"<li>{MAIN}{self.words(1, 14)}{self.pick('', '.')}" + self.pick("</li>", "") for _ in range(self.r.randint(2, 6)))
                parts.append(self.pick(f"<ul>{items}</ul>", f"<ol>{items}</ol>"))
            elif x < 0.9:
                parts.append(f"<blockquote>{self.para()}</blockquote>")
            elif x < 0.93:
                rows = "".join(f"<tr><td>{MAIN}{self.words(1, 4)}</td><td>{MAIN}{self.r.randint(1, 9999)}</td></tr>" for _ in range(self.r.randint(1, 4)))
                parts.append(f"<table>{rows}</table>")
            elif x < 0.96:
                parts.append(f"<figure><img src=x><figcaption>{MAIN}{self.words(2, 12)}</figcaption></figure>")
            else:
                parts.append(f"<pre>{MAIN}{self.words(2, 30)}</pre>")
        return parts

    # the rest
    def menu(self) -> str:
        items = "".join(f"<li>{self.link(REST + self.words(1, 3))}</li>" for _ in range(self.r.randint(2, 9)))
        body = f"<ul>{items}</ul>" if self.r.random() < 0.7 else "".join(f"<div>{self.link(REST + self.words(1, 2))}</div>" for _ in range(4))
        return self.pick(f"<nav>{body}</nav>", f"<nav{self.attrs('menu', 'nav')}>{body}</nav>", f"<div{self.attrs('menu', 'nav', 'navigation', 'breadcrumb', 'topbar')}>{body}</div>",
                         f"<ul{self.attrs('menu', 'nav', 'links')}>{items}</ul>", f'<div role="navigation">{body}</div>')

    def small(self) -> str:
        x = self.r.random()
        if x < 0.5:
            return f"<p>{REST}{self.sentences(self.r.randint(1, 3))}</p>"
        if x < 0.8:
            return f"{REST}{self.pick(self.sentences(1), self.words(1, 8))}"
        return f"<div>{REST}{self.words(1, 6)}</div><p>{self.link(REST + self.words(1, 4))}</p>"

    def advert(self) -> str:
        return f"<div{self.attrs('ad', 'ads', 'advert', 'advertisement', 'promo', 'sponsored', 'banner', 'adsense')}>{self.small()}</div>"

    def notice(self) -> str:
        return self.pick(f"<div{self.attrs('cookie', 'notice', 'consent', 'alert', 'gdpr', 'newsletter', 'popup', 'modal', 'warning')}>{self.small()}<button>{REST}{self.words(1, 2)}</button></div>",
                         f"<dialog>{self.small()}</dialog>", f'<div role="alert">{self.small()}</div>')

    def sidebar(self) -> str:
        body = f"<h3>{REST}{self.words(1, 3)}</h3>" + "".join(self.pick(self.small(), f"<ul><li>{self.link(REST + self.words(2, 7))}</li><li>{self.link(REST + self.words(2, 7))}</li></ul>") for _ in range(self.r.randint(1, 3)))
        return self.pick(f"<aside>{body}</aside>", f"<aside{self.attrs('sidebar', 'widget')}>{body}</aside>", f"<div{self.attrs('sidebar', 'side', 'widget', 'related', 'recommended', 'trending', 'share', 'social', 'tags', 'pagination')}>{body}</div>",
                         f"<section{self.attrs('related', 'recommended', 'more')}>{body}</section>")

    def form(self) -> str:
        fields = "".join(f"<label>{REST}{self.words(1, 3)}</label><input name=q>" for _ in range(self.r.randint(1, 3)))
        return f"<form action=/s>{self.pick('', '<p>' + REST + self.sentences(1) + '</p>')}{fields}<button>{REST}{self.words(1, 2)}</button></form>"

    def comments(self) -> str:
        one = lambda: self.pick(f"<div{self.attrs('comment', 'reply')}><b>{REST}{self.word()}</b><p>{REST}{self.sentences(self.r.randint(1, 4))}</p></div>", f"<li><p>{REST}{self.sentences(self.r.randint(1, 4))}</p></li>")
        body = "".join(one() for _ in range(self.r.randint(1, 5)))
        head = self.pick("", f"<h2>{REST}{self.words(1, 3)}</h2>")
        return self.pick(f"<section{self.attrs('comments', 'discussion', 'responses')}>{head}{body}</section>", f"<div{self.attrs('comments', 'disqus', 'replies')}>{head}{body}</div>", f"<ul{self.attrs('comments', 'commentlist')}>{body}</ul>")

    def header(self) -> str:
        body = f"<{self.pick('div', 'p', 'h2', 'span')}>{REST}{self.words(1, 5)}</div>" + self.pick("", self.menu(), f"<p>{REST}{self.sentences(1)}</p>")
        return self.pick(f"<header>{body}</header>", f"<header{self.attrs('header', 'masthead')}>{body}</header>", f"<div{self.attrs('header', 'masthead', 'branding')}>{body}</div>")

    def footer(self) -> str:
        body = self.pick(f"&copy; {self.words(1, 3)} &middot; {self.sentences(1)}", self.sentences(self.r.randint(1, 3)), f"{self.words(1, 4)} | {self.words(1, 3)}")
        body = self.pick(f"{REST}{body}", f"<p>{REST}{body}</p>", f"<p>{REST}{body}</p>{self.menu()}")
        return self.pick(f"<footer>{body}</footer>", f"<footer>{body}</footer>", f"<footer{self.attrs('footer', 'copyright')}>{body}</footer>", f"<div{self.attrs('footer', 'copyright', 'legal', 'bottom')}>{body}</div>")

    def page(self) -> str:
        parts = self.main_parts()
        for noise in (self.advert, self.sidebar, self.form, self.notice):
            if self.r.random() < 0.12:
                parts.insert(self.r.randint(0, len(parts)), noise())
        if self.r.random() < 0.08:
            parts.append(self.comments())
        body = "".join(parts)
        main = self.pick(f"<article>{body}</article>", f"<article>{body}</article>", f"<article{self.attrs('post', 'entry', 'story')}>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>",
                         f"<div{self.attrs('content', 'post', 'entry', 'article', 'story', 'text', 'body')}>{body}</div>", f"<section>{body}</section>", f"<div>{body}</div>", body)
        kinds = [self.header, self.menu, self.advert, self.notice, self.sidebar, self.form]
        if self.r.random() < 0.1:
            bare = self.pick("<br>", "<br><br>", "<div></div>").join(MAIN + self.sentences(self.r.randint(1, 4)) for _ in range(self.r.randint(1, 4)))
            return self.pick(f"<html><body>{main}</body></html>", main, bare, MAIN + self.words(1, 6), f"<body>{bare}</body>", f"<div>{bare}</div>")
        before = [x() for x in self.r.sample(kinds, self.r.randint(0, 4))]
        after = [x() for x in self.r.sample([self.sidebar, self.comments, self.form, self.advert, self.notice, self.menu], self.r.randint(0, 3))] + [self.footer()] * (self.r.random() < 0.85)
        wrap = self.pick("{}", "{}", '<div id="page">{}</div>', '<div class="container"><div class="row">{}</div></div>')
        end = self.pick("</body></html>", "")
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><style>p{{margin:0}}</style></head><body>" + wrap.format("".join(before) + main + "".join(after)) + end


def labelled_pages(n: int, seed: int = 7) -> list[tuple[list[LeafBlock], list[int]]]:
    """``n`` written pages as blocks and labels (1: main text)."""
    out, rng = [], random.Random(seed)
    while len(out) < n:
        blocks = leaf_blocks(_Writer(rng).page())
        labels = [int(MAIN in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MAIN, "").replace(REST, "")
            b.linked = min(b.linked, len(b.text))
        keep = [i for i, b in enumerate(blocks) if b.text]
        out.append(([blocks[i] for i in keep], [labels[i] for i in keep]))
    return out


# --- the model ------------------------------------------------------------------------------

@dataclass
class Crf:
    """Weights of "main text" over "rest" for each feature, and scores of label pairs."""
    weights: dict[str, float]
    start: list[float]
    pairs: list[list[float]]

    @cached_property
    def known(self) -> frozenset[str]:
        """Ancestor tags and names that have a weight; no other one changes a label."""
        return frozenset(x.split("=", 1)[1] for x in self.weights if x.startswith(("in=", "name=")))

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most probable labels (Viterbi)."""
        get, (t00, t01), (t10, t11) = self.weights.get, self.pairs[0], self.pairs[1]
        back: list[tuple[int, int]] = []
        a = b = 0.0
        for i, names in enumerate(features):
            u = 0.0
            for x in names:
                u += get(x, 0.0)
            if not i:
                a, b = self.start[0], self.start[1] + u
                back.append((0, 0))
                continue
            from0 = (a + t00, 0) if a + t00 >= b + t10 else (b + t10, 1)
            from1 = (b + t11, 1) if b + t11 >= a + t01 else (a + t01, 0)
            back.append((from0[1], from1[1]))
            a, b = from0[0], from1[0] + u
        out, label = [], int(b > a)
        for previous in reversed(back):
            out.append(label)
            label = previous[label]
        return out[::-1]


def train(pages: list[tuple[list[LeafBlock], list[int]]], steps: int = 120, rate: float = 0.2, ridge: float = 2e-4) -> Crf:
    """Maximum-likelihood CRF with a ridge, by forward-backward over all pages at once."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    flat: list[int] = []
    sizes: list[int] = []
    for blocks, _ in pages:
        for f in block_features(blocks):
            ids = [names.setdefault(x, len(names)) for x in f]
            flat += ids
            sizes.append(len(ids))
    idx, first = np.array(flat), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    length = np.array([len(p[0]) for p in pages])
    n, longest = len(pages), int(length.max())
    row = np.repeat(np.arange(n), length)
    col = np.concatenate([np.arange(x) for x in length])
    y = np.zeros((n, longest), int)
    y[row, col] = np.concatenate([p[1] for p in pages])
    live = np.zeros((n, longest), bool)
    live[row, col] = True
    theta = np.zeros(len(names) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = len(row)
    onehot = np.eye(2)[y]
    for step in range(1, steps + 1):
        w, start, pairs = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        unary = np.zeros((n, longest, 2))
        unary[row, col, 1] = np.add.reduceat(w[idx], first)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = start + unary[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, 0, None] + pairs[0], alpha[:, t - 1, 1, None] + pairs[1]) + unary[:, t]
        for t in range(longest - 2, -1, -1):
            x = beta[:, t + 1] + unary[:, t + 1]
            y2 = np.logaddexp(pairs[:, 0] + x[:, 0, None], pairs[:, 1] + x[:, 1, None])
            beta[:, t] = np.where(live[:, t + 1, None], y2, 0.0)
        z = np.logaddexp(*(alpha[np.arange(n), length - 1].T))
        node = np.exp(alpha + beta - z[:, None, None])
        edge = np.exp(alpha[:, :-1, :, None] + pairs + (unary + beta)[:, 1:, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
        true = onehot[:, :-1, :, None] * onehot[:, 1:, None, :] * live[:, 1:, None, None]
        grad = np.zeros_like(theta)
        grad[:-6] = np.bincount(idx, np.repeat(y[row, col] - node[row, col, 1], sizes), minlength=len(names))
        grad[-6:-4] = (onehot[:, 0] - node[:, 0]).sum(axis=0)
        grad[-4:] = (true - edge).sum(axis=(0, 1)).ravel()
        grad = grad / total - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf({x: float(theta[i]) for x, i in names.items()}, theta[-6:-4].tolist(), theta[-4:].reshape(2, 2).tolist())


@lru_cache(2)
def trained(pages: int) -> Crf:
    """The model of so many written pages, fitted once a process."""
    return train(labelled_pages(pages))


def main_text(page: str | None, model: Crf) -> str:
    blocks = leaf_blocks(page or "", model.known)
    return " ".join(b.text for b, label in zip(blocks, model.decode(block_features(blocks)), strict=True) if label)


def extract_main_text(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; ``model`` defaults to one trained on
    ``TRAINING_PAGES`` labelled pages, a bound that does not follow the corpus.

    Null or empty html, or html without main text, gives an empty text. Null ids and urls,
    repeated rows and pages of any length are kept; other columns play no part.
    """
    fitted = model or trained(TRAINING_PAGES)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(x, fitted) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
    return (pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
