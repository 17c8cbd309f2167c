"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks at block-level tags; script, style and the like, comments and the head have no text. Each block
has features of its ancestors (tags, and words of their class and id) and of its text (length, link density, punctuation).
A two-label CRF, trained in numpy on labelled pages that are generated from page layouts (training_pages), decodes a page's
blocks by Viterbi; blocks labelled as content are joined in page order. Nothing is cut off or dropped beyond that.

Defined cases: a null or empty page, or one without content blocks, gives an empty text. Unclosed tags, stray end tags and
broken attributes are read as browsers do, near enough for blocks. Repeated rows are read each by itself; extra columns go
through, except those named like the results.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import ship

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(script|style|textarea|title)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements without text of the page, and their ends; one that is not closed is read as any other tag.
SKIPPED = {n: re.compile(rf"</{n}\s*>", re.I) for n in "iframe select svg template".split()}
#: Tags that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose start ends an open one of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What such a start must not reach beyond.
WALLS = frozenset("ul ol dl table article section main div body".split())


class Path:
    """An element's tag, and the tags and words of it and of all around it; equal sets are one object on a page."""

    __slots__ = ("tag", "features")

    def __init__(self, tag: str, features: frozenset) -> None:
        self.tag, self.features = tag, features


class Block:
    __slots__ = ("path", "text", "links")

    def __init__(self, path: Path, text: str, links: int) -> None:
        self.path, self.text, self.links = path, text, links


def blocks(page: str | None, known: dict[str, int] | None = None) -> list[Block]:
    """Leaf blocks in page order. Of paths' features only ``known`` ones are kept, if given: however deep a page is nested, a path has no more."""
    out: list[Block] = []
    root = Path("", frozenset(["tag:"]))
    same: dict[frozenset, frozenset] = {}
    stack: list[tuple[str, Path]] = [("", root)]
    depth: dict[str, int] = {}  # open elements of each name
    parts: list[str] = []
    linked = link_depth = 0
    in_head = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not in_head:
                out.append(Block(stack[-1][1], text, linked))
            parts.clear()
        linked = 0

    def pop() -> str:
        name = stack.pop()[0]
        depth[name] -= 1
        return name

    at, unclosed = 0, set()
    while m := TOKEN.search(page or "", at):
        if m.start() > at:
            raw = page[at : m.start()]
            parts.append(raw)
            if link_depth:
                linked += len(raw.strip())
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            if m[1]:
                parts.append(" ")
            continue
        name, closing, rest = name.lower(), bool(m[2] or m[5]), m[4] or m[7] or ""
        if name in SKIPPED and not closing and name not in unclosed:
            if name == "svg" and rest.endswith("/"):
                parts.append(" ")
                continue
            if end := SKIPPED[name].search(page, at):
                at = end.end()
                parts.append(" ")
                continue
            unclosed.add(name)
        if name in INLINE:
            if name == "a":
                link_depth = 0 if closing else 1
            elif name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        flush()
        link_depth = 0
        if name in ("head", "body"):
            in_head = name == "head" and not closing
            if name == "head":
                continue
        if closing:
            if depth.get(name):
                while pop() != name:
                    pass
            continue
        if in_head and name not in VOID:
            in_head = False
        if stack[-1][0] == "p":
            pop()
        if name in ENDS and any(depth.get(x) for x in ENDS[name]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ENDS[name]:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in WALLS:
                    break
        if name not in VOID:
            words = tuple(sorted({w for a in NAMED.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(a).lower()) if w})) if "=" in rest else ()
            above, new = stack[-1][1].features, {x for x in (f"tag:{name}", *(f"word:{w}" for w in words)) if known is None or x in known}
            if not new <= above:
                above = above | new
                above = same.setdefault(above, above)
            stack.append((name, Path(name, above)))
            depth[name] = depth.get(name, 0) + 1
    if page and at < len(page):
        parts.append(re.sub(r"<[^>]*\Z", " ", page[at:]))
    flush()
    return out


def path_features(path: Path) -> list[str]:
    """The innermost tag, and of the ancestors: each tag, and each word of a class or id."""
    return [f"near:{path.tag}", *sorted(path.features)]


def text_features(b: Block) -> list[str]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    share = min(1.0, b.links / n)
    out = ["bias", f"words:{min(words.bit_length(), 7)}", f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}"]
    if b.text[-1] in ".!?…":
        out.append("sentence")
    if "©" in b.text or "|" in b.text:
        out.append("mark")
    if share > 0.8 and words < 6:
        out.append("short-link")
    if b.path.tag in ("h1", "h2", "h3", "h4"):
        out.append("heading")
    return out


class Crf:
    """Two labels, 1 for content. Weights: features by label, transitions, start and end."""

    def __init__(self, index: dict[str, int], node: np.ndarray, step: np.ndarray, edge: np.ndarray) -> None:
        self.index, self.node, self.step, self.edge = index, node, step, edge
        self.kept: dict[tuple, tuple[float, float]] = {}

    def _sum(self, names: list[str]) -> tuple[float, float]:
        a = b = 0.0
        for x in names:
            k = self.index.get(x)
            if k is not None:
                a += self.node[k][0]
                b += self.node[k][1]
        return a, b

    def scores(self, b: Block) -> tuple[float, float]:
        key = (b.path.tag, b.path.features)
        if key not in self.kept:
            if len(self.kept) > 50_000:
                self.kept.clear()
            self.kept[key] = self._sum(path_features(b.path))
        p, t = self.kept[key], self._sum(text_features(b))
        return p[0] + t[0], p[1] + t[1]

    def decode(self, page: list[Block]) -> list[int]:
        """Viterbi."""
        if not page:
            return []
        (aa, ab), (ba, bb) = self.step.tolist()
        s0, s1 = self.edge[0].tolist()
        back: list[tuple[int, int]] = []
        for k, b in enumerate(page):
            e0, e1 = self.scores(b)
            if k:
                f0, f1 = int(s1 + ba > s0 + aa), int(s1 + bb > s0 + ab)
                back.append((f0, f1))
                s0, s1 = (s1 + ba if f0 else s0 + aa), (s1 + bb if f1 else s0 + ab)
            s0, s1 = s0 + e0, s1 + e1
        label = int(s1 + float(self.edge[1][1]) > s0 + float(self.edge[1][0]))
        out = [label]
        for f in reversed(back):
            label = f[label]
            out.append(label)
        return out[::-1]


def train_crf(pages: list[tuple[list[Block], list[int]]], steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Crf:
    """Maximum likelihood with a Gaussian prior, by Adam over all pages at once; forward and backward run over padded pages."""
    index: dict[str, int] = {}
    feature, owner, labels, n = [], [], [], max(len(b) for b, _ in pages)
    y = np.zeros((len(pages), n), np.int64)
    mask = np.zeros((len(pages), n), bool)
    for i, (page, own) in enumerate(pages):
        y[i, : len(own)], mask[i, : len(own)] = own, True
        for j, b in enumerate(page):
            for x in path_features(b.path) + text_features(b):
                feature.append(index.setdefault(x, len(index)))
                owner.append(i * n + j)
    feature, owner = np.array(feature), np.array(owner)
    size, last = mask.sum(1), mask.sum(1) - 1
    w = {"node": np.zeros((len(index), 2)), "step": np.zeros((2, 2)), "edge": np.zeros((2, 2))}
    m, v = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    rows, one = np.arange(len(pages)), np.eye(2)
    for t in range(1, steps + 1):
        e = np.zeros((len(pages) * n, 2))
        np.add.at(e, owner, w["node"][feature])
        e = e.reshape(len(pages), n, 2)
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = w["edge"][0] + e[:, 0]
        for k in range(1, n):
            f[:, k] = np.where(mask[:, k, None], np.logaddexp(f[:, k - 1, :1] + w["step"][0], f[:, k - 1, 1:] + w["step"][1]) + e[:, k], f[:, k - 1])
        b[rows, last] = w["edge"][1]
        for k in range(n - 2, -1, -1):
            x = b[:, k + 1] + e[:, k + 1]
            b[:, k] = np.where((k < last)[:, None], np.logaddexp(x[:, :1] + w["step"][:, 0], x[:, 1:] + w["step"][:, 1]), b[:, k])
        z = np.logaddexp(*(f[rows, last] + w["edge"][1]).T)
        d = (one[y] - np.exp(f + b - z[:, None, None])) * mask[..., None]
        g = {k: -decay * x * len(pages) for k, x in w.items()}
        np.add.at(g["node"], feature, d.reshape(-1, 2)[owner])
        pair = np.exp(f[:, :-1, :, None] + w["step"] + (e + b)[:, 1:, None, :] - z[:, None, None, None])
        both = mask[:, 1:, None, None]
        g["step"] += ((one[y[:, :-1]][..., :, None] * one[y[:, 1:]][..., None, :] - pair) * both).sum((0, 1))
        g["edge"][0] += d[:, 0].sum(0)
        g["edge"][1] += d[rows, last].sum(0)
        for k in w:
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
            w[k] = w[k] + rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    assert size.min() > 0
    return Crf(index, w["node"], w["step"], w["edge"])


# How pages name their parts.
CONTENT_NAMES = "content main-content post-content entry-content article-body story-body post entry body-text text article page-content".split()
CHROME = {
    "nav": "menu nav navbar navigation main-menu breadcrumbs topnav links pagination".split(),
    "header": "header site-header masthead top banner page-header branding topbar".split(),
    "footer": "footer site-footer bottom copyright legal page-footer colophon".split(),
    "aside": "sidebar side widget related sidebar-right recommended popular aside rail trending".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad adsense sponsor ad-slot".split(),
    "notice": "notice cookie-notice cookie-banner alert consent popup modal gdpr message disclaimer newsletter subscribe notification".split(),
    "form": "search login signup form contact-form search-form subscribe-form".split(),
    "comments": "comments comment comment-list reader-comments discussion responses replies disqus comment-body user-comments".split(),
    "share": "share social share-buttons social-links toolbar tags meta".split(),
}


def training_pages(n: int = 500, seed: int = 5) -> list[tuple[str, list[tuple[str, int]]]]:
    """Generated pages with their blocks' texts and labels, in page order. Words are invented, so that layouts decide, not words."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p
    sounds = "ka ro mi ten sul ar en lo fi das ne or pi ut gra vel".split()
    number = 0

    def word() -> str:
        return "".join(pick(sounds) for _ in range(int(rng.integers(1, 4))))

    def prose(least: int, most: int) -> str:
        nonlocal number
        number += 1
        words = [word() for _ in range(int(rng.integers(least, most + 1)))]
        return f"{' '.join(words).capitalize()} x{number}" + pick([".", ".", ".", "", "!", ":"])

    def make() -> tuple[str, list[tuple[str, int]]]:
        truth: list[tuple[str, int]] = []

        def put(text: str, label: int) -> str:
            truth.append((text, label))
            return text

        def attr(kind: str | None, names: list[str]) -> str:
            return "" if kind is None else f' {pick(["class", "class", "id"])}="{pick(names)}{pick(["", "", " wide", "-1", " clearfix"])}"'

        def chrome(kind: str) -> str:
            bare = kind in ("nav", "header", "footer", "aside", "form")
            tag = kind if bare and chance(0.6) else pick(["div", "section", "div", "aside"] if kind != "nav" else ["div", "ul"])
            named = None if tag == kind and chance(0.5) else kind
            inside = []
            if kind != "header" and chance(0.3):
                inside.append(f"<{(c := pick(['h2', 'h3', 'h4']))}>{put(prose(1, 4), 0)}</{c}>")
            for _ in range(int(rng.integers(1, 4))):
                if kind in ("nav", "aside", "share") and chance(0.7) or kind in ("footer", "header") and chance(0.4):
                    items = "".join(f'<li><a href="/{word()}">{put(prose(1, 4).rstrip("."), 0)}</a></li>' if chance(0.8) else f"<li>{put(prose(1, 6), 0)}</li>" for _ in range(int(rng.integers(2, 7))))
                    inside.append(f"<ul>{items}</ul>")
                elif kind == "form":
                    inside.append(f'<label>{put(prose(1, 3), 0)}</label><input name="q"><p>{put(prose(2, 8), 0)}</p><button>{put(word() + " go", 0)}</button>')
                elif kind == "comments":
                    inside.append(f'<{(c := pick(["div", "li", "article", "p"]))} class="{pick(["comment", "reply", "c", "item"])}">' + (f"<p>{put(prose(3, 40), 0)}</p>" if c != "p" else put(prose(3, 40), 0)) + f"</{c}>")
                elif kind == "header" and chance(0.5):
                    inside.append(f"<{(c := pick(['h1', 'h2', 'div', 'p']))}>{put(prose(1, 6), 0)}</{c}>")
                elif kind == "footer" and chance(0.6):
                    inside.append(("&copy; " if chance(0.6) else "") + put(prose(3, 14), 0))
                    break
                elif chance(0.5):
                    inside.append(put(prose(2, 25), 0))
                    break
                else:
                    inside.append(f"<p>{put(prose(2, 30), 0)}</p>")
            return f"<{tag}{attr(named, CHROME[kind])}>{''.join(inside)}</{tag}>"

        def paragraph() -> str:
            r = rng.random()
            if r < 0.7:
                text = put(prose(1, 6) if chance(0.25) else prose(5, 80), 1)
                if chance(0.15):
                    first, _, rest = text.partition(" ")
                    return f'<p><a href="/{word()}">{first}</a> {rest}' + ("</p>" if chance(0.9) else "")
                return (f"<p><b>{text}<br>" if chance(0.1) else f"<p>{text}" + ("</p>" if chance(0.9) else ""))
            if r < 0.8:
                return f"<{(c := pick(['h2', 'h3', 'h4']))}>{put(prose(1, 8), 1)}</{c}>"
            if r < 0.88:
                return f"<{(c := pick(['ul', 'ol']))}>" + "".join(f"<li>{put(prose(1, 20), 1)}</li>" for _ in range(int(rng.integers(2, 5)))) + f"</{c}>"
            if r < 0.94:
                return f"<blockquote><p>{put(prose(4, 40), 1)}</p></blockquote>"
            return "<table><tr>" + "".join(f"<td>{put(prose(1, 5), 1)}</td>" for _ in range(int(rng.integers(2, 5)))) + "</tr></table>"

        def article() -> str:
            tag = pick(["article", "article", "article", "main", "div", "section"])
            named = None if tag in ("article", "main") and chance(0.6) else "content"
            title = f"<h1>{put(prose(1, 9), 1)}</h1>" if chance(0.85) else ""
            if title and chance(0.15):
                title = f"<header>{title}</header>"
            inside = [title]
            for _ in range(int(rng.integers(0, 12))):
                inside.append(paragraph())
                if chance(0.06):
                    inside.append(chrome(pick(["ad", "share", "notice", "aside"])))
            if chance(0.1):
                inside.append(chrome(pick(["comments", "share", "footer"])))
            body = "".join(inside)
            if chance(0.3):
                body = f"<div{attr('content', CONTENT_NAMES) if chance(0.6) else ''}>{body}</div>"
            out = f"<{tag}{attr(named, CONTENT_NAMES)}>{body}</{tag}>"
            return f"<main>{out}</main>" if tag != "main" and chance(0.15) else out

        before = [chrome(k) for k in ("notice", "header", "nav", "form", "ad", "aside") if chance(0.45)]
        middle = article()
        after = [chrome(k) for k in ("share", "ad", "comments", "aside", "form", "notice", "footer") if chance(0.45)]
        inner = "".join(before) + middle + "".join(after)
        if chance(0.3):
            inner = f'<div{attr("wrap", ["wrapper", "page", "container", "site"])}>{inner}</div>'
        return f"<html><head><title>{word()}</title></head><body>{inner}</body></html>", truth

    return [make() for _ in range(n)]


def labelled_blocks(page: str, truth: list[tuple[str, int]]) -> tuple[list[Block], list[int]]:
    """A generated page's blocks with labels. Every text has its own number, which tells a block's label."""
    number = re.compile(r"x\d+")
    label = {k: y for text, y in truth for k in number.findall(text)[-1:]}
    found, own = blocks(page), []
    for b in found:
        ks = number.findall(b.text)
        own.append(label[ks[-1]] if ks and ks[-1] in label else 0)
    return found, own


_MODEL: list[Crf] = []


def default_model() -> Crf:
    """The model trained on the generated pages; trained once in a process."""
    if not _MODEL:
        _MODEL.append(train_crf([x for x in (labelled_blocks(*p) for p in training_pages()) if x[0]]))
    return _MODEL[0]


def main_text(page: str | None, model: Crf) -> str:
    found = blocks(page, model.index)
    return "\n".join(b.text for b, y in zip(found, model.decode(found), strict=True) if y)


def extract_pages(pages: DataFrame, html_col: str = "html", model: Crf | None = None) -> DataFrame:
    """pages without the html, with text and n_chars."""
    ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(model or default_model())

    @F.pandas_udf("string")
    def read(batch):
        import pandas as pd

        return pd.Series([main_text(x, held.value) for x in batch], dtype=object)

    return pages.drop("text", "n_chars").withColumn("text", read(F.col(html_col))).withColumn("n_chars", F.length("text").cast("long")).drop(html_col)
