"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is read as its sequence of leaf blocks: runs of text between block-level
tags, with the path of open tags (names, classes, ids, roles), the words and a
few numbers. Path and word tokens are hashed into learned vectors; a numpy LSTM
in each direction carries the whole page as context, and a logistic unit decides
for each block whether it belongs to the article.

The labeller is trained here, on ``train_pages`` pages that a seeded generator
lays out (articles among menus, headers, footers, sidebars, notices, adverts,
forms and comments, under varied tags and names) and on at most ``fit_pages`` of
the given pages, those of the smallest url hash, as far as their markup names
the article. Both bounds are parameters; every page is labelled.

Defined results: null, empty and text-free pages give an empty text and
``n_chars`` 0; scripts, styles, comments, titles and the head never count, nor what
a closed svg, template, iframe, textarea or select holds; formulas and noscript
text do. The head ends at the first tag or text that cannot stand in it. An unclosed
script or style goes on to the page's end, as in a browser, an unclosed title to the
next tag; the other elements that do not count end at their own tag if unclosed or
self-closed. Other unclosed and stray tags are tolerated; null ids and urls pass
through; repeated pages give equal rows; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element classes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Formulas stand within a line; their parts are read as words.
FORMULA = frozenset(
    "math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo "
    "mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable "
    "mtd mtext mtr munder munderover none semantics".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SELF_NESTED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""", re.S | re.I | re.X)
# What ends an element that is not read: its end tag, or a tag that cannot stand
# in it, which shows that it was not closed.
_BLOCK = ("</?(?:address|article|aside|blockquote|body|center|dd|div|dl|dt|fieldset|figure|footer|form"
          "|h[1-6]|head|header|li|main|nav|ol|p|pre|section|table|ul)")
RAW = {name: re.compile(rf"(?:(?P<end></{name})" + (f"|{other}" if other else "")
                        + r")(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I)
       for name, other in {
           "script": "", "style": "", "template": "", "textarea": "<textarea", "iframe": "<iframe",
           "svg": _BLOCK, "select": _BLOCK + "|<select", "title": "</head|<body|<title",
           "noscript": "</head|<body|<noscript", "head": "<body"}.items()}
UNREAD = RAW.keys() - {"noscript", "head"}
SELF_CLOSED = re.compile(r"""(?:\A|["'\s]|(?:\A|\s)[^\s=]+)/\s*\Z""")
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""",
                   re.I)
MARK = re.compile(r'data-y="([01])"')
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

PATH_ROWS, WORD_ROWS, PATH_DIM, WORD_DIM, NUMBERS = 1024, 1024, 16, 8, 8


@dataclass
class Block:
    """A run of text and where it stands."""

    text: str
    path: tuple[str, ...]
    link_chars: int
    mark: int = 0


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order, white space made single."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []
    buffer: list[str] = []
    linked, anchor, skip = 0, 0, 0
    ends: dict[str, re.Match | None] = {}

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text and not skip:
                path = tuple(t for _, names, _ in stack for t in names)
                out.append(Block(text, path, min(linked, len(text)), stack[-1][2] if stack else 0))
            buffer.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        if skip and text.strip():
            leave_head()
        buffer.append(text)
        if anchor:
            linked += len(text.strip())

    def pop_to(k: int) -> None:
        nonlocal skip
        while len(stack) > k:
            if stack.pop()[0] == "head":
                skip -= 1

    def leave_head() -> None:
        flush()
        while skip:
            pop_to(max(k for k, e in enumerate(stack) if e[0] == "head"))

    def end_of(name: str, at: int) -> int | None:
        """Where the element opened before ``at`` ends, if it is closed."""
        m = found(name, at)
        return m.end() if m and m["end"] else None

    def found(name: str, at: int) -> re.Match | None:
        # Kept until passed, so that many unclosed tags do not read the page again.
        m = ends.get(name)
        if name not in ends or (m and m.start() < at):
            m = ends[name] = RAW[name].search(page, at)
        return m

    at = 0
    while m := MARKUP.search(page, at):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        opens = not (m["close"] or m["close2"])
        # A noscript element of a head that is told to end belongs to the head.
        if opens and (name in UNREAD or name == "noscript" and skip and found("head", at)):
            attrs = m["attrs"] or m["attrs2"] or ""
            if SELF_CLOSED.search(attrs) and (
                    name not in ("script", "style") or "src" in attrs.lower()):
                continue
            end = end_of(name, at)
            if end is not None:
                at = end
            elif name in ("script", "style"):
                at = len(page)
            elif name == "title":
                at = k if (k := page.find("<", at)) >= 0 else len(page)
            else:
                buffer.append(" ")
            continue
        if skip and opens and name not in IN_HEAD:
            leave_head()
        if name in FORMULA:
            buffer.append(" ")
            continue
        if not opens:
            if name == "a":
                anchor = 0
            elif name in INLINE:
                pass
            else:
                flush()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        pop_to(k)
                        break
            continue
        if name in INLINE:
            if name == "a":
                anchor = 1
            elif name == "br":
                buffer.append(" ")
            continue
        flush()
        anchor = 0
        if name in VOID:
            continue
        if name == "body":
            pop_to(0)
        while stack and (stack[-1][0] in CLOSED_BY_BLOCK and name != "noscript"
                         or stack[-1][0] in SELF_NESTED.get(name, ())):
            pop_to(len(stack) - 1)
        attrs = m["attrs"] or m["attrs2"] or ""
        names = [name]
        for g in NAMES.findall(attrs) if "=" in attrs else ():
            names += [w.lower() for w in NAME_WORD.findall("".join(g))]
        mark = MARK.search(attrs) if "data-y" in attrs else None
        stack.append((name, tuple(names), int(mark[1]) if mark else stack[-1][2] if stack else 0))
        skip += name == "head"
    if at < len(page):
        say(page[at:])
    flush()
    return out


@dataclass
class Rows:
    """Hashed features of a page's blocks."""

    path: list[list[int]] = field(default_factory=list)
    words: list[list[int]] = field(default_factory=list)
    numbers: np.ndarray | None = None


def featurize(found: list[Block], memo: dict[str, int]) -> Rows:
    def slot(token: str, rows: int) -> int:
        h = memo.get(token)
        if h is None:
            if len(memo) > 200_000:
                memo.clear()
            h = memo[token] = crc32(token.encode())
        return h % rows

    rows, n = Rows(), len(found)
    numbers = np.zeros((n, NUMBERS), np.float32)
    for i, b in enumerate(found):
        rows.path.append([slot("<" + t, PATH_ROWS) for t in dict.fromkeys(b.path)])
        words = b.text.lower().split()
        rows.words.append([slot(w.strip(".,;:!?()[]\"'|"), WORD_ROWS) for w in words])
        size = len(b.text)
        numbers[i] = (np.log1p(len(words)) / 5, b.link_chars / size,
                      sum(map(b.text.count, ".,;")) / len(words), size / len(words) / 20,
                      b.text[-1] in ".!?", i / n, sum(map(str.isdigit, b.text)) / size, 1 / n)
    rows.numbers = numbers
    return rows


class Labeller:
    """Bidirectional LSTM over block vectors, in numpy."""

    def __init__(self, hidden: int = 20, seed: int = 5):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + NUMBERS

        def weights(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.hidden = hidden
        self.p = {"ep": weights(PATH_ROWS, PATH_DIM, scale=0.3),
                  "ew": weights(WORD_ROWS, WORD_DIM, scale=0.1),
                  "wo": weights(2 * hidden + d, 1, scale=0.1), "bo": np.zeros(1, np.float32)}
        for k in ("f", "b"):
            self.p["wx" + k] = weights(d, 4 * hidden, scale=d ** -0.5)
            self.p["wh" + k] = weights(hidden, 4 * hidden, scale=hidden ** -0.5)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1
            self.p["bb" + k] = bias

    def _inputs(self, pages: list[Rows]):
        """(time, page, features), mask and what the backward pass needs."""
        steps = max(len(r.path) for r in pages)
        x = np.zeros((steps, len(pages), PATH_DIM + WORD_DIM + NUMBERS), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        used = []
        for table, lists, lo in (("ep", "path", 0), ("ew", "words", PATH_DIM)):
            flat = [v for r in pages for v in getattr(r, lists)]
            size = np.array([len(v) for v in flat])
            index = np.array([i for v in flat for i in v], np.int64)
            owner = np.repeat(np.arange(len(flat)), size)
            total = np.zeros((len(flat), self.p[table].shape[1]), np.float32)
            some = size > 0
            if len(index):
                begin = np.cumsum(size) - size
                total[some] = np.add.reduceat(self.p[table][index], begin[some], axis=0)
            mean = total / np.maximum(size, 1)[:, None]
            used.append((table, index, owner, np.maximum(size, 1), lo, mean.shape[1]))
            at = 0
            for j, r in enumerate(pages):
                x[:len(r.path), j, lo:lo + mean.shape[1]] = mean[at:at + len(r.path)]
                at += len(r.path)
        for j, r in enumerate(pages):
            x[:len(r.path), j, -NUMBERS:] = r.numbers
            mask[:len(r.path), j] = True
        return x, mask, used

    def _run(self, x: np.ndarray, mask: np.ndarray, k: str, keep: bool):
        p, n = self.p, self.hidden
        order = range(len(x)) if k == "f" else range(len(x) - 1, -1, -1)
        h = np.zeros((x.shape[1], n), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((*x.shape[:2], n), np.float32)
        given = x @ p["wx" + k] + p["bb" + k]
        saved = []
        for t in order:
            z = given[t] + h @ p["wh" + k]
            gate = 1 / (1 + np.exp(-np.clip(z[:, :3 * n], -30, 30)))
            i, f, o = gate[:, :n], gate[:, n:2 * n], gate[:, 2 * n:]
            g = np.tanh(z[:, 3 * n:])
            live = mask[t][:, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep:
                saved.append((t, h, c, i, f, o, g, tanh, live))
            c = np.where(live, new, c)
            h = np.where(live, o * tanh, h)
            out[t] = np.where(live, h, 0)
        return out, saved

    def scores(self, pages: list[Rows], keep: bool = False):
        x, mask, used = self._inputs(pages)
        fore, saved_f = self._run(x, mask, "f", keep)
        back, saved_b = self._run(x, mask, "b", keep)
        joined = np.concatenate([fore, back, x], axis=2)
        z = (joined @ self.p["wo"])[..., 0] + self.p["bo"][0]
        return z, (x, mask, used, joined, saved_f, saved_b)

    def _back(self, x: np.ndarray, saved: list, grad: np.ndarray, k: str, out: dict) -> np.ndarray:
        p, n = self.p, self.hidden
        dx = np.zeros_like(x)
        dh = np.zeros_like(grad[0])
        dc = np.zeros_like(dh)
        for name in ("wx", "wh", "bb"):
            out[name + k] = np.zeros_like(p[name + k])
        for t, h, c, i, f, o, g, tanh, live in reversed(saved):
            dh_t = np.where(live, dh + grad[t], 0)
            carried_h, carried_c = np.where(live, 0, dh), np.where(live, 0, dc)
            do = dh_t * tanh
            dcell = np.where(live, dc, 0) + dh_t * o * (1 - tanh ** 2)
            dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f),
                                 do * o * (1 - o), dcell * i * (1 - g ** 2)], axis=1)
            out["wx" + k] += x[t].T @ dz
            out["wh" + k] += h.T @ dz
            out["bb" + k] += dz.sum(0)
            dx[t] = dz @ p["wx" + k].T
            dh = dz @ p["wh" + k].T + carried_h
            dc = dcell * f + carried_c
        return dx

    def gradients(self, pages: list[Rows], labels: list[np.ndarray]):
        z, (x, mask, used, joined, saved_f, saved_b) = self.scores(pages, keep=True)
        y = np.zeros_like(z)
        for j, v in enumerate(labels):
            y[:len(v), j] = v
        prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = mask.sum()
        dz = np.where(mask, prob - y, 0).astype(np.float32)[..., None] / total
        n, out = self.hidden, {}
        out["wo"] = np.einsum("tbk,tbo->ko", joined, dz)
        out["bo"] = dz.sum((0, 1))
        dj = dz @ self.p["wo"].T
        dx = dj[..., 2 * n:] + self._back(x, saved_f, dj[..., :n], "f", out) \
            + self._back(x, saved_b, dj[..., n:2 * n], "b", out)
        flat = np.concatenate([dx[:len(r.path), j] for j, r in enumerate(pages)])
        for table, index, owner, size, lo, dim in used:
            share = (flat[:, lo:lo + dim] / size[:, None])[owner]
            out[table] = np.stack([np.bincount(index, share[:, d], len(self.p[table]))
                                   for d in range(dim)], axis=1).astype(np.float32)
        loss = -np.where(mask, y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9), 0).sum()
        return out, loss / total

    def fit(self, pages: list[Rows], labels: list[np.ndarray], epochs: int = 8, batch: int = 32,
            rate: float = 0.01, drop: float = 0.12, seed: int = 9) -> float:
        """Adam on shuffled batches; path tokens and the words of some blocks are
        hidden at random, so that no one kind of evidence decides alone. Returns the last mean loss."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, mean = 0, 0.0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            losses = []
            for lo in range(0, len(order), batch):
                pick = order[lo:lo + batch]
                some = [Rows([[t for t in path if rng.random() > drop] for path in pages[i].path],
                             [w if rng.random() > 2 * drop else [] for w in pages[i].words],
                             pages[i].numbers) for i in pick]
                grads, loss = self.gradients(some, [labels[i] for i in pick])
                losses.append(loss)
                step += 1
                lr = rate * (1 - 0.9 * epoch / epochs)
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= lr * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            mean = float(np.mean(losses))
        return mean

    def main_blocks(self, pages: list[Rows]) -> list[np.ndarray]:
        """For each page, which blocks belong to the article."""
        if not pages:
            return []
        z, _ = self.scores(pages)
        return [z[:len(r.path), j] > 0 for j, r in enumerate(pages)]


# Names that page parts carry, for the generator.
PARTS = {
    "main": "article content post entry story main body text page-content post-body entry-content "
            "article-body story-text markdown",
    "nav": "nav menu navbar topnav breadcrumbs breadcrumb navigation main-menu toc pagination",
    "header": "header masthead top site-header branding topbar page-header",
    "footer": "footer bottom colophon site-footer copyright page-footer legal",
    "aside": "sidebar aside widget related rail side-bar recommended popular trending tags",
    "notice": "notice cookie alert consent gdpr popup modal cookie-banner message disclaimer",
    "advert": "ad ads advert advertisement sponsor promo banner-ad ad-slot sponsored adsense",
    "form": "newsletter subscribe search login signup contact-form search-box",
    "comments": "comments comment comment-list reply discussion disqus respond responses "
                "user-comments reviews",
    "share": "share social share-buttons follow byline meta author-box post-meta",
}
CUES = {
    "nav": "home about contact products services blog news menu next previous",
    "header": "welcome logo skip to content search",
    "footer": "copyright all rights reserved privacy policy terms of use imprint contact",
    "aside": "related articles popular posts recent most read tags archive see also",
    "notice": "we use cookies accept this site continue agree privacy settings close",
    "advert": "advertisement sponsored buy now offer sale discount shop free",
    "form": "subscribe email name password sign up log in submit your address",
    "comments": "reply says posted comment ago like report thanks wrote leave a",
    "share": "share tweet facebook by author posted on minutes read follow",
}
TAGS = {"nav": "nav div ul", "header": "header div", "footer": "footer div", "aside": "aside div section",
        "notice": "div section aside", "advert": "div aside section", "form": "form div",
        "comments": "section div ol", "share": "div ul p", "main": "article main div section td"}


class Layout:
    """Seeded generator of pages whose article blocks are marked."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        bits = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de " \
               "rt ve ra ri ro la el il ue eu ch ie ge un die ein ción os que é è ñ ü ß ai".split()
        self.vocabulary = ["".join(bits[i] for i in self.rng.integers(
            0, len(bits), self.rng.integers(1, 5))) for _ in range(3000)]

    def pick(self, text: str) -> str:
        options = text.split()
        return options[self.rng.integers(len(options))]

    def words(self, low: int, high: int, cue: str = "") -> str:
        at = self.rng.integers(0, len(self.vocabulary), self.rng.integers(low, high + 1))
        out = [self.vocabulary[i] for i in at]
        if cue and self.rng.random() < 0.7:
            cues = CUES[cue].split()
            for _ in range(min(len(out), 1 + int(self.rng.integers(0, 4)))):
                out[self.rng.integers(0, len(out))] = cues[self.rng.integers(len(cues))]
        return " ".join(out).capitalize()

    def prose(self, low: int, high: int, cue: str = "") -> str:
        return " ".join(self.words(3, 14, cue) + "." for _ in range(self.rng.integers(low, high + 1)))

    def named(self, kind: str, mark: int, inner: str, tag: str | None = None) -> str:
        tag = tag or self.pick(TAGS[kind])
        plain = tag in ("nav", "header", "footer", "aside", "article", "main", "form")
        names = ""
        if not plain or self.rng.random() < 0.4:
            key = "class" if self.rng.random() < 0.7 else "id"
            names = f' {key}="{self.pick(PARTS[kind])}"'
        return f'<{tag} data-y="{mark}"{names}>{inner}</{tag}>'

    def links(self, n: int, cue: str) -> str:
        tag = "li" if self.rng.random() < 0.7 else "div" if self.rng.random() < 0.5 else "span"
        items = "".join(f'<{tag}><a href="/x">{self.words(1, 4, cue)}</a></{tag}>' for _ in range(n))
        return f"<ul>{items}</ul>" if tag == "li" else items

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        if kind in ("nav", "share") or (kind in ("aside", "header") and r.random() < 0.5):
            inner = self.links(int(r.integers(2, 9)), kind)
        elif kind == "comments":
            inner = "".join(self.named("comments", 0, (
                f"<b>{self.words(1, 2)}</b>" if r.random() < 0.5 else "") + f"<p>{self.prose(1, 4, kind)}</p>",
                self.pick("div li article")) for _ in range(r.integers(1, 6)))
            inner = f"<h3>{self.words(1, 3, kind)}</h3>" + inner
        elif kind == "form":
            inner = f'<label>{self.words(1, 4, kind)}</label><input name="q"><button>' \
                    f"{self.words(1, 2, kind)}</button>"
        elif kind == "footer":
            inner = f"&copy; {self.words(1, 6, kind)} &middot; {self.prose(1, 2, kind)}"
            inner = f"<p>{inner}</p>" if r.random() < 0.5 else inner
        else:
            inner = self.prose(1, 2, kind)
            inner = f"<p>{inner}</p>" if r.random() < 0.5 else inner
            if r.random() < 0.2:
                inner = f"<h4>{self.words(1, 3, kind)}</h4>" + inner
        return self.named(kind, 0, inner)

    def article(self) -> str:
        r = self.rng
        parts = [f"<h1>{self.words(2, 10)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.integers(1, 10)):
            kind = r.random()
            if kind < 0.7:
                # Short paragraphs and ones with menu or footer words occur in articles.
                size = r.random()
                text = self.words(1, 5) + "." if size < 0.2 else self.prose(
                    1, 2, self.pick(" ".join(CUES))) if size < 0.35 else self.prose(1, 6)
                if r.random() < 0.3:
                    text = f"<b>{text}<br>"
                elif r.random() < 0.3:
                    text += f' <a href="/y">{self.words(1, 4)}</a> {self.words(2, 8)}.'
                parts.append(f"<p>{text}" + ("</p>" if r.random() < 0.85 else ""))
            elif kind < 0.78:
                parts.append(f"<h2>{self.words(1, 6)}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 10)}</li>"
                                              for _ in range(r.integers(2, 5))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote>{self.prose(1, 3)}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            else:
                parts.append(self.boilerplate(self.pick("advert share form notice aside")))
        inner = "".join(parts)
        tag = self.pick(TAGS["main"])
        if tag == "td":
            return f"<table><tr>{self.named('main', 1, inner, 'td')}</tr></table>"
        if r.random() < 0.3:
            inner = self.named("main", 1, inner, "div")
        if r.random() < 0.15:
            # Comments and related links inside the container of the article.
            inner += self.boilerplate(self.pick("comments aside share"))
        return self.named("main", 1, inner, tag)

    def page(self) -> str:
        r = self.rng
        before = [k for k in ("header", "nav", "notice", "advert", "form", "aside")
                  if r.random() < (0.6 if k in ("header", "nav") else 0.3)]
        after = [k for k in ("share", "advert", "comments", "aside", "form", "nav", "notice", "footer")
                 if r.random() < (0.75 if k == "footer" else 0.4 if k == "comments" else 0.25)]
        return ("<html><head><title>x</title></head><body>" + "".join(map(self.boilerplate, before))
                + self.article() + "".join(map(self.boilerplate, after)) + "</body></html>")


def training_rows(pages: int, seed: int) -> tuple[list[Rows], list[np.ndarray]]:
    layout, memo = Layout(seed), {}
    rows, labels = [], []
    for _ in range(pages):
        found = blocks(layout.page())
        rows.append(featurize(found, memo))
        labels.append(np.array([b.mark for b in found], np.float32))
    return rows, labels


def marked_rows(pages: list[str]) -> tuple[list[Rows], list[np.ndarray]]:
    """Rows of pages whose own markup tells the article: exactly one ``article``
    or ``main`` element, and no part below it named as something else."""
    other = {w for k in PARTS if k != "main" for w in PARTS[k].split() if "-" not in w}
    rows, labels, memo = [], [], {}
    for page in pages:
        if len(re.findall(r"<(?:article|main)\b", page)) != 1:
            continue
        found = blocks(page)
        marks = []
        for b in found:
            at = max((k for k, t in enumerate(b.path) if t in ("article", "main")), default=-1)
            marks.append(at >= 0 and not other.intersection(b.path[at + 1:]))
        if found:
            rows.append(featurize(found, memo))
            labels.append(np.array(marks, np.float32))
    return rows, labels


def train(train_pages: int = 1000, epochs: int = 8, seed: int = 11,
          marked: list[str] | None = None) -> Labeller:
    rows, labels = training_rows(train_pages, seed)
    more = marked_rows(marked or [])
    model = Labeller()
    model.fit(rows + more[0], labels + more[1], epochs=epochs)
    return model


def _extractor(weights: dict[str, np.ndarray], hidden: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Labeller(hidden)
        model.p = weights
        memo: dict[str, int] = {}
        for part in parts:
            found = [blocks(h) if h else [] for h in part["html"]]
            texts = [""] * len(found)
            # Pages of like length run together, a bounded number of blocks at a time.
            order = sorted((i for i, b in enumerate(found) if b), key=lambda i: len(found[i]))
            lo = 0
            while lo < len(order):
                hi = lo + 1
                while hi < min(lo + 256, len(order)) and \
                        (hi + 1 - lo) * len(found[order[hi]]) <= 16_384:
                    hi += 1
                pick = order[lo:hi]
                rows = [featurize(found[i], memo) for i in pick]
                for i, main in zip(pick, model.main_blocks(rows), strict=True):
                    texts[i] = "\n".join(b.text for b, m in zip(found[i], main, strict=True) if m)
                lo = hi
            yield pd.DataFrame({"page_id": part["page_id"].array, "url": part["url"].array,
                                "text": texts, "n_chars": [len(t) for t in texts]})
    return run


def sample_pages(pages: DataFrame, most: int, url_col: str = "url", html_col: str = "html") -> list[str]:
    """The pages of the ``most`` smallest hashes (copies count once). The hashes are
    chosen first, so no task sends more pages than are wanted."""
    hashed = pages.where(F.length(html_col).between(1, 200_000)).select(
        F.xxhash64(url_col, html_col).alias("h"), F.col(html_col).alias("html"))
    wanted = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(most).collect()]
    if not wanted:
        return []
    found = hashed.where(F.col("h").isin(wanted)).groupBy("h").agg(F.any_value("html").alias("html"))
    return [r.html for r in sorted(found.collect(), key=lambda r: r.h)]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", model: Labeller | None = None,
              fit_pages: int = 150) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. Without ``model`` the
    labeller is trained first, on the driver, in bounded time."""
    if model is None:
        model = train(marked=sample_pages(pages, fit_pages, url_col, html_col))
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"))
    kind = narrow.schema["page_id"].dataType.simpleString()
    return narrow.mapInPandas(_extractor(model.p, model.hidden),
                              f"page_id {kind}, url string, text string, n_chars long")
