"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the element tree.

A page is a sequence of blocks (`html_blocks`). Features of a block are the elements above it, what their class, id and role hint
at, its own element, lengths, links, punctuation, words that such blocks often hold, its place on the page and how much of the page's
text its element holds. A block is main text or not; the field has weights for features under each label and for pairs of neighbouring
labels, apart for neighbours in one element and in two. It is trained by the exact gradient of the likelihood (forward and
backward sums) and decoded by Viterbi.

Labelled pages: at most `max_pages` pages of the table (those with the smallest hash of their html, of at most `max_chars` characters) are
taken twice. First as they are, where one article or main element marks the main text. Then their texts are set into other
layouts by `compose`, each block with its label: articles in plain elements, menus, headers, side columns, notices, adverts, forms and
comments in many spellings, with and without class names. So neither one template nor the name of an element decides.

Results for special cases: a null or empty page, and one without main text, has an empty text; repeated rows and null ids
are kept; a page that is cut or badly nested is read as far as it goes; an empty table gives an empty result; columns named
in `keep` stay as they are, others are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_arrow
from .html_blocks import ABOVE, GROUPS, LEAVES, NESTED, Block, blocks

# Words that blocks beside the main text often hold, in four languages, by kind.
PHRASES = {
    "notice": "cookie, cookies, consent, gdpr, einwilligung, consentimiento, consentement, datenschutz, privacidad, confidentialité",
    "comment": "comment, comments, kommentar, kommentare, commentaire, commentaires, comentario, comentarios, reply, replies, antworten, répondre, responder",
    "share": "share, teilen, partager, compartir, follow us, tweet, facebook, twitter, instagram, whatsapp",
    "legal": "©, copyright, all rights reserved, imprint, impressum, privacy, terms of, mentions légales, aviso legal, powered by",
    "account": "sign in, sign up, log in, login, register, anmelden, registrieren, connexion, iniciar sesión, password, passwort, e-mail",
    "advert": "advertisement, sponsored, anzeige, werbung, publicité, publicidad, patrocinado",
    "more": "read more, related, mehr lesen, lire la suite, leer más, popular, recommended, trending, next, previous, skip to",
    "form": "search, suche, rechercher, buscar, newsletter, subscribe, abonnieren, abonner, suscribirse",
}
_KINDS = [(p.strip(), i) for i, words in enumerate(PHRASES.values()) for p in words.split(",")]
_ONE_WORD = {p: i for p, i in _KINDS if p.isalnum() or p == "©"}
_OTHERS = [(f" {p.replace('-', ' ')} ", i) for p, i in _KINDS if p not in _ONE_WORD]
_TOKEN = re.compile(r"\w+|©")
_END = re.compile(r"[.!?…:;»\"”)]\W*$")
_AGO = re.compile(r"\b(?:\d+ (?:hours?|days?|minutes?|weeks?|months?) ago|vor \d+|il y a \d+|hace \d+|\d{4}-\d\d-\d\d|\d{1,2}[:.]\d\d)\b", re.I)
WIDTHS = (1, 2, 4, 8, 16, 32, 64, 128)
NAMES = (
    [f"above {x}" for x in ABOVE] + [f"hint {x}" for x in GROUPS] + ["nested article"] + [f"nearest {x}" for x in GROUPS] + [f"leaf {x}" for x in LEAVES] + [f"words >= {x}" for x in WIDTHS] + [f"holds {x}" for x in PHRASES]
    + ["ends a sentence", "date", "own share", "own most", "outer share", "outer most", "article elsewhere", "repeated"]
    + ["links", "all links", "some links", "commas", "digits", "capitals", "first", "last", "start", "end", "no article", "bias"]
)
_BITS = len(ABOVE) + len(GROUPS) + 1


def features(page: list[Block]) -> np.ndarray:
    """A row of len(NAMES) numbers for each block."""
    n = len(page)
    x = np.zeros((n, len(NAMES)), np.float32)
    if not n:
        return x
    above = np.array([b.above for b in page], np.uint64)
    x[:, :_BITS] = above[:, None] >> np.arange(_BITS, dtype=np.uint64) & np.uint64(1)
    at = _BITS
    x[:, at : at + len(GROUPS)] = np.array([b.nearest for b in page], np.int64)[:, None] >> np.arange(len(GROUPS)) & 1
    at += len(GROUPS)
    leaf = {name: i for i, name in enumerate(LEAVES)}
    own, outer, same = Counter(), Counter(), Counter()
    for b in page:
        own[b.parent] += len(b.text)
        outer[b.grand] += len(b.text)
        same[b.text] += 1
    total = sum(own.values())
    most, outer_most = max(own.values()), max(outer.values())
    marked = any(b.above & 3 for b in page)  # article or main
    size = np.array([len(b.text) for b in page])
    code = np.frombuffer("".join(b.text for b in page).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(size) - size
    tally = lambda which: np.add.reduceat(which, starts, dtype=np.int64)  # noqa: E731  over the characters of each block
    words = tally(code == 32) + 1
    digits = tally(code - np.uint32(48) < 10)
    capitals = tally((code - np.uint32(65) < 26) | (code - np.uint32(192) < 31))
    links = np.array([b.linked for b in page]) / size
    rows = []
    for i, (b, w, d) in enumerate(zip(page, words.tolist(), digits.tolist(), strict=True)):
        text, held = b.text, [False] * len(PHRASES)
        if w <= 60:
            tokens = _TOKEN.findall(text.lower())
            for t in tokens:
                if t in _ONE_WORD:
                    held[_ONE_WORD[t]] = True
            line = f" {' '.join(tokens)} "
            for phrase, kind in _OTHERS:
                if phrase in line:
                    held[kind] = True
        ago = d > 0 and w <= 30 and _AGO.search(text) is not None
        rows.append((*held, _END.search(text[-20:]) is not None, ago, own[b.parent] / total, own[b.parent] == most, outer[b.grand] / total, outer[b.grand] == outer_most, marked and not b.above & 3, same[text] > 1))
        if b.leaf in leaf:
            x[i, at + leaf[b.leaf]] = 1
    at += len(LEAVES)
    x[:, at : at + len(WIDTHS)] = words[:, None] >= np.array(WIDTHS)
    at += len(WIDTHS)
    told = np.array(rows, np.float32)
    x[:, at : at + told.shape[1]] = told
    at += told.shape[1]
    place = np.arange(n) / n
    rest = (links, links > 0.9, (links > 0) & (links <= 0.9), np.minimum(tally(code == 44) / words, 1), digits / size, capitals / size, place == 0, place == place[-1], place, 1 - place, np.full(n, not marked), np.ones(n))
    x[:, at:] = np.stack(rest, axis=1)
    return x


def joints(page: list[Block]) -> np.ndarray:
    """For each block but the first, whether it lies in the same element as the one before it."""
    return np.array([a.parent == b.parent for a, b in zip(page[:-1], page[1:], strict=True)], np.int64)


class Field:
    """Weights: `own` (features, 2) and `pair` (2 kinds of neighbours, label before, label)."""

    def __init__(self, own: np.ndarray, pair: np.ndarray):
        self.own, self.pair = own, pair

    def label(self, page: list[Block]) -> np.ndarray:
        """The most probable labels together."""
        return viterbi(features(page).astype(np.float64) @ self.own, self.pair[joints(page)]) if page else np.zeros(0, np.int64)

    def pack(self) -> bytes:
        return np.concatenate([self.own.ravel(), self.pair.ravel()]).astype("<f8").tobytes()

    @classmethod
    def unpack(cls, packed: bytes) -> Field:
        w = np.frombuffer(packed, "<f8")
        return cls(w[:-8].reshape(-1, 2), w[-8:].reshape(2, 2, 2))


def viterbi(unary: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Labels of the greatest sum; label 0 where sums are equal."""
    a, b = unary[0].tolist()
    back = []
    for (u0, u1), ((p00, p01), (p10, p11)) in zip(unary[1:].tolist(), pairs.tolist(), strict=True):
        from0, from1 = a + p00, b + p10
        to0, to1 = a + p01, b + p11
        back.append((from1 > from0, to1 > to0))
        a, b = max(from0, from1) + u0, max(to0, to1) + u1
    out = [int(b > a)]
    for step in reversed(back):
        out.append(int(step[out[-1]]))
    return np.array(out[::-1])


def gradient(field: Field, x: np.ndarray, joint: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of padded pages and its gradient. x: (pages, blocks, features); joint: (pages, blocks - 1); y and mask: (pages, blocks)."""
    unary = np.where(mask[..., None], (x @ field.own.astype(x.dtype)).astype(float), 0.0)
    pages, length = mask.shape
    pair = field.pair[joint]  # pages, blocks - 1, 2, 2
    alpha, beta = np.zeros((pages, length, 2)), np.zeros((pages, length, 2))
    alpha[:, 0] = unary[:, 0]
    for t in range(1, length):
        step = np.logaddexp(alpha[:, t - 1, 0, None] + pair[:, t - 1, 0], alpha[:, t - 1, 1, None] + pair[:, t - 1, 1]) + unary[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        ahead = beta[:, t + 1] + unary[:, t + 1]
        step = np.logaddexp(pair[:, t, :, 0] + ahead[:, 0, None], pair[:, t, :, 1] + ahead[:, 1, None])
        beta[:, t] = np.where(mask[:, t + 1, None], step, beta[:, t + 1])
    whole = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    chosen = np.eye(2)[y] * mask[..., None]
    apart = chosen - np.exp(alpha + beta - whole[:, None, None]) * mask[..., None]
    d_own = (x.reshape(pages * length, -1).T @ apart.reshape(pages * length, 2).astype(x.dtype)).astype(float)
    d_pair = np.zeros((2, 2, 2))
    both = (mask[:, 1:] & mask[:, :-1]).astype(float)
    log_p = alpha[:, :-1, :, None] + pair + (beta + unary)[:, 1:, None, :] - whole[:, None, None, None]
    expected = np.exp(np.minimum(log_p, 0.0)) * both[..., None, None]
    told = chosen[:, :-1, :, None] * chosen[:, 1:, None, :]
    for kind in (0, 1):
        d_pair[kind] = ((told - expected) * (joint == kind)[..., None, None]).sum(axis=(0, 1))
    own_score = (unary * chosen).sum(axis=(1, 2)) + (pair * told).sum(axis=(1, 2, 3))
    return float((own_score - whole).sum()), d_own, d_pair


def train(pages: list[tuple[list[Block], np.ndarray]], steps: int = 250, rate: float = 0.1, penalty: float = 2e-4) -> Field:
    """Gradient ascent with Adam's step sizes on all pages at once; `penalty` times half the squared weights is taken off for each block."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: len(p[0]))
    field = Field(np.zeros((len(NAMES), 2)), np.zeros((2, 2, 2)))
    groups = []  # pages of like length are padded together
    for at in range(0, len(pages), 64):
        part = pages[at : at + 64]
        length = max(len(p) for p, _ in part)
        x, y = np.zeros((len(part), length, len(NAMES)), np.float32), np.zeros((len(part), length), np.int64)
        joint, mask = np.zeros((len(part), max(length - 1, 0)), np.int64), np.zeros((len(part), length), bool)
        for i, (page, labels) in enumerate(part):
            x[i, : len(page)], y[i, : len(page)], mask[i, : len(page)] = features(page), labels, True
            joint[i, : len(page) - 1] = joints(page)
        groups.append((x, joint, y, mask))
    n = sum(len(p) for p, _ in pages)
    weights = [field.own, field.pair]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1 if n else 1):
        sums = [np.zeros_like(w) for w in weights]
        for group in groups:
            _, *grads = gradient(field, *group)
            for s, g in zip(sums, grads, strict=True):
                s += g
        for w, s, m, v in zip(weights, sums, mean, square, strict=True):
            g = s / n - penalty * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def self_labelled(page: list[Block]) -> np.ndarray | None:
    """Labels of a page whose main text is one article or main element; None for others."""
    beside = sum(1 << ABOVE.index(x) for x in ("nav", "aside", "footer", "form", "search", "menu", "dialog"))
    hints = sum(1 << GROUPS.index(x) for x in ("menu", "side", "notice", "advert", "form", "comment", "share", "hidden"))
    for name in ("article", "main"):
        bit = 1 << ABOVE.index(name)
        inside = [bool(b.above & bit) for b in page]
        runs = sum(x and not y for x, y in zip(inside, [False, *inside], strict=False))
        if runs == 1:
            return np.array([int(x and not b.above & beside and not b.above & NESTED and not b.above >> len(ABOVE) & hints) for x, b in zip(inside, page, strict=True)])
    return None


class _Layout:
    """A page in the making: html, and the label of each block in order."""

    def __init__(self, rng: np.random.Generator, prose: list[str], short: list[str]):
        self.rng, self.prose, self.short, self.html, self.labels = rng, prose, short, [], []
        self.named = rng.random() < 0.75  # whether classes tell what elements are

    def one(self, *choices: str) -> str:
        return choices[int(self.rng.integers(len(choices)))]

    def some(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def paragraph(self) -> str:
        return self.one(*self.prose)

    def title(self) -> str:
        return self.one(*self.short)

    def open(self, tag: str, *names: str) -> str:
        """Open an element; its class or id is one of `names` if classes tell, else a number."""
        name = (self.one(*names) if names and self.named else self.one("", f"c{self.rng.integers(99)}", "row", "box"))
        attribute = f' {self.one("class", "class", "id")}="{name}"' if name else ""
        self.html.append(f"<{tag}{attribute}>")
        return tag

    def close(self, tag: str) -> None:
        self.html.append(f"</{tag}>")

    def block(self, tag: str, text: str, main: bool, linked: bool = False, unclosed: bool = False) -> None:
        shown = f'<a href="/{self.rng.integers(999)}">{text}</a>' if linked else text
        self.html.append(f"<{tag}>{shown}" + ("" if unclosed else f"</{tag}>"))
        self.labels.append(int(main))

    def menu(self) -> None:
        outer = self.open(self.one("nav", "div", "nav", "header"), "menu", "nav", "main-nav", "navbar", "breadcrumbs", "topbar")
        inner = self.open("ul")
        for _ in self.some(3, 9):
            self.block("li", self.title().split()[0], False, linked=True)
        self.close(inner)
        self.close(outer)

    def header(self) -> None:
        outer = self.open(self.one("header", "header", "div"), "header", "masthead", "branding", "site-header")
        self.block(self.one("h1", "div", "p"), self.title(), False, linked=self.rng.random() < 0.4)
        if self.rng.random() < 0.5:
            self.block("p", self.title(), False)
        self.close(outer)

    def footer(self) -> None:
        outer = self.open(self.one("footer", "footer", "div"), "footer", "colophon", "legal", "site-footer")
        for _ in self.some(1, 4):
            text = self.one(f"&copy; 20{self.rng.integers(10, 30)} {self.title()}", "All rights reserved.", self.title(), self.paragraph())
            self.block(self.one("p", "div"), text, False, linked=self.rng.random() < 0.2)
        self.close(outer)

    def aside(self) -> None:
        outer = self.open(self.one("aside", "aside", "div", "section"), "sidebar", "widget", "related", "side", "popular-posts", "rail")
        self.block("h3", self.one("Related", "Popular", "Read more", self.title()), False)
        for _ in self.some(1, 5):
            if self.rng.random() < 0.6:
                self.block(self.one("li", "p", "div"), self.title(), False, linked=True)
            else:
                self.block("p", self.paragraph(), False)
        self.close(outer)

    def notice(self) -> None:
        outer = self.open(self.one("div", "div", "section", "dialog"), "cookie-notice", "alert", "banner", "newsletter-popup", "consent", "notice", "modal")
        text = self.one("We use cookies to improve this site.", "Wir verwenden Cookies.", "Ce site utilise des cookies.", "Este sitio usa cookies.", "Subscribe to our newsletter.", self.title(), self.paragraph())
        self.block(self.one("p", "div"), text, False)
        self.close(outer)

    def advert(self) -> None:
        outer = self.open("div", "ad", "ads", "advert", "sponsored", "ad-slot", "promo")
        for _ in self.some(1, 2):
            self.block(self.one("p", "div"), self.one("Advertisement", self.title(), self.paragraph(), self.paragraph()), False, linked=self.rng.random() < 0.3)
        self.close(outer)

    def form(self) -> None:
        outer = self.open("form", "search", "login", "contact", "signup")
        for _ in self.some(1, 3):
            self.block(self.one("p", "div"), f"<label>{self.one('Search', 'E-mail', 'Name', 'Password', self.title(), self.paragraph())}</label> <input name=q>", False)
        self.html.append("<button>Send</button>")
        self.close(outer)

    def share(self) -> None:
        outer = self.open(self.one("div", "ul"), "share", "social", "sharing")
        for _ in self.some(2, 4):
            self.block("li", self.one("Share", "Tweet", "Facebook", "WhatsApp", "Teilen", "Partager"), False, linked=True)
        self.close(outer)

    def comments(self) -> None:
        outer = self.open(self.one("section", "div", "div"), "comments", "discussion", "comment-list", "responses", "disqus_thread")
        self.block(self.one("h2", "h3"), self.one("Comments", "Kommentare", "Commentaires", "Comentarios", "3 comments", "Discussion", self.title()), False)
        for _ in self.some(1, 5):
            inner = self.open(self.one("div", "li", "article"), "comment", "comment-body", "reply", "comment depth")
            if self.rng.random() < 0.7:
                self.block(self.one("div", "p", "h4"), self.one(self.title().split()[0], f"{self.title().split()[0]}, 3 hours ago", f"{self.title().split()[0]} 2021-03-04"), False)
            for _ in self.some(1, 2):
                self.block("p", self.one(self.paragraph(), self.title()), False)
            if self.rng.random() < 0.3:
                self.block("div", self.one("Reply", "Antworten"), False, linked=True)
            self.close(inner)
        self.close(outer)

    def article(self) -> None:
        outers = []
        for tag, *names in [(self.one("main", "div"), "main", "page", "wrapper", "content")] * int(self.rng.random() < 0.5) + [(self.one("article", "article", "div", "div", "section", "main", "td"), "post", "entry-content", "article-body", "story", "content", "post-text")]:
            if tag == "td":
                self.html.append("<table><tr>")
            outers.append((self.open(tag, *names), tag))
        if self.rng.random() < 0.8:
            wrapped = self.rng.random() < 0.2
            self.html.append("<header>" * wrapped)
            self.block("h1", self.title(), True)
            self.html.append("</header>" * wrapped)
        unclosed = self.rng.random() < 0.15
        paragraph = self.one("p", "p", "p", "p", "p", "p", "div", "section") if not unclosed else "p"
        for _ in self.some(1, 12):
            kind = self.rng.random()
            if kind < 0.62:
                self.block(paragraph, self.paragraph(), True, unclosed=unclosed)
            elif kind < 0.70:
                self.block(self.one("h2", "h3"), self.title(), True)
            elif kind < 0.77:
                tag = self.open(self.one("ul", "ol"))
                for _ in self.some(2, 5):
                    self.block("li", self.one(self.title(), self.paragraph()), True)
                self.close(tag)
            elif kind < 0.81:
                self.block("blockquote", self.paragraph(), True)
            elif kind < 0.84:
                self.html.append("<table>")
                for _ in self.some(1, 3):
                    self.html.append("<tr>")
                    for _ in self.some(2, 3):
                        self.block("td", self.title().split()[0], True)
                    self.html.append("</tr>")
                self.html.append("</table>")
            elif kind < 0.87:
                self.block("pre", self.title(), True)
            elif kind < 0.90:
                words = self.paragraph().split(" ")
                words[len(words) // 2] = f'<a href="/x">{words[len(words) // 2]}</a>'
                self.block("p", " ".join(words), True)
            else:
                self.one_of((self.advert, 4), (self.share, 2), (self.notice, 2), (self.aside, 2), (self.form, 1))
        if self.rng.random() < 0.2:
            self.one_of((self.share, 1), (self.comments, 2), (self.aside, 1))
        for tag, shown in reversed(outers):
            self.close(tag)
            if shown == "td":
                self.html.append("</tr></table>")

    def one_of(self, *parts) -> None:
        weight = np.array([w for _, w in parts], float)
        parts[int(self.rng.choice(len(parts), p=weight / weight.sum()))][0]()

    def page(self) -> None:
        form = self.rng.random() < 0.03  # some sites put a whole page in a form
        self.html.append("<!DOCTYPE html><html><head><title>x</title><style>p{margin:0}</style></head><body>" + "<form>" * form)
        order = [p for p, share in ((self.notice, 0.3), (self.header, 0.5), (self.menu, 0.8), (self.advert, 0.4), (self.form, 0.2), (self.aside, 0.2)) if self.rng.random() < share]
        for i in self.rng.permutation(len(order)) if self.rng.random() < 0.3 else range(len(order)):
            order[i]()
        if self.rng.random() < 0.95:
            self.article()
        for part, share in ((self.share, 0.2), (self.advert, 0.25), (self.comments, 0.4), (self.aside, 0.35), (self.form, 0.2), (self.menu, 0.15), (self.notice, 0.15), (self.footer, 0.85)):
            if self.rng.random() < share:
                part()
        self.html.append("</form>" * form + "</body></html>")


#: Used where no page of the table has a sentence.
_FILLER = ["It was a plain sentence, and nothing more than that was said.", "A second one followed."]


def compose(pages: list[list[Block]], n: int, seed: int = 11) -> list[tuple[str, np.ndarray]]:
    """`n` pages (html, labels) in layouts drawn at random, from the texts of `pages`."""
    rng = np.random.default_rng(seed)
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    texts = [escape(b.text) for page in pages for b in page]
    prose = [t for t in texts if t.count(" ") >= 7] or _FILLER
    short = [t for t in texts if t.count(" ") <= 9] or [t.split(".")[0] for t in _FILLER]
    out = []
    for _ in range(n):
        # a page draws from a few texts, so that it is not all pages' mean
        layout = _Layout(rng, [prose[i] for i in rng.integers(0, len(prose), 60)], [short[i] for i in rng.integers(0, len(short), 40)])
        layout.page()
        out.append(("".join(layout.html), np.array(layout.labels)))
    return out


def labelled(htmls: list[str], layouts: int = 1500, seed: int = 11) -> list[tuple[list[Block], np.ndarray]]:
    pages = [blocks(h) for h in htmls]
    own = [(p, y) for p in pages if (y := self_labelled(p)) is not None]
    made = [(blocks(h), y) for h, y in compose(pages, layouts, seed)]
    return own + [(p, y) for p, y in made if len(p) == len(y)]


def _train(batches: Iterator[pd.DataFrame], layouts: int) -> Iterator[pd.DataFrame]:
    rows = pd.concat([pd.DataFrame({"html": pd.Series(dtype=str)}), *batches], ignore_index=True).sort_values("html")
    if len(rows):
        yield pd.DataFrame({"model": [train(labelled(list(rows["html"]), layouts)).pack()]})


def learn(pages: DataFrame, html_col: str = "html", max_pages: int = 300, max_chars: int = 100_000, layouts: int = 1500) -> Field:
    """The field, from at most `max_pages` pages. What reaches one task is bounded by that sample. Without any, layouts hold a filler."""
    html = F.col(html_col).cast("string")
    rows = pages.select(html.alias("html"), F.xxhash64(html).alias("h")).filter((F.length("html") > 0) & (F.length("html") <= max_chars))
    chosen = rows.select("h").distinct().orderBy("h").limit(max_pages)
    sample = rows.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.max("html").alias("html"))
    found = sample.select("html").repartition(1).mapInPandas(partial(_train, layouts=layouts), "model binary").collect()
    return Field.unpack(found[0]["model"]) if found else train(labelled([], layouts))


def main_text(html: str, field: Field) -> str:
    page = blocks(html)
    return "\n".join(b.text for b, y in zip(page, field.label(page), strict=True) if y)


def _extract(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    field = Field.unpack(model.value)
    for batch in batches:
        kept = batch.num_columns - 1
        texts = [main_text(h or "", field) for at in range(0, batch.num_rows, 64) for h in batch.column(kept).slice(at, 64).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(texts, pa.string())], names=[*batch.schema.names[:kept], "text"])
        free_arrow()


def extract(pages: DataFrame, field: Field, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns `keep` of every row with `text` and `n_chars`."""
    shared = pages.sparkSession.sparkContext.broadcast(field.pack())  # as many numbers as there are features
    rows = pages.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(html_col).cast("string").alias("_html"))
    types = "".join(f"_{i} {pages.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = rows.mapInArrow(partial(_extract, model=shared), f"{types}text string")
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "text", F.char_length("text").cast("long").alias("n_chars"))
