"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags). Each block is a vector: the mean of the hashed tokens of
its tag path (its innermost ``PATH`` elements: tags and the words of their class, id and role), the mean of its hashed words,
and six measures. A bidirectional LSTM in numpy reads the whole page's blocks and says for each whether it is main text; a
block is judged by the LSTM's states alone.

There is no gold text to learn from, so the network is trained on a bounded sample of the pages: blocks inside an
article that no boilerplate container holds are main text. Each sampled page is also re-dressed several times: its main
blocks in another container, among menus, notices, adverts, teasers, forms, footers and reader comments before, inside and
after it (``MAIN``, ``KINDS``). Half of the containers bear a made-up name or none, so that structure, words and
the order of the page are learned, not only names.

A block is main text at a probability of one half. On a page none of whose blocks reaches that, the blocks count that reach half of
the page's greatest probability, unless that is below ``DOUBT``: then the page has no main text.

Pages are scanned in linear time: where quotes of a tag do not close, the rest of the page is read without quotes.

Defined cases: null html is empty; pages without blocks or without main text give an empty text; unclosed tags
end with their container (unclosed script, style, textarea and title with the page); repeated rows each get a row; null ids and urls are kept; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .sample import Adam, sigmoid

#: Elements whose content is no markup, up to their end tag.
RAW = frozenset("script style textarea title".split())
NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
QUOTE_OR_END = re.compile("[>\"']")
#: Elements that go with their content where they are closed; without an end tag, only the tag itself goes.
DROPPED = frozenset("noscript template svg iframe select".split())
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: For training: containers of main text, and kinds of everything else with containers of theirs, as paths of tag.class.
MAIN = "article;main;main article;div.content;div#main;div.post;div.entry-content;div.article-body;section.article;div.story;div.text;div.body;td;section;div;body".split(";")
KINDS = {
    "menu": "nav ul li;ul.menu li;div.menu;div.menu a;header;div.header;div.topbar;ul li;div;div.breadcrumb;div.pagination;div.tags;td;ol li".split(";"),
    "notice": "div.cookie;div.cookie-notice p;div.notice;div.consent;div.alert;div.popup;div.modal p;div.banner;div p;div;aside;dialog".split(";"),
    "advert": "div.ad;div.ads;div.advert;div.advertisement p;div.promo p;div.sponsored;aside.ad;div.banner;div;iframe-slot;section".split(";"),
    "teasers": "aside;aside p;div.sidebar;div.sidebar p;div#sidebar ul li;div.related;div.related ul li;div.share;div.social;ul li;div;section ul li".split(";"),
    "form": "form;form p;form.search;form.newsletter;div.subscribe;div.signup p;div.login;form div;div".split(";"),
    "footer": "footer;footer p;div.footer;div#footer;div.copyright;footer ul li;div;div p;td".split(";"),
    "comments": "section.comments;div.comments p;section#comments div.comment p;ol.comments li;div.comment;div.thread div;section.discussion div;div.replies;div.responses p;ul li;div div;div;section;ol li p".split(";"),
}
#: Words that such blocks often hold, in the languages of the tables; in half of the blocks the page's own words stand alone.
TYPICAL = {
    "menu": "home;about;contact;news;sports;terms;privacy;login;archive;help;search;products;blog;inicio;contacto;noticias;accueil;contact;actualités;startseite;kontakt;nachrichten;impressum;über uns;next;previous".split(";"),
    "notice": "we use cookies;accept all cookies;this site uses cookies to improve your experience;privacy settings;update your browser;wir verwenden cookies;nous utilisons des cookies;usamos cookies".split(";"),
    "advert": "advertisement;sponsored;buy now;limited offer;anzeige;publicité;publicidad;shop now".split(";"),
    "teasers": "related;read more;most read;popular;share;tweet;you may also like;mehr lesen;à lire aussi;leer más;see also".split(";"),
    "form": "subscribe to our newsletter;your e-mail;name;send;search;sign in;password;abonnieren;s'abonner;suscribirse;submit".split(";"),
    "footer": "all rights reserved;© 2024;©;terms of use;privacy policy;imprint;contact;impressum;datenschutz;mentions légales;aviso legal".split(";"),
    "comments": "reply;like;report;says;wrote;posted;2 days ago;yesterday;3 hours ago;comments;antworten;répondre;responder;commented".split(";"),
}
LEAVES = ("p", "p", "p", "p", "p", "h2", "h3", "ul li", "ol li", "blockquote", "blockquote p", "table tr td", "div", "pre", "figure figcaption", "dl dd")
#: Words of tags, classes and ids that mark a container as boilerplate, for the labels of the sample.
BOILERPLATE = re.compile(
    r"^(nav|header|footer|aside|form|menu|dialog|button|navbar|navigation|topbar|sidebar|side|ads?|adverts?|advertisements?|banner|promos?|sponsored|sponsor|cookies?|notice|consent|gdpr|alert|popup|modal|newsletter|subscribe|signup|comments?|replies|discussion|thread|responses|related|share|social|breadcrumbs?|pagination|pager|tags|login|search|copyright|masthead|widget)$"
)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Where no block of a page reaches one half, those count that reach half of its greatest probability, if that is not below this.
DOUBT = 0.1
PATH_BUCKETS, WORD_BUCKETS, DIM, MEASURES, HIDDEN, PATH = 1 << 10, 1 << 12, 16, 6, 20, 8
Block = tuple[tuple[str, ...], str, float]


def _name(tag: str, attributes: str) -> tuple[str, ...]:
    """Path tokens of an element: its tag, and its class, id and role words."""
    out = [tag]
    for kind, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        for word in re.split(r"[\s_-]+", (a or b or c).lower()):
            if word:
                out += [word, f"{kind.lower()}={word}"]
    return tuple(out)


def tokens(html: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, tag, attributes) of each piece of markup; tag is empty where nothing but its place counts, / leads an end tag's."""
    at, quotes = 0, True
    lower = html.lower() if "<" in html else html
    same = len(lower) == len(html)  # a few letters change length
    no_end: set[str] = set()
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(html)
            yield start, at, "", ""
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            if end < 0:
                return
            at = end + 1
            yield start, at, "", ""
            continue
        m = NAME.match(html, start + 1)
        if not m:
            continue
        end = _end(html, m.end()) if quotes else html.find(">", m.end())
        if end < 0 and quotes:
            quotes, end = False, html.find(">", m.end())
        if end < 0:
            return
        tag = m[1].lower()
        if tag in RAW and html[start + 1] != "/" and tag not in no_end:
            close = (lower if same else html).find(f"</{tag}", end)
            if close < 0:
                no_end.add(tag)
            stop = html.find(">", close) if close >= 0 else -1
            at = stop + 1 if stop >= 0 else len(html)
            yield start, at, "", ""
            continue
        at = end + 1
        yield start, at, ("/" if html[start + 1] == "/" else "") + tag, html[m.end() : end]


def _end(html: str, at: int) -> int:
    """Place of the tag's > outside quotes; -1 without one."""
    while m := QUOTE_OR_END.search(html, at):
        if m[0] == ">":
            return m.start()
        at = html.find(m[0], m.end()) + 1
        if not at:
            return -1
    return -1


def _dropped(html: str, found: list[tuple[int, int, str, str]]) -> dict[int, int]:
    """Start of each closed element of ``DROPPED`` in the page, to its end; nested ones of a name are paired inside out."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for start, end, tag, _ in found:
        name = tag.lstrip("/")
        if name in DROPPED:
            if tag[0] == "/":
                if opened.get(name):
                    out[opened[name].pop()] = end
            elif not (name == "svg" and html[end - 2] == "/"):
                opened.setdefault(name, []).append(start)
    return out


def blocks(html: str | None) -> list[Block]:
    """(path tokens, text, share of text in links) of each block that has text, in page order."""
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    depth: Counter[str] = Counter()
    parts: list[str] = []
    links = in_link = 0

    def close() -> None:
        nonlocal links
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((tuple(t for _, name in stack[-PATH:] for t in name), text, min(1.0, links / len(text))))
        parts.clear()
        links = 0

    def pop() -> str:
        tag = stack.pop()[0]
        depth[tag] -= 1
        return tag

    at = 0
    found = list(tokens(html))
    dropped = _dropped(html, found)
    for start, end, tag, attributes in found:
        if start < at:
            continue
        if start > at:
            parts.append(html[at:start])
            links += in_link * (start - at)
        at = dropped.get(start, end)
        ending = tag[:1] == "/"
        tag = tag.lstrip("/")
        if tag == "a":
            in_link = int(not ending)
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            close()
            in_link = 0
            if ending:
                if depth[tag]:
                    while pop() != tag:
                        pass
                continue
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                pop()
                if tag == "li" and stack and stack[-1][0] == "li":
                    pop()
            if tag not in VOID:
                stack.append((tag, _name(tag, attributes)))
                depth[tag] += 1
    parts.append(html[at:])
    close()
    return out


def rule_labels(page: list[Block]) -> list[int]:
    """1 for blocks in an article or main element (in any element, where a page has neither) outside boilerplate."""
    good = [not any(BOILERPLATE.match(t) for t in path) for path, _, _ in page]
    inside = [not {"article", "main"}.isdisjoint(path) for path, _, _ in page]
    return [int(g and (i or not any(inside))) for g, i in zip(good, inside, strict=True)]


class Features:
    """Hashed features of pages. Distinct path tokens are hashed once, words all at once in numpy."""

    def __init__(self, limit: int = 300_000):
        self.paths: dict[str, int] = {}
        self.limit = limit
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        base = 0x9E3779B97F4A7C15
        self.up, self.down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words, end to end, and each text's number of words, by a polynomial hash of their bytes."""
        data = np.frombuffer("\n".join(texts).encode("utf-8", "replace").translate(LOWER), np.uint8)
        if len(data) > len(self.up):
            self._powers(2 * len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.down[: len(data)], out=sums[1:])
        space = (data == 32) | (data == 10)
        first = np.flatnonzero(~space & np.r_[True, space[:-1]])
        last = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
        hashes = (sums[last] - sums[first]) * self.up[first]
        hashes ^= hashes >> np.uint64(31)
        lines = np.searchsorted(np.flatnonzero(data == 10), first)
        return ((hashes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS, np.bincount(lines, minlength=len(texts))

    def page(self, page: list[Block]) -> tuple[list[list[int]], tuple[np.ndarray, np.ndarray], np.ndarray]:
        path_ids = []
        measures = np.empty((len(page), MEASURES), np.float32)
        for k, (path, text, links) in enumerate(page):
            path_ids.append([self._path(t) for t in path or ("",)])
            measures[k] = len(text), links, k / len(page), min(1.0, len(page) / 50), text[-1] in ".!?…:;\"”»", k > 0 and path == page[k - 1][0]
        measures[:, 0] = np.minimum(1.5, np.log1p(measures[:, 0]) / 6)
        return path_ids, self.words([text for _, text, _ in page]), measures

    def _path(self, token: str) -> int:
        if token not in self.paths:
            if len(self.paths) > self.limit:
                self.paths.clear()
            self.paths[token] = zlib.crc32(token.encode("utf-8", "replace")) % PATH_BUCKETS
        return self.paths[token]


def init(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"path": (PATH_BUCKETS, DIM), "word": (WORD_BUCKETS, DIM), "wx": (2, 2 * DIM + MEASURES, 4 * HIDDEN), "u": (2, HIDDEN, 4 * HIDDEN), "b": (2, 1, 4 * HIDDEN), "out": (2 * HIDDEN,), "bias": (1,)}
    scale = {"b": 0, "bias": 0, "path": 0.1, "word": 0.05}
    return {k: (rng.standard_normal(s) * scale.get(k, 0.25)).astype(np.float32) for k, s in shapes.items()}


def _means(vectors: np.ndarray, flat: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return np.add.reduceat(vectors[flat], np.cumsum(lens) - lens, axis=0) / lens[:, None].astype(np.float32)


def _lstm(p: dict[str, np.ndarray], x: np.ndarray, places: np.ndarray, keep: bool):
    """x: (blocks + 1, features), last row zero. places: (2, steps, pages) numbers of blocks in reading order."""
    gates_in = x @ p["wx"] + p["b"]
    h = c = np.zeros((2, places.shape[2], HIDDEN), np.float32)
    trace = []
    states = np.zeros((2, len(x), HIDDEN), np.float32)
    for t in range(places.shape[1]):
        a = np.stack([gates_in[0, places[0, t]], gates_in[1, places[1, t]]]) + h @ p["u"]
        ifo = sigmoid(a[..., : 3 * HIDDEN])
        i, f, o = ifo[..., :HIDDEN], ifo[..., HIDDEN : 2 * HIDDEN], ifo[..., 2 * HIDDEN :]
        g = np.tanh(a[..., 3 * HIDDEN :])
        new = f * c + i * g
        tc = np.tanh(new)
        if keep:
            trace.append((h, c, i, f, o, g, tc))
        c, h = new, o * tc
        states[0, places[0, t]], states[1, places[1, t]] = h[0], h[1]
    return states, trace


def _places(lengths: list[int]) -> np.ndarray:
    """Reading orders of pages whose blocks are numbered end to end; steps past a page's end read the zero row."""
    total, steps = sum(lengths), max(lengths)
    out = np.full((2, steps, len(lengths)), total, np.int64)
    at = 0
    for k, n in enumerate(lengths):
        out[0, :n, k] = np.arange(at, at + n)
        out[1, :n, k] = np.arange(at + n - 1, at - 1, -1)
        at += n
    return out


def label(p: dict[str, np.ndarray], pages: list[tuple], keep: bool = False):
    """Probability of main text for the blocks of all pages, end to end."""
    paths = [x for page in pages for x in page[0]]
    path_lens = np.array([len(x) for x in paths])
    path_flat = np.fromiter(chain.from_iterable(paths), np.int64, int(path_lens.sum()))
    word_flat, word_lens = (np.concatenate(x) for x in zip(*(page[1] for page in pages), strict=True))
    path_mean, word_mean = _means(p["path"], path_flat, path_lens), _means(p["word"], word_flat, word_lens)
    x = np.concatenate([path_mean, word_mean, np.concatenate([page[2] for page in pages])], axis=1)
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    places = _places([len(page[0]) for page in pages])
    states, trace = _lstm(p, x, places, keep)
    top = np.concatenate([states[0, :-1], states[1, :-1]], axis=1)
    prob = sigmoid(top @ p["out"] + p["bias"][0])
    return (prob, (x, places, trace, top, path_flat, path_lens, word_flat, word_lens)) if keep else prob


def _back(p: dict[str, np.ndarray], kept, d: np.ndarray) -> dict[str, np.ndarray]:
    x, places, trace, top, path_flat, path_lens, word_flat, word_lens = kept
    g = {"out": top.T @ d, "bias": np.array([d.sum()], np.float32), "u": np.zeros_like(p["u"])}
    dtop = d[:, None] * p["out"]
    dstates = np.zeros((2, len(x), HIDDEN), np.float32)
    dstates[0, :-1], dstates[1, :-1] = dtop[:, :HIDDEN], dtop[:, HIDDEN : 2 * HIDDEN]
    dgates = np.zeros((2, len(x), 4 * HIDDEN), np.float32)
    dh = dc = np.zeros((2, places.shape[2], HIDDEN), np.float32)
    ut = p["u"].transpose(0, 2, 1)
    real = (places < len(x) - 1)[..., None]
    for t in range(places.shape[1] - 1, -1, -1):
        h, c, i, f, o, gg, tc = trace[t]
        dh = (dh + np.stack([dstates[0, places[0, t]], dstates[1, places[1, t]]])) * real[:, t]
        dc = dc * real[:, t] + dh * o * (1 - tc * tc)
        da = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - gg * gg)], axis=-1)
        dgates[0, places[0, t]], dgates[1, places[1, t]] = da[0], da[1]
        g["u"] += h.transpose(0, 2, 1) @ da
        dh, dc = da @ ut, dc * f
    dgates[:, -1] = 0
    g["b"] = dgates.sum(axis=1, keepdims=True)
    g["wx"] = x.T @ dgates
    dx = (dgates @ p["wx"].transpose(0, 2, 1)).sum(axis=0)[:-1]
    g["path"], g["word"] = np.zeros_like(p["path"]), np.zeros_like(p["word"])
    np.add.at(g["path"], path_flat, np.repeat(dx[:, :DIM] / path_lens[:, None], path_lens, axis=0))
    np.add.at(g["word"], word_flat, np.repeat(dx[:, DIM : 2 * DIM] / word_lens[:, None], word_lens, axis=0))
    return g


def _container(path: str, rng: np.random.Generator, named: float) -> tuple[str, ...]:
    """Path tokens of nested elements. With a chance of 1 - ``named`` their names are made up or left out."""
    out: list[str] = []
    known = rng.random() < named
    for element in path.split():
        tag, kind, word = re.fullmatch(r"([\w-]+?)(?:([.#])(.+))?", element).groups()
        if not known and tag not in PLAIN:
            tag = PLAIN[rng.integers(len(PLAIN))]
        if not known:
            word = "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(3, 9)))) if rng.random() < 0.6 else None
        out += _name(tag, f'{"id" if kind == "#" else "class"}="{word}"' if word else "")
    return tuple(out)


PLAIN = ("div", "div", "div", "section", "ul", "li", "p", "td")


def redress(page: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page's main blocks in another container, among other kinds of blocks that hold text of the same page."""
    main = [b for b, y in zip(page, labels, strict=True) if y]
    texts = [b[1].split() for b in page]
    if not main:
        return page, labels
    at = int(rng.integers(len(main)))
    main = main[at : at + int(rng.integers(1, 31 if rng.random() < 0.6 else 5))]
    named = 0.5 if rng.random() < 0.8 else 0.0
    root = ("html", "body", *(_container("div", rng, 0.3) if rng.random() < 0.5 else ()))
    some = lambda items: items[rng.integers(len(items))]

    def own(low: int, high: int) -> str:
        words = some(texts)
        start = int(rng.integers(max(1, len(words) - low)))
        return " ".join(words[start : start + int(rng.integers(low, high))])

    def other(kind: str, inside: tuple[str, ...]) -> list[tuple[Block, int]]:
        path = inside + _container(some(KINDS[kind]), rng, named)
        typical = lambda: some(TYPICAL[kind]).capitalize() if rng.random() < 0.6 else ""
        out: list[tuple[str, float]] = []
        if kind == "menu":
            out = [(typical() or own(1, 4), float(rng.random() < 0.9)) for _ in range(int(rng.integers(2, 10)))]
            if rng.random() < 0.3:  # all in one block
                out = [(" ".join(t for t, _ in out), float(rng.random() < 0.8))]
        elif kind in ("notice", "advert", "form"):
            out = [(f"{typical()} {own(2, 14)}".strip(), float(rng.random() < 0.3)) for _ in range(int(rng.integers(1, 3)))]
        elif kind == "teasers":
            out = [(typical() or own(1, 4), 0.0)] + [(own(4, 14), float(rng.random() < 0.8)) for _ in range(int(rng.integers(1, 7)))]
        elif kind == "footer":
            out = [(f"{typical()} {own(1, 12) if rng.random() < 0.6 else ''}".strip() or "©", float(rng.random() < 0.3)) for _ in range(int(rng.integers(1, 4)))]
        else:
            if rng.random() < 0.5:
                out.append((f"{int(rng.integers(1, 99))} {typical()}", 0.0))
            split, tail = rng.random() < 0.6, rng.random() < 0.5
            for _ in range(int(rng.integers(1, 6))):
                who = f"{own(1, 3)} {some(TYPICAL[kind])}" if rng.random() < 0.8 else own(1, 3)
                said = own(4, 50) + ("." if rng.random() < 0.5 else "")
                out += [(who, float(rng.random() < 0.3)), (said, 0.0)] if split else [(f"{who}: {said}", 0.0)]
                if tail:
                    out.append((some(TYPICAL[kind]).capitalize(), 1.0))
        deeper = path + _container("p", rng, 1.0) if rng.random() < 0.4 else path
        return [((deeper if rng.random() < 0.9 else path, t, link), 0) for t, link in out if t]

    flat = root + (some(PLAIN),) if rng.random() < 0.25 else None  # a page whose blocks all lie in one container, as siblings
    if flat and rng.random() < 0.7:
        main = main[: int(rng.integers(1, 5))]
    holder = root + _container(some(MAIN), rng, named)
    body: list[tuple[Block, int]] = []
    as_leaves = rng.random() < 0.9
    for k, (_, text, links) in enumerate(main):
        leaf = "h1" if k == 0 and rng.random() < 0.6 else some(LEAVES) if rng.random() < 0.4 else "p"
        if leaf in ("figure figcaption", "h2", "h3"):
            text = " ".join(text.split()[: int(rng.integers(3, 14))])
        elif rng.random() < 0.3:  # where a text ends does not tell its kind
            text = own(8, 60)
        body.append((((*holder, *leaf.split()) if as_leaves else holder, text, links if rng.random() < 0.9 else float(rng.random())), 1))
        if rng.random() < 0.12:  # a list of short items belongs to the text around it
            items = (*holder, *some(("ul li", "ul li", "ol li", "ul li p")).split())
            body += [((items, own(2, 12), float(rng.random() < 0.1)), 1) for _ in range(int(rng.integers(2, 7)))]
        if rng.random() < 0.08:
            body += other(some(("advert", "teasers", "form")), holder)
    rows: list[tuple[Block, int]] = []
    for kind, chance in (("notice", 0.3), ("menu", 0.8), ("advert", 0.3), ("form", 0.2), ("teasers", 0.2)):
        rows += other(kind, root) if rng.random() < chance else []
    rows += body
    if rng.random() < 0.6:
        rows += other("comments", holder if rng.random() < 0.4 else root)
    for kind, chance in (("teasers", 0.4), ("form", 0.2), ("advert", 0.2), ("menu", 0.3), ("footer", 0.7), ("notice", 0.15)):
        rows += other(kind, root) if rng.random() < chance else []
    if flat:
        # only short blocks can be told from the text there
        rows = [((flat, text, links if rng.random() < 0.3 else 0.0), y) for (_, text, links), y in rows if y or text.count(" ") < 6]
    return [b for b, _ in rows], [y for _, y in rows]


def fit(htmls: list[str], copies: int = 16, epochs: int = 4, batch: int = 16, rate: float = 0.01, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    features = Features()
    data = []
    for html in htmls:
        page = blocks(html)
        if page:
            labels = rule_labels(page)
            data += [(features.page(page), np.array(labels, np.float32))] * (copies // 4)  # as it is, a fifth of the time
            for _ in range(copies):
                other, y = redress(page, labels, rng)
                data.append((features.page(other), np.array(y, np.float32)))
    p = init(seed)
    adam = Adam(p, rate)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(len(data)), max(1, len(data) // batch)) if data else []:
            y = np.concatenate([data[i][1] for i in some])
            prob, kept = label(p, [data[i][0] for i in some], keep=True)
            adam.step(_back(p, kept, ((prob - y) / len(y)).astype(np.float32)))
    return p


def extract(p: dict[str, np.ndarray], htmls: list[str | None], features: Features) -> list[str]:
    """Main text of each page; pages of like length are labelled together."""
    parsed = [blocks(h) for h in htmls]
    out = [""] * len(htmls)
    order = sorted((k for k in range(len(parsed)) if parsed[k]), key=lambda k: len(parsed[k]))
    for at in range(0, len(order), 64):
        some = order[at : at + 64]
        prob = label(p, [features.page(parsed[k]) for k in some])
        start = 0
        for k in some:
            n = len(parsed[k])
            here = prob[start : start + n]
            most = float(here.max())
            cut = 0.5 if most >= 0.5 or most < DOUBT else most / 2
            out[k] = " ".join(b[1] for b, q in zip(parsed[k], here, strict=True) if q >= cut)
            start += n
    return out


def extract_pages(pages: DataFrame, sample_pages: int = 250, max_chars: int = 60_000) -> DataFrame:
    """(page_id, url, text, n_chars). The network is fitted on the first ``sample_pages`` pages by hash of id and html."""
    first = pages.where(F.length("html").between(1, max_chars)).select(F.xxhash64("page_id", "html").alias("_key")).distinct().orderBy("_key").limit(sample_pages)
    keyed = pages.select(F.xxhash64("page_id", "html").alias("_key"), "html")
    sample = keyed.join(F.broadcast(first), "_key").dropDuplicates(["_key"]).orderBy("_key")  # sample_pages rows at most
    p = fit([r.html for r in sample.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts = extract(p, b.column(2).to_pylist(), features)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
