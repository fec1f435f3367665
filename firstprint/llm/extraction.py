"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks: text between block-level tags, with inline tags taken out and character references
decoded. Each block is a row of numbers: hashed vectors of the tags, classes and ids above it (nearest ones weighted more),
hashed vectors of its words, and a few shares (links, length, punctuation). A bidirectional LSTM in numpy reads the rows of
a page in both directions and labels every block as main text or not, so a block is judged in the context of the whole page.

The labeller is trained when asked for, in seconds, on layouts whose labels are known: `training_pages` puts sentences of
a bounded sample of the given pages into generated pages with menus, headers, sidebars, adverts, notices, forms, comments
and footers. Pages are labelled whole, in batches of pages with similar numbers of blocks.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from firstprint.llm.caching import Remembered
from firstprint.llm.frames import frame

PATH_SIZE = 384
WORD_SIZE = 64
SHARES = 8
HIDDEN = 24
SAMPLE_PAGES = 200
LAYOUTS = 1200
EPOCHS = 8
SEED = 7
FADE = 0.92  # of a path name, for each name nearer to the block
STRIDE = 16

# HTML's element groups.
UNSEEN = {"script", "style", "head", "title", "noscript", "template", "svg", "iframe", "canvas", "audio", "video"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "picture", "source", "object", "param",
          "math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "msup", "msub", "msubsup", "mover",
          "munder", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd", "mstyle", "merror", "mpadded",
          "mphantom", "menclose", "maction", "semantics", "annotation"}
# What a head may hold; anything else ends a head that was left open.
HEADED = {"base", "basefont", "bgsound", "link", "meta", "title", "noscript", "noframes", "script", "style", "template"}
# Tags that end an svg that was left open, unless they stand in one of its elements that hold HTML.
LEAVES_SVG = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4",
              "h5", "h6", "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small",
              "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var"}
SVG_HOLDS_HTML = {"foreignobject", "desc", "title"}
CLOSED_BY_SAME = {"p", "li", "dt", "dd", "option", "tr", "td", "th"}

# Comments, declarations and tags, each ended as HTML ends it: a quote is one only where a value begins, and if it never ends
# it belongs to the value. What has begun is not tried another way.
_MARKUP = re.compile(r"""(?xs)
    <!--(?: -?> | .*?(?: --!?> | (?P<unended>\Z)))
    | <[!?][^>]*>
    | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
      (?P<attributes>(?> [\s/]++ | [^\s/>][^\s/>=]*+ (?: \s*+ = \s*+ (?: "[^"]*+" | '[^']*+' | [^\s>]*+ ) )?+ )*+)>""")
_COMMENT = re.compile("<[!?]")
_NAMES = re.compile(r"(?is)\b(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


class Path:
    """An open element: its tag, its names (tag, classes, ids), and the element above it."""

    __slots__ = ("tag", "names", "above", "depth", "vector")

    def __init__(self, tag: str, names: tuple[str, ...], above: Path | None):
        self.tag, self.names, self.above, self.vector = tag, names, above, None
        self.depth = above.depth + 1 if above else 1


def blocks_of(page: str | None) -> list[tuple[str, Path | None, float]]:
    """(text, path, share of link text) of each leaf block with text, in page order; in time that grows with the page alone."""
    page = page or ""
    stack: list[Path] = []
    open_tags: Counter[str] = Counter()
    out: list[tuple[str, Path | None, float]] = []
    parts: list[str] = []
    linked, hidden, at, last = 0, 0, 0, page.rfind(">") + 1

    def close() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append((text, stack[-1] if stack else None, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if stack and stack[-1].tag == "head" and text.strip():
            drop(len(stack) - 1)
        if text and not hidden:
            parts.append(text)
            if open_tags["a"]:
                linked += len(text)

    def push(tag: str, names: list[str]) -> None:
        nonlocal hidden
        stack.append(Path(tag, tuple(names), stack[-1] if stack else None))
        open_tags[tag] += 1
        hidden += tag in UNSEEN

    def drop(index: int) -> None:
        nonlocal hidden
        for element in stack[index:]:
            hidden -= element.tag in UNSEEN
            open_tags[element.tag] -= 1
        del stack[index:]

    def leave(tag: str) -> None:
        """Close a head or an svg that was left open before `tag`."""
        if not (open_tags["head"] or open_tags["svg"] and tag in LEAVES_SVG):
            return
        for index in range(len(stack) - 1, -1, -1):
            above = stack[index].tag
            if above in SVG_HOLDS_HTML or above == "head" and tag in HEADED:
                return
            if above == "head" or above == "svg" and tag in LEAVES_SVG:
                drop(index)
                if above == "head":
                    return

    while at < len(page):
        found = _MARKUP.search(page, at, last) if at < last else None
        if not found:  # a comment that never ends hides what follows
            rest = page[at:]
            add(_COMMENT.split(rest, maxsplit=1)[0])
            break
        add(page[at:found.start()])
        at = found.end()
        if found["unended"] is not None:
            break
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if tag not in INLINE:
            close()
        if found["end"]:
            if open_tags[tag]:
                drop(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
        else:
            leave(tag)
            if tag == "head" and len(stack) > open_tags["html"]:  # a head within a body is none
                continue
            if tag in CLOSED_BY_SAME and stack and stack[-1].tag == tag:
                drop(len(stack) - 1)
            if tag in VOID:  # a slash at the end closes nothing else in HTML
                continue
            names = [tag]
            if "=" in found["attributes"]:
                for name in _NAMES.finditer(found["attributes"]):
                    names += ["." + x.lower() for x in _PARTS.findall(entities.unescape(name[2] or name[3] or name[4] or ""))]
            push(tag, names)
            if tag in RAW:
                end = re.compile(rf"(?i)</{tag}\b[^>]*>").search(page, at)
                if tag not in UNSEEN:
                    add(page[at:end.start() if end else len(page)])
                at = end.end() if end else len(page)
                if tag not in INLINE:
                    close()
                drop(len(stack) - 1)
    close()
    return out


def _place(name: str, size: int, salt: str) -> tuple[int, float]:
    code = zlib.crc32((salt + name).encode("utf-8", "surrogatepass"))
    return code % size, 1.0 if code & 0x10000 else -1.0


class Vectors:
    """Hashed vectors of paths and words, remembered within a bound."""

    def __init__(self):
        self.paths = Remembered(self._names, most=20_000, longest=256)
        self.words = Remembered(lambda word: (lambda place, sign: 2 * place + (sign > 0))(*_place(word, WORD_SIZE, "word ")))

    @staticmethod
    def _names(names: tuple[str, ...]) -> np.ndarray:
        out = np.zeros(PATH_SIZE, np.float32)
        for depth, name in enumerate(reversed(names)):
            place, sign = _place(name, PATH_SIZE, "path ")
            out[place] += sign * FADE ** depth
        return out

    def _under(self, above: np.ndarray | None, names: list[str]) -> np.ndarray:
        own = self.paths[tuple(names)]
        return own if above is None else own + above * np.float32(FADE ** len(names))

    def of_path(self, path: Path | None) -> np.ndarray:
        """All names of the path, the nearest weighted most. Elements STRIDE apart keep their vectors for all below them."""
        steps, names = [], []
        while path is not None and path.vector is None:
            steps.append(path)
            path = path.above
        out = path.vector if path is not None else None
        for step in reversed(steps):
            names += step.names
            if step.depth % STRIDE == 0 or len(step.names) > STRIDE:
                out, names = self._under(out, names), []
                step.vector = out
        return self._under(out, names)

    def of_words(self, words: list[str]) -> np.ndarray:
        codes = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return np.bincount(codes >> 1, weights=(codes & 1) * 2.0 - 1, minlength=WORD_SIZE)


def rows_of(blocks: list[tuple[str, Path | None, float]], vectors: Vectors) -> np.ndarray:
    """One row of numbers per block."""
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + SHARES), np.float32)
    for i, (text, path, linked) in enumerate(blocks):
        words = _WORD.findall(text.lower())
        out[i, :PATH_SIZE] = vectors.of_path(path)
        spoken = vectors.of_words(words)
        out[i, PATH_SIZE:PATH_SIZE + WORD_SIZE] = spoken / max(1.0, np.linalg.norm(spoken))  # one word said often stays small
        stops = sum(text.count(x) for x in ".!?")
        capitals = len(text) - len(_CAPITAL.sub("", text))
        out[i, PATH_SIZE + WORD_SIZE:] = (linked, np.log1p(len(words)) / 4, stops / (len(words) + 1), text[-1] in ".!?",
                                          capitals / len(text), i / len(blocks), "©" in text, 1.0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scan(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states of an LSTM over (pages, blocks, numbers); padded blocks pass the state on."""
    n, steps, _ = x.shape
    size = u.shape[0]
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    given, states, kept = x @ w + b, np.zeros((n, steps, size), np.float32), []
    for t in range(steps):
        gates = given[:, t] + h @ u
        i, f, o = _sigmoid(gates[:, :size]), _sigmoid(gates[:, size:2 * size] + 1), _sigmoid(gates[:, 2 * size:3 * size])
        g, m = np.tanh(gates[:, 3 * size:]), mask[:, t, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        kept.append((h, c, i, f, o, g, squashed, m))
        h, c = m * (o * squashed) + (1 - m) * h, m * new + (1 - m) * c
        states[:, t] = h
    return states, kept


def _unscan(x: np.ndarray, d_states: np.ndarray, kept: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the weights of _scan by back-propagation through time."""
    n, steps, size = d_states.shape
    d_given, du = np.zeros((n, steps, 4 * size), np.float32), np.zeros_like(u)
    dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, squashed, m = kept[t]
        dh = dh + d_states[:, t]
        dnew = m * (dc + dh * o * (1 - squashed ** 2))
        dgates = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), m * dh * squashed * o * (1 - o), dnew * i * (1 - g ** 2)], axis=1)
        d_given[:, t] = dgates
        du += h.T @ dgates
        dh, dc = dgates @ u.T + (1 - m) * dh, dnew * f + (1 - m) * dc
    return np.einsum("nti,ntj->ij", x, d_given, optimize=True), du, d_given.sum(axis=(0, 1))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, page in enumerate(pages):
        x[i, :len(page)], mask[i, :len(page)] = page, 1
    return x, mask


def label(pages: list[np.ndarray], model: dict) -> list[np.ndarray]:
    """The chance of each block of each page to be main text."""
    x, mask = _padded(pages)
    ahead, _ = _scan(x, mask, *model["ahead"])
    back, _ = _scan(x[:, ::-1], mask[:, ::-1], *model["back"])
    w, v, b = model["out"]
    scores = _sigmoid(ahead @ w + back[:, ::-1] @ v + b)
    return [scores[i, :len(page)] for i, page in enumerate(pages)]


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.01) -> dict:
    """Fit the labeller with Adam on the log loss of every block."""
    rng = np.random.default_rng(SEED)
    width = pages[0].shape[1]
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    flat = [draw(width, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32),
            draw(width, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32),
            draw(HIDDEN), draw(HIDDEN), np.zeros((), np.float32)]
    first, second, step = [np.zeros_like(p) for p in flat], [np.zeros_like(p) for p in flat], 0
    for _ in range(epochs):
        order = np.argsort([len(p) + rng.random() * 8 for p in pages])
        groups = [order[i:i + 32] for i in range(0, len(order), 32)]
        for at in rng.permutation(len(groups)):
            x, mask = _padded([pages[i] for i in groups[at]])
            y = _padded([labels[i][:, None] for i in groups[at]])[0][:, :, 0]
            back_x, back_mask = np.ascontiguousarray(x[:, ::-1]), mask[:, ::-1]
            ahead, kept = _scan(x, mask, *flat[:3])
            back, back_kept = _scan(back_x, back_mask, *flat[3:6])
            back = back[:, ::-1]
            d = (_sigmoid(ahead @ flat[6] + back @ flat[7] + flat[8]) - y) * mask / mask.sum()
            slopes = [*_unscan(x, d[:, :, None] * flat[6], kept, flat[1]),
                      *_unscan(back_x, (d[:, :, None] * flat[7])[:, ::-1], back_kept, flat[4]),
                      np.einsum("nt,nth->h", d, ahead), np.einsum("nt,nth->h", d, back), d.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope ** 2
                flat[i] = (flat[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return {"ahead": tuple(flat[:3]), "back": tuple(flat[3:6]), "out": tuple(flat[6:])}


# Names that pages commonly give to their parts.
FURNITURE = {
    "menu": (("nav", "ul", "div", "td"), ("nav", "menu", "navbar", "breadcrumb", "topnav", "site-nav", "tabs", "toc", "pagination")),
    "header": (("header", "div"), ("header", "masthead", "site-header", "top-bar", "branding", "logo")),
    "footer": (("footer", "div"), ("footer", "site-footer", "copyright", "legal", "bottom", "colophon")),
    "sidebar": (("aside", "div", "td"), ("sidebar", "side", "related", "widget", "trending", "popular", "recommended", "more-links")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "promotion")),
    "notice": (("div", "section", "p"), ("cookie", "consent", "notice", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe", "paywall")),
    "form": (("form", "div"), ("form", "search", "login", "signup", "contact-form", "search-box")),
    "comments": (("section", "div", "ol"), ("comments", "comment-list", "discussion", "responses", "replies", "disqus", "reader-comments")),
    "share": (("div", "ul"), ("share", "social", "follow", "share-buttons", "tags", "meta-links")),
}
HOLDERS = (("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"), ("div", "story-body"),
           ("section", "article-body"), ("div", "main-content"), ("div", "text"), ("td", ""), ("div", ""))


def _layout(sentences: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """One generated page; the labels come back through a marker word that begins every block of main text."""
    say = lambda low, high: " ".join(rng.choice(sentences) for _ in range(rng.randint(low, high)))
    words = lambda low, high: " ".join(say(1, 2).split()[:rng.randint(low, high)])
    marked = lambda text: "\x01" + text

    def named(tag: str, names: tuple[str, ...] | str, inner: str) -> str:
        name = names if isinstance(names, str) else rng.choice(names) if rng.random() < 0.8 or tag in ("div", "section", "p", "ol", "td") else ""
        if rng.random() < 0.1 and name:
            name = name.title().replace("-", "")
        attribute = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def furniture(kind: str) -> str:
        tags, names = FURNITURE[kind]
        links = lambda n: "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(n))
        if kind in ("menu", "share"):
            inner = f"<ul>{links(rng.randint(2, 9))}</ul>" if rng.random() < 0.8 else " | ".join(f'<a href="#">{words(1, 2)}</a>' for _ in range(4))
        elif kind == "header":
            inner = f'<a href="/">{words(1, 3)}</a>' + rng.choice(("", f"<p>{words(2, 6)}</p>", f"<h1>{words(1, 3)}</h1>"))
        elif kind == "footer":
            inner = rng.choice((f"&copy; {words(1, 4)} &middot; {say(1, 2)}", f"<p>{say(1, 1)}</p><ul>{links(3)}</ul>", say(1, 2)))
        elif kind == "sidebar":
            inner = f"<h3>{words(1, 3)}</h3>" + rng.choice((f"<ul>{links(5)}</ul>", f"<p>{say(1, 2)}</p>", f"<p>{say(1, 1)}</p><ul>{links(3)}</ul>"))
        elif kind == "form":
            inner = f"<label>{words(1, 3)}</label><input><select><option>{words(1, 1)}</option></select><button>{words(1, 2)}</button>"
        elif kind == "comments":
            inner = f"<h3>{words(1, 2)}</h3>" + "".join(named(rng.choice(("div", "li", "p")), ("comment", "reply", "comment-body"), rng.choice(
                ("{0}", "<p>{0}</p>", "<b>{1}</b><p>{0}</p>")).format(say(1, 3), words(1, 2))) for _ in range(rng.randint(1, 5)))
        else:
            inner = rng.choice((say(1, 2), f"<p>{say(1, 2)}</p>", f'{say(1, 1)} <a href="#">{words(1, 2)}</a> <button>{words(1, 1)}</button>'))
        return named(rng.choice(tags), names, inner)

    def body() -> str:
        made = [f"<h1>{marked(words(3, 12))}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 10)):
            kind = rng.random()
            if kind < 0.62:
                made.append(f"<p>{marked(say(1, 6))}</p>")
            elif kind < 0.68:
                made.append(f"<h2>{marked(words(1, 6))}</h2>")
            elif kind < 0.74:
                made.append(f"<ul>{''.join(f'<li>{marked(say(1, 2))}</li>' for _ in range(rng.randint(2, 4)))}</ul>")
            elif kind < 0.78:
                made.append(f"<blockquote>{marked(say(1, 2))}</blockquote>")
            elif kind < 0.84:
                made.append(f"<p><b>{marked(say(1, 1))}<br>{marked(say(1, 2))}")
            elif kind < 0.96:
                made.append(furniture(rng.choice(("advert", "advert", "notice", "share", "sidebar", "form"))))
            else:
                made.append(f"<p>{marked(words(1, 2))}.</p>")
        return "".join(made)

    tag, name = rng.choice(HOLDERS) if rng.random() < 0.6 else ("article", "")
    main = named(tag, name, body())
    for _ in range(rng.randint(0, 2)):
        main = named("div", rng.choice(("", "wrapper", "container", "row", "page", "layout", "col")), main)
    before = [k for k in ("header", "menu", "notice", "advert", "form", "sidebar") if rng.random() < 0.45]
    after = [k for k in ("share", "comments", "sidebar", "advert", "form", "footer", "notice") if rng.random() < 0.45]
    rng.shuffle(before)
    page = "".join(map(furniture, before)) + main + "".join(map(furniture, after))
    if rng.random() < 0.3:
        page = named("div", rng.choice(("wrapper", "page", "container")), page)
    page = f"<html><head><title>{words(2, 6)}</title></head><body>{page}</body></html>"
    return page.replace("\x01", ""), [int(text.startswith("\x01")) for text, _, _ in blocks_of(page)]


def training_pages(sample: list[str], layouts: int = LAYOUTS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows and labels of generated pages that speak in sentences of the sample."""
    rng = random.Random(SEED)
    sentences = [s for page in sample for text, _, _ in blocks_of(page) for s in re.split(r"(?<=[.!?]) ", text) if 1 < len(s) < 400]
    sentences = [entities.escape(s) for s in sentences] or ["Some words stand here.", "More of them follow, as before."]
    vectors = Vectors()
    made = [_layout(sentences, rng) for _ in range(layouts)]
    made = [(blocks_of(page), marks) for page, marks in made]
    made = [(blocks, marks) for blocks, marks in made if blocks and len(blocks) == len(marks)]
    return [rows_of(blocks, vectors) for blocks, _ in made], [np.array(marks, np.float32) for _, marks in made]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict:
    """Train on layouts filled with sentences of the `sample_pages` pages whose ids have the smallest md5."""
    ids = pages.where("html is not null").select("page_id").distinct()
    ids = ids.orderBy(F.md5(F.col("page_id").cast("string")), "page_id").limit(sample_pages)  # ids alone are compared
    chosen = pages.select("page_id", "html").join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    return train(*training_pages([r["html"] for r in chosen.orderBy("page_id").collect()]))


def texts_of(pages: list[str | None], model: dict, vectors: Vectors, group: int = 64) -> list[str]:
    """The main text of each page."""
    read = [blocks_of(page) for page in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if read[i]), key=lambda i: len(read[i]))
    for at in range(0, len(order), group):
        chosen = order[at:at + group]
        for i, scores in zip(chosen, label([rows_of(read[i], vectors) for i in chosen], model)):
            out[i] = " ".join(text for (text, _, _), score in zip(read[i], scores) if score >= 0.5)
    return out


def _plain(values: pd.Series) -> list:
    return [None if pd.isna(x) else x for x in values]


def main_texts(pages: DataFrame, model: dict) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null or empty html, and a page without a block of main text, gives an empty text. Pages of any length are read whole;
    repeated rows give repeated results; null ids and urls are carried; other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch[at:at + 512]
                texts = texts_of(_plain(part["html"]), model, vectors)
                yield frame("page_id url text n_chars", zip(_plain(part["page_id"]), _plain(part["url"]), texts, map(len, texts)))

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
