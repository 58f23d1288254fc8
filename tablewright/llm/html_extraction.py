"""Main text of pages: a recurrent network labels the blocks of a page.

A page becomes a sequence of leaf blocks. A bidirectional LSTM reads for each the hashed path of tags and classes, its
hashed words and a few measures, and sees the blocks before and after; blocks it calls content make the text.
It is trained here on pages whose blocks are marked by their own semantic tags, and on the same blocks set into
other layouts, so that it does not depend on one site's tags.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import in_sample, kept, map_texts

# Training reads about this many pages that can be trained on, and of each at most so many blocks, of at most so many characters.
SAMPLE_PAGES = 300
SAMPLE_BLOCKS = 200
SAMPLE_CHARS = 2_000
# Where no page is marked, the longest texts of pages, of so many words at least, are laid out as training pages.
PLAIN_BLOCKS, PLAIN_WORDS = 12, 5
EPOCHS = 8
# So many pages in other layouts are trained on, however few are known.
LAID_PAGES = 1_000
PATH, WORDS, MEASURES, HIDDEN = 768, 96, 8, 16
# Rows of a page or of several that are spelled out at a time.
ROWS = 10_000

# Fixed values of HTML: elements whose content is no text, elements that begin a block, elements without an end,
# and the open elements that a start tag ends.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "iframe", "svg", "title", "button", "object", "math")
BLOCKS = frozenset(
    "html head body article aside section main nav header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre figure figcaption form fieldset legend address details summary dialog hr center menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_ITS_KIND = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}
STOPS = frozenset("ul ol dl table".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<more>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-label|itemprop)\b(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.IGNORECASE)
PART = re.compile(r"[A-Za-z]+")
UNENDED = re.compile(r"<!--|<!\[CDATA\[")
# A block's path tells so many outer and inner elements.
FAR = 100


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    link_chars: int


def path_parts(name: str, more: str) -> tuple[str, ...]:
    parts = [name]
    for m in NAMED.finditer(more):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() in ("hidden", "aria-label"):
            parts.append(m[1].lower())
        parts += [f"{m[1].lower()}={w.lower()}" for w in PART.findall(value)]
    return tuple(parts)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order: text between tags that begin or end blocks, references decoded, white space made one space.

    Markup may be broken: an end tag without its start is passed over, a start tag ends the paragraph it cannot
    lie in, and what is open at the end ends there.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    places: dict[str, list[int]] = {}  # of the open elements of each name, in the stack
    pieces: list[str] = []
    links, link_chars, at = 0, 0, 0

    def flush():
        nonlocal link_chars
        text = " ".join("".join(pieces).split())
        if text:
            near = stack if len(stack) <= 2 * FAR else stack[:FAR] + stack[-FAR:]
            out.append(Block(tuple(x for _, parts in near for x in parts), text, min(link_chars, len(text))))
        pieces.clear()
        link_chars = 0

    def add(raw: str):
        nonlocal link_chars
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if links:
                link_chars += len(text)

    def cut(size: int):
        while len(stack) > size:
            places[stack.pop()[0]].pop()

    def highest(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    # No tag ends behind the last ">": what looks like one there is not looked at again and again.
    last = page.rfind(">") + 1
    position = 0
    while m := TOKEN.search(page, position, last):
        add(page[at : m.start()])
        at = position = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if at == last and m[0].startswith(("<!--", "<![CDATA[")) and not m[0].endswith(("-->", "]]>")):
                at = len(page)  # it never ends
            continue
        if m["end"]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS and places.get(name):
                flush()
                cut(places[name][-1])
                links = 0
            continue
        if name in RAW:
            if not m["more"].rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*+>", re.IGNORECASE).search(page, position, last)
                at = position = end.end() if end else len(page)
            pieces.append(" ")
        elif name == "a":
            links += 1
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCKS:
            flush()
            links = 0
            if stack and stack[-1][0] == "p":
                cut(len(stack) - 1)
            # It ends the outermost of its kind above the innermost list or table.
            above = -1 if name in ("thead", "tbody", "tfoot") else highest(STOPS)
            ended = [p[bisect_right(p, above)] for n in ENDS_ITS_KIND.get(name, ()) if (p := places.get(n)) and p[-1] > above]
            if ended:
                cut(min(ended))
            if name not in VOID:
                places.setdefault(name, []).append(len(stack))
                stack.append((name, path_parts(name, m["more"])))
    rest = page[at:]
    opened = UNENDED.search(rest)
    rest = rest[: opened.start()] if opened else rest
    add(rest if not re.match(r"<[/!?A-Za-z]", rest) else "")  # a tag that never ends is markup
    flush()
    return out


@lru_cache(1 << 16)
def hashed(part: str, size: int) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) % size


@lru_cache(1 << 14)
def path_places(path: tuple[str, ...]) -> np.ndarray:
    """Places of a path's parts, of the last three with their place, and of the beginnings of names, so that a class and
    an id of one word, or its singular and plural, have something in common."""
    last = path[-3:]
    parts = [*path, *(f"{len(last) - place}{part}" for place, part in enumerate(last))]
    parts += ["~" + part.split("=", 1)[1][:5] for part in path if "=" in part]
    return np.unique([hashed(part, PATH) for part in parts]).astype(np.int64)


def vectors(blocks: list[Block], first: int = 0, size: int | None = None) -> np.ndarray:
    """One row per block, or per block of a run of them: hashed path, hashed words, measures."""
    run = blocks[first : first + size] if size else blocks
    table = np.zeros((len(run), PATH + WORDS + MEASURES), np.float32)
    total = sum(len(b.text) for b in blocks) or 1
    for i, block in enumerate(run, first):
        row = table[i - first]
        row[path_places(block.path)] = 1
        found = block.text.lower().split()
        counts = np.bincount([hashed(w, WORDS) for w in found], minlength=WORDS)
        row[PATH : PATH + WORDS] = counts / np.sqrt(max(1, (counts**2).sum()))
        n = len(block.text)
        row[PATH + WORDS :] = (
            1, min(np.log1p(n), 8) / 8, block.link_chars / n, min(len(found), 50) / 50,
            sum(map(block.text.count, ".,;!?")) / max(1, len(found)), i / len(blocks), n / total, block.text[-1] in ".!?",
        )
    return table


# ---- the network ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Labeller:
    """Two directions of (input, recurrent, bias) weights, and the output layer."""

    ways: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]
    out: np.ndarray

    def read(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each direction takes from the rows, and their measures."""
        return *(table @ w + b for w, _, b in self.ways), table[:, PATH + WORDS :]

    def chances(self, tables: list[np.ndarray]) -> list[np.ndarray]:
        """The chance of each block to be content, by the rows of each page."""
        return self.judged([self.read(t) for t in tables])

    def chances_of(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The same by blocks: rows are spelled out a run at a time, so a page may have any number of them."""
        return self.judged([
            tuple(map(np.concatenate, zip(*(self.read(vectors(blocks, i, ROWS)) for i in range(0, max(1, len(blocks)), ROWS)), strict=True)))
            for blocks in pages
        ])

    def judged(self, pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Pages lie longest first; a step handles those that reach it."""
        order = [i for i in sorted(range(len(pages)), key=lambda i: -len(pages[i][2])) if len(pages[i][2])]
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        if not order:
            return found
        lengths = np.array([len(pages[i][2]) for i in order])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        states = []
        for way, (_, u, _) in enumerate(self.ways):
            drive = np.concatenate([pages[i][way] for i in order])
            state = np.zeros((len(drive), HIDDEN), np.float32)
            h = np.zeros((len(order), HIDDEN), np.float32)
            c = np.zeros_like(h)
            for t in range(int(lengths[0])):
                n = int(np.searchsorted(-lengths, -t, "left"))
                at = begin[:n] + (t if way == 0 else lengths[:n] - 1 - t)
                h[:n], c[:n], _ = cell(drive[at] + h[:n] @ u, c[:n])
                state[at] = h[:n]
            states.append(state)
        chance = sigmoid(np.concatenate([*states, np.concatenate([pages[i][2] for i in order])], 1) @ self.out)
        for k, i in enumerate(order):
            found[i] = chance[begin[k] : begin[k] + lengths[k]]
        return found


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def cell(gates: np.ndarray, c: np.ndarray):
    """Input, forget and output gates and the candidate, side by side."""
    i, f, o = (sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
    g = np.tanh(gates[:, 3 * HIDDEN :])
    new = f * c + i * g
    return o * np.tanh(new), new, (i, f, o, g)


def train_labeller(tables: list[np.ndarray], labels: list[np.ndarray], seed: int = 11) -> Labeller:
    """Adam on the log loss, by backpropagation through time over batches of pages."""
    random = np.random.default_rng(seed)
    width = PATH + WORDS + MEASURES
    weights = []
    for _ in range(2):
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN : 2 * HIDDEN] = 1
        weights += [random.normal(0, 0.1, (width, 4 * HIDDEN)), random.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)), bias]
    weights.append(random.normal(0, 0.1, 2 * HIDDEN + MEASURES))
    weights = [w.astype(np.float32) for w in weights]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    order = sorted(range(len(tables)), key=lambda i: len(tables[i]))
    batches = [order[i : i + 24] for i in range(0, len(order), 24)]
    for epoch in range(EPOCHS):
        rate = 0.02 * (1 - 0.9 * epoch / EPOCHS)
        for k in random.permutation(len(batches)):
            part = batches[k]
            slopes = slopes_of(weights, [tables[i] for i in part], [labels[i] for i in part])
            step += 1
            for w, g, m, s in zip(weights, slopes, mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Labeller((tuple(weights[:3]), tuple(weights[3:6])), weights[6])


def slopes_of(weights, tables, labels):
    most, size = max(map(len, tables)), len(tables)
    kind = weights[0].dtype
    x = np.zeros((most, size, PATH + WORDS + MEASURES), kind)
    y, there = np.zeros((most, size), kind), np.zeros((most, size), kind)
    for k, (table, label) in enumerate(zip(tables, labels, strict=True)):
        x[: len(table), k], y[: len(table), k], there[: len(table), k] = table, label, 1
    kept, states = [], []
    for way in range(2):
        w, u, b = weights[3 * way : 3 * way + 3]
        drive = x @ w + b
        h = c = np.zeros((size, HIDDEN), kind)
        past, state = [None] * most, np.zeros((most, size, HIDDEN), kind)
        for t in range(most) if way == 0 else range(most - 1, -1, -1):
            before = (h, c)
            h, c, gates = cell(drive[t] + h @ u, c)
            h, c = h * there[t][:, None], c * there[t][:, None]  # nothing comes from behind a page's end
            past[t], state[t] = (*before, c, gates), h
        kept.append(past)
        states.append(state)
    seen = np.concatenate([*states, x[..., PATH + WORDS :]], 2)
    wrong = (sigmoid(seen @ weights[6]) - y) * there / there.sum()
    out = []
    for way in range(2):
        u = weights[3 * way + 1]
        from_output = wrong[..., None] * weights[6][way * HIDDEN : (way + 1) * HIDDEN]
        d_drive, d_u = np.zeros((most, size, 4 * HIDDEN), kind), np.zeros_like(u)
        dh, dc = np.zeros((size, HIDDEN), kind), np.zeros((size, HIDDEN), kind)
        for t in range(most - 1, -1, -1) if way == 0 else range(most):
            h0, c0, c1, (i, f, o, g) = kept[way][t]
            dh = (dh + from_output[t]) * there[t][:, None]
            tanh = np.tanh(c1)
            dc = (dc + dh * o * (1 - tanh**2)) * there[t][:, None]
            d = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g**2)], 1)
            d_drive[t], dc = d, dc * f
            d_u += h0.T @ d
            dh = d @ u.T
        out += [np.einsum("tkf,tkh->fh", x, d_drive, optimize=True), d_u, d_drive.sum((0, 1))]
    return [*out, np.einsum("tkf,tk->f", seen, wrong)]


# ---- training pages -------------------------------------------------------------------------------------

# Words of paths that say what a block is, in the sample and in the layouts made from it.
CONTENT_ROOTS = ("article", "main", "role=main", "class=content", "class=post", "class=entry", "id=content", "itemprop=articleBody".lower())
# A header inside a content root is the article's own: its heading and byline.
ASIDE_ROOTS = (
    "nav", "footer", "aside", "form", "class=ad", "class=ads", "class=advert", "class=sidebar", "class=comments",
    "class=comment", "id=comments", "class=notice", "class=cookie", "class=banner", "class=menu", "class=related", "class=share",
)


def marked(blocks: list[Block]) -> np.ndarray | None:
    """Labels from semantic tags: inside a content root, and inside no other kind of element below it. None without a root."""
    out = []
    for block in blocks:
        inside = [i for i, part in enumerate(block.path) if part in CONTENT_ROOTS]
        out.append(float(bool(inside) and not any(part in ASIDE_ROOTS for part in block.path[inside[0] :])))
    return np.array(out) if any(out) else None


SHELLS = (
    ("article",), ("main",), ("main", "article"), ("div", "class=content"), ("div", "id=content"), ("div", "class=post"),
    ("div", "class=main"), ("section", "class=article", "class=body"), ("div", "class=entry", "class=content"), ("div", "class=story"),
    (), (), ("div",), ("div", "div"), ("section",), ("div", "class=?"), ("div", "class=?", "div", "class=?"), ("div", "id=?"),
    ("div", "class=?", "class=?", "div", "id=?", "div"), ("table", "tr", "td"),
)
# What stands above the paragraphs of an article.
OPENINGS = (
    (("header", "h1"), 12), (("header", "p"), 12), (("header", "div", "class=byline"), 8), (("h1",), 12), (("div", "h1"), 12),
    (("header", "div", "h2"), 12), (("p", "class=byline"), 8), (("header", "address"), 6),
)
# Other elements that articles put their text into, with the most words that such a block has.
INNER = (
    (("ul", "li"), 25), (("ol", "li"), 25), (("blockquote",), 60), (("blockquote", "p"), 60), (("table", "tr", "td"), 8),
    (("table", "tbody", "tr", "td"), 8), (("table", "tr", "th"), 4), (("pre",), 30), (("h2",), 8), (("h3",), 8), (("dl", "dt"), 4),
    (("dl", "dd"), 25), (("figure", "figcaption"), 15), (("section", "p"), 80), (("section", "h2"), 8), (("div",), 80), (("div", "p"), 80),
)
# Where readers' comments stand, inside an article or after it.
COMMENTS = (
    ("section", "class=comments", "div", "class=comment", "p"), ("div", "id=comments", "h2"), ("div", "id=comments", "ol", "li", "p"),
    ("div", "class=comment", "p"), ("ul", "class=comments", "li"), ("section", "id=comments", "article", "class=comment", "p"),
    ("div", "id=disqus", "class=thread", "div", "class=reply"), ("div", "id=respond", "div", "p"), ("div", "class=replies", "div", "class=reply", "p"),
    ("section", "class=responses", "div", "p"), ("div", "class=discussion", "div", "class=message", "p"), ("section", "class=discussion", "p"),
    ("ol", "class=commentlist", "li", "div", "p"), ("div", "id=?", "div", "class=comment", "class=body"), ("section", "class=feedback", "p"),
    ("div", "id=disqus", "div", "class=reply", "p"), ("section", "class=comments", "h3"), ("div", "class=replies", "h3"),
    ("section", "class=comments", "p"), ("section", "class=comments", "ul", "li"), ("div", "class=reviews", "div", "class=review", "p"),
)
NOISE = {
    "before": (
        ("nav", "ul", "li"), ("header", "div", "class=menu", "ul", "li"), ("header", "h1"), ("header", "p"),
        ("div", "class=cookie", "class=notice", "p"), ("div", "class=notice"), ("div", "class=banner", "p"), ("div", "class=breadcrumb"),
        ("div", "id=header", "div"), ("aside", "class=sidebar", "ul", "li"), ("div", "class=sidebar", "p"), ("form", "class=search", "p"),
        ("div", "class=ad"), ("div", "class=advert"), ("div", "class=alert", "role=alert"), ("div", "role=banner"), ("aside", "p"),
        ("nav", "a"), ("div", "class=nav", "ul", "li"), ("div", "class=?", "ul", "li"), ("ul", "li"), ("header", "div", "class=logo"),
        ("div", "id=cookie", "class=consent", "p"), ("div", "class=topbar", "div"), ("ul", "class=menu", "li"), ("menu", "li"),
    ),
    "inside": (
        ("div", "class=ad"), ("aside", "p"), ("aside", "class=related", "ul", "li"), ("div", "class=share", "ul", "li"),
        ("form", "class=newsletter", "p"), ("div", "class=promo", "p"), ("figure", "class=ad", "figcaption"), ("nav", "class=toc", "ul", "li"),
        ("div", "class=sponsored"), ("div", "class=advertisement", "p"), ("form", "fieldset", "legend"), ("form", "div"), ("form", "p"),
    ),
    "after": (
        ("footer",), ("footer", "p"), ("footer", "ul", "li"), ("aside", "class=related", "ul", "li"),
        ("div", "class=sidebar", "h3"), ("form", "p"), ("form", "label"),
        ("div", "class=footer"), ("div", "id=footer", "p"), ("aside", "class=sidebar", "p"),
        ("div", "class=newsletter", "form", "p"), ("div", "class=ad"), ("div", "role=contentinfo"), ("aside", "h3"), ("nav", "a"),
        ("div", "class=?", "ul", "li"), ("div", "class=copyright"), ("footer", "div", "class=?"), ("div", "class=legal", "p"),
    ),
    "comments": COMMENTS,
}


NOISE_TAGS = {"nav", "header", "footer", "aside", "form", "menu"}
NAMES_OF_NOISE = {part.split("=")[1] for paths in NOISE.values() for path in paths for part in path if "=" in part} - {"?"}


def relaid(blocks: list[Block], labels: np.ndarray, others: list[str], random: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page's content in another shell, with lists, tables and quotes of other pages' words as more content, and with
    blocks of other pages' text set around and into it as noise."""
    def named(path: tuple[str, ...]) -> tuple[str, ...]:
        """A made-up name in place of each ``?``."""
        return tuple(x[:-1] + "".join(map(chr, random.integers(97, 123, int(random.integers(1, 8))))) if x.endswith("=?") else x for x in path)

    def words_of_others(most: int) -> str:
        words = others[int(random.integers(len(others)))].split()
        first = int(random.integers(len(words)))
        return " ".join(words[first : first + int(random.integers(1, most))])

    def dressed(path: tuple[str, ...]) -> tuple[str, ...]:
        """Now and then the path with a name that says nothing on its last element."""
        return (*path, ("class=?", "id=?")[int(random.integers(2))]) if path and random.random() < 0.3 else path

    shell = named(dressed(SHELLS[int(random.integers(len(SHELLS)))]))
    out: list[tuple[Block, float]] = []

    def content(inner: tuple[str, ...], text: str):
        out.append((Block(("html", "body", *shell, *inner), text, 0), 1.0))

    def noise(kind: str, most: int, inside: bool = False):
        for _ in range(int(random.integers(0, most))):
            plain = NOISE[kind][int(random.integers(len(NOISE[kind])))]
            path = named((*dressed(plain[:1]), *plain[1:]))
            for _ in range(int(random.integers(1, 5))):
                text = words_of_others(40 if path[-1] == "p" or kind == "comments" else 9)
                # A bare list is a menu by its links alone.
                bare = path[-1] == "li" and not any("=" in x and x.split("=")[1] in NAMES_OF_NOISE for x in path) and not NOISE_TAGS & {*path}
                linked = path[-1] in ("li", "a") and kind != "comments" and (bare or random.random() < 0.85)
                out.append((Block(("html", "body", *shell * inside, *path), text, len(text) * linked), 0.0))

    # Short articles too: a run of the page's content.
    chosen = [block for block, label in zip(blocks, labels, strict=True) if label]
    if chosen and random.random() < 0.35:
        first = int(random.integers(len(chosen)))
        chosen = chosen[first : first + int(random.integers(1, 4))]

    noise("before", 5)
    if shell and random.random() < 0.5:
        for _ in range(int(random.integers(1, 3))):
            inner, most = OPENINGS[int(random.integers(len(OPENINGS)))]
            content(inner, words_of_others(most))
    for block in chosen:
        tag = block.path[-1] if block.path[-1] in ("p", "h1", "h2", "h3", "li", "blockquote", "td") else "p"
        content((*(("section",) if random.random() < 0.15 else ("ul",) if tag == "li" else ()), tag), block.text)
        if random.random() < 0.3:
            # A third of them are lists.
            inner, most = INNER[int(random.integers(2 if random.random() < 0.3 else len(INNER)))]
            for _ in range(int(random.integers(1, 6))):
                content(inner, words_of_others(most))
        if random.random() < 0.08:
            noise("inside", 3, True)
    if random.random() < 0.3:
        noise("comments", 3, True)
    noise("after", 5)
    if random.random() < 0.3:
        noise("comments", 3)
        noise("after", 3)
    return [b for b, _ in out], np.array([x for _, x in out])


def laid_out(blocks: list[Block]) -> list[Block]:
    """The longest unlinked texts of a page without marks, as the paragraphs of an article."""
    places = [i for i, b in enumerate(blocks) if len(b.text.split()) >= PLAIN_WORDS and 2 * b.link_chars <= len(b.text)]
    places = sorted(sorted(places, key=lambda i: (-len(blocks[i].text), i))[:PLAIN_BLOCKS])
    return [Block(("html", "body", "article", "p"), blocks[i].text, 0) for i in places]


def make_trainer(plain: bool):
    """The blocks of each page that are trained on and their labels, as JSON; null for a page that cannot be used.

    They are at most SAMPLE_BLOCKS in a row, which begin before the content."""

    def parts(texts):
        out = []
        for text in texts:
            blocks = laid_out(blocks_of(text)) if plain else blocks_of(text)
            labels = marked(blocks)
            if labels is None:
                out.append(None)
                continue
            first = max(0, int(labels.argmax()) - SAMPLE_BLOCKS // 4)
            chosen = range(first, min(len(blocks), first + SAMPLE_BLOCKS))
            out.append(json.dumps([(blocks[i].path, blocks[i].text[:SAMPLE_CHARS], min(blocks[i].link_chars, SAMPLE_CHARS), labels[i]) for i in chosen]))
        return [out]

    return parts


def training_pages(table: DataFrame, total: int, n: int, plain: bool) -> list[tuple[list[Block], np.ndarray]]:
    """About ``n`` usable pages, by a hash: the share of pages that is looked at grows until enough are found or all were seen."""
    looked = n
    while True:
        part = table.where(in_sample(looked, total, "place")).where(F.length("page") > 0)
        found = kept(map_texts(part, ["place"], "page", "part string", make_trainer, plain).where("part IS NOT NULL"))
        usable = found.count()
        if 3 * usable >= n or looked >= total:
            break
        looked *= 10
    # The hash is even over the share that was looked at, so a part of that share is a part of the usable pages.
    share = min(looked, total) * min(1.0, n / usable) if usable else 0
    rows = found.where(in_sample(share, total, "place")).select("part").limit(2 * n).collect()
    pages = [json.loads(r.part) for r in sorted(rows)]
    return [([Block(tuple(path), text, links) for path, text, links, _ in page], np.array([x[-1] for x in page])) for page in pages]


def fit_labeller(pages: DataFrame, *, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller | None:
    """Train on about ``sample_pages`` pages, by a hash of the page, whose tags mark their content, each as it is and all in other layouts,
    LAID_PAGES of these.

    However rare they are, marked pages are looked for in the whole table. Where there is none, the texts of pages are
    laid out and trained on; None when there is no text either.
    """
    table = pages.select(F.col(f"`{html_col}`").alias("page"), F.xxhash64(*[f"`{c}`" for c in pages.columns]).alias("place"))
    total = pages.count()
    plain = not (known := training_pages(table, total, sample_pages, False))
    if plain and not (known := training_pages(table, total, sample_pages, True)):
        return None
    random = np.random.default_rng(13)
    others = [b.text for blocks, _ in known for b in blocks]
    made = known * (not plain) + [relaid(b, m, others, random) for b, m in known * -(-LAID_PAGES // len(known))]
    made = [(b[:SAMPLE_BLOCKS], m[:SAMPLE_BLOCKS]) for b, m in made]  # training only: steps of a batch
    return train_labeller([vectors(b) for b, _ in made], [m for _, m in made])


def make_extractor(labeller: Labeller | None):
    def extract(texts):
        out = []
        for first in range(0, len(texts), 200):
            pages = [blocks_of(t) for t in texts[first : first + 200]]
            chances = labeller.chances_of(pages) if labeller else [np.zeros(len(b)) for b in pages]
            out += ["\n\n".join(b.text for b, p in zip(blocks, chance, strict=True) if p >= 0.5) for blocks, chance in zip(pages, chances, strict=True)]
        return out, [len(t) for t in out]

    return extract


def extract_main_text(pages: DataFrame, labeller: Labeller | None, *, keep: tuple[str, ...] = ("page_id", "url"),
                      html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the columns ``keep``, text (blocks of content joined by an empty line) and n_chars.

    A null, empty or blockless page has an empty text. Repeated rows get a row each; other columns are ignored.
    """
    return map_texts(pages, list(keep), html_col, "text string, n_chars long", make_extractor, labeller)
