"""Main text of web pages by a recurrent labeller of their blocks.

A page is cut into leaf blocks, each with the path of elements it stands in. A
block is read as the vectors of its path (tags, words of classes and ids), of
its words (hashed), and some sizes; a bidirectional LSTM runs over all blocks
of a page, so that the label of each, main text or not, hangs on the whole page.

There are no labelled blocks. The network learns from pages whose own markup
says where the article is, and from variations of them: with that markup taken
out, and with sidebars, notices, forms, comments and the like put in. Forward
and backward passes are plain numpy.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PAGES = 300  # to learn from
PATHS, WORDS = 1_024, 2_048  # hash buckets of path parts and of words
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 8, 20
EPOCHS = 16
BATCH_PAGES = 48
READ_PAGES = 256  # pages that are read side by side
LONGEST_SIDE_BY_SIDE = 50_000  # padded blocks

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title"  # hold no elements; unclosed, they go on to the end of the page
UNSEEN = frozenset("template noscript svg iframe object select canvas audio video annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr br ruby rt rp output "
    # of formulas
    "math semantics maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none".split()
)
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
CONTAINERS = frozenset("ul ol dl table body html div section article main aside nav".split())

# What the training labels take from the markup.
ARTICLE = frozenset(["<article", "<main"])
HEADINGS = frozenset(["<h1", "<h2", "<h3"])
ASIDE = frozenset(
    "<nav <footer <aside <header <form <button <menu <dialog ad ads advert advertisement sidebar menu cookie "
    "notice banner comment comments related share social promo newsletter breadcrumb footer header nav".split()
)

_ATTRIBUTES = r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+"
_NOT_ELEMENTS = rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
_MARKUP = re.compile(
    _NOT_ELEMENTS + r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
_UNSEEN = re.compile(
    _NOT_ELEMENTS + rf"|<(/?)({'|'.join(sorted(UNSEEN))})(?=[\s/>])({_ATTRIBUTES})>", re.S | re.I
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text, the parts of its path, and how much of it is links."""

    text: str
    path: tuple[str, ...]
    linked: int = 0
    main: int = -1  # a label, where known


@lru_cache(50_000)
def _parts(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element adds to the path: its tag, and the words of its class, id and role."""
    named = (" ".join(found) for found in _NAMED.findall(attributes)) if "=" in attributes else ()
    return ("<" + tag, *(part for some in named for part in _PART.findall(some.lower())))


def _hidden(page: str, at: int) -> dict[int, int]:
    """Where each hidden element of a page from ``at`` on starts, and where it ends, if it is closed."""
    ends: dict[int, int] = {}
    starts: dict[str, list[int]] = {}
    for match in _UNSEEN.finditer(page, at):
        if match[3] is None or match[4].endswith("/"):
            continue
        same = starts.setdefault(match[3].lower(), [])
        if not match[2]:
            same.append(match.start())
        elif same:
            ends[same.pop()] = match.end()
    return ends


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, references decoded, white space as single spaces.

    Hidden elements count with all that is in them; one that is closed in its
    own tag, or nowhere, is that tag alone.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = [("", ())]
    texts: list[str] = []
    linked = 0
    links = 0  # open links

    def flush() -> None:
        nonlocal linked
        if texts:
            raw = "".join(texts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                block = next(path for tag, path in reversed(stack) if tag not in INLINE)
                found.append(Block(text, block, linked))
            texts.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal links
        while True:
            top = stack.pop()[0]
            links -= top == "a"
            if top == tag:
                return

    def is_open(tag: str, until: frozenset[str]) -> bool:
        for top, _ in reversed(stack):
            if top == tag:
                return True
            if top in until:
                return False
        return False

    at = 0
    hidden: dict[int, int] | None = None
    while match := _MARKUP.search(page, at):
        if match.start() > at:
            texts.append(page[at : match.start()])
            linked += (match.start() - at) * (links > 0)
        at = match.end()
        end, tag, attributes = match[2], match[3], match[4]
        if tag is None:
            end, tag, attributes = match[5], match[6], match[7]
        if tag is None:
            if match[1]:
                texts.append(" ")
            continue
        tag = tag.lower()
        if tag in UNSEEN:
            texts.append(" ")
            if not end:
                hidden = _hidden(page, match.start()) if hidden is None else hidden
                at = hidden.get(match.start(), at)
            continue
        if tag not in INLINE:
            flush()
        elif tag == "br":
            texts.append(" ")
        if end:
            if is_open(tag, frozenset()):
                close(tag)
        elif tag not in VOID:
            if tag in CLOSED_BY_SAME and is_open(tag, CONTAINERS):
                close(tag)
            elif tag not in INLINE and is_open("p", CONTAINERS):
                close("p")
            if not attributes.endswith("/") or tag not in INLINE:
                stack.append((tag, stack[-1][1] + _parts(tag, attributes)))
                links += tag == "a"
    if at < len(page):
        texts.append(page[at:])
    flush()
    return found


@lru_cache(100_000)
def _path_ids(path: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(_part_id(part) for part in path) or (0,)


@lru_cache(10_000)
def _part_id(part: str) -> int:
    """Tags and names that pages use for parts of a page; all other names are one."""
    return 1 + zlib.crc32(part.encode()) % (PATHS - 1) if part[0] == "<" or part in known_names() else 0


@lru_cache(1)
def known_names() -> frozenset[str]:
    shapes = " ".join((*EXTRAS, *BODIES, *RUNS, *HEADS)).split()
    return frozenset(part for part in (*shapes, *ASIDE, *ARTICLE) if part[0] not in "<*")


class _WordIds(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS
        return value


_WORD_IDS = _WordIds()


@dataclass
class Page:
    """The blocks of a page as numbers: ids of path parts and words with their starts, leaves, sizes."""

    paths: np.ndarray
    path_starts: np.ndarray
    leaves: np.ndarray
    words: np.ndarray
    word_starts: np.ndarray
    sizes: np.ndarray


def _at_home(some: list[Block], letters: list[float]) -> np.ndarray:
    """Of each block, whether it is (2) where the one path down the page leads that holds half of its text outside links."""
    half = sum(letters) / 2
    inside, depth = range(len(some)), 0
    while half:
        held: dict[str, float] = {}
        for k in inside:
            path = some[k].path
            if len(path) > depth + 1:
                held[path[depth]] = held.get(path[depth], 0.0) + letters[k]
        part = max(held, key=held.__getitem__, default=None)
        if part is None or held[part] < half:
            break
        inside = [k for k in inside if len(some[k].path) > depth + 1 and some[k].path[depth] == part]
        depth += 1
    home = np.zeros(len(some))
    home[list(inside)] = 2
    return home


def numbers(some: list[Block]) -> Page:
    paths = [_path_ids(block.path) for block in some]
    words = [block.text.split() for block in some]
    counts = np.array([len(own) for own in words])
    length = np.array([len(block.text) for block in some], dtype=float)
    linked = np.array([block.linked for block in some], dtype=float)
    last = np.array([block.text[-1] in ".!?" for block in some], dtype=float)
    place = np.arange(len(some)) / max(1, len(some) - 1)
    home = _at_home(some, (length - linked).clip(0).tolist())
    sizes = np.stack([np.log1p(length) / 5, np.minimum(1, linked / length), counts / (counts + 10), last, place, home], 1)
    return Page(
        np.fromiter((i for own in paths for i in own), np.int64),
        np.cumsum([0, *map(len, paths[:-1])]),
        np.array([own[-1] for own in paths]),
        np.fromiter((_WORD_IDS[word] for own in words for word in own), np.int64),
        np.cumsum([0, *counts[:-1]]),
        sizes,
    )


SIZES = 6
WIDTH = 2 * PATH_SIZE + WORD_SIZE + SIZES
Weights = dict[str, np.ndarray]


def _start() -> Weights:
    chance = np.random.default_rng(17)
    out = {
        "paths": chance.normal(0, 0.3, (PATHS, PATH_SIZE)),
        "leaves": chance.normal(0, 0.3, (PATHS, PATH_SIZE)),
        "words": chance.normal(0, 0.1, (WORDS, WORD_SIZE)),
        "out": chance.normal(0, 0.2, 2 * HIDDEN),
        "bias": np.zeros(1),
    }
    for way in ("f", "b"):
        out["x" + way] = chance.normal(0, WIDTH**-0.5, (WIDTH, 4 * HIDDEN))
        out["h" + way] = chance.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        out["c" + way] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    return out


def _means(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(np.append(starts, len(rows)))[:, None]
    return np.add.reduceat(rows, starts, axis=0) / counts, counts


def _vectors(weights: Weights, page: Page) -> np.ndarray:
    """One row for each block."""
    return np.hstack([
        _means(weights["paths"][page.paths], page.path_starts)[0],
        weights["leaves"][page.leaves],
        _means(weights["words"][page.words], page.word_starts)[0],
        page.sizes,
    ])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, wx, wh, bias, keep: bool) -> tuple[np.ndarray, list]:
    """An LSTM over x (steps, pages, width); where the mask is 0, the state stays as it is."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    pulled = x @ wx + bias
    out, tape = np.zeros((steps, pages, HIDDEN)), []
    for t in range(steps):
        gates = pulled[t] + h @ wh
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        grown = f * c + i * g
        flat = np.tanh(grown)
        if keep:
            tape.append((h, c, i, f, o, g, flat, m))
        c = m * grown + (1 - m) * c
        h = m * o * flat + (1 - m) * h
        out[t] = h
    return out, tape


def _back(x: np.ndarray, tape: list, wx, wh, slope: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of an LSTM for the slopes at its outputs: of x, and of its three weights."""
    dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
    gates = np.zeros((*x.shape[:2], 4 * HIDDEN))
    dwh = np.zeros_like(wh)
    for t in range(len(tape) - 1, -1, -1):
        h, c, i, f, o, g, flat, m = tape[t]
        dh = dh + slope[t]
        do = dh * m * flat
        grown = dc * m + dh * m * o * (1 - flat**2)
        gates[t] = np.hstack([
            grown * g * i * (1 - i), grown * c * f * (1 - f), do * o * (1 - o), grown * i * (1 - g**2)
        ])
        dwh += h.T @ gates[t]
        dh = dh * (1 - m) + gates[t] @ wh.T
        dc = dc * (1 - m) + grown * f
    flat_gates = gates.reshape(-1, gates.shape[-1])
    return gates @ wx.T, x.reshape(-1, x.shape[-1]).T @ flat_gates, dwh, flat_gates.sum(0)


def _together(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages side by side, the mask of their blocks, and the same read backwards (as indices)."""
    lengths = np.array([len(rows) for rows in vectors])
    steps = np.arange(lengths.max())[:, None]
    x = np.zeros((lengths.max(), len(vectors), WIDTH))
    for k, rows in enumerate(vectors):
        x[: len(rows), k] = rows
    mask = (steps < lengths).astype(float)
    return x, mask, np.where(steps < lengths, lengths - 1 - steps, steps)


def _forward(weights: Weights, vectors: list[np.ndarray], keep: bool = False):
    x, mask, turned = _together(vectors)
    pages = np.arange(x.shape[1])
    ahead, tape_f = _run(x, mask, weights["xf"], weights["hf"], weights["cf"], keep)
    x_back = x[turned, pages]
    behind, tape_b = _run(x_back, mask, weights["xb"], weights["hb"], weights["cb"], keep)
    states = np.concatenate([ahead, behind[turned, pages]], axis=2)
    return states @ weights["out"] + weights["bias"], (x, x_back, mask, turned, states, tape_f, tape_b)


def probabilities(weights: Weights, pages: list[Page]) -> list[np.ndarray]:
    """For each block of each page, how likely it is main text."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i, page in enumerate(pages) if len(page.leaves)), key=lambda i: len(pages[i].leaves))
    while order:
        longest = len(pages[order[-1]].leaves)
        take = max(1, min(READ_PAGES, LONGEST_SIDE_BY_SIDE // longest))
        some, order = order[-take:], order[:-take]
        found = _sigmoid(_forward(weights, [_vectors(weights, pages[i]) for i in some])[0])
        for k, i in enumerate(some):
            out[i] = found[: len(pages[i].leaves), k]
    return out


def _gradients(weights: Weights, pages: list[Page], labels: list[np.ndarray]) -> Weights:
    vectors = [_vectors(weights, page) for page in pages]
    scores, (x, x_back, mask, turned, states, tape_f, tape_b) = _forward(weights, vectors, True)
    target = np.zeros_like(mask)
    for k, own in enumerate(labels):
        target[: len(own), k] = own
    slope = mask * (_sigmoid(scores) - target) / mask.sum()
    out = {name: np.zeros_like(value) for name, value in weights.items()}
    out["out"] = np.einsum("tp,tph->h", slope, states)
    out["bias"] = np.array([slope.sum()])
    pull = slope[:, :, None] * weights["out"]
    columns = np.arange(x.shape[1])
    dx, out["xf"], out["hf"], out["cf"] = _back(x, tape_f, weights["xf"], weights["hf"], pull[:, :, :HIDDEN])
    back, out["xb"], out["hb"], out["cb"] = _back(
        x_back, tape_b, weights["xb"], weights["hb"], pull[:, :, HIDDEN:][turned, columns]
    )
    dx = dx + back[turned, columns]
    for k, page in enumerate(pages):
        own = dx[: len(page.leaves), k]
        for name, ids, starts, at in (
            ("paths", page.paths, page.path_starts, 0), ("words", page.words, page.word_starts, 2 * PATH_SIZE)
        ):
            size = weights[name].shape[1]
            counts = np.diff(np.append(starts, len(ids)))
            np.add.at(out[name], ids, np.repeat(own[:, at : at + size] / counts[:, None], counts, axis=0))
        np.add.at(out["leaves"], page.leaves, own[:, PATH_SIZE : 2 * PATH_SIZE])
    return out


def fit(pages: list[list[Block]]) -> Weights:
    """The network, from pages of labelled blocks."""
    chance = np.random.default_rng(23)
    weights = _start()
    seen = [(numbers(some), np.array([block.main for block in some], dtype=float)) for some in pages if some]
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        for chosen in np.array_split(chance.permutation(len(seen)), max(1, len(seen) // BATCH_PAGES)):
            step += 1
            rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
            slopes = _gradients(weights, [seen[i][0] for i in chosen], [seen[i][1] for i in chosen])
            for name, slope in slopes.items():
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                moved = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                weights[name] = weights[name] - rate * moved
    return weights


def labelled(some: list[Block]) -> list[Block]:
    """The blocks with labels from the page's own markup, or none, if it marks no article.

    Headings in a header of the article's own are its headings.
    """
    found = []
    for block in some:
        start = next((k for k, part in enumerate(block.path) if part in ARTICLE), None)
        main = start is not None and not set(block.path[:start]) & ASIDE
        if main:
            inside = set(block.path[start:])
            if block.path[-1] in HEADINGS:
                inside -= {"<header", "header"}
            main = not inside & ASIDE
        found.append(replace(block, main=int(main)))
    return found if any(block.main for block in found) else []


#: Paths of the things that pages put beside the article, below the body or inside the article.
EXTRAS = (
    "<aside <p", "<aside <ul <li", "<div sidebar <p", "<div sidebar <h3", "<section comments <p", "<div comments <div comment <p",
    "<div comment", "<ol comments <li comment <p", "<div cookie notice <p", "<div notice", "<div banner", "<header <p",
    "<header <h1", "<header <div", "<form <label", "<form <p", "<form <div", "<button", "<div ad", "<div ads <p", "<div advert <p",
    "<div related <ul <li", "<div share <a", "<div newsletter <p", "<div promo <p", "<ul menu <li", "<div menu <a",
    "<nav <a", "<nav <ul <li", "<footer <p", "<footer", "<div footer <p", "<div breadcrumb <a", "<dialog <p", "<div popup <p",
    "<div disclaimer <p", "<section related <h2", "<section comments <h2", "<table menu <tr <td",
    "<div respond <p", "<div respond <div <p", "<ol commentlist <li <p", "<div replies <p", "<section discussion <p",
    "<div feedback <p", "<ul thread <li <p", "<div responses <blockquote", "<div reader comments <p",
    "<div gdpr overlay <p", "<div gdpr overlay", "<div consent modal <p", "<div overlay <div <p", "<div modal <p",
    "<div popup overlay <p", "<div subscribe <p", "<div signup <p", "<div toolbar <a", "<table navigation <tr <td <a",
)
#: Beside an article that is marked as one, also what has a name that says nothing is no part of it.
UNNAMED = ("<div * <p", "<section * <p", "<div * <div <p", "<div * <div * <p", "<ol * <li <p", "<div *", "<div * <h3")
BODIES = (
    "<article", "<main", "<main <article", "<div content", "<div article body", "<div post content", "<section content",
    "<div main", "<div entry content", "<div story", "<div", "<div page", "<div page <div", "<table <tr <td",
    "<table <tbody <tr <td", "<table layout <tbody <tr <td <div", "<div *", "<div * <div *", "<section *", "<div * <div",
)
#: Ways in which some of an article's blocks, one after another, can stand in it.
RUNS = (
    "<ul <li", "<ol <li", "<ul * <li", "<ul <li <p", "<table <tr <td", "<table <tbody <tr <td", "<table * <tbody <tr <td",
    "<table <tbody <tr <th", "<dl <dd", "<blockquote <p", "<figure <figcaption", "<section <p", "<div <p", "<div * <p", "<details <p",
)
HEADS = ("<h1", "<header <h1", "<header * <h1", "<div * <h1", "<h2")
LEAVES = ("<p", "<h1", "<h2", "<h3", "<li", "<blockquote", "<pre", "<td", "<div")


def varied(pages: list[list[Block]], seed: int = 29) -> list[list[Block]]:
    """Pages like the given ones, with other markup around the article, and with extras put in."""
    chance = np.random.default_rng(seed)
    texts = [block.text for some in pages for block in some] or ["some words of a text."]
    short = [text for text in texts if len(text) < 120] or texts
    pick = lambda some: some[chance.integers(len(some))]

    def path_of(shape: str) -> tuple[str, ...]:
        """The parts of a path; a star is a name that says nothing."""
        return tuple(
            "".join(chance.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) if part == "*" else part for part in shape.split()
        )

    out = []
    for some in pages:
        body = path_of(pick(BODIES))
        wraps = ("<html", "<body", *(("<div",) * int(chance.integers(0, 3))))
        plain = body in (("<div",), ("<div", "main"))
        new = []
        run, left, titled = (), 0, False
        for block in some:
            if block.main == 1:
                leaf = (block.path[-1] if block.path and block.path[-1] in LEAVES else "<p",)
                if leaf == ("<p",) and chance.random() < 0.1:
                    leaf = (pick(LEAVES),)
                if leaf[0] in HEADINGS and not titled:
                    leaf = path_of(pick(HEADS))
                elif left:
                    leaf, left = run, left - 1
                elif chance.random() < 0.15:
                    run, left = path_of(pick(RUNS)), int(chance.integers(0, 6))
                    leaf = run
                titled = True
                new.append(replace(block, path=(*wraps, *body, *leaf)))
            elif chance.random() < (1.0 if plain else 0.6):
                new.append(replace(block, path=(*wraps[: 2], *block.path[2:])))
        for _ in range(int(chance.integers(1, 6))):
            marked = body[0] in ARTICLE and chance.random() < 0.6
            extra = path_of(pick(UNNAMED if marked else EXTRAS))
            inside = not marked and chance.random() < 0.25
            path = (*wraps, *(body if inside else ()), *extra)
            count = int(chance.integers(1, 5))
            text = [str(pick(texts if chance.random() < 0.5 else short)) for _ in range(count)]
            links = "<a" in extra or "<li" in extra or "<nav" in extra
            put = [Block(t, path, len(t) * int(links), 0) for t in text]
            mains = [k for k, block in enumerate(new) if block.main == 1]
            if inside and len(mains) > 1:
                at = mains[int(chance.integers(1, len(mains)))]
            else:
                at = 0 if chance.random() < 0.5 or not mains else mains[-1] + 1
                at = min(at, mains[0]) if mains and at == 0 else at
            new[at:at] = put
        out.append(new)
    return out


def fit_on(pages: DataFrame) -> Weights:
    """A network from ``pages`` (page_id, html): from at most ``MOST_PAGES``, in the order of a hash."""
    order = F.xxhash64(F.lit("sample"), "page_id")
    ids = pages.select("page_id").filter("page_id IS NOT NULL").orderBy(order, "page_id").limit(MOST_PAGES).distinct()
    # Bounded, and so small enough for every executor.
    rows = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).join(F.broadcast(ids), "page_id")
    texts = [html_text for _, html_text in sorted((row.page_id, row.html) for row in rows.collect())]
    known = [some for some in (labelled(blocks(text)) for text in texts) if some]
    made = known or [[Block(f"Some words of text number {k}.", ("<html", "<body", "<p"), 0, 1) for k in range(9)] for _ in range(40)]
    return fit(known + varied(made) + varied(made, 31) + varied(made, 37))


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    ``text``: the blocks taken for main text, in page order, one on a line.
    Null, empty and blank pages have an empty text; ids and urls may be null or
    repeated; an empty table gives an empty table. Other columns are not looked at.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), READ_PAGES):
                part = batch.iloc[start : start + READ_PAGES]
                cut = [blocks(page) for page in part["html"]]
                marks = iter(probabilities(weights, [numbers(some) for some in cut if some]))
                texts = []
                for some in cut:
                    main = next(marks) >= 0.5 if some else ()
                    texts.append("\n".join(block.text for block, own in zip(some, main) if own))
                yield pd.DataFrame({
                    "page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": list(map(len, texts))
                }).astype({"page_id": "Int64"})

    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return chosen.mapInPandas(run, "page_id long, url string, text string, n_chars long")
