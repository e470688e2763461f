"""Main text of web pages: a recurrent network labels every block of a page."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart.llm.shingles import word_hashes

# Elements by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
# Not shown. Without an end tag, the first hold the rest of the page, as in browsers;
# of the others the start tag alone is left out. ``head`` is no more than its tags:
# all it may hold is void or in these lists, and anything else ends it.
RAW_TEXT = "script|style|textarea|title"
UNSEEN = "iframe|noscript|object|select|svg|template"

# Words of tags, classes and ids that the training labels are made from.
BOILERPLATE = (
    "nav menu navbar header footer aside sidebar form cookie consent notice alert banner "
    "ad ads advert advertisement sponsored promo comment comments respond discussion share "
    "social related breadcrumb pagination newsletter subscribe login copyright widget popup"
).split()
CONTENT = "article main content post entry story body text".split()

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TEXT})(?![^\s/>])[^>]*>(?:.*?</\1(?![^\s/>])[^>]*>|.*)"
    rf"|<({UNSEEN})(?![^\s/>])({_ATTRIBUTES}|[^>]*)>|<[!?][^>]*>"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>",
    re.DOTALL | re.IGNORECASE,
)
_ENDS = {
    name: re.compile(
        rf"<!--.*?(?:-->|\Z)|<(/?){name}(?![^\s/>])({_ATTRIBUTES}|[^>]*)>",
        re.DOTALL | re.IGNORECASE,
    )
    for name in UNSEEN.split("|")
}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PARTS = re.compile(r"[a-z]+")

PATH_SIZE, WORD_SIZE, NUMBERS = 96, 32, 6
INPUTS = PATH_SIZE + WORD_SIZE + NUMBERS
HIDDEN = 12
# Pages that a model is fitted on, and their blocks that one training step sees.
TRAINING_PAGES, STEPS, BATCH, MOST_STEPS = 200, 150, 24, 48


@dataclass
class Block:
    """Text between two block-level tags, and the elements around it."""

    path: tuple[str, ...]
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside of links

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _name(tag: str, attributes: str) -> str:
    """An element as its tag and the words of its class, id and role."""
    if "=" not in attributes:
        return tag
    words = [w for m in _NAMED.finditer(attributes) for w in _PARTS.findall(m[m.lastindex].lower())]
    return " ".join([tag, *words])


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of this name start, and where those with an end tag end.

    An end tag belongs to the last element that is open; ``<svg/>`` is empty.
    """
    ends: dict[int, int] = {}
    opened: list[int] = []
    for tag in _ENDS[name].finditer(page):
        if tag[1] is None:
            continue
        if tag[1]:
            if opened:
                ends[opened.pop()] = tag.end()
        elif name != "svg" or not tag[2].endswith("/"):
            opened.append(tag.start())
    return ends


def page_blocks(page: str) -> list[Block]:
    """All blocks with text, in page order; what browsers do not show is left out.

    Tags need not be balanced: a closing tag ends all elements in its element, one
    that nothing opens is passed over, a paragraph ends where a block begins, and
    an unseen element without an end tag hides nothing but its start tag.
    """
    ends: dict[str, dict[int, int]] = {}
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []
    links = 0
    current: Block | None = None
    at = 0

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            current = Block(tuple(name for tag, name in stack if tag not in INLINE))
            blocks.append(current)
        shown = html.unescape(raw) if "&" in raw else raw
        current.parts.append(shown)
        if links:
            current.linked += len(shown)

    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        if token[5] is None:
            # Comments and unseen elements: inline ones do not end a block.
            current = current if token[1] is None and token[2] is None else None
            if token[2] is not None:
                unseen = token[2].lower()
                if unseen not in ends:
                    ends[unseen] = _ends(page, unseen)
                at = ends[unseen].get(token.start(), at)
            continue
        tag, closing = token[5].lower(), bool(token[4])
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            current = None
        if tag in VOID or tag == "head":
            continue
        if closing:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if place >= 0:
                del stack[place:]
        else:
            if tag not in INLINE:
                place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), -1)
                if place >= 0:
                    del stack[place:]
            stack.append((tag, _name(tag, token[6])))
        if tag == "a" or links:
            links = sum(name == "a" for name, _ in stack)
    add(page[at:])
    return [b for b in blocks if b.text]


_slots: dict[str, tuple[int, ...]] = {}


def _path_slots(name: str) -> tuple[int, ...]:
    found = _slots.get(name)
    if found is None:
        if len(_slots) > 50_000:
            _slots.clear()
        found = tuple(zlib.crc32(w.encode()) % PATH_SIZE for w in name.split())
        _slots[name] = found
    return found


def block_features(pages: list[list[Block]]) -> list[np.ndarray]:
    """A row for each block: hashed tag path, hashed words, and a few measures."""
    blocks = [b for p in pages for b in p]
    texts = [b.text for b in blocks]
    x = np.zeros((len(blocks), INPUTS), np.float32)
    for i, b in enumerate(blocks):
        for name in b.path:
            for slot in _path_slots(name):
                x[i, slot] = 1
    raw = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words, first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), starts)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(blocks)), n_words)
    slot = row * WORD_SIZE + (words % np.uint64(WORD_SIZE)).astype(np.int64)
    bag = np.bincount(slot, minlength=len(blocks) * WORD_SIZE).reshape(-1, WORD_SIZE)
    norm = np.sqrt((bag**2).sum(axis=1, keepdims=True))
    x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = bag / np.maximum(norm, 1)
    chars = np.array([len(t) for t in texts], float)
    numbers = x[:, PATH_SIZE + WORD_SIZE :]
    numbers[:, 0] = np.log1p(n_words) / 5
    numbers[:, 1] = np.minimum(1, np.array([b.linked for b in blocks]) / np.maximum(chars, 1))
    numbers[:, 2] = [t.endswith((".", "!", "?", "…")) for t in texts]
    numbers[:, 3] = [len(b.path) / 10 for b in blocks]
    numbers[:, 4] = chars / np.maximum(n_words, 1) / 20
    out, at = [], 0
    for p in pages:
        own = x[at : at + len(p)]
        own[:, -1] = np.arange(len(p)) / max(1, len(p))
        out.append(own)
        at += len(p)
    return out


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks of a page, with one output for each."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":
            self.w[f"x{side}"] = rng.normal(0, 0.15, (INPUTS, 4 * HIDDEN))
            self.w[f"h{side}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.w[f"c{side}"] = bias
        self.w["o"] = rng.normal(0, 0.15, 2 * HIDDEN)
        self.w["d"] = np.zeros(1)

    def _direction(self, x: np.ndarray, side: str, keep: list | None):
        """Hidden states of pages by steps, read in the given order."""
        pages, steps, _ = x.shape
        h = c = np.zeros((pages, HIDDEN))
        inputs = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
        out = np.empty((pages, steps, HIDDEN))
        for t in range(steps):
            gates = inputs[:, t] + h @ self.w[f"h{side}"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            squeezed = np.tanh(c)
            if keep is not None:
                keep.append((h, before, i, f, o, g, squeezed))
            h = o * squeezed
            out[:, t] = h
        return out

    @staticmethod
    def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each page's steps in reverse order; what is beyond its end stays behind."""
        at = np.arange(x.shape[1])[None, :]
        back = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
        return np.take_along_axis(x, back[:, :, None], axis=1)

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kept_f, kept_b = ([], []) if keep is not None else (None, None)
        turned = self._turned(x, lengths)
        ahead = self._direction(x, "f", kept_f)
        behind = self._turned(self._direction(turned, "b", kept_b), lengths)
        both = np.concatenate([ahead, behind], axis=2)
        if keep is not None:
            keep.update(f=kept_f, b=kept_b, both=both, turned=turned)
        return _sigmoid(both @ self.w["o"] + self.w["d"])

    def _back(self, x: np.ndarray, side: str, kept: list, d_out: np.ndarray, grads: dict) -> None:
        dh = dc = np.zeros((len(x), HIDDEN))
        for t in range(x.shape[1] - 1, -1, -1):
            h, before, i, f, o, g, squeezed = kept[t]
            dh = dh + d_out[:, t]
            dc = dc + dh * o * (1 - squeezed**2)
            gates = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f),
                 dh * squeezed * o * (1 - o), dc * i * (1 - g**2)], axis=1,
            )
            grads[f"x{side}"] += x[:, t].T @ gates
            grads[f"h{side}"] += h.T @ gates
            grads[f"c{side}"] += gates.sum(axis=0)
            dh, dc = gates @ self.w[f"h{side}"].T, dc * f

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict:
        keep: dict = {}
        p = self.forward(x, lengths, keep)
        real = np.arange(x.shape[1])[None, :] < lengths[:, None]
        error = (p - y) * real / real.sum()
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["o"] = np.einsum("pt,pth->h", error, keep["both"])
        grads["d"] = error.sum(keepdims=True).ravel()
        d_both = error[:, :, None] * self.w["o"]
        self._back(x, "f", keep["f"], d_both[:, :, :HIDDEN], grads)
        d_behind = self._turned(d_both[:, :, HIDDEN:], lengths)
        self._back(keep["turned"], "b", keep["b"], d_behind, grads)
        return grads

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int, seed: int = 1) -> None:
        """Adam on random pages; a long page is seen in windows of ``MOST_STEPS`` blocks."""
        rng = np.random.default_rng(seed)
        windows = [
            (x[i : i + MOST_STEPS], y[i : i + MOST_STEPS])
            for x, y in pages
            for i in range(0, len(x), MOST_STEPS)
        ]
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            chosen = [windows[i] for i in rng.integers(0, len(windows), BATCH)]
            x, lengths = padded([x for x, _ in chosen])
            y = padded([y[:, None] for _, y in chosen])[0][:, :, 0]
            for k, g in self.gradients(x, lengths, y).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                rate = 0.02 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                self.w[k] = self.w[k] - rate * mean[k] / (np.sqrt(square[k]) + 1e-8)

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            longest = max(2 * len(pages[order[at]]), 8)
            end = at
            while end < len(order) and len(pages[order[end]]) <= longest and end - at < 256:
                end += 1
            group = order[at:end]
            x, lengths = padded([pages[i] for i in group])
            for i, p in zip(group, self.forward(x, lengths)):
                out[i] = p[: len(pages[i])] > 0.5
            at = end
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), max(lengths), rows[0].shape[1]))
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
    return x, lengths


def seed_labels(blocks: list[Block]) -> np.ndarray:
    """Labels to learn from: blocks that no element around them tells against."""
    names = [set(" ".join(b.path).split()) for b in blocks]
    framed = any(n & {"article", "main"} for n in names)
    good = [not n & set(BOILERPLATE) and (not framed or bool(n & {"article", "main"})) for n in names]
    return np.array(good, float)


def varied(pages: list[list[Block]], rng: np.random.Generator) -> list[tuple[list[Block], np.ndarray]]:
    """Pages as they are, and the same pages laid out in other ways.

    In the other ways the main text stands in other elements, and blocks of other
    pages stand before, between and after it in elements of boilerplate.
    """
    out = [(p, seed_labels(p)) for p in pages]
    pool = [b for p in pages for b in p]
    for p in pages:
        y = seed_labels(p)
        frame = ("html", "body", *rng.choice(
            ["article", "main", "div content", "div post", "section story", "div entry",
             "div article body", "div main content"], 1,
        ))
        blocks, labels = [], []

        def boilerplate(count: int, inner: tuple[str, ...]) -> None:
            word = str(rng.choice(BOILERPLATE))
            tag = word if word in ("nav", "header", "footer", "aside", "form") else (
                f"{rng.choice(['div', 'section', 'aside', 'ul'])} {word}"
            )
            leaf = str(rng.choice(["p", "li", "div", "h3", "span", "td"]))
            for b in (pool[i] for i in rng.integers(0, len(pool), count)):
                own = Block((*inner, tag, leaf), b.parts, b.linked)
                own.linked = len(own.text) if rng.random() < 0.3 else 0
                blocks.append(own)
                labels.append(0.0)

        for _ in range(int(rng.integers(1, 4))):
            boilerplate(int(rng.integers(1, 6)), ("html", "body"))
        main = [b for b, good in zip(p, y) if good]
        for b in main:
            leaf = str(rng.choice(["p", "p", "p", "h2", "li", "blockquote", "div", "pre"]))
            blocks.append(Block((*frame, leaf), b.parts, b.linked))
            labels.append(1.0)
            if rng.random() < 0.1:
                boilerplate(1, frame)
        for _ in range(int(rng.integers(1, 4))):
            boilerplate(int(rng.integers(1, 6)), ("html", "body"))
        out.append((blocks, np.array(labels)))
    return out


def fit(pages: DataFrame, n_pages: int = TRAINING_PAGES, steps: int = STEPS) -> Labeller:
    """A labeller from ``n_pages`` distinct pages, those with the smallest hash of their html.

    No page is labelled by hand: ``seed_labels`` reads labels off the words of the
    elements around a block, and ``varied`` adds other layouts. The network learns
    to do so from hashed paths and words, and from what stands around a block.
    """
    hashed = pages.filter("html IS NOT NULL").select(F.xxhash64("html").alias("hash"), "html")
    # Of copies only the hashes are shuffled.
    least = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(n_pages).collect()]
    chosen = hashed.filter(F.col("hash").isin(least)).groupBy("hash").agg(F.min("html").alias("html"))
    rows = sorted(chosen.collect(), key=lambda r: r["hash"])
    blocks = [b for b in (page_blocks(r["html"]) for r in rows) if b]
    model = Labeller()
    if blocks:
        sets = varied(blocks, np.random.default_rng(7))
        features = block_features([b for b, _ in sets])
        model.train([(x, y) for x, (_, y) in zip(features, sets)], steps)
    return model


def extract_text(
    pages: DataFrame, model: Labeller | None = None, html_col: str = "html", into: str = "main_text"
) -> DataFrame:
    """``pages`` with ``into``: the main text of each page's whole html.

    Blocks are the texts between block-level tags, with character references
    decoded and white space made one blank; those that the labeller takes for main
    text are joined by a blank, in page order. Null, empty and textless pages give
    an empty text. No shuffle; the model, a few thousand numbers, goes to all tasks.
    """
    model = model or fit(pages.select(F.col(html_col).alias("html")))
    shared = pages.sparkSession.sparkContext.broadcast(model.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.w = shared.value
        for batch in batches:
            texts = []
            column = batch.column(html_col)
            for at in range(0, len(column), 512):
                found = [page_blocks(p or "") for p in column.slice(at, 512).to_pylist()]
                for blocks, keep in zip(found, labeller.labels(block_features(found))):
                    texts.append(" ".join(b.text for b, k in zip(blocks, keep) if k))
            columns = [c for c in batch.schema.names if c != into]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, columns), pa.array(texts, pa.string())], names=[*columns, into]
            )

    pages = pages.drop(into)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInArrow(run, f"{fields}, `{into}` string")
