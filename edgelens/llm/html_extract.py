"""Main text of web pages by a recurrent block labeller.

A page is a sequence of blocks, the runs of text between block-level tags. A bidirectional LSTM,
in numpy, reads for each block a vector of its tag path and of its hashed words and decides, with
the context of the whole page, whether the block belongs to the article.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm.sample import hashed_sample

#: Fixed values of HTML: elements that never have content, those whose content is no text, and
#: those that begin and end a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style template noscript iframe object svg math textarea select canvas audio video".split())
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: An element on the left ends one of those on the right that is still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

PATH_SIZE, WORD_SIZE, EXTRA, HIDDEN = 64, 32, 6, 24
#: Pages from which the labeller learns, pages composed from them, and passes over both.
TRAIN_PAGES, COMPOSED, EPOCHS = 200, 500, 14
#: Pages with more characters or blocks are not trained on, and of an article so many blocks are
#: used to compose others; every page is extracted whole.
TRAIN_CHARS, TRAIN_BLOCKS, TRAIN_PARAGRAPHS = 200_000, 400, 40
SEED = 29

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<!--|<[!?][^>]*>")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")


@dataclass
class Block:
    """``path``: names of the open elements and of their classes; ``linked``: characters in links."""

    path: tuple[str, ...]
    text: str
    linked: int


def _behind(page: str, name: str, at: int) -> int | None:
    """Where the content of a ``RAW`` element that starts at ``at`` ends, its end tag included.

    Foreign elements may hold their like. Scripts and styles that are never closed hold the rest
    of the page; any other is taken for a stray tag (None), as its text would be lost.
    """
    depth, last = 1, None
    for m in re.compile(rf"<(/?){name}(?=[\s/>])([^>]*)>", re.I).finditer(page, at):
        if m.group(1):
            depth, last = depth - 1, m.end()
        elif name in FOREIGN and not m.group(2).endswith("/"):
            depth += 1
        if not depth:
            return last
    return len(page) if last is None and name in ("script", "style") else last


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order: references decoded, white space made one space, trimmed.

    Comments, markup and the content of scripts, styles and the like are left out, as is what
    stands in the head. Unclosed elements, comments and tags do no harm.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = at = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            parts.clear()
            if "&" in text:
                text = html.unescape(text)
            text = _SPACES.sub(" ", text).strip()
            if text and not any(name == "head" or name == "title" for name, _ in stack):
                found.append(Block(tuple(x for _, names in stack for x in names), text, linked))
        linked = 0

    def text_to(end: int) -> None:
        nonlocal linked
        if end > at:
            parts.append(page[at:end])
            if links:
                linked += end - at

    def close(names: set[str] | frozenset[str], until: frozenset[str] = frozenset()) -> None:
        nonlocal links
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                if any(n in BLOCK for n, _ in stack[depth:]):
                    flush()
                links -= sum(n == "a" for n, _ in stack[depth:])
                del stack[depth:]
                return
            if stack[depth][0] in until:
                return

    never: set[str] = set()
    while True:
        m = _TAG.search(page, at)
        if m is None:
            text_to(len(page))
            break
        text_to(m.start())
        at = m.end()
        if m.group() == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        name = (m.group(2) or "").lower()
        if not name:
            continue
        rest = m.group(3)
        if rest.count('"') % 2 and (quote := page.find('"', at)) >= 0 and (end := page.find(">", quote)) >= 0:
            rest, at = page[m.start(3) : end], end + 1  # a quoted value held the first ">"
        if m.group(1):
            if name in BLOCK:
                flush()
            close({name})
            continue
        if name in RAW:
            parts.append(" ")
            if name in never or (name in FOREIGN and rest.endswith("/")):
                continue
            end = _behind(page, name, at)
            if end is None:  # nor is any later one closed
                never.add(name)
            at = at if end is None else end
            continue
        if name == "br":
            parts.append(" ")
        if name in BLOCK:
            flush()
            if name not in ("html", "body", "li", "td", "th", "tr", "dt", "dd", "option"):
                close({"p"}, frozenset({"div", "article", "section", "td", "li", "body"}))
            if name in CLOSES:
                close(CLOSES[name], frozenset({"ul", "ol", "dl", "table", "select", "menu"}))
            if name == "body":
                close({"head"})
        if name in VOID or rest.endswith("/"):
            continue
        names = [name]
        if rest:
            for _, value in _ATTRIBUTE.findall(rest):
                names += [f".{x}" for x in _NAME.findall(value.lower())]
        stack.append((name, tuple(names)))
        links += name == "a"
    flush()
    return found


# ------------------------------------------------------------------------------------ features


class _Buckets(dict):
    """Hash buckets of words, remembered for a bounded number of words."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bucket = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.size
        return bucket


_PATHS, _WORDS = _Buckets(PATH_SIZE), _Buckets(WORD_SIZE)


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block: its hashed path, its hashed words by share, and six measures."""
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + EXTRA), np.float32)
    for i, block in enumerate(blocks):
        out[i, [_PATHS[x] for x in block.path]] = 1
        words = block.text.split()
        out[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.bincount([_WORDS[x] for x in words], minlength=WORD_SIZE) / len(words)
        length = len(block.text)
        out[i, -EXTRA:] = (
            np.log1p(len(words)) / 5, min(1.0, block.linked / length), block.text[-1] in ".!?\"'", block.text.count(",") / len(words),
            i / len(blocks), np.log1p(len(blocks)) / 5,
        )
    return out


# ------------------------------------------------------------------------------------ labeller


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM with a logistic output for each block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + EXTRA
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {"out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.weights |= {f"x{way}": draw(size, 4 * HIDDEN), f"h{way}": draw(HIDDEN, 4 * HIDDEN), f"c{way}": bias}

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States (time, page, hidden) of one direction; padding keeps the state as it is."""
        w = self.weights
        order = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        inputs = x @ w[f"x{way}"] + w[f"c{way}"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        states, tape = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        for t in order:
            gates = inputs[t] + h @ w[f"h{way}"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            fresh = f * c + i * g
            tape.append((t, h, c, i, f, o, g, np.tanh(fresh), m))
            h, c = m * (o * np.tanh(fresh)) + (1 - m) * h, m * fresh + (1 - m) * c
            states[t] = h
        return states, tape

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page's features, the probability of each block to be main text. Pages of like
        length are run together."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= 20_000:
                end += 1
            group = order[at:end]
            x, mask = _padded([pages[i] for i in group])
            both = np.concatenate([self._run(x, mask, "f")[0], self._run(x, mask, "b")[0]], axis=2)
            p = _sigmoid(both @ self.weights["out"] + self.weights["bias"])[..., 0]
            for k, i in enumerate(group):
                out[i] = p[: len(pages[i]), k]
            at = end
        return out

    def _gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        runs = {way: self._run(x, mask, way) for way in ("f", "b")}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        p = _sigmoid(both @ w["out"] + w["bias"])[..., 0]
        d_logit = ((p - y) * mask / mask.sum())[..., None].astype(np.float32)
        grads = {"out": both.reshape(-1, 2 * HIDDEN).T @ d_logit.reshape(-1, 1), "bias": d_logit.sum((0, 1))}
        d_states = d_logit @ w["out"].T
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            d_x = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            grads[f"h{way}"] = np.zeros_like(w[f"h{way}"])
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh, m in reversed(runs[way][1]):
                dh = dh + d_states[t, :, part]
                d_fresh = m * (dh * o * (1 - tanh**2) + dc)
                gate = np.concatenate([d_fresh * g * i * (1 - i), d_fresh * c * f * (1 - f), m * dh * tanh * o * (1 - o), d_fresh * i * (1 - g**2)], axis=1)
                d_x[t] = gate
                grads[f"h{way}"] += h.T @ gate
                dh, dc = gate @ w[f"h{way}"].T + (1 - m) * dh, d_fresh * f + (1 - m) * dc
            grads[f"x{way}"] = x.reshape(-1, x.shape[2]).T @ d_x.reshape(-1, 4 * HIDDEN)
            grads[f"c{way}"] = d_x.sum((0, 1))
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam over batches of pages of like length, in a seeded order."""
        rng = np.random.default_rng(seed)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        batches = [order[i : i + 24] for i in range(0, len(order), 24)]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            for b in rng.permutation(len(batches)):
                x, mask = _padded([pages[i] for i in batches[b]])
                y, _ = _padded([labels[i][:, None] for i in batches[b]])
                step += 1
                for k, g in self._gradients(x, mask, y[..., 0]).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    self.weights[k] = self.weights[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, pages)), len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros(x.shape[:2], np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


# ------------------------------------------------------------------------------------ training

#: Names by which pages mark what is and what is not their article.
_BESIDE = {
    "header": "header masthead topbar banner brand logo", "nav": "nav menu navbar breadcrumb tabs pagination", "footer": "footer copyright legal bottom colophon",
    "aside": "aside sidebar widget related recommended trending popular", "notice": "cookie consent notice alert gdpr popup modal overlay",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner", "form": "form newsletter subscribe signup search login",
    "comments": "comments comment replies discussion respond disqus", "social": "share social follow tags meta",
}
_ARTICLE = "article main content post entry story body text page blog"
_NOT_MAIN = frozenset(x for names in _BESIDE.values() for x in names.split()) | {"button", "label", "dialog"}


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """1 for the blocks in an ``article`` or ``main`` element that no element with a name from
    beside it encloses; None for a page that has no such element."""
    if not any(x in ("article", "main") for b in blocks for x in b.path):
        return None
    inside = lambda b: any(x in ("article", "main") for x in b.path) and not any(x.lstrip(".") in _NOT_MAIN for x in b.path)
    return np.array([inside(b) for b in blocks], np.float32)


def compose(rng: np.random.Generator, article: list[str], beside: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page made of an article's paragraphs and of texts from beside articles, with its labels.

    Elements and their names vary, parts come and go, and some pages have no telling names."""
    pick = lambda words: str(rng.choice(words.split()))
    mark = "\x01"
    say = lambda: html.escape(str(rng.choice(beside)))[: int(rng.integers(8, 160))] or "x"

    def part(kind: str) -> str:
        name = pick(_BESIDE[kind])
        tag = str(rng.choice([kind if kind in ("header", "nav", "footer", "aside", "form") else "div", "div", "section"]))
        inner = str(rng.choice(["list", "plain", "paragraphs"], p=[0.6, 0.2, 0.2] if kind == "nav" else [0.2, 0.4, 0.4]))
        if inner == "list":
            body = "<ul>" + "".join(f"<li><a href='#'>{say()[:40]}</a></li>" for _ in range(int(rng.integers(2, 8)))) + "</ul>"
        else:
            wrap = "p" if inner == "paragraphs" else "div"
            body = "".join(f"<{wrap}>{say()}</{wrap}>" for _ in range(int(rng.integers(1, 5)))) if inner == "paragraphs" else say()
        named = f" class='{name}'" if tag in ("div", "section") or rng.random() < 0.3 else ""
        return f"<{tag}{named}>{body}</{tag}>"

    paragraphs = "".join(
        f"<{tag}>{'<b>' if rng.random() < 0.2 else ''}{mark}{html.escape(x)}</{tag}>" + (part("ad") if rng.random() < 0.04 else "")
        for x in article for tag in [str(rng.choice(["p", "p", "p", "h2", "li", "blockquote", "div"]))]
    )
    heading = f"<h1>{mark}{html.escape(article[0][:60])}</h1>"
    wrap = str(rng.choice(["<article>", "<main>", f"<div class='{pick(_ARTICLE)}'>", f"<section id='{pick(_ARTICLE)}'>", f"<main><article class='{pick(_ARTICLE)}'>"]))
    end = "".join(f"</{x}>" for x in reversed(re.findall(r"<(\w+)", wrap)))
    before = "".join(part(k) for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.5)
    after = "".join(part(k) for k in ("social", "comments", "aside", "form", "ad", "footer") if rng.random() < 0.5)
    tail = "".join(part(k) for k in ("social", "comments") if rng.random() < 0.2)
    page = f"<html><body>{before}{wrap}{heading}{paragraphs}{tail}{end}{after}</body></html>"
    blocks = blocks_of(page)
    labels = np.array([mark in b.text for b in blocks], np.float32)
    for block in blocks:
        block.text = block.text.replace(mark, "").strip() or "x"
    return blocks, labels


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", seed: int = SEED) -> BlockLabeller:
    """Learns from the ``TRAIN_PAGES`` pages with the smallest hash of their id, labelled by their
    ``article`` and ``main`` elements, and from ``COMPOSED`` pages made of their blocks.

    Null, empty and very long pages (``TRAIN_CHARS``, ``TRAIN_BLOCKS``) are left out of the
    sample. Pages of one id count once. From an empty table it learns by composed pages alone."""
    shown = F.when(F.length(html_col).between(1, TRAIN_CHARS), F.col(html_col))
    rows = hashed_sample(pages, id_col, shown, TRAIN_PAGES)
    known, articles, beside = [], [], []
    for row in rows:
        blocks = blocks_of(row)
        labels = weak_labels(blocks)
        if labels is not None and len(blocks) <= TRAIN_BLOCKS:
            known.append((blocks, labels))
            articles.append([b.text for b, y in zip(blocks, labels, strict=True) if y][:TRAIN_PARAGRAPHS])
            beside += [b.text for b, y in zip(blocks, labels, strict=True) if not y]
    articles = [x for x in articles if x] or [["One sentence of an article, which is long enough to be read.", "Another one follows it."]]
    beside = beside or ["Home", "About us", "All rights reserved."]
    rng = np.random.default_rng(seed)
    short = [x[:120] for a in articles for x in a]  # texts alone must not tell
    for k in range(COMPOSED):
        known.append(compose(rng, articles[k % len(articles)], beside + short[: len(beside)]))
    labeller = BlockLabeller(seed)
    known = [(features(blocks), labels) for blocks, labels in known if blocks]
    labeller.fit([x for x, _ in known], [y for _, y in known])
    return labeller


def extract_text(labeller: BlockLabeller, pages: list[str]) -> list[str]:
    """The main text of each page: its article's blocks joined by an empty line."""
    blocks = [blocks_of(x) for x in pages]
    found = labeller.probabilities([features(x) for x in blocks])
    return ["\n\n".join(b.text for b, p in zip(own, ps, strict=True) if p >= 0.5) for own, ps in zip(blocks, found, strict=True)]


def extract_main_text(pages: DataFrame, labeller: BlockLabeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (empty if none) and ``n_chars``.

    Null html is empty. Whole pages are read; repeated rows and null ids are pages like any
    other. Further columns are ignored; an empty table gives an empty result.
    """
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType())])
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                rows = batch.slice(at, 128)
                texts = extract_text(shared.value, [x.as_py() or "" for x in rows.column(2)])
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())], schema.names)

    found = pages.select(id_col, url_col, F.col(html_col).cast("string").alias("_html")).mapInArrow(extract, schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))
