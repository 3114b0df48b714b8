"""Main text of web pages: a recurrent labeller of blocks.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags, each with the path of open tags
(names, classes, ids, roles). A bidirectional LSTM in numpy reads, for each block in page order, hashed tag-path
vectors, hashed-word vectors and a few numbers (length, share of link text, punctuation, place), so every block is
classified with the whole page as context. The blocks judged to be main text are joined in page order.

The labeller is trained here, on the driver, on at most about `SAMPLE_PAGES` pages of at most `SAMPLE_BYTES` bytes (a
documented bound): pages with an `article` or `main` element label themselves, and as many pages again are made up from
the sample's sentences in other layouts (menus, sidebars, notices, adverts, forms, reader comments; content without
`article`). All pages are then labelled in whole: no block is dropped or capped.

Nulls: a null or empty page has an empty text; a null id or url is kept. Unclosed and misnested tags are tolerated, a `<`
that begins no tag is text. Repeated rows are extracted each; an empty table gives no rows (and no training).
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm import textops

SAMPLE_PAGES = 300
SAMPLE_BYTES = 1 << 16
TRAINING_BLOCKS = 96
EPOCHS = 14
HIDDEN = 12
PATH_SIZE, PATH_BUCKETS = 16, 1024
WORD_SIZE, WORD_BUCKETS = 4, 256
NUMBERS = 7
SLICE_BYTES = 1 << 20

_BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html label legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NO_CONTENT = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_SAME = frozenset("p li dt dd td th tr option".split())
_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|iframe|svg|textarea|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.I | re.S)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>"']*+(?:"[^"<]*+"[^<>"']*+|'[^'<]*+'[^<>"']*+)*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*+)>""")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[int, ...]  # buckets of the path's tags and names
    linked: int  # characters inside links
    main: bool  # inside `article` or `main` and nothing that excludes it
    marked: bool  # inside an element made up for training as main text


_EXCLUDED = frozenset("nav footer header aside form menu button label dialog".split())
_MARK = "data-main"
_bucket_of: dict[str, int] = {}


def _bucket(token: str) -> int:
    if token not in _bucket_of:
        if len(_bucket_of) > 100_000:
            _bucket_of.clear()
        _bucket_of[token] = zlib.crc32(token.encode()) % PATH_BUCKETS
    return _bucket_of[token]


def _describe(tag: str, attributes: str) -> tuple[str, tuple[int, ...], bool]:
    tokens = [tag]
    if attributes:
        for found in _NAMED.findall(attributes):
            tokens += [f".{part}" for part in _PARTS.findall("".join(found).lower())[:8]]
    return tag, tuple(_bucket(t) for t in tokens), _MARK in attributes


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; blocks without text are left out."""
    page = _UNSEEN.sub(" ", page)
    stack: list[tuple[str, tuple[int, ...], bool]] = []
    out: list[Block] = []
    pieces: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                names = [s[0] for s in stack]
                inside = max((i for i, n in enumerate(names) if n in ("article", "main")), default=-1)
                main = inside >= 0 and not any(n in _EXCLUDED for n in names[inside:])
                out.append(Block(text, tuple(b for s in stack for b in s[1]), linked, main, any(s[2] for s in stack)))
            pieces.clear()
        linked = 0

    for found in _TAG.finditer(page):
        text = page[at : found.start()]
        at = found.end()
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text)
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        tag = tag.lower()
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        elif tag in _BLOCK_TAGS:
            flush()
            in_link = False
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif tag not in _NO_CONTENT:
                if stack and tag in _CLOSED_BY_SAME and stack[-1][0] == tag:
                    stack.pop()
                elif stack and stack[-1][0] == "p":  # a paragraph holds no blocks
                    stack.pop()
                stack.append(_describe(tag, attributes))
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(path buckets, block of each path bucket, word and number columns) of all blocks of some pages, in order."""
    every = [b for page in pages for b in page]
    path = np.array([x for b in every for x in b.path], np.int64)
    owner = np.repeat(np.arange(len(every)), [len(b.path) for b in every])
    data, offsets = textops.text_buffers(pa.array([b.text for b in every], pa.large_string()))
    vectors = np.zeros((len(every), WORD_SIZE), np.float32)
    n_words = np.zeros(len(every))
    for first, last in textops.slices(offsets):
        found = textops.words(data, offsets[first : last + 1])
        count = np.diff(found.offsets)
        filled = np.flatnonzero(count)
        if len(filled):
            summed = np.add.reduceat(_word_vectors()[(found.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)], found.offsets[:-1][filled], axis=0)
            vectors[first + filled] = summed / np.sqrt(count[filled])[:, None]
        n_words[first:last] = count
    chars = np.array([len(b.text) for b in every], float)
    place = np.concatenate([(np.arange(len(p)) + 0.5) / max(1, len(p)) for p in pages]) if every else np.zeros(0)
    numbers = np.stack(
        [
            np.log1p(chars) / 4,
            np.log1p(n_words) / 3,
            np.array([min(1.0, b.linked / max(1, len(b.text))) for b in every]),
            np.array([b.text.count(".") + b.text.count(",") for b in every]) / np.maximum(1, n_words),
            np.array([b.text[-1] in ".!?" for b in every], float),
            np.array([b.text[0] == "©" for b in every], float),
            place,
        ],
        axis=1,
    ) if every else np.zeros((0, NUMBERS))
    return path, owner, np.concatenate([vectors * 0.3, numbers], axis=1).astype(np.float32)


_words_fixed: np.ndarray | None = None


def _word_vectors() -> np.ndarray:
    global _words_fixed
    if _words_fixed is None:
        _words_fixed = np.random.default_rng(5).normal(0, 1, (WORD_BUCKETS, WORD_SIZE)).astype(np.float32)
    return _words_fixed


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with one output per block."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + NUMBERS
        self.p = {"path": rng.normal(0, 0.3, (PATH_BUCKETS, PATH_SIZE)), "out_b": np.zeros(1)}
        for d in "fb":
            self.p |= {f"w{d}": rng.normal(0, size**-0.5, (size, 4 * HIDDEN)), f"u{d}": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))}
            self.p |= {f"b{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN), f"out{d}": rng.normal(0, 0.3, HIDDEN)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, path: np.ndarray, owner: np.ndarray, others: np.ndarray) -> np.ndarray:
        summed = np.zeros((len(others), PATH_SIZE), np.float32)
        if len(path):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            summed[owner[first]] = np.add.reduceat(self.p["path"][path], first, axis=0)
        return np.concatenate([summed, others], axis=1)

    def scores(self, pages: list[list[Block]]) -> np.ndarray:
        """Probability of main text of every block, pages one after the other."""
        sizes = np.array([len(p) for p in pages])
        x = self.inputs(*features(pages))
        total = np.full(len(x), self.p["out_b"][0], np.float32)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        for d in "fb":
            gates = x @ self.p[f"w{d}"] + self.p[f"b{d}"]
            h = np.zeros((len(pages), HIDDEN), np.float32)
            c = np.zeros_like(h)
            for t in range(int(sizes[0]) if len(sizes) else 0):
                n = int(np.searchsorted(-sizes, -t, side="left"))  # pages longer than t
                row = starts[:n] + (t if d == "f" else sizes[:n] - 1 - t)
                z = gates[row] + h[:n] @ self.p[f"u{d}"]
                i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
                c[:n] = f * c[:n] + i * np.tanh(z[:, 3 * HIDDEN :])
                h[:n] = o * np.tanh(c[:n])
                total[row] += h[:n] @ self.p[f"out{d}"]
        return _sigmoid(total)

    def step(self, pages: list[list[Block]], wanted: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the cross entropy for a batch of pages."""
        path, owner, others = features(pages)
        x = self.inputs(path, owner, others)
        sizes = np.array([len(p) for p in pages])
        starts, longest = np.cumsum(sizes) - sizes, int(sizes.max())
        filled = np.arange(longest) < sizes[:, None]
        rows = {"f": np.where(filled, starts[:, None] + np.arange(longest), 0), "b": np.where(filled, starts[:, None] + sizes[:, None] - 1 - np.arange(longest), 0)}
        total = np.full(len(x), self.p["out_b"][0])
        kept = {}
        for d in "fb":
            h, c, states = np.zeros((len(pages), HIDDEN)), np.zeros((len(pages), HIDDEN)), []
            for t in range(longest):
                own = x[rows[d][:, t]]
                z = own @ self.p[f"w{d}"] + self.p[f"b{d}"] + h @ self.p[f"u{d}"]
                i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
                g = np.tanh(z[:, 3 * HIDDEN :])
                c_new = f * c + i * g
                states.append((own, h, c, i, f, o, g, c_new))
                h, c = o * np.tanh(c_new), c_new
                some = filled[:, t]
                total[rows[d][some, t]] += (h @ self.p[f"out{d}"])[some]
            kept[d] = states
        slope = (_sigmoid(total) - np.concatenate(wanted)) / len(x)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out_b"][0] = slope.sum()
        dx = np.zeros_like(x)
        for d in "fb":
            dh_next, dc_next = np.zeros((len(pages), HIDDEN)), np.zeros((len(pages), HIDDEN))
            for t in range(longest - 1, -1, -1):
                own, h, c, i, f, o, g, c_new = kept[d][t]
                ds = np.where(filled[:, t], slope[rows[d][:, t]], 0)
                tanh = np.tanh(c_new)
                grads[f"out{d}"] += ds @ (o * tanh)
                dh = ds[:, None] * self.p[f"out{d}"] + dh_next
                dc = dh * o * (1 - tanh**2) + dc_next
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                grads[f"w{d}"] += own.T @ dz
                grads[f"u{d}"] += h.T @ dz
                grads[f"b{d}"] += dz.sum(axis=0)
                np.add.at(dx, rows[d][:, t], np.where(filled[:, t, None], dz @ self.p[f"w{d}"].T, 0))
                dh_next, dc_next = dz @ self.p[f"u{d}"].T, dc * f
        np.add.at(grads["path"], path, dx[owner, :PATH_SIZE])
        return grads

    def fit(self, pages: list[list[Block]], wanted: list[np.ndarray], epochs: int = EPOCHS, batch: int = 24, rate: float = 0.02, seed: int = 2) -> Labeller:
        rng = np.random.default_rng(seed)
        first, second, t = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for k in range(0, len(order), batch):
                own = order[k : k + batch]
                grads = self.step([pages[i] for i in own], [wanted[i] for i in own])
                t += 1
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    size = rate * (1 - epoch / (epochs + 1)) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
                    self.p[name] -= (size * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
        return self


def made_up_page(rng: np.random.Generator, sentences: list[str]) -> str:
    """A page in a random layout, its main text inside elements with the mark."""

    def say(low: int, high: int) -> str:
        return html.escape(" ".join(sentences[i] for i in rng.integers(0, len(sentences), rng.integers(low, high + 1))))

    def word() -> str:
        return html.escape((sentences[rng.integers(0, len(sentences))].split() or ["x"])[0])

    def pick(*choices: str) -> str:
        return choices[rng.integers(0, len(choices))]

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="#">{word()}</a></li>' for _ in range(n)) + "</ul>"

    def aside() -> str:
        kind = rng.integers(0, 7)
        if kind == 0:
            return f'<div class="{pick("ad", "advert", "ads banner", "sponsored", "promo")}">{say(1, 2)}</div>'
        if kind == 1:
            return f'<{pick("aside", "div")} class="{pick("sidebar", "related", "widget", "side")}"><h3>{word()}</h3>{pick(links(4), f"<p>{say(1, 2)}</p>")}</{pick("aside", "div")}>'
        if kind == 2:
            return f'<div class="{pick("cookie-notice", "notice", "cookie banner", "consent", "popup")}"><p>{say(1, 2)}</p><button>{word()}</button></div>'
        if kind == 3:
            return f'<form class="{pick("newsletter", "search", "subscribe", "")}"><label>{word()}</label><input type="text"><button>{word()}</button><p>{say(1, 1)}</p></form>'
        if kind == 4:
            return f'<div class="{pick("share", "social", "tags", "breadcrumb", "pagination")}">' + " ".join(f'<a href="#">{word()}</a>' for _ in range(4)) + "</div>"
        if kind == 5:
            return f'<aside><p>{say(1, 2)}</p></aside>'
        return f'<nav class="{pick("menu", "toc", "")}">{links(3)}</nav>'

    def body() -> str:
        parts = [f"<h1>{word()} {word()}</h1>"]
        for _ in range(rng.integers(2, 9)):
            kind = rng.integers(0, 12)
            parts.append(
                f"<h2>{word()} {word()}</h2>" if kind == 0 else f"<blockquote><p>{say(1, 2)}</p></blockquote>" if kind == 1 else
                "<ul>" + "".join(f"<li>{say(1, 1)}</li>" for _ in range(3)) + "</ul>" if kind == 2 else
                f"<p><b>{word()}</b> {say(1, 3)}<br></p>" if kind == 3 else f"<p>{word()}</p>" if kind == 4 else
                f'<p>{say(1, 2)} <a href="#">{word()}</a></p>' if kind == 5 else f"<p>{say(1, 5)}</p>"
            )
        cut = rng.integers(1, len(parts) + 1)
        marked = lambda some: f"<section {_MARK}>{''.join(some)}</section>" if rng.random() < 0.2 else "".join(re.sub(r"^<(\w+)", rf"<\1 {_MARK}", x) for x in some)
        return marked(parts[:cut]) + (aside() if rng.random() < 0.4 else "") + marked(parts[cut:])

    wrap = pick("<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post-body">', '<section class="entry-content">', '<div class="article-text">', '<div class="container">', "<main><article>")
    close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", wrap)))
    comment = pick('<article class="comment">', '<div class="comment-body">', '<li class="comment">')
    closed = f"</{re.match(r'<(\w+)', comment)[1]}>"
    comments = f'<{pick("section", "div")} {pick("id", "class")}="{pick("comments", "comment-list", "responses", "discussion")}"><h3>{word()}</h3>' + "".join(f"{comment}<p>{say(1, 3)}</p>{closed}" for _ in range(rng.integers(1, 5))) + "</section></div>"
    top = pick(f'<header><a href="#">{word()}</a><p>{say(1, 1)}</p></header>', f'<div class="header">{word()} {word()}</div>', "")
    menu = pick(f"<nav>{links(6)}</nav>", f'<div class="{pick("menu", "navbar", "nav")}">{links(5)}</div>', "")
    foot = pick(f"<footer>&copy; {word()} &middot; {say(1, 1)}</footer>", f'<div class="{pick("footer", "copyright", "site-footer")}">{say(1, 2)}</div>', f"<footer><p>{say(1, 2)}</p>{links(3)}</footer>", "")
    some = lambda chance: aside() if rng.random() < chance else ""
    return f"<html><body>{top}{menu}{some(0.5)}{wrap}{body()}{close}{some(0.5)}{comments if rng.random() < 0.35 else ''}{some(0.3)}{foot}</body></html>"


def train(pages: list[str], seed: int = 3) -> Labeller:
    """Labeller from some pages."""
    rng = np.random.default_rng(seed)
    known = [blocks(p) for p in pages]
    examples, wanted = [], []
    for page in known:
        if page and any(b.main for b in page):
            examples.append(page[:TRAINING_BLOCKS])
            wanted.append(np.array([b.main for b in examples[-1]], float))
    sentences = [s for page in known for b in page for s in re.split(r"(?<=[.!?]) ", b.text)][:5000] or ["One.", "Two words.", "And a third, longer sentence."]
    for _ in range(max(100, len(pages))):
        page = blocks(made_up_page(rng, sentences))[:TRAINING_BLOCKS]
        if page:
            examples.append(page)
            wanted.append(np.array([b.marked for b in page], float))
    return Labeller().fit(examples, wanted)


def main_texts(pages: list[str], labeller: Labeller) -> list[str]:
    """Main text of each page."""
    found = [blocks(p) for p in pages]
    chosen = labeller.scores(found) >= 0.5
    out, at = [], 0
    for page in found:
        out.append("\n\n".join(b.text for b, c in zip(page, chosen[at : at + len(page)].tolist(), strict=True) if c))
        at += len(page)
    return out


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url"), sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """The columns `keep` with text and n_chars."""
    names = [c for c in keep if c not in ("text", "n_chars")]
    source = pages.select(*names, pages[html_column].alias("__html"))
    small = source.filter(F.octet_length("__html") <= SAMPLE_BYTES).select("__html")
    share = min(1.0, 1.2 * sample_pages / max(1, small.count()))
    drawn = F.pmod(F.xxhash64("__html"), F.lit(1 << 30)) <= int(share * (1 << 30))
    sample = [row[0] for row in small.filter(drawn).distinct().limit(sample_pages).collect()]
    labeller = pages.sparkSession.sparkContext.broadcast(train(sorted(sample)) if sample else Labeller())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textops.text_buffers(batch.column(len(names)))
            for a, b in textops.slices(offsets, SLICE_BYTES):
                texts = main_texts([data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(a, b)], labeller.value)
                own = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__html")
    return source.mapInArrow(run, f"{fields}, text string, n_chars bigint")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op8_html_extraction": op8_html_extraction}
SQL: dict[str, str] = {}
