"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, stretches of text between block-level markup. Each
block is a vector: its tag path and attribute words and its own words, hashed into
learned embeddings, and a few shares. A bidirectional LSTM in numpy reads the
blocks of the whole page in both directions and labels every block as article or
not. It is trained here, once for each driver, on generated pages whose labels are
known (``make_page``), and its weights, some 100 KB whatever the data, are broadcast.

Defined cases: null and empty html, and pages without article blocks, give an
empty text; br ends a block; a page of any length is read whole, all words and all
open elements of each block included; a share of exactly one half is no article; an
empty table gives an empty result; markup that the page ends in the middle of is dropped; a "<" that
starts no markup is text; repeated rows each return a row; extra columns are
ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea)\b.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*'|[\"'][^<>\"']*)*+)(>|\Z|(?=<))|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"\w+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that an opening tag closes.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
SCOPES = frozenset("article aside body div dl footer form header html main nav ol section table ul blockquote".split())
CLOSES |= {t: {"p"} for t in (*SCOPES, "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr", "figure")}

PATH_SLOTS, WORD_SLOTS = 512, 512


def _slot(text: str, slots: int) -> int:
    return zlib.crc32(text.encode()) % slots


@lru_cache(maxsize=100_000)
def _path_slot(text: str) -> int:
    return _slot(text, PATH_SLOTS)


@lru_cache(maxsize=200_000)
def _word_slot(text: str) -> int:
    return _slot(text, WORD_SLOTS)


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[int, ...], linked: float):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str | None) -> list[Block]:
    """The page's non-empty leaf blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    parts: list[tuple[str, bool]] = []
    where: list[tuple[int, ...]] = [()]
    links = 0

    def end() -> None:
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p) for p, a in parts if a)
                out.append(Block(text, where[0], linked / max(1, sum(len(p) for p, _ in parts))))
            parts.clear()

    def add(text: str) -> None:
        if text:
            if not parts:
                where[0] = tuple(s for _, slots in stack for s in slots)
            parts.append((text, links > 0))

    page = page or ""
    at = 0
    for m in _MARKUP.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m.group(3)
        if not name:
            continue
        name, closing = name.lower(), m.group(2) == "/"
        if name not in INLINE:
            end()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
        elif name not in VOID:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES.get(name, ()):
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in SCOPES:
                    break
            attributes = m.group(4)
            slots = [_path_slot(name)]
            if "=" in attributes:
                for a in _ATTRIBUTE.finditer(attributes):
                    slots += [_path_slot("." + w) for w in re.split(r"[^a-z0-9]+", (a.group(2) or a.group(3) or a.group(4) or "").lower()) if w]
            stack.append((name, tuple(slots)))
            links += name == "a"
    add(page[at:])
    end()
    return out


# -- generated training pages -------------------------------------------------------

_SYLLABLES = "an be co da el fi go hu in ka lo mi no or pa qu re sa ti un ve wo ya zi sch tion ent ould".split()
_AROUND = {
    "nav": ["<nav>{links}</nav>", '<div class="menu">{links}</div>', '<div id="navigation">{links}</div>', '<ul class="nav">{items}</ul>', "<div role='navigation'>{links}</div>", '<div class="breadcrumb">{links}</div>'],
    "header": ["<header>{lines}</header>", '<div class="header">{lines}</div>', '<div id="masthead"><p>{line}</p></div>', '<header><h1>{line}</h1>{links}</header>'],
    "notice": ['<div class="cookie-notice">{lines}</div>', '<div id="cookies"><p>{line}</p><button>{word}</button></div>', '<div class="banner notice">{line}</div>', '<div class="alert">{line}</div>', '<div class="consent">{line}</div>'],
    "ad": ['<div class="ad">{line}</div>', '<div class="ads">{lines}</div>', '<div class="advert"><p>{line}</p></div>', '<aside class="sponsored">{line}</aside>', '<div class="ad">{line}\n{line}</div>', '<div class="promo">{lines}</div>'],
    "side": ["<aside>{lines}</aside>", '<div class="sidebar">{lines}</div>', '<div id="sidebar">{links}</div>', '<div class="related"><h3>{word}</h3>{links}</div>', '<div class="widget">{items}</div>', '<aside><h2>{word}</h2><p>{line}</p></aside>'],
    "form": ['<form action="/s"><label>{word}</label><input name="q"><button>{word}</button></form>', '<div class="newsletter"><form><p>{line}</p><button>{word}</button></form></div>', "<form><select><option>{word}</option><option>{word}</option></select></form>", '<div class="subscribe">{line}</div>'],
    "comments": ['<div class="comments"><h3>{word}</h3>{posts}</div>', '<section id="comments">{posts}</section>', '<ol class="comment-list">{posts}</ol>', '<div class="comment"><p>{line}</p></div>', '<div id="disqus_thread"><p>{line}</p></div>', '<section class="responses">{posts}</section>'],
    "footer": ["<footer>{lines}</footer>", '<div class="footer">{lines}</div>', "<footer>&copy; {word} &middot; {line}</footer>", '<div id="footer"><p>{line}</p>{links}</div>', "<footer>&copy; {word}.example.com &middot; {line}\n{line}</footer>"],
}
_MAIN = [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="content">', "</div>"), ('<div class="article-body">', "</div>"), ('<div class="post">', "</div>"), ("<main><article>", "</article></main>"), ('<article class="entry">', "</article>"), ('<div id="main"><section>', "</section></div>"), ("<article>", "</article>"), ("<article>", "</article>")]


def make_page(rng: random.Random) -> tuple[str, list[int]]:
    """A generated page and its blocks' labels. Words tell nothing of the label."""

    def word() -> str:
        w = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
        return rng.choice([w, w, w, w.upper(), w.title(), w + rng.choice(["***", "!!", ",", "&amp;", " |"])])

    def line(most: int = 14) -> str:
        return " ".join(word() for _ in range(rng.randint(1, most))) + rng.choice([".", ".", "", "!"])

    def fill(template: str) -> str:
        links = lambda: "".join(f'<a href="/{word()}">{word()}</a>' + rng.choice(["", " ", "<br>"]) for _ in range(rng.randint(1, 5)))
        items = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{line(3)}</a></li>' for _ in range(rng.randint(1, 6))) + "</ul>"
        lines = lambda: "".join(f"<p>{line()}</p>" for _ in range(rng.randint(1, 3)))
        posts = lambda: "".join(rng.choice(["<div class='comment'><b>{0}</b><p>{1}</p></div>", "<li class='comment'>{0}: {1}</li>", "<article class='comment'><p>{1}</p></article>", "<div class='reply'><p>{1}</p><p>{0}</p></div>"]).format(word(), line(30)) for _ in range(rng.randint(1, 4)))
        for key, make in (("{links}", lambda: rng.choice([links, items])()), ("{items}", items), ("{lines}", lines), ("{posts}", posts), ("{line}", line), ("{word}", word)):
            while key in template:
                template = template.replace(key, make(), 1)
        return template

    def part(kinds: list[str], most: int) -> str:
        return "".join(fill(rng.choice(_AROUND[k])) for k in kinds if rng.random() < 0.6 for _ in range(rng.randint(1, most)))

    def body() -> str:
        out = rng.choice(["", f"<h1>{line(8)}</h1>", f"<h1>{line(8)}</h1>", f"<header><h1>{line(8)}</h1></header>"])
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            kind = rng.random()
            long = line(rng.choice([2, 20, 60]))
            if kind < 0.62:
                out += rng.choice([f"<p>{long}</p>", f"<p><b>{long}<br>", f"<p>{long}", f"<p>{word()} <a href='/x'>{word()}</a> {long}</p>", f"<p>{long}<br>{line()}</p>", f"<div>{long}</div>"])
            elif kind < 0.72:
                out += f"<h2>{line(6)}</h2>"
            elif kind < 0.82:
                out += "<ul>" + "".join(f"<li>{line()}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
            elif kind < 0.88:
                out += f"<blockquote>{long}</blockquote>"
            elif kind < 0.93:
                out += f"<pre>{long}</pre>"
            else:
                out += f"<table><tr><td>{word()}</td><td>{line(4)}</td></tr></table>"
        return out

    head = rng.choice(["", f"<head><title>{line(8)}</title><style>p{{margin:0}}</style></head>", f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{line(8)}</title></head>'])
    opening, closing = rng.choice(_MAIN)
    inner_junk = ["ad", "side", "form", "notice"] if rng.random() < 0.3 else []
    if rng.random() < 0.06:  # nothing but the text itself
        marked = _tagged(body(), chr(0xE000))
        return marked.replace(chr(0xE000), ""), [int(chr(0xE000) in b.text) for b in blocks(marked)]
    top = "<body>" + part(["notice", "header", "nav", "ad"], 1)
    first, second = body(), body() if rng.random() < 0.5 else ""
    middle = part(inner_junk, 1)
    last = part(["ad", "side", "form", "comments", "nav", "footer"], 1)
    wrap = rng.random() < 0.3
    before, after = ('<div class="page">' if wrap else "") + head + top, closing + last + ("</div>" if wrap else "") + "</body></html>"
    mark = chr(0xE000)
    marked = before + opening + _tagged(first, mark) + middle + _tagged(second, mark) + after
    if rng.random() < 0.1:
        marked = marked[: rng.randint(len(marked) // 2, len(marked))]
    labels = [1 if mark in b.text else 0 for b in blocks(marked)]
    return marked.replace(mark, ""), labels


def _tagged(markup: str, mark: str) -> str:
    """Each text of the markup with a mark in front."""
    return re.sub(r"(^|>)([^<]*[^<\s][^<]*)", lambda m: m.group(1) + mark + m.group(2), markup)


# -- the labeller ---------------------------------------------------------------------

PATH_SIZE, WORD_SIZE, HIDDEN, PLAIN = 12, 4, 12, 6


class Vectors:
    """Slots and plain figures of the blocks of pages, padded to one length."""

    def __init__(self, pages: list[list[Block]]):
        n, t = len(pages), max(map(len, pages), default=0)
        self.filled = np.zeros((n, t), np.float32)
        self.plain = np.zeros((n, t, PLAIN), np.float32)
        path, word = [], []
        for r, page in enumerate(pages):
            self.filled[r, : len(page)] = 1
            for c, b in enumerate(page):
                words = _WORD.findall(b.text.lower())
                size = len(b.text)
                self.plain[r, c] = (min(size, 2000) / 500, b.linked, sum(b.text.count(x) for x in ".!?") / max(size, 1) * 20, min(len(words), 20) / 20, c / len(page), 1 / (1 + c))
                at = r * t + c
                path += [(at, s, 1 / max(1, len(b.path))) for s in b.path]
                word += [(at, _word_slot(w), 1 / len(words)) for w in words]
        self.path = _sparse(path)
        self.word = _sparse(word)

    def embed(self, params: dict) -> np.ndarray:
        n, t = self.filled.shape
        x = np.zeros((n * t, PATH_SIZE + WORD_SIZE), np.float32)
        for (at, slot, weight), table, side in ((self.path, params["path"], slice(0, PATH_SIZE)), (self.word, params["word"], slice(PATH_SIZE, None))):
            if len(at):
                head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                x[at[head], side] = np.add.reduceat(table[slot] * weight[:, None], head, axis=0)
        return np.concatenate([x.reshape(n, t, PATH_SIZE + WORD_SIZE), self.plain], axis=2)


def _sparse(rows: list[tuple[int, int, float]]):
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    a, s, w = zip(*rows)
    return np.array(a, np.int64), np.array(s, np.int64), np.array(w, np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, filled: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool):
    """States after each block, from left to right; padded places keep the state."""
    n, t, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((n, t, HIDDEN), np.float32)
    tape = []
    drive = x @ w[: x.shape[2]] + b
    rest = w[x.shape[2] :]
    for k in range(t):
        z = drive[:, k] + h @ rest
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = filled[:, k : k + 1]
        c2 = f * c + i * g
        h2 = o * np.tanh(c2)
        if keep:
            tape.append((i, f, o, g, c, c2, h, m))
        c, h = c + m * (c2 - c), h + m * (h2 - h)
        out[:, k] = h
    return out, tape


def _lstm_back(x, w, tape, dout):
    """Gradients of the weights, bias and input of _lstm."""
    n, t, d = x.shape
    dw, db, dx = np.zeros_like(w), np.zeros(w.shape[1], np.float32), np.zeros_like(x)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for k in range(t - 1, -1, -1):
        i, f, o, g, c, c2, h, m = tape[k]
        dh = dh + dout[:, k]
        live, idle = dh * m, dh * (1 - m)
        tanh = np.tanh(c2)
        dc2 = live * o * (1 - tanh**2) + dc * m
        dz = np.concatenate([dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), live * tanh * o * (1 - o), dc2 * i * (1 - g**2)], axis=1)
        dw[:d] += x[:, k].T @ dz
        dw[d:] += h.T @ dz
        db += dz.sum(axis=0)
        dx[:, k] = dz @ w[:d].T
        dh = dz @ w[d:].T + idle
        dc = dc2 * f + dc * (1 - m)
    return dw, db, dx


class Labeller:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        wide = PATH_SIZE + WORD_SIZE + PLAIN
        draw = lambda *shape, s=0.2: (rng.standard_normal(shape) * s).astype(np.float32)
        self.params = {"path": draw(PATH_SLOTS, PATH_SIZE, s=0.5), "word": draw(WORD_SLOTS, WORD_SIZE, s=0.1), "out": draw(2 * HIDDEN + wide), "bias": np.zeros(1, np.float32)}
        for side in "lr":
            self.params |= {f"w{side}": draw(wide + HIDDEN, 4 * HIDDEN), f"b{side}": np.zeros(4 * HIDDEN, np.float32)}
            self.params[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1

    def forward(self, v: Vectors, keep: bool = False):
        p = self.params
        x = v.embed(p)
        left, tape_l = _lstm(x, v.filled, p["wl"], p["bl"], keep)
        right, tape_r = _lstm(x[:, ::-1], v.filled[:, ::-1], p["wr"], p["br"], keep)
        seen = np.concatenate([left, right[:, ::-1], x], axis=2)
        return _sigmoid(seen @ p["out"] + p["bias"]), (x, seen, tape_l, tape_r)

    def gradients(self, v: Vectors, y: np.ndarray) -> dict:
        p = self.params
        prob, (x, seen, tape_l, tape_r) = self.forward(v, True)
        dz = (prob - y) * v.filled / v.filled.sum()
        out = {"out": (seen * dz[..., None]).sum(axis=(0, 1)), "bias": dz.sum(keepdims=True).reshape(1)}
        dseen = dz[..., None] * p["out"]
        out["wl"], out["bl"], dx = _lstm_back(x, p["wl"], tape_l, dseen[..., :HIDDEN])
        out["wr"], out["br"], back = _lstm_back(x[:, ::-1], p["wr"], tape_r, dseen[:, ::-1, HIDDEN : 2 * HIDDEN])
        dx = (dx + back[:, ::-1] + dseen[..., 2 * HIDDEN :]).reshape(-1, x.shape[2])
        for (at, slot, weight), name, side in ((v.path, "path", slice(0, PATH_SIZE)), (v.word, "word", slice(PATH_SIZE, PATH_SIZE + WORD_SIZE))):
            out[name] = np.zeros_like(p[name])
            np.add.at(out[name], slot, dx[at, side] * weight[:, None])
        return out

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page is of the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted(range(len(pages)), key=lambda r: len(pages[r]))
        a = 0
        while a < len(order):  # pages of about one length together, at most 20,000 blocks
            b = a + 1
            while b < len(order) and b - a < 256 and len(pages[order[b]]) * (b - a + 1) <= 20_000 and len(pages[order[b]]) <= 1.3 * len(pages[order[a]]) + 4:
                b += 1
            some = order[a:b]
            prob, _ = self.forward(Vectors([pages[r] for r in some]))
            for k, r in enumerate(some):
                out[r] = prob[k, : len(pages[r])] > 0.5
            a = b
        return out


def train(pages: int = 1200, epochs: int = 4, seed: int = 11) -> Labeller:
    """A labeller fitted to generated pages."""
    rng = random.Random(seed)
    model = Labeller()
    data = []
    while len(data) < pages:
        page, labels = make_page(rng)
        found = blocks(page)
        if found and len(found) == len(labels):
            data.append((found, labels))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.params.items()}
    step = 0
    total = epochs * (len(data) // 32)
    for _ in range(epochs):
        rng.shuffle(data)
        for a in range(0, len(data) - 31, 32):
            part = sorted(data[a : a + 32], key=lambda x: len(x[0]))
            v = Vectors([b for b, _ in part])
            y = np.zeros(v.filled.shape, np.float32)
            for r, (_, labels) in enumerate(part):
                y[r, : len(labels)] = labels
            step += 1
            rate = 0.02 * (1 - step / (total + 1))
            for k, g in model.gradients(v, y).items():
                m, s = moments[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                model.params[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return model


@lru_cache(maxsize=1)
def trained() -> Labeller:
    return train()


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html)."""
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches):
        labeller = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                batch = whole.slice(a, 512)
                found = [blocks(x) for x in batch.column("html").to_pylist()]
                texts = ["\n".join(b.text for b, keep in zip(page, labels) if keep) for page, labels in zip(found, labeller.label(found))]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
