"""Main text of web pages: a bidirectional LSTM labels every block in its page's context.

A page is a sequence of leaf blocks. Each is described by its path of tags, by the names in
class and id along it, by hashed words and by a few proportions. The network, in numpy, reads
the sequence in both directions and says of every block whether it is main text. It is
trained once per driver, from a fixed seed, on made page layouts of many kinds; its weights
are some tens of kilobytes and go to the tasks with the function.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfsight.llm.staging import small_batches

#: Pages and rounds of training, and units of either direction.
LAYOUTS, ROUNDS, UNITS = 700, 14, 16

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
#: Elements that begin and end a block, that hold no text to read, and that have no end tag.
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu"
    " nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
RAW = frozenset("script style noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}

_TAGS, _LEAF, _WORDS_OF_NAMES, _WORDS, _NUMBERS = 64, 32, 96, 32, 10
WIDTH = _TAGS + _LEAF + _WORDS_OF_NAMES + _WORDS + _NUMBERS


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    linked: int


def leaf_blocks(page: str) -> list[Block]:
    """The texts between block elements in page order, white space folded, references decoded.

    Text of hidden elements (by their own ``hidden`` or ``display: none``) is left out up to
    where they end, be it by the end tag of an element around them.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    parts: list[str] = []
    linked, at = 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            names = tuple(n for _, own, _ in stack for n in own)
            out.append(Block(text, tuple(t for t, _, _ in stack), names, linked))
        parts.clear()
        linked = 0

    def pop_to(names: set[str], barrier: frozenset[str] | set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in barrier:
                return

    while True:
        found = _TOKEN.search(page, at)
        raw = page[at : found.start() if found else len(page)]
        if raw and not any(hidden for _, _, hidden in stack):
            text = html.unescape(raw)
            parts.append(text)
            if any(t == "a" for t, _, _ in stack):
                linked += len(text)
        if not found:
            break
        at = found.end()
        end, tag, attributes = (
            found.group(1, 2, 3) if found.group(2) is not None else found.group(4, 5, 6)
        )
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            if tag in BLOCKS:
                close()
            if tag not in VOID:
                pop_to({tag}, set() if tag in BLOCKS else BLOCKS)
            if tag in ("br", "p"):
                parts.append(" ")
            continue
        if tag in RAW:
            if tag in BLOCKS:
                close()
            if not attributes.endswith("/"):
                at = _after(page, at, tag)
            continue
        if tag in BLOCKS:
            close()
            if any(t == "p" for t, _, _ in stack):
                pop_to({"p"}, BLOCKS - {"p"})
            if tag in _CLOSES:
                pop_to(_CLOSES[tag], {"ul", "ol", "dl", "table", "select", "tbody", "thead"} - {tag})
        if tag == "br":
            parts.append(" ")
        if tag not in VOID and not attributes.endswith("/"):
            own = _attributes(attributes)
            names = " ".join(own.get(name, "") for name in own if name in ("class", "id", "role"))
            hidden = "hidden" in own or bool(_NOT_SHOWN.search(own.get("style", "")))
            stack.append((tag, tuple(re.findall(r"[a-z]+", _camel(names))[:12]), hidden))
    close()
    return out


def _attributes(tag: str) -> dict[str, str]:
    """By name in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(tag):
        out.setdefault(name.lower(), "".join(values))
    return out


def _camel(names: str) -> str:
    return re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()


@cache
def _tag_pattern(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)


def _after(page: str, at: int, tag: str) -> int:
    """Behind the end of an element whose content is not read; nested ones of its name count."""
    depth, nests = 1, tag not in ("script", "style", "noscript", "iframe")
    for found in _tag_pattern(tag).finditer(page, at):
        depth += -1 if found.group(1) else nests
        if depth == 0:
            return found.end()
    return len(page)


@cache
def _slot(text: str, width: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % width


def describe(blocks: list[Block]) -> np.ndarray:
    """One row of WIDTH numbers per block."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    for i, block in enumerate(blocks):
        row = out[i]
        for tag in block.path:
            row[_slot("t" + tag[:12], _TAGS)] = 1
        row[_TAGS + _slot("l" + (block.path[-1] if block.path else "")[:12], _LEAF)] = 1
        for name in block.names:
            row[_TAGS + _LEAF + _slot("n" + name[:16], _WORDS_OF_NAMES)] = 1
        words = block.text.split()
        base = _TAGS + _LEAF + _WORDS_OF_NAMES
        for word in words:
            row[base + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % _WORDS] += 1
        row[base : base + _WORDS] /= np.sqrt(1 + len(words))
        n = len(block.text)
        row[base + _WORDS :] = (
            np.log1p(len(words)) / 4, np.log1p(n) / 6, block.linked / (n + 1), len(block.path) / 10,
            block.text.count(".") / (len(words) + 1), block.text.count("|") / (len(words) + 1),
            sum(map(str.isdigit, block.text)) / n, i / len(blocks),
            float(block.text[-1] in ".!?"), 1.0,
        )
    return out


class Network:
    """A bidirectional LSTM with one logistic output per step."""

    def __init__(self, rng: np.random.Generator, width: int = WIDTH, units: int = UNITS):
        scale = 1 / np.sqrt(width)
        self.weights = {
            f"{d}{k}": v.astype(np.float32)
            for d in "fb"
            for k, v in {
                "x": rng.normal(0, scale, (width, 4 * units)),
                "h": rng.normal(0, 1 / np.sqrt(units), (units, 4 * units)),
                "c": np.concatenate([np.zeros(units), np.ones(units), np.zeros(2 * units)]),
            }.items()
        }
        self.weights["o"] = rng.normal(0, 0.3, 2 * units).astype(np.float32)
        self.weights["ob"] = np.zeros(1, np.float32)
        self.units = units

    def _direction(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """x: steps x pages x width. Steps outside a page leave the state as it is."""
        w, n = self.weights, self.units
        steps, pages, _ = x.shape
        inputs = x @ w[d + "x"] + w[d + "c"]
        h = np.zeros((pages, n), np.float32)
        c = np.zeros((pages, n), np.float32)
        out, tape = np.zeros((steps, pages, n), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = inputs[t] + h @ w[d + "h"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * n], -30, 30)))
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            g = np.tanh(z[:, 3 * n :])
            m = mask[t][:, None]
            c_new = f * c + i * g
            squashed = np.tanh(c_new)
            if keep:
                tape.append((t, h, c, i, f, o, g, squashed, m))
            h = m * (o * squashed) + (1 - m) * h
            c = m * c_new + (1 - m) * c
            out[t] = h
        return out, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, tape_f = self._direction("f", x, mask, keep)
        b, tape_b = self._direction("b", x, mask, keep)
        both = np.concatenate([f, b], 2)
        z = both @ self.weights["o"] + self.weights["ob"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), both, {"f": tape_f, "b": tape_b}

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        p, both, tapes = self.forward(x, mask, keep=True)
        error = (p - y) * mask / mask.sum()
        n, w = self.units, self.weights
        out = {k: np.zeros_like(v) for k, v in w.items()}
        out["o"], out["ob"] = np.einsum("tp,tpk->k", error, both), error.sum(keepdims=True)[0]
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            dh = np.zeros((x.shape[1], n), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, squashed, m in reversed(tapes[d]):
                dh = dh + error[t][:, None] * w["o"][part]
                inner = dh * m
                dc_new = dc * m + inner * o * (1 - squashed**2)
                dz = np.concatenate(
                    [dc_new * g * i * (1 - i), dc_new * c * f * (1 - f),
                     inner * squashed * o * (1 - o), dc_new * i * (1 - g**2)], 1,
                )
                out[d + "x"] += x[t].T @ dz
                out[d + "h"] += h.T @ dz
                out[d + "c"] += dz.sum(0)
                dh = dh * (1 - m) + dz @ w[d + "h"].T
                dc = dc * (1 - m) + dc_new * f
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for i, page in enumerate(pages):
        x[: len(page), i] = page
        mask[: len(page), i] = 1
    return x, mask


# Layouts to train on -----------------------------------------------------------------------

_MAIN, _REST = chr(0xE000), chr(0xE001)
_WRAPPERS = (
    ("<article>", "</article>"), ("<main>", "</main>"), ("<article class='post'>", "</article>"),
    ("<main id='content'><article>", "</article></main>"), ("<div id='content'>", "</div>"),
    ("<div class='article-body'>", "</div>"), ("<section class='entry-content'>", "</section>"),
    ("<div class='post story'>", "</div>"), ("<div class='main-text'>", "</div>"), ("<article>", "</article>"),
)
_BOXES = {
    "menu": (("<nav>", "</nav>"), ("<div class='menu'>", "</div>"), ("<ul class='nav navbar'>", "</ul>"), ("<nav class='breadcrumb'>", "</nav>"), ("<div id='navigation' role='navigation'>", "</div>")),
    "header": (("<header>", "</header>"), ("<div class='header'>", "</div>"), ("<div id='masthead' role='banner'>", "</div>"), ("<header class='site-header'>", "</header>")),
    "footer": (("<footer>", "</footer>"), ("<div class='footer'>", "</div>"), ("<div id='site-footer' role='contentinfo'>", "</div>")),
    "side": (("<aside>", "</aside>"), ("<div class='sidebar'>", "</div>"), ("<aside class='related'>", "</aside>"), ("<div id='sidebar' role='complementary'>", "</div>"), ("<div class='widget popular'>", "</div>")),
    "notice": (("<div class='notice'>", "</div>"), ("<div class='cookie-banner'>", "</div>"), ("<div id='consent' role='dialog'>", "</div>"), ("<div class='alert newsletter'>", "</div>"), ("<div class='cookie-notice'>", "</div>")),
    "advert": (("<div class='ad'>", "</div>"), ("<div class='advert'>", "</div>"), ("<div class='ads sponsored'>", "</div>"), ("<aside class='promo'>", "</aside>"), ("<div id='banner' class='advertisement'>", "</div>")),
    "form": (("<form>", "</form>"), ("<form class='search'>", "</form>"), ("<form class='subscribe'>", "</form>"), ("<div class='login'><form>", "</form></div>")),
    "comments": (("<section class='comments'>", "</section>"), ("<div id='comments'>", "</div>"), ("<ol class='comment-list'>", "</ol>"), ("<div class='comment replies'>", "</div>")),
    "share": (("<div class='share social'>", "</div>"), ("<ul class='tags'>", "</ul>"), ("<div class='byline author meta'>", "</div>")),
}


def made_page(rng: np.random.Generator) -> str:
    """A random layout; every text begins with the sign of its label."""
    syllables = ["".join(rng.choice(list("bcdfghklmnprstvwz"))) + str(rng.choice(list("aeiouäéó"))) for _ in range(40)]

    def words(low: int, high: int) -> str:
        made = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(rng.integers(low, high))]
        style = rng.integers(8)
        if style == 0:
            made = [w + str(rng.choice(["###", "%%%", "&amp;&amp;", "***"])) for w in made]
        elif style == 1:
            made = [w.upper() + "!!" for w in made]
        elif style == 2:
            made = [f"{w} |" for w in made]
        return " ".join(made).capitalize() + str(rng.choice([".", ".", "", "!"]))

    def rest(tag: str, low: int, high: int, link: bool = False) -> str:
        text = _REST + words(low, high)
        inner = f"<a href='/x'>{text}</a>" if link else text
        return f"<{tag}>{inner}</{tag}>" if tag else inner

    def box(kind: str) -> str:
        begin, end = _BOXES[kind][rng.integers(len(_BOXES[kind]))]
        many = int(rng.integers(1, 7))
        if kind == "menu" or (kind in ("side", "footer") and rng.random() < 0.5):
            inner = "<ul>" + "".join(rest("li", 1, 4, True) for _ in range(many)) + "</ul>"
        elif kind == "form":
            inner = "".join(rest(str(rng.choice(["label", "button", "option", "p"])), 1, 8) for _ in range(many))
        elif kind == "comments":
            tag = "li" if begin.startswith("<ol") else str(rng.choice(["p", "div"]))
            inner = "".join(rest(tag, 1, 60) for _ in range(many))
        elif kind == "header":
            inner = rest(str(rng.choice(["h1", "div", "p"])), 1, 6) + (box("menu") if rng.random() < 0.3 else "")
        else:
            inner = "".join(rest(str(rng.choice(["p", "div", "", "h3"])), 1, 40, rng.random() < 0.2) for _ in range(min(many, 3)))
        return begin + inner + end

    def paragraph() -> str:
        text = _MAIN + words(1, int(rng.choice([3, 20, 80])))
        roll = rng.random()
        if roll < 0.1:
            return f"<h2>{text}</h2>"
        if roll < 0.18:
            return "<ul>" + "".join(f"<li>{_MAIN}{words(1, 15)}</li>" for _ in range(3)) + "</ul>"
        if roll < 0.24:
            return f"<blockquote><p>{text}</p></blockquote>"
        if roll < 0.3:
            return f"<p>{text[:-1]} <a href='/y'>{words(1, 3)}</a> {words(1, 9)}</p>"
        if roll < 0.34:
            return f"<pre>{text}</pre>"
        if roll < 0.38:
            return f"<table><tr><td>{text}</td><td>{_MAIN}{words(1, 4)}</td></tr></table>"
        return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")

    begin, end = _WRAPPERS[rng.integers(len(_WRAPPERS))]
    body = [f"<h1>{_MAIN}{words(1, 12)}</h1>"] if rng.random() < 0.9 else []
    if rng.random() < 0.4:
        body.append(f"<p><b>{_MAIN}{words(3, 40)}<br>")
    for _ in range(int(rng.choice([1, 2, 4, 8, 16]))):
        body.append(paragraph())
        if rng.random() < 0.08:
            body.append(box(str(rng.choice(["advert", "side", "form", "share", "notice"]))))
    if rng.random() < 0.12:
        body.append(box("comments"))
    before = [box(k) for k in ("notice", "header", "menu", "advert") if rng.random() < 0.5]
    after = [box(k) for k in ("comments", "side", "share", "advert", "form", "notice", "footer") if rng.random() < 0.4]
    if rng.random() < 0.3:
        before.append(box("side"))
    rng.shuffle(before)
    return (
        f"<html><head><title>{_REST}{words(2, 9)}</title></head><body>" + "".join(before)
        + begin + "".join(body) + end + "".join(after) + "</body></html>"
    )


def labelled(page: str) -> tuple[np.ndarray, np.ndarray]:
    blocks = leaf_blocks(page)
    labels = np.array([_MAIN in b.text for b in blocks], np.float32)
    for block in blocks:
        block.text = block.text.replace(_MAIN, "").replace(_REST, "") or "x"
    return describe(blocks), labels


@cache
def trained(layouts: int = LAYOUTS, rounds: int = ROUNDS, seed: int = 3) -> Network:
    """The network after Adam on made layouts; the same for the same seed."""
    rng = np.random.default_rng(seed)
    pages = [labelled(made_page(rng)) for _ in range(layouts)]
    pages.sort(key=lambda p: len(p[1]))
    groups = [pages[i : i + 20] for i in range(0, len(pages), 20)]
    batches = []
    for group in groups:
        x, mask = padded([p for p, _ in group])
        y = np.zeros_like(mask)
        for i, (_, labels) in enumerate(group):
            y[: len(labels), i] = labels
        batches.append((x, y, mask))
    network = Network(rng)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for turn in range(rounds):
        rate = 0.02 * (1 - turn / rounds) + 0.001
        for i in rng.permutation(len(batches)):
            step += 1
            for k, g in network.gradients(*batches[i]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                network.weights[k] -= (
                    rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                )
    return network


# Extraction --------------------------------------------------------------------------------


def label_pages(pages: list[list[Block]], network: Network) -> list[np.ndarray]:
    """For every page which blocks are main text. Pages of like length go through together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and high - low < 256 and (high - low + 1) * len(pages[order[high]]) <= 8192:
            high += 1
        group = order[low:high]
        x, mask = padded([describe(pages[i]) for i in group])
        p, _, _ = network.forward(x, mask)
        for j, i in enumerate(group):
            out[i] = p[: len(pages[i]), j] >= 0.5
        low = high
    return out


def _extract(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 500):
            part = batch.slice(low, 500)
            pages = [leaf_blocks(h or "") for h in part.column("html").to_pylist()]
            texts = [
                "\n\n".join(b.text for b, main in zip(blocks, marks, strict=True) if main)
                for blocks, marks in zip(pages, label_pages(pages, network), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(p) for p in pages], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars", "n_blocks"],
            )


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (main blocks joined by two line ends), n_chars, n_blocks.

    Character references are decoded, white space inside a block becomes one space, blocks
    are trimmed and those without text left out. Null and empty html, and pages without main
    text, give an empty text. Ids and urls, null or not, are passed on; repeated rows come
    out as often; an empty table gives an empty table; further columns are not read.
    """
    small_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(
        partial(_extract, network=trained()),
        f"page_id {id_type}, url string, text string, n_chars long, n_blocks long",
    )
