"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: the text between block-level tags, with the path of
tags, classes and ids above it. A bidirectional LSTM in numpy reads the whole sequence
of blocks (hashed tag path, hashed words, length) and labels every block as article or
not; the article's blocks make the text.

Training happens on the driver over a bounded sample: ``sample_pages`` pages of at most
``sample_bytes`` bytes each, those with the smallest hash of their id. There are no
labels, so pages are built from the sample's own blocks in many random layouts (where
every block's label is known), and the sampled pages themselves are added wherever an
``article`` or ``main`` element tells what their text is. Labelling is one narrow pass
over every whole page.

The content of script and style runs to their own end tag and is no text; that of a
textarea or svg is a block, that of math part of its sentence; noscript, template, iframe
and object are elements like others, and the labeller judges their text.

Cases: null or empty html, or html without text, gives an empty text; tags left open
end with the page or where HTML ends them; a br is white space; character references
are decoded, then white space is made one space; repeated rows give equal results;
other columns are not read unless carried.
"""
from __future__ import annotations

import html as html_lib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from streakflow.llm.common import by_bytes, map_arrow, text_of, texts

#: Elements of HTML by what they do to the text around them (fixed values).
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
                   "sub sup time tt u var wbr br img acronym".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
#: Elements whose content runs to their own end tag: code, the text of a field, a drawing, a formula.
NO_TEXT = frozenset("script style".split())
RAW = NO_TEXT | {"textarea", "svg", "math"}

PATH_DIMS, WORD_DIMS = 128, 24
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>"
    # a quote counts at the start of a value only; one that nothing closes is part of an unquoted value
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))?+)*+)>", re.DOTALL)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW}
_MARKS = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(path, text) of every leaf block with text, in page order. A path is
    ``tag.class`` steps joined by ``/``."""
    out, stack, names, held, at = [], [], [], [], 0

    def flush() -> None:
        text = "".join(held)
        held.clear()
        if "&" in text:
            text = html_lib.unescape(text)
        text = " ".join(text.split())
        if text:
            out.append(("/".join(stack), text))

    endless = set()  # raw elements that no end tag closes any more
    found = _TAG.search(page)
    while found:
        name = found[2].lower() if found[2] else None
        held.append(page[at:found.start()])
        at = found.end()
        if name in RAW and not found[1]:
            held.append(" ")
            end = None if found[3].endswith("/") or name in endless else _END[name].search(page, at)
            if end:
                inner = page[at:end.start()]
                if name == "math":  # part of its sentence
                    held.append(_TAG.sub("", inner) + " ")
                elif name not in NO_TEXT:
                    text = " ".join(t for _, t in blocks_of(inner)) if name == "svg" else " ".join(html_lib.unescape(inner).split())
                    if text:
                        flush()
                        out.append(("/".join([*stack, name]), text))
                at = end.end()
            elif not found[3].endswith("/"):
                endless.add(name)
                at = len(page) if name in NO_TEXT else at
        found, tag = _TAG.search(page, at), found
        if name is None or name in RAW:
            continue
        if name in INLINE:
            held.append(" " if name == "br" else "")
            if name == "a" and not tag[1]:
                held.append("")
            continue
        flush()
        if tag[1]:
            if name in names:
                while names.pop() != name:
                    stack.pop()
                stack.pop()
            continue
        closes = "p" if name in CLOSES_P else name if name in ("li", "option", "tr", "td", "th", "dt", "dd") else None
        if closes in names and (closes == "p" or not {"ul", "ol", "table", "dl", "select"} & set(names[len(names) - names[::-1].index(closes):])):
            while names.pop() != closes:
                stack.pop()
            stack.pop()
        if name not in VOID and not tag[3].endswith("/"):
            marks = [m.strip("\"'") for m in _MARKS.findall(tag[3])] if tag[3] else []
            names.append(name)
            stack.append(".".join([name, *re.findall("[a-z0-9]+", " ".join(marks).lower())]))
    held.append(page[at:])
    flush()
    return out


def path_vector(path: str) -> np.ndarray:
    vector = np.zeros(PATH_DIMS, np.float32)
    steps = path.split("/")
    for step in steps:
        tag, *marks = step.split(".")
        for token in (tag, *("." + m for m in marks)):
            h = zlib.crc32(token.encode())
            vector[h % PATH_DIMS] += 1.0 if h >> 31 else -1.0
    last = zlib.crc32(b"^" + steps[-1].split(".")[0].encode())
    vector[last % PATH_DIMS] += 1.0 if last >> 31 else -1.0
    return np.clip(vector, -2, 2)


class Features:
    """Blocks to input vectors; paths and words are hashed once each."""

    def __init__(self):
        self.paths: dict[str, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def __call__(self, blocks: list[tuple[str, str]]) -> np.ndarray:
        if len(self.words) > 500_000:
            self.words.clear()
        if len(self.paths) > 100_000:
            self.paths.clear()
        out = np.zeros((len(blocks), PATH_DIMS + WORD_DIMS + 3), np.float32)
        seen, flat, counts = self.words, [], []
        for i, (path, text) in enumerate(blocks):
            if path not in self.paths:
                self.paths[path] = path_vector(path)
            out[i, :PATH_DIMS] = self.paths[path]
            own = text.lower().split()
            for w in own:
                if w not in seen:
                    seen[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_DIMS
            flat += map(seen.__getitem__, own)
            counts.append(len(own))
            out[i, -2] = text[-1:] in ".!?"
            out[i, -1] = "©" in text
        sizes = np.array(counts)
        where = np.repeat(np.arange(len(blocks)), sizes) * WORD_DIMS + np.array(flat, np.int64)
        bag = np.bincount(where, minlength=len(blocks) * WORD_DIMS).reshape(len(blocks), WORD_DIMS)
        out[:, PATH_DIMS:PATH_DIMS + WORD_DIMS] = bag / np.maximum(sizes, 1)[:, None]
        out[:, -3] = np.log1p(sizes) / 4
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BiLstm:
    """Two LSTMs, one per direction, and a logistic output over both states."""

    params: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(inputs: int, hidden: int, rng: np.random.Generator) -> "BiLstm":
        p = {}
        for d in "fb":
            p[f"wx{d}"] = rng.standard_normal((inputs, 4 * hidden)) * 0.15
            p[f"wh{d}"] = rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)
            p[f"b{d}"] = np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]
        p["out"], p["bias"] = rng.standard_normal(2 * hidden) * 0.3, np.zeros(1)
        return BiLstm({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, real: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction; x is (time, pages, inputs), real masks padding."""
        hidden = self.params[f"wh{d}"].shape[0]
        drive = x @ self.params[f"wx{d}"] + self.params[f"b{d}"]
        h = c = np.zeros((x.shape[1], hidden), np.float32)
        states = np.zeros((*x.shape[:2], hidden), np.float32)
        for t in (range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)):
            z = drive[t] + h @ self.params[f"wh{d}"]
            gates = _sigmoid(z[:, :3 * hidden])
            i, f, o, g = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:], np.tanh(z[:, 3 * hidden:])
            m = real[t][:, None]
            before = (h, c)
            c_new = f * c + i * g
            tanh_c = np.tanh(c_new)
            c = np.where(m, c_new, c)
            h = np.where(m, o * tanh_c, h)
            states[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, tanh_c, before, m))
        return states

    def logits(self, x: np.ndarray, real: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, real, d, None) for d in "fb"], 2)
        return both @ self.params["out"] + self.params["bias"]

    def gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept = {"f": [], "b": []}
        both = np.concatenate([self._run(x, real, d, kept[d]) for d in "fb"], 2)
        slope = np.where(real, _sigmoid(both @ self.params["out"] + self.params["bias"]) - y, 0) / max(1, real.sum())
        grads = {"out": np.einsum("tn,tnh->h", slope, both), "bias": np.array([slope.sum()], np.float32)}
        hidden = both.shape[2] // 2
        for k, d in enumerate("fb"):
            wh = self.params[f"wh{d}"]
            dz_all = np.zeros((*x.shape[:2], 4 * hidden), np.float32)
            gwh = np.zeros_like(wh)
            dh = dc = np.zeros((x.shape[1], hidden), np.float32)
            for t, i, f, o, g, tanh_c, (h0, c0), m in reversed(kept[d]):
                dh = dh + slope[t][:, None] * self.params["out"][k * hidden:(k + 1) * hidden]
                dcn = dc + dh * o * (1 - tanh_c ** 2)
                dz = np.where(m, np.concatenate([dcn * g * i * (1 - i), dcn * c0 * f * (1 - f), dh * tanh_c * o * (1 - o),
                                                 dcn * i * (1 - g ** 2)], 1), 0)
                dz_all[t] = dz
                gwh += h0.T @ dz
                dh = np.where(m, dz @ wh.T, dh)
                dc = np.where(m, dcn * f, dc)
            grads[f"wh{d}"], grads[f"b{d}"] = gwh, dz_all.sum((0, 1))
            grads[f"wx{d}"] = np.einsum("tni,tnj->ij", x, dz_all, optimize=True)
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    real = np.zeros((longest, len(pages)), bool)
    for n, page in enumerate(pages):
        x[:len(page), n], real[:len(page), n] = page, True
    return x, real


def _by_cells(pages: list, cells: int) -> list[list]:
    """The pages of a step in parts whose padded blocks stay bounded; their gradients add up."""
    if len(pages) * max(len(label) for _, label in pages) <= cells:
        return [pages]
    parts, order = [], sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
    while order:
        width = max(1, cells // len(pages[order[-1]][1]))
        parts.append([pages[i] for i in order[-width:]])
        order = order[:-width]
    return parts


def train(pages: list[tuple[np.ndarray, np.ndarray]], hidden: int = 16, epochs: int = 10, rate: float = 0.01,
          batch: int = 32, seed: int = 5, cells: int = 12_000) -> BiLstm:
    rng = np.random.default_rng(seed)
    model = BiLstm.fresh(pages[0][0].shape[1] if pages else PATH_DIMS + WORD_DIMS + 3, hidden, rng)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.params.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(pages))
        for start in range(0, len(order), batch):
            some = [pages[i] for i in order[start:start + batch]]
            grads, total = {}, sum(len(label) for _, label in some)
            for few in _by_cells(some, cells):
                x, real = _padded([p for p, _ in few])
                y = np.zeros(real.shape, np.float32)
                for n, (_, label) in enumerate(few):
                    y[:len(label), n] = label
                for k, g in model.gradients(x, real, y).items():
                    grads[k] = grads.get(k, 0) + g * np.float32(real.sum() / max(1, total))
            step += 1
            now = rate * (1 - epoch / epochs) + 1e-4
            for k, g in grads.items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.params[k] -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


#: Class and id words of page parts, for the training layouts (fixed values).
ARTICLE_MARKS = "article post content entry story main body text page single".split()
OTHER_MARKS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toc topbar", "header": "header masthead site branding logo top",
    "footer": "footer bottom copyright legal colophon", "aside": "sidebar aside related widget side recommended trending",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner adsense", "notice": "cookie consent notice gdpr popup modal alert banner",
    "form": "form search login signup newsletter subscribe contact", "comments": "comment comments reply replies disqus discussion respond",
    "share": "share social follow tags meta pagination pager byline"}
OTHER_MARKS = {k: v.split() for k, v in OTHER_MARKS.items()}
_TAGS_OF = {"nav": ["nav", "div", "ul", "section"], "header": ["header", "div"], "footer": ["footer", "div"],
            "aside": ["aside", "div", "section"], "ad": ["div", "aside", "section", "ins"], "notice": ["div", "section", "aside"],
            "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}


def layout_page(paragraphs: list[str], scraps: list[str], rng: np.random.Generator) -> tuple[list[tuple[str, str]], list[int]]:
    """Blocks and labels of one page in a random layout."""
    pick = lambda items: items[int(rng.integers(len(items)))]
    blocks, labels = [("html/head/title", pick(scraps))], [0]
    outer = "html/body" + pick(["", "", "/div.wrapper", "/div.page", "/div.container/div.row"])

    def other(kind: str, above: str) -> None:
        marked = rng.random() < 0.8
        tag = pick(_TAGS_OF[kind]) if marked else _TAGS_OF[kind][0]
        if tag in ("div", "section", "ul", "ol", "ins") or rng.random() < 0.4:
            step = f"{tag}.{pick(OTHER_MARKS[kind])}"
        else:
            step = tag
        inner = {"nav": ["ul/li"], "footer": ["", "p", "ul/li"], "form": ["label", "p", "", "button"], "comments": ["li/p", "p", "div.comment/p", "div"],
                 "header": ["", "p", "h1", "h2"], "aside": ["ul/li", "p", "h3", "div"]}.get(kind, ["", "p"])
        child = pick(inner)
        for _ in range(int(rng.integers(1, 9)) if kind in ("nav", "aside", "comments", "footer") else int(rng.integers(1, 3))):
            long = kind in ("comments", "ad", "notice") and rng.random() < 0.6
            blocks.append((f"{above}/{step}" + (f"/{child}" if child else ""), pick(paragraphs if long else scraps)))
            labels.append(0)

    for kind in ("notice", "header", "nav", "nav", "ad", "form"):
        if rng.random() < 0.5:
            other(kind, outer)
    tag = pick(["article", "article", "article", "main", "div", "div", "section"])
    body = tag if tag in ("article", "main") and rng.random() < 0.6 else f"{tag}.{pick(ARTICLE_MARKS)}"
    above = outer + pick(["", "", "/main", "/div.content"]) + "/" + body
    blocks.append((above + pick(["/h1", "/header/h1", "/h2"]), pick(scraps)))
    labels.append(1)
    for _ in range(int(rng.integers(1, 14))):
        if rng.random() < 0.06:
            other(pick(["ad", "share", "form", "aside"]), above)
        blocks.append((above + pick(["/p"] * 8 + ["/ul/li", "/blockquote/p", "/h2", "/pre"]), pick(paragraphs)))
        labels.append(1)
    if rng.random() < 0.2:
        other("comments", above)
    for kind in ("share", "comments", "ad", "aside", "form", "nav", "notice", "footer"):
        if rng.random() < (0.8 if kind == "footer" else 0.35):
            other(kind, outer)
    return blocks, labels


def taught_label(path: str) -> int:
    """Label by the page's own article or main element, for sampled pages."""
    steps = [s.split(".") for s in path.split("/")]
    bad = {"nav", "header", "footer", "aside", "form", "figcaption", "button", "noscript", "template", "iframe", "textarea", "svg"} | {m for marks in OTHER_MARKS.values() for m in marks}
    inside = [i for i, s in enumerate(steps) if s[0] in ("article", "main")]
    return int(bool(inside) and not any(s[0] in bad - {"header"} or bad & set(s[1:]) for s in steps[inside[0]:]))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = 150,
        sample_bytes: int = 1 << 16, built_pages: int = 500) -> BiLstm:
    """The labeller, from a bounded sample of pages and pages built from it."""
    source = text_of(html_col)
    rows = (pages.where(F.octet_length(source) <= sample_bytes).select(F.xxhash64(id_col).alias("h"), source.alias("html"))
            .orderBy("h", "html").limit(sample_pages).collect())
    own = [blocks for blocks in (blocks_of(r.html) for r in rows) if blocks]
    every = [text for blocks in own for _, text in blocks]
    paragraphs = [t for t in every if len(t.split()) > 5] or ["one two three four five six seven."]
    scraps = [t for t in every if len(t.split()) <= 8] + [t[:40] for t in paragraphs[:50]]
    rng, features, training = np.random.default_rng(11), Features(), []
    for _ in range(built_pages):
        blocks, labels = layout_page(paragraphs, scraps, rng)
        training.append((features(blocks), np.array(labels, np.float32)))
    for blocks in own:
        if any(taught_label(path) for path, _ in blocks):
            training.append((features(blocks), np.array([taught_label(path) for path, _ in blocks], np.float32)))
    return train(training)


def label_pages(model: BiLstm, features: Features, pages: list[list[tuple[str, str]]], cells: int = 30_000) -> list[np.ndarray]:
    """For every page, which blocks are article text. Pages of like length share a run."""
    out = [np.zeros(0, bool) for _ in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while order:
        width = max(1, cells // len(pages[order[-1]]))
        some, order = order[-width:], order[:-width]
        x, real = _padded([features(pages[i]) for i in some])
        logits = model.logits(x, real)
        for n, i in enumerate(some):
            out[i] = logits[:len(pages[i]), n] > 0
    return out


def main_text(pages: DataFrame, model: BiLstm, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url"),
              out: str = "text") -> DataFrame:
    """``carry`` columns plus ``out``: the article's blocks, one a line."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([pages.schema[c] for c in carry] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for part in by_bytes(batch, len(carry), 8 << 20):
                own = [blocks_of(page) for page in texts(part.column(len(carry)))]
                kept = label_pages(shared.value, features, own)
                found = ["\n".join(text for (_, text), good in zip(blocks, marks) if good) for blocks, marks in zip(own, kept)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carry)], pa.array(found, pa.string())], names=[*carry, out])

    return map_arrow(pages.select(*carry, text_of(html_col).alias("__html")), run, schema)
