"""Main text of web pages: a bidirectional LSTM labels the sequence of a page's text blocks."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.llm.common import byte_balanced, lowest_hashes, slices

# HTML elements by what they do to the text around them.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
HIDDEN_TAGS = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas textarea select button title".split())
#: Of these, those whose content is no markup either, those that stand in for other content, and what never lies in the rest.
RAW_TAGS = frozenset("script style".split())
FALLBACK_TAGS = frozenset("noscript template iframe object canvas".split())
NEVER_HIDDEN = frozenset("body article main section header footer nav aside form table".split())
#: Elements that end an open one of the same kind.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

# Names of containers, by what they usually hold.
MAIN_NAMES = ("article", "main", "content", "post", "entry", "story", "body-text", "article-body", "post-content", "entry-content", "prose")
SIDE_NAMES = (
    "nav", "navigation", "menu", "navbar", "header", "masthead", "topbar", "footer", "colophon", "aside", "sidebar", "rail", "widget",
    "ad", "ads", "advert", "advertisement", "promo", "sponsored", "banner", "notice", "cookie", "consent", "gdpr", "popup", "modal",
    "comments", "comment", "comment-list", "replies", "discussion", "form", "search", "login", "newsletter", "subscribe", "share",
    "social", "related", "recommended", "breadcrumb", "pagination", "tags", "copyright", "legal", "toolbar", "skip",
)
SIDE_TAGS = ("nav", "header", "footer", "aside", "form")
MAIN_TAGS = ("article", "main")
#: A header inside the article, in paths.
OWN_HEADER = "own header"

_MAIN_TAGS = frozenset(MAIN_TAGS)
_MAIN_PARTS = _MAIN_TAGS | {f".{x}" for name in MAIN_NAMES for x in name.split("-")}
_SIDE_PARTS = frozenset(SIDE_TAGS) | {f".{x}" for name in SIDE_NAMES for x in name.split("-")} - {".list"}

#: Sizes of the hashed vectors, of the other features of a block, and of a direction's state.
PATH_DIM, WORD_DIM, OTHER_DIM, HIDDEN = 192, 32, 6, 16
INPUT = PATH_DIM + WORD_DIM + OTHER_DIM
#: Pages of the table that lend their texts to training, those with the lowest hash of the id; made pages; rounds over them.
SAMPLE_PAGES, MADE_PAGES, EPOCHS = 150, 450, 10
#: Blocks of a training page; longer pages are trained on in parts. Prediction always sees a whole page.
TRAIN_BLOCKS = 64
#: Padded blocks that a step of prediction holds.
STEP_BLOCKS = 1 << 15

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|[!?][^>]*>|(?=/?[a-zA-Z!?][^>]*\Z))")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    #: Characters inside links.
    linked: int


def blocks_of(page: str) -> list[Block]:
    """The texts between block-level tags in page order, with character references decoded and white space folded.

    Hidden elements, comments and markup are left out; a tag that the end of the page cuts off is no text. A script, style
    or comment that is never closed runs to the end of the page; any other hidden element that is left open ends where
    `_hidden_end` says. The names of `html` and `body` aren't kept, nor is what a container of the whole page says of it
    (`_without_page_wide`): they tell no block from another. A header inside the article is the article's own.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0
    path: tuple[str, ...] = ()
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(path, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    while at < size:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else size
        if stop > at:
            text = page[at:stop]
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if links:
                linked += len(text)
        if tag is None:
            break
        at = tag.end()
        name = tag.group(2)
        if name is None:
            if page.startswith("<!--", stop):
                end = page.find("-->", at)
                at = end + 3 if end >= 0 else size
            elif at == stop + 1 and not tag.group().endswith(">"):
                break
            continue
        name = name.lower()
        if name in HIDDEN_TAGS:
            if not tag.group(1) and not tag.group(3).endswith("/"):
                at = _hidden_end(page, name, at, {x for x, _ in stack})
            continue
        if name == "a":
            links = max(0, links - 1) if tag.group(1) else links + 1
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK_TAGS:
            flush()
            if tag.group(1):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                        break
            elif name not in VOID_TAGS:
                if name in SELF_CLOSING and stack and stack[-1][0] == name:
                    stack.pop()
                above = stack[-1][1] if stack else ()
                names = _names(tag.group(3)) if tag.group(3) and name not in ("html", "body") else ()
                own = OWN_HEADER if name == "header" and not _MAIN_TAGS.isdisjoint(above) else name
                stack.append((name, (*above, own, *names)))
            path = stack[-1][1] if stack else ()
    flush()
    return _without_page_wide(found)


def _hidden_end(page: str, name: str, at: int, around: set[str]) -> int:
    """Where the hidden element `name` ends whose content begins at `at`, inside elements of the names `around`.

    That is behind its closing tag. If the element that holds it ends first, or another one of its name or something that
    never lies in it begins, it was left open: then it ends before the first block in it, or where that happens.
    """
    if name in RAW_TAGS:
        end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
        return end.end() if end else len(page)
    never = {"body"} if name in FALLBACK_TAGS else NEVER_HIDDEN
    inside: list[str] = []
    first = None
    while tag := _TAG.search(page, at):
        start, at = tag.start(), tag.end()
        if tag.group(2) is None:
            if page.startswith("<!--", start):
                end = page.find("-->", at)
                at = end + 3 if end >= 0 else len(page)
            elif at == start:
                break
            continue
        other, closes = tag.group(2).lower(), bool(tag.group(1))
        if other == name:
            if closes:
                return at
            return start if first is None else first
        if closes:
            if other in inside:
                del inside[len(inside) - 1 - inside[::-1].index(other) :]
            elif other in around or other in ("body", "html", "head"):
                return start if first is None else first
        elif other in never:
            return start if first is None else first
        elif other in RAW_TAGS:
            at = _hidden_end(page, other, at, around)
        elif other in BLOCK_TAGS and other not in VOID_TAGS:
            inside.append(other)
            first = start if first is None else first
    return len(page) if first is None else first


def _without_page_wide(blocks: list[Block]) -> list[Block]:
    """The blocks without the side names of containers that all of them share, if the paths inside say what is what."""
    if not blocks:
        return blocks
    shared = len(commonprefix([b.path for b in blocks]))
    common = blocks[0].path[:shared]
    telling = [x for x in common if x in _SIDE_PARTS]
    if not telling or all(_SIDE_PARTS.isdisjoint(b.path[shared:]) and _MAIN_PARTS.isdisjoint(b.path[shared:]) for b in blocks):
        return blocks
    left = tuple(x for x in common if x not in _SIDE_PARTS)
    return [Block((*left, *b.path[shared:]), b.text, b.linked) for b in blocks]


def _names(attributes: str) -> tuple[str, ...]:
    """The parts of class, id and role names, marked so that they differ from tags."""
    values = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return tuple(f".{x}" for value in values for x in _PART.findall(value.lower()))


def features(blocks: list[Block], known: dict[tuple[str, ...], np.ndarray]) -> np.ndarray:
    """(blocks, INPUT): hashed tag path, hashed words, and lengths, links and punctuation of each block."""
    out = np.zeros((len(blocks), INPUT), np.float32)
    for row, block in zip(out, blocks, strict=True):
        vector = known.get(block.path)
        if vector is None:
            vector = np.zeros(PATH_DIM, np.float32)
            for token in block.path:
                vector[zlib.crc32(token.encode()) % PATH_DIM] = 1
            if len(known) < 10_000:
                known[block.path] = vector
        row[:PATH_DIM] = vector
        words = block.text.lower().split()
        hashed = np.bincount([zlib.crc32(w.encode()) % WORD_DIM for w in words], minlength=WORD_DIM)
        row[PATH_DIM : PATH_DIM + WORD_DIM] = hashed / len(words)
        chars = len(block.text)
        row[PATH_DIM + WORD_DIM :] = (
            np.log1p(len(words)) / 5,
            block.linked / chars,
            block.text[-1] in ".!?…:;\"'”»)",
            sum(map(block.text.count, ".,;!?")) / chars * 10,
            len(words) <= 4,
            min(1.0, len(block.path) / 16),
        )
    return out


@dataclass
class Labeller:
    """Weights by name: for each direction inputs, state and bias of the gates, and the output layer."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 0) -> Labeller:
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for d in "fb":
            w[f"{d}x"] = rng.normal(0, 0.1, (INPUT, 4 * HIDDEN))
            w[f"{d}h"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            w[f"{d}b"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        w["o"] = rng.normal(0, 0.2, 2 * HIDDEN)
        w["ob"] = np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(pages, blocks) of pages padded to one length."""
        states = [_run(self.weights, d, _turned(x, lengths, d))[0] for d in "fb"]
        both = np.concatenate([states[0], _turned(states[1], lengths, "b")], axis=2)
        return _sigmoid(both @ self.weights["o"] + self.weights["ob"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _turned(x: np.ndarray, lengths: np.ndarray, direction: str) -> np.ndarray:
    """Each page's blocks from last to first for the backward direction; padding stays behind."""
    if direction == "f":
        return x
    at = np.arange(x.shape[1])[None, :]
    index = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
    return np.take_along_axis(x, index[:, :, None], axis=1)


def _run(w: dict[str, np.ndarray], d: str, x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """States of one direction over all steps, and what the backward pass needs of each step."""
    pages, steps, _ = x.shape
    h = c = np.zeros((pages, HIDDEN), np.float32)
    given = x @ w[f"{d}x"] + w[f"{d}b"]
    states, kept = np.empty((pages, steps, HIDDEN), np.float32), []
    for t in range(steps):
        z = given[:, t] + h @ w[f"{d}h"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        kept.append((h, c, i, f, o, g))
        c = f * c + i * g
        h = o * np.tanh(c)
        states[:, t] = h
    return states, kept


def _back(w: dict[str, np.ndarray], d: str, x: np.ndarray, kept: list[tuple[np.ndarray, ...]], into: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one direction's weights, from those of its states."""
    dz_all = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
    dh_next = dc_next = np.zeros_like(kept[0][0])
    dwh = np.zeros_like(w[f"{d}h"])
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g = kept[t]
        tanh_c = np.tanh(f * c + i * g)
        dh = into[:, t] + dh_next
        dc = dh * o * (1 - tanh_c**2) + dc_next
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        dz_all[:, t] = dz
        dwh += h.T @ dz
        dh_next, dc_next = dz @ w[f"{d}h"].T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return {f"{d}x": x.reshape(-1, INPUT).T @ flat, f"{d}h": dwh, f"{d}b": flat.sum(axis=0)}


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 0) -> Labeller:
    """A labeller from (features, labels) of pages, by gradient descent through time with Adam."""
    model, rng = Labeller.fresh(seed), np.random.default_rng(seed)
    w = model.weights
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    cut = [(x[i : i + TRAIN_BLOCKS], y[i : i + TRAIN_BLOCKS]) for x, y in pages for i in range(0, len(y), TRAIN_BLOCKS)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(cut))
        order = sorted(order, key=lambda k: len(cut[k][1]))
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        for k in rng.permutation(len(batches)):
            batch = [cut[j] for j in batches[k]]
            lengths = np.array([len(y) for _, y in batch])
            x, y = np.zeros((len(batch), lengths.max(), INPUT), np.float32), np.zeros((len(batch), lengths.max()), np.float32)
            for row, (own, labels) in enumerate(batch):
                x[row, : len(labels)], y[row, : len(labels)] = own, labels
            real = (np.arange(x.shape[1])[None, :] < lengths[:, None]).astype(np.float32)
            turned = {d: _turned(x, lengths, d) for d in "fb"}
            runs = {d: _run(w, d, turned[d]) for d in "fb"}
            both = np.concatenate([runs["f"][0], _turned(runs["b"][0], lengths, "b")], axis=2)
            error = (_sigmoid(both @ w["o"] + w["ob"]) - y) * real / real.sum()
            grads = {"o": np.einsum("pt,pth->h", error, both), "ob": np.array([error.sum()])}
            into = error[:, :, None] * w["o"]
            grads |= _back(w, "f", turned["f"], runs["f"][1], into[:, :, :HIDDEN])
            grads |= _back(w, "b", turned["b"], runs["b"][1], _turned(into[:, :, HIDDEN:], lengths, "b"))
            step += 1
            for name, grad in grads.items():
                grad = np.clip(grad, -1, 1) + 1e-5 * w[name]
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad**2
                rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                w[name] = (w[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return model


def silver_labels(blocks: list[Block]) -> list[int]:
    """What a page says of its blocks: any side container decides, then a main one.

    Where neither is around a block, its length and links do, and on a page without a main container the next such block:
    a heading, or a short line between long ones, is what the text below it is.
    """
    named = [0 if not _SIDE_PARTS.isdisjoint(b.path) else 1 if not _MAIN_PARTS.isdisjoint(b.path) else None for b in blocks]
    labels = [int(len(b.text.split()) >= 10 and 2 * b.linked < len(b.text)) if x is None else x for b, x in zip(blocks, named, strict=True)]
    if 1 not in named:
        below = 0
        for i in range(len(blocks) - 1, -1, -1):
            if named[i] is None:
                if below and 2 * blocks[i].linked < len(blocks[i].text):
                    labels[i] = 1
                below = labels[i]
    return labels


def made_pages(texts: list[str], n: int = MADE_PAGES, seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Pages of random layout whose blocks have known labels, with sentences taken from `texts`."""
    rng = np.random.default_rng(seed)
    words = " ".join(texts).split() or [f"{a}{b}" for a in ("ta", "ri", "mo", "ne") for b in ("ka", "lo", "shi", "pe")]

    def some(low: int, high: int) -> str:
        k = int(rng.integers(low, high + 1))
        at = int(rng.integers(0, max(1, len(words) - k)))
        return " ".join(words[at : at + k])

    def pick(names: tuple[str, ...]) -> str:
        return names[int(rng.integers(len(names)))]

    def shell(names: tuple[str, ...], tags: tuple[str, ...]) -> tuple[str, ...]:
        if rng.random() < 0.4:
            return (pick(tags),)
        parts = tuple(f".{x}" for x in _PART.findall(pick(names)))
        return (pick(("div", "section", "ul", "div")), *parts)

    pages = []
    for _ in range(n):
        blocks: list[Block] = []
        labels: list[int] = []

        def side(outer: tuple[str, ...], blocks: list[Block] = blocks, labels: list[int] = labels) -> None:
            container = (*outer, *shell(SIDE_NAMES, SIDE_TAGS))
            kind = rng.random()
            for _ in range(int(rng.integers(1, 7))):
                if kind < 0.5:
                    text = some(1, 4)
                    path, linked = (*container, "ul", "li"), len(text)
                else:
                    # Notices, adverts and comments can read like the article.
                    text = some(3, 12) if kind < 0.75 else some(10, 60)
                    path, linked = (*container, "p") if rng.random() < 0.6 else container, 0
                blocks.append(Block(path, text, linked))
                labels.append(0)

        outer = ("html", "body") if rng.random() < 0.8 else ("html", "body", "div", f".{pick(('page', 'wrapper', 'container', 'site'))}")
        for _ in range(int(rng.integers(0, 4))):
            side(outer)
        # Some articles stand in no container of their own, or in one that says nothing.
        kind = rng.random()
        main = outer if kind < 0.12 else (*outer, "div") if kind < 0.25 else (*outer, *shell(MAIN_NAMES, MAIN_TAGS))
        if rng.random() < 0.7:
            own = (OWN_HEADER,) if not _MAIN_TAGS.isdisjoint(main) and rng.random() < 0.3 else ()
            blocks.append(Block((*main, *own, pick(("h1", "h1", "h2"))), some(3, 12), 0))
            labels.append(1)
            if own and rng.random() < 0.5:
                blocks.append(Block((*main, *own, "p"), some(2, 30), 0))
                labels.append(1)
        for _ in range(int(rng.integers(1, 12))):
            tag = pick(("p", "p", "p", "p", "p", "li", "blockquote", "h2", "pre", "td"))
            inner = (*main, "ul", "li") if tag == "li" else (*main, "table", "tr", "td") if tag == "td" else (*main, tag)
            if rng.random() < 0.1:
                inner = main
            blocks.append(Block(inner, some(1, 6) if tag == "h2" else some(1, 100), 0))
            labels.append(1)
            if rng.random() < 0.06:
                side(main)
        for _ in range(int(rng.integers(0, 4))):
            side(outer)
        pages.append((blocks, labels))
    return pages


def fit_labeller(pages: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE_PAGES) -> Labeller:
    """A labeller from made pages and from `sample` pages of the table, labelled by the names of their containers."""
    chosen = lowest_hashes(pages.where(F.col(html_col).isNotNull()).select(id_col, html_col), sample, id_col, html_col).select(html_col)
    parsed = [b for b in (blocks_of(row[0]) for row in chosen.collect()) if b]
    examples = [(b, silver_labels(b)) for b in parsed]
    examples += made_pages([x.text for b in parsed for x in b])
    known: dict[tuple[str, ...], np.ndarray] = {}
    return train([(features(b, known), np.array(y, np.float32)) for b, y in examples])


def main_texts(pages: list[str], model: Labeller, known: dict[tuple[str, ...], np.ndarray]) -> list[str]:
    """The main text of each page: the blocks labelled so, in page order, joined by an empty line."""
    parsed = [blocks_of(x) for x in pages]
    texts = [""] * len(pages)
    order = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
    while order:
        # Pages of like length together: as many as fit into a step, the longest of them last.
        n = 1
        while n < len(order) and (n + 1) * len(parsed[order[n]]) <= STEP_BLOCKS:
            n += 1
        group, order = order[:n], order[n:]
        lengths = np.array([len(parsed[i]) for i in group])
        x = np.zeros((n, lengths.max(), INPUT), np.float32)
        for row, i in enumerate(group):
            x[row, : lengths[row]] = features(parsed[i], known)
        probs = model.probabilities(x, lengths)
        for row, i in enumerate(group):
            texts[i] = "\n\n".join(b.text for b, p in zip(parsed[i], probs[row], strict=False) if p >= 0.5)
    return texts


def page_texts(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE_PAGES
) -> DataFrame:
    """(id, url, text, n_chars) for every row of `df`: the main text of its whole page.

    The labeller reads a page's blocks in both directions, so a block is judged by all others. It learns from made layouts and
    from at most `sample` pages, those with the lowest hash of the id. A null or empty page, or one without main
    text, gives an empty text. Repeated rows give repeated results, null ids and urls stay null, an empty table gives an empty
    result; other columns are not read. Nothing is shuffled.
    """
    model = df.sparkSession.sparkContext.broadcast(fit_labeller(df, id_col, html_col, sample))
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField(url_col, df.schema[url_col].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, ...], np.ndarray] = {}
        for batch in slices(batches):
            pages = [x or "" for x in batch.column(html_col).to_pylist()]
            texts: list[str] = []
            for low, high in byte_balanced(pages):
                texts += main_texts(pages[low:high], model.value, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column(url_col), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                schema.names,
            )

    return df.select(id_col, url_col, html_col).mapInArrow(run, schema)
