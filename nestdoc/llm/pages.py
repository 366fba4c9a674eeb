"""Main text of web pages by a recurrent block labeller.

A page is read into leaf blocks (runs of text between block tags) in page order, each with the
path of its ancestors' tags, classes, ids and roles, its words, and the share of it in links. A
bidirectional LSTM reads the page's sequence of blocks (path vector, hashed-word vector, a few
measures) and labels every block with what stands before and after it in view; blocks labelled
main text are joined.

The labeller is trained here: on `SAMPLE_PAGES` of the table (drawn by hash, up to `SAMPLE_BYTES`
each), labelled by what their ancestors are called, and on `MADE_PAGES` arrangements of their
blocks in other layouts (other containers, sidebars, notices, adverts, forms, comments, and
layouts whose containers have no telling names), so that it knows more than one table's layout.

Reading follows HTML where pages differ from well-formed markup: tags that close others, void
and raw-text elements, comments, unclosed tags at the end, references without a semicolon. White
space inside a block becomes one blank; a line break is white space.

Defined results: null and empty pages, and pages without main text, give an empty text; repeated
rows are each reported; an empty table gives an empty result; very long pages are read whole;
other columns are kept whatever they are called.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import free_name, quoted, table, widened
from nestdoc.llm._recurrent import F32, Adam, lstm, lstm_back, lstm_weights, sigmoid
from nestdoc.llm._words import chunks

SAMPLE_PAGES = 150
SAMPLE_BYTES = 200_000
MADE_PAGES = 500
EPOCHS = 10
CHUNK_BYTES = 2 << 20

PATHS, WORDS, WIDTH, HIDDEN, MEASURES = 2048, 2048, 12, 16, 6

# Names of HTML elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe title head".split())
#: Pictures, choices of a form and what only other readers see: skipped to their end tag; without
#: one they are read on like any element.
ASIDE = frozenset("svg select noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big canvas cite code data del dfn em font i ins kbd label mark math noscript object q s samp "
    "select small span strike strong sub sup svg template time tt u var br wbr img".split()
)
#: An opening tag closes an open element of these names, up to the element that holds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}

# Names that ancestors of training blocks are judged by.
MAIN_NAMES = frozenset("article main content post entry story body text blog page".split())
OTHER_NAMES = frozenset(
    "nav menu navigation navbar header masthead footer foot aside sidebar side rail widget ad ads advert "
    "advertisement sponsor sponsored promo banner cookie cookies consent notice alert popup modal overlay form "
    "search login signup newsletter subscribe comment comments reply replies respond discussion disqus share "
    "social related recommended breadcrumb breadcrumbs pagination pager toolbar copyright legal button skip".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.DOTALL
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    path: tuple[str, ...]  # ancestors' tags, and .name for each part of their classes, ids and roles
    text: str
    link: float  # share of characters inside links


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[tuple[str, bool]] = []
    path: tuple[str, ...] = ()
    links = 0

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(entities.unescape("".join(p for p, _ in parts)).split())
            if text:
                whole = sum(len(p) for p, _ in parts)
                out.append(Block(path, text, sum(len(p) for p, a in parts if a) / whole))
            parts = []

    def read(text: str) -> None:
        nonlocal path
        if text:
            if not any(not p.isspace() for p, _ in parts):
                path = tuple(name for _, names in stack for name in names)
            parts.append((text, links > 0))

    def close(k: int) -> None:
        nonlocal links
        if any(tag not in INLINE for tag, _ in stack[k:]):
            flush()
        links -= sum(tag == "a" for tag, _ in stack[k:])
        del stack[k:]

    at = 0
    for m in iter(lambda: _TAG.search(page, at), None):
        read(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        end = None
        if (tag in RAW or tag in ASIDE or tag == "math") and not m[3].endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
        if tag == "math" and end is not None:  # a formula is text of its block, whatever elements it has
            read(_TAG.sub(lambda t: "" if t[2] else t[0], page[at : end.start()]))
            at = end.end()
            continue
        if (tag in RAW or (tag in ASIDE and end is not None)) and not m[3].endswith("/"):
            flush()
            if end is not None:
                at = end.end()
            elif tag == "head":  # it ends where the body begins
                body = re.compile(r"<body\b", re.IGNORECASE).search(page, at)
                at = body.start() if body else len(page)
            else:
                at = len(page)
            continue
        if tag == "br":
            read(" ")
            continue
        if tag not in INLINE:
            flush()
            closed, within = CLOSES.get(tag, ({"p"}, set()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in within or (closed == {"p"} and stack[k][0] not in INLINE and stack[k][0] != "p"):
                    break
                if stack[k][0] in closed:
                    close(k)
                    break
        if tag not in VOID and not m[3].endswith("/"):
            names = [tag]
            for a in _ATTR.finditer(m[3]):
                names += [f".{part}" for part in _NAME.findall((a[2] or a[3] or a[4] or "").lower())]
            stack.append((tag, tuple(names)))
            links += tag == "a"
    read(page[at:])
    flush()
    return out


def by_names(b: Block) -> bool | None:
    """Whether the names of a block's ancestors call it main text; None if they say nothing."""
    names = [p.lstrip(".") for p in b.path]
    inside = "article" in names or "main" in names
    other = [n for n in names if n in OTHER_NAMES and not (n == "header" and inside and names[-1] in ("h1", "h2"))]
    if other:
        return False
    if inside or any(p[0] == "." and p[1:] in MAIN_NAMES for p in b.path):
        return True
    return None


# Layouts of made pages: containers of main text, of a page's parts, and of what stands among it.
_MAINS = ["article", "main", "div .content", "div .post", "section .story", "div .entry .content", "main .main article", "div .article .body", "div"]
_HEADS = ["header", "div .header", "div .masthead", "header .site", "div .banner"]
_NAVS = ["nav", "ul .menu", "div .nav", "nav .navigation", "div .breadcrumb", "div .navbar", "ul"]
_NOTICES = ["div .cookie .notice", "div .notice", "div .alert", "div .consent", "section .popup", "div .modal"]
_ADS = ["div .ad", "div .advert", "aside .promo", "div .sponsored", "ins .ads", "div .advertisement"]
_SIDES = ["aside", "div .sidebar", "div .side .rail", "section .widget", "div .related", "aside .recommended"]
_FORMS = ["form", "form .search", "div .newsletter form", "form .login", "div .subscribe"]
_TALK = ["section .comments", "div .comments div .comment", "ol .replies li .comment", "div .discussion", "div .comment .respond", "section .comments article .comment"]
_FEET = ["footer", "div .footer", "footer .site", "div .copyright", "div .legal", "div"]
_NOISE = ["div", "div .container", "div .wrapper", "div .row", "div .col", "div .page .wrap", "div .layout"]


def made_page(rng: np.random.Generator, long: list[str], short: list[str]) -> list[tuple[Block, bool]]:
    """Blocks of an invented layout, filled with texts of real ones."""

    def pick(options: list[str]) -> tuple[str, ...]:
        return tuple(str(rng.choice(options)).split())

    def some(pool: list[str]) -> str:
        return str(pool[rng.integers(len(pool))])

    top = ("html", "body", *(pick(_NOISE) if rng.random() < 0.5 else ()))
    out: list[tuple[Block, bool]] = []

    def add(path: tuple[str, ...], text: str, main: bool, link: float = 0.0) -> None:
        out.append((Block(path, text, link), main))

    def part(options: list[str], n: int, leaf: list[str], pool: list[str], link: float, at: tuple[str, ...] = top) -> None:
        where = (*at, *pick(options))
        for _ in range(n):
            tail = pick(leaf)
            add((*where, *tail), some(pool), False, link if "a" in tail else 0.0)

    if rng.random() < 0.5:
        part(_HEADS, int(rng.integers(1, 4)), ["p", "h1", "a", "span"], short, 1.0)
    if rng.random() < 0.8:
        part(_NAVS, int(rng.integers(2, 9)), ["li a", "a"], short, 1.0)
    if rng.random() < 0.35:
        part(_NOTICES, int(rng.integers(1, 3)), ["p", "span"], long + short, 0.0)
    if rng.random() < 0.35:
        part(_ADS, int(rng.integers(1, 3)), ["p", "", "a"], long + short, 1.0)
    container = pick(_MAINS)
    body = (*top, *container)
    if rng.random() < 0.85:
        add((*body, *(("header",) if container[0] == "article" and rng.random() < 0.2 else ()), "h1"), some(short), True)
    for _ in range(int(rng.integers(1, 14))):
        r = rng.random()
        if r < 0.08:
            part(_ADS, 1, ["p", "", "a"], long + short, 1.0, body)
        elif r < 0.12:
            part(_SIDES, int(rng.integers(1, 3)), ["p", "li a"], long + short, 1.0, body)
        elif r < 0.15:
            part(_FORMS, int(rng.integers(1, 3)), ["label", "p", "button"], short, 0.0, body)
        elif r < 0.2:
            add((*body, *pick(["h2", "h3"])), some(short), True)
        elif r < 0.27:
            for _ in range(int(rng.integers(2, 5))):
                add((*body, *pick(["ul li", "ol li", "table tr td"])), some(short + long), True)
        else:
            add((*body, *pick(["p", "p", "p", "p", "blockquote p", "section p", "div p", "p b", "pre"])), some(long if rng.random() < 0.8 else short), True, 0.2 * rng.random())
    if rng.random() < 0.4:
        where = (*(body if rng.random() < 0.3 else top), *pick(_TALK))
        for _ in range(int(rng.integers(1, 6))):
            add((*where, *pick(["p", "div p", "li"])), some(long if rng.random() < 0.7 else short), False)
    if rng.random() < 0.4:
        part(_SIDES, int(rng.integers(1, 6)), ["p", "li a", "h3"], long + short, 1.0)
    if rng.random() < 0.3:
        part(_FORMS, int(rng.integers(1, 4)), ["label", "p", "button"], short, 0.0)
    if rng.random() < 0.85:
        part(_FEET, int(rng.integers(1, 4)), ["p", "", "a", "small"], [f"© {s}" for s in short] + short, 1.0)
    return out


_IDS: dict[str, int] = {}


def _word_id(word: str) -> int:
    _IDS[word] = zlib.crc32(word.encode()) % WORDS
    return _IDS[word]


@lru_cache(100_000)
def _path_ids(path: tuple[str, ...]) -> list[int]:
    """Of a path's names, and of the last one apart."""
    leaf = [f"leaf {p}" for p in path[-1:]]
    return sorted({zlib.crc32(p.encode()) % PATHS for p in (*path, *leaf)})


def encode(page: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of path names and of words with the block that each is in, and the blocks' measures."""
    names, of_name, words, of_word = [], [], [], []
    if len(_IDS) > 200_000:
        _IDS.clear()
    measures = np.zeros((len(page), MEASURES), F32)
    for k, b in enumerate(page):
        ids = _path_ids(b.path)
        names += ids
        of_name += [k] * len(ids)
        w = _WORD.findall(b.text.lower())
        ids = [_IDS.get(x) or _word_id(x) for x in w]
        words += ids
        of_word += [k] * len(ids)
        n = len(b.text)
        marks = sum(b.text.count(c) for c in ".,;:!?")
        measures[k] = (np.log1p(n) / 6, min(len(w), 100) / 50, b.link, 20 * marks / n, "©" in b.text, (k + 1) / (len(page) + 1))
    return np.array(names, np.int64), np.array(of_name, np.int64), np.array(words, np.int64), np.array(of_word, np.int64), measures


def _bag(table_: np.ndarray, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Mean of the rows `ids` for each of n owners; `of` rises."""
    out = np.zeros((n, table_.shape[1]), F32)
    if len(ids):
        begin = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        counts = np.diff(np.append(begin, len(of)))
        out[of[begin]] = np.add.reduceat(table_[ids], begin, axis=0) / counts[:, None].astype(F32)
    return out


def together(pages: list[tuple]) -> tuple:
    """Encoded pages as one, blocks numbered through."""
    sizes = [len(p[4]) for p in pages]
    first = np.cumsum([0, *sizes[:-1]])
    return (
        np.concatenate([p[0] for p in pages]), np.concatenate([p[1] + f for p, f in zip(pages, first, strict=True)]),
        np.concatenate([p[2] for p in pages]), np.concatenate([p[3] + f for p, f in zip(pages, first, strict=True)]),
        np.concatenate([p[4] for p in pages]),
    )


class Labeller:
    """Bidirectional LSTM over the blocks of a page."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        width = 2 * WIDTH + MEASURES
        self.w = {
            "path": rng.normal(0, 0.3, (PATHS, WIDTH)).astype(F32),
            "word": rng.normal(0, 0.1, (WORDS, WIDTH)).astype(F32),
            **{f"f{k}": v for k, v in lstm_weights(rng, width, HIDDEN).items()},
            **{f"r{k}": v for k, v in lstm_weights(rng, width, HIDDEN).items()},
            "o": rng.normal(0, 0.2, 2 * HIDDEN + width).astype(F32),
            "ob": np.zeros(1, F32),
        }

    def _layer(self, side: str) -> dict[str, np.ndarray]:
        return {k: self.w[side + k] for k in "xhb"}

    def _inputs(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        sizes = np.array([len(p[4]) for p in pages])
        names, of_name, words, of_word, measures = together(pages)
        n = len(measures)
        page = np.repeat(np.arange(len(pages)), sizes)
        step = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x = np.zeros((sizes.max(), len(pages), 2 * WIDTH + MEASURES), F32)
        x[step, page, :WIDTH] = _bag(self.w["path"], names, of_name, n) * 3
        x[step, page, WIDTH : 2 * WIDTH] = _bag(self.w["word"], words, of_word, n)
        x[step, page, 2 * WIDTH :] = measures
        mask = np.arange(sizes.max())[:, None] < sizes[None, :]
        return x, mask, sizes

    def _forward(self, x: np.ndarray, mask: np.ndarray) -> tuple:
        f, saved_f = lstm(self._layer("f"), x, mask, False)
        r, saved_r = lstm(self._layer("r"), x, mask, True)
        top = np.concatenate((f, r, x), axis=2)
        return top, top @ self.w["o"] + self.w["ob"][0], saved_f, saved_r

    def scores(self, pages: list[tuple]) -> list[np.ndarray]:
        """Probability of main text for every block of each encoded page."""
        out: list[np.ndarray] = [np.zeros(0, F32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k][4])), key=lambda k: len(pages[k][4]))
        at = 0
        while at < len(order):  # pages of like length together, of 20000 blocks or one page
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(pages[order[to]][4]) <= 20_000:
                to += 1
            part = [pages[k] for k in order[at:to]]
            x, mask, sizes = self._inputs(part)
            _, z, _, _ = self._forward(x, mask)
            for j, k in enumerate(order[at:to]):
                out[k] = sigmoid(z[: sizes[j], j])
            at = to
        return out

    def train(self, pages: list[tuple], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 1) -> None:
        """labels: 1 main text, 0 other, -1 not known."""
        rng = np.random.default_rng(seed)
        adam = Adam(self.w, 0.01)
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), 32):
                batch = [k for k in order[at : at + 32] if len(labels[k])]
                if not batch:
                    continue
                part = [pages[k] for k in batch]
                # Now and then a page hides its names, so that words and order must do.
                part = [(p[0][:0], p[1][:0], *p[2:]) if rng.random() < 0.1 else p for p in part]
                x, mask, sizes = self._inputs(part)
                top, z, saved_f, saved_r = self._forward(x, mask)
                y = np.full(z.shape, -1.0, F32)
                for j, k in enumerate(batch):
                    y[: sizes[j], j] = labels[k]
                known = y >= 0
                dz = np.where(known, sigmoid(z) - y, 0).astype(F32) / F32(max(1, known.sum()))
                grads = {"o": np.einsum("tb,tbk->k", dz, top), "ob": dz.sum(keepdims=True).reshape(1)}
                dtop = dz[:, :, None] * self.w["o"]
                df, dxf = lstm_back(self._layer("f"), saved_f, dtop[:, :, :HIDDEN])
                dr, dxr = lstm_back(self._layer("r"), saved_r, dtop[:, :, HIDDEN : 2 * HIDDEN])
                grads |= {f"f{k}": v for k, v in df.items()} | {f"r{k}": v for k, v in dr.items()}
                dx = (dxf + dxr + dtop[:, :, 2 * HIDDEN :]).transpose(1, 0, 2)[mask.T]  # by block
                names, of_name, words, of_word, _ = together(part)
                for name, ids, of, cut, scale in (
                    ("path", names, of_name, slice(0, WIDTH), 3),
                    ("word", words, of_word, slice(WIDTH, 2 * WIDTH), 1),
                ):
                    grads[name] = np.zeros_like(self.w[name])
                    share = (scale / np.maximum(np.bincount(of, minlength=len(dx)), 1)).astype(F32)
                    np.add.at(grads[name], ids, dx[of, cut] * share[of, None])
                adam.step(grads)


def fit(pages: list[str], seed: int = 0) -> Labeller:
    """Labeller trained on pages and on layouts made from their blocks."""
    rng = np.random.default_rng(seed)
    read = [blocks(p) for p in pages]
    truth = [[by_names(b) for b in p] for p in read]
    long = [b.text for p, y in zip(read, truth, strict=True) for b, main in zip(p, y, strict=True) if main and len(b.text) > 60]
    short = [b.text for p in read for b in p if len(b.text) <= 60]
    long, short = long or ["One sentence of a text, and one more."], short or ["A title"]
    data = [(encode(p), np.array([-1 if v is None else int(v) for v in y], F32)) for p, y in zip(read, truth, strict=True)]
    for _ in range(MADE_PAGES):
        made = made_page(rng, long, short)
        data.append((encode([b for b, _ in made]), np.array([y for _, y in made], F32)))
    model = Labeller(seed)
    model.train([d for d, _ in data], [y for _, y in data])
    return model


def train(pages: DataFrame, html: str = "html", seed: int = 0) -> Labeller:
    """Labeller of a bounded sample of the pages."""
    h = quoted(html)
    some = pages.where(h.isNotNull()).select(F.substring(h, 1, SAMPLE_BYTES).alias("html"), F.xxhash64(h, F.lit(seed)).alias("u"))
    # The pages of the smallest hashes, each once; only some more than are wanted leave the tasks.
    n = pages.where(h.isNotNull()).count()
    for share in (4 * SAMPLE_PAGES / max(n, 1), 64 * SAMPLE_PAGES / max(n, 1), 1.0):
        near = some if share >= 1 else some.where(F.col("u") < F.lit(int(-(1 << 63) + share * (1 << 64))))
        rows = near.groupBy("u").agg(F.min("html").alias("html")).orderBy("u").limit(SAMPLE_PAGES).collect()
        if len(rows) == SAMPLE_PAGES or share >= 1:
            return fit([r["html"] for r in rows], seed)


def extract(pages: DataFrame, model: Labeller, html: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text in a column `out` in place of the html."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for part in chunks(batches, f"c{at}", CHUNK_BYTES):
            found = [blocks(h or "") for h in part.column(at).to_pylist()]
            scores = shared.value.scores([encode(p) for p in found])
            texts = ["\n".join(b.text for b, s in zip(p, y, strict=True) if s >= 0.5) for p, y in zip(found, scores, strict=True)]
            yield part, [pa.array(texts, pa.string())]

    rest = [quoted(c) for c in pages.columns if c != html]
    # The html goes first, under a name that no other column's new name can meet.
    whole = pages.select(quoted(html).alias("html"), F.struct(F.lit(0).alias("_"), *rest).alias("rest"))
    done = widened(whole, "html", [("main_text", T.StringType())], read)
    name = free_name(pages.select(*rest), out)
    return done.select(*[F.col("rest")[c].alias(c) for c in pages.columns if c != html], F.col("main_text").alias(name))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))
