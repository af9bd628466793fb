"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A page is cut into leaf blocks (runs of text between block-level tags, each with its open ancestors).
Features name ancestor tags, what ancestors' class and id words hint at, and the shape of the text
(length, share of link text, sentence ends). The field has two labels, article and rest, and is trained
by maximum likelihood (forward-backward, Adam) on labelled pages. The table has no labels, so training
pages are made: block texts of SAMPLE pages are laid out anew in LAYOUTS, under names that the hint words
know or under made-up ones, and each block's label is the part of the page it was put in - never what a
tag or hint says. Viterbi decodes every page.

Training sees a bounded sample only (SAMPLE pages, TEXTS of their blocks, both parameters); every page is
parsed whole, in place, in the task that reads it: nothing is shuffled. An open element carries what its
ancestors say, so parsing takes time and memory in proportion to the page however deep it nests.

Defined results: null or empty html, or a page without article blocks, gives the empty text; broken
markup is read leniently (unclosed elements end with their parent, a stray ``<`` is text); repeated
rows are each extracted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import store, table

SAMPLE, TEXTS = 200, 4000

#: Elements by how they are read.
RAW = set("script style noscript template svg math iframe object canvas audio video select textarea head title".split())
BLOCK = set(
    "html body main article section aside nav header footer address div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption table caption thead tbody tfoot tr td th form fieldset legend details summary hr center hgroup dialog menu search".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag ends an open element of these, up to the nearest element that may hold it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ENDS_P = BLOCK - {"html", "body"}
#: Words of class and id attributes, and of tags, by what they hint at.
HINTS = {
    "article": "article articles post entry story content main maincontent body text prose markdown blog news page".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager skip links topbar".split(),
    "header": "header masthead top branding logo site-header".split(),
    "footer": "footer bottom copyright colophon legal imprint credits".split(),
    "side": "aside sidebar side rail widget widgets related recommended recommendations trending popular more tags".split(),
    "advert": "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion dfp adsense".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup paywall toast warning".split(),
    "form": "form search login register input contact".split(),
    "comment": "comment comments reply replies respond discussion disqus reader thread feedback".split(),
    "share": "share sharing social follow byline meta author date buttons toolbar tools".split(),
}
HINT_OF = {word: hint for hint, words in HINTS.items() for word in words}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^>"']++|"[^"]*"|'[^']*')*+>|</?[a-zA-Z][^>]*>""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_DIGIT = re.compile(r"[0-9]")


_TAGS = "article main section aside nav header footer form table ul ol figure blockquote pre li p h1 h2 h3 h4 h5 h6 td dd dt figcaption address dialog".split()
_SHAPES = [f"words{k}" for k in range(5)] + [f"link{k}" for k in range(4)] + "sentence copyright many_digits first last bias inner_rest inner_article no_hint".split()
FEATURES = {name: k for k, name in enumerate([f"in_{t}" for t in _TAGS] + [f"own_{t}" for t in _TAGS] + [f"hint_{h}" for h in HINTS] + _SHAPES)}
REST_TAGS = {"nav", "header", "footer", "aside", "form", "dialog"}


@dataclass
class Block:
    """A leaf block: its text, link characters, own tag, and what its ancestors say (a bit for each feature)."""

    text: str
    link_chars: int
    tag: str
    said: int


@dataclass
class Open:
    """An open element and what it and its ancestors say; the innermost that says anything decides article or rest."""

    tag: str
    said: int


_INNER = (1 << FEATURES["inner_rest"]) | (1 << FEATURES["inner_article"]) | (1 << FEATURES["no_hint"])
_NOTHING = 1 << FEATURES["bias"] | 1 << FEATURES["no_hint"]


def opened(tag: str, words: set[str], above: int) -> Open:
    hints = {HINT_OF[w] for w in words if w in HINT_OF}
    said = above
    for name in [f"in_{tag}"] * (tag in _TAGS) + [f"hint_{h}" for h in hints]:
        said |= 1 << FEATURES[name]
    rest = tag in REST_TAGS or hints - {"article"}
    if rest or tag in ("article", "main") or hints:
        said = said & ~_INNER | 1 << FEATURES["inner_rest" if rest else "inner_article"]
    return Open(tag, said)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order."""
    out: list[Block] = []
    stack: list[Open] = []
    n_open: Counter[str] = Counter()
    endless: set[str] = set()
    texts: list[str] = []
    links, in_link, at, last = 0, 0, 0, page.rfind(">") + 1  # no tag ends after the last >

    def flush():
        nonlocal links
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                out.append(Block(text, min(links, len(text)), stack[-1].tag if stack else "html", stack[-1].said if stack else _NOTHING))
            texts.clear()
        links = 0

    def add(raw: str):
        nonlocal links
        text = html.unescape(raw)
        texts.append(text)
        if in_link:
            links += len(text.strip())

    def close(down_to: int):
        while len(stack) > down_to:
            n_open[stack.pop().tag] -= 1

    while (m := _TOKEN.search(page, at, last)) is not None:
        if m.start() > at:
            add(page[at : m.start()])
        at, tag = m.end(), m[0]
        if tag[1] in "!?":
            if tag.startswith("<!--") and not tag.endswith("-->"):
                at = len(page)
            continue
        name = _NAME.match(tag)[1].lower()
        closing = tag[1] == "/"
        if name in RAW and not closing:
            if tag.endswith("/>") or name in endless:
                end = None
            elif name == "head":  # ends with its end tag or where the body begins
                end = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
            else:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if end is None and not tag.endswith("/>"):
                endless.add(name)
            if name in ("svg", "math", "object", "audio", "video", "canvas", "iframe", "select", "head") and end is None:
                continue  # without an end they hide nothing
            if not tag.endswith("/>"):
                at = end.end() if end else len(page)
            texts.append(" ")
        elif name == "br":
            texts.append(" ")
        elif name == "a":
            in_link = 0 if closing else 1
        elif name in BLOCK or "-" in name:
            flush()
            in_link = 0
            if closing:
                if n_open[name]:
                    close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == name))
            elif name not in VOID:
                if name in ENDS_P and stack and stack[-1].tag == "p":
                    close(len(stack) - 1)
                ends = CLOSES.get(name)
                if ends and any(n_open[e] for e in ends):
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k].tag in ends:
                            close(k)
                            break
                        if stack[k].tag in ("ul", "ol", "dl", "table"):
                            break
                words = {w for a in _ATTR.finditer(tag) for w in _WORD.findall((a[1] or a[2] or a[3] or "").lower())}
                stack.append(opened(name, words, stack[-1].said if stack else _NOTHING))
                n_open[name] += 1
    rest = page[at:].partition("<!--")[0]
    if rest:
        add(rest)
    flush()
    return out


@functools.lru_cache(maxsize=10_000)
def path_features(tag: str, said: int) -> list[int]:
    own = [FEATURES[f"own_{tag}"]] if tag in _TAGS else []
    return own + [k for k in range(said.bit_length()) if said >> k & 1]


def features(block: Block, place: int, total: int) -> list[int]:
    row = list(path_features(block.tag, block.said))
    words = block.text.count(" ") + 1
    row.append(FEATURES["words0"] + (words > 2) + (words > 6) + (words > 15) + (words > 40))
    share = block.link_chars / len(block.text)
    row.append(FEATURES["link0"] + (share > 0) + (share > 0.3) + (share > 0.8))
    if block.text[-1] in ".!?:;\"')»”…":
        row.append(FEATURES["sentence"])
    if "©" in block.text:
        row.append(FEATURES["copyright"])
    if len(_DIGIT.findall(block.text[:200])) > 20:
        row.append(FEATURES["many_digits"])
    if place == 0:
        row.append(FEATURES["first"])
    if place == total - 1:
        row.append(FEATURES["last"])
    return row


def page_features(found: list[Block]) -> list[list[int]]:
    return [features(b, k, len(found)) for k, b in enumerate(found)]


@dataclass
class Field:
    """Score of label 1 (article) for each feature, and of each step from label to label."""

    weights: np.ndarray
    steps: np.ndarray

    def viterbi(self, rows: list[list[int]]) -> list[int]:
        w, ((aa, ab), (ba, bb)) = self.weights, self.steps.tolist()
        rest, art, back = 0.0, 0.0, []
        for k, row in enumerate(rows):
            e = float(w[row].sum())
            if k:
                from_rest, from_art = rest + aa >= art + ba, rest + ab > art + bb
                rest, art = (rest + aa if from_rest else art + ba), (rest + ab if from_art else art + bb) + e
                back.append((not from_rest, not from_art))
            else:
                art = e
        label = art > rest
        out = [int(label)]
        for to_rest, to_art in reversed(back):
            label = to_art if label else to_rest
            out.append(int(label))
        return out[::-1] if rows else []


def fit(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 80, l2: float = 0.02) -> Field:
    """Maximum likelihood with all pages side by side, padded to the longest."""
    pages = [p for p in pages if p[0]]
    n, longest = len(pages), max((len(p[0]) for p in pages), default=0)
    field = Field(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    if not n:
        return field
    x = np.zeros((n, longest, len(FEATURES)), np.float32)
    y, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (rows, labels) in enumerate(pages):
        for k, row in enumerate(rows):
            x[i, k, row] = 1
        y[i, : len(labels)], mask[i, : len(labels)] = labels, True
    flat, y_flat = x[mask], y[mask]
    params = np.zeros(len(FEATURES) + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    pairs = mask[:, 1:]
    seen = np.array([[np.sum(pairs & (y[:, :-1] == a) & (y[:, 1:] == b)) for b in (0, 1)] for a in (0, 1)])
    total = mask.sum()
    for t in range(1, rounds + 1):
        w, steps = params[:-4], params[-4:].reshape(2, 2)
        e = np.zeros((n, longest, 2))
        e[..., 1][mask] = flat @ w
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for k in range(1, longest):
            alpha[:, k] = np.logaddexp(alpha[:, k - 1, :1] + steps[0], alpha[:, k - 1, 1:] + steps[1]) + e[:, k]
        for k in range(longest - 2, -1, -1):
            nxt = (e[:, k + 1] + beta[:, k + 1])[:, None, :] + steps
            beta[:, k] = np.where(mask[:, k + 1, None], np.logaddexp(nxt[..., 0], nxt[..., 1]), 0.0)
        both = alpha + beta
        z = np.logaddexp(both[..., 0], both[..., 1])[:, :1]
        p = np.exp(both[..., 1] - z)
        gradient = np.zeros_like(params)
        gradient[:-4] = flat.T @ (y_flat - p[mask])
        joint = np.exp(alpha[:, :-1, :, None] + steps + (e + beta)[:, 1:, None, :] - z[..., None, None])
        gradient[-4:] = (seen - (joint * pairs[..., None, None]).sum((0, 1))).ravel()
        gradient = gradient / total - l2 / 100 * params
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        params += 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Field(params[:-4], params[-4:].reshape(2, 2))


#: How the elements of the training pages are wrapped: articles, and each kind of the rest.
LAYOUTS = {
    "article": ["article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="story"', 'div class="entry-content"', 'div class="article-text"', "main|article", "main|div", 'div class="page"|article', 'div id="content"|div'],
    "menu": ["nav|ul", 'div class="menu"|ul', 'ul class="nav-links"', 'div id="navbar"', 'ol class="breadcrumbs"', "header|nav|ul"],
    "header": ["header", 'div class="header"', 'div id="masthead"', 'div class="site-header"'],
    "footer": ["footer", 'div class="footer"', 'div id="bottom"', 'p class="copyright"'],
    "side": ["aside", 'div class="sidebar"', 'div class="widget related"', 'section class="recommended"'],
    "advert": ['div class="ad"', 'div class="advert"', 'aside class="sponsored"', 'div class="promo banner"', 'p class="ad"'],
    "notice": ['div class="cookie-notice"', 'div id="consent"', 'div class="newsletter signup"', 'div role="alert"', 'div class="notice"', 'p class="notice"'],
    "form": ["form", 'form class="search"', 'div class="login"|form'],
    "comment": ['section class="comments"', 'div id="comments"', 'ol class="comment-list"|li', 'div class="reader-comments"'],
    "share": ['div class="share"', 'p class="byline"', 'div class="social"'],
}


def wrapped(spec: str, inner: str) -> str:
    parts = spec.split("|")
    return "".join(f"<{p}>" for p in parts) + inner + "".join(f"</{p.split()[0]}>" for p in reversed(parts))


def laid_out(rng: random.Random, long: list[str], short: list[str], layouts: dict[str, list[str]] = LAYOUTS, made_up: float = 0.15) -> tuple[str, list[int]]:
    """A page in a random layout and the label of each of its blocks; a share of the names is made up and hints at nothing."""
    parts: list[tuple[str, list[int]]] = []

    def spec_of(kind: str) -> str:
        spec = rng.choice(layouts[kind])
        if rng.random() < made_up:
            spec = re.sub(r'"[^"]*"', lambda _: f'"x{rng.randrange(10**6)}"', spec)
        return spec

    def rest(kind: str) -> tuple[str, list[int]]:
        spec = spec_of(kind)
        if kind == "menu":
            n = rng.randint(2, 7)
            items = [f'<a href="#">{rng.choice(short)}</a>' for _ in range(n)]
            return wrapped(spec, "".join(f"<li>{a}</li>" for a in items) if "ul" in spec or "ol" in spec else "".join(f"<p>{a}</p>" for a in items)), [0] * n
        text = rng.choice(long if rng.random() < (0.8 if kind in ("comment", "advert") else 0.4) else short)
        n = 1 if spec.startswith("p ") else rng.randint(1, 3)
        return wrapped(spec, f"&copy; {text}" * (kind == "footer") + "".join(f"<p>{rng.choice([text, *short, *long])}</p>" for _ in range(n)) if not spec.startswith("p ") else text), [0] * (n + (kind == "footer") * (not spec.startswith("p ")))

    often = rng.choice((0.0, 0.3, 0.6))
    for kind in ("notice", "header", "menu", "advert", "side"):
        if rng.random() < often:
            parts.append(rest(kind))
    body, labels = (f"<h1>{rng.choice(long)}</h1>", [1]) if rng.random() < 0.7 else ("", [])
    if rng.random() < 0.3:
        extra, marks = rest("share")
        body, labels = body + extra, labels + marks
    for _ in range(rng.randint(1, 8)):
        roll = rng.random()
        inner = rng.choice(long) if rng.random() < 0.8 else rng.choice(short)
        if roll < 0.75:
            body, labels = body + f"<p>{inner}</p>", [*labels, 1]
        elif roll < 0.82:
            body, labels = body + f"<ul><li>{inner}</li><li>{rng.choice(short)}</li></ul>", [*labels, 1, 1]
        elif roll < 0.9:
            body, labels = body + rng.choice(["<h2>{}</h2>", "<blockquote>{}</blockquote>", "<h3>{}</h3>", "<pre>{}</pre>"]).format(inner), [*labels, 1]
        else:
            extra, marks = rest(rng.choice(["advert", "side", "share", "notice", "comment", "form"]))
            body, labels = body + extra, labels + marks
    parts.append((wrapped(spec_of("article"), body), labels))
    often = rng.choice((0.0, 0.3, 0.6))
    for kind in ("comment", "side", "form", "share", "advert", "footer"):
        if rng.random() < often:
            parts.append(rest(kind))
    return f"<html><body>{''.join(p for p, _ in parts)}</body></html>", [x for _, marks in parts for x in marks]


def train(texts: list[str], layouts: int = 500) -> Field:
    """The field for block texts of the table, laid out anew ``layouts`` times."""
    rng = random.Random(7)
    long = [html.escape(t, False) for t in texts if t.count(" ") > 5]
    short = [html.escape(t, False) for t in texts if t.count(" ") <= 5]
    labelled = []
    if long and short:
        for _ in range(layouts):
            page, labels = laid_out(rng, long, short)
            found = blocks(page)
            if len(found) == len(labels):
                labelled.append((page_features(found), labels))
    return fit(labelled)


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, label in zip(found, field.viterbi(page_features(found)), strict=True) if label)


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for page in batch.column("html").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([b.text for b in blocks(page or "")], pa.string())], ["text"])


def first_by_hash(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of ``df`` that come first by a hash of the whole row; thinned to about twice as many before they are sorted."""
    mark = F.shiftrightunsigned(F.xxhash64(*df.columns, F.lit(23)), 1)
    return df.withColumn("mark", mark).where(F.col("mark") / float(1 << 63) <= (2.0 * n + 100) / max(1, df.count())).orderBy("mark", *df.columns).limit(n).drop("mark")


def sample_texts(pages: DataFrame, sample: int = SAMPLE, texts: int = TEXTS) -> list[str]:
    """At most ``texts`` block texts of ``sample`` pages."""
    drawn = first_by_hash(pages.select("page_id", "url", "html"), sample).select("html").mapInArrow(_block_texts, "text string").distinct()
    return [r.text for r in first_by_hash(store(drawn, "block-texts"), texts).collect()]


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text of every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [main_text(h or "", shared.value) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = pages.select("page_id", "url").schema.add("text", "string")
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def op2_block_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract(pages, train(sample_texts(pages)))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op2_block_crf": op2_block_crf}
ORACLE: dict[str, str] = {}
