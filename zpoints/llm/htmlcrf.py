"""Main-text extraction: a linear-chain conditional random field over a page's leaf blocks.

A page is cut into leaf blocks (text between block-level tags), each with its
open ancestors. A block's features say which tags and class words are above
it, how long it is, how much of it is link text, how it ends and where it
stands; the chain's labels are main text and boilerplate. Weights are fitted
by maximum likelihood (forward-backward, L2) on labelled pages, and a page is
decoded by Viterbi. The kept blocks, in page order, are the text.

``pages`` has no label column, so labelled pages are made from the pages'
own semantic markup (:func:`markup_labels`): inside article or main, and under no
boilerplate element. Each is also trained on with plain wrappers in place of those ancestors,
so that class words, text and neighbours carry weight where markup is missing, and with
blocks set under boilerplate elements inside the article (comments, asides, adverts,
forms), so that such ancestors outweigh it. The number of pages to fit on is
bounded by ``max_pages``, picked among the pages that have such markup; every page is decoded.

Formulas, embedded objects and fallback text (math, object, noscript, canvas, audio, video) are
text like any other, to be labelled by the field.

Defined cases: a null or empty html, or one without text, gives the empty
text; unclosed and misnested tags close with their ancestor; unterminated
comments, scripts and tags end with the page; rows are independent, so
repeated rows and null ids are extracted like any other; if no page has
semantic markup, a fixed prior on length and links decides; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import INT, LONG, STRING, schema

# Element names of HTML and words that sites use in class, id and role.
BLOCK_TAGS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                 "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
                 "ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
MARKUP = r"(?i)<(article|main)[\s/>]|articleBody"
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = set("script style template svg iframe textarea".split())
ENDS_P = BLOCK_TAGS - set("html head body caption li dd dt td th tr tbody thead tfoot option legend title summary".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "p": {"div", "article", "section", "td", "th", "li", "main", "aside", "body", "dd",
                                      "blockquote", "form", "figure", "header", "footer", "nav"}}
FEATURE_TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 li ul ol nav header footer aside form table td th "
                "blockquote pre figure figcaption dl dt dd a title head body button label fieldset details "
                "select option dialog menu").split()
WORDS_BAD = ("ad ads advert advertisement sponsor promo banner nav navbar menu header footer sidebar side aside comment "
             "comments reply replies disqus share social follow cookie consent notice alert popup modal related "
             "recommended trending breadcrumb breadcrumbs pagination pager form login signup subscribe newsletter search "
             "widget tags meta byline copyright legal toolbar skip navigation complementary contentinfo").split()
WORDS_GOOD = "content article post entry main body story text articlebody maincontent".split()
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "label", "fieldset"}
MARKERS = [("aside",), ("nav",), ("form",), ("footer",), *[("div", w) for w in (
    "ad", "ads", "advert", "promo", "comment", "comments", "reply", "share", "social", "related", "newsletter", "cookie",
    "notice", "sidebar", "menu", "subscribe", "breadcrumb", "widget", "banner", "alert")],
    ("section", "comments"), ("section", "related"), ("ul", "comments"), ("ul", "share")]

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD_SPLIT = re.compile(r"[^a-z]+")
LENGTHS = (15, 40, 80, 160, 320)

NAMES = ([f"tag:{t}" for t in FEATURE_TAGS] + [f"near:{t}" for t in FEATURE_TAGS]
         + [f"word:{w}" for w in (*WORDS_BAD, *WORDS_GOOD)] + [f"length:{i}" for i in range(len(LENGTHS) + 1)]
         + [f"links:{i}" for i in range(4)]
         + ["bias", "sentence end", "no stop", "copyright", "mostly upper", "has digits", "first block", "last block",
            "early", "late", "first heading"])
INDEX = {n: i for i, n in enumerate(NAMES)}
SEMANTIC = frozenset(INDEX[n] for n in ("tag:article", "tag:main", "word:article", "word:articlebody", "word:main",
                                        "word:maincontent"))
_TAG_AT = {t: INDEX[f"tag:{t}"] for t in FEATURE_TAGS}
_NEAR_AT = {t: INDEX[f"near:{t}"] for t in FEATURE_TAGS}
_WORD_AT = {w: INDEX[f"word:{w}"] for w in (*WORDS_BAD, *WORDS_GOOD)}
_BAD = frozenset(WORDS_BAD)


class Block:
    __slots__ = ("text", "tags", "words", "linked")

    def __init__(self, text: str, tags: list[str], words: frozenset[str], linked: int):
        self.text, self.tags, self.words, self.linked = text, tags, words, linked


def leaf_blocks(page: str) -> list[Block]:
    """The non-empty leaf blocks of a page in order; white space of each is single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    buffer: list[str] = []
    linked = links = 0
    none: frozenset[str] = frozenset()

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                words = none.union(*[w for _, w in stack if w]) if stack else none
                out.append(Block(text, [t for t, _ in stack], words, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def close(names: set[str] | frozenset[str], scope) -> bool:
        """Pop through the nearest open element of ``names``, unless one of ``scope`` stands before it."""
        nonlocal links
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                links -= sum(t == "a" for t, _ in stack[i:])
                del stack[i:]
                return True
            if stack[i][0] in scope:
                return False
        return False

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            text = entities.unescape(text) if "&" in text else text
            buffer.append(text)
            if links > 0:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        end, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if end:
            if name in BLOCK_TAGS:
                flush()
            close({name}, SCOPES.get(name, ()))
            continue
        if name in RAW_TAGS:
            if not (rest or "").endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}[\s/>]|</{re.escape(name)}\Z", re.I).search(page, at)
                at = n if not stop else (page.find(">", stop.start()) + 1 or n)
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in BLOCK_TAGS:
            flush()
            if name in ENDS_P:
                close({"p"}, SCOPES["p"])
            if name in CLOSES:
                close(CLOSES[name], SCOPES[name])
        if name not in VOID_TAGS:
            words = none
            if rest and "=" in rest:
                found = [x for trio in NAMED.findall(rest) for x in trio if x]
                if found:
                    words = frozenset(w for w in WORD_SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found)).lower())
                                      if w in _WORD_AT) | frozenset(x.lower() for x in found if x.lower() in _WORD_AT)
            stack.append((name, words))
            links += name == "a"
    flush()
    return out


def markup_labels(blocks: list[Block]) -> list[int] | None:
    """1 for main text by the page's semantic markup; None if the page has none."""
    out = []
    for b in blocks:
        inside = "article" in b.tags or "main" in b.tags or "articlebody" in b.words
        bad = BOILERPLATE_TAGS.intersection(b.tags) or _BAD.intersection(b.words)
        heading = inside and any(t in ("h1", "h2", "h3", "h4", "h5", "h6") for t in b.tags)
        if "header" in b.tags and not heading:
            bad = True
        out.append(int(inside and not bad))
    return out if any(out) else None


def text_features(b: Block) -> list[int]:
    t, n = b.text, len(b.text)
    f = [INDEX["bias"], INDEX[f"length:{sum(n > x for x in LENGTHS)}"]]
    density = b.linked / n
    f.append(INDEX[f"links:{0 if density == 0 else 1 if density < 0.3 else 2 if density < 0.7 else 3}"])
    f.append(INDEX["sentence end"] if t[-1] in ".!?…\"”»" else INDEX["no stop"])
    if "©" in t:
        f.append(INDEX["copyright"])
    if t.isupper():
        f.append(INDEX["mostly upper"])
    if any(map(str.isdigit, t[:80])):
        f.append(INDEX["has digits"])
    return f


def page_features(blocks: list[Block]) -> list[list[int]]:
    out, n, headed = [], len(blocks), False
    for k, b in enumerate(blocks):
        f = text_features(b)
        f += [_TAG_AT[t] for t in set(b.tags) if t in _TAG_AT]
        near = next((t for t in reversed(b.tags) if t in BLOCK_TAGS), None)
        if near in _NEAR_AT:
            f.append(_NEAR_AT[near])
        f += [_WORD_AT[w] for w in b.words]
        if k == 0:
            f.append(INDEX["first block"])
        if k == n - 1:
            f.append(INDEX["last block"])
        f.append(INDEX["early"] if 2 * k < n else INDEX["late"])
        if near == "h1" and not headed:
            headed = True
            f.append(INDEX["first heading"])
        out.append(f)
    return out


class Model:
    """weights[feature, label], transitions[from, to], start[label]."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray):
        self.keep = (weights[:, 1] - weights[:, 0]).tolist()  # only differences matter to two labels
        (self.t00, self.t01), (self.t10, self.t11) = transitions.tolist()
        self.start = float(start[1] - start[0])

    def viterbi(self, features: list[list[int]]) -> list[int]:
        if not features:
            return []
        keep, back = self.keep, []
        no, yes = 0.0, self.start + sum(keep[j] for j in features[0])
        for f in features[1:]:
            to_no, to_yes = no + self.t00 >= yes + self.t10, no + self.t01 > yes + self.t11
            back.append((0 if to_no else 1, 0 if to_yes else 1))
            no, yes = (no + self.t00 if to_no else yes + self.t10,
                       (no + self.t01 if to_yes else yes + self.t11) + sum(keep[j] for j in f))
        label = int(yes > no)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def fit(sequences: list[tuple[list[list[int]], list[int]]], *, steps: int = 120, l2: float = 0.02,
        rate: float = 0.2) -> Model:
    """Maximum likelihood by forward-backward over all sequences at once, with Adam."""
    n, longest, width = len(sequences), max(len(y) for _, y in sequences), len(NAMES)
    size = np.array([len(y) for _, y in sequences])
    flat = np.zeros((int(size.sum()), width), np.float32)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    y = np.concatenate([y for _, y in sequences])
    for s, (fs, _) in zip(first, sequences):
        for k, f in enumerate(fs):
            flat[s + k, f] = 1
    page, place = np.repeat(np.arange(n), size), np.arange(len(y)) - np.repeat(first, size)
    mask = np.arange(longest)[None, :] < size[:, None]
    last = size - 1
    one_hot = np.eye(2)[y]
    follows = place > 0
    true_steps = np.zeros((2, 2))
    np.add.at(true_steps, (y[np.flatnonzero(follows) - 1], y[follows]), 1)
    true_start = np.bincount(y[first], minlength=2)
    params = [np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def sum_exp(x, axis):  # over two labels
        return np.logaddexp(np.take(x, 0, axis), np.take(x, 1, axis))

    for step in range(1, steps + 1):
        w, t, s = params
        e = np.zeros((n, longest, 2))
        e[page, place] = flat @ w.astype(np.float32)
        alpha, beta = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        alpha[0] = e[:, 0] + s
        for k in range(1, longest):
            nxt = sum_exp(alpha[k - 1][:, :, None] + t[None], 1) + e[:, k]
            alpha[k] = np.where(mask[:, k, None], nxt, alpha[k - 1])
        for k in range(longest - 2, -1, -1):
            nxt = sum_exp(t[None] + (e[:, k + 1] + beta[k + 1])[:, None, :], 2)
            beta[k] = np.where(mask[:, k + 1, None], nxt, 0)
        z = sum_exp(alpha[last, np.arange(n)], 1)
        marginal = np.exp(alpha[place, page] + beta[place, page] - z[page, None])
        steps_expected = np.zeros((2, 2))
        for k in range(1, longest):
            live = mask[:, k]
            if live.any():
                pair = (alpha[k - 1][live][:, :, None] + t[None] + (e[live, k] + beta[k][live])[:, None, :]
                        - z[live][:, None, None])
                steps_expected += np.exp(pair).sum(0)
        start_expected = marginal[first].sum(0)
        grads = [flat.T @ (marginal - one_hot).astype(np.float32) / n + l2 * w / 10, (steps_expected - true_steps) / n + l2 * t,
                 (start_expected - true_start) / n + l2 * s]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(*params)


def prior() -> Model:
    """Without labelled pages: long blocks with few links are main text, blocks under boilerplate words are not."""
    w = np.zeros((len(NAMES), 2))
    for name, value in {"bias": -1.0, "length:0": -1, "length:3": 1, "length:4": 2, "length:5": 3, "links:0": 0.5, "links:2": -2,
                        "links:3": -4, "near:p": 1, "copyright": -3,
                        **{f"word:{x}": -4 for x in WORDS_BAD}, **{f"tag:{x}": -4 for x in BOILERPLATE_TAGS}}.items():
        if name in INDEX:
            w[INDEX[name], 1] = value
    return Model(w, np.array([[0.5, -0.5], [-0.5, 0.5]]), np.zeros(2))


#: What main text may stand under besides p.
TEXT_ELEMENTS = [("div",), ("div", "p"), ("section", "p"), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("h2",), ("h3",),
                 ("pre",), ("figure", "figcaption"), ("table", "tr", "td"), ("div", "div")]


def training_sequences(blocks: list[Block], labels: list[int], rng: random.Random) -> list[tuple]:
    """The page as it is; varied; and varied with plain wrappers for its semantic ancestors.

    Varied: some main text under other elements than its own, and blocks under boilerplate elements set among it.
    """
    root = next(b.tags for b, y in zip(blocks, labels) if y)
    root = root[:max((i + 1 for i, t in enumerate(root) if t in ("article", "main")), default=len(root))]
    varied, varied_labels, inside = [], [], []
    for b, y in zip(blocks, labels):
        if y and rng.random() < 0.25 and "h1" not in b.tags:
            varied.append(Block(b.text, [*root, *rng.choice(TEXT_ELEMENTS)], b.words, b.linked))
        else:
            varied.append(b)
        varied_labels.append(y)
        inside.append(y)
        if y and rng.random() < 0.3:
            marker = rng.choice(MARKERS)
            for _ in range(rng.randint(1, 3)):
                like = blocks[rng.randrange(len(blocks))]
                tags = [*root, marker[0], rng.choice(["p", "p", "div", "li", "h3"])]
                varied.append(Block(like.text, tags, frozenset(marker[1:]) & _WORD_AT.keys(), like.linked))
                varied_labels.append(0)
                inside.append(1)
    wrapper = {INDEX[x] for x in rng.choice([(), ("tag:div",), ("tag:div",), ("tag:section",), ("tag:section", "tag:div")])}
    if rng.random() < 0.5:
        wrapper.add(_WORD_AT[rng.choice([w for w in WORDS_GOOD if _WORD_AT[w] not in SEMANTIC])])
    rich = page_features(varied)
    bare = [sorted({j for j in f if j not in SEMANTIC} | (wrapper if x else set())) for f, x in zip(rich, inside)]
    return [(page_features(blocks), labels), (rich, varied_labels), (bare, varied_labels)]


def learn(pages: DataFrame, *, max_pages: int = 400, max_blocks: int = 100) -> Model:
    """Fit on at most ``max_pages`` pages with semantic markup, the first by a hash of page_id.

    Of a page with more than ``max_blocks`` blocks, half of them are taken from its start and half from its end.
    """
    picked = (pages.where(F.col("page_id").isNotNull() & F.col("html").rlike(MARKUP)).select("page_id").distinct()
              .orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages))

    def rows(batches):
        for pdf in batches:
            out = []
            for i, page in zip(pdf["page_id"], pdf["html"]):
                blocks = leaf_blocks(page or "")
                if len(blocks) > max_blocks:
                    blocks = blocks[:max_blocks // 2] + blocks[len(blocks) - max_blocks // 2:]
                labels = markup_labels(blocks) if blocks else None
                if labels:
                    out += training_sequences(blocks, labels, random.Random(int(i)))
            yield pd.DataFrame(out, columns=["features", "labels"])

    kind = T.StructType([T.StructField("features", T.ArrayType(T.ArrayType(INT))), T.StructField("labels", T.ArrayType(INT))])
    got = (pages.select("page_id", "html").join(F.broadcast(picked), "page_id").dropDuplicates(["page_id"])
           .mapInPandas(rows, kind).collect())
    sequences = sorted(([list(f) for f in r["features"]], list(r["labels"])) for r in got)
    return fit(sequences) if sequences else prior()


def main_text(page: str, model: Model) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, model.viterbi(page_features(blocks))) if y)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every row. No shuffle."""
    def run(batches):
        for batch in batches:
            texts = [main_text(x, model) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    out = schema(page_id=LONG, url=STRING, text=STRING, n_chars=LONG)
    return pages.select("page_id", "url", "html").mapInArrow(run, out)


def extract_main_text(pages: DataFrame, *, max_pages: int = 400) -> DataFrame:
    """Learn from the table's own labelled pages, then extract from every row."""
    return extract(pages, learn(pages, max_pages=max_pages))
