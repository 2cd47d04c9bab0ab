"""Main text of web pages by a recurrent block labeller.

The fare library keeps search pages as JSON payloads, not as markup, so this operator is general: it
takes any table of pages.

A page is cut into its leaf blocks.  Each block is a vector: the hashed tags and class words of its path,
the hashed words of its text, and figures of the text itself.  A bidirectional LSTM in numpy reads the blocks of a
page in order and classifies each in the light of all others.

It is trained here on pages of the table by weak labels (:func:`taught`): containers that say what they hold where there
are any, else what several figures of a block and its neighbours agree on; blocks without agreement teach nothing.  Half of
the training pages lose the names of their containers, so the model has to learn from texts, links, order and neighbours
what names told it, and can label pages whose names it has never seen.  Boilerplate of many kinds is worked in.
"""

import html as entities
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .records import restored

#: Words of tags, classes and ids that tell what a container holds.  Those of ``rest`` hold whatever is inside them; a ``wrapper`` may
#: stand around a whole page, so that main text inside it stays main text.
TEACH = {
    "main": ("article", "main", "content", "post", "story", "entry"),
    "rest": ("nav", "menu", "header", "footer", "aside", "sidebar", "ad", "ads", "advert", "promo", "sponsor", "banner", "cookie", "notice",
             "alert", "popup", "comment", "comments", "reply", "related", "share", "social", "breadcrumb", "copyright", "subscribe",
             "newsletter", "login", "search", "widget", "toolbar", "pagination"),
    "wrapper": ("form",),
}
_MAIN, _REST, _WRAPPER = (frozenset(TEACH[k]) for k in ("main", "rest", "wrapper"))
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                       "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
                       "tfoot th thead title tr ul".split())
HIDDEN = frozenset("script style noscript template svg iframe head title textarea select object canvas audio video math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"[>\"']")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noscript")}
_SPACE = re.compile(r"\s+")
_SPLIT = re.compile(r"[^a-z]+")

PATH_DIM, WORD_DIM, HIDDEN_DIM = 96, 64, 16
FIGURES = 10
TRAIN_PAGES, EPOCHS, RATE, SEED = 300, 10, 0.02, 5
#: Elements of a block's path that are kept, the innermost.
PATH_ELEMENTS = 40
#: Names that tell nothing, for containers in training that lose theirs.
NEUTRAL = ("box", "wrap", "c1", "col", "row", "block", "x", "unit", "part", "text", "grid", "s2", "outer", "inner", "zone", "cell")


class _Ends:
    """Where the tag that starts at a place ends; quotes may hold ``>``.  Every quote and ``>`` is looked at once a page."""

    def __init__(self, html: str):
        self.html, self.known, self.next = html, {}, (-1, -1)

    def _special(self, at: int) -> int:
        lo, hi = self.next
        if not lo <= at <= hi:
            m = _SPECIAL.search(self.html, at)
            self.next = (at, hi := m.start() if m else len(self.html))
        return hi

    def after(self, at: int) -> int:
        """The place behind the ``>`` that ends the tag, or -1 if nothing does."""
        first, chain = self._special(at), []
        j, end = first, -1
        while True:
            if j in self.known:
                end = self.known[j]
                break
            if j >= len(self.html):
                break
            chain.append(j)
            if self.html[j] == ">":
                end = j + 1
                break
            close = self.html.find(self.html[j], j + 1)
            if close < 0:
                break
            m = _SPECIAL.search(self.html, close + 1)
            j = m.start() if m else len(self.html)
        for k in chain:
            self.known[k] = end
        return end


def blocks(html: str) -> list[tuple[tuple[str, ...], str, float]]:
    """``(path, text, share of link text)`` of each leaf block, in page order; an element of the path is its tag and names.

    Hidden elements, comments and markup are left out; character references are decoded; white space
    within a block is one blank.  Unclosed elements end with their parents; a ``<`` that starts no tag is
    text.  Time is linear in the page, whatever is broken in it.
    """
    out, parts, linked, chars = [], [], 0, 0
    stack: list[tuple[str, str]] = []
    opened: dict[str, int] = {}
    ends = _Ends(html)
    hidden = link = 0
    at, n = 0, len(html)

    def flush():
        nonlocal parts, linked, chars
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            out.append((tuple(e for _, e in stack[-PATH_ELEMENTS:]), text, linked / max(chars, 1)))
        parts, linked, chars = [], 0, 0

    def say(text):
        nonlocal linked, chars
        if not hidden:
            parts.append(text)
            chars += len(text)
            linked += len(text) if link else 0

    def close(tag):
        nonlocal hidden, link
        while True:
            t, _ = stack.pop()
            opened[t] -= 1
            hidden -= t in HIDDEN
            link -= t == "a"
            if t == tag:
                return

    while at < n:
        lt = html.find("<", at)
        if lt != at:
            say(html[at:lt if lt >= 0 else n])
            if lt < 0:
                break
            at = lt
        m = _TAG.match(html, at)
        if not m:
            mark = "-->" if html.startswith("<!--", at) else "]]>" if html.startswith("<![CDATA[", at) else ">" if html[at + 1:at + 2] in ("!", "?") else None
            if mark is None or mark == ">" and html.find(">", at) < 0:
                say("<")
                at += 1
                continue
            end = html.find(mark, at + 2)
            at = end + len(mark) if end >= 0 else n
            continue
        end = ends.after(m.end())
        if end < 0:
            say("<")
            at += 1
            continue
        closing, tag, attributes = m.group(1), m.group(2).lower(), html[m.end():end - 1]
        at = end
        if tag in BLOCK_TAGS or tag in HIDDEN:
            flush()
        if closing:
            if opened.get(tag):
                close(tag)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            if tag == "p" and opened.get("p"):
                close("p")
            names = [w for g in _NAMES.findall(attributes) for w in _SPLIT.split("".join(g).lower()) if w] if attributes else []
            stack.append((tag, " ".join([tag, *names])))
            opened[tag] = opened.get(tag, 0) + 1
            hidden += tag in HIDDEN
            link += tag == "a"
            if tag in _RAW:
                found = _RAW[tag].search(html, at)
                at = found.start() if found else n
    flush()
    return out


def container_vote(path: tuple[str, ...]) -> int:
    """1 if the containers say main text, -1 if they say anything else, 0 if they say nothing.

    An element whose names say both (``article ad-free``) says neither.
    """
    inside = 0
    for element in path:
        words = set(element.split())
        main, rest = bool(words & _MAIN), bool(words & _REST)
        if rest and not main:
            return -1
        if main and not rest:
            inside = 1
        elif words & _WRAPPER and not main:
            inside = -1
    return inside


def _is_prose(text: str, links: float) -> bool:
    return len(text) >= 120 and links < 0.25 and text[-1] in ".!?…\"”»"


def text_votes(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    """Sum of the votes of each block's own figures and its neighbours': length, sentence end, link share, prose next to it."""
    prose = np.array([_is_prose(t, s) for _, t, s in page])
    near = np.zeros(len(page), bool)
    near[1:] |= prose[:-1]
    near[:-1] |= prose[1:]
    votes = []
    for (_, text, links), is_prose, beside in zip(page, prose, near):
        ended = text[-1] in ".!?…\"”»"
        votes.append(2 * int(is_prose) + int(len(text) >= 60 and ended and links < 0.25) - 2 * int(links >= 0.5)
                     - int(len(text) < 30 and not ended) + int(beside and links < 0.25))
    return np.array(votes)


def taught(page: list[tuple[tuple[str, ...], str, float]]) -> tuple[np.ndarray, np.ndarray]:
    """``(label, weight)`` of each block: containers decide where they speak, else votes that agree; weight 0 teaches nothing."""
    named = np.array([container_vote(p) for p, _, _ in page])
    votes = text_votes(page)
    label = np.where(named != 0, named, np.sign(votes)) > 0
    weight = np.where(named != 0, 1.0, np.where(np.abs(votes) >= 2, 0.5, 0.0))
    return label.astype(float), weight


_WORD_SLOTS: dict[str, int] = {}
_PATH_SLOTS: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    got = _PATH_SLOTS.get(path)
    if got is None:
        got = np.zeros(PATH_DIM, np.float32)
        for w in {w for e in path for w in e.split()} - {"html", "body", "p", "b", "i", "em", "strong", "span", "u", "font"}:
            got[zlib.crc32(w.encode()) % PATH_DIM] = 1
        if len(_PATH_SLOTS) > 50_000:
            _PATH_SLOTS.clear()
        _PATH_SLOTS[path] = got
    return got


def _slot(word: str) -> int:
    got = _WORD_SLOTS.get(word)
    if got is None:
        if len(_WORD_SLOTS) > 300_000:
            _WORD_SLOTS.clear()
        got = _WORD_SLOTS[word] = zlib.crc32(word.lower().encode()) % WORD_DIM
    return got


def _text_vector(text: str, links: float) -> np.ndarray:
    """Hashed words and figures of a block's text; the place in the page is left open."""
    out = np.zeros(WORD_DIM + FIGURES, np.float32)
    words = text.split(" ")
    out[:WORD_DIM] = np.bincount([_slot(w) for w in words], minlength=WORD_DIM) / len(words)
    out[WORD_DIM:] = (min(len(text) / 300, 3), links, min(len(words) / 24, 1), text[-1:] in ".!?…\"”»", 0, 1, min(sum(map(text.count, ".!?")) / 5, 1),
                      sum(map(text.count, ",;")) / len(words), sum(w[:1].isupper() for w in words) / len(words), _is_prose(text, links))
    return out


def vectors(page: list[tuple[tuple[str, ...], str, float]], known: dict | None = None) -> np.ndarray:
    """One row per block: path words, words of the text, figures.  ``known`` keeps vectors of texts met before."""
    x = np.zeros((len(page), PATH_DIM + WORD_DIM + FIGURES), np.float32)
    for i, (path, text, links) in enumerate(page):
        x[i, :PATH_DIM] = _path_vector(path)
        got = known.get((text, links)) if known is not None else None
        if got is None:
            got = _text_vector(text, links)
            if known is not None:
                known[text, links] = got
        x[i, PATH_DIM:] = got
        x[i, -FIGURES + 4] = i / max(len(page), 1)
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output per block; trained by full backpropagation and Adam."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + FIGURES, HIDDEN_DIM
        self.p = {f"{k}{side}": v for side in "fb" for k, v in (
            ("W", rng.standard_normal((d, 4 * h)) * 0.1), ("U", rng.standard_normal((h, 4 * h)) * 0.1), ("b", np.repeat([0.0, 1.0, 0.0, 0.0], h)))}
        self.p["v"], self.p["c"] = rng.standard_normal(2 * h) * 0.3, np.zeros(1)

    def _run(self, x, side):
        """Hidden states of ``x`` (steps, pages, features) in reading order and what the gradient needs."""
        h_dim = HIDDEN_DIM
        steps, pages, _ = x.shape
        pre = x @ self.p["W" + side] + self.p["b" + side]
        h = np.zeros((pages, h_dim))
        c = np.zeros((pages, h_dim))
        hs, kept = np.zeros((steps, pages, h_dim)), []
        for t in range(steps):
            z = pre[t] + h @ self.p["U" + side]
            i, f, o = _sigmoid(z[:, :h_dim]), _sigmoid(z[:, h_dim:2 * h_dim]), _sigmoid(z[:, 2 * h_dim:3 * h_dim])
            g = np.tanh(z[:, 3 * h_dim:])
            before, h_before = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            hs[t] = h
            kept.append((i, f, o, g, c, before, h_before))
        return hs, kept

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of main text, ``(steps, pages)``; steps beyond a page's length mean nothing."""
        forward, _ = self._run(x, "f")
        back, _ = self._run(_reversed(x, lengths), "b")
        hs = np.concatenate([forward, _reversed(back, lengths)], axis=2)
        return _sigmoid(hs @ self.p["v"] + self.p["c"][0])

    def gradients(self, x, lengths, y, weight):
        xb = _reversed(x, lengths)
        hf, kf = self._run(x, "f")
        hb, kb = self._run(xb, "b")
        hs = np.concatenate([hf, _reversed(hb, lengths)], axis=2)
        err = (_sigmoid(hs @ self.p["v"] + self.p["c"][0]) - y) * weight / max(weight.sum(), 1)
        g = {"v": np.einsum("tp,tph->h", err, hs), "c": np.array([err.sum()])}
        dh = err[:, :, None] * self.p["v"]
        for side, xs, kept, d in (("f", x, kf, dh[:, :, :HIDDEN_DIM]), ("b", xb, kb, _reversed(dh[:, :, HIDDEN_DIM:], lengths))):
            dW, dU, db = (np.zeros_like(self.p[k + side]) for k in "WUb")
            h_next, c_next = np.zeros_like(d[0]), np.zeros_like(d[0])
            for t in range(len(kept) - 1, -1, -1):
                i, f, o, gg, c, before, h_before = kept[t]
                a = d[t] + h_next
                tc = np.tanh(c)
                dc = a * o * (1 - tc ** 2) + c_next
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), a * tc * o * (1 - o), dc * i * (1 - gg ** 2)], axis=1)
                dW += xs[t].T @ dz
                dU += h_before.T @ dz
                db += dz.sum(axis=0)
                h_next, c_next = dz @ self.p["U" + side].T, dc * f
            g["W" + side], g["U" + side], g["b" + side] = dW, dU, db
        return g


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's steps in opposite order, padding left at the end."""
    at = np.arange(x.shape[0])[:, None]
    order = np.where(at < lengths[None, :], lengths[None, :] - 1 - at, at)
    return x[order, np.arange(x.shape[1])[None, :]]


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((max(lengths.max(), 1), len(rows), PATH_DIM + WORD_DIM + FIGURES), np.float32)
    for i, r in enumerate(rows):
        x[:len(r), i] = r
    return x, lengths


def _worked_in(page, others, rng):
    """The page with boilerplate blocks of every kind at its ends and between its blocks, some inside the article."""
    out = list(page)
    for _ in range(int(rng.integers(2, 7))):
        word = TEACH["rest"][int(rng.integers(len(TEACH["rest"])))]
        tag = word if word in BLOCK_TAGS else "div"
        outer = ("article",) if rng.random() < 0.4 else ()
        path = ("html", "body", *outer, f"{tag} {word}", *(("ul", "li") if rng.random() < 0.3 else ("p",)))
        at = int(rng.integers(0, len(out) + 1))
        out[at:at] = [(path, others[int(rng.integers(len(others)))], float(rng.random() < 0.3)) for _ in range(int(rng.integers(1, 4)))]
    if rng.random() < 0.5:  # pages that name their main part otherwise
        word = TEACH["main"][int(rng.integers(len(TEACH["main"])))]
        out = [(tuple(f"div {word}" if e.split()[0] == "article" else e for e in p), t, s) for p, t, s in out]
    if rng.random() < 0.2:  # a form around the whole page
        out = [((*p[:2], "form", *p[2:]), t, s) for p, t, s in out]
    return out


_PLAIN = frozenset("html body p b i em strong span u font ul ol li a br h1 h2 h3 h4 h5 h6 table tr td th blockquote pre div".split())


def _nameless(page, rng):
    """The page with names that tell nothing: containers become plain ones, each name another, the same all over the page."""
    given: dict[str, str] = {}

    def plain(element):
        tag, *names = element.split()
        if element not in given:
            keep = tag if tag in _PLAIN else ("div", "section")[int(rng.integers(2))]
            many = int(rng.integers(0, 2)) + bool(names) if keep in ("div", "section") or names else 0
            given[element] = " ".join([keep, *(NEUTRAL[int(rng.integers(len(NEUTRAL)))] for _ in range(many))])
        return given[element]
    return [(tuple(plain(e) for e in p), t, s) for p, t, s in page]


def _frayed(page, label, weight, rng):
    """Some boilerplate left out, and rows of links before or behind what is left, so that no fixed frame marks the main text."""
    keep = np.flatnonzero((label > 0) | (rng.random(len(page)) < rng.choice([0.4, 0.8, 1.0])))
    out = [page[i] for i in keep]
    y, w = label[keep].tolist(), weight[keep].tolist()
    for _ in range(int(rng.integers(0, 4))):
        at = (0, len(out))[int(rng.integers(2))]
        words = " ".join(NEUTRAL[int(rng.integers(len(NEUTRAL)))] for _ in range(int(rng.integers(1, 6))))
        out.insert(at, (("html", "body", "div " + NEUTRAL[int(rng.integers(len(NEUTRAL)))]), words, float(rng.uniform(0.6, 1.0))))
        y.insert(at, 0.0)
        w.insert(at, 1.0)
    return out, np.array(y), np.array(w)


def _ambiguous(page, rng):
    """The page with a name of the rest on its main containers too, as in ``article ad-free``."""
    word = TEACH["rest"][int(rng.integers(len(TEACH["rest"])))]
    return [(tuple(f"{e} {word}" if set(e.split()) & _MAIN else e for e in p), t, s) for p, t, s in page]


def train(pages: DataFrame, html: str = "html") -> Labeller:
    """Labeller fitted on at most ``TRAIN_PAGES`` pages, chosen by hash, by the labels of :func:`taught`."""
    rows = pages.select(F.col(f"`{html}`").alias("__html")).where("__html is not null and __html <> ''").withColumn("__h", F.xxhash64("__html"))
    low = [r["__h"] for r in rows.select("__h").distinct().orderBy("__h").limit(TRAIN_PAGES).collect()]
    sample = [blocks(r["__html"]) for r in rows.where(F.col("__h") <= low[-1]).dropDuplicates(["__h"]).orderBy("__h").collect()] if low else []
    sample = [p for p in sample if p]
    model = Labeller()
    if not sample:
        return model
    rng = np.random.default_rng(SEED)
    texts = [t for p in sample for _, t, _ in p]
    known: dict = {}  # texts of at most TRAIN_PAGES pages
    m1, m2 = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(np.resize(np.arange(len(sample)), max(len(sample), TRAIN_PAGES)))  # few pages are used again, worked differently
        for lo in range(0, len(order), 20):
            batch, y_own = [], []
            for i in order[lo:lo + 20]:
                page = sample[i] if rng.random() < 0.5 else _worked_in(sample[i], texts, rng)
                label, weight = taught(page)
                if page is sample[i]:
                    votes = text_votes(page)  # without names a block teaches only what its text does not speak against
                    weight = np.where((np.abs(votes) >= 2) & ((votes > 0) != (label > 0)), 0.0, weight)
                    page, label, weight = _frayed(_nameless(page, rng), label, weight, rng)
                elif rng.random() < 0.3:
                    page = _ambiguous(page, rng)
                batch.append(page)
                y_own.append((label, weight))
            x, lengths = _padded([vectors(p, known) for p in batch])
            y, weight = np.zeros(x.shape[:2]), np.zeros(x.shape[:2])
            for i, (label, w) in enumerate(y_own):
                y[:len(label), i], weight[:len(label), i] = label, w
            step += 1
            for k, g in model.gradients(x, lengths, y, weight).items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                model.p[k] -= RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def extract_pages(model: Labeller, htmls: list[str]) -> list[str]:
    """Main text of each page; pages of like length go through the model together."""
    cut = [blocks(h) for h in htmls]
    out = [""] * len(cut)
    order = sorted((i for i in range(len(cut)) if cut[i]), key=lambda i: len(cut[i]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and hi - lo < 64 and len(cut[order[hi]]) * (hi - lo + 1) <= 20_000:
            hi += 1
        own = order[lo:hi]
        x, lengths = _padded([vectors(cut[i]) for i in own])
        p = model.probabilities(x, lengths)
        for k, i in enumerate(own):
            out[i] = "\n".join(text for (_, text, _), q in zip(cut[i], p[:, k]) if q >= 0.5)
        lo = hi
    return out


def extract(pages: DataFrame, model: Labeller, key: str = "page_id", html: str = "html", carry: tuple[str, ...] = ()) -> DataFrame:
    """``page_id, text`` and the columns named in ``carry``: the blocks labelled main text, in page order, joined by line breaks.

    Null, empty or textless pages: empty text.  Null keys stay; repeated rows each keep their row; an empty
    table gives an empty one.  Other columns are not read.  A page is read whole, however long.
    """
    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), 200):
                part = pdf.iloc[lo:lo + 200]
                yield pd.DataFrame({key: part["__key"], **{c: part[c] for c in carry}, "text": extract_pages(model, part["__html"].tolist())})

    plain = pages.select(F.col(f"`{key}`").cast("string").alias("__key"), *[F.col(f"`{c}`") for c in carry],
                         F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("__html"))
    kept = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in carry)
    return restored(plain.mapInPandas(run, f"`{key}` string, {kept}text string"), key, pages)
