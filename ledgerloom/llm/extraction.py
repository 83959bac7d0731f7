"""Operator 7: main text of web pages by a bidirectional LSTM over the page's blocks.

A page is cut into its leaf blocks in page order. The network, plain numpy, reads for each block its
tag path (hashed tags and class names, and hashed steps from tag to tag), hashed words and a few
measures, in both directions, and labels the block as article or not with the whole page in view. It
is trained on pages composed of the corpus's own text: blocks of a bounded sample of pages are dealt
into many layouts whose parts are known by construction. All steps are linear in a page's length,
whatever its markup.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import longs, over_batches, table, texts_of

#: Pages whose text the layouts are filled with, at most about; blocks of each, and characters of a block, at most.
SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_CHARS = 150, 100, 2_000
PATH_BITS, STEP_BITS, WORD_BITS, MEASURES, HIDDEN = 7, 5, 5, 6, 16
AT_STEPS = 1 << PATH_BITS
AT_WORDS = AT_STEPS + (1 << STEP_BITS)
AT_MEASURES = AT_WORDS + (1 << WORD_BITS)
INPUTS = AT_MEASURES + MEASURES
#: Blocks, padding included, that are read together, and places of a long page that are at once in memory as inputs.
READ_BLOCKS, READ_PLACES = 1 << 15, 1 << 12

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
END = re.compile(r"""(?:[^'">]++|"[^"]*"|'[^']*')*+>""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
# Elements within a line of text, elements without content, those whose content is no markup, and paragraphs' rivals.
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in ("script", "style", "template", "noscript", "svg", "textarea", "title")}
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table select".split())


@lru_cache(100_000)
def _bit(word: str, bits: int) -> int:
    return 1 << (zlib.crc32(word.encode()) >> (32 - bits))


class Path(NamedTuple):
    """The innermost tag, and bits of hashed tags and names, and of hashed steps from tag to tag, from the root on."""

    tag: str
    words: int
    steps: int

    def down(self, tag: str, names: list[str]) -> Path:
        words = self.words | _bit(tag, PATH_BITS)
        for word in names:
            words |= _bit(word, PATH_BITS)
        return Path(tag, words, self.steps | _bit(f"{self.tag}>{tag}", STEP_BITS))


class Block:
    __slots__ = ("path", "parts", "linked")

    def __init__(self, path: Path):
        self.path, self.parts, self.linked = path, [], 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def markup(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text, tag, closing, attributes) in page order; either text or tag is empty, both are for comments and the like.

    A tag ends at the first ``>`` outside quotes. Where there is none any more, quotes have no
    meaning in the rest of the page, so that nothing is read twice; and a rest without ``>`` is text.
    """
    at = look = 0
    quoted = True
    while (i := page.find("<", look)) >= 0:
        tag, closing, more = "", False, ""
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            end = len(page) if end < 0 else end + 3
        elif page[i + 1 : i + 2] in ("!", "?"):
            end = page.find(">", i) + 1
        elif found := TAG.match(page, i):
            whole = END.match(page, found.end()) if quoted else None
            quoted = whole is not None
            end = whole.end() if whole else page.find(">", found.end()) + 1
            tag, closing, more = found[2].lower(), bool(found[1]), page[found.end() : end - 1]
        else:  # a mere character
            look = i + 1
            continue
        if not end:
            break
        if i > at:
            yield page[at:i], "", False, ""
        if tag in RAW and not closing:
            close = RAW[tag].search(page, end)
            tag, end = "", close.end() if close else len(page)
        yield "", tag, closing, more
        at = look = end
    if at < len(page):
        yield page[at:], "", False, ""


def blocks(page: str) -> list[tuple[Path, str, float]]:
    """(tag path, text, share of linked characters) of each leaf block that has text, in page order.

    Character references are decoded, white space within a block is one blank, and a ``br`` is white
    space. Elements that stay open weigh no more than others: a path is a few hashed bits.
    """
    root = Path("", 0, 0)
    stack: list[Path] = []
    opened: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]  # what is open since the last list or table
    out: list[Block] = []
    now: Block | None = None
    links = 0

    def pop(k: int) -> None:
        for path in stack[k:]:
            opened[path.tag] -= 1
        while len(stack) > k:
            if (tag := stack.pop().tag) in SCOPES:
                scopes.pop()
            else:
                scopes[-1][tag] -= 1

    for raw, tag, closing, more in markup(page):
        if raw:
            if now is None:
                if not raw.strip():
                    continue
                now = Block(stack[-1] if stack else root)
                out.append(now)
            now.parts.append(html.unescape(raw))
            if links:
                now.linked += len(raw.strip())
            continue
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br" and now is not None:
                now.parts.append(" ")
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        now, links = None, 0
        if closing:
            if opened[tag]:
                pop(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag))
            continue
        if tag in VOID:
            continue
        if stack and stack[-1].tag == "p":  # a paragraph ends where another block begins
            pop(len(stack) - 1)
        if any(scopes[-1][x] > 0 for x in SAME_LEVEL.get(tag, ())):
            pop(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag in SAME_LEVEL[tag]))
        names: list[str] = []
        if "=" in more:
            for name in NAMES.finditer(more):
                names += re.findall(r"[a-z]+", (name[1] or name[2] or name[3] or "").lower())
        if not more.endswith("/"):
            stack.append((stack[-1] if stack else root).down(tag, names))
            opened[tag] += 1
            if tag in SCOPES:
                scopes.append(Counter())
            else:
                scopes[-1][tag] += 1
    found = ((b.path, b.text(), b.linked / max(1, sum(map(len, b.parts)))) for b in out)
    return [x for x in found if x[1]]


def features(page: list[tuple[Path, str, float]], first: int = 0, last: int | None = None) -> np.ndarray:
    """The inputs of a page's blocks, or of those from ``first`` to before ``last``."""
    part = page[first:last]
    x = np.zeros((len(part), INPUTS), np.float32)
    for at, width, bits in ((0, AT_STEPS, [p.words for p, _, _ in part]), (AT_STEPS, AT_WORDS - AT_STEPS, [p.steps for p, _, _ in part])):
        packed = np.frombuffer(b"".join([b.to_bytes(width // 8, "little") for b in bits]), np.uint8).reshape(len(part), width // 8)
        x[:, at : at + width] = np.unpackbits(packed, axis=1, bitorder="little")
    for i, (path, text, linked) in enumerate(part):
        parts = text.split(" ")
        counts = np.bincount([zlib.crc32(w.encode()) >> (32 - WORD_BITS) for w in parts], minlength=1 << WORD_BITS)
        x[i, AT_WORDS:AT_MEASURES] = np.sqrt(counts / len(parts))
        n = len(text)
        x[i, AT_MEASURES:] = (
            np.log1p(n) / 8, linked, sum(map(text.count, ".,;:!?")) / n * 10, (first + i) / len(page), 1.0 if path.tag in ("p", "pre", "blockquote") else 0.0,
            1.0 if path.tag in ("h1", "h2", "h3") else 0.0,
        )
    return x


class Labeller:
    """A bidirectional LSTM and a logistic output for each block."""

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        scale = 1 / np.sqrt(HIDDEN)
        self.w: dict[str, np.ndarray] = {}
        for way in "fb":
            self.w[f"x{way}"] = random.normal(0, 0.1, (INPUTS, 4 * HIDDEN)).astype(np.float32)
            self.w[f"h{way}"] = random.uniform(-scale, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.w[f"c{way}"] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
        self.w["out"] = random.normal(0, 0.1, (2 * HIDDEN, 1)).astype(np.float32)
        self.w["bias"] = np.zeros(1, np.float32)

    def _pass(self, way: str, x: np.ndarray, mask: np.ndarray, state: tuple | None = None, kept: list | None = None) -> tuple[np.ndarray, tuple]:
        """x: steps x pages x inputs, padded; a padded step leaves the state as it is. ``kept``: takes what the gradient needs."""
        steps, pages, _ = x.shape
        h, c = state or (np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32))
        seen = np.zeros((steps, pages, HIDDEN), np.float32)
        inward = (x.reshape(steps * pages, -1) @ self.w[f"x{way}"] + self.w[f"c{way}"]).reshape(steps, pages, -1)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            gates = inward[t] + h @ self.w[f"h{way}"]
            i, f, o = (1 / (1 + np.exp(-np.clip(gates[:, k * HIDDEN : (k + 1) * HIDDEN], -30, 30))) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            on = mask[t][:, None]
            if kept is not None:
                kept.append((t, h, c, i, f, o, g, squashed))
            h, c = on * (o * squashed) + (1 - on) * h, on * new_c + (1 - on) * c
            seen[t] = h
        return seen, (h, c)

    def _output(self, both: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((both @ self.w["out"])[..., 0] + self.w["bias"], -30, 30)))

    def chances(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._output(np.concatenate([self._pass(way, x, mask)[0] for way in "fb"], axis=2))

    def read(self, pages: list[list]) -> np.ndarray:
        """``chances`` of pages' blocks, places x pages, with the inputs of a few places at a time in memory."""
        steps = max(map(len, pages))
        both = np.zeros((steps, len(pages), 2 * HIDDEN), np.float32)
        starts = list(range(0, steps, READ_PLACES))

        def inputs(at: int) -> tuple[np.ndarray, np.ndarray]:
            to = min(steps, at + READ_PLACES)
            return padded([features(page, at, to) for page in pages], to - at)

        once = inputs(0) if len(starts) == 1 else None
        for k, (way, order) in enumerate((("f", starts), ("b", starts[::-1]))):
            state = None
            for at in order:
                x, mask = once or inputs(at)
                both[at : at + len(x), :, k * HIDDEN : (k + 1) * HIDDEN], state = self._pass(way, x, mask, state)
        return self._output(both)

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over real blocks, by back-propagation through time."""
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._pass(way, x, mask, None, kept[way])[0] for way in "fb"], axis=2)
        p = self._output(both)
        error = ((p - y) * mask / max(1.0, mask.sum()))[..., None].astype(np.float32)
        grad = {"out": (both.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, 1)), "bias": error.sum((0, 1))}
        back = error @ self.w["out"].T
        for k, way in enumerate("fb"):
            part = back[..., k * HIDDEN : (k + 1) * HIDDEN]
            wh = self.w[f"h{way}"]
            gh, gx, gc = np.zeros_like(wh), np.zeros_like(self.w[f"x{way}"]), np.zeros(4 * HIDDEN, np.float32)
            dh, dc = np.zeros(part[0].shape, np.float32), np.zeros(part[0].shape, np.float32)
            for t, h, c, i, f, o, g, squashed in reversed(kept[way]):
                on = mask[t][:, None]
                all_h = dh + part[t]
                new_h, new_c = all_h * on, dc * on
                new_c = new_c + new_h * o * (1 - squashed**2)
                d = np.concatenate([new_c * g * i * (1 - i), new_c * c * f * (1 - f), new_h * squashed * o * (1 - o), new_c * i * (1 - g**2)], axis=1)
                gh += h.T @ d
                gx += x[t].T @ d
                gc += d.sum(0)
                dh, dc = d @ wh.T + all_h * (1 - on), new_c * f + dc * (1 - on)
            grad |= {f"h{way}": gh, f"x{way}": gx, f"c{way}": gc}
        return grad

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 8, size: int = 16, rate: float = 0.02) -> None:
        random, step = np.random.default_rng(11), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        for _ in range(rounds):
            order = random.permutation(len(pages))
            for at in range(0, len(order), size):
                chosen = order[at : at + size]
                x, mask = padded([pages[i] for i in chosen])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(chosen):
                    y[: len(labels[i]), k] = labels[i]
                step += 1
                for name, g in self.gradient(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    self.w[name] = self.w[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)

    def label(self, pages: list[list]) -> list[np.ndarray]:
        """True for each article block of each page, given their ``blocks``; pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        chosen: list[int] = []
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        for k, i in enumerate(order):
            chosen.append(i)
            if k + 1 == len(order) or len(pages[order[k + 1]]) * (len(chosen) + 1) > READ_BLOCKS:
                p = self.read([pages[j] for j in chosen])
                for c, j in enumerate(chosen):
                    out[j] = p[: len(pages[j]), c] >= 0.5
                chosen = []
        return out


def padded(pages: list[np.ndarray], steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    steps = steps or max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), INPUTS), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


# How the parts of training pages are wrapped, as "tag.name.name" from the outside in.
ARTICLE = ["article", "main article", "main", "div.content", "div.main.content article", "div.post section.post.body", "section.article.body", "div.entry.content", "div.wrapper article.post", "div.story div.text"]
BESIDE = {
    "menu": ["nav ul li", "div.menu ul li", "header nav ul li", "ul.nav.menu li", "div.breadcrumb", "div.navbar ul li", "aside nav ul li"],
    "header": ["header", "div.header", "header h1", "header.site p", "div.masthead div.title", "div.top.banner"],
    "footer": ["footer", "footer p", "div.footer", "div.footer ul li", "footer.site div.copyright", "footer section p"],
    "sidebar": ["aside", "aside p", "aside.sidebar div", "div.sidebar ul li", "div.widget p", "aside section h2", "div.related ul li", "section.related h3"],
    "notice": ["div.cookie.notice", "div.notice p", "div.consent p", "section.alert p", "div.newsletter.signup p", "div.notification"],
    "advert": ["div.ad", "div.ads p", "div.advert", "aside.ad div", "section.promo p", "div.sponsored p", "ins.ad div", "div.banner"],
    "form": ["form label", "form p", "form div button", "div.search form", "form.login p", "form fieldset legend", "form select option"],
    "comments": ["section.comments div.comment p", "div.comments ul li", "div.comment.list p", "ol.comments li p", "section.discussion div.reply p", "div.comments h2", "div.responses p"],
}


def _wrap(layout: str, inner: str) -> str:
    for part in reversed(layout.split()):
        tag, *names = part.split(".")
        inner = f"<{tag}{f' class="{" ".join(names)}"' if names else ''}>{inner}</{tag}>"
    return inner


def compose(texts: list[str], random: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of the corpus's text in a layout by chance, and which of its blocks are article."""

    def some(n: int) -> list[str]:
        return [html.escape(texts[i]) for i in random.integers(0, len(texts), n)]

    def short(text: str) -> str:
        return " ".join(text.split()[: int(random.integers(1, 9))]) or "more"

    page: list[str] = []
    labels: list[bool] = []

    def beside(kind: str, within: bool = False) -> None:
        for _ in range(int(random.integers(1, 3 if within else 7))):
            text = some(1)[0] if kind in ("comments", "advert", "notice", "footer", "sidebar") and random.random() < 0.6 else short(some(1)[0])
            linked = kind in ("menu", "sidebar", "footer") and random.random() < 0.7
            layout = str(random.choice(BESIDE[kind]))
            page.append(_wrap(layout, f'<a href="/x">{text}</a>' if linked else text))
            labels.append(False)

    for kind in random.permutation(["menu", "header", "notice", "advert", "form"])[: int(random.integers(0, 5))]:
        beside(str(kind))
    layout = str(random.choice(ARTICLE))
    inner: list[str] = []
    if random.random() < 0.8:
        inner.append(f"<h1>{short(some(1)[0])}</h1>")
    for text in some(int(random.integers(1, 14))):
        kind = random.random()
        text = short(text) if random.random() < 0.15 else text
        inner.append(f"<h2>{short(text)}</h2>" if kind < 0.08 else f"<ul><li>{text}</li></ul>" if kind < 0.13 else f"<blockquote>{text}</blockquote>" if kind < 0.17 else f"<pre>{text}</pre>" if kind < 0.2 else f"<p><b>{text}<br>" if kind < 0.3 else f"<p>{text}</p>")
    marks = [True] * len(inner)
    if random.random() < 0.4:  # something foreign within the article
        before = len(page)
        beside(str(random.choice(["advert", "sidebar", "notice", "comments", "form"])), within=True)
        at = int(random.integers(1, len(inner) + 1))
        inner[at:at], marks[at:at] = page[before:], labels[before:]
        del page[before:], labels[before:]
    page.append(_wrap(layout, "".join(inner)))
    labels += marks
    for kind in random.permutation(["comments", "sidebar", "advert", "form", "footer", "footer"])[: int(random.integers(0, 6))]:
        beside(str(kind))
    return "<html><body>" + "".join(page) + "</body></html>", labels


def trained(texts: list[str], pages: int = 480, seed: int = 3) -> Labeller:
    """A labeller trained on ``pages`` composed pages; the same for the same texts."""
    random = np.random.default_rng(seed)
    texts = [x for x in texts if x.strip()] or ["Text."]
    xs, ys = [], []
    for _ in range(pages):
        page, labels = compose(texts, random)
        found = blocks(page)
        if found and len(found) == len(labels):
            xs.append(features(found))
            ys.append(np.array(labels, np.float32))
    labeller = Labeller()
    labeller.train(xs, ys)
    return labeller


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_blocks: int = SAMPLE_BLOCKS, sample_chars: int = SAMPLE_CHARS) -> Labeller:
    """Train on text of about ``sample_pages`` pages of any length, chosen by a hash: of each at most
    ``sample_blocks`` blocks, spread over the page, cut to ``sample_chars``. That bounds what reaches the driver.

    Where the chosen pages have no block, pages that have one are looked for; where no page has one,
    there is nothing to label either.
    """
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 30))

    def drawn(usable: DataFrame) -> list[str]:
        n = usable.count()
        sample = usable.where(place * F.lit(n) < F.lit(sample_pages * (1 << 30))).select("html", place.alias("place"), F.xxhash64("html", F.lit(1)).alias("tie"))
        kept = sample.select("place", "tie").orderBy("place", "tie").limit(2 * sample_pages)
        rows = over_batches(sample.join(F.broadcast(kept.distinct()), ["place", "tie"]), some_blocks, "place long, tie long, texts array<string>").collect()
        return [text for row in sorted(rows, key=lambda r: (r.place, r.tie)) for text in row.texts]

    def some_blocks(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            texts = []
            for page in texts_of(record, "html"):
                found = [text[:sample_chars] for _, text, _ in blocks(page)]
                step = -(-len(found) // sample_blocks)
                texts.append(found[::step] if found else [])
            yield pa.RecordBatch.from_arrays([record.column("place"), record.column("tie"), pa.array(texts, pa.list_(pa.string()))], names=["place", "tie", "texts"])

    def with_blocks(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            yield pa.RecordBatch.from_arrays([pa.array([x for x in texts_of(record, "html") if any(text.strip() for _, text, _ in blocks(x))], pa.string())], names=["html"])

    usable = pages.where(F.length("html") > 0).select("html")
    texts = drawn(usable)
    return trained(texts if any(x.strip() for x in texts) else drawn(over_batches(usable, with_blocks, "html string")))


def extracted(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """``pages`` (html and any other columns) with text (blocks of the article, joined by line feeds) and n_chars.

    A null page is empty, and a page without an article block has an empty text. Pages may be of any
    length: inputs are made for a few thousand blocks at a time. Rows alike give texts alike; an
    empty table gives an empty one, and nothing to train on gives a network trained on one word.
    """
    shared = pages.sparkSession.sparkContext.broadcast(labeller)  # some ten thousand numbers
    rest = pages.drop("text", "n_chars")
    names = [x for x in rest.columns if x != "html"]
    schema = T.StructType([*rest.select(*names).schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            cut = [blocks(x) for x in texts_of(record, "html")]
            chosen = shared.value.label(cut)
            texts = ["\n".join(b[1] for b, y in zip(page, on, strict=True) if y) for page, on in zip(cut, chosen, strict=True)]
            yield pa.RecordBatch.from_arrays([*(record.column(x) for x in names), pa.array(texts, pa.string()), longs([len(x) for x in texts])], names=[*names, "text", "n_chars"])

    return over_batches(rest, rows, schema)


def op7_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages, fit(pages))
