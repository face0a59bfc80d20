"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, the runs of text between the borders of block
elements. Each block is described by the tags and the class words of its ancestors
and by its text; a conditional random field with the labels "kept" and "left out" is
trained on labelled pages and decoded by the Viterbi algorithm.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import draw, map_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements whose borders end a block.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section "
    "math xmp select summary table tbody td tfoot th thead title tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Elements that a page may hide until it is loaded; their text counts all the same.
WHOLE = frozenset("html body main article".split())

# Elements whose content is not text of the page.
RAW = frozenset("script style template iframe noframes noscript textarea svg object audio video canvas title".split())

# Those of them that reach to the end of the page without an end tag; after others a reader goes on.
TO_THE_END = frozenset("script style textarea title".split())

# What a start tag ends if it is open: elements that cannot hold each other.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}

# Labelled pages of a training.
TRAINING_PAGES = 1000

# Pages of the table whose text the labelled pages are made of, at most about so many.
TEXT_PAGES = 200


@dataclass(slots=True)
class Block:
    """A run of text, the tags and class words above it, and how much of it is linked."""

    text: str
    path: tuple[str, ...]
    linked: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """Features of an element: its tag, the words of class, id and role, and whether it is hidden."""
    if not attributes.strip():
        return (tag,)
    words = {
        w.lower()
        for m in ATTRIBUTE.finditer(attributes)
        for w in WORDS.findall(m.group(2) or m.group(3) or m.group(4) or "")
    }
    hidden = ["hidden!"] if HIDDEN.search(attributes) and tag not in WHOLE else []
    return (tag, *hidden, *sorted("." + w for w in words))


def blocks(page: str | None) -> Iterator[Block]:
    """The leaf blocks of a page in order."""
    page = page or ""
    stack: list[tuple[str, tuple[str, ...]]] = []
    text, linked, link = [], 0, 0
    at = 0
    unclosed: set[str] = set()

    def flush():
        nonlocal linked
        joined = " ".join("".join(text).split())
        found = [Block(joined, tuple(f for _, names in stack for f in names), min(linked, len(joined)))] if joined else []
        text.clear()
        linked = 0
        return found

    def add(chunk: str):
        nonlocal linked
        if chunk:
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            text.append(chunk)
            linked += len(chunk) if link else 0

    n = len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                text.append(m.group()[9:].removesuffix("]]>"))
            continue
        closing, attributes = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if tag == "a":
            link = 0 if closing else 1
        if tag in RAW and not closing:
            if not attributes.endswith("/") or tag in TO_THE_END:
                ending = None
                if tag not in unclosed:
                    ending = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                if ending:
                    at = ending.end()
                elif tag in TO_THE_END:
                    at = n
                else:
                    # one search to the end for all start tags without an end tag
                    unclosed.add(tag)
            if tag == "title":
                yield from flush()
            continue
        if tag not in BLOCKS:
            continue
        yield from flush()
        link = 0
        if closing:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            if stack and stack[-1][0] == "p":
                stack.pop()
            if ended := ENDS.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ended:
                        del stack[k:]
                        break
                    if stack[k][0] in ("ul", "ol", "dl", "table", "select", "html"):
                        break
            if not attributes.rstrip().endswith("/") or tag not in ("div", "p"):
                stack.append((tag, _names(tag, attributes)))
    yield from flush()


# Words of class and id attributes, by what they stand for.
KEPT_WORDS = ["content", "post", "entry", "article", "story", "text", "body", "main", "page", "document"]
PART_WORDS = {
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "topbar", "links", "tabs"],
    "header": ["header", "masthead", "banner", "site", "logo", "top", "head"],
    "footer": ["footer", "foot", "bottom", "copyright", "legal", "colophon", "site"],
    "side": ["sidebar", "side", "aside", "widget", "related", "recommended", "popular", "trending", "tags", "more"],
    "notice": ["cookie", "notice", "consent", "alert", "modal", "popup", "gdpr", "overlay", "message", "warning"],
    "advert": ["ad", "ads", "advert", "sponsor", "sponsored", "promo", "promotion", "advertisement", "banner"],
    "form": ["form", "search", "login", "newsletter", "subscribe", "signup", "contact"],
    "comments": ["comments", "comment", "reply", "replies", "discussion", "disqus", "respond", "reader", "responses"],
    "share": ["share", "social", "buttons", "meta", "byline", "author", "tools"],
}
PART_OF = {"." + word: kind for kind, words in PART_WORDS.items() for word in words}
KEPT_OF = frozenset("." + word for word in KEPT_WORDS)


def _text_features(block: Block) -> Iterator[str]:
    text = block.text
    n = len(text)
    yield f"size {min(n.bit_length(), 10)}"
    yield f"links {block.linked * 4 // n}"
    yield f"end {text[-1] if text[-1] in '.!?:;,' else 'other'}"
    yield f"words {min(text.count(' ') // 4, 6)}"
    if text[0] in "©&" or "©" in text[:40]:
        yield "sign"
    if "|" in text or "·" in text or "»" in text or "›" in text:
        yield "separator"


def features(found: list[Block]) -> list[list[str]]:
    """Features of each block: ancestors, the nearest tag, its text, and its place in the page."""
    out = []
    whole = {f for block in found for f in block.path}
    outer = [f for f in ("article", "main", ".main", ".content") if f in whole][:1]
    for k, block in enumerate(found):
        path = block.path
        own = [f"in {f}" for f in set(path)]
        own += [f"part {PART_OF[f]}" for f in set(path) if f in PART_OF]
        marked = [f for f in path if f in PART_OF or f in KEPT_OF]
        own.append(f"nearest {'kept' if marked[-1] in KEPT_OF else 'part'}" if marked else "unmarked")
        own += [f"{'within' if f in path else 'beside'} {f}" for f in outer]
        tags = [f for f in path if f[0] != "."]
        last = tags[-1] if tags else "none"
        own += [f"tag {last}", f"pair {'>'.join(tags[-2:])}"]
        own += [f"{last} {f}" for f in _text_features(block)]
        own += _text_features(block)
        own.append(f"first {k}" if k < 2 else f"last {len(found) - k}" if len(found) - k < 3 else "inside")
        same = k and path == found[k - 1].path
        own.append("as before" if same else "new place")
        out.append(own)
    return out


@dataclass
class PageModel:
    """Weights of the features for "kept" against "left out", and of the transitions."""

    weights: dict[str, float]
    transitions: list[list[float]]

    def decode(self, found: list[Block]) -> list[bool]:
        """The likeliest labels of a page's blocks (Viterbi)."""
        get, moves = self.weights.get, self.transitions
        score, back = (0.0, 0.0), []
        for k, own in enumerate(features(found)):
            kept = sum([get(f, 0.0) for f in own])
            if not k:
                score = (moves[2][0], moves[2][1] + kept)
                continue
            left = (score[0] + moves[0][0], score[1] + moves[1][0])
            right = (score[0] + moves[0][1], score[1] + moves[1][1])
            back.append((left[1] > left[0], right[1] > right[0]))
            score = (max(left), max(right) + kept)
        if not found:
            return []
        label = score[1] > score[0]
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[list[Block], list[bool]]], rounds: int = 120, ridge: float = 0.01) -> PageModel:
    """Train the field by the gradient of the log-likelihood, over all pages at once."""
    pages = [(b, y) for b, y in pages if b]
    names: dict[str, int] = {}
    rows, columns, lengths = [], [], [len(b) for b, _ in pages]
    place = 0
    for found, _ in pages:
        for own in features(found):
            columns += [names.setdefault(f, len(names)) for f in own]
            rows += [place] * len(own)
            place += 1
    rows, columns = np.array(rows), np.array(columns)
    longest, n = max(lengths), len(pages)
    start = np.cumsum([0, *lengths[:-1]])
    mask = np.arange(longest) < np.array(lengths)[:, None]
    slot = np.where(mask, start[:, None] + np.arange(longest), 0)
    gold = np.concatenate([np.array(y, float) for _, y in pages])
    truth = np.where(mask, gold[slot], 0).astype(int)
    weights, moves = np.zeros(len(names)), np.zeros((3, 2))
    squares, move_squares = np.full(len(names), 1e-6), np.full((3, 2), 1e-6)
    for _ in range(rounds):
        kept = np.bincount(rows, weights[columns], place)
        emit = np.zeros((n, longest, 2))
        emit[:, :, 1] = np.where(mask, kept[slot], 0)
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = moves[2] + emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves[None, :2], axis=1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        expected_moves = np.zeros((3, 2))
        for t in range(longest - 1, 0, -1):
            ahead = emit[:, t] + backward[:, t]
            joint = forward[:, t - 1, :, None] + moves[None, :2] + ahead[:, None, :] - total[:, None, None]
            expected_moves[:2] += np.exp(joint[mask[:, t]]).sum(0)
            step = np.logaddexp.reduce(moves[None, :2] + ahead[:, None, :], axis=2)
            backward[:, t - 1] = np.where(mask[:, t, None], step, 0)
        beliefs = np.exp(forward + backward - total[:, None, None])
        expected_moves[2] = beliefs[:, 0].sum(0)
        seen = np.zeros((3, 2))
        np.add.at(seen[2], truth[:, 0], 1)
        both = mask[:, 1:]
        np.add.at(seen, (truth[:, :-1][both], truth[:, 1:][both]), 1)
        belief = np.zeros(place)
        belief[slot[mask]] = beliefs[:, :, 1][mask]
        slope = np.bincount(columns, (gold - belief)[rows], len(names)) - ridge * weights
        move_slope = seen - expected_moves - ridge * moves
        squares += slope**2
        move_squares += move_slope**2
        weights += 0.4 * slope / np.sqrt(squares)
        moves += 0.4 * move_slope / np.sqrt(move_squares)
    known = {name: float(weights[k]) for name, k in names.items() if abs(weights[k]) > 1e-4}
    return PageModel(known, moves.tolist())


class Layout:
    """Random pages with known labels: the parts of a site around an article, in many markups."""

    def __init__(self, seed: int, lines: list[str]):
        self.pick = random.Random(seed)
        self.lines = lines or ["Some words of a line.", "More."]

    def words(self, least: int, most: int) -> str:
        line = self.pick.choice(self.lines).split()
        n = self.pick.randint(least, most)
        while len(line) < n:
            line += self.pick.choice(self.lines).split() or ["word"]
        return html.escape(" ".join(line[:n]))

    def line(self) -> str:
        return html.escape(self.pick.choice(self.lines))

    def paragraph(self) -> str:
        """A line, sometimes a few words of one, or words between bars."""
        chance = self.pick.random()
        if chance < 0.8:
            return self.line()
        words = self.words(1, 9)
        return words if chance < 0.9 else words.replace(" ", " | ") + self.pick.choice(["", " |", "."])

    def mark(self, kind: str) -> str:
        """Class or id attribute with a word of the kind, or none."""
        word = self.pick.choice(KEPT_WORDS if kind == "kept" else PART_WORDS[kind])
        form = self.pick.choice(["{}", "{}", "{}-box", "site-{}", "{}-1", "js-{}", "block {}", "{}-list", "{}-slot", "{}-wrap"])
        return self.pick.choice([' class="{}"', ' id="{}"', " class='{}'"]).format(form.format(word))

    def open(self, kind: str, tags: list[str]) -> tuple[str, str]:
        tag = self.pick.choice(tags)
        # A tag that says nothing by itself always gets a word.
        marked = tag in ("div", "section", "ul", "p", "table") or self.pick.random() < 0.4
        return f"<{tag}{self.mark(kind) if marked else ''}>", f"</{tag}>"

    def links(self) -> str:
        items = [f'<a href="/{k}">{self.words(1, 3)}</a>' for k in range(self.pick.randint(3, 8))]
        form = self.pick.choice(["<ul>{}</ul>", "{}", "<ol>{}</ol>"])
        return form.format("".join(f"<li>{i}</li>" for i in items) if form != "{}" else " | ".join(items))

    def part(self, kind: str) -> str:
        begin, end = self.open(kind, {
            "menu": ["nav", "nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "footer", "div"],
            "side": ["aside", "div", "section"], "notice": ["div", "section", "dialog"], "advert": ["div", "div", "aside", "p"],
            "form": ["form", "form", "div"], "comments": ["section", "div", "ul"], "share": ["div", "p", "ul"],
        }[kind])
        few = "".join(f"<p>{self.words(2, 14)}</p>" for _ in range(self.pick.randint(1, 3)))
        body = {
            "menu": self.links,
            "header": lambda: self.pick.choice(["<h1>{}</h1>", "<div>{}</div>", "<a href='/'>{}</a>"]).format(self.words(1, 5))
            + self.pick.choice(["", f"<p>{self.words(2, 8)}</p>", self.links()]),
            "footer": lambda: self.pick.choice(["&copy; ", "Copyright &copy; ", ""]) + self.words(3, 16)
            + self.pick.choice(["", self.links(), f" &middot; {self.words(3, 12)}"]),
            "side": lambda: f"<h3>{self.words(1, 4)}</h3>" + self.pick.choice([self.links(), few, f"<p>{self.line()}</p>"]),
            "notice": lambda: self.pick.choice([few, self.words(4, 30)]) + "<button>OK</button>",
            "advert": lambda: self.pick.choice([few, self.words(3, 20), f"<a href='/x'>{self.words(3, 10)}</a>"]),
            "form": lambda: f"<label>{self.words(1, 4)}</label><input name='q'>"
            + self.pick.choice(["", f"<p>{self.words(3, 14)}</p>", f"<select><option>{self.words(1, 2)}</option></select>"])
            + f"<button>{self.words(1, 2)}</button>",
            "comments": lambda: f"<h3>{self.words(1, 3)}</h3>"
            + "".join(
                self.pick.choice(["<div class='comment'><b>{0}</b><p>{1}</p></div>", "<li><p>{1}</p></li>", "<p>{1}</p>"])
                .format(self.words(1, 2), self.line()) for _ in range(self.pick.randint(1, 5))
            ),
            "share": lambda: self.pick.choice([self.links(), self.words(1, 5)]),
        }[kind]()
        return begin + body + end

    def article(self) -> list[tuple[str, bool]]:
        """Pieces of the article with their labels; adverts and such may stand between paragraphs."""
        title = self.pick.choice(["<h1>{}</h1>"] * 5 + ["<header><h1>{}</h1></header>", "<h2>{}</h2>", ""])
        pieces = [(title.format(self.words(2, 9)), True)]
        wrap = self.pick.choice(["<p>{}</p>"] * 5 + ["<p><b>{}<br>", "<div>{}</div>", "{}<br>"])
        for _ in range(self.pick.randint(1, 12)):
            chance = self.pick.random()
            if chance < 0.12:
                pieces.append((self.part(self.pick.choice(["advert", "advert", "share", "side", "form", "notice"])), False))
            elif chance < 0.17:
                pieces.append((f"<h2>{self.words(1, 7)}</h2>", True))
            elif chance < 0.22:
                items = "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(self.pick.randint(2, 6)))
                pieces.append((f"<ul>{items}</ul>", True))
            elif chance < 0.27:
                form = self.pick.choice(["<blockquote><p>{}</p></blockquote>", "<pre>{}</pre>", "<figcaption>{}</figcaption>",
                                         "<table><tr><td>{}</td></tr></table>"])
                pieces.append((form.format(self.line()), True))
            else:
                form = self.pick.choice([wrap] * 4 + ["<p><b>{}<br>", "<p>{} <a href='/y'>more</a> here.</p>", "<p>{}</p>"])
                pieces.append((form.format(self.paragraph()), True))
        return pieces

    def page(self) -> list[tuple[str, bool]]:
        """Pieces of a page; the label of a piece holds for the blocks in it."""
        pick = self.pick
        before = [k for k in ("notice", "header", "menu", "advert", "form") if pick.random() < 0.5]
        pick.shuffle(before)
        after = [k for k in ("share", "comments", "side", "form", "advert", "notice") if pick.random() < 0.35]
        pick.shuffle(after)
        begin, end = pick.choice([
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
            (f"<div{self.mark('kept')}>", "</div>"), (f"<div id='page'><div{self.mark('kept')}>", "</div></div>"),
            (f"<section{self.mark('kept')}>", "</section>"), (f"<table><tr><td{self.mark('kept')}>", "</td></tr></table>"),
            ("<div role='main'>", "</div>"), ("", ""), ("<div>", "</div>"),
        ])
        within = [(self.part(k), False) for k in ("share", "comments", "advert", "side") if pick.random() < 0.12]
        pieces = [("<html><head><title>x</title></head><body>", False)]
        pieces += [(self.part(k), False) for k in before]
        pieces += [(begin, False), *self.article(), *within, (end, False)]
        pieces += [(self.part(k), False) for k in after]
        if pick.random() < 0.85:
            pieces.append((self.part("footer"), False))
        return pieces


def labelled_page(pieces: list[tuple[str, bool]]) -> tuple[str, list[Block], list[bool]]:
    """A page with its blocks and their labels: the blocks that are gone without a piece have its label."""
    whole, labels = "".join(p for p, _ in pieces), []
    before = ""
    for piece, kept in pieces:
        before += piece
        labels += [kept] * (len(list(blocks(before))) - len(labels))
    found = list(blocks(whole))
    return whole, found, labels[: len(found)]


def train_page_model(pages: DataFrame, n_pages: int = TRAINING_PAGES, text_pages: int = TEXT_PAGES) -> PageModel:
    """A field trained on labelled pages, whose text comes from about ``text_pages`` pages of the table.

    The labels come from the layouts that the pages are put in, not from the table.
    """
    n = pages.count()
    chosen = pages.select("html").where(
        draw(F.lit(1), F.col("page_id").cast("string")) * F.lit(max(n, 1)) < F.lit(float(text_pages))
    )
    lines = sorted({b.text[:600] for (page,) in chosen.limit(2 * text_pages).collect() for b in blocks(page) if b.text.count(" ") > 1})
    made = [labelled_page(Layout(k, lines).page()) for k in range(n_pages)]
    return fit([(found, labels) for _, found, labels in made])


def extract(page: str | None, model: PageModel) -> str:
    """The main text: kept blocks, one a line. Blocks that a page hides are no part of it."""
    found = [b for b in blocks(page) if "hidden!" not in b.path]
    return "\n".join(b.text for b, kept in zip(found, model.decode(found)) if kept)


def main_text(pages: DataFrame, model: PageModel) -> DataFrame:
    """Main text of every page.

    Returns one row per input row: page_id, url, text, n_chars (code points).
    Nulls and edges: null and empty pages, and pages without a kept block, have an
    empty text; ids and addresses may be null or repeated; broken markup is read as
    far as it goes. Further columns, also ones named like the result's, are not
    read. An empty table gives no rows.
    """
    weights, transitions = model.weights, model.transitions
    shared = pages.sparkSession.sparkContext.broadcast((weights, transitions))

    def run(batch):
        own = PageModel(*shared.value)
        texts = [extract(page, own) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(
        pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars long"
    )
