"""Main text of web pages by wrappers inferred from the token streams of a host.

1. Every page becomes a stream of tags and text slots. Neighbouring repeats are folded into repeated groups
   at once, so pages of one template give few distinct streams; they are counted per host together with
   the text under every path.
2. The distinct streams of a host are aligned one after another to a union-free regular expression, the
   wrapper: what only one side has becomes an optional group, neighbouring repeats a repeated one, text a
   slot. A host with many streams is aligned in parts first; the parts' wrappers are aligned last.
   A block of text that at least three different pages of the host and half of those with text in the same
   place hold verbatim, headings apart, enters the stream with its key instead of a slot. Where the wrapper
   has it outside repeated groups, it is template text and no page's own; inside it stays data.
3. Every page is read again, whole, and its data slots are told apart: those under navigation, adverts, comments
   and the like are left out. Parts that only a class or id name, a form or a header marks are kept where an
   article is in them, or nearly all text of the page. Of what is left the page's own article or main elements
   are kept, and all of it where they have little or no text. So a page's text never depends on where other
   pages of its host keep theirs.

The labels in streams and wrappers have only the class and id words that at least half of the pages of the
host share; slugs, ids and categories of single pages do not make a template of their own.
"""

from __future__ import annotations

import ast
import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.tables import stored

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea|title)\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<[/a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[/!?a-zA-Z][^>]*+>",
    re.S | re.I,
)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>=/])|aria-hidden\s*=\s*["']?true)""", re.I)
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINER = frozenset("html body main article section div nav header footer aside form table ul ol dl fieldset figure center".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
NOISE_TAG = frozenset("head nav footer aside button select dialog menu object audio video canvas".split())
# Forms and headers of a page: they give way to an article in them, or to the bulk of the text.
WEAK_TAG = frozenset("header form".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
# Words of class and id names that mark parts outside the article; those of reader comments and links to other
# articles hide an article in them too.
FOREIGN_WORD = frozenset("related recommended comment comments reply replies discussion disqus".split())
NOISE_WORD = FOREIGN_WORD | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay"
    " newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs pagination sidebar sidebars aside widget widgets"
    " share sharing social footer header masthead toolbar skip".split()
)
# Words that leave a name what it is: "cookie-bar" is a notice, "has-sidebar" and "related-work" are not what they name.
LAYOUT_WORD = frozenset(
    "area bar block body bottom box button buttons column container content form global group icon icons inner item items link links list main mobile outer panel"
    " placeholder primary right left row secondary section site slot thread top unit user wrap wrapper".split()
)
ARTICLE_WORD = frozenset("article articles entry post posts story stories page".split())
HEADER_WORD = frozenset("header masthead footer".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 dt th caption figcaption legend summary".split())
# Blocks are not broken by these, but their text is left out.
INLINE_NOISE = frozenset("button select object audio video canvas".split())
ARTICLE = frozenset("article main".split())
SPLIT_WORDS = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
MAX_FOLD = 16
PART_STREAMS = 200
TEXT = "#"
SAME = "="
WORDS = re.compile(r"\.[^/]*")
# A text is compared as template text where so many different pages of the host hold it in one place.
LEAST_SAME = 3
# What is hidden for its name only is shown where it is so many times the text that is left, and the text outside
# the articles of a page where that is so many times theirs.
BULK = 4


def noise_kind(name: str) -> str:
    """"!" for a class or id name of parts foreign to the page's article, "~" for other parts outside it, else "".

    All words of the name must be noise or layout; words of articles may stand by any noise but headers.
    """
    words = [w.lower() for w in SPLIT_WORDS.split(name) if w]
    noise = NOISE_WORD.intersection(words)
    others = [w for w in words if w not in NOISE_WORD and w not in LAYOUT_WORD and len(w) > 2]
    if not noise or any(w not in ARTICLE_WORD for w in others) or others and noise <= HEADER_WORD:
        return ""
    return "!" if noise & FOREIGN_WORD else "~"


class Tag:
    """What the reader needs to know of a tag, kept per distinct tag text."""

    __slots__ = ("name", "closes", "words", "noise", "article", "void")

    def __init__(self, text: str):
        found = NAME.match(text)
        self.name = found[1].lower() if found else ""
        self.closes = text.startswith("</")
        self.void = self.name in VOID or text.endswith("/>") and self.name not in CONTAINER
        words, roles, marks = [], [], ""
        if not self.closes and "=" in text:
            for kind, *values in ATTRIBUTE.findall(text):
                for name in "".join(values).split():
                    own = [w.lower() for w in SPLIT_WORDS.split(name) if w]
                    (roles if kind.lower() == "role" else words).extend(own)
                    marks += noise_kind(name) if kind.lower() != "role" else ""
        self.words = frozenset(words)
        self.article = self.name in ARTICLE or "main" in roles or "article" in roles
        self.noise = ""  # "!": left out; "~": left out unless the article or the bulk of the text is in it
        if not self.closes and self.name not in ("html", "body"):
            if self.name in NOISE_TAG or not NOISE_ROLE.isdisjoint(roles) or "!" in marks or HIDDEN.search(text):
                self.noise = "!"
            elif self.name in WEAK_TAG or marks:
                self.noise = "~"
        if self.article and self.noise == "~":
            self.noise = ""


class Reader:
    """Walks over pages; gives the stream, the path of every text, and block borders.

    Labels have the class and id words in ``shared`` only.
    """

    def __init__(self):
        self.known: dict[str, Tag] = {}
        self.shared: frozenset[str] = frozenset()

    def tag(self, text: str) -> Tag:
        found = self.known.get(text)
        if found is None:
            if len(self.known) > 50_000:
                self.known.clear()
            found = self.known[text] = Tag(text)
        return found

    def label(self, tag: Tag) -> str:
        own = tag.words & self.shared if tag.words else tag.words
        return ".".join([tag.name, *sorted(own)]) if own else tag.name

    def words(self, page: str) -> set[str]:
        """Class and id words of the page."""
        own: set[str] = set()
        for found in TAG.finditer(page):
            if "=" in found[0] and not found[1]:
                own.update(self.tag(found[0]).words)
        return own

    def events(self, page: str) -> Iterator[tuple[str, str, str]]:
        """(kind, label or text, path): kind is tag, block or text. A path joins the containers, noise marked by '!' or
        '~', articles by '*'."""
        stack: list[tuple[str, str]] = []  # name, path below it
        path, at = "", 0
        for found in TAG.finditer(page):
            if found.start() > at:
                yield TEXT, page[at : found.start()], path
            at = found.end()
            content = found[0]
            if found[1]:
                if found[1].lower() != "svg":
                    yield "block" if found[1].lower() != "textarea" else "tag", found[1].lower(), path
                continue
            tag = self.tag(content)
            if not tag.name:
                continue
            kind = "tag" if tag.name in INLINE or tag.name in INLINE_NOISE else "block"
            label = self.label(tag)
            if tag.closes:
                depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == tag.name), -1)
                if depth >= 0:
                    del stack[depth:]
                path = stack[-1][1] if stack else ""
            else:
                closed = "p" if tag.name in ENDS_PARAGRAPH else tag.name if tag.name in ("li", "dt", "dd", "tr", "td", "th", "option") else ""
                if closed:
                    for d in range(len(stack) - 1, -1, -1):
                        if stack[d][0] == closed:
                            del stack[d:]
                            break
                        if stack[d][0] in CONTAINER:
                            break
                path = stack[-1][1] if stack else ""
                if not tag.void:
                    if tag.name in CONTAINER or tag.noise or tag.article:
                        noise = "" if tag.name == "header" and tag.noise == "~" and "/*" in path else tag.noise
                        mark = noise or ("*" if tag.article else "")
                        path = f"{path}/{mark}{label}"
                    stack.append((tag.name, path))
            yield kind, ("/" if tag.closes else "") + label, path
        if at < len(page):
            yield TEXT, page[at:], path


def fold(items: list) -> list:
    """Neighbouring equal runs of up to MAX_FOLD items as repeated groups ('+', run)."""
    out: list = []
    for item in items:
        out.append(item)
        again = True
        while again:
            again = False
            for n in range(1, min(MAX_FOLD, len(out) - 1) + 1):
                if n < len(out) and isinstance(out[-1 - n], tuple) and out[-1 - n][0] == "+" and list(out[-1 - n][1]) == out[-n:]:
                    del out[-n:]
                    again = True
                    break
                if 2 * n <= len(out) and out[-1] == out[-1 - n] and out[-n:] == out[-2 * n : -n]:
                    run = tuple(out[-n:])
                    del out[-2 * n :]
                    out.append(run[0] if n == 1 and isinstance(run[0], tuple) else ("+", run))
                    again = True
                    break
    return out


def joined(pieces: list[str]) -> str:
    return SPACE.sub(" ", entities.unescape("".join(pieces))).strip()


def block_key(path: str, text: str) -> str:
    """A block's text and place: the containers without their class and id words."""
    return hashlib.blake2b(f"{WORDS.sub('', path)}\n{text}".encode("utf-8", "replace"), digest_size=8).hexdigest()


def _hidden_by(path: str, opened: set[str]) -> str:
    """"!", or the path of the outermost container that hides this one for its name only, or "" if it is shown."""
    if "/!" in path:
        return "!"
    at = path.find("/~", max(path.rfind("/*"), 0))
    while at >= 0:
        end = path.find("/", at + 1)
        whole = path if end < 0 else path[:end]
        if whole not in opened:
            return whole
        at = path.find("/~", at + 1)
    return ""


def shown_paths(events: list[tuple[str, str, str]]) -> set[str]:
    """The paths whose text belongs to the page."""
    sizes: dict[str, int] = {}
    for kind, value, path in events:
        if kind == TEXT:
            sizes[path] = sizes.get(path, 0) + len(value.strip())
    opened: set[str] = set()
    while True:
        by: dict[str, int] = {}
        for path, size in sizes.items():
            by[hider] = by.get(hider := _hidden_by(path, opened), 0) + size
        weak = max((h for h in by if h not in ("", "!")), key=lambda h: (by[h], h), default=None)
        if weak is None or by[weak] <= BULK * by.get("", 0):
            return {path for path in sizes if not _hidden_by(path, opened)}
        opened.add(weak)


def clean_blocks(events: list[tuple[str, str, str]]) -> Iterator[tuple[str, str, str, bool]]:
    """(path, text in articles, text, whether it is a heading) of the blocks of the page's own parts."""
    shown = shown_paths(events)
    block: list[tuple[bool, str]] = []
    at, heading = "", False
    for kind, value, path in events:
        if kind == TEXT:
            if path in shown:
                at = at if block else path
                block.append(("/*" in path, value))
        elif kind == "block":
            if block and (text := joined([v for _, v in block])):
                yield at, joined([v for article, v in block if article]), text, heading
            block.clear()
            heading = value.split(".")[0] in HEADING
        elif value == "br" and block:
            block.append((block[-1][0], " "))
    if block and (text := joined([v for _, v in block])):
        yield at, joined([v for article, v in block if article]), text, heading


def stream(reader: Reader, page: str, same: frozenset[str] = frozenset()) -> list:
    """The folded stream of a page; the slots of blocks in ``same`` hold their text's key."""
    items: list = []
    block: list[str] = []
    slots: list[int] = []
    at = ""

    def close():
        if same and block and (key := block_key(at, joined(block))) in same:
            for k in slots:
                items[k] = f"{SAME}{key}"
        block.clear(), slots.clear()

    events = list(reader.events(page))
    shown = shown_paths(events)
    for kind, value, path in events:
        if kind == "block":
            close()
        if kind != TEXT:
            items.append(value)
            if value == "br" and block:
                block.append(" ")
            continue
        if path in shown:
            at = at if block else path
            block.append(value)
        if value.strip() and (not items or items[-1] != f"{TEXT}{path}"):
            items.append(f"{TEXT}{path}")
            if path in shown:
                slots.append(len(items) - 1)
    close()
    return fold(items)


def align(a: list, b: list) -> list:
    """A wrapper that both read: the common items in order, the rest optional, item by item."""
    bodies = sorted({item[1] for item in (*a, *b) if isinstance(item, tuple) and len(item[1]) > 1}, key=lambda x: (-len(x), repr(x)))
    a, b = _wrapped(a, bodies), _wrapped(b, bodies)
    n, m = len(a), len(b)
    best = CommonItems(a, b)
    out, i, j = [], 0, 0
    left: list = []
    right: list = []

    def close():
        for rest in (left, right):
            out.extend(("*" if isinstance(item, tuple) and item[0] in "+*" else "?", _body(item)) for item in rest)
            rest.clear()

    while i < n or j < m:
        if i < n and j < m and _same(a[i], b[j]):
            close()
            out.append(_joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best.row(i + 1)[j] >= best.row(i)[j + 1]:
            left.append(a[i])
            i += 1
        else:
            right.append(b[j])
            j += 1
    close()
    return _tidy(out)


class CommonItems:
    """How many items the rest of two streams have in common in order, row by row from the first stream's end.

    Only every ``step``-th row is kept, about the square root of their number; the rows between two of those are
    made again when the alignment comes to them, so memory grows with the 1.5th power of a stream's length.
    """

    def __init__(self, a: list, b: list):
        number: dict[tuple, int] = {}
        self.a, self.b = (np.array([number.setdefault(_body(x), len(number)) for x in items], np.int64) for items in (a, b))
        self.step = max(1, int(len(a) ** 0.5))
        self.kept = {len(a): np.zeros(len(b) + 1, np.int32)}
        below = self.kept[len(a)]
        for i in range(len(a) - 1, -1, -1):
            below = self._above(i, below)
            if i % self.step == 0:
                self.kept[i] = below
        self.some: dict[int, np.ndarray] = {}

    def _above(self, i: int, below: np.ndarray) -> np.ndarray:
        row = below.copy()
        row[:-1] = np.where(self.b == self.a[i], below[1:] + 1, below[:-1])
        return np.maximum.accumulate(row[::-1])[::-1]

    def row(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        if i not in self.some:
            low = i - i % self.step
            high = min(low + self.step, len(self.a))
            below = self.kept[high]
            self.some = {}
            for k in range(high - 1, low, -1):
                below = self.some[k] = self._above(k, below)
        return self.some[i]


def _wrapped(items: list, bodies: list[tuple]) -> list:
    """Single runs of what is repeated elsewhere as repeated groups, so that they meet those."""
    for body in bodies:
        out: list = []
        for item in items:
            out.append(item)
            if len(out) >= len(body) and tuple(out[-len(body) :]) == body:
                out[-len(body) :] = [("+", body)]
        items = _tidy(out)
    return items


def _body(item) -> tuple:
    return item[1] if isinstance(item, tuple) else (item,)


def _same(x, y) -> bool:
    """Equal, or a group and what it repeats or leaves out."""
    return x == y or (isinstance(x, tuple) or isinstance(y, tuple)) and _body(x) == _body(y)


def _joined(x, y):
    kinds = {item[0] if isinstance(item, tuple) else "" for item in (x, y)}
    kinds.discard("")
    if not kinds:
        return x
    return ("?" if kinds == {"?"} else "+" if kinds == {"+"} else "*", _body(x))


def _tidy(items: list) -> list:
    """Drop groups next to a group of the same body: both together are a repeated group."""
    out: list = []
    for item in items:
        if out and isinstance(item, tuple) and _body(out[-1]) == item[1]:
            out[-1] = ("*" if isinstance(out[-1], tuple) and out[-1][0] in "?*" and item[0] in "?*" else "+", item[1])
        else:
            out.append(item)
    return out


def wrapper_text(wrapper: list) -> str:
    """The wrapper written as a regular expression over tags and slots."""
    parts = []
    for item in wrapper:
        if isinstance(item, tuple):
            parts.append(f"({wrapper_text(list(item[1]))}){item[0]}")
        else:
            parts.append(TEXT if item.startswith(TEXT) else item if item.startswith(SAME) else f"<{item}>")
    return " ".join(parts)


def template_texts(wrapper: list) -> list[str]:
    """Keys of the texts that stand in the wrapper outside its repeated groups; in those they are data."""
    found: dict[bool, set[str]] = {True: set(), False: set()}

    def walk(items, repeated: bool):
        for item in items:
            if isinstance(item, tuple):
                walk(item[1], repeated or item[0] in "+*")
            elif item.startswith(SAME):
                found[repeated].add(item[1:])

    walk(wrapper, False)
    return sorted(found[False] - found[True])


def infer(streams: list[list]) -> list:
    wrapper: list = []
    for number, own in enumerate(streams):
        wrapper = align(wrapper, own) if number else own
    return wrapper


def main_text(reader: Reader, page: str, template: frozenset[str] = frozenset()) -> str:
    """Text of the page's data slots: white space of a block as one blank, blocks in page order, one line each.

    A page with more template text than text of its own is a near copy of others and stays whole.
    """
    blocks = list(clean_blocks(list(reader.events(page))))
    texts = [(path, article, text) for path, article, text, _ in blocks if article]
    if BULK * sum(len(article) for _, article, _ in texts) < sum(len(text) - len(article) for _, article, text, _ in blocks):
        texts = [(path, text, text) for path, _, text, _ in blocks]
    own = [article for path, article, text in texts if not template or block_key(path, text) not in template]
    if 2 * sum(map(len, own)) < sum(len(article) for _, article, _ in texts):
        own = [article for _, article, _ in texts]
    return "\n".join(own)


def _page_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        rows: set[tuple[str, str, str, str]] = set()
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            # The empty value counts the pages of the host and of the place.
            whole = hashlib.blake2b(page.encode("utf-8", "replace"), digest_size=8).hexdigest()
            rows.update((host, "", word, whole) for word in ("", *reader.words(page)))
            blocks = [(WORDS.sub("", path), block_key(path, text), heading) for path, _, text, heading in clean_blocks(list(reader.events(page)))]
            own = hashlib.blake2b("".join(key for _, key, _ in blocks).encode(), digest_size=8).hexdigest()
            # A heading is the article's own, also where all articles have it.
            rows.update((host, place, value, own) for place, key, heading in blocks if not heading for value in ("", key))
        names = ["host", "place", "value", "page"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=names)


def host_marks(pages: DataFrame) -> DataFrame:
    """(host, words, same) from a frame (host, html), repeated pages counted once.

    ``words``: class and id words on at least half of the pages of the host. ``same``: keys of the texts on
    LEAST_SAME different pages, and on half of those with text in the same place; headings are left out.
    """
    marks = pages.mapInArrow(_page_marks, "host string, place string, value string, page string").distinct()
    counted = stored(marks.groupBy("host", "place", "value").agg(F.count("*").alias("n")), "marks")
    total = counted.where("value = ''").select("host", "place", F.col("n").alias("pages"))
    held = counted.where((F.col("place") == "") | (F.col("value") == "") | (F.col("n") >= LEAST_SAME)).join(total, ["host", "place"])
    value = F.when((F.col("value") != "") & (2 * F.col("n") >= F.col("pages")), F.col("value"))
    return held.groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(F.col("place") == "", value))).alias("words"), F.array_sort(F.collect_list(F.when(F.col("place") != "", value))).alias("same")
    )


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        texts = []
        for page, words, same in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            reader.shared = frozenset(words or ())
            texts.append(repr(stream(reader, page, frozenset(same or ()))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["host", "stream"])


def _wrappers(group: pa.Table) -> pa.Table:
    host = group["host"][0].as_py()
    shapes = sorted(set(group["stream"].to_pylist()), key=lambda s: (-len(s), s))
    return pa.table({"host": pa.array([host], pa.string()), "wrapper": pa.array([repr(infer([_parsed(s) for s in shapes]))], pa.string())})


def _parsed(shape: str) -> list:
    return ast.literal_eval(shape)


def _whole_wrapper(group: pa.Table) -> pa.Table:
    host = group["host"][0].as_py()
    wrapper = infer([_parsed(s) for s in sorted(set(group["wrapper"].to_pylist()), key=lambda s: (-len(s), s))])
    return pa.table(
        {"host": pa.array([host], pa.string()), "wrapper": pa.array([wrapper_text(wrapper)], pa.string()), "template": pa.array([template_texts(wrapper)], pa.list_(pa.string()))}
    )


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, template) from a frame (host, html); ``template`` has the keys of the template texts."""
    known = pages.join(host_marks(pages), "host", "left").select("host", "html", "words", "same")
    shapes = stored(known.mapInArrow(_streams, "host string, stream string").distinct(), "streams")
    many = shapes.groupBy("host").agg(F.ceil(F.count("*") / PART_STREAMS).alias("parts"))
    shapes = shapes.join(many, "host").withColumn("part", F.pmod(F.xxhash64("stream"), F.col("parts")))
    wrappers = shapes.groupBy("host", "part").applyInArrow(_wrappers, "host string, wrapper string")
    return wrappers.groupBy("host").applyInArrow(_whole_wrapper, "host string, wrapper string, template array<string>")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        texts = [main_text(reader, page, frozenset(template or ())) for page, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages`` (page_id, url, html).

    A null html is empty, an empty page gives an empty text. Pages without a host in their url, or without
    url, share one wrapper. Rows with null ids and repeated rows are read like any other. Streams are aligned
    longest first, ties by their text, so the wrapper does not depend on the order of the rows. An empty
    table gives an empty result; other columns are not read.
    """
    host = F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.lower(host).alias("host")
    )
    rules = stored(host_wrappers(rows.select("host", "html")), "wrappers")
    known = rows.join(rules.select("host", "template"), "host", "left")
    texts = known.select("page_id", "url", "html", "template").mapInArrow(_texts, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
