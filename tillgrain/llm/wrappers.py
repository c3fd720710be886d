"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a sequence of tags and text slots. Runs that repeat next to each other fold into one
repeated group. Sequences of one host are aligned one after the other: where they agree the
wrapper keeps its parts, what only one of them has becomes optional, and text becomes a slot.
Slots carry the region they lie in (inside or outside the article, or in a menu, header, footer,
side bar, notice, advert, form or reader comment), known from element names, roles and classes. On
pages that mark no article, blocks whose slots have one and the same text on several different
pages and blocks made mostly of links are boilerplate; the others are content.

A page that marks an article keeps the texts in it, without its host's wrapper; the text of another
page is what its tokens put in the content slots of the wrapper. Blocks are joined by empty lines in
page order.

Distinct sequences of a host are merged in two steps, first in ``SHARES`` shares per host and then
together, so a host with a third of all pages does not meet in one task. Pages are joined to the
wrappers by host, as a broadcast where Spark measures them as small, else by a shuffle join whose
hot keys Spark splits.

Defined cases: NULL and empty html give an empty text; a NULL or odd address is a host of its own;
html of any kind is read, with unclosed and misplaced tags; repeated rows stay rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.language import host_of
from tillgrain.llm.rows import append_columns, as_bytes, map_texts, stored, text_of

#: Parts of a host's distinct sequences that are merged on their own first.
SHARES = 32
#: Pages of a host, of different contents, that must share a slot's text for it to be boilerplate.
CONSTANT_PAGES = 3
#: Longest run of parts that is looked for as a repeated group.
LONGEST_GROUP = 12

# Elements and words by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre"
    " section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
NOISE_ELEMENTS = frozenset(
    "head script style noscript template iframe svg nav menu footer aside form button select textarea"
    " dialog object".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies disqus footer menu modal nav navbar navigation newsletter notice pager pagination popup"
    " promo related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar"
    " widget".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/)?(?P<name>[A-Za-z][\w:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CLASS = re.compile(r"(?i)\bclass\s*=\s*[\"']?([^\"'>]*)")
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[^a-z0-9]+")

MAIN, PLAIN, NOISE = "main", "plain", "noise"


@dataclass
class Page:
    """Parts of a page in order: tags as labels, texts as slots with their block and region."""

    parts: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    regions: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


def _noise(name: str, rest: str, inside_main: bool) -> bool:
    if name in NOISE_ELEMENTS or (name == "header" and not inside_main):
        return True
    if not rest:
        return False
    for found in _ATTRIBUTE.finditer(rest):
        key = found[1].lower()
        value = (found[2] or found[3] or found[4] or "").lower()
        if key in ("class", "id"):
            words = set(_SPLIT.split(value))
            if words & NOISE_WORDS or ("header" in words and not inside_main):
                return True
        elif key == "role" and value in NOISE_ROLES:
            return True
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def read_page(source: str) -> Page:
    page = Page()
    # Open containers: element, region outside it, whether it is or lies in an article.
    stack: list[tuple[str, str, bool]] = []
    region, inside, links, block, at = PLAIN, False, 0, 0, 0
    size = len(source)

    def text(raw: str) -> None:
        page.parts.append("#a" if links else "#")
        page.texts.append(raw)
        page.regions.append(region)
        page.blocks.append(block)

    while at < size:
        found = _TOKEN.search(source, at)
        end = found.start() if found else size
        if end > at:
            text(source[at:end])
        if not found:
            break
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            block += 1
            links = 0
        if found["close"]:
            if name == "a":
                links = 0
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    region, inside = stack[depth][1], stack[depth][2]
                    del stack[depth:]
                    break
            page.parts.append(f"</{name}>")
        elif name in VOID:
            if name == "br":
                text(" ")
            continue
        else:
            rest = found["rest"].strip()
            if rest.endswith("/") and name not in BLOCKS:
                continue
            if name == "a":
                links = 1
            noise = _noise(name, rest, inside)
            if name in RAW:
                closing = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                if noise or name != "title":
                    at = closing.end() if closing else size
                    continue
            container = name in BLOCKS and name not in ("p", "li", "dt", "dd")
            if container or noise:
                stack.append((name, region, inside))
                if noise:
                    region = NOISE
                elif name in ("article", "main") and region != NOISE:
                    region, inside = MAIN, True
            kind = _CLASS.search(rest) if rest else None
            mark = "." + _DIGITS.sub("0", ".".join(kind[1].lower().split())) if kind else ""
            page.parts.append(f"<{name}{mark}>")
        page.texts.append(None)
        page.regions.append(region)
        page.blocks.append(block)
    return page


# --- Folding and aligning --------------------------------------------------------------------


def labels(page: Page) -> list[str]:
    """Parts with their regions; blank texts are no parts of the sequence."""
    return [f"{r[0]}:{p}" for p, r in zip(page.parts, page.regions)]


def fold(parts: list[str]) -> tuple[list[str], list[int]]:
    """Fold adjacent repeats into groups; also the place of every original part in the result."""
    items, spans = list(parts), [1] * len(parts)
    changed = True
    while changed:
        changed = False
        for size in range(1, LONGEST_GROUP + 1):
            out, widths, i = [], [], 0
            while i < len(items):
                group = items[i : i + size]
                n = 1
                while len(group) == size and items[i + n * size : i + (n + 1) * size] == group:
                    n += 1
                # A group next to its own repetition belongs to it.
                name = f"({' '.join(group)})+"
                if n > 1:
                    out.append(name)
                    widths.append(sum(spans[i : i + n * size]))
                    i += n * size
                    changed = True
                else:
                    out.append(items[i])
                    widths.append(spans[i])
                    i += 1
            items, spans = out, widths
    places, at = [0] * len(parts), 0
    for place, width in enumerate(spans):
        for _ in range(width):
            places[at] = place
            at += 1
    return items, places


def _once(item: str) -> str:
    return item[1:-2] if item.endswith(")+") and item.startswith("(") else item


def alignment(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence of two folded sequences as pairs of places."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(head)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            out.append((head + i, None))
            i += 1
        else:
            out.append((None, head + j))
            j += 1
    return out + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


@dataclass
class Wrapper:
    """Parts of the expression in order; per part whether it may be missing, the pages that had
    it, and for text the hash of its only value so far (None once values differ) with the contents
    of pages that had it, ``CONSTANT_PAGES`` at most; copies of a page are one content."""

    items: list[str] = field(default_factory=list)
    optional: list[bool] = field(default_factory=list)
    pages: list[int] = field(default_factory=list)
    values: list[str | None] = field(default_factory=list)
    contents: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.contents:
            self.contents = [[] for _ in self.items]

    def merged(self, other: Wrapper) -> Wrapper:
        if not self.items:
            return other
        out = Wrapper()
        for i, j in alignment(self.items, other.items):
            one = self if i is not None else other
            at = i if i is not None else j
            out.items.append(one.items[at])
            both = i is not None and j is not None
            out.optional.append(one.optional[at] or not both or other.optional[j])
            out.pages.append(one.pages[at] + (other.pages[j] if both else 0))
            same = not both or one.values[at] == other.values[j]
            out.values.append(one.values[at] if same else None)
            seen = one.contents[at] if same and one.values[at] is not None else []
            if seen and both and other.contents[j] != seen:
                seen = sorted({*seen, *other.contents[j]})[:CONSTANT_PAGES]
            out.contents.append(seen)
        return out

    def content(self) -> list[bool]:
        """Which parts hold content on pages that mark no article: those without constant texts.
        Pages with an article hold theirs in it, whatever other pages of the host do."""
        out = []
        for item, value, seen in zip(self.items, self.values, self.contents):
            constant = value is not None and len(seen) >= CONSTANT_PAGES
            out.append(item.lstrip("(")[:1] == "p" and not constant)
        return out

    def dumped(self) -> str:
        return json.dumps([self.items, self.optional, self.pages, self.values, self.contents], ensure_ascii=False)

    @staticmethod
    def loaded(text: str) -> Wrapper:
        return Wrapper(*json.loads(text))

    def expression(self) -> str:
        return " ".join(f"({x})?" if o else x for x, o in zip(self.items, self.optional))


def _slots(page: Page) -> tuple[list[str], list[int], list[str | None]]:
    """Folded sequence without blank texts, the place of each part of the page (-1: none), and
    the hash of the text at each place."""
    used = [i for i, t in enumerate(page.texts) if t is None or t.strip()]
    all_labels = labels(page)
    items, places = fold([all_labels[i] for i in used])
    at = [-1] * len(page.texts)
    held: list[list[str]] = [[] for _ in items]
    for i, place in zip(used, places):
        at[i] = place
        if page.texts[i] is not None:
            held[place].append(page.texts[i].strip())
    values = [xxhash.xxh64_hexdigest("\n".join(h).encode("utf-8", "replace")) if h else None for h in held]
    return items, at, values


def _wrapper(page: Page, items: list[str], values: list[str | None]) -> Wrapper:
    """Wrapper of one page."""
    texts = [t.strip() for t, r in zip(page.texts, page.regions) if t is not None and r != NOISE]
    own = xxhash.xxh64_hexdigest("\n".join(t for t in texts if t).encode("utf-8", "replace"))
    contents = [[own] if v is not None else [] for v in values]
    return Wrapper(items, [False] * len(items), [1] * len(items), values, contents)


def _kept_blocks(page: Page, at: list[int], content: list[bool]) -> set[int]:
    """Blocks with a text in a content slot and no more than half of their letters in links."""
    held: set[int] = set()
    letters: dict[int, int] = {}
    for part, text, block, place, region in zip(page.parts, page.texts, page.blocks, at, page.regions):
        if place < 0 or text is None or region == NOISE:
            continue
        size = len(text.strip())
        letters[block] = letters.get(block, 0) + (-size if part == "#a" else size)
        if content[place]:
            held.add(block)
    return {b for b in held if letters[b] >= 0}


def extract(source: str, wrapper: Wrapper | None) -> str:
    """Main text of a page by the wrapper of its host."""
    page = read_page(source)
    items, at, values = _slots(page)
    if wrapper is None:
        wrapper = _wrapper(page, items, values)
    roles = wrapper.content()
    # What the wrapper does not know is content.
    content = [True] * len(items)
    for i, j in alignment(wrapper.items, items):
        if j is not None and i is not None:
            content[j] = roles[i]
    marked = any(r == MAIN for r in page.regions)
    kept = set() if marked else _kept_blocks(page, at, content)
    out: list[str] = []
    last = None
    for i, text in enumerate(page.texts):
        if text is None:
            continue
        if page.regions[i] != MAIN if marked else page.regions[i] == NOISE or page.blocks[i] not in kept:
            continue
        if last == page.blocks[i]:
            out[-1] += text
        else:
            out.append(text)
            last = page.blocks[i]
    blocks = (" ".join(entities.unescape(b).split()) for b in out)
    return "\n\n".join(b for b in blocks if b)


# --- Spark ------------------------------------------------------------------------------------

SEQUENCES = [("host", pa.string(), "string"), ("wrapper", pa.string(), "string"), ("n", pa.int64(), "bigint")]
TEXTS = [("_main", pa.string(), "string"), ("_chars", pa.int64(), "bigint")]


def _sequences(parts: Iterator[pa.RecordBatch]):
    """Per slice and host one wrapper for each distinct sequence, with the pages it stands for."""
    for part in parts:
        found: dict[tuple[str, str], tuple[Wrapper, int]] = {}
        for host, raw in zip(part.column("host").to_pylist(), part.column("body").to_pylist()):
            page = read_page(text_of(raw))
            items, _, values = _slots(page)
            key = (host, "\x00".join(items))
            new = _wrapper(page, items, values)
            if key in found:
                old, n = found[key]
                found[key] = (old.merged(new), n + 1)
            else:
                found[key] = (new, 1)
        yield [(host, wrapper.dumped(), n) for (host, _), (wrapper, n) in found.items()]


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    rows = sorted(zip(group["wrapper"], group["n"]), key=lambda r: (-r[1], r[0]))
    wrapper = Wrapper()
    for text, _ in rows:
        wrapper = wrapper.merged(Wrapper.loaded(text))
    return pd.DataFrame(
        {"host": [group["host"].iloc[0]], "wrapper": [wrapper.dumped()], "n": [sum(n for _, n in rows)]}
    )


def infer(pages: DataFrame) -> DataFrame:
    """One wrapper per host: host, wrapper, n (pages)."""
    bodies = pages.select(F.coalesce(host_of(), F.lit("")).alias("host"), as_bytes("html").alias("body"))
    found = map_texts(bodies, "body", _sequences, SEQUENCES)
    kind = "host string, wrapper string, n bigint"
    share = F.pmod(F.xxhash64("wrapper"), F.lit(SHARES))
    first = found.groupBy("host", share.alias("share")).applyInPandas(_merge, kind)
    return stored(first.groupBy("host").applyInPandas(_merge, kind), "wrappers")


def _extract(parts: Iterator[pa.RecordBatch]):
    known: dict[str, Wrapper] = {}
    for part in parts:
        rows = []
        wrappers = part.column("row").field("_wrapper").to_pylist()
        for raw, text in zip(part.column("body").to_pylist(), wrappers):
            if text is not None and text not in known:
                if len(known) > 500:
                    known.clear()
                known[text] = Wrapper.loaded(text)
            main = extract(text_of(raw), known[text] if text is not None else None)
            rows.append((main, len(main)))
        yield rows


def main_texts(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    known = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    rows = (
        pages.select("page_id", "url", "html")
        .withColumn("_host", F.coalesce(host_of(), F.lit("")))
        .join(known, "_host", "left")
    )
    found = append_columns(rows, as_bytes("html"), _extract, TEXTS)
    return found.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.col("_main").alias("text"), F.col("_chars").alias("n_chars"),
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    return main_texts(pages, infer(pages))
