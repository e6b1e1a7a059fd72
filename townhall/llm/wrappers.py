"""Main text of pages by wrappers: union-free regular expressions inferred for each host.

A page's stream of structure tokens is folded into an expression: neighbouring repeats of a group
become one repeated group, innermost first. Expressions of one host are aligned one after the
other; equal items match, a repeated group also matches any number of its own occurrences, and
items that only one side has become optional. No alternatives are ever formed. Text is a slot, and
each slot gathers how many pages fill it, how much text it holds, how much of it is links and
whether the text differs between pages.

Pages of a host that mark an article and pages that do not have a wrapper each. The finished wrapper
decides which slots are main text: those inside the page's article, if it marks one, else those of the container with most text that differs; never those of menus, headers,
footers, sidebars, notices, adverts, forms or comments. Every page is then aligned with its
host's wrapper, and the text in the chosen slots is returned, without what is constant at its place:
a slot, or one of the first and last PLACES occurrences of a repeated slot, that has the same text on
all pages that have it, three different ones at least. Headings in a marked article always stay.

Wrappers of a host are inferred in a tree: each task folds the pages it holds, and partial
wrappers are merged in groups of at most FAN_IN. A wrapper is as long as a page's structure, so
no task holds more than that many, whatever the number of pages of a host.

Defined results: a null or empty html, or one without main text, gives an empty text; pages
without a url share one host; repeated rows give equal results; an empty table an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townhall.llm.page_tokens import TEXT, Token, tokens
from townhall.session import settle

FAN_IN = 32
MOST_PERIOD = 12  # tokens in a group that may repeat
SEEN = 3  # different texts of a slot, and different pages that fill it, that are told apart
PLACES = 8  # first and last occurrences of a repeated slot that are judged one by one

# fixed values: what parts of a page are called that are not its main text
_ASIDE_TAGS = frozenset(
    "head nav footer aside form fieldset template noscript select button svg iframe object video audio canvas dialog "
    "menu textarea label datalist title option legend".split()
)
_ASIDE_NAMES = re.compile(
    r"(?:^|[-_])(?:ads?|adN|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|notification|alert|popup|"
    r"modal|overlay|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|share|sharing|social|related|recommend\w*|"
    r"comments?|commentlist|replies|reply|respond|disqus|subscribe|newsletter|signup|login|footer|foot|masthead|toolbar|"
    r"pagination|pager|widget|copyright|skip|hidden|search|tags|toc|byline-social|complementary|contentinfo)(?:$|[-_N])"
)
# of these, what holds articles of its own; and endings and beginnings that only tell how a part is laid out
_LISTS = re.compile(
    r"(?:^|[-_])(?:ads?|adN|advert\w*|promo\w*|sponsor\w*|sidebar|related|recommend\w*|comments?|commentlist|replies|reply|"
    r"respond|disqus|widget)(?:$|[-_N])|^hidden$"
)
_STATE = re.compile(
    r"^(?:has|have|no|not|with|without|is|js|show|hide)[-_]|[-_](?:open|closed|enabled|disabled|on|off|layout|results?|active)$")
_COMMENTS = re.compile(r"^(?:comments?|commentlist|replies|respond|disqus\w*|comments?[-_](?:list|area|section|thread))$")
_MAIN = re.compile(r"^<(?:article|main)(?:\.|$)|\.(?:main|articlebody|article-body|post-content|entry-content)(?:\.|$)")


class Slot:
    """What is known of a text slot: its place and figures over pages."""

    __slots__ = ("path", "pages", "words", "links", "texts", "seen", "places", "spots")

    def __init__(self, path: tuple[str, ...], pages: int = 0, words: int = 0, links: int = 0, texts: list[int] = (),
                 seen: list[int] = (), places: dict[int, tuple[int, list[int]] | None] = {}, spots: list[int] = ()):
        self.path, self.pages, self.words, self.links = path, pages, words, links
        self.texts, self.seen = list(texts), list(seen)  # the least few of the different texts, and of the different pages
        # of a repeated slot: text and pages of its first and last occurrences, None where the text differs
        self.places = dict(places)
        self.spots = list(spots)  # of one page: where the slot's texts are among its tokens

    def copy(self) -> Slot:
        return Slot(self.path, self.pages, self.words, self.links, self.texts, self.seen, self.places, self.spots)

    def take(self, other: Slot) -> None:
        self.pages += other.pages
        self.seen = sorted({*self.seen, *other.seen})[:SEEN]
        self.words += other.words
        self.links += other.links
        self.texts = sorted({*self.texts, *other.texts})[:SEEN]
        for at, theirs in other.places.items():
            ours = self.places.get(at, theirs)
            same = ours and theirs and ours[0] == theirs[0]
            self.places[at] = (ours[0], sorted({*ours[1], *theirs[1]})[:SEEN]) if same else None
        self.spots += other.spots


class Item:
    """A token, a text slot or a repeated group; ``key`` is equal for items that match."""

    __slots__ = ("key", "slot", "group", "optional")

    def __init__(self, key: str, slot: Slot | None = None, group: list[Item] | None = None, optional: bool = False):
        self.key, self.slot, self.group, self.optional = key, slot, group, optional

    def copy(self) -> Item:
        return Item(self.key, self.slot and self.slot.copy(), self.group and [i.copy() for i in self.group], self.optional)

    def take(self, other: Item) -> None:
        """Adds the figures of an equal item."""
        if self.slot:
            self.slot.take(other.slot)
        for a, b in zip(self.group or [], other.group or []):
            a.take(b)
        self.optional |= other.optional

    def slots(self) -> Iterator[Slot]:
        if self.slot:
            yield self.slot
        for item in self.group or []:
            yield from item.slots()


def _item(token: Token, page: int = 0, spot: int = 0) -> Item:
    """A text's key holds its place, so that text in different containers never matches; ``page`` names the page."""
    if token.key != TEXT:
        return Item(token.key)
    slot = Slot(token.path, 1, token.words, token.link_words, [zlib.crc32(token.text.encode())], [page],
                spots=[spot])
    return Item("T" + "/".join(token.path), slot)


def _may_repeat(unit: list[Item]) -> bool:
    """A group holds text, and is not merely a group again."""
    return any(i.slot or i.group for i in unit) and not (len(unit) == 1 and unit[0].group)


def fold(items: list[Item], groups: set[str] | None = None) -> list[Item]:
    """Neighbouring repeats as repeated groups, short periods first.

    ``groups`` names groups to form even from a single occurrence, as another page repeats them.
    """
    for period in range(1, MOST_PERIOD + 1):
        out: list[Item] = []
        keys = [i.key for i in items]
        at = 0
        while at < len(items):
            end = at + period
            repeats = end < len(keys) and keys[at] == keys[end] and keys[at:end] == keys[end : end + period]
            if (repeats or groups and end <= len(keys)) and _may_repeat(items[at:end]):
                unit = keys[at:end]
                name = "(" + " ".join(unit) + ")+"
                if repeats or name in groups:
                    first = [i.copy() for i in items[at:end]]
                    while keys[end : end + period] == unit:
                        for a, b in zip(first, items[end : end + period]):
                            a.take(b)
                        end += period
                    out.append(Item(name, None, first))
                    at = end
                    continue
            out.append(items[at])
            at += 1
        merged: list[Item] = []
        for item in out:  # a group beside an equal one is one group
            if merged and item.group and merged[-1].key == item.key:
                merged[-1].take(item)
            else:
                merged.append(item)
        items = merged
    return items


def page_items(found: list[Token], page: int) -> list[Item]:
    """A page's expression; the ends of its repeated slots are noted by occurrence."""
    items = fold([_item(t, page, k) for k, t in enumerate(found)])
    for item in items:
        for slot in item.slots():
            n = len(slot.spots)
            if n > 1:
                for nth in {*range(min(n, PLACES)), *range(max(0, n - PLACES), n)}:
                    what = zlib.crc32(found[slot.spots[nth]].text.encode()), [page]
                    if nth < PLACES:
                        slot.places[nth] = what
                    if n - nth <= PLACES:
                        slot.places[nth - n] = what
    return items


def _groups(items: list[Item]) -> set[str]:
    out = set()
    for i in items:
        if i.group:
            out.add(i.key)
            out |= _groups(i.group)
    return out


def align(left: list[Item], right: list[Item]) -> list[tuple[int, int]]:
    """Matching items in order, as pairs of places."""
    blocks = SequenceMatcher(None, [i.key for i in left], [i.key for i in right], autojunk=False).get_matching_blocks()
    return [(a + k, b + k) for a, b, size in blocks for k in range(size)]


def merge(left: list[Item], right: list[Item]) -> list[Item]:
    """One wrapper for both: matches gather, what one side lacks becomes optional."""
    left, right = fold(left, _groups(right)), fold(right, _groups(left))
    out: list[Item] = []
    a = b = 0
    for i, j in [*align(left, right), (len(left), len(right))]:
        for item in left[a:i] + right[b:j]:
            item.optional = True
            out.append(item)
        if i < len(left):
            left[i].take(right[j])
            out.append(left[i])
        a, b = i + 1, j + 1
    return fold(out)


# -- as text, for tables --------------------------------------------------------


def to_json(items: list[Item]) -> str:
    def flat(i: Item):
        s = i.slot and [list(i.slot.path), i.slot.pages, i.slot.words, i.slot.links, i.slot.texts, i.slot.seen,
                        [[at, *(what or ())] for at, what in sorted(i.slot.places.items())]]
        return [i.key, s, i.group and [flat(g) for g in i.group], int(i.optional)]

    return json.dumps([flat(i) for i in items], separators=(",", ":"))


def from_json(text: str) -> list[Item]:
    def deep(x) -> Item:
        key, s, group, optional = x
        slot = s and Slot(tuple(s[0]), *s[1:6], {at: tuple(what) or None for at, *what in s[6]})
        return Item(key, slot, group and [deep(g) for g in group], bool(optional))

    return [deep(x) for x in json.loads(text)]


# -- which slots are main text ----------------------------------------------------


def is_aside(path: tuple[str, ...], trusted: frozenset[tuple[str, ...]] | None = frozenset()) -> bool:
    """Whether a place lies in a part of a page that is not its main text.

    Names say nothing on html and body or on the containers ``trusted`` (all, if None); a marked
    article and what is around it count as aside only by the names of lists of articles.
    """
    last = max((k for k, key in enumerate(path) if _MAIN.search(key)), default=-1)
    in_main = False
    for k, key in enumerate(path):
        name, *marks = key[1:].split(".")
        if name in _ASIDE_TAGS:
            return True
        if name == "header" and not in_main:  # an article's own header holds its title
            return True
        if trusted is not None and name not in ("html", "body") and path[: k + 1] not in trusted:
            names = _LISTS if k <= last else _ASIDE_NAMES
            if any(names.search(m) and not _STATE.search(m) for m in marks):
                return True
        in_main |= bool(_MAIN.search(key))
    return False


def _constant(slot: Slot) -> bool:
    """One and the same text in several pages that differ in their own text; copies of a page count once."""
    return len(slot.seen) >= SEEN and len(slot.texts) == 1


def page_mark(found: list[Token]) -> int:
    """Equal for copies of a page, also if only menus, adverts or the like differ."""
    texts = [t for t in found if t.key == TEXT and not is_aside(t.path, None)]
    own = [t.text for t in texts if not is_aside(t.path)] or [t.text for t in texts]
    return zlib.crc32("\n".join(own).encode())


def trusted_places(slots: list[Slot]) -> frozenset[tuple[str, ...]]:
    """Containers with most of the text that differs: a name like that of an aside says nothing there."""
    mass: dict[tuple[str, ...], int] = {}
    total = 0
    for s in slots:
        if not _constant(s) and not is_aside(s.path, None):
            total += s.words
            for depth in range(1, len(s.path) + 1):
                mass[s.path[:depth]] = mass.get(s.path[:depth], 0) + s.words
    return frozenset(place for place, words in mass.items()
                     if 2 * words > total and not any(_COMMENTS.search(m) for m in place[-1][1:].split(".")[1:]))


def is_marked(found: list[Token]) -> bool:
    """Whether a page fills a marked article of its own."""
    return any(t.key == TEXT and any(_MAIN.search(p) for p in t.path) and not is_aside(t.path) for t in found)


def main_slots(items: list[Item], marked: bool = False) -> set[str]:
    """Keys of the text slots that hold the main text of a host's pages, those with a marked article or those without."""
    slots: dict[str, Slot] = {}

    def gather(item: Item) -> None:
        if item.slot:
            if item.key in slots:
                slots[item.key].take(item.slot)
            else:
                slots[item.key] = item.slot.copy()
        for i in item.group or []:
            gather(i)

    for item in items:
        gather(item)
    trusted = trusted_places(list(slots.values()))
    own = {k: s for k, s in slots.items() if not is_aside(s.path, trusted)}
    if marked:
        return {k for k, s in own.items() if any(_MAIN.search(p) for p in s.path)}
    # without a marked article: all text that differs between pages, lists of links aside
    return {k for k, s in own.items() if 2 * s.links < s.words and not _constant(s)}


_HEADS = re.compile(r"^<(?:h[1-6]|dt|th|caption|figcaption|summary)(?:\.|$)")


def fixed_places(slot: Slot) -> dict[int, int]:
    """Occurrences of a repeated slot with one and the same text on all pages, and that text.

    Where three quarters of the ends are like that, the pages are versions of one page: nothing is fixed.
    """
    fixed = {at: what[0] for at, what in slot.places.items() if what and len(what[1]) >= SEEN}
    return {} if 4 * len(fixed) >= 3 * len(slot.places) else fixed


class Wrapper:
    """A host's finished wrapper, and what is main text by it."""

    def __init__(self, items: list[Item], marked: bool):
        self.items, self.marked = items, marked
        self.chosen = main_slots(items, marked)
        self.groups = _groups(items)
        # by identity: slots with the same path differ by their position
        self.fixed: dict[int, tuple[int | None, dict[int, int]]] = {}
        self.pairs: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for item in items:
            self._judge(item)

    def _judge(self, item: Item) -> None:
        if item.slot and item.key in self.chosen and not (self.marked and _HEADS.search(item.slot.path[-1])):
            whole = item.slot.texts[0] if _constant(item.slot) else None
            places = fixed_places(item.slot)
            if whole is not None or places:
                self.fixed[id(item.slot)] = whole, places
        for i in item.group or []:
            self._judge(i)

    def constant(self, found: list[Token]) -> set[int]:
        """Tokens of a page that are at a place of the wrapper with constant text, and have that text."""
        out: set[int] = set()

        def compare(own: Item, known: Item) -> None:
            if own.slot and id(known.slot) in self.fixed:
                whole, places = self.fixed[id(known.slot)]
                n = len(own.slot.spots)
                for nth, spot in enumerate(own.slot.spots):
                    if zlib.crc32(found[spot].text.encode()) in (whole, places.get(nth), places.get(nth - n)):
                        out.add(spot)
            for a, b in zip(own.group or [], known.group or []):
                compare(a, b)

        if self.fixed:
            own = fold(page_items(found, 0), self.groups)
            shape = tuple(i.key for i in own)
            if shape not in self.pairs:
                if len(self.pairs) >= 256:
                    self.pairs.clear()
                self.pairs[shape] = align(own, self.items)
            for a, b in self.pairs[shape]:
                compare(own[a], self.items[b])
        return out


def extract(found: list[Token], wrapper: Wrapper) -> str:
    """Text in the chosen slots without what is constant at its place, a block a line; never nothing for that alone."""
    main = [k for k, t in enumerate(found) if t.key == TEXT and "T" + "/".join(t.path) in wrapper.chosen]
    constant = wrapper.constant(found) if main else set()
    return "\n".join(found[k].text for k in [k for k in main if k not in constant] or main)


# -- as Spark jobs ------------------------------------------------------------------

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _combined(wrappers: list[list[Item]]) -> list[Item]:
    while len(wrappers) > 1:
        wrappers = [merge(*wrappers[k : k + 2]) if k + 1 < len(wrappers) else wrappers[k]
                    for k in range(0, len(wrappers), 2)]
    return wrappers[0]


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A wrapper for each host, kind and expression in a batch; equal expressions only add their figures.

    The kinds are pages with a marked article and pages without; a host may have both.
    """
    for batch in batches:
        held: dict[tuple[str, bool, str], list[Item]] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            found = tokens(page)
            marked = is_marked(found)
            mark = page_mark(found)
            items = page_items(found, mark)
            shape = " ".join(i.key for i in items)
            known = held.get((host, marked, shape))
            if known is None:
                held[host, marked, shape] = items
            else:
                for a, b in zip(known, items):
                    a.take(b)
        by_kind: dict[tuple[str, bool], list[list[Item]]] = {}
        for (host, marked, _), items in held.items():
            by_kind.setdefault((host, marked), []).append(items)
        rows = [(host, marked, to_json(_combined(w))) for (host, marked), w in by_kind.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()),
             pa.array([r[2] for r in rows], pa.string())], names=["host", "marked", "wrapper"])


def _merge_group(group: pd.DataFrame) -> pd.DataFrame:
    whole = _combined([from_json(w) for w in sorted(group["wrapper"])])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "marked": [group["marked"].iloc[0]], "wrapper": [to_json(whole)]})


_PARTS = "host string, marked boolean, wrapper string"


def infer(pages: DataFrame) -> DataFrame:
    """Wrappers per host, from columns host and html: of pages with a marked article and of pages without."""
    parts = settle(pages.select("host", "html").mapInArrow(_fold_pages, _PARTS), "wrappers")
    while True:
        most = parts.groupBy("host", "marked").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        # rows are written, so their numbers hold; a group has FAN_IN of them on average at most
        salt = F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(max(1, -(-most // FAN_IN))))
        parts = settle(
            parts.withColumn("salt", salt).groupBy("host", "marked", "salt").applyInPandas(_merge_group, _PARTS), "wrappers")
    both = parts.groupBy("host").agg(F.max(F.when(F.col("marked"), F.col("wrapper"))).alias("marked_wrapper"),
                                     F.max(F.when(~F.col("marked"), F.col("wrapper"))).alias("plain_wrapper"))
    return settle(both, "wrappers")  # of known size, so that pages are not dealt out by host where it is small


def _extract_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decided: dict[tuple[bool, str], Wrapper] = {}
    for batch in batches:
        texts = []
        columns = [batch.column(c).to_pylist() for c in ("html", "marked_wrapper", "plain_wrapper")]
        for page, marked_wrapper, plain_wrapper in zip(*columns):
            found = tokens(page)
            marked = is_marked(found)
            wrapper = marked_wrapper if marked else plain_wrapper
            if (marked, wrapper) not in decided:
                if len(decided) >= 256:
                    decided.clear()
                decided[marked, wrapper] = Wrapper(from_json(wrapper) if wrapper else [], marked)
            texts.append(extract(found, decided[marked, wrapper]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), _HOST, 1), F.lit(""))).alias("host"),
    )
    wrappers = infer(plain)
    return plain.join(wrappers, "host").mapInArrow(
        _extract_pages, "page_id long, url string, text string, n_chars long")
