"""Main text of web pages by maximum-scoring subsequence.

Method: a page is a sequence of words and tags. Words score positive, tags negative, and one linear scan finds the contiguous run with
the highest sum: the content region. The weights are learned from labelled pages, which are those that mark their content by
one of LABELS: each feature of a tag (its name, and the words of its class, id and role) is counted inside and outside the
marked content, as tags and as words below them, apart for places below a mark and others. A word scores the lowest content share
among its ancestors' features, a tag the less the rarer its features are in content. Features that labelled pages do not
show in such a place score neutrally, except the names and class words of BOILERPLATE, which are never content, inside an
article either. Words of the region that stand below such features, or below others of which less than CONTENT_SHARE is content
(menus, adverts, notices, forms, comments), are left out. On a page without a mark only classes, ids and roles count for the latter.

The text: character references decoded, white space in a block turned into one space, blocks trimmed and joined in page order by two
line ends. Line-break and inline tags do not end a block. Whole pages are read, whatever their length; cut-off tags,
comments and scripts run to the page's end, a head without its end tag to <body> or the first element or text that a head cannot hold. Null, empty and text-free pages give an empty text. Repeated rows are read each by
itself. Extra columns pass through; one with the name of an output is replaced.
"""

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from folioscope.llm.common import Scratch, appended, gather, with_columns

#: Elements that may stand in a head; any other ends an open one.
IN_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}

#: Elements by which a page marks its content.
LABELS = {"article", "main"}

#: Elements that never hold text of a page.
UNREAD = {"head", "script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "canvas", "select", "button"}

#: Elements, and words of class, id or role, of parts that are not content.
BOILERPLATE = {
    "tag": {"nav", "header", "footer", "aside", "form", "menu", "dialog"},
    "attr": {
        "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "sidebar", "aside", "menu", "nav",
        "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "comment", "comments", "reply", "replies",
        "discussion", "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "share",
        "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "search",
        "pagination", "pager", "toolbar", "widget", "copyright", "contentinfo", "complementary",
    },
}

#: Elements without an end tag, and elements that do not end a block.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}

#: Elements that say nothing about a word on a page without a mark.
NEUTRAL = {"html", "body", "div", "section", "center", "span", "table", "tbody", "tr", "td", "ul", "ol"}

#: A block of these is ended by the next of the same group.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

#: A feature is kept if it has this share of all labelled tags; so a model has at most 1 / FEATURE_SHARE features.
FEATURE_SHARE = 1e-5

#: Words of the region with a lower score are not content.
CONTENT_SHARE = 0.5

#: Scores: of a tag whose features occur in content only, and what others lose on top; of a word that is never content.
TAG_LEAST, TAG_MOST, WORD_LEAST = 0.05, 3.0, 0.01

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def features(name: str, attributes: str) -> tuple[str, ...]:
    found = [f"tag:{name}"]
    if attributes and "=" in attributes:
        for match in _ATTR.finditer(attributes):
            words = _PARTS.findall(_CAMEL.sub(" ", match[1] or match[2] or match[3] or "").lower())
            found += [f"attr:{w}" for w in words]
    return tuple(found)


def is_boilerplate(feature: str) -> bool:
    kind, _, word = feature.partition(":")
    return word in BOILERPLATE[kind]


def events(page: str) -> Iterator[tuple[str, str, tuple[str, ...]]]:
    """("text", raw text, ()), ("open", name, features) and ("close", name, ()) in page order; unread parts are skipped."""
    at = 0
    for match in _TOKEN.finditer(page):
        if match.start() > at:
            yield "text", page[at : match.start()], ()
        at = match.end()
        name = (match[3] or match[6] or "").lower()
        if name:
            closing = match[2] if match[3] else match[5]
            if closing:
                yield "close", name, ()
            else:
                yield "open", name, features(name, (match[4] if match[3] else match[7]) or "")
    if at < len(page):
        yield "text", page[at:], ()


class Entry:
    """An open element, with what holds for all that stands in it."""

    __slots__ = ("name", "own", "place", "boilerplate", "unread", "lowest", "fresh", "words")

    def __init__(self, name: str, own: tuple[str, ...], outer: "Entry | None"):
        self.name, self.own = name, own
        #: "in" a mark of content or "out"
        self.place = "in" if name in LABELS else outer.place if outer else "out"
        self.boilerplate = bool(outer and outer.boilerplate) or any(map(is_boilerplate, own))
        self.unread = bool(outer and outer.unread) or name in UNREAD
        #: the least word share of the features up to here from the innermost mark on; Model.lowest fills it in
        self.lowest: float | None = -1.0


class Walk:
    """The open elements while a page is read. What an event costs does not depend on how many are open."""

    def __init__(self) -> None:
        self.stack: list[Entry] = []
        self.at: dict[str, list[int]] = {}  # where elements of each name are open
        self.blocks: list[int] = []  # where elements are open that are not inline

    def open(self, name: str, own: tuple[str, ...]) -> None:
        if name not in IN_HEAD:
            self.close("head")  # its end tag may be left out
        if name in VOID:
            return
        if name not in INLINE:
            self._end(name)
        entry = Entry(name, own, self.stack[-1] if self.stack else None)
        self.at.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(entry)

    def left(self, entry: Entry) -> None:
        """Called for each element that ends."""

    def _cut(self, size: int) -> None:
        while len(self.stack) > size:
            entry = self.stack.pop()
            self.at[entry.name].pop()
            if entry.name not in INLINE:
                self.blocks.pop()
            self.left(entry)

    def _innermost(self, names: set[str]) -> int:
        return max((self.at[name][-1] for name in names if self.at.get(name)), default=-1)

    def text(self, value: str) -> bool:
        """Whether the text ends an open head, as all but white space in the head itself does."""
        ended = bool(self.stack) and self.stack[-1].name == "head" and bool(value.strip(" \t\n\r\f"))
        if ended:
            self._cut(len(self.stack) - 1)
        return ended

    def _end(self, name: str) -> None:
        # an unclosed paragraph or item, with the inline elements left open in it
        if name in ENDED_BY:
            found = self._innermost({"p"} | ENDED_BY[name])
            if found > self._innermost({"ul", "ol", "dl", "table"} | LABELS):
                self._cut(found)
        elif self.blocks and self.stack[self.blocks[-1]].name == "p":
            self._cut(self.blocks[-1])

    def close(self, name: str) -> None:
        found = self._innermost({name})
        if found >= 0:
            self._cut(found)

    def place(self) -> str:
        return self.stack[-1].place if self.stack else "out"

    def boilerplate(self) -> bool:
        return bool(self.stack) and self.stack[-1].boilerplate

    def unread(self) -> bool:
        return bool(self.stack) and self.stack[-1].unread


class Count(Walk):
    """Counts, for each place and feature, the tags in and out of content and the words below it in and out.

    A word counts for the features that speak for its place: those above it up to the innermost mark, each once. An element adds up its words
    and gives them, when it ends, to the features that no outer element of this scope has, and to the outer element.
    """

    def __init__(self, held: dict[str, list[int]]) -> None:
        super().__init__()
        self.held = held
        self.scopes: list[set[str]] = [set()]  # features above, for each mark that is open and outside of all

    def open(self, name: str, own: tuple[str, ...]) -> None:
        before = len(self.at.get(name, ())) if name not in VOID else None
        super().open(name, own)
        inside = self.place() == "in" and not self.boilerplate()
        for f in own:
            self.held.setdefault(f"{self.place()} {f}", [0, 0, 0, 0])[0 if inside else 1] += 1
        if before is None:
            return
        entry = self.stack[-1]
        entry.words = [0, 0]
        if name in LABELS:
            self.scopes.append(set())
            entry.fresh = ()
        else:
            entry.fresh = [f for f in dict.fromkeys(own) if f not in self.scopes[-1]]
            self.scopes[-1].update(entry.fresh)

    def words(self, number: int) -> None:
        if self.stack and not self.unread():
            inside = self.place() == "in" and not self.boilerplate()
            self.stack[-1].words[0 if inside else 1] += number

    def left(self, entry: Entry) -> None:
        if entry.name in LABELS:
            self.scopes.pop()
            return
        self.scopes[-1].difference_update(entry.fresh)
        for side in (0, 1):
            if entry.words[side]:
                for f in entry.fresh:
                    self.held.setdefault(f"{entry.place} {f}", [0, 0, 0, 0])[2 + side] += entry.words[side]
                if self.stack:
                    self.stack[-1].words[side] += entry.words[side]

    def finish(self) -> None:
        self._cut(0)


def count_features(page: str, held: dict[str, list[int]]) -> None:
    """Adds a labelled page's counts."""
    walk = Count(held)
    for kind, value, own in events(page):
        if kind == "open":
            walk.open(value, own)
        elif kind == "close":
            walk.close(value)
        else:
            walk.text(value)
            walk.words(len(value.split()))
    walk.finish()


@dataclass
class Model:
    tags: dict[str, float]  # of a place and feature: share of the tags that stand in content
    words: dict[str, float]  # share of the words below it that do
    outside: float = 0.0  # the same for words outside of any mark below features not seen there

    def tag_score(self, place: str, own: tuple[str, ...]) -> float:
        if place == "in":
            return -TAG_LEAST
        share = 0.0 if any(map(is_boilerplate, own)) else min((self.tags.get(f"{place} {f}", 1.0) for f in own), default=1.0)
        return -(TAG_LEAST + (TAG_MOST - TAG_LEAST) * (1.0 - share))

    def lowest(self, walk: Walk) -> float | None:
        """The least share of the features above, up to the innermost mark; None without any."""
        stack = walk.stack
        known = len(stack)
        while known and stack[known - 1].lowest == -1.0:
            known -= 1
        low = stack[known - 1].lowest if known else None
        for entry in stack[known:]:
            if entry.name in LABELS:
                low = None
            else:
                unseen = self.unseen(entry.place)
                own = min(self.words.get(f"{entry.place} {f}", unseen) for f in entry.own)
                low = own if low is None else min(low, own)
            entry.lowest = low
        return low

    def unseen(self, place: str) -> float:
        return 1.0 if place == "in" else self.outside

    def word_score(self, walk: Walk) -> tuple[float, bool]:
        """A word's score here, and whether it can be content."""
        if walk.boilerplate():
            return WORD_LEAST, False
        score = self.lowest(walk)
        if score is None:
            score = self.unseen(walk.place())
        return max(WORD_LEAST, score), score >= CONTENT_SHARE

    def without_mark(self) -> "Model":
        """For pages that mark nothing: shares over both places, as far as they do not hang on the mark."""

        def kept(shares: dict[str, float]) -> dict[str, float]:
            out: dict[str, float] = {}
            for key, share in shares.items():
                feature = key.partition(" ")[2]
                if feature.startswith("attr:"):
                    out[f"out {feature}"] = max(share, out.get(f"out {feature}", 0.0))
                elif feature.partition(":")[2] not in NEUTRAL | LABELS:
                    # a part of its weight: it shapes the region but does not take words out of it
                    out[f"out {feature}"] = max(0.5 + share / 2, out.get(f"out {feature}", 0.0))
            return out

        return Model(kept(self.tags), kept(self.words), 1.0)


def fit(pages: DataFrame, column: str = "html") -> Model:
    """Learn from all pages that mark their content."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_features(page, held)
            if len(held) > 100_000:
                yield made(held)
                held = {}
        if held:
            yield made(held)

    def made(held: dict[str, list[int]]) -> pa.RecordBatch:
        rows = list(held.values())
        numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(list(held)), *numbers], names=["feature", "ti", "to", "wi", "wo"])

    labelled = pages.select(column).where(F.col(column).rlike("(?i)<(" + "|".join(sorted(LABELS)) + r")\b"))
    totals = (
        labelled.mapInArrow(run, "feature string, ti long, to long, wi long, wo long")
        .groupBy("feature")
        .agg(*[F.sum(c).alias(c) for c in ("ti", "to", "wi", "wo")])
    )
    with Scratch(pages.sparkSession, "tag-counts") as scratch:  # one parse of the pages
        totals = scratch.store(totals, "totals")
        n = totals.where(F.col("feature").contains(" tag:")).agg(F.coalesce(F.sum(F.col("ti") + F.col("to")), F.lit(0))).first()[0]
        rows = gather(totals.where(F.col("ti") + F.col("to") >= FEATURE_SHARE * n))
    model = Model({}, {})
    for feature, tags_in, tags_out, words_in, words_out in rows:
        if feature.partition(":")[2] in {"html", "body"}:
            continue  # they hold both content and the rest
        model.tags[feature] = (tags_in + 1) / (tags_in + tags_out + 1)
        model.words[feature] = (words_in + 1) / (words_in + words_out + 1)
    return model


_MARK = re.compile("<(?:" + "|".join(sorted(LABELS)) + r")\b", re.I)


def extract(page: str | None, model: Model, without_mark: Model) -> str:
    """Main text of one page."""
    if not page:
        return ""
    if not _MARK.search(page):
        model = without_mark
    walk = Walk()
    pieces: list[tuple[str, bool, bool]] = []  # text, whether a block ends before it, whether it can be content
    ends, unread, place = True, False, "out"
    score, content = 1.0, True
    total, begin, best, region = 0.0, 0, 0.0, (0, 0)
    for kind, value, own in events(page):
        if kind == "text":
            if unread and walk.text(value):
                score, content = model.word_score(walk)
                unread = walk.unread()
            if unread:
                continue
            text = html.unescape(value)
            words = len(text.split())
            if words:
                if total <= 0:
                    total, begin = 0.0, len(pieces)
                total += words * score
            pieces.append((text, ends, content))
            ends = False
            if words and total > best:
                best, region = total, (begin, len(pieces))
            continue
        if kind == "open":
            walk.open(value, own)
        else:
            walk.close(value)
        total += model.tag_score(place, own or (f"tag:{value}",))
        if value == "br":
            pieces.append((" ", ends, content))
            ends = False
        elif value not in INLINE:
            ends = True
        place = walk.place()
        score, content = model.word_score(walk)
        unread = walk.unread()
    blocks: list[list[str]] = []
    fresh = True
    for text, before, content in pieces[region[0] : region[1]]:
        fresh |= before
        if not content:
            continue
        if fresh:
            blocks.append([])
            fresh = False
        blocks[-1].append(text)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def main_text(pages: DataFrame, model: Model, column: str = "html") -> DataFrame:
    """Adds text and n_chars (code points) to each row."""
    shipped = pages.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURE_SHARE
    schema = with_columns(pages.schema, text=StringType(), n_chars=LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        bare = own.without_mark()
        for batch in batches:
            texts = [extract(page, own, bare) for page in batch.column(column).to_pylist()]
            yield appended(batch, schema, text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    return pages.mapInArrow(run, schema)
