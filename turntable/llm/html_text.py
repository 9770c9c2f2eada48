"""The main text of web pages by two passes over their blocks.

Pass one decides each block for itself, by where it stands, how much of it is link text, how long it is and
how many of its words are stop words. Pass two lets the undecided (short or word-poor) blocks inherit from
the nearest decided blocks of the same article, or of the page if there is no article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.llm.common import map_batches, texts_of

MAX_LINK_DENSITY = 0.4
SHORT = 70
LONG = 200
LOW_STOP_WORDS = 0.10
HIGH_STOP_WORDS = 0.15

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the
    their there they this to was we were which will with you
    au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour qui que
    sa se ses son sont sur un une vous
    aber als am auch auf aus bei das dass dem den der des die durch ein eine einer eines er es für hat ich im
    ist mit nach nicht oder sich sie sind so über um und von vor war wie wird zu zum zur
    al como con del el ella ellos esta este fue ha hay la las lo los más no o para pero por porque se sin sobre
    su sus un una y ya
    """.split()
)

# Elements of HTML by what they do.
_RAW = frozenset("script style iframe textarea title xmp".split())  # what they hold is no markup
_SKIPPED = frozenset("noscript template object svg math select canvas audio video".split())
_FOREIGN = frozenset("svg math".split())  # these may close themselves, and so may what they hold
_BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul
    """.split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_UNWANTED = frozenset("nav footer aside form menu dialog head button fieldset".split())
_VOID = frozenset("hr br img input meta link wbr area base col embed source track param".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words in a class or id that mark what is not the article, whatever stands beside them, ...
_STRONG = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie
    cookies consent gdpr comment comments disqus respond replies newsletter subscribe subscription popup modal
    overlay breadcrumb breadcrumbs notice notices paywall
    """.split()
)
# ... and unless a word of the last list does.
_WEAK = frozenset(
    """
    nav navigation navbar menu menubar footer header masthead sidebar side aside widget widgets related recommended
    share sharing social toolbar tags pagination pager login signup search copyright legal alert disclaimer
    """.split()
)
_WANTED = frozenset("article content main post entry story body text page".split())

_MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*\Z)
    |<(?P<close>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)>
    |<[!?/][^>]*>""",
    re.S | re.I | re.X,
)
_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in _RAW}
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w+")
# The sign, or "(c)" with a year or the word; not the "(c)" of a list.
_COPYRIGHT = re.compile(r"©|\(c\)(?=\s*(?:copyright\b\s*)?(?:19|20)\d\d)|\bcopyright\s*\(c\)|^\(c\)\s*copyright\b", re.I)


@dataclass
class Block:
    """A run of text between two block elements."""

    unwanted: bool
    article: int  # which article or main element holds it, 0 for none
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None


def _marks_unwanted(tag: str, attributes: str, inside: int) -> bool:
    if tag in _UNWANTED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    names: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            names.update(word.lower() for word in _NAME.findall(value))
    if names & _STRONG:
        return True
    weak = names & _WEAK
    return bool(weak) and not names & _WANTED and not (inside and weak <= {"header"})


@dataclass
class _Tag:
    """A tag between two stretches of text; a comment has no name. What a raw element holds belongs to its tag."""

    start: int
    end: int
    name: str = ""
    closes: bool = False
    attributes: str = ""


def _tags(page: str) -> list[_Tag]:
    out: list[_Tag] = []
    at = foreign = 0
    while found := _MARKUP.search(page, at):
        name = (found["tag"] or "").lower()
        tag = _Tag(found.start(), found.end(), name, bool(found["close"]), found["attributes"] or "")
        itself = tag.attributes.rstrip().endswith("/")
        if name in _FOREIGN:
            if itself and not tag.closes:
                tag.name = ""
            else:
                foreign = max(0, foreign + (-1 if tag.closes else 1))
        if name in _RAW and not tag.closes and not (foreign and itself):
            end = _ENDS[name].search(page, tag.end)
            tag.end, tag.name = end.end() if end else len(page), ""
        out.append(tag)
        at = tag.end
    return out


def _skips(tags: list[_Tag]) -> dict[int, int]:
    """For each tag that opens a skipped element, the tag that closes it; none where its parent ends before."""
    out: dict[int, int] = {}
    stack: list[int] = []
    n_open: Counter[str] = Counter()
    for i, tag in enumerate(tags):
        if tag.name not in _SKIPPED and tag.name not in _BLOCKS:
            continue
        if not tag.closes:
            stack.append(i)
            n_open[tag.name] += 1
        elif n_open[tag.name]:
            while True:
                first = stack.pop()
                n_open[tags[first].name] -= 1
                if tags[first].name == tag.name:
                    break
            if tag.name in _SKIPPED:
                out[first] = i
    return out


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that hold text, in order, with character references decoded.

    A skipped element says nothing up to its end. If it has none before its parent ends, it is silent up to the next block element.
    """
    blocks: list[Block] = []
    open_tags: list[tuple[str, bool, int]] = []  # element, unwanted, article
    unwanted, article, articles, links, heading = False, 0, 0, 0, False
    current: Block | None = None
    at, skipped_to, silent = 0, -1, False

    def say(text: str) -> None:
        nonlocal current
        if not text or silent:
            return
        if current is None:
            if text.isspace():
                return
            current = Block(unwanted, article, heading)
            blocks.append(current)
        text = html.unescape(text)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())

    tags = _tags(page)
    skips = _skips(tags)
    for i, found in enumerate(tags):
        if i <= skipped_to:
            at = found.end
            continue
        say(page[at : found.start])
        at = found.end
        tag = found.name
        if not tag:
            continue
        if tag in _SKIPPED:
            if i in skips:
                skipped_to = skips[i]
            elif not found.closes:
                silent = True
            continue
        if tag == "br":
            say(" ")
        elif tag == "a":
            links = 0 if found.closes else 1
        if tag in _VOID:
            current = None if tag == "hr" else current
            continue
        if tag not in _BLOCKS:
            if tag == "button" or (not found.closes and _marks_unwanted(tag, found.attributes, article)):
                pass
            else:
                continue
        if tag in _BLOCKS:
            current, links, silent = None, 0, False
        if not found.closes:
            if tag in _BLOCKS and open_tags and open_tags[-1][0] == "p":  # a paragraph ends where the next block begins
                _, unwanted, article = open_tags.pop()
            open_tags.append((tag, unwanted, article))
            if tag in ("article", "main"):
                articles += 1
                article = articles if not unwanted or tag == "main" else article
                unwanted = unwanted and tag != "main"
            unwanted = unwanted or _marks_unwanted(tag, found.attributes, article)
            if tag not in _BLOCKS:
                current = None
        else:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag), None)
            if depth is not None:
                _, before, article = open_tags[depth]
                if before != unwanted:
                    current = None
                unwanted = before
                del open_tags[depth:]
        heading = any(name in _HEADINGS for name, _, _ in open_tags[-2:])
    say(page[at:])
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
    return [block for block in blocks if block.text]


def _decide(block: Block, by_stop_words: bool = True) -> bool | None:
    """Pass one: wanted, unwanted, or None where the block alone does not tell."""
    size = len(block.text)
    if block.unwanted or (block.linked and block.linked > MAX_LINK_DENSITY * size):
        return False
    if not block.article and size < LONG and _COPYRIGHT.search(block.text):
        return False
    if size < SHORT:
        return None
    if not by_stop_words:
        return True
    words = _WORD.findall(block.text.lower())
    stop_words = sum(word in STOP_WORDS for word in words)
    if stop_words >= HIGH_STOP_WORDS * len(words) or (size >= LONG and stop_words >= LOW_STOP_WORDS * len(words)):
        return True
    return None if block.article or stop_words >= LOW_STOP_WORDS * len(words) else False


def _settle(blocks: list[Block]) -> None:
    """Pass two: the undecided inherit from the nearest decided blocks."""
    decided = [block.good for block in blocks]
    groups: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        if not block.unwanted or not block.article:
            groups.setdefault(block.article, []).append(i)
    for article, places in groups.items():
        before: list[int | None] = []
        last = None
        for k, i in enumerate(places):
            last = k if decided[i] is not None else last
            before.append(last)
        after: list[int | None] = []
        last = None
        for k in range(len(places) - 1, -1, -1):
            last = k if decided[places[k]] is not None else last
            after.append(last)
        after.reverse()
        for k, i in enumerate(places):
            if decided[i] is not None:
                continue
            near = [(abs(k - j), decided[places[j]]) for j in (before[k], after[k]) if j is not None]
            follows = after[k] is not None and decided[places[after[k]]]
            if not near:
                blocks[i].good = bool(article)
            elif article or (blocks[i].heading and follows):
                # An article's own blocks are its text; a heading goes with what it heads.
                closest = min(distance for distance, _ in near)
                blocks[i].good = any(good for distance, good in near if distance == closest) or bool(follows)
            else:
                closest = min(distance for distance, _ in near)
                blocks[i].good = all(good for distance, good in near if distance == closest)


def main_text(page: str) -> str:
    """The text of the wanted blocks, one space between two."""
    blocks = blocks_of(page)
    for block in blocks:
        block.good = _decide(block)
    if not any(block.good or block.article for block in blocks):
        # No article element, and nothing in a language with stop words: long blocks are judged without them.
        for block in blocks:
            block.good = _decide(block, by_stop_words=False)
    _settle(blocks)
    return " ".join(block.text for block in blocks if block.good)


def extract_text(df: DataFrame, column: str = "html", output: str = "text") -> DataFrame:
    """All columns of `df` but `column`, and the main text of the page, empty if there is none.

    A null or empty page has no text. Broken markup ends where the page ends. Rows are taken one by one, so
    repeated rows and null ids stay; a column named as the output is replaced. One pass without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([main_text(page) for page in texts_of(batch, column)], pa.string())
        return pa.record_batch([*[batch.column(name) for name in kept], texts], [*kept, output])

    kept = [name for name in df.columns if name.lower() not in (column.lower(), output.lower())]
    types = dict(df.dtypes)
    schema = ", ".join(f"`{name}` {types[name]}" for name in kept)
    chosen = df.select(*[F.col(f"`{name}`") for name in [*kept, column]])
    return map_batches(chosen, work, f"{schema}, `{output}` string" if kept else f"`{output}` string")
