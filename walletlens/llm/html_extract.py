"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped to lines, one per block element.  Boilerplate elements leave empty lines behind,
so the sum of text lengths over a sliding window of lines falls to zero there.  A surge is a place
where that sum rises from zero, a dive where it falls back; the text between a surge and its dive is
kept if its greatest window sum reaches the threshold.  Where no tag parts a menu or an imprint from the
text, surge and dive move inwards to where the sum over a window crosses a threshold taken from the block's own
lines (``EDGE_SHARE``), so short lines at the ends of a block go; lines that end like a sentence, and headings right
before the text, stay, and nothing between surge and dive is cut.  The outermost ``article`` or ``main`` adds
empty lines at its edges, boilerplate within it none, and its lines weigh ``CONTAINER_WEIGHT`` times as
much; text outside is measured by the same sums.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from walletlens.llm.common import per_text

WINDOW_LINES = 3
LEAST_SUM = 86
LEAST_SHARE = 0.5
CONTAINER_WEIGHT = 2
EDGE_SHARE = 0.5

# Elements whose content is no markup, those whose markup is never text of the page, and boilerplate.
RAW = "script style iframe textarea title".split()
FOREIGN = frozenset("noscript template svg math object canvas".split())
BOILERPLATE = frozenset(
    "nav footer aside form button select menu dialog figure-ad header option label input".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
# Words that name boilerplate in a class, id or role, alone or joined to each other and to those around them.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent discussion "
    "disqus footer masthead menu modal nav navbar navigation newsletter notice popup promo related replies respond share sharing "
    "sidebar social sponsored sponsor subscribe toolbar widget".split()
)
AROUND_WORDS = frozenset(
    "area articles bar block bottom box button buttons form global icons links list main message overlay posts primary "
    "secondary signup site slot stories top unit".split()
)
# Those a section can be about; an id is also the target of links to a section.
TOPICS = frozenset(
    "ad ads advert adverts advertisement banner consent cookie cookies menu navigation notice promo related share "
    "sharing social sponsored sponsor subscribe toolbar widget".split()
)
# A class that names a part of an article as well as comments.
PARTS = frozenset(("discussion",))
# Elements whose id only is a target of links.
TARGETS = HEADINGS | frozenset("p li dt dd a span".split())
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_EMPTY = re.compile(r"""(?:^|[\s"'])/\Z""")

_SENTENCE_ENDS = tuple(".!?…:;\"”’»)。！？")

# Where an element is sought among the open ones: not beyond these.
SCOPES = frozenset("table td th caption template object".split())
_LISTS = SCOPES | frozenset("ul ol menu dir".split())
_TABLE = frozenset(("table",))
_END_SCOPES = {"li": _LISTS, "table": frozenset(), "template": frozenset(), "object": frozenset()} | dict.fromkeys(
    "caption td th tr tbody thead tfoot".split(), _TABLE
)
# Start tag -> the elements it ends if their end tag is left out, and where the search for them stops.
_IMPLIED = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), SCOPES | {"dl"}),
    "dd": (frozenset(("dt", "dd")), SCOPES | {"dl"}),
    "td": (frozenset(("td", "th", "caption")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th", "caption")), frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption")), _TABLE),
    "tbody": (frozenset(("tbody", "thead", "tfoot", "caption")), _TABLE),
    "thead": (frozenset(("tbody", "thead", "tfoot", "caption")), _TABLE),
    "tfoot": (frozenset(("tbody", "thead", "tfoot", "caption")), _TABLE),
    "option": (frozenset(("option",)), SCOPES | {"select"}),
    "a": (frozenset(("a",)), SCOPES),
    "button": (frozenset(("button",)), SCOPES),
}
_ENDS_P = BLOCKS - frozenset("body html caption td th tr tbody thead tfoot summary figcaption".split())
_DRAWN = frozenset(("svg", "math"))
_HTML_IN_DRAWN = frozenset("foreignobject desc annotation-xml mtext".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_RAW_ENDS["title"] = re.compile(r"</title\s*>|(?=</?(?:head|body|title)\b)", re.I)


def _after_raw(html: str, name: str, at: int) -> int:
    """Where the content of a raw element that starts at ``at`` ends.

    Without an end tag scripts and styles are cut off by the end of the page, unless written as empty; a
    title ends at the next tag; of the others nothing is dropped.
    """
    if end := _RAW_ENDS[name].search(html, at):
        return end.end()
    if name == "title":
        return at + len(html[at:].partition("<")[0])
    return len(html) if name in ("script", "style") and html[at - 2] != "/" else at


def _names_boilerplate(token: str, but: frozenset = frozenset()) -> bool:
    words = [w for w in re.split("[-_]+", token) if w]
    named = BOILERPLATE_WORDS - but
    return any(w in named for w in words) and all(w in named or w in AROUND_WORDS for w in words)


def _is_boilerplate(name: str, rest: str, in_article: bool) -> bool:
    if name in CONTAINERS or name in ("html", "head", "body"):
        return False
    if name == "header":  # an article's own header holds its title
        return not in_article
    if name in BOILERPLATE:
        return True
    if "=" not in rest and "hidden" not in rest.lower():
        return False
    found: dict[str, str] = {}
    for attribute, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(attribute.lower(), "".join(values).lower())
    if found.get("hidden", "until-found") != "until-found" or found.get("aria-hidden") == "true":
        return True
    tokens = f"{found.get('class', '')} {found.get('role', '')}".split()
    parts = PARTS if in_article or name == "section" or name in TARGETS else frozenset()
    if "hidden" in tokens or any(_names_boilerplate(token, parts) for token in tokens) or _NO_DISPLAY.search(found.get("style", "")):
        return True
    if name in TARGETS:
        return False
    but = TOPICS | PARTS if in_article or name == "section" else frozenset()
    return any(_names_boilerplate(token, but) for token in found.get("id", "").split())


#: (text before the tag, name, whether it is an end tag, attributes)
Tag = tuple[str, str, bool, str]


def page_tags(html: str) -> list[Tag]:
    """All tags with the text before each, without comments and raw elements; the last has no name."""
    tags, at, text = [], 0, []
    while m := _MARKUP.search(html, at):
        text.append(html[at : m.start()])
        at = m.end()
        if m.group("name") is None:
            continue  # comments, declarations
        name, ends = m.group("name").lower(), bool(m.group("end"))
        if name in _RAW_ENDS:
            at = at if ends else _after_raw(html, name, at)
            continue
        tags.append(("".join(text), name, ends, m.group("rest")))
        text = []
    text.append(re.sub(r"<[!/a-zA-Z][^>]*\Z", "", html[at:]))  # a tag cut off by the end of the page
    tags.append(("".join(text), "", True, ""))
    return tags


def element_ends(tags: list[Tag]) -> tuple[list[int], list[bool]]:
    """For each start tag the place of the tag that ends its element, and whether that is its own end tag.

    End tags may be left out: an element also ends with the one around it, and p, li and their like before
    what they cannot hold.  Void and empty elements end where they start.
    """
    last = len(tags) - 1
    ends_at, closed = list(range(len(tags))), [False] * len(tags)
    opened: list[int] = []
    count = Counter()

    def pop(depth: int, at: int) -> None:
        for i in opened[depth:]:
            ends_at[i] = at
            count[tags[i][1]] -= 1
        del opened[depth:]

    def seek(names, stops) -> int:
        """Depth of the innermost open element among ``names``, or -1."""
        if any(count[n] for n in names):
            for depth in range(len(opened) - 1, -1, -1):
                name = tags[opened[depth]][1]
                if name in names:
                    return depth
                if name in stops:
                    break
        return -1

    for at, (_, name, ends, rest) in enumerate(tags):
        if ends:
            if name in ("", "html", "body"):
                continue
            depth = seek((name,), _END_SCOPES.get(name, SCOPES))
            if depth < 0:
                continue
            closed[opened[depth]] = True
            if name in INLINE and any(tags[i][1] in BLOCKS for i in opened[depth:]):
                ends_at[opened[depth]] = at  # blocks opened within stay open
                count[name] -= 1
                del opened[depth]
            else:
                pop(depth, at)
            continue
        if name in BLOCKS and (depth := seek(_DRAWN, _HTML_IN_DRAWN)) >= 0:
            pop(depth, at)
        if name in _ENDS_P and (depth := seek(("p",), BLOCKS)) >= 0:
            pop(depth, at)
        if name in _IMPLIED and (depth := seek(*_IMPLIED[name])) >= 0:
            pop(depth, at)
        if name not in VOID and not _EMPTY.search(rest):
            opened.append(at)
            count[name] += 1
    pop(0, last)
    return ends_at, closed


def page_lines(html: str) -> tuple[list[str], list[bool], list[bool]]:
    """Text of each line (references decoded, white space made one space), whether an article holds it, whether it is a heading.

    Outside articles a line of links alone is a menu entry and leaves an empty line.
    """
    tags = page_tags(html)
    ends_at, closed = element_ends(tags)
    lines: list[str] = []
    inside: list[bool] = []
    headings: list[bool] = []
    in_heading = False
    parts: list[str] = []
    holders: list[int] = []  # ends of the open containers
    plain = False  # the line has text outside links
    link_end, link_open = -1, False  # the end of a link; whether one without an end tag is open
    skip_end, whole, to_block = -1, False, False  # the boilerplate element that is left out
    wraps = False  # it may hold the article, as a form around the page does
    resumed: list[int] = []  # ends of containers within boilerplate, each before the end of that
    after: list[tuple[int, bool]] = []

    def close() -> None:
        nonlocal plain
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            lines.append(text if plain or holders else "")
            inside.append(bool(holders))
            headings.append(in_heading)
        parts.clear()
        plain = False

    def barrier() -> None:
        close()
        if holders:
            return
        lines.extend([""] * WINDOW_LINES)
        inside.extend([False] * WINDOW_LINES)
        headings.extend([False] * WINDOW_LINES)

    for at, (text, name, ends, rest) in enumerate(tags):
        container = name in CONTAINERS and not ends
        if skip_end < 0:
            if text:
                parts.append(text)
                plain = plain or not (link_open or at <= link_end) and not text.isspace()
        elif at >= skip_end or to_block and name in BLOCKS:
            skip_end = -1
        elif container and (not whole or name == "main" or wraps):
            if whole:  # what is left of the boilerplate element after the container is left out too
                resumed.append(ends_at[at])
                after.append((skip_end, wraps))
            skip_end = -1
        else:
            continue
        while holders and holders[-1] <= at:
            close()
            holders.pop()
            barrier()
        if resumed and resumed[-1] <= at:
            resumed.pop()
            (skip_end, wraps), whole, to_block = after.pop(), True, False
            if at < skip_end:
                continue
            skip_end = -1
        if name in BLOCKS:
            link_open = False
        if container:
            barrier()
            holders.append(ends_at[at])
        elif not ends and (name in FOREIGN or _is_boilerplate(name, rest, bool(holders))):
            if name not in FOREIGN:
                barrier()
            if ends_at[at] > at:
                # Without its own end tag an element is left out up to the next container, or block if it is inline.
                skip_end, whole, to_block = ends_at[at], closed[at], not closed[at] and name not in BLOCKS
                wraps = name == "form"
        elif name == "a":
            if not ends:
                link_end, link_open = ends_at[at] if closed[at] else -1, not closed[at] and ends_at[at] > at
            else:
                link_open = False
        elif name not in INLINE and name not in FOREIGN:
            close()
            in_heading = not ends if name in HEADINGS else in_heading and name == "br"
    close()
    return lines, inside, headings


def text_edges(lines: list[str], headings: list[bool]) -> tuple[int, int]:
    """Surge and dive within a block of lines: where the sum over a window crosses a threshold taken from its lines.

    Half of the block's text lies in lines at least as long as the threshold's base. The window ends at a line on the way
    in and begins at it on the way out, so text further inside does not carry the lines at the edge.
    """
    lengths = np.array([len(line) for line in lines], np.int64)
    falling = np.sort(lengths)[::-1]
    base = falling[np.searchsorted(np.cumsum(falling), lengths.sum() / 2)]
    ones = np.ones(WINDOW_LINES, np.int64)
    least = min(LEAST_SUM, EDGE_SHARE * base)
    prose = np.array([line.endswith(_SENTENCE_ENDS) for line in lines], bool)
    # Sums of the window that ends, and of the one that begins, at each line.
    behind = np.convolve(lengths, ones)[: len(lines)]
    ahead = np.convolve(lengths, ones)[WINDOW_LINES - 1 :]
    surge = int(np.argmax((behind >= least) | prose))
    dive = len(lines) - int(np.argmax(((ahead >= least) | prose)[::-1]))
    while surge and headings[surge - 1]:
        surge -= 1
    return surge, dive


def main_text(html: str) -> str:
    """The page's main text; empty if it has none."""
    lines, inside, headings = page_lines(html)
    lengths = np.array([len(line) for line in lines], dtype=np.int64)
    weighted = np.where(np.array(inside, bool), CONTAINER_WEIGHT * lengths, lengths)
    padded = np.concatenate([weighted, np.zeros(WINDOW_LINES - 1, np.int64)])
    sums = np.convolve(padded, np.ones(WINDOW_LINES, np.int64), "valid")
    if not len(sums) or not sums.max():
        return ""
    threshold = min(LEAST_SUM, LEAST_SHARE * sums.max())
    rising = np.diff((sums > 0).astype(np.int8), prepend=0, append=0)
    kept = []
    for surge, dive in zip(np.flatnonzero(rising > 0), np.flatnonzero(rising < 0)):
        if sums[surge:dive].max() >= threshold:
            # The window looks ahead, so the last lines with text lie before the dive.
            block = [i for i in range(surge, min(dive + WINDOW_LINES - 1, len(lines))) if lengths[i]]
            if not inside[block[0]] and sums[surge:dive].max() >= LEAST_SUM:
                first, last = text_edges([lines[i] for i in block], [headings[i] for i in block])
                block = block[first:last]
            kept += [lines[i] for i in block]
    return " ".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A null or empty page has an empty text; repeated rows each get a row; other columns are ignored.
    """

    def extract(html: str) -> tuple:
        text = main_text(html)
        return text, len(text)

    return pages.select("page_id", "url", per_text(extract, "text string, n_chars long")("html").alias("r")).select(
        "page_id", "url", "r.*"
    )
