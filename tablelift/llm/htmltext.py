"""The main text of web pages by text-to-tag ratios.

Parser events of the standard library cut a page into lines, one for each block of text.  The ratio of
text to tags of the lines, smoothed with a Gaussian, is split at a threshold into content and the rest.
Content decides which region of the page is the article; of that region every line stays, except those in
parts that are never article text (menus, adverts, comments and the like).  Names and forms mark such parts
only as long as they do not hold the article or most of the content.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tablelift.llm.common import Rows, utf8

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NEVER = set(
    "head title script style noscript template iframe object svg math canvas audio video nav aside footer button select "
    "textarea menu dialog".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
REGIONS = set("article body div main section td".split())
MAIN = set("article main".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEPS_OPEN = set("ul ol dl table select article section div body".split())
#: Words that page builders give to every block.
BUILDER = {"widget"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|comment-?list|consent|cookies?|copyright|disclaimer|"
    r"disqus|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|"
    r"related|replies|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|toolbar|widget)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Names of what a page has or lacks, such as has-sidebar.
ABOUT = re.compile(r"(?i)\b(?:has|no|with)-\S+")
HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-?title)(?:$|[\s_-])", re.IGNORECASE)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: Standard deviation of the smoothing in lines, and how far it reaches.
SIGMA = 1.0
REACH = 3
#: Share of the content that the chosen region must hold.
SHARE = 0.8
#: Constructs left open that are searched to the end of a page.
CUT_OFF = 50
#: A part is not excluded by its name if it holds more than this share of the content.
MOST = 0.5


class Line:
    """A block of text: its words, the tags inside it, the innermost region and named part, and whether it can be content."""

    __slots__ = ("parts", "tags", "region", "never", "named")

    def __init__(self, region: int, never: bool, named: int):
        self.parts: list[str] = []
        self.tags, self.region, self.never, self.named = 1, region, never, named

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class _Page(HTMLParser):
    """Lines of a page.  Regions and named parts point to the one around them (-1: none), numbered as they open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # tag, whether never content, region, named part
        self.at: dict[str, list[int]] = {}  # where in ``open`` each tag stands
        self.blocks: list[int] = []  # where in ``open`` blocks stand
        self.names: list[set[str]] = []  # of each named part the words that speak against it
        self.part_of: list[int] = []  # of each named part the one around it
        self.depth: list[int] = []  # of each named part how many are around it
        self.main: list[bool] = []
        self.region_of: list[int] = []  # of each region the one around it
        self.in_main: list[bool] = []  # of each region whether it or one around it is main
        self.outside: dict[int, int] = {}  # of each article without such words itself the named part around it
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.cut_off = 0

    def _scan(self, parse, i: int) -> int:
        """Constructs that the page never closes make the parser search to its end; after ``CUT_OFF`` of them they are text."""
        if self.cut_off >= CUT_OFF:
            return -1
        k = parse(i)
        self.cut_off += k < 0
        return k

    def parse_starttag(self, i):
        return self._scan(super().parse_starttag, i)

    def parse_endtag(self, i):
        return self._scan(super().parse_endtag, i)

    def parse_html_declaration(self, i):
        return self._scan(super().parse_html_declaration, i)

    def parse_comment(self, i, report=1):
        return self._scan(super().parse_comment, i)

    def parse_pi(self, i):
        return self._scan(super().parse_pi, i)

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, -1, -1)

    def _push(self, tag: str, never: bool, region: int, named: int) -> None:
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, never, region, named))

    def _never(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in NEVER or "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style") or ""):
            return True
        region = self._state()[1]
        inside_main = region >= 0 and self.in_main[region]
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        if tag == "header" or HEADER.search(names):
            return not inside_main
        return tag not in ("body", "html", "article", "main", "form") and (attrs.get("role") or "").lower() in ROLES - {"form"}

    def _words(self, tag: str, attrs: dict[str, str | None]) -> set[str]:
        """The words for which a part may be no content."""
        if tag in ("body", "html"):
            return set()
        names = ABOUT.sub("", f"{attrs.get('class') or ''} {attrs.get('id') or ''}")
        words = {w.lower() for w in BOILERPLATE.findall(names)}
        if tag in MAIN and not words:
            return set()
        role = (attrs.get("role") or "").lower()
        return words | ({"form"} if tag == "form" or role == "form" else set()) | ({role} if role in ROLES else set())

    def _last(self, tags) -> int:
        """Where the innermost open one of ``tags`` stands, or -1."""
        return max((places[-1] for t in tags if (places := self.at.get(t))), default=-1)

    def _last_block(self, but: str) -> int:
        return next((k for k in reversed(self.blocks) if self.open[k][0] != but), -1)

    def _close_to(self, found: int, stop: int) -> None:
        """Close all that is open from ``found`` on, unless ``stop`` stands inside it."""
        if found < 0 or stop > found:
            return
        for tag, *_ in reversed(self.open[found:]):
            self.at[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
        del self.open[found:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.line = None
            self._close_to(self._last(("p",)), self._last_block("p"))
        if tag in CLOSES_ITSELF:
            self._close_to(self._last(CLOSES_ITSELF[tag]), self._last(KEEPS_OPEN - CLOSES_ITSELF[tag]))
        if tag == "br":
            self.handle_data("\n")
        if self.line:
            self.line.tags += 1
        if tag in VOID:
            return
        never, region, named = self._state()
        values = dict(attrs)
        own = self._never(tag, values)
        if words := self._words(tag, values):
            self.part_of.append(named)
            self.depth.append(self.depth[named] + 1 if named >= 0 else 1)
            named = len(self.names)
            self.names.append(words)
        if tag in REGIONS:
            main = tag in MAIN or (values.get("role") or "").lower() == "main"
            self.region_of.append(region)
            self.in_main.append(main or region >= 0 and self.in_main[region])
            region = len(self.main)
            self.main.append(main)
            if main and not words:
                self.outside[region] = named
        self._push(tag, never or own, region, named)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.line = None
        elif self.line:
            self.line.tags += 1
        self._close_to(self._last((tag,)), -1 if tag in BLOCKS and tag != "p" else self._last_block(tag))

    def handle_data(self, data):
        never, region, named = self._state()
        if self.line is not None and (self.line.never != never or self.line.region != region or self.line.named != named):
            if not data.strip():
                return
            if never or self._depth(named) > self._depth(self.line.named):  # such a part inside a line: the line goes on after it
                return
            self.line = None
        if self.line is None:
            if not data.strip() or never and self.open and self.open[-1][0] in ("script", "style", "title"):
                return
            self.line = Line(region, never, named)
            self.lines.append(self.line)
        self.line.parts.append(data)

    def _depth(self, named: int) -> int:
        return self.depth[named] if named >= 0 else 0


def smoothed(values: list[float], sigma: float = SIGMA, reach: int = REACH) -> list[float]:
    """Gaussian average of each value and its neighbours."""
    weights = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        around = range(max(0, i - reach), min(len(values), i + reach + 1))
        out.append(sum(values[j] * weights[abs(i - j)] for j in around) / sum(weights[abs(i - j)] for j in around))
    return out


def threshold(values: list[float]) -> float:
    """Where two clusters of the values part: halfway between their means, settled from the overall mean.

    Content is what lies above it.  Values that are all alike are one cluster, and all of them lie above.
    """
    least, most = min(values), max(values)
    if most - least <= 1e-6 * abs(most):
        return least - 1
    cut = sum(values) / len(values)
    for _ in range(50):
        low, high = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not low or not high:
            return least - 1 if not low else cut
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def _content(lines: list[tuple[Line, str]]) -> list[bool]:
    """Which lines are content by their smoothed text-to-tag ratios."""
    ratios = smoothed([0.0 if line.never else len(text) / line.tags for line, text in lines])
    usable = [r for r, (line, _) in zip(ratios, lines) if not line.never]
    # Lines that cannot be content are the lower cluster where there are any; alone, the usable ones may be all alike.
    cut = threshold(ratios)
    if usable and not any(r > cut for r in usable):
        cut = threshold(usable)
    return [not line.never and r > cut for r, (line, _) in zip(ratios, lines)]


def _upward(sums: dict[int, int], parents: list[int]) -> list[int]:
    """What each part holds with all parts inside it, from what it holds itself; parts open after those around them."""
    out = [0] * len(parents)
    for part, n in sums.items():
        if part >= 0:
            out[part] += n
    for part in range(len(parents) - 1, -1, -1):
        if parents[part] >= 0:
            out[parents[part]] += out[part]
    return out


def _sums(pairs) -> dict[int, int]:
    out: dict[int, int] = {}
    for part, n in pairs:
        out[part] = out.get(part, 0) + n
    return out


def _downward(own: list, parents: list[int], join) -> list:
    """Of each part what ``join`` makes of its own value and that of the part around it."""
    out = list(own)
    for part, parent in enumerate(parents):
        if parent >= 0:
            out[part] = join(out[part], out[parent])
    return out


def exclude_named(page: _Page, lines: list[tuple[Line, str]]) -> None:
    """Mark the lines of parts whose names speak against them, unless they hold the article or most of the content."""
    if not any(line.named >= 0 for line, _ in lines):
        return
    content = [(line, len(text)) for (line, text), yes in zip(lines, _content(lines)) if yes]
    in_main = [(line, n) for line, n in content if line.region >= 0 and page.in_main[line.region]]
    allowed = [False] * len(page.names)
    if any(line.named < 0 for line, _ in in_main):
        content = in_main  # what is outside the article, such as long comments, cannot outweigh it
    else:  # every article is in a named part; names of the article itself count
        held = _upward(_sums((line.region, n) for line, n in in_main), page.region_of)
        for region, named in page.outside.items():
            if held[region]:
                while named >= 0 and not allowed[named]:
                    allowed[named], named = True, page.part_of[named]
    total = sum(n for _, n in content)
    mass = _upward(_sums((line.named, n) for line, n in content), page.part_of)
    allowed = [a or n > MOST * total for a, n in zip(allowed, mass)]
    # Words of the blocks of a page builder: most of the content is in parts with that word.
    by_word: dict[str, int] = {}
    words = _downward([frozenset(w) for w in page.names], page.part_of, lambda own, around: own if own <= around else own | around)
    for line, n in content:
        for word in words[line.named] if line.named >= 0 else ():
            by_word[word] = by_word.get(word, 0) + n
    common = {w for w, n in by_word.items() if n > MOST * total and (w in BUILDER or not any(allowed))}
    against = [not a and bool(w - common) for a, w in zip(allowed, page.names)]
    against = _downward(against, page.part_of, lambda own, around: own or around)
    for line, _ in lines:
        line.never = line.never or line.named >= 0 and against[line.named]


def extract(html: str | None) -> str:
    """Main text of a page: blocks joined by two line feeds."""
    page = _Page()
    page.feed(html or "")
    page.close()
    lines = [(line, text) for line in page.lines if (text := line.text())]
    exclude_named(page, lines)
    usable = [(line, text) for line, text in lines if not line.never]
    if not usable:
        return ""
    content = [(line, len(text)) for (line, text), yes in zip(lines, _content(lines)) if yes]
    if any(page.in_main[line.region] for line, _ in usable if line.region >= 0):
        # All articles of the page: those that hold content, and those beside them.
        return "\n\n".join(text for line, text in usable if line.region >= 0 and page.in_main[line.region])
    held = _upward(_sums((line.region, n) for line, n in content), page.region_of)
    total = sum(n for _, n in content)
    enough = [r for r, n in enumerate(held) if n and n >= SHARE * total]
    if not enough:
        return "\n\n".join(text for _, text in usable)
    region = enough[-1]  # the innermost: regions are numbered as they open
    lines_in = _upward(_sums((line.region, 1) for line, _ in usable), page.region_of)
    while lines_in[region] == 1 and page.region_of[region] >= 0:  # a block of its own, not what holds the article's blocks
        region = page.region_of[region]
    inside = [r == region for r in range(len(held))]
    inside = _downward(inside, page.region_of, lambda own, around: own or around)
    return "\n\n".join(text for line, text in usable if line.region >= 0 and inside[line.region])


def _text_rows(batches):
    rows = None
    for batch in batches:
        page_id, url, html = (batch.column(n) for n in ("page_id", "url", "html"))
        if rows is None:
            rows = Rows(pa.schema([("page_id", page_id.type), ("url", url.type), ("text", pa.string()), ("n_chars", pa.int64())]))
        for k in range(batch.num_rows):
            text = extract((html[k].as_py() or b"").decode("utf-8", "replace"))
            rows.add(page_id[k].as_py(), url[k].as_py(), text, len(text), size=len(text))
            if rows.full():
                yield from rows.take()
    if rows is not None:
        yield from rows.take()


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    A null or empty ``html``, and a page without article text, give an empty text.  Null ids and urls are
    carried along, repeated rows get a row each, an empty table gives no rows, other columns are not read.
    Pages are parsed whole; broken ones as far as they go.
    """
    rows = pages.select("page_id", "url", utf8("html").alias("html"))
    schema = T.StructType(
        [*pages.select("page_id", "url").schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return rows.mapInArrow(_text_rows, schema)
