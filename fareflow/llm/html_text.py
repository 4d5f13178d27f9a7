"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by themselves: blocks inside navigation, headers, footers,
forms, scripts and the like, or inside elements named as such, are boilerplate; of the others the link density, the length and the
density of stop words decide: few links, long and many stop words is content; many links is boilerplate; short blocks and blocks
with a middling density stay open. In the second pass an open block inherits from its nearest decided neighbours before
and after: content if both are, and boilerplate if both are; if they disagree or are missing, the block goes by where it stands, content inside an
article or main element and boilerplate elsewhere.

Neighbours are looked for within one section of the page (an article, or what is outside all of them), so an advert next to
an article doesn't inherit from it, nor it from the advert. A long block inside an article is never boilerplate for a lack of stop
words, as a text's language may not be among the lists.

Character references are decoded, white space in a block is one space, blocks are joined by one line feed in page order.
Nothing else is dropped, and nothing is cut.

Defined cases. A null or empty page has an empty text. Markup that never ends (a script, a comment, a tag) lasts to the end of the
page. Repeated rows are extracted each. Columns named like the ones added (``text``, ``n_chars``) are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fareflow.llm.store import without

# Elements by role.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button option "
                   "datalist head".split())
BOILER = frozenset("nav header footer aside form menu dialog fieldset label".split())
SECTION = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul"
    .split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = BLOCK - {"br"}
# Words by which elements are named that hold no main text.
BOILER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|header|masthead|menu|modal|nav\w*|"
    r"newsletter|notices?|notification|pagination|pager|popup|promo\w*|related|replies|respond|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|toolbar|widget\w*|toc)(?:$|[\s_-])", re.I)
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article(?:-?body)?|post-?(?:body|content)|entry-?content|main-?content|story(?:-?body)?)(?:$|[\s_-])", re.I)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Frequent words of some languages.
STOP_WORDS = frozenset((
    "a about after all also an and are as at be because been but by can could did do for from had has have he her his how i if in into is it "
    "its may more most my no not of on one or our out over she so some such than that the their them then there these they this to up was we "
    "were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist ja "
    "kann mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wenn wie wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle elles en est et eu il ils je la le les leur lui mais me mes ne nous on ou où par pas "
    "plus pour qu que qui sa sans se ses son sont sur un une vous "
    "al como con de del desde donde el ella en entre era es esta este fue ha hasta la las lo los más me mi muy no nos o para pero por que "
    "se ser si sin sobre son su sus también te tiene un una unos y ya yo").split())

TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|$|=)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
MARKS = re.compile(r"^[^\w]+|[\W_]+$")


@dataclass(frozen=True)
class Rules:
    most_links: float = 0.5
    short: int = 70
    few_stops: float = 0.15
    many_stops: float = 0.25


@dataclass
class Block:
    section: int
    inside: bool  # of an article or main element
    boiler: bool
    heading: bool = False
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)  # the parts inside links

    def text(self) -> str:
        return _plain(self.parts)

    def linked(self) -> int:
        return len(_plain(self.links))


def _plain(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def _named(attributes: str) -> tuple[bool, bool]:
    """Whether an element's class, id or role names boilerplate, or content."""
    boiler = content = False
    for key, a, b, c in NAMED.findall(attributes):
        value = a or b or c
        if key.lower() == "role":
            boiler |= value.lower() in BOILER_ROLES
            content |= value.lower() in ("main", "article")
        else:
            boiler |= bool(BOILER_NAMES.search(value))
            content |= bool(CONTENT_NAMES.search(value))
    return boiler, content


def blocks_of(page: str) -> list[Block]:
    blocks: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # element, boilerplate, inside an article, section
    boiler, inside, section, sections, links = False, False, 0, 0, 0
    now: Block | None = None
    at, n = 0, len(page)
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            mark = n
        token = TOKENS.match(page, mark) if mark < n else None
        stop = mark if token is not None or mark == n else mark + 1  # a lone "<" is text
        if stop > at:
            piece = page[at:stop]
            if now is None:
                now = Block(section, inside, boiler, bool(stack) and stack[-1][0] in HEADINGS)
                blocks.append(now)
            now.parts.append(piece)
            if links:
                now.links.append(piece)
        if token is None:
            at = stop
            continue
        at = token.end()
        name = (token[1] or "").lower()
        if not name:
            continue
        closing = page.startswith("</", mark)
        attributes = token[2] or ""
        if name in SILENT and not closing:
            end = re.compile(rf"</{re.escape(name)}(?![^\s/>])[^>]*>", re.I).search(page, at)
            if name in ("head", "button", "option", "svg", "math", "select") and end is None:
                continue  # its end tag is missing, its content is not raw
            at = end.end() if end else n
            now = None if name in BLOCK or name == "head" else now
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name in BLOCK:
            now = None
        if name in VOID or name not in BLOCK and name not in BOILER and name not in SECTION:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    _, boiler, inside, section = stack[depth]
                    del stack[depth:]
                    links = 0
                    break
        elif not attributes.rstrip().endswith("/") or name not in VOID:
            if name in ENDS_PARAGRAPH and stack and stack[-1][0] == "p":
                _, boiler, inside, section = stack.pop()  # a block ends an open paragraph
            if name == "li" and stack and stack[-1][0] == "li":
                _, boiler, inside, section = stack.pop()
            stack.append((name, boiler, inside, section))
            bad, good = _named(attributes) if attributes else (False, False)
            main = name in SECTION or good
            if main and not inside and not boiler:
                sections += 1
                section, inside = sections, True
            # An article's own header is its title; a page's is not.
            boiler = boiler or (bad and not main) or name in BOILER and not (name == "header" and inside) or bool(
                attributes and HIDDEN.search(attributes))
    return blocks


def first_pass(block: Block, text: str, rules: Rules) -> bool | None:
    """True for content, False for boilerplate, None for open."""
    if block.boiler:
        return False
    if block.linked() > rules.most_links * len(text):
        return False
    if len(text) < rules.short:
        return None
    words = [MARKS.sub("", w) for w in text.lower().split()]
    stops = sum(w in STOP_WORDS for w in words) / len(words)
    if stops >= rules.many_stops:
        return True
    return None if stops >= rules.few_stops or block.inside else False


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    found = [(b, b.text()) for b in blocks_of(page or "")]
    found = [(b, t) for b, t in found if t]
    labels = [first_pass(b, t, rules) for b, t in found]
    final = list(labels)
    for way in (range(len(found)), range(len(found) - 1, -1, -1)):  # nearest decided one before, then after
        nearest: dict[int, bool | None] = {}
        for i in way:
            block = found[i][0]
            if labels[i] is not None:
                if not block.boiler:
                    nearest[block.section] = labels[i]
            else:
                seen = nearest.get(block.section)
                final[i] = (final[i] or ()) + (seen,) if isinstance(final[i], tuple) else (seen,)
    out = []
    for (block, text), label in zip(found, final):
        if isinstance(label, tuple):
            before, after = label
            if block.heading and after is not None:
                label = after
            else:
                label = before if before == after and before is not None else block.inside
        if label:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, rules: Rules = Rules(), column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` instead of the markup."""
    pages = without(pages, "text", "n_chars")
    kept = [f for f in pages.schema.fields if f.name != column]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    at = pages.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), rules) for page in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if i != at), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)
    return pages.mapInArrow(run, schema)
