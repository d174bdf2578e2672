"""The main text of web pages by scoring their element tree.

A page is read into block elements. Each paragraph passes points for its length and commas,
less its share of link text, to the elements around it: all to its parent, half to the one
above, less and less to those further out. Elements that say what they are (article,
main) start with points, as do class and id names of content. The best container, discounted
by its own share of links, is kept with those siblings that score enough themselves.
Menus, forms and the like are left out wherever they stand, and so is what a class or id names as comments,
adverts, notices and so on, whatever its size; `blocks` tells which names are not final.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import mapped, pieces, table

#: A comment, a declaration, or a tag; quoted attribute values may hold ">".
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>", re.DOTALL)
ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

BLOCKS = frozenset(
    "html body main article section div p pre blockquote center address details summary figure "
    "figcaption h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td "
    "th header footer nav aside form fieldset menu dialog hr head title search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never part of the main text.
OUT = frozenset(
    "script style noscript template iframe object embed svg canvas audio video map head title nav "
    "footer aside form fieldset button select option datalist textarea menu dialog search noembed "
    "noframes".split())
#: What an opening tag closes, besides an open paragraph closed by any block.
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
          "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu "
                  "menubar toolbar alertdialog".split())


def _names(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{words})(?:$|[\s_-])", re.IGNORECASE)


#: What such a name speaks against is never main text.
FOREIGN = _names(
    r"ads?|adverts?|advertis\w*|adsense|sponsor\w*|promo\w*|comments?|commentlist|disqus|respond|"
    r"repl(?:y|ies)|cookies?|consent|gdpr|newsletter|subscri\w*|sign-?up|log-?in|share|sharing|social")
#: Nor is this, but for elements that are named content as well, and pages with no other text.
ASIDE = _names(
    r"banner|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|notices?|alert|pop-?up|modal|"
    r"overlay|related|recommend\w*|pagination|pager")
#: Names of parts of a page that may also hold all of it.
PART = _names(r"masthead|top-?bar|widget|toolbar|skip|header")
LEVELS = ((3, FOREIGN), (2, ASIDE), (1, PART))
WANTED = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|page)(?:$|[\s_-])",
                    re.IGNORECASE)

#: A name that tells what an element has beside or below it, not what it is.
BESIDE = re.compile(r"(?:no|has|with|without)[_-]|.*[_-](?:open|closed|enabled|disabled|on|off)$", re.IGNORECASE)

#: Characters from which a block passes points.
SCORES = 25

START = {"article": 25, "main": 25, "section": 3, "div": 5, "pre": 3, "td": 3, "blockquote": 3}


class Element:
    __slots__ = ("tag", "parent", "out", "doubt", "score", "chars", "link_chars", "within")

    def __init__(self, tag: str, parent: Element | None, out: bool, bonus: float, within: bool,
                 doubt: Doubt | None = None) -> None:
        self.tag, self.parent, self.out, self.score = tag, parent, out, bonus
        #: The innermost element around it that is left out by its name alone.
        self.doubt = doubt
        self.chars = self.link_chars = 0
        #: Whether an article or main element stands around it.
        self.within = within


class Doubt:
    """An element that only its class or id speaks against, and how strongly; its own text, and
    that of all below it."""
    __slots__ = ("at", "around", "level", "content", "own", "chars", "link_chars", "inner")

    def __init__(self, at: int, around: Doubt | None, level: int, content: bool) -> None:
        self.at, self.around, self.level, self.content = at, around, level, content
        self.own = self.chars = self.link_chars = 0
        self.inner: list[Doubt] = []

    def text(self) -> bool:
        """Whether it is text rather than links."""
        return self.chars > 0 and 2 * self.link_chars <= self.chars


def named(attributes: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    return found


def unwanted(tag: str, given: dict[str, str], within: bool) -> bool:
    """Whether an element is left out by what it is."""
    if tag in OUT or tag == "header" and not within:
        return True
    if tag in ("html", "body", "main") or not given:
        return False
    if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role") in ROLES:
        return True
    style = given.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style


def names(given: dict[str, str]) -> list[str]:
    return f"{given.get('class', '')} {given.get('id', '')}".split()


def spoken_against(name: str, tag: str, within: bool) -> int:
    """How strongly one class or id tells that an element is left out: a level, or 0."""
    if within and tag in ("header", "h1", "h2", "hgroup", "div"):
        # An article's own header names its title.
        name = re.sub("header", "", name, flags=re.IGNORECASE)
    if BESIDE.match(name):
        return 0
    return next((level for level, pattern in LEVELS if pattern.search(name)), 0)


def content(given: dict[str, str]) -> bool:
    """Whether a class or id of its own, not one like post-comments, names content."""
    return any(WANTED.search(name) and not any(pattern.search(name) for _, pattern in LEVELS)
               for name in names(given))


def blocks(page: str) -> list[tuple[Element, str, int]]:
    """(element, text, characters in links) of each block of wanted text, in page order.

    An element that only its name speaks against stays where it is an article or named content as well,
    unless the name is one of FOREIGN. Where nothing else on the page is long enough to score, a
    PART stays, and an ASIDE where there is no other text at all: the one with most text, and of
    those inside it, while it has no such text of its own, again that with most.
    """
    found, doubts = read(page, frozenset())
    spared = {d.at for d in doubts if d.level < 3 and d.content and d.text()}
    if spared:
        found, doubts = read(page, frozenset(spared))
    if any(len(text) >= SCORES for _, text, _ in found):
        return found
    strongest = 1 if found else 2
    inside = [d for d in doubts if d.around is None]
    before = len(spared)
    while inside := [d for d in inside if d.level <= strongest and d.text()]:
        most = max(inside, key=lambda d: d.chars)
        spared.add(most.at)
        if most.own >= SCORES:
            break
        inside = most.inner
    return read(page, frozenset(spared))[0] if len(spared) > before else found


def read(page: str, spared: frozenset[int]) -> tuple[list[tuple[Element, str, int]], list[Doubt]]:
    """The blocks, and what was left out by name alone.

    Elements that start at one of `spared` are not left out by name.
    """
    closing = page.rfind(">")
    cut = re.compile(r"<[a-zA-Z/!?]").search(page, closing + 1)
    if cut and not page.startswith("<!--", cut.start()):
        page = page[:cut.start()]  # a tag that the page's end cuts short
    top = Element("", None, False, 0, False)
    stack: list[tuple[str, Element]] = [("", top)]
    opened: Counter[str] = Counter()
    found: list[tuple[Element, str, int]] = []
    held: list[str] = []
    linked = [0]
    doubts: list[Doubt] = []

    def text(raw: str) -> None:
        element = stack[-1][1]
        if element.out or not raw:
            return
        if element.doubt is not None:
            size = sum(map(len, raw.split()))
            element.doubt.own += size
            element.doubt.chars += size
            element.doubt.link_chars += size if opened["a"] else 0
        else:
            held.append(raw)
            if opened["a"]:
                linked[0] += len(raw)

    def flush() -> None:
        if held:
            whole = " ".join(html.unescape("".join(held)).split())
            if whole:
                found.append((stack[-1][1], whole, min(linked[0], len(whole))))
            held.clear()
        linked[0] = 0

    def close(tag: str) -> None:
        """Close elements up to the innermost open `tag`."""
        while stack[-1][0] != tag:
            opened[stack.pop()[0]] -= 1
        stack.pop()
        opened[tag] -= 1

    def close_any(tags: str, limits: tuple[str, ...]) -> None:
        """Close the outermost open one of `tags` that is not beyond one of `limits`."""
        names, at, target = tags.split(), len(stack) - 1, 0
        while at > 0 and stack[at][0] not in limits:
            if stack[at][0] in names:
                target = at
            at -= 1
        while target and len(stack) > target:
            opened[stack.pop()[0]] -= 1

    at, search = 0, MARKUP.search
    while True:
        match = search(page, at)
        if match is None:
            text(page[at:])
            break
        if match.start() > at:
            text(page[at:match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag, ends, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        block = tag in BLOCKS
        if block:
            flush()
        elif tag == "br":
            text(" ")
        if ends:
            if opened[tag]:
                if block:
                    close(tag)
                else:  # an inline end tag does not close blocks
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == tag:
                            opened[tag] -= 1
                            del stack[depth]
                            break
                        if stack[depth][0] in BLOCKS:
                            break
            continue
        if block and opened["p"] and tag not in ("html", "body", "head"):
            depth = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p")
            if not any(name in ("td", "th", "button", "object") for name, _ in stack[depth:]):
                close("p")
        if tag in CLOSES:
            close_any(*CLOSES[tag])
        parent = stack[-1][1]
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            if tag == "textarea" or tag in OUT:
                at = end.end() if end else len(page)
                continue
            text(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        given = named(attributes) if len(attributes) > 1 else {}
        out, doubt = parent.out or unwanted(tag, given, parent.within), parent.doubt
        against = 0
        if given and not out and tag not in ("html", "body", "main"):
            against = max((spoken_against(name, tag, parent.within) for name in names(given)), default=0)
        if against and match.start() not in spared:
            doubt = Doubt(match.start(), parent.doubt, against, tag == "article" or content(given))
            doubts.append(doubt)
        if block or out != parent.out or doubt is not parent.doubt:
            bonus = START.get(tag, 0)
            if given and (content(given) if against else any(map(WANTED.search, names(given)))):
                bonus += 25
            element = Element(tag, parent, out, bonus, parent.within or tag in ("article", "main"), doubt)
        else:
            element = parent
        stack.append((tag, element))
        opened[tag] += 1
    flush()
    for doubt in reversed(doubts):  # inner ones first
        if doubt.around is not None:
            doubt.around.chars += doubt.chars
            doubt.around.link_chars += doubt.link_chars
            doubt.around.inner.append(doubt)
    return found, doubts


def main_text(page: str) -> str:
    """The main text: wanted blocks of the best container and its siblings, one per line.

    A page without wanted text gives "". A page none of whose blocks is long enough to score
    gives all wanted blocks of its article or main element, or else of the whole page.
    """
    found = blocks(page)
    scored: dict[int, Element] = {}
    most = 0.0
    for element, text, links in found:
        commas = text.count(",") + text.count("，") + text.count("、")
        points = 1 + commas + min(len(text) // 100, 3) if len(text) >= SCORES else 0
        points *= 1 - links / len(text)
        most = max(most, points)
        around, level = element, 0
        if element.tag not in ("p", "pre", "td", "li", "blockquote", "dd") and not element.tag.startswith("h"):
            level = 1  # text that stands in a container itself
        while around is not None:
            around.chars += len(text)
            around.link_chars += links
            if level:
                around.score += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
                scored[id(around)] = around
            around, level = around.parent, level + 1
    if not most:
        inside = [text for element, text, links in found if element.within]
        return "\n".join(inside or [text for element, text, links in found])

    def worth(element: Element) -> float:
        return element.score * (1 - element.link_chars / max(element.chars, 1))

    best = max(scored.values(), key=worth)
    around = best
    while around is not None:  # the article, where there is one, is the container
        if around.tag in ("article", "main"):
            best = around
            break
        around = around.parent
    least = max(10.0, 0.2 * worth(best))
    home = best.parent if best.tag not in ("", "html", "body", "main") else None

    def kept(element: Element, text: str, links: int) -> bool:
        last, around = element, element
        while around is not None:
            if around is best:
                return True
            if around is home:
                if best.tag in ("article", "main") and last.tag not in ("article", "section", "div", "p"):
                    return False
                if worth(last) >= least and id(last) in scored:
                    return last.link_chars <= last.chars / 4
                plain = last is element and element.tag == "p"
                return plain and best.tag not in ("article", "main") and len(text) > 80 and links < len(text) / 4
            last, around = around, around.parent
        return False

    return "\n".join(text for element, text, links in found if kept(element, text, links))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages`; n_chars are code points.

    A null html counts as empty and gives an empty text. Repeated rows are read each, other
    columns are ignored, nothing is cut off: a page of any length is read whole, in a batch of its own
    where it is long. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return mapped(pages.select("page_id", F.col("url").cast("string").alias("url"),
                               F.col("html").cast("string").alias("html")), run,
                  f"page_id {kind}, url string, text string, n_chars long")


def op4_html_text(spark, folder: str) -> DataFrame:
    """Every page with its main text."""
    return extract(table(spark, folder, "pages"))
