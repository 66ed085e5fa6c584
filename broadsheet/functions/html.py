"""Small per-page helper for what regular expressions cannot do: nested HTML elements.

The operators call it inside Arrow batch functions, so Spark partitions the pages and moves
the results.
"""

from __future__ import annotations

from html.parser import HTMLParser

# Elements without an end tag, elements whose text is not page text, the
# selectors of the metadata script, the tag line and the article body, the sitemap table id.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
OPAQUE = frozenset({"script", "style", "template"})
METADATA_TYPE = "application/ld+json"
METADATA_CLASS = "rank-math-schema"
TAGS_CLASS = "entry-category-header default-max-width"
BODY_CLASS = "entry-content"
SITEMAP_TABLE_ID = "sitemap"


class Element:
    """A start tag with the ranges of elements and text pieces it encloses."""

    __slots__ = ("name", "attrs", "opaque", "inner", "text_range")

    def __init__(self, name: str, attrs: dict, opaque: str | None, at: int, piece: int):
        self.name, self.attrs, self.opaque = name, attrs, opaque
        self.inner = [at + 1, at + 1]
        self.text_range = [piece, piece]

    def has_class(self, wanted: str) -> bool:
        names = self.attrs.get("class", "").split()
        return wanted in names or " ".join(names) == wanted


class Page(HTMLParser):
    """Elements of one page in document order.

    Unclosed elements last until an element around them closes; an end tag without a start
    is ignored.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self._pieces: list[tuple[str, str | None]] = []
        self._open: list[Element] = []
        self.feed(html)
        self.close()
        self._close_down_to(0)

    def handle_starttag(self, tag, attrs):
        around = self._open[-1].opaque if self._open else None
        element = Element(
            tag,
            {key: value or "" for key, value in attrs},
            tag if tag in OPAQUE else around,
            len(self.elements),
            len(self._pieces),
        )
        self.elements.append(element)
        if tag not in VOID:
            self._open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_down_to(len(self._open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth].name == tag:
                self._close_down_to(depth)
                return

    def handle_data(self, data):
        self._pieces.append((data, self._open[-1].opaque if self._open else None))

    def _close_down_to(self, depth: int):
        for element in self._open[depth:]:
            element.inner[1] = len(self.elements)
            element.text_range[1] = len(self._pieces)
        del self._open[depth:]

    def strings(self, element: Element) -> list[str]:
        """Text pieces of an element; script, style and template text only for those themselves."""
        wanted = element.name if element.name in OPAQUE else None
        first, last = element.text_range
        return [text for text, kind in self._pieces[first:last] if kind == wanted]

    def inside(self, element: Element) -> list[Element]:
        return self.elements[slice(*element.inner)]

    def find(self, name: str, accept) -> Element | None:
        return next((e for e in self.elements if e.name == name and accept(e)), None)


def _joined_stripped(page: Page, element: Element) -> str:
    return "".join(s.strip() for s in page.strings(element))


def metadata_text(page: Page) -> str | None:
    script = page.find(
        "script", lambda e: e.attrs.get("type") == METADATA_TYPE and e.has_class(METADATA_CLASS)
    )
    return None if script is None else "".join(page.strings(script))


def tag_names(page: Page) -> list[str]:
    """Comma-separated names, not trimmed one by one."""
    line = page.find("div", lambda e: e.has_class(TAGS_CLASS))
    return [] if line is None else _joined_stripped(page, line).split(",")


def body_elements(page: Page, body_class: str | None = BODY_CLASS) -> list[Element]:
    """Elements of the article body, or of the whole page when no class is given."""
    if body_class is None:
        return page.elements
    body = page.find("div", lambda e: e.has_class(body_class))
    return [] if body is None else page.inside(body)


def anchors(page: Page, elements: list[Element]) -> list[dict]:
    return [
        {"text": _joined_stripped(page, e), "link": e.attrs["href"]}
        for e in elements
        if e.name == "a" and "href" in e.attrs
    ]


def paragraphs(page: Page, elements: list[Element], leaf: bool = False) -> list[str]:
    """Stripped text of every element with text, so text of nested elements repeats.

    With ``leaf`` only elements that enclose no other element count.
    """
    found = []
    for e in elements:
        if leaf and e.inner[0] < e.inner[1]:
            continue
        text = "".join(page.strings(e)).strip()
        if text:
            found.append(text)
    return found


def table_cells(page: Page, table_id: str = SITEMAP_TABLE_ID) -> list[dict]:
    """Per row of the sitemap table: the hrefs of its cells and the texts of those without one."""
    table = page.find("table", lambda e: e.attrs.get("id") == table_id)
    rows = []
    for row in page.inside(table) if table is not None else []:
        if row.name != "tr":
            continue
        links, texts = [], []
        for cell in page.inside(row):
            if cell.name != "td":
                continue
            link = next((e for e in page.inside(cell) if e.name == "a"), None)
            if link is not None:
                links.append(link.attrs.get("href"))
            else:
                texts.append("".join(page.strings(cell)).strip())
        rows.append({"links": links, "texts": texts})
    return rows
