"""Main text of web pages: text-to-tag ratios over the lines of a streaming parser, smoothed and clustered."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SIGMA = 2.0
# Elements by their part in a page.
DROPPED = frozenset("script style noscript template svg math canvas iframe object audio video select button textarea nav header footer aside dialog menu head title".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
BORDERS = BLOCKS | DROPPED | {"form"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
MARKED = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices popup modal newsletter subscribe share "
    "social related recommended sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies "
    "respond form login".split()
)
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "form", "alert", "dialog"))


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the element is not shown."""
    return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)


def marked(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether class, id or role name a part that is not the article."""
    for name, value in attrs:
        if name in ("class", "id"):
            words = (value or "").lower().replace("-", " ").replace("_", " ").split()
            if not MARKED.isdisjoint(words):
                return True
        elif name == "role" and (value or "").lower() in ROLES:
            return True
    return False


class Lines(HTMLParser):
    """Collects a page's lines: (text, tags met in it, whether it lies in an article, whether in a dropped part).

    Forms and elements with a marking class, id or role are not dropped at once, as a whole page or its article may lie in
    one: `marks` holds (name, names of article or main in it) of each, `within` the marks around each line. A line is the text between two block borders. Elements left open are closed by the end of what holds them, and a new
    block closes an open paragraph.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, bool]] = []
        self.within: list[tuple[int, ...]] = []
        self.marks: list[tuple[str, set[str]]] = []
        self.open: list[tuple[str, bool, bool, tuple[int, ...]]] = []  # name, dropped, in an article, marks around
        self.text: list[str] = []
        self.tags = 0

    @property
    def dropped(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def main(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    @property
    def around(self) -> tuple[int, ...]:
        return self.open[-1][3] if self.open else ()

    def border(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.main, self.dropped))
            self.within.append(self.around)
            self.tags = 0
        self.text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BORDERS:
            self.border()
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS:
            self._close("p", ("div", "article", "section", "main", "body", "td", "li", "blockquote"))
        if tag in VOID:
            return
        # A header within an article holds its title; a page's own header does not.
        drop = self.dropped or tag in DROPPED and not (tag == "header" and self.main) or hidden(attrs) and tag not in ("html", "body")
        around = self.around
        if tag == "form" or marked(attrs) and tag not in ("html", "body"):
            around = (*around, len(self.marks))
            self.marks.append((tag, set()))
        if tag in MAIN and not drop:
            for k in around:
                self.marks[k][1].add(tag)
        self.open.append((tag, drop, self.main or tag in MAIN, around))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BORDERS:
            self.border()
        self.tags += 1
        if tag in BORDERS:
            self._close(tag, ())
        else:  # an inline element ends within its block
            self._close(tag, BORDERS)

    def _close(self, tag: str, within) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in within:
                return

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def close(self) -> None:
        super().close()
        self.border()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian mean over neighbours within three sigma, weights adding up to one at the borders too."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    middle = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def is_content(lines: list[tuple[str, int, bool, bool]]) -> np.ndarray:
    """Whether each line's smoothed ratio of code points to tags is over the ratios' standard deviation."""
    ratios = smoothed(np.array([len(t) / max(1, tags) for t, tags, _, _ in lines], dtype=np.float64))
    return ratios >= ratios.std()


def judged(parser: Lines) -> list[tuple[str, int, bool, bool]]:
    """The page's lines, those in marked elements dropped unless the element is spared.

    Spared is what holds main, and a marked article with content. Where no line of an article or main lies outside marked
    elements, what holds an article or most of the content is spared too. Elements within a spared one are judged by themselves. If nothing is left and one holds an
    article, no mark counts.
    """
    lines, within = parser.lines, parser.within
    if not any(within):
        return lines
    size = np.array([len(x[0]) for x in lines]) * is_content(lines) * np.array([not x[3] for x in lines])
    held = [0] * len(parser.marks)
    for n, around in zip(size.tolist(), within, strict=True):
        for k in around:
            held[k] += n
    own = any(x[2] and not x[3] and not around for x, around in zip(lines, within, strict=True))
    own = own or any(n and x[2] and all(parser.marks[k][0] in MAIN for k in around) for n, x, around in zip(size.tolist(), lines, within, strict=True))
    spared = [
        "main" in holds or tag == "article" and n > 0 or not own and (bool(holds) or 2 * n > size.sum())
        for (tag, holds), n in zip(parser.marks, held, strict=True)
    ]
    out = [(*x[:3], x[3] or not all(spared[k] for k in around)) for x, around in zip(lines, within, strict=True)]
    articles = any(holds for _, holds in parser.marks)
    return lines if articles and all(x[3] for x in out) else out


def content_lines(lines: list[tuple[str, int, bool, bool]]) -> list[str]:
    """The texts of the content region, in page order.

    Lines in menus, adverts and the like are out by their element. Of the rest each has a ratio: its code points to
    the tags met since the last line. Smoothed ratios over their standard deviation are content. If most of
    that lies in an article, the region is all of the article's lines, so that its short ones stay; else it is the lines
    from the first to the last run of content.
    """
    kept = [x for x in lines if not x[3]]
    if not kept:
        return []
    content = is_content(lines)[[i for i, x in enumerate(lines) if not x[3]]]
    size = np.array([len(x[0]) for x in kept]) * content
    main = np.array([x[2] for x in kept])
    if main.any() and 2 * size[main].sum() >= size.sum():
        return [x[0] for x, inside in zip(kept, main, strict=True) if inside]
    chosen = np.flatnonzero(content)
    if not len(chosen):
        return [x[0] for x in kept]
    return [x[0] for x in kept[chosen[0] : chosen[-1] + 1]]


def main_text(html: str | None) -> str:
    """Blocks of the main text joined by an empty line; empty for a null or empty page, or one without content."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    return "\n\n".join(content_lines(judged(parser)))


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages`, from the whole `html`.

    A null html gives an empty text; null ids and urls stay; repeated rows are read each; further columns are left out.
    """
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(read, schema)
