"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, text_of

#: Lines in a window.
WINDOW = 3
#: Characters in a window from which text surges.
SURGE = 80

#: Elements whose content is never text of the page.
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|select|canvas|audio|video"
#: Elements around a page's text: menus, headers, footers, sidebars, forms, dialogs.
ASIDE = set("nav header footer aside form menu dialog button label fieldset datalist".split())
#: Elements that begin and end a line.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end when another of their group begins in the same parent.
ENDS = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
        "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Words in a class or id that mark what is not the article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social comment comments respond reply replies disqus nav navbar navigation menu menus breadcrumb "
    "breadcrumbs pagination pager sidebar aside footer masthead related recommended recommendations widget widgets "
    "toolbar form search hidden copyright disclaimer".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
            "toolbar note".split())
#: Elements that hold a whole page or article and are not dropped for a mark.
WHOLE = {"html", "body", "main", "article"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
REST = re.compile(r"(?P<text>.+)(?P<raw>\b\B)?(?P<tag>\b\B)?", re.S)
ATTR = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
SPLIT_NAME = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


def beside(tag: str, attrs: str) -> bool:
    """Is this element no part of the article, by its tag, role, class or id?"""
    if tag in ASIDE:
        return True
    if not attrs.strip() or tag in WHOLE:
        return False
    a = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTR.findall(attrs)}
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if a.get("role", "").lower() in ROLES:
        return True
    names = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{a.get('class', '')} {a.get('id', '')}").lower()
    return not MARKS.isdisjoint(SPLIT_NAME.split(names))


def lines(page: str) -> Iterator[tuple[str, int, bool, bool]]:
    """(text, characters outside links, in an article element, in a heading) of each line.

    A line is the text between two block tags; a beside element yields one
    empty line, the gap that the distribution sees.
    """
    # tag, beside, link, article, heading - each with what is around it
    stack: list[tuple[str, bool, bool, bool, bool]] = []
    # where each tag and the blocks are in the stack: no end tag searches it
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    text: list[str] = []
    plain = 0
    state = (False, False, False, False)

    def flush():
        nonlocal text, plain
        t = " ".join(html.unescape("".join(text)).split())
        out = [(t, plain, state[2], state[3])] if t else []
        text, plain = [], 0
        return out

    def close(at: int):
        for tag, *_ in stack[at:]:
            if tag:
                places[tag].pop()
        del stack[at:]
        while blocks and blocks[-1] >= at:
            blocks.pop()

    def now():
        return stack[-1][1:] if stack else (False, False, False, False)

    # behind the last ">" there is no tag any more
    end = page.rfind(">") + 1
    for m in chain(TOKEN.finditer(page, 0, end), REST.finditer(page, end)):
        if m["text"] is not None:
            if not state[0]:
                text.append(m["text"])
                if not state[1]:
                    plain += len(m["text"].strip())
        elif m["raw"] is not None:
            if not state[0]:
                text.append(" ")
        elif m["tag"] is not None:
            tag = m["tag"].lower()
            if tag in BLOCK:
                yield from flush()
            elif tag == "br" and not state[0]:
                text.append(" ")
            if m["end"]:
                if places.get(tag):
                    at = places[tag][-1]
                    # an inline or misplaced end tag does not end the blocks around it
                    if tag in BLOCK or not blocks or blocks[-1] <= at:
                        close(at)
                    else:
                        places[tag].pop()
                        stack[at] = ("", *stack[at][1:])
            elif tag not in VOID and not m["attrs"].rstrip().endswith("/"):
                if tag in BLOCK:
                    # an inline element that was never closed ends with its paragraph
                    if blocks and tag in ENDS.get(stack[blocks[-1]][0], ()):
                        close(blocks[-1])
                up = now()
                out = up[0] or beside(tag, m["attrs"])
                if out and not up[0]:
                    yield from flush()
                    yield "", 0, False, False
                places.setdefault(tag, []).append(len(stack))
                if tag in BLOCK:
                    blocks.append(len(stack))
                stack.append((tag, out, up[1] or tag == "a", up[2] or tag in ("article", "main"),
                              up[3] or tag in HEADINGS))
            was, state = state, now()
            if was[0] and not state[0]:
                text = []
    yield from flush()


def main_blocks(page: str, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between the surge and dive points of a page, in page order.

    If the page has an article or main element, L is the text length of a line
    in it, links as well, and 0 for a line outside of it. Otherwise L is the
    text length outside links. A line beside the article has 0. S(i) sums L
    over ``window`` lines from i on. Text surges at the first line of a window
    with S of ``surge`` or more and dives at the first window with S = 0 after
    it; between the two every line with text is kept, one of links too. A
    heading that is a link belongs to the text that begins within a window of
    it. A stretch that never reaches ``surge`` is kept only if the page has no
    other (a short article), or lies in an article element.
    """
    rows = list(lines(page))
    marked = any(r[2] and r[0] for r in rows)
    size = [(len(t) if inside else 0) if marked else plain for t, plain, inside, _ in rows]
    n = len(rows)
    sums = [sum(size[i:i + window]) for i in range(n + 1)]
    runs: list[tuple[int, int, int]] = []
    i = 0
    while i < n:
        if not size[i]:
            i += 1
            continue
        end = i
        while end < n and sums[end]:
            end += 1
        after = runs[-1][1] if runs else 0
        begin = i if marked else next(
            (k for k in range(max(after, i - window + 1), i) if rows[k][3] and rows[k][0]), i)
        runs.append((begin, end, max(sums[i:end])))
        i = end
    if not runs:
        return []
    if not marked:
        high = [r for r in runs if r[2] >= surge]
        runs = high or [max(runs, key=lambda r: (sum(size[r[0]:r[1]]), -r[0]))]
    return [rows[k][0] for a, b, _ in runs for k in range(a, b)
            if rows[k][0] and (rows[k][2] or not marked)]


def extract(page: str | None) -> str:
    return "\n\n".join(main_blocks(page or ""))


def extract_text(df: DataFrame, html_col: str = "html", keep: list[str] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars (code points) of every whole page.

    Null or empty html, or a page without text: the empty text. Rows are
    handled one by one, so ties, repeated rows and further columns change
    nothing; an empty table gives no rows. One map-side pass, no shuffle.
    """
    keep = list(keep)

    def run(batches):
        for b in batches:
            text = pa.array([extract(x.as_py()) for x in b.column("_html")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [text], names=[*keep, "text"])

    src = ready(df).select(*[F.col(c) for c in keep], text_of(html_col).alias("_html"))
    out = ", ".join([*[f"`{c}` {t}" for c, t in src.dtypes if c != "_html"], "text string"])
    return src.mapInArrow(run, out).withColumn("n_chars", F.char_length("text").cast("bigint"))
