"""Main text of HTML pages by two-pass rules over text blocks."""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, prepare

# fixed values: frequent function words of four languages
STOP_WORDS = frozenset("""
the of and a to in is that it was for on are as with be by at this from not have or an they which you we
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
le la les de des du un une et à en est que qui dans pour par sur pas plus au avec ce il sont ne se
el los las del y en un una que es por con no para al lo como más su se
""".split())
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
SILENT = frozenset("head script style noscript template iframe svg select textarea button title canvas audio video".split())
APART = frozenset("nav footer aside form menu dialog header".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
HINTS = frozenset("""ad ads advert advertisement sponsor sponsored promo promotion banner sidebar side nav navbar navigation menu breadcrumb breadcrumbs
header footer masthead comment comments respond reply replies disqus cookie cookies consent notice notices alert popup modal overlay newsletter subscribe
subscription signup login share sharing social related recommended widget toolbar copyright legal form search tags pagination pager""".split())

# hints that titles and subjects begin with as well: in ids, and inside an article, they count only as the whole name
SUBJECTS = frozenset("""side promotion banner navigation menu header comment comments respond reply replies consent notice notices alert subscription social
related legal form search tags copyright share sharing""".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
LEAD = re.compile(r"[a-z]+(?![a-z])")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass
class Block:
    """A run of text between block tags, with what the rules ask of it."""
    text: str
    linked: int
    apart: bool
    inside: bool
    heading: bool
    spare: bool = False
    label: str = ""


def _set_apart(tag: str, rest: str, inside: bool) -> str:
    """Whether an element holds something other than the article: "name" by its name or role, "hint" by class or id.

    A hint is a whole class name or id, or its leading part; headings have their
    ids from titles, and so have sections inside an article.
    """
    if tag in APART and not (inside and tag == "header"):
        return "name"
    found = ""
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and not ROLES.isdisjoint(value.split()):
            return "name"
        if name == "class" or name == "id" and tag not in HEADINGS and not (inside and tag == "section"):
            for whole in value.split():
                lead = LEAD.match(whole)
                if whole in HINTS or lead and lead.group() in HINTS and not ((inside or name == "id") and lead.group() in SUBJECTS):
                    found = "hint"
    return found


def _shown(text: str) -> str:
    """Text as a reader sees it: character references decoded, white space folded."""
    return " ".join(html.unescape(text).split())


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order; scripts, styles and other unseen text are left out."""
    out: list[Block] = []
    open_tags: list[tuple[str, str, bool, bool]] = []  # name, set apart, in the article, spare
    texts: list[str] = []
    linked: list[str] = []  # the text of each link in the block
    links = 0
    heading = False
    at, end = 0, len(page)

    def close() -> None:
        nonlocal heading
        text = _shown("".join(texts))
        if text:
            apart, inside, spare = open_tags[-1][1:] if open_tags else ("", False, False)
            out.append(Block(text, min(sum(len(_shown(x)) for x in linked), len(text)), bool(apart), inside, heading, spare))
        texts.clear()
        linked.clear()
        heading = False

    def say(text: str) -> None:
        texts.append(text)
        if links:
            linked[-1:] = [linked[-1] + text if linked else text]

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at: m.start()])
        at = m.end()
        if not m.group(2):
            continue
        closing, tag = bool(m.group(1)), m.group(2).lower()
        if tag in SILENT:
            if not closing and not m.group(3).rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>" + (r"|<body\b" if tag == "head" else ""), re.I).search(page, at)
                at = end if stop is None else stop.start() if stop.group().lower().startswith("<body") else stop.end()
            if tag in BLOCKS:
                close()
            else:
                texts.append(" ")
        elif tag == "a":
            links = max(0, links + (-1 if closing else 1))
            if not closing:
                linked.append("")
        elif tag == "br":
            texts.append(" ")
        elif tag in BLOCKS:
            close()
            links = 0
            if closing:
                depth = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == tag), None)
                if depth is not None:
                    del open_tags[depth:]
            elif tag not in VOID:
                if tag == "p" and open_tags and open_tags[-1][0] == "p":
                    open_tags.pop()  # a paragraph ends where the next one begins
                above, inside, spare = open_tags[-1][1:] if open_tags else ("", False, False)
                mark = "" if tag in ("html", "body") else _set_apart(tag, m.group(3), inside or tag in ("article", "main"))
                own = tag in ("article", "main") and not mark
                mark = "" if tag in ("article", "main") else mark
                # an article ends the hint of a wrapper around it; what is set apart inside stays so
                spare = (spare or own and above == "hint" and not inside) and not mark
                apart = "name" if "name" in (above, mark) else above or mark
                open_tags.append((tag, apart, inside or own, spare))
                heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
    close()
    return out


def main_text(page: str | None, short: int = 10, dense: float = 0.3, linked: float = 0.33) -> str:
    """The article's blocks, joined by line feeds.

    First pass. A block is bad if it stands in an element that is set apart, if
    over ``linked`` of its characters, as a reader sees them, are in links, or if it has a copyright sign
    outside the article. A block of at least ``short`` words is good if it stands
    in an article or main element, or if ``dense`` of its words are function
    words; if fewer than a third of that are, it is bad. The others are
    undecided: short ones, headings, and those in between.

    Second pass. An undecided block takes the label of the nearest decided block,
    good if two are equally near; without any, it is good in an article and bad
    elsewhere. Blocks set apart decide nothing about others. If the page marks
    an article, only its blocks decide and are kept.

    An article that only a class or id of a wrapper sets apart is read too, if no
    other is marked; it is taken if it has more text than the rules find without it.
    """
    blocks = blocks_of(page or "")
    kept = _kept(blocks, short, dense, linked)
    if any(b.spare for b in blocks) and not any(b.inside and not b.apart for b in blocks):
        freed = _kept([replace(b, apart=b.apart and not b.spare, label="") for b in blocks], short, dense, linked)
        kept = max(kept, freed, key=lambda texts: sum(map(len, texts)))
    return "\n".join(kept)


def _kept(blocks: list[Block], short: int, dense: float, linked: float) -> list[str]:
    """Texts of the good blocks."""
    marked = any(b.inside and not b.apart for b in blocks)
    for b in blocks:
        words = b.text.split()
        stops = sum(w.strip(".,;:!?\"'()«»#$%&*").lower() in STOP_WORDS for w in words) / len(words)
        if b.apart or b.linked > linked * len(b.text) or (marked and not b.inside) or ("©" in b.text and not b.inside):
            b.label = "bad"
        elif len(words) >= short and not b.heading and (b.inside or stops >= dense):
            b.label = "good"
        elif len(words) >= short and not b.heading and stops < dense / 3:
            b.label = "bad"
    decided = [k for k, b in enumerate(blocks) if b.label and not b.apart and (not marked or b.inside)]
    kept = []
    for k, b in enumerate(blocks):
        label = b.label
        if not label:
            at = bisect(decided, k)
            around = [(abs(j - k), blocks[j].label != "good") for j in decided[max(0, at - 1): at + 1]]
            label = "bad" if (min(around)[1] if around else not b.inside) else "good"
        if label == "good":
            kept.append(b.text)
    return kept


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the kept columns, text and n_chars (code points).

    A null or empty page, or one without an article, has the empty text. Pages are
    read whole and one by one, without a shuffle, so equal pages and a host with
    most of them make no difference. Other columns, whatever their names, are
    ignored; an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = pa.schema([b.schema.field(k) for k in keep] + [("text", pa.string()), ("n_chars", pa.int64())])
            rest = [b.column(k).to_pylist() for k in keep]
            texts = (main_text(p) for p in b.column("_html").to_pylist())
            yield from batches_of(((*r, t, len(t)) for *r, t in zip(*rest, texts)), out)

    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
