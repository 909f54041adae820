"""Main text of web pages by differencing each page with its nearest neighbour on the host."""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlens.llm.common import arrow_schema
from wardlens.operators.sequences import along
from wardlens.sources.staging import stage

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(script|style|iframe|textarea|title)(?![\w:-])"
    r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>(?:(?<=/>)|.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_CUT = re.compile(r"[^a-z]+")

#: Elements that hold others; only these are matched with their end tags.
CONTAINERS = frozenset(
    "html head body main article section div nav header footer aside form ul ol dl table figure "
    "blockquote details dialog menu fieldset".split()
)
#: Elements whose start or end ends a line of text.
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre hr address figcaption summary "
    "center legend option".split()
)
#: Elements that never hold the article.
ASIDE = frozenset("head nav footer aside form dialog menu".split())
#: Elements whose text is no part of the page's; one that is never closed ends at the next block.
HIDDEN = frozenset("noscript template svg object canvas select button".split())
#: Words of class, id and role that mark such elements.
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer contentinfo complementary "
    "cookie cookies consent gdpr notice notification alert popup modal newsletter subscribe ad ads advert "
    "advertisement adbox sponsor sponsored promo comment comments disqus share sharing social related "
    "recommended login signup search pagination pager toolbar".split()
)
#: These mark a page's head, but may also hold an article's title.
HEAD_WORDS = frozenset("header masthead banner topbar".split())
#: Words that say nothing beside one of those: ``comments-list`` is a comment part, ``ad-free`` no advert.
PLAIN_WORDS = frozenset(
    "site page main global primary secondary top bottom left right box bar block list item items section area "
    "container wrapper wrap inner outer content row col column slot unit link links button buttons form "
    "user users reader readers post posts message overlay text title small large".split()
)
#: A line inside articles recurs on a host if at least this many and half of its different pages have it.
RECURRING = 4


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if tag in ("article", "main", "body", "html") and "comment" not in attributes.lower():
        return False
    marks = ASIDE_WORDS if in_article else ASIDE_WORDS | HEAD_WORDS
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for label in value.strip("\"'").lower().split():
                words = {word for word in _CUT.split(label) if word}
                if words & marks and words <= marks | PLAIN_WORDS:
                    return True
        elif name.lower() == "aria-hidden" and "true" in value.lower():
            return True
    return False


def _after(places: list[int], i: int, end: int) -> int:
    """The first of the sorted places after ``i``, else ``end``."""
    at = bisect.bisect_right(places, i)
    return places[at] if at < len(places) else end


def page_lines(page: str) -> list[tuple[str, bool]]:
    """The page's lines of text outside asides, each with whether an article or main holds it.

    A line is the text between two block tags, references decoded and white space joined.  End
    tags close the nearest open container of their name and all inside it.  An aside that is
    never closed ends where an article or main starts.  ``<svg/>`` and the like hold nothing.
    """
    tokens = list(_TOKEN.finditer(page))
    stack: list[tuple[str, int]] = []
    depth: Counter[str] = Counter()
    end_of: dict[int, int] = {}
    blocks = [i for i, m in enumerate(tokens) if (m[3] or "").lower() in BLOCKS]
    mains = [i for i, m in enumerate(tokens) if m[3] and not m[2] and m[3].lower() in ("article", "main")]
    for i, m in enumerate(tokens):
        tag = (m[3] or "").lower()
        if tag not in CONTAINERS and tag not in HIDDEN:
            continue
        if tag in HIDDEN and m[4].endswith("/"):
            end_of[i] = i
        elif not m[2]:
            stack.append((tag, i))
            depth[tag] += 1
        elif depth[tag]:
            while True:
                name, at = stack.pop()
                depth[name] -= 1
                if name == tag or name not in HIDDEN:
                    end_of[at] = i
                if name == tag:
                    break
    lines: list[tuple[str, str]] = []
    words: list[str] = []
    skip_to, holds = -1, []

    def flush() -> None:
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            lines.append((text, holds[-1][0] if holds else ""))
        words.clear()

    for i, m in enumerate(tokens):
        while holds and holds[-1][1] <= i:
            flush()
            holds.pop()
        if i < skip_to:
            continue
        tag = (m[3] or "").lower()
        if tag in BLOCKS:
            flush()
            if tag in CONTAINERS and not m[2]:
                end = end_of.get(i)
                if _is_aside(tag, m[4] or "", bool(holds)):
                    skip_to = end if end is not None else _after(mains, i, len(tokens))
                elif tag in ("article", "main"):
                    holds.append((tag, len(tokens) if end is None else end))
        elif tag in HIDDEN and not m[2]:
            # Up to its end tag; one that is never closed hides what comes before the next block.
            end = end_of.get(i)
            skip_to = _after(blocks, i, len(tokens)) if end is None else end
        elif m[5]:
            words.append(m[5])
        elif tag == "br":
            words.append(" ")
    flush()
    # The articles are the content; else the main part; else whatever is left of the page.
    kinds = {kind for _, kind in lines}
    content = "article" if "article" in kinds else "main" if "main" in kinds else None
    return [(text, kind == content) for text, kind in lines]


def shared_lines(a: Sequence, b: Sequence) -> set[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    The table of lengths is kept as one bit per cell: bit j of a row is 0 where the length grows
    from j to j + 1 lines of ``b``.  So two pages of 10,000 lines in common take 12 MB.
    """
    theirs, mine = set(b), set(a)
    left = [i for i, x in enumerate(a) if x in theirs]
    right = [y for y in b if y in mine]
    places: dict[str, int] = {}
    for j, y in enumerate(right):
        places[y] = places.get(y, 0) | 1 << j
    full = state = (1 << len(right)) - 1
    rows = []
    for i in left:
        match = state & places[a[i]]
        state = ((state + match) | (state - match)) & full
        rows.append(state)
    found, row, column = set(), len(left), len(right)
    while row and column:
        if rows[row - 1] >> (column - 1) & 1:
            column -= 1
            continue
        row -= 1
        if not row or rows[row - 1] >> (column - 1) & 1:
            found.add(left[row])
            column -= 1
    return found


def content_lines(lines: list[tuple[str, bool]]) -> tuple[bool, list[str]]:
    """Whether the page has an article or main part, and the lines of it, else all lines."""
    content = any(held for _, held in lines)
    return content, [text for text, held in lines if held or not content]


def kept_lines(
    content: bool, mine: Sequence[int], neighbour: Sequence[int], recurring: Sequence[int]
) -> list[bool]:
    """Which lines stay, by line hashes: of those aligned with the neighbour all go on a page without an
    article or main part, and inside one those that recur on the host, so what two articles share stays."""
    shared, often = shared_lines(mine, neighbour), set(recurring)
    return [not (i in shared and (not content or line in often)) for i, line in enumerate(mine)]


def _common(a: Column, b: Column) -> Column:
    """Number of characters at the start that two texts have in common; NULL if the second is NULL."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(b.isNotNull(), F.when(first > 0, first - 1).otherwise(F.length(a)))


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """The id, the url, ``_host``, ``_path``, ``_content``, ``_lines`` and ``_digest`` (of the lines)."""
    url = F.coalesce(F.lower(F.col(url_col).cast("string")), F.lit(""))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    source = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    keyed = pages.select(
        F.col(id_col), F.col(url_col), host.alias("_host"), path.alias("_path"), source.alias("_html")
    )
    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]
    ddl = ", ".join(
        [*fields, "_host string, _path string, _content boolean, _lines array<string>, _digest binary"]
    )
    schema = arrow_schema(ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = []
                for row in batch.slice(start, 200).to_pylist():
                    content, lines = content_lines(page_lines(row.pop("_html")))
                    digest = hashlib.sha256("\n".join([str(content), *lines]).encode()).digest()[:16]
                    out.append({**row, "_content": content, "_lines": lines, "_digest": digest})
                yield pa.RecordBatch.from_pylist(out, schema)

    return keyed.mapInArrow(rows, ddl)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: the id, the url, ``text`` (main text, lines joined by newlines), ``n_chars``.

    Pages are parsed once and written as lines.  The different contents of a host stand in order of
    path, and each is compared with the one beside it whose path agrees longer: their lines, as
    64-bit hashes, are aligned by a longest common subsequence.  Without an article or main part all
    aligned lines go; inside one those that at least half of the host's contents have (four at
    least).  Pages of one host with equal lines have equal texts, and partitions play no part.  A
    host of any size is spread over tasks: the order is taken over digests by ``along``, line counts
    by host and line, and texts meet only the decisions on their own content.

    A NULL html is empty and gives an empty text; a NULL url stands before all hosts, and such
    pages are each other's neighbours.  Repeated rows are pages of their own, with one text.  A page
    alone on its host is extracted without a comparison.  Other columns are not read.  An empty
    table gives no rows.
    """
    parsed = stage(_parsed(pages, id_col, url_col, html_col), "pages")
    line_hashes = F.transform("_lines", lambda line: F.xxhash64(line))
    key = ["_host", "_digest"]
    contents = stage(
        parsed.filter(F.size("_lines") > 0).select(*key, "_path", "_content", line_hashes.alias("_hashes"))
        .groupBy(*key).agg(
            F.min("_path").alias("_path"), F.any_value("_content").alias("_content"),
            F.any_value("_hashes").alias("_hashes"),
        ),
        "contents",
    )
    lines = contents.select(*key, "_content", F.explode(F.array_distinct("_hashes")).alias("_line"))
    hosts = contents.groupBy("_host").agg(F.count("*").alias("_pages"))
    often = (
        lines.groupBy("_host", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= RECURRING)
        .join(hosts, "_host").filter(2 * F.col("_n") >= F.col("_pages")).select("_host", "_line")
    )
    recurring = (
        lines.filter("_content").join(often, ["_host", "_line"])
        .groupBy(*key).agg(F.collect_list("_line").alias("_recurring"))
    )
    beside = along(
        contents.select(*key, "_path"), ["_host"], ["_path", "_digest"],
        {
            "_path_before": ("_path", 1), "_before": ("_digest", 1),
            "_path_after": ("_path", -1), "_after": ("_digest", -1),
        },
    )
    longer = F.coalesce(_common(F.col("_path"), F.col("_path_after")), F.lit(-1)) > F.coalesce(
        _common(F.col("_path"), F.col("_path_before")), F.lit(-1)
    )
    nearest = beside.select(*key, F.when(longer, F.col("_after")).otherwise(F.col("_before")).alias("_near"))
    asked = (
        contents.join(recurring, key, "left").filter("NOT _content OR _recurring IS NOT NULL")
        .select(*key, "_content", "_hashes", "_recurring").join(nearest, key)
    )
    theirs = contents.select("_host", F.col("_digest").alias("_near"), F.col("_hashes").alias("_theirs"))
    compared = asked.join(theirs, ["_host", "_near"]).select(
        *key, "_content", "_hashes", "_theirs", F.coalesce("_recurring", F.array().cast("array<long>")).alias("_often")
    )
    ddl = "_host string, _digest binary, _keep array<boolean>"
    schema = arrow_schema(ddl)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, digest, *page in zip(*(c.to_pylist() for c in batch.columns)):
                keep = kept_lines(*page)
                if not all(keep):
                    out.append({"_host": host, "_digest": digest, "_keep": keep})
            yield pa.RecordBatch.from_pylist(out, schema)

    decided = stage(compared.mapInArrow(decide, ddl), "decided")
    kept = F.when(F.col("_keep").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda _, i: F.get("_keep", i))
    )
    texts = parsed.join(decided, key, "left").select(id_col, url_col, F.concat_ws("\n", kept).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
