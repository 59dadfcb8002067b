"""Main text of web pages by differencing against the nearest page of the same host.

Pages are read as lines, one for each block. Within a host each page is paired with the page whose URL path is nearest in sorted
order; their lines are aligned by a longest common subsequence, and the lines that both have are template and are deleted.

What a page declares itself is used as well: lines of menus, headers, footers, sidebars, notices, adverts, forms and comments go
whether shared or not, and a line inside a declared article that is none of these stays even if the neighbour has it too (two
articles may hold the same sentence). So the alignment decides about all lines of undeclared regions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import narrow
from tagmill.session import cut

# A tag, or a stretch that is no text: comments, declarations, and elements whose content is not markup.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|svg|iframe|object|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
_BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = set("nav header footer aside form button dialog menu head fieldset".split())
_BODY = {"article", "main"}
#: Whole tokens of class and id. Parts of hyphenated names say little: 'has-sidebar' and 'entry-header' name wrappers and titles.
_DROPPED_NAMES = re.compile(
    r"(?:^|\s)(?:(?:ads?|advert\w*|sponsor(?:s|ed)?|promo(?:s|tions?)?|banner|nav|navbar|navigation|menu|breadcrumbs?|masthead|side-?bar|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|sharing|social|related|comments?|replies|respond|disqus|search|login|signup|pagination|skip)"
    r"|(?:site|page|main|top|primary|secondary|global)-(?:header|footer|nav|navigation|menu|sidebar|banner)|header|footer|ad-(?:banner|box|slot|unit|container)|nav-?(?:menu|links?|list)|(?:cookie|consent)-(?:banner|bar|notice|popup)|(?:share|social)-(?:bar|buttons?|links?)|related-(?:posts|articles|links)|comments?-(?:list|area|section|form)|skip-link)(?=$|\s)",
    re.I,
)
_DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "alertdialog"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
DROP, FREE, KEEP = -1, 0, 1


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """The page's lines with what it declares of them: DROP, KEEP (inside an article), or FREE."""
    page = page or ""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int, int]] = []
    # Elements dropped by class or id outside articles: the one around each, and whether an article lies inside, which clears it.
    named_in: list[int] = []
    cleared: list[bool] = []
    inside: list[tuple[int, int]] = []  # (line, innermost such element)
    state, last, soft = FREE, 0, -1

    def flush() -> None:
        if held:
            line = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if line:
                if soft >= 0 and state == DROP:
                    inside.append((len(out), soft))
                out.append((line, state))
            held.clear()

    for m in _MARKUP.finditer(page):
        if m.start() > last:
            held.append(page[last : m.start()])
        last = m.end()
        name = (m.group(3) or "").lower()
        if not name:
            continue
        if name in _BLOCKS:
            flush()
        if m.group(2):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if any(n in _BLOCKS for n, _, _ in stack[i:]) and name not in _BLOCKS:
                        break  # an inline end tag does not close a block
                    state, soft = stack[i][1:]
                    del stack[i:]
                    break
        elif name not in _VOID and not m.group(4).endswith("/"):
            if name in _BLOCKS:  # a block ends inline elements and blocks that it cannot lie in, up to the next container
                shut = _CLOSES.get(name, {"p"})
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in shut:
                        state, soft = stack[i][1:]
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCKS:
                        break
            in_article = any(n == "article" for n, _, _ in stack)
            stack.append((name, state, soft))
            if state != DROP or soft >= 0:
                marks = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(m.group(4))} if "=" in m.group(4) else {}
                role = marks.get("role", "").lower()
                named = name not in ("html", "body") and any(_DROPPED_NAMES.search(marks.get(k, "")) for k in ("class", "id"))
                body = name in _BODY or role in _BODY
                if role in _DROPPED_ROLES or (name in _DROPPED and not (name == "header" and state == KEEP)) or (named and (in_article or body)):
                    state, soft = DROP, -1  # comments are articles in an article
                elif named:
                    named_in.append(soft)
                    cleared.append(False)
                    state, soft = DROP, len(named_in) - 1
                elif body:
                    while soft >= 0:
                        cleared[soft] = True
                        soft = named_in[soft]
                    state = KEEP
    if last < len(page):
        held.append(page[last:])
    flush()
    for at, k in inside:
        while k >= 0 and cleared[k]:
            k = named_in[k]
        if k < 0:
            out[at] = (out[at][0], FREE)
    return out


def shared_lines(ours: list[int], theirs: list[int]) -> set[int]:
    """Places of ``ours`` in a longest common subsequence with ``theirs``.

    Equal ends are taken off first; the rest is a bit-parallel table of one number a line. Every 256th is kept and the others are
    made again on the way back, which bounds memory for very long pages.
    """
    head = 0
    while head < min(len(ours), len(theirs)) and ours[head] == theirs[head]:
        head += 1
    tail = 0
    while tail < min(len(ours), len(theirs)) - head and ours[-1 - tail] == theirs[-1 - tail]:
        tail += 1
    found = set(range(head)) | set(range(len(ours) - tail, len(ours)))
    a, b = ours[head : len(ours) - tail], theirs[head : len(theirs) - tail]
    if not a or not b or not set(a) & set(b):
        return found
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1

    def step(row: int, x: int) -> int:
        hit = row & where.get(x, 0)
        return ((row + hit) | (row - hit)) & full

    saved, row, stride = [full], full, 256
    for i, x in enumerate(a):
        row = step(row, x)
        if (i + 1) % stride == 0:
            saved.append(row)
    i, j = len(a), len(b)
    while i > 0 and j > 0:
        base = (i - 1) // stride
        rows = [saved[base]]
        for x in a[base * stride : i]:
            rows.append(step(rows[-1], x))
        while i > base * stride and j > 0:
            above = rows[i - 1 - base * stride] & ((1 << j) - 1)
            here = rows[i - base * stride] & ((1 << j) - 1)
            if above.bit_count() == here.bit_count():  # as long without our line
                i -= 1
                continue
            low = (1 << (j - 1)) - 1
            if (here >> (j - 1)) & 1:  # as long without their line
                j -= 1
                continue
            if a[i - 1] == b[j - 1]:
                found.add(head + i - 1)
                i, j = i - 1, j - 1
            elif (here & low).bit_count() == here.bit_count():
                j -= 1
            else:
                i -= 1
    return found


def host_and_path(url):
    """Columns host (lower case) and path (without query and fragment) of a URL column."""
    text = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(text, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(text, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    return host, path


def _partners(keys: DataFrame) -> DataFrame:
    """(row, other): each row's nearest by path of its host, rows being (host, path, row) in sorted order.

    Range partitions keep a hot host spread over tasks. Neighbours inside a partition come from a window over the partition;
    across boundaries from the partitions' first and last rows. The nearer of both has the longer common start of its path; ties go
    to the one before.
    """
    tagged = cut(keys.repartitionByRange("host", "path", "row").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy("host", "path", "row")
    here = F.struct("host", "path", "row")
    local = tagged.select("*", F.lag(here).over(inside).alias("before"), F.lead(here).over(inside).alias("after"))
    ends = tagged.groupBy("part").agg(F.min(here).alias("lo"), F.max(here).alias("hi"))
    across = Window.partitionBy(F.lit(1)).orderBy("part")  # one row a partition
    ends = ends.select(F.col("part").alias("_part"), F.lag("hi").over(across).alias("prior"), F.lead("lo").over(across).alias("next"))
    joined = local.join(F.broadcast(ends), F.col("part") == F.col("_part"))
    joined = joined.select("host", "path", "row", F.coalesce("before", "prior").alias("before"), F.coalesce("after", "next").alias("after"))

    def common(other: str):
        n = F.least(F.length("path"), F.length(f"{other}.path"))
        equal = F.expr(f"coalesce(array_position(transform(sequence(1, greatest(1, least(length(path), length({other}.path)))), i -> substr(path, i, 1) <> substr({other}.path, i, 1)), true), 0)")
        return F.when(F.col(f"{other}.host") == F.col("host"), F.when(equal > 0, equal - 1).otherwise(n)).otherwise(F.lit(-1))

    near = joined.select("row", F.col("before.row").alias("b"), F.col("after.row").alias("a"), F.coalesce(common("before"), F.lit(-1)).alias("cb"), F.coalesce(common("after"), F.lit(-1)).alias("ca"))
    other = F.when((F.col("cb") < 0) & (F.col("ca") < 0), None).when(F.col("cb") >= F.col("ca"), F.col("b")).otherwise(F.col("a"))
    return near.select("row", other.alias("other")).where("other is not null")


def _hashes(lines: list[tuple[str, int]]) -> list[int]:
    return [xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in lines]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars, and the numbers of lines shared with the neighbour and kept.

    Null html is empty; a page without a host or alone on it has no neighbour and keeps all undeclared lines; rows that repeat
    id, url and html are one page to its neighbours, and each gets the result; null ids are pages like any other. A page of which
    the neighbour has nearly all undeclared lines (more than 9 in 10) is its copy, which tells nothing about templates, so no line
    is deleted for it. Whole pages are read. Extra columns are ignored; an empty table gives an empty result.
    """
    base = narrow(pages, id_col, url_col, html_col).select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    base = base.withColumn("row", F.xxhash64("id", "url", "html"))
    host, path = host_and_path(F.col("url"))
    keys = base.select(host.alias("host"), path.alias("path"), "row").where("host <> ''").distinct()

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"other": batch["row"], "theirs": [_hashes(lines_of(p)) for p in batch["html"]]})

    partners = _partners(keys)
    lines = base.select("row", "html").mapInPandas(hashes, "other long, theirs array<long>")
    known = partners.join(lines, "other").dropDuplicates(["row"]).select(F.col("row").alias("_row"), "theirs")

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            split = [lines_of(p) for p in batch["html"]]
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "row": batch["row"], "ours": [_hashes(x) for x in split], "lines": [[t if s != DROP else "" for t, s in x] for x in split], "states": [[s for _, s in x] for x in split]})

    def decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"id": batch["id"], "url": batch["url"], "text": [], "n_shared": [], "n_lines": []}
            for ours, texts, states, theirs in batch[["ours", "lines", "states", "theirs"]].itertuples(index=False):
                shared = shared_lines(list(ours), list(theirs)) if theirs is not None else set()
                free = [i for i, s in enumerate(states) if s != DROP]
                if sum(i in shared for i in free) > 0.9 * len(free):
                    shared = set()
                kept = [texts[i] for i in free if states[i] == KEEP or i not in shared]
                out["text"].append("\n".join(kept))
                out["n_shared"].append(len(shared))
                out["n_lines"].append(len(kept))
            yield pd.DataFrame(out)

    kind = dict(base.dtypes)["id"]
    carried = base.withColumn("id", F.col("id").cast("string"))  # pandas would round long ids beside a null
    own = carried.mapInPandas(parsed, "id string, url string, row long, ours array<long>, lines array<string>, states array<int>")
    joined = own.join(known, F.col("row") == F.col("_row"), "left").select("id", "url", "ours", "lines", "states", "theirs")
    found = joined.mapInPandas(decided, "id string, url string, text string, n_shared long, n_lines long")
    return found.select(F.col("id").cast(kind).alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "n_shared", "n_lines")
