"""Main text of web pages: markup rules and differencing against the nearest pages of the host.

A page is read as lines, one per block element. Pages are paired within a host with the pages
whose URL paths stand next to theirs in order, those that share the longer beginning first. The
lines outside of article elements are aligned with theirs by a longest common subsequence, and
shared ones are deleted: a line is its text, or in a menu, footer, advert or the like its place in
the markup, whose text may change from page to page. Such a place needs one page that shares it; a
line of text needs two that differ, of which neither is nearly a copy of the page, so that copies
and quotations lose nothing. A line of a main element may go, too, if two pages share it. A check
follows, since a host may have few pages: lines in boilerplate elements go in any case, and so do
lines outside the article or main element where there is one. Lines of an article element stay.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from barlake.llm.common import cut

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Elements and the words of class, id and role attributes that mark boilerplate.
RAW = frozenset("script style title textarea noscript template iframe svg math".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup td th time tt u var wbr".split())
BOILERPLATE = frozenset("nav footer aside form button select dialog menu header head".split())
ARTICLE = frozenset("article main".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
    "login sidebar menu nav navbar navigation breadcrumb breadcrumbs toc footer header masthead "
    "comment comments respond replies disqus share sharing social related recommended widget "
    "search pagination pager copyright contentinfo complementary dialog hidden".split())
# Beside them a compound name may have these parts, and numbers: ``site-footer``, ``ad-box-2``. Any
# other part says something else: ``has-sidebar``, ``comments-open``, ``tag-search``, ``entry-header``.
WITH_MARKS = frozenset(
    "site page main global top bottom left right primary secondary mobile sticky fixed bar box "
    "block area wrap wrapper container inner outer content body section panel unit slot zone row "
    "list item items link links button buttons icon icons group form field fields text title "
    "heading label message policy media network networks inline post posts article articles "
    "story stories entry entries reply thread author meta".split())
# The title of an article, not of the site.
TITLES = frozenset("post posts article articles story stories entry entries content main".split())
# What these elements are called never makes the main text boilerplate.
MAIN = frozenset("html body main article".split())
# An article inside one of these is no main text: teasers and reader comments.
CLOSED_TO_ARTICLES = frozenset(
    "aside comment comments respond replies disqus related recommended widget".split())

# Pages with so large a part of their lines in common are near copies.
NEAR_COPY = 0.9
# Pages looked at on either side, and bits of the table that aligns two pages.
AROUND, MOST_BITS = 2, 1 << 28


def _named(own: str) -> set[str]:
    """The marks in a class name, if it has no part that says something else."""
    parts = {p for p in re.split(r"[-_]+", own) if p and not p.isdigit()}
    marks = parts & MARKS
    if not parts <= MARKS | WITH_MARKS or marks == {"header"} and parts & TITLES:
        return set()
    return marks


def _marks(name: str, attributes: str) -> set[str]:
    """Why an element is boilerplate; empty if it is not."""
    found = {name} if name in BOILERPLATE else set()
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        words = re.findall(r"[a-z0-9]+", value.lower())
        if key in ("class", "id", "role"):
            if name not in MAIN:
                for own in value.strip("\"'").lower().split():
                    found |= _named(own)
        elif name in ("html", "body"):
            # Often hidden only until the page has loaded.
            continue
        elif key == "hidden" or key == "aria-hidden" and "true" in words:
            found.add("hidden")
        elif key == "style" and "none" in words and "display" in words:
            found.add("hidden")
    return found


def page_lines(page: str) -> list[tuple[str, str, int]]:
    """(text, place, inside) per line; the place is empty outside of boilerplate, ``inside`` is
    2 in an article element, 1 in a main element only, else 0."""
    lines: list[tuple[str, str, int]] = []
    # Open elements: name, reasons to be boilerplate, whether it is an article.
    stack: list[tuple[str, set[str], bool]] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            marked = [n for n, why, _ in stack if why]
            place = "/".join(n for n, _, _ in stack) if marked else ""
            within = {n for n, _, article in stack if article and not marked}
            lines.append((text, place, 2 if "article" in within else int(bool(within))))

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        parts.append(html.unescape(page[at:token.start() if token else end]))
        if not token:
            break
        at = token.end()
        closing = token[1] if token[2] else token[4]
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        elif name in ("td", "th"):
            parts.append(" ")
        if closing:
            if any(n == name for n, _, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
            found = close.search(page, at)
            at = found.end() if found else end
        elif name not in VOID and not (token[3] or token[6] or "").endswith("/"):
            why = _marks(name, token[3] or token[6] or "")
            article = name in ARTICLE
            if article and not why:
                # Boilerplate left open before the article ends here.
                closed = any(w & CLOSED_TO_ARTICLES for _, w, _ in stack)
                if not closed:
                    stack[:] = [(n, set(), a) for n, _, a in stack]
            if name == "header" and any(a for _, _, a in stack):
                why.discard("header")
            if name == "p":
                # A paragraph ends the one before it.
                while stack and stack[-1][0] in INLINE:
                    stack.pop()
                if stack and stack[-1][0] == "p":
                    stack.pop()
            stack.append((name, why, article and not why))
    flush()
    return lines


def _last_row(a: list[int], b: list[int], rows: list[int] | None = None) -> int:
    """The last row of the table of longest common subsequences: bit i is 0 where a[:i + 1] has
    one more in common with b than a[:i]. ``rows`` gets all rows."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for y in b:
        hit = row & masks.get(y, 0)
        row = ((row + hit) | (row - hit)) & every
        if rows is not None:
            rows.append(row)
    return row


def _lengths(row: int, n: int) -> np.ndarray:
    """Lengths of the common subsequences of b with a[:0], a[:1], ..., a[:n]."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8),
                         bitorder="little")[:n]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def common(a: list[int], b: list[int], most_bits: int = MOST_BITS) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits. Where these
    would take more than ``most_bits``, ``b`` is halved, and ``a`` where both halves have most in
    common with theirs."""
    if len(a) * len(b) > most_bits and len(b) > 1:
        half = len(b) // 2
        ahead = _lengths(_last_row(a, b[:half]), len(a))
        back = _lengths(_last_row(a[::-1], b[half:][::-1]), len(a))[::-1]
        cut_at = int((ahead + back).argmax())
        return common(a[:cut_at], b[:half], most_bits) | {
            cut_at + i for i in common(a[cut_at:], b[half:], most_bits)}
    rows = [(1 << len(a)) - 1]
    _last_row(a, b, rows)
    i, j, out = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return out


def deleted(
    units: list[int], prose: list[bool], others: list[list[int]], copied: bool
) -> list[bool]:
    """Whether each unit is deleted. ``others`` are those of the nearest pages, nearest first; a
    place in the markup goes if the first shares it, or another page is a copy (``copied``). Prose
    goes if two pages share it that are no near copies, and not if no prose would be left."""
    gone = {i for i, text in enumerate(prose) if not text} if copied else set()
    votes, witnesses = [0] * len(units), 0
    for k, other in enumerate(others):
        found = common(units, other)
        if k == 0:
            gone |= {i for i in found if not prose[i]}
        if len(found) < NEAR_COPY * max(len(units), len(other)):
            witnesses += 1
            for i in found:
                votes[i] += 1
        if witnesses == 2:
            break
    text = {i for i, n in enumerate(votes) if n == 2 and prose[i]}
    gone |= text if len(text) < sum(prose) else set()
    return [i in gone for i in range(len(units))]


def _host(url: str) -> str:
    return (re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("/")[0]
            .split("?")[0].split("#")[0].lower())


def _path(url: str) -> str:
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url)
    return re.split(r"[?#]", rest[len(rest.split("/")[0]):])[0].rstrip("/")


_LINES = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("lines", T.ArrayType(T.StringType())),
    T.StructField("places", T.ArrayType(T.StringType())),
    T.StructField("inside", T.ArrayType(T.IntegerType())),
    T.StructField("number", T.ArrayType(T.IntegerType())),
])


def _candidate_numbers(lines: list[tuple[str, str, int]]) -> list[int]:
    """The number of each line among those outside of article elements; -1 for the others."""
    numbers, n = [], 0
    for _, _, inside in lines:
        numbers.append(n if inside < 2 else -1)
        n += inside < 2
    return numbers


def _read(pages: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [page_lines(h or "") for h in batch.column("html").to_pylist()]
            urls = [u or "" for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in kept),
                pa.array([_host(u) for u in urls], pa.string()),
                pa.array([_path(u) for u in urls], pa.string()),
                pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string())),
                pa.array([[x[1] for x in f] for f in found], pa.list_(pa.string())),
                pa.array([[x[2] for x in f] for f in found], pa.list_(pa.int32())),
                pa.array([_candidate_numbers(f) for f in found], pa.list_(pa.int32())),
            ], [*kept, *_LINES.names])

    kept = [c for c in pages.columns if c != "html"]
    schema = T.StructType([*(pages.schema[c] for c in kept), *_LINES.fields])
    return pages.mapInArrow(run, schema)


def _shared(rows: DataFrame) -> DataFrame:
    """(host, units_hash, gone): whether each candidate line is deleted."""
    def run(batches):
        for batch in batches:
            found = [deleted(*own) for own in zip(*(
                batch.column(c).to_pylist() for c in ("units", "prose", "others", "copied")),
                strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("units_hash"),
                 pa.array(found, pa.list_(pa.bool_()))], ["host", "units_hash", "gone"])

    return rows.select("host", "units_hash", "units", "prose", "others", "copied").mapInArrow(
        run, "host string, units_hash long, gone array<boolean>")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_shared) of each row of ``pages`` (page_id, url, html).

    The lines of the article or main element joined by one line feed; where a page has none, all
    lines outside of boilerplate elements; in both cases without the lines of text, outside of
    article elements, that two other pages share. n_shared is the number of lines deleted by
    differencing, those in boilerplate elements included. A null or empty page has the empty text.
    Rows equal in url and html share their pairing; a null url is a host of its own. A page that
    is cut off ends there.
    """
    pages = pages.select("page_id", "url", "html")
    zipped = F.arrays_zip("lines", "places", "inside")
    candidates = F.filter(zipped, lambda x: x["inside"] < 2)
    units = F.transform(candidates, lambda x: F.xxhash64(
        F.when(x["places"] != "", x["places"]).otherwise(x["lines"]), x["places"] != ""))
    lines = _read(pages).withColumn("units", units).withColumn(
        "units_hash", F.xxhash64("units", F.transform(candidates, lambda x: x["places"] != "")))
    slim = lines.select("host", "path", "units", "units_hash", F.xxhash64("url").alias("from"),
                        F.transform(candidates, lambda x: x["places"] == "").alias("prose"))
    # Pages with the same lines are one page, by its first path.
    slim = slim.groupBy("host", "units_hash").agg(
        F.min("path").alias("path"), F.first("units").alias("units"),
        F.first("prose").alias("prose"), (F.min("from") != F.max("from")).alias("copied"))
    rows = lines.drop("units").join(_shared(_neighbours(slim)), ["host", "units_hash"], "left")
    # Lines of boilerplate elements go in any case, and the others if their candidate is gone.
    def stays(x):
        return (x["places"] == "") & ~F.coalesce(F.get("gone", x["number"]), F.lit(False))

    each = F.arrays_zip("lines", "places", "inside", "number")
    inside = F.exists("inside", lambda n: n > 0)
    chosen = F.filter(each, lambda x: stays(x) & (~inside | (x["inside"] > 0)))
    text = F.array_join(F.transform(chosen, lambda x: x["lines"]), "\n")
    n_gone = F.size(F.filter(F.coalesce("gone", F.array().cast("array<boolean>")), lambda x: x))
    return rows.select("page_id", "url", text.alias("text"), n_gone.cast("long").alias("n_shared"))


def _neighbours(slim: DataFrame) -> DataFrame:
    """``slim`` with ``others``: the units of the nearest pages of the host, nearest first.

    Pages are sorted by host and path over all tasks and numbered, so that a host with very many
    pages is spread like all others; a page meets the AROUND ones before and after it by number.
    Within the host, those whose paths share the longer beginning are the nearer.
    """
    order = ["host", "path", "units_hash"]
    ranged = cut(slim.repartitionByRange(*order).sortWithinPartitions(*order))
    place = ranged.withColumn("id", F.monotonically_increasing_id()).withColumn(
        "part", F.shiftright("id", 33))
    # One row per partition.
    counts = place.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = cut(
        place.join(F.broadcast(starts), "part")
        .withColumn("number", F.col("start") + F.col("id") - F.shiftleft("part", 33))
        .select("number", "host", "path", "units", "units_hash", "prose", "copied"))
    steps = [k for n in range(1, AROUND + 1) for k in (n, -n)]
    both = numbered
    for k in steps:
        both = both.join(numbered.select(
            (F.col("number") + k).alias("number"), "host",
            F.struct("path", "units").alias(f"other{k}")), ["number", "host"], "left")

    def alike(other: Column) -> Column:
        """Characters that both paths begin with."""
        most = F.least(F.length("path"), F.length(other["path"]))
        return F.size(F.filter(F.sequence(F.lit(0), most), lambda n: F.substr(
            "path", F.lit(1), n) == F.substr(other["path"], F.lit(1), n)))

    found = [F.struct((-alike(F.col(f"other{k}"))).alias("far"), F.lit(rank).alias("rank"),
                      F.col(f"other{k}.units").alias("units")) for rank, k in enumerate(steps)]
    near = F.array_sort(F.filter(F.array(*found), lambda x: x["units"].isNotNull()))
    return both.withColumn("others", F.transform(near, lambda x: x["units"]))
