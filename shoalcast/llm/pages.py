"""Main text of web pages by differencing each page with the page of the nearest URL.

A page is cut into lines (the text of its blocks).  Pages are ordered by host and path, and the nearer of
the two neighbours on the same host is the partner, copies and near copies of the page skipped; a longest common subsequence aligns the lines
of both, for every page, and shared lines are the site's, not the page's.  Structure then corrects lines: what
stands in menus, site headers, footers, sidebars, notices, adverts, forms and comments goes, and an article or main
element is the main text even where neighbours quote the same lines.  A class or id that says so makes
an element the site's too, but not html, body, article and main, nor one that holds an article or main element.
Differencing decides all other lines, also of pages that mark an article, and all lines of a page that structure would leave empty.

Null html is an empty page (text empty), a null url a page of no host, a page alone on its host shares
nothing.  Pages of one host and path with equal lines have one entry and one partner, whatever their page_id.  Broken markup closes where its parent does.  Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage, drop_written

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav aside footer form button select menu dialog object canvas audio video head".split())
MAIN = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer login masthead menu modal nav navbar navigation newsletter notice pagination popup promo related reply replies "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Never the site's by their class or id.
NAMELESS = frozenset("html body".split()) | MAIN
OPEN, ARTICLE, SITE = 0, 1, 2
# Neighbours that share at least so much of their text (by characters) are copies, not partners.
ALMOST = 0.9
# The low bits of a line's digest hold its length, as far as they go.
LENGTH_BITS = 12


def kind(tag: str, attributes: str, in_main: bool) -> tuple[int, bool]:
    """Whether an element opens the site's part, the article's, or neither; and whether a class or id alone says site."""
    if tag in BOILERPLATE or (tag == "header" and not in_main):
        return SITE, False
    worded, main = False, tag in MAIN
    if "=" in attributes or "hidden" in attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return SITE, False
            if name == "role" and value in BOILERPLATE_ROLES:
                return SITE, False
            main |= name == "role" and value == "main"
            worded |= name in ("class", "id") and not BOILERPLATE_WORDS.isdisjoint(value.split())
    return ARTICLE if main else OPEN, worded and not main and tag not in NAMELESS


def lines(page: str) -> list[tuple[str, int]]:
    """The lines of a page in order, each with the part it belongs to."""
    # Each with the elements around it that are the site's by a class or id, unless they turn out to hold an article.
    out: list[tuple[str, int, tuple[int, ...]]] = []
    stack: list[tuple[str, int, tuple[int, ...]]] = []
    holds: set[int] = set()
    part, words, count, buffer, at = OPEN, (), 0, [], 0

    def flush():
        if buffer:
            line = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                out.append((line, part, words))

    def back_to(depth: int):
        nonlocal part, words
        del stack[depth:]
        now, around = stack[-1][1:] if stack else (OPEN, ())
        if (now, around) != (part, words):
            flush()
            part, words = now, around

    for token in TOKEN.finditer(page):
        if token.start() > at:
            buffer.append(page[at : token.start()])
        at = token.end()
        tag = token.group(3)
        if tag is None:
            if token.group(1):
                flush()
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if token.group(2):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    back_to(depth)
                    break
            continue
        if tag in VOID or token.group(4).endswith("/"):
            continue
        # A block ends an open paragraph, an item the item before it.
        if tag not in INLINE:
            for depth in range(len(stack) - 1, -1, -1):
                name = stack[depth][0]
                if name == "p" or name == tag == "li":
                    back_to(depth)
                    break
                if name not in INLINE:
                    break
        own, worded = kind(tag, token.group(4), part == ARTICLE)
        # Inside an article, an article among the comments is a comment.
        now, around = (SITE if part == SITE or own == SITE or (worded and part == ARTICLE) else max(part, own)), words
        if now == OPEN and worded:
            count += 1
            around = (*words, count)
        elif now == ARTICLE and part == OPEN:
            holds.update(words)
            around = ()
        if (now, around) != (part, words):
            flush()
            part, words = now, around
        stack.append((tag, now, around))
    buffer.append(page[at:])
    flush()
    return [(line, SITE if any(w not in holds for w in words) else part) for line, part, words in out]


def common(one: list[int], two: list[int]) -> list[bool]:
    """Which items of ``one`` are in a longest common subsequence with ``two``, by bit rows."""
    head = 0
    while head < min(len(one), len(two)) and one[head] == two[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and one[-1 - tail] == two[-1 - tail]:
        tail += 1
    a, b = one[head : len(one) - tail], two[head : len(two) - tail]
    return [True] * head + aligned(a, b) + [True] * tail


def bit_rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """After each item of ``b``, a row of bits; zero where the length grows with the item of ``a``."""
    places: dict[int, int] = {}
    for i, item in enumerate(a):
        places[item] = places.get(item, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows = full, []
    for item in b:
        met = row & places.get(item, 0)
        row = (row + met | row - met) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def aligned(a: list[int], b: list[int], most_bits: int = 1 << 28) -> list[bool]:
    if not a or not b:
        return [False] * len(a)
    if len(a) * len(b) > most_bits and len(b) > 1:
        # Too long to keep every row: cut ``b`` in half and ``a`` where both halves match most.
        half = len(b) // 2
        fore, back = bit_rows(a, b[:half], False)[0], bit_rows(a[::-1], b[half:][::-1], False)[0]

        def lengths(row: int) -> np.ndarray:
            bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
            return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

        cut = int(np.argmax(lengths(fore) + lengths(back)[::-1]))
        return aligned(a[:cut], b[:half], most_bits) + aligned(a[cut:], b[half:], most_bits)
    rows = bit_rows(a, b, True)
    out = [False] * len(a)
    row, column = len(b), len(a)
    while row and column:
        if rows[row - 1] >> (column - 1) & 1:
            column -= 1
        else:
            row -= 1
            if not row or rows[row - 1] >> (column - 1) & 1:
                column -= 1
                out[column] = True
    return out


def digest(line: str) -> int:
    most = (1 << LENGTH_BITS) - 1
    return (xxhash.xxh64_intdigest(line) & ~most | min(len(line), most)) - (1 << 63)


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map (key, host, path, html) to the line digests of each page."""
    for batch in batches:
        found = [[digest(text) for text, _ in lines(h or "")] for h in batch.column("html").to_pylist()]
        arrays = [*(batch.column(c) for c in ("key", "host", "path")), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "host", "path", "lines"])


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map (page_id, url, key, html) to the lines of each page and the part each belongs to."""
    for batch in batches:
        found = [lines(h or "") for h in batch.column("html").to_pylist()]
        arrays = [batch.column(c) for c in ("page_id", "url", "key")]
        arrays += [pa.array([[text for text, _ in f] for f in found], pa.list_(pa.string()))]
        arrays += [pa.array([[part for _, part in f] for f in found], pa.list_(pa.int8()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "key", "texts", "parts"])


def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map (host, path, copy, lines, partner) to which of the lines the partner shares."""
    for batch in batches:
        shared = [common(own, partner or []) for own, partner in zip(*(batch.column(c).to_pylist() for c in ("lines", "partner")))]
        arrays = [*(batch.column(c) for c in ("host", "path", "copy")), pa.array(shared, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "path", "copy", "shared"])


def corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map (page_id, url, texts, parts, shared) to the main text: lines that are not shared, structure put right."""
    for batch in batches:
        out, size = [], []
        for texts, parts, shared in zip(*(batch.column(c).to_pylist() for c in ("texts", "parts", "shared"))):
            asks = OPEN if any(part != SITE for part in parts) else SITE
            text = " ".join(t for t, part, gone in zip(texts, parts, shared) if part == ARTICLE or (part == asks and not gone))
            out.append(text)
            size.append((len(text), len(texts), sum(shared)))
        arrays = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())]
        arrays += [pa.array([s[i] for s in size], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars", "n_lines", "n_shared"])


def almost_equal(one: Column, two: Column) -> Column:
    """Whether two line lists share nearly all of their text; false with a missing one."""

    def chars(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + x.bitwiseAND((1 << LENGTH_BITS) - 1))

    shared = chars(F.array_intersect(one, two))
    most = F.greatest(chars(F.array_distinct(one)), chars(F.array_distinct(two)))
    return F.coalesce((one == two) | (shared >= ALMOST * most), F.lit(False))


def entries(pages: DataFrame) -> DataFrame:
    """key, host, path, copy (what equal line lists of a path have in common), lines."""
    schema = "key long, host string, path string, lines array<long>"
    found = pages.select("key", "host", "path", "html").mapInArrow(listed, schema)
    return found.withColumn("copy", F.xxhash64("lines"))


def partners(found: DataFrame) -> DataFrame:
    """host, path, copy, lines and partner (line digests of the nearest page of the host that is no copy) of
    the distinct entries.

    Entries are range partitioned by host and path, so a host of any size spreads; the rows at the
    edges of a part see the next part's first or last row, and what lies behind a run of copies there.
    """
    one_each = found.groupBy("host", "path", "copy").agg(F.first("lines").alias("lines"))
    ranged = one_each.repartitionByRange("host", "path", "copy")
    rows = cut_lineage(ranged.sortWithinPartitions("host", "path", "copy").withColumn("part", F.spark_partition_id()))
    place = F.struct("host", "path", "copy", "lines")
    onward = Window.partitionBy("part").orderBy("host", "path", "copy")
    backward = Window.partitionBy("part").orderBy(F.desc("host"), F.desc("path"), F.desc("copy"))
    near = rows.withColumn("last", F.lag(place).over(onward))
    # A run of almost equal neighbours ends where the next entry shares less.
    starts = F.col("last").isNotNull() & ~((F.col("last.host") == F.col("host")) & almost_equal(F.col("lines"), F.col("last.lines")))
    near = near.withColumn("starts", starts)
    near = near.withColumn("before", F.last(F.when(F.col("starts"), F.col("last")), ignorenulls=True).over(onward.rowsBetween(Window.unboundedPreceding, 0)))
    near = near.withColumn("after", F.last(F.when(F.col("starts"), place), ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1)))
    near = cut_lineage(near.drop("last", "starts"))
    edges = near.groupBy("part").agg(
        F.min(place).alias("first"),
        F.max(place).alias("last"),
        F.max("before").alias("last_before"),
        F.min("after").alias("first_after"),
    )
    # One row for each part.
    over = Window.orderBy("part")
    past, next_ = over.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        "part",
        F.lag("last").over(over).alias("before_part"),
        F.last("last_before", ignorenulls=True).over(past).alias("before_run"),
        F.lead("first").over(over).alias("after_part"),
        F.last("first_after", ignorenulls=True).over(next_).alias("after_run"),
    )
    near = near.join(edges, "part")

    def other(c: str):
        """The place, unless it is on another host or holds a copy."""
        apart = (F.col(f"{c}.host") == F.col("host")) & ~almost_equal(F.col("lines"), F.col(f"{c}.lines"))
        return F.when(apart, F.col(c))

    for side in ("before", "after"):
        near = near.withColumn(side, F.coalesce(other(side), F.when(F.col(side).isNull(), F.coalesce(other(f"{side}_part"), other(f"{side}_run")))))

    def distance(side: str):
        return F.when(F.col(f"{side}.host") == F.col("host"), F.levenshtein(F.col(f"{side}.path"), F.col("path")))

    near = near.withColumn("db", distance("before")).withColumn("da", distance("after"))
    back = F.col("db").isNotNull() & (F.col("da").isNull() | (F.col("db") <= F.col("da")))
    chosen = F.when(back, F.col("before.lines")).when(F.col("da").isNotNull(), F.col("after.lines"))
    return near.select("host", "path", "copy", "lines", chosen.alias("partner"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_lines and n_shared (lines the partner has too, before structure
    corrects any) of every row of ``pages`` (page_id, url, html)."""
    url = F.coalesce("url", F.lit(""))
    rest = F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    keyed = pages.select(
        "page_id",
        "url",
        "html",
        F.xxhash64("page_id", "url", "html").alias("key"),
        F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    id_type = pages.schema["page_id"].dataType.simpleString()
    # Written first: partners are sought among the entries, and each page takes its partner's lines by them.
    found = cut_lineage(entries(keyed))
    shared = partners(found).mapInArrow(differenced, "host string, path string, copy long, shared array<boolean>")
    # Rows of one key are equal, so each key has one partner; copies of a page get theirs by key.
    by_key = found.select("key", "host", "path", "copy").join(shared, ["host", "path", "copy"]).select("key", "shared").dropDuplicates(["key"])
    by_key = cut_lineage(by_key)
    drop_written(found)
    texts = keyed.mapInArrow(marked, f"page_id {id_type}, url string, key long, texts array<string>, parts array<byte>")
    schema = f"page_id {id_type}, url string, text string, n_chars long, n_lines long, n_shared long"
    return texts.join(by_key.hint("merge"), "key").select("page_id", "url", "texts", "parts", "shared").mapInArrow(corrected, schema)
