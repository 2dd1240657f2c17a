"""Main text of web pages (operator 9) by differencing with the nearest URL.

1. Blocks. A page is cut into text blocks at block-level tags; each block knows the elements
   around it. Character references are decoded, white space inside a block becomes one
   space. Scripts, styles and other elements without text of their own are left out.
2. Neighbours. Pages are put in the order of (host, URL path). The order is a range-
   partitioned position, not a window, so a host with a third of all pages is spread over
   many tasks. Each page is paired with the page before it and the page after it on its host.
3. Differencing. The block lists of a pair are aligned by their longest common subsequence.
   Shared blocks are the template of the site (menus, notices, footers) and are deleted.
4. Article. Inside an ``article`` or ``main`` element copied pages and quoted passages share
   blocks that must stay. There a block is template only if both neighbours hold it at the same
   place (counted from the article's beginning or its end), at most half of the article is
   like that, and it is found so on more than half of the pages of a host with at least
   ``SITE_PAGES`` pages. Elements that say what they are (menus, headers, footers, asides,
   forms, adverts, notices, comments) are deleted, shared or not. Where a page has an article
   element, unshared blocks around it are furniture as well, unless they hold more text than
   it does: then the article is a teaser and the page's text stands around it.

Only hashes of blocks travel between pages; the page itself meets its deletions by a key of
the whole row, so repeated rows get one answer each.

Defined cases: null html is the empty page (empty text). A page whose URL is null is paired
with nothing. Unclosed and cut-off markup is read to its end; cut-off references stay as
they are. Long pages are read whole. Empty tables give empty results.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import md_key, read, stored
from tidemark.operators.ranking import with_global_position

# HTML element names by their role.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select "
                   "textarea button datalist map".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
OWN = frozenset("article main".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr big acronym img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that name furniture: of any page, of what stands in an article too.
FOREIGN = (r"ads?|advert\w*|adsense|promo\w*|sponsor\w*|comments?|comment-list|reviews?|disqus|share|sharing|social|"
           r"newsletter|subscribe|search")
AREAS = r"banner|breadcrumbs?|cookies?|consent|footer|menu|nav|navbar|navigation|notices?|popup|modal|related|sidebar|" \
        r"toolbar|widget|complementary|contentinfo"
HEADS = r"header|masthead"


def _naming(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{words})(?:$|[\s_-])", re.I)


#: By where an element stands: in no article or main, in main alone, in an article.
NAMED, NAMED_IN_MAIN, NAMED_IN_ARTICLE = (_naming(w) for w in (f"{FOREIGN}|{AREAS}|{HEADS}", f"{FOREIGN}|{AREAS}", FOREIGN))
TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)"
                 r"((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)

#: Cells of the largest alignment table that is held at once.
TABLE_CELLS = 4_000_000
#: Elements that a new paragraph closes.
OPEN_ENDED = INLINE | {"p"}
#: Pages of a host from which lines inside its articles can be told to be template.
SITE_PAGES = 5
#: Where a block stands.
AROUND, ARTICLE, REMOVED = 0, 1, 2


def _removed(attributes: str, names: re.Pattern) -> bool:
    """Whether an element is hidden, or says by class, id or role what it is."""
    own: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        own.setdefault(name.lower(), "".join(values))
    return ("hidden" in own or own.get("aria-hidden", "").strip().lower() == "true"
            or bool(UNSEEN.search(own.get("style", "")))
            or bool(names.search(" ".join(own.get(k, "") for k in ("class", "id", "role")))))


def blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, where) of the blocks of a page, in page order."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, an article's own, silent
    removed = silent = own = 0

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((text, REMOVED if removed else ARTICLE if own else AROUND))
            held.clear()

    source, at = html or "", 0
    while at < len(source):
        m = TAG.search(source, at)
        if m is None:
            if not silent:
                held.append(source[at:])
            break
        if m.start() > at and not silent:
            held.append(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, ending = m[2].lower(), m[1] == "/"
        if name not in INLINE:
            close()
        if ending:
            if any(name == n for n, *_ in stack):
                while stack:
                    n, is_removed, is_own, is_silent = stack.pop()
                    removed, own, silent = removed - is_removed, own - is_own, silent - is_silent
                    if n == name:
                        break
        elif name not in VOID and not m[3].endswith("/"):
            if name in RAW:  # its content is not markup: go on at its end
                end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if name == "p":  # a paragraph ends where the next begins
                while stack and stack[-1][0] in OPEN_ENDED:
                    n, is_removed, is_own, is_silent = stack.pop()
                    removed, own, silent = removed - is_removed, own - is_own, silent - is_silent
                    if n == "p":
                        break
            is_silent = name in SILENT
            is_own = name in OWN
            names = (NAMED if not own else NAMED_IN_ARTICLE if any(n == "article" for n, *_ in stack) else NAMED_IN_MAIN)
            named = bool(m[3]) and _removed(m[3], names)
            inside = own > 0 and name == "header"  # an article's own heading stays
            is_removed = (name in FURNITURE and not inside) or (named and name not in ("html", "body") and not is_own)
            stack.append((name, is_removed, is_own, is_silent))
            removed, own, silent = removed + is_removed, own + is_own, silent + is_silent
    close()
    return out


def _last_row(x: np.ndarray, y: np.ndarray, keep: bool = False) -> np.ndarray:
    """Lengths of the longest common subsequences of x and each beginning of y (or all rows)."""
    row = np.zeros(len(y) + 1, np.int32)
    table = [row]
    for value in x:
        row = np.r_[0, np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == value)))].astype(np.int32)
        if keep:
            table.append(row)
    return np.array(table) if keep else row


def _matched(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence; halves what is too large for one table."""
    if not len(x) or not len(y):
        return []
    if len(x) > 1 and len(x) * len(y) > TABLE_CELLS:
        half = len(x) // 2
        cut = int(np.argmax(_last_row(x[:half], y) + _last_row(x[half:][::-1], y[::-1])[::-1]))
        return _matched(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in _matched(x[half:], y[cut:])]
    table, out = _last_row(x, y, keep=True), []
    i, j = len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1] and table[i, j] == table[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of a longest common subsequence of two arrays.

    Equal beginnings and ends are set aside, and what only one side has cannot be shared.
    """
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    n -= head
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    in_a[:head] = in_b[:head] = True
    in_a[len(a) - tail:] = in_b[len(b) - tail:] = True
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    rows, cols = np.flatnonzero(np.isin(x, y)), np.flatnonzero(np.isin(y, x))
    for i, j in _matched(x[rows], y[cols]):
        in_a[head + rows[i]] = in_b[head + cols[j]] = True
    return in_a, in_b


def _hashes(found: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """Hashes of the blocks around the article (64 bits), and of the article's own (32 bits)."""
    lines = np.array([xxhash.xxh64_intdigest(t) for t, where in found if where != ARTICLE], np.uint64)
    own = np.array([xxhash.xxh32_intdigest(t) for t, where in found if where == ARTICLE], np.uint32)
    return lines.tobytes(), own.tobytes()


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [_hashes(blocks(h)) for h in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)),
                                          *(pa.array([x[i] for x in lines], pa.binary()) for i in range(2))],
                                         names=["host", "path", "key", "lines", "own"])


def same_places(own: np.ndarray, others: list[np.ndarray]) -> list[dict[str, int]]:
    """Lines of an article that all the others hold at the same place from the beginning (0, 1, ...)
    or from the end (-1, -2, ...); none if they are more than half of it, as in copies."""
    if not others:
        return []
    n, found = len(own), []
    least = min(n, *map(len, others))
    for at in np.flatnonzero(np.all([own[:least] == o[:least] for o in others], axis=0)).tolist():
        found.append({"at": at, "line": int(own[at]), "place": at})
    ends = np.all([own[n - least:] == o[len(o) - least:] for o in others], axis=0)
    for at in (n - least + np.flatnonzero(ends)).tolist():
        found.append({"at": at, "line": int(own[at]), "place": at - n})
    return found if 2 * len({f["at"] for f in found}) <= n else []


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Masks of the lines that a page shares with the page before or after it, and the lines of
    its article that both hold at the same place."""
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            lines = np.frombuffer(r.lines, np.uint64)
            mask = np.zeros(len(lines), bool)
            for other in (r.lines_before, r.lines_after):
                if other is not None:
                    mask |= common(lines, np.frombuffer(other, np.uint64))[0]
            others = [np.frombuffer(o, np.uint32) for o in (r.own_before, r.own_after) if o is not None]
            rows.append((r.host, r.key, np.packbits(mask).tobytes(), same_places(np.frombuffer(r.own, np.uint32), others)))
        yield pd.DataFrame(rows, columns=["host", "key", "mask", "alike"])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a URL; the query and the fragment are not part of a path."""
    return (F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)),
            F.regexp_extract(url, r"^(?:(?:[a-zA-Z][\w+.-]*:)?//[^/?#]*)?([^?#]*)", 1))


def templates(pages: DataFrame) -> DataFrame:
    """key, mask, site: which surrounding blocks of a page its nearest URLs share, and which
    blocks of its article are the site's."""
    host, path = url_parts(F.col("url"))
    narrow = (pages.where(F.col("url").isNotNull())
              .select(host.alias("host"), path.alias("path"), _key().alias("key"), "html")
              .mapInArrow(_surroundings, "host string, path string, key binary, lines binary, own binary")
              .dropDuplicates(["key"]).where(F.octet_length("lines") + F.octet_length("own") > 0))
    placed = stored(with_global_position(narrow, [F.col("host"), F.col("path"), F.col("key")], "pos"), "page-order")

    def neighbour(step: int, name: str) -> DataFrame:
        return placed.select((F.col("pos") + step).alias("pos"), "host", F.col("lines").alias(f"lines_{name}"),
                             F.col("own").alias(f"own_{name}"))

    paired = (placed.select("pos", "host", "key", "lines", "own")
              .join(neighbour(1, "before"), ["pos", "host"], "left").join(neighbour(-1, "after"), ["pos", "host"], "left"))
    pairs = stored(paired.drop("pos").mapInPandas(
        _shared, "host string, key binary, mask binary, alike array<struct<at int, line long, place int>>"), "page-pairs")

    alike = pairs.select("host", "key", F.inline("alike"))
    sizes = placed.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= SITE_PAGES)
    usual = (alike.groupBy("host", "line", "place").agg(F.count(F.lit(1)).alias("n")).join(sizes, "host")
             .where(2 * F.col("n") > F.col("pages")).select("host", "line", "place"))
    site = alike.join(usual, ["host", "line", "place"]).groupBy("key").agg(F.collect_set("at").alias("site"))
    return pairs.select("key", "mask").join(site, "key", "left")


def _key() -> Column:
    return md_key(F.col("page_id"), F.col("url"), F.col("html"))


def main_blocks(html: str | None, mask: bytes | None, site: list[int] | None = None) -> list[str]:
    """The blocks that stay: not shared with a neighbour, not the site's (``site``: numbers of such
    blocks among the article's own), not furniture."""
    found = blocks(html)
    size = sum(where != ARTICLE for _, where in found)
    bits = np.unpackbits(np.frombuffer(mask, np.uint8))[:size] if mask else np.zeros(size, bool)
    shared, inside = iter(bits), np.zeros(len(found) - size, bool)
    inside[site or []] = True
    theirs = iter(inside)
    left = [(t, where) for t, where in found if not next(theirs if where == ARTICLE else shared)]
    held = {kind: sum(len(t) for t, where in left if where == kind) for kind in (ARTICLE, AROUND)}
    if size < len(found) and held[AROUND] <= held[ARTICLE]:  # unshared blocks around an article go as well
        return [t for t, where in left if where == ARTICLE]
    return [t for t, where in left if where != REMOVED]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = ["\n".join(main_blocks(*row)) for row in zip(
            *(batch.column(i).to_pylist() for i in range(2, 5)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page (columns page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    masks = stored(templates(rows), "page-templates").hint("merge")  # as many as pages: nothing to broadcast
    masked = rows.withColumn("key", _key()).join(masks, "key", "left")
    return masked.select("page_id", "url", "html", "mask", "site").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    return extract(read(spark, sf_dir, "pages"))


QUERIES = {"op9_html_extraction": op9_html_extraction}
