"""Main text of web pages by differencing against the nearest page of the same host.

A page becomes lines, one per block. What stands in menus, headers, footers,
sidebars, notices, adverts, forms or comments by its element goes at once, and so it
does by its class, id or role where one of them is such a word as a whole and no
article stands inside; names that only contain such a word are left to the differencing.
Each page is paired with the page of its host whose URL path is nearest and whose
lines differ; both are aligned by a longest common subsequence, and lines that they
share go. Lines inside a marked article are exempt from that (`trust_articles`):
two articles may quote the same passage, and a copy of an article has a near path.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.arrays import slices
from shelfsight.sources.scratch import materialize

ARTICLE, OPEN = 1, 0
_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<[!?][^>]*+>""")
_CLASS = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "select", "title"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "head", "button", "menu", "dialog", "fieldset"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
#: These end an open one of their kind, up to the container they are in.
_IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDERS = {"div", "section", "article", "main", "ul", "ol", "dl", "table", "body", "html", "blockquote", "figure", *_DROPPED}
_BOILER_WORDS = (
    "ad|ads|advert|advertisement|advertising|banner|sponsor(?:ed)?|promo|nav|navbar|navigation|menu|"
    "header|masthead|footer|sidebar|aside|complementary|contentinfo|cookies?|consent|gdpr|notice|alert|popup|modal|"
    "comments?|comment-list|disqus|reply|replies|share|sharing|social|related|recommended|newsletter|subscribe|signup|"
    "breadcrumbs?|pagination|pager|toolbar|skip|search"
)
_BOILER = re.compile(rf"(?i)(?<!\S)(?:{_BOILER_WORDS})(?!\S)")
_BOILER_PART = re.compile(rf"(?i)(?:^|[_-])(?:{_BOILER_WORDS})(?:$|[_-])")
#: Inside an article only whole words of this list drop an element, so alerts and search hints of the text stay,
#: and words of the second list as parts of compound names, too.
_INSIDE = re.compile(rf"(?i)(?<!\S)(?!(?:alert|search)(?!\S))(?:{_BOILER_WORDS})(?!\S)")
_ADDED_WORDS = "ads?|advert|advertisement|sponsor(?:ed)?|promo|comments?|disqus|reply|replies|share|sharing|social|related|recommended|newsletter|subscribe"
_ADDED = re.compile(rf"(?i)(?:^|[\s_-])(?:{_ADDED_WORDS})(?:$|[\s_-])")
#: An article that names itself so only points to another page.
_TEASER = re.compile(rf"(?i)(?:^|[\s_-])(?:teaser|card|{_ADDED_WORDS})(?:$|[\s_-])")
_MAIN = re.compile(r"\bmain\b")
#: Bits of row history that an alignment keeps at once; larger ones are split in two.
ALIGN_BITS = 1 << 28


def _is_main(marks: str) -> bool:
    """Does a class, id or role tell of the main part, and not of something like a main menu?"""
    return "main" in marks and any(_MAIN.search(m) and not _BOILER_PART.search(m) for m in marks.split())


def page_lines(html: str) -> tuple[list[str], list[int]]:
    """Lines of a page in order, without dropped elements, and the zone of each."""
    blocks: list[tuple[list[tuple[str, tuple[int, ...]]], int]] = []
    held: list[tuple[str, tuple[int, ...]]] = []  # text, and the elements marked by class around it
    stack: list[tuple[str, bool, bool, bool]] = []  # name, dropped, marked, article
    dropped = article = marked = 0
    around: tuple[int, ...] = ()
    holding: set[int] = set()  # marked elements with an article inside, which stay
    heads: list[tuple[bool, tuple[int, ...]]] = []  # of each h1: is it in an article, and the marked elements around it

    def flush():
        if held:
            blocks.append((held.copy(), ARTICLE if article else OPEN))
        held.clear()

    def pop():
        nonlocal dropped, article, around
        _, d, c, a = stack.pop()
        dropped -= d
        article -= a
        if c:
            around = around[:-1]

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        stop = m.start() if m else n
        if stop > at and not dropped:
            held.append((html[at:stop], around))
        if m is None:
            break
        at = m.end()
        if m[0] == "<!--":
            end = html.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if name in _RAW and not closing:
            if not m[3].endswith("/"):
                end = re.compile(rf"(?i)</{name}\b[^>]*+>?").search(html, at)
                at = n if end is None else end.end()
            if not dropped:
                held.append((" ", around))
            continue
        if name not in _INLINE and name != "br":
            flush()
        elif name == "br" and not dropped:
            held.append((" ", around))
        if name in _VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    while len(stack) > k:
                        pop()
                    break
            continue
        if name in _IMPLIED:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _HOLDERS and not (name in ("tr", "td", "th") and stack[k][0] != "table"):
                    break
                if stack[k][0] in _IMPLIED[name]:
                    while len(stack) > k:
                        pop()
                    break
        if m[3].endswith("/"):
            continue
        marks = " ".join(x or y or z for x, y, z in _CLASS.findall(m[3])) if m[3] else ""
        gone = name in _DROPPED
        words = (_INSIDE, _ADDED) if article else (_BOILER,)
        boiler = marks != "" and any(w.search(marks) for w in words)
        teaser = name == "article" and _TEASER.search(marks) is not None
        inside = name in ("article", "main") and not teaser or name not in ("body", "html", "article", "main") and _is_main(marks)
        if name == "h1" and not dropped:
            heads.append((article > 0, around))
        if inside and not boiler and not dropped and not gone:
            holding.update(around)
        by_class = teaser or boiler and not gone and name not in ("body", "html", "article", "main")
        if by_class:
            marked += 1
            around = (*around, marked)
        stack.append((name, gone, by_class, inside))
        dropped += gone
        article += inside
    flush()
    lines, zones = [], []
    for pieces, zone in blocks:
        text = " ".join(references.unescape("".join(t for t, c in pieces if holding.issuperset(c))).split())
        if text:
            lines.append(text)
            zones.append(zone)
    if any(zones):  # with a marked article, what stands outside it is not the article, unless only the outside has a headline
        shown = [z for z, c in heads if holding.issuperset(c)]
        kept = OPEN if shown and not any(shown) else ARTICLE
        lines = [t for t, z in zip(lines, zones) if z == kept]
        zones = [kept] * len(lines)
    return lines, zones


def common_marks(a: Sequence[int], b: Sequence[int], bits: int = ALIGN_BITS) -> list[bool]:
    """Which items of `a` are in a longest common subsequence with `b`.

    Rows of the table are bit vectors; when they would need more than `bits` bits, the
    longer problem is split where two half alignments sum to the best (Hirschberg).
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if not len(x) or not len(y):
        middle = [False] * len(x)
    elif len(x) * len(y) <= bits or len(x) == 1:
        middle = _traced(x, y)
    else:
        half = len(x) // 2
        front, back = _prefix_lengths(x[:half], y), _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int(np.argmax(front + back))
        middle = common_marks(x[:half], y[:cut], bits) + common_marks(x[half:], y[cut:], bits)
    return [True] * head + middle + [True] * tail


def _bit_rows(x: Sequence[int], y: Sequence[int]) -> Iterator[int]:
    where: dict[int, int] = {}
    for k, v in enumerate(y):
        where[v] = where.get(v, 0) | (1 << k)
    full = (1 << len(y)) - 1
    row = full
    for v in x:
        used = row & where.get(v, 0)
        row = ((row + used) | (row - used)) & full
        yield row


def _prefix_lengths(x: Sequence[int], y: Sequence[int]) -> np.ndarray:
    """Common subsequence length of all `x` with each prefix of `y`."""
    row = (1 << len(y)) - 1
    for row in _bit_rows(x, y):
        pass
    raw = np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), dtype=np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(raw, bitorder="little")[: len(y)].astype(np.int64))])


def _traced(x: Sequence[int], y: Sequence[int]) -> list[bool]:
    rows, out = list(_bit_rows(x, y)), [False] * len(x)
    i, j = len(x), len(y)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i == 0 or rows[i - 1] >> (j - 1) & 1:
            out[i] = True
            j -= 1
    return out


def _place(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", url or ""


def _parsed(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "html"):
            out = []
            for url, html in zip(piece.column("url").to_pylist(), pc.fill_null(piece.column("html"), "").to_pylist()):
                lines, zones = page_lines(html)
                host, path = _place(url)
                hashes = [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) for t in lines]
                sign = hashlib.blake2b(np.array(hashes, dtype=np.int64).tobytes() + bytes(zones), digest_size=16).digest()
                out.append((host, path, sign, lines if wide else hashes, zones))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.binary(), pa.list_(pa.string() if wide else pa.int64()), pa.list_(pa.int8()))
            ready = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["host", "path", "sign", "lines", "zones"]
            if wide:
                ready, names = [piece.column("page_id"), piece.column("url"), *ready], ["page_id", "url", *names]
            yield pa.RecordBatch.from_arrays(ready, names=names)


def _neighbours(signs: DataFrame) -> DataFrame:
    """Add the sign of the page before and after in (host, path) order, or null at a host's ends.

    Rows are range-sorted into slices; a slice's first and last rows find theirs among
    the first and last rows of the other slices, so no host is ordered in one task.
    """
    ranged = signs.select("host", "path", "sign").repartitionByRange("host", "path", "sign")
    ranged = materialize(ranged.withColumn("slice", F.spark_partition_id()), "paths")
    inside = Window.partitionBy("slice").orderBy("host", "path", "sign")
    this = F.struct("host", "path", "sign")
    near = ranged.withColumns({"prev": F.lag(this).over(inside), "next": F.lead(this).over(inside)})
    # Two rows per slice: its first and its last.
    edges = materialize(ranged.groupBy("slice").agg(F.min(this).alias("low"), F.max(this).alias("high")), "edges")
    across = Window.orderBy("slice")
    edges = edges.select("slice", F.lag("high").over(across).alias("edge_prev"), F.lead("low").over(across).alias("edge_next"))
    near = near.join(materialize(edges, "edges"), "slice")
    prev, after = F.coalesce("prev", "edge_prev"), F.coalesce("next", "edge_next")
    same = lambda other: F.when(other["host"] == F.col("host"), other)
    return near.select("host", "path", "sign", same(prev).alias("prev"), same(after).alias("next"))


def _shared_path(a, b):
    """How many leading path segments two paths have in common."""
    x, y = F.split(a, "/"), F.split(b, "/")
    equal = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"].eqNullSafe(p["y"]))
    first = F.array_position(equal, F.lit(False))
    return F.when(first == 0, F.size(equal)).otherwise(first - 1)


def main_text(
    pages: DataFrame, trust_articles: bool = True, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Return page_id, url, text and n_chars (code points) for every row of `pages`.

    A null html has no text (empty); a null url has an empty host, whose pages pair
    among themselves. Pages whose lines are all equal share one pairing, so a copy never
    erases a page, and a host's only page keeps all its lines. Repeated rows get equal
    texts; an empty table gives no rows. Other columns are not read. Starts Spark jobs.
    """
    chosen = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    narrow = "host string, path string, sign binary, lines array<long>, zones array<byte>"
    prints = chosen.select("url", "html").mapInArrow(lambda b: _parsed(b, False), narrow)
    # Equal pages of a host are one; their lines are taken along from any of them.
    signs = materialize(
        prints.groupBy("host", "sign").agg(F.min("path").alias("path"), F.any_value("lines").alias("lines"), F.any_value("zones").alias("zones")),
        "signs",
    )
    near = _neighbours(signs)
    closer = _shared_path(F.col("next.path"), F.col("path")) > _shared_path(F.col("prev.path"), F.col("path"))
    nearest = F.when(F.col("prev").isNull() | F.coalesce(closer, F.lit(False)), F.col("next")).otherwise(F.col("prev"))
    pairs = near.select("host", "sign", nearest["sign"].alias("other")).filter("other is not null")
    theirs = signs.select("host", F.col("sign").alias("other"), F.col("lines").alias("other_lines"))
    aligned = pairs.join(signs.select("host", "sign", "lines", "zones"), ["host", "sign"]).join(theirs, ["host", "other"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            gone = []
            for own, zones, other in zip(rows["lines"], rows["zones"], rows["other_lines"]):
                marks = common_marks(own, other)
                gone.append([k for k, m in enumerate(marks) if m and not (trust_articles and zones[k] == ARTICLE)])
            columns = [batch.column("host"), batch.column("sign"), pa.array(gone, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "sign", "gone"])

    gone = materialize(
        aligned.select("host", "sign", "lines", "zones", "other_lines")
        .mapInArrow(shared, "host string, sign binary, gone array<int>")
        .filter(F.size("gone") > 0),
        "gone",
    )
    wide = "page_id long, url string, host string, path string, sign binary, lines array<string>, zones array<byte>"
    parsed = chosen.mapInArrow(lambda b: _parsed(b, True), wide)
    left = F.filter("lines", lambda line, k: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), k))
    return (
        parsed.join(gone, ["host", "sign"], "left")
        .select("page_id", "url", F.array_join(left, "\n").alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
