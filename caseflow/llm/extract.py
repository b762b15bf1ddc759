"""Main text of web pages by nearest-URL page differencing.

A page becomes text lines: one per block element, character references
decoded, white space as single spaces. Pages are ordered by host and URL path,
each is aligned with the nearest page before and after it on its host by a
longest common subsequence of lines, and lines that align are deleted: a site
repeats its template, not its articles.

What the markup itself says comes after the alignment and overrules it: a line
inside ``article`` or ``main`` stays although a neighbour quotes it, and a line
inside a menu, footer, advert, form, script, comment section and the like goes
although it differs from page to page (rotating adverts, for instance). A mark
that rests on part of a class name, or a form, gives way to an article inside
it, or to most of a page's text; see ``_Marks``.

Pages are parsed once, into a table of packed lines. The order is made by
Spark: range bounds come from the places alone (one for each
``PAGES_PER_RANGE`` pages reaches the driver), and every range is read as a
sorted stream, so a host with a third of all pages is many ranges. Neighbours
with the very same lines (copies) are one run, however many and over however
many ranges: of the lines' digests, the two outermost runs at each end of a
range reach the driver (places and digests only), and each range is sent the
nearest page before and after it whose lines differ from those at its edge. A
task holds the lines of a run once, and of its copies the id and URL.

Defined results: null html is an empty page; a null or odd URL is a page of
the host ""; neighbours with the very same lines (copies) are passed over; a p, li,
dt, dd, table part or head without an end tag ends where HTML ends it, other tags
that are never closed end with their parent; a page cut off inside a tag ends
there; a very long page is whole in its task; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path
from .arrow import map_texts, quoted, schema_of

PAGES_PER_RANGE = 2000
#: How hard lines are packed (zlib): they are written once and exchanged once.
PACKING = 6
#: Rows and characters of text in a batch of results.
BATCH_ROWS, BATCH_CHARS = 500, 2_000_000
#: Pairs of equal lines per line of two pages, above which they are halved.
PAIRS = 16
TEMPLATE, PLAIN, ARTICLE = 0, 1, 2

#: A comment, a declaration, or a tag with its attributes: quotes count only where a value begins.
_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]++|[^\s/>][^\s/>=]*+(?>\s*+=\s*+(?>"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?)*+)(?:>|\Z)""",
                  re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?>\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?""")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
#: Left out too, but they nest, and the first may close itself.
_NESTED = {"svg", "math", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
          "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
          "thead", "tr", "ul"}
_SPACED = {"br", "td", "th"}
_OUT = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "head", "object", "canvas", "audio", "video"}
#: Start tags that close open elements whose end tag was left out: which, and where the search for them stops.
_CELLS, _GROUPS, _HEAD = {"td", "th"}, {"tbody", "thead", "tfoot"}, {"html", "head", "base", "link", "meta"}
_LIST_STOPS = (_BLOCK | _OUT | {"form"}) - {"address", "div", "p", "li", "dt", "dd"}
_CLOSES = {"li": ({"li"}, _LIST_STOPS), **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, _LIST_STOPS)),
           **dict.fromkeys(_CELLS, (_CELLS, {"tr", "table"})), "tr": (_CELLS | {"tr"}, {"table"}),
           **dict.fromkeys(_GROUPS, (_CELLS | _GROUPS | {"tr"}, {"table"}))}
_CLOSE_P, _P_STOPS = _BLOCK - _GROUPS - {"tr", "html", "head", "body"}, {"button", "object", "table"}
_OUT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
              "comments", "consent", "cookie", "cookies", "disqus", "footer", "menu", "modal", "nav", "navbar",
              "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "share", "sharing",
              "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
_WHOLE = {"html", "body", "main", "article"}
_OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu"}
#: First parts of names that say how a page is laid out, not what an element holds.
_ABOUT = {"has", "with", "no", "non", "not", "without", "is", "show", "hide"}
_CONTROLS = {"label", "legend", "option"}
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "article", "main"}
#: How sure a mark is: it holds whatever is inside; by a whole name; by the last part of a
#: name; by another part; a form.
SURE, NAMED, ENDS, PART, FORM = 4, 3, 2, 1, 0


def _marked(element: str, attributes: str) -> int | None:
    """How surely class, id or role name something that is not the article. Of what
    holds the article, a name like ``has-sidebar`` says nothing: only whole names count."""
    seen, found = set(), []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in seen:
            continue  # the first one holds
        seen.add(name)
        if name in ("class", "id"):
            for word in value.split():
                if word in _OUT_WORDS:
                    found.append(SURE if element in _WHOLE else NAMED)
                elif element not in _WHOLE:
                    parts = [x for x in re.split(r"[^a-z0-9]+", word) if x]
                    if parts and parts[0] not in _ABOUT and any(x in _OUT_WORDS for x in parts):
                        found.append(ENDS if parts[-1] in _OUT_WORDS else PART)
        elif name == "role":
            if value.strip() in _OUT_ROLES:
                found.append(SURE)
        elif name == "hidden" or name == "aria-hidden" and value.strip() == "true":
            found.append(SURE)
    return max(found, default=None)


class _Marks:
    """Elements whose mark holds only if the page has its main text elsewhere."""

    def __init__(self):
        self.above: list[int] = []  # the mark around each mark, -1 for none
        self.kind: list[int] = []
        self.lines: list[tuple[str, int, int, tuple[int, bool] | None, bool]] = []

    def add(self, above: int, kind: int) -> int:
        self.above.append(above)
        self.kind.append(kind)
        return len(self.kind) - 1

    def around(self, mark: int) -> Iterator[int]:
        while mark >= 0:
            yield mark
            mark = self.above[mark]

    def decided(self) -> list[tuple[str, int]]:
        """(text, region) of every line. A mark by part of a name, or a form, gives
        way to an article or ``main`` inside it; a whole name gives way to ``main``, and
        to an article if no other is left. On a page without either, a form or the
        part of a name gives way if it holds most of the text."""
        if not self.kind:
            return [(x[0], x[1]) for x in self.lines]
        void: set[int] = set()
        inner = [(article, text) for text, region, _, article, _ in self.lines if region == ARTICLE and article]
        for (mark, is_main), _ in inner:
            void.update(m for m in self.around(mark) if is_main or self.kind[m] < NAMED)

        def stays(mark: int) -> bool:
            return all(m in void for m in self.around(mark))

        def has_article() -> bool:
            return any(x[1] == ARTICLE and stays(x[2]) for x in self.lines)

        if not has_article():
            for (mark, _), _ in inner:
                void.update(self.around(mark))
        if not has_article():
            holds, total = [0] * len(self.kind), 0
            for text, region, mark, _, prose in self.lines:
                if region != TEMPLATE and all(self.kind[m] < NAMED for m in self.around(mark)):
                    total += len(text)
                    for m in self.around(mark):
                        holds[m] += len(text) if prose or self.kind[m] != FORM else 0
            void.update(m for m, n in enumerate(holds) if self.kind[m] < ENDS and 2 * n > total)
        return [(x[0], x[1] if stays(x[2]) else TEMPLATE) for x in self.lines]


def _skipped(page: str, at: int, name: str) -> int:
    """Where a nested element that began before ``at`` ends."""
    depth = 1
    for found in _TAG.finditer(page, at):
        if (found[2] or "").lower() == name:
            depth += -1 if found[1] else 0 if found[3].endswith("/") else 1
            if not depth:
                return found.end()
    return len(page)


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, region) of every block with text, in page order."""
    marks = _Marks()
    parts: list[str] = []
    # open elements: name, region inside, innermost mark, (mark around the article, is it main)
    stack: list[tuple[str, int, int, tuple[int, bool] | None]] = []
    outside = ("", PLAIN, -1, None)
    opened: Counter = Counter()

    def end() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            name, region, mark, article = stack[-1] if stack else outside
            marks.lines.append((text, region, mark, article, name in _PROSE))

    def close(names: set[str], stops: set[str] = frozenset()) -> None:
        """End the outermost of these elements (without stops, the innermost) and what is in it."""
        if not any(opened[x] for x in names):
            return
        first = None
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                first = k
                if not stops:
                    break
            elif stack[k][0] in stops:
                break
        if first is not None:
            if stack[-1][1:3] != (stack[first - 1] if first else outside)[1:3]:
                end()
            opened.subtract(x[0] for x in stack[first:])
            del stack[first:]

    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            parts.append(page[at:])
            break
        parts.append(page[at:found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue  # a comment or a declaration
        if found[1]:
            if name in _BLOCK:
                end()
            close({name})
            continue
        if name in _RAW:
            tail = re.compile(f"</{re.escape(name)}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = tail.end() if tail else len(page)
            continue
        if name in _NESTED:
            at = at if found[3].endswith("/") and name != "template" else _skipped(page, at, name)
            continue
        if name in _SPACED:
            parts.append(" ")
        if name in _BLOCK:
            end()
        if name in _CLOSES:
            close(*_CLOSES[name])
        if name in _CLOSE_P:
            close({"p"}, _P_STOPS)
        if name not in _HEAD and stack and stack[-1][0] == "head":
            close({"head"})
        _, region, mark, article = stack[-1] if stack else outside
        inside, own = region, mark
        sure = _marked(name, found[3]) if found[3] else None
        if name in _OUT or sure == SURE or (name == "header" and region != ARTICLE) or (name in _CONTROLS and opened["form"]):
            inside = TEMPLATE
        elif region != TEMPLATE:
            if sure is not None or name == "form":
                own = marks.add(mark, FORM if sure is None else sure)
            if name in ("article", "main"):
                inside, article = ARTICLE, (mark, name == "main")
        if name not in _VOID and (name in _BLOCK or name in _CELLS or (inside, own) != (region, mark)):
            if name not in _BLOCK and (inside, own) != (region, mark):
                end()
            stack.append((name, inside, own, article))
            opened[name] += 1
    end()
    return marks.decided()


def _lengths(a: Sequence, b: Sequence) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and ``b[:j]`` for every j (bit-parallel)."""
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    masks = {}
    for x in set(a) & places.keys():
        bits = np.zeros(len(b), np.uint8)
        bits[places[x]] = 1
        masks[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    ones = (1 << len(b)) - 1
    v = ones
    for x in a:
        if x in masks:
            u = v & masks[x]
            v = ((v + u) | (v - u)) & ones
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def aligned(a: Sequence, b: Sequence) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``: every line
    meets every occurrence in the other page (Hunt-Szymanski); where these pairs
    are many, ``a`` is halved at the best place of ``b`` first (Hirschberg)."""
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    if len(a) > 1 and sum(len(places.get(x, ())) for x in a) > PAIRS * (len(a) + len(b)):
        mid = len(a) // 2
        at = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        return aligned(a[:mid], b[:at]) | {mid + k for k in aligned(a[mid:], b[at:])}
    tails: list[int] = []  # smallest last position of a subsequence of each length
    last: list[tuple] = []  # and its chain: (position in a, chain before)
    for k, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            n = bisect.bisect_left(tails, j)
            if n == len(tails):
                tails.append(j)
                last.append((k, last[n - 1] if n else None))
            elif tails[n] != j:
                tails[n], last[n] = j, (k, last[n - 1] if n else None)
    out, chain = set(), last[-1] if last else None
    while chain:
        out.add(chain[0])
        chain = chain[1]
    return out


def _keyed(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    address = F.coalesce(F.col(quoted(url)).cast("string"), F.lit(""))
    path = F.regexp_replace(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    host = F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    number = F.coalesce(F.lpad(F.col(quoted(page_id)).cast("string"), 20, "0"), F.lit(""))
    return pages.select(F.struct(F.col(quoted(page_id)).alias("page_id"), F.col(quoted(url)).alias("url")).alias("row"),
                        host.alias("host"), F.concat_ws("\u0000", host, path, number).alias("place"),
                        F.col(quoted(html)).cast("string").alias("html"))


def _ranges(parsed: DataFrame) -> list[str]:
    """First place of every range, from the places alone."""
    n = parsed.count()
    found = parsed.select("place").repartitionByRange(max(1, -(-n // PAGES_PER_RANGE)), "place") \
        .groupBy(F.spark_partition_id().alias("p")).agg(F.min("place").alias("lo")).orderBy("lo").collect()
    return [r["lo"] for r in found]


def _unpacked(lines: bytes) -> list[str]:
    whole = zlib.decompress(lines).decode("utf-8", "surrogatepass")
    return whole.split("\n") if whole else []


def _home(lows: list[str], place: str) -> int:
    return max(bisect.bisect_right(lows, place) - 1, 0)


def _dealt(parsed: DataFrame, lows: list[str], guests: dict[tuple[str, bytes], list[int]]) -> DataFrame:
    """Every page once in its own range (``bucket``) and once (``guest`` > 0) in
    each range that needs it, ordered by place within a range."""
    sent = parsed.sparkSession.sparkContext.broadcast((lows, guests))
    out = StructType([*parsed.schema.fields, *schema_of("buckets array<int>").fields])
    arrow = to_arrow_schema(out)

    def number(batches):
        lows, guests = sent.value
        for batch in batches:
            place, digest = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("place", "digest"))
            own = [[_home(lows, p), *guests.get((p, d), ())] for p, d in zip(place, digest)]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.list_(pa.int32())).cast(arrow.field("buckets").type)],
                                             schema=arrow)

    numbered = parsed.mapInArrow(number, out)
    return numbered.select(*parsed.columns, F.posexplode("buckets").alias("guest", "bucket")) \
        .repartitionById(max(len(lows), 1), "bucket").sortWithinPartitions("bucket", "place", "digest")


def _edges(parsed: DataFrame, lows: list[str]) -> dict[int, list]:
    """For every range, a page (host, place, digest) of its first run, of its
    second, of its last and of the one before the last; None where it has no such run."""
    out = schema_of("bucket int, edge int, host string, place string, digest binary")
    arrow = to_arrow_schema(out)

    def ends(batches):
        bucket, found = None, [None] * 4

        def done():
            return pa.RecordBatch.from_pylist([dict(zip(arrow.names, (bucket, k, *x))) for k, x in enumerate(found) if x],
                                              schema=arrow)

        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bucket", "host", "place", "digest"))
            for b, *page in zip(*columns):
                if b != bucket:
                    if bucket is not None:
                        yield done()
                    bucket, found = b, [page, None, page, None]
                    continue
                if page[::2] != found[2][::2]:
                    found[3] = found[2]
                    if found[1] is None:
                        found[1] = page
                found[2] = page
        if bucket is not None:
            yield done()

    edges: dict[int, list] = {}
    for r in _dealt(parsed.select("host", "place", "digest"), lows, {}).mapInArrow(ends, out).collect():
        edges.setdefault(r["bucket"], [None] * 4)[r["edge"]] = (r["host"], r["place"], bytes(r["digest"]))
    return edges


def _guests(edges: dict[int, list]) -> dict[tuple[str, bytes], list[int]]:
    """The pages (place, digest) that ranges need from others: for each range
    the nearest one before and after it that is no copy of the page at its edge."""
    guests: dict[tuple[str, bytes], list[int]] = {}
    order = sorted(edges)
    for k, bucket in enumerate(order):
        # own edge, the others from near to far, and their near run and the one behind it
        for own, others, near, behind in ((0, reversed(order[:k]), 2, 3), (2, order[k + 1:], 0, 1)):
            host, _, digest = edges[bucket][own]
            for other in others:
                page = edges[other][near]
                if page[0] == host and page[2] == digest:
                    page = edges[other][behind]
                    if page is None:
                        continue  # all of that range belongs to the run
                if page[0] == host:
                    guests.setdefault((page[1], page[2]), []).append(bucket)
                break
    return guests


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every page with ``text`` (the lines that stay, one a row), ``n_chars``,
    ``n_shared`` (lines that a neighbour shares) and ``n_lines``."""
    spark = pages.sparkSession

    def parse(rows, texts):
        lines, region, digest = [], [], []
        for page in texts.to_pylist():
            found = lines_of(page or "")
            whole = "\n".join(x for x, _ in found).encode("utf-8", "surrogatepass")
            lines.append(zlib.compress(whole, PACKING))
            region.append(bytes(r for _, r in found))
            digest.append(hashlib.blake2b(whole, digest_size=16).digest())
        return {"digest": digest, "lines": lines, "region": region}

    keyed = _keyed(pages, page_id, url, html)
    path = scratch_path(spark, "page-lines")  # parsed once; the ranges and their edges read a few of its columns
    map_texts(keyed, "html", ["row", "host", "place"], "digest binary, lines binary, region binary", parse) \
        .write.option("compression", "zstd").parquet(path)
    parsed = spark.read.parquet(path)
    lows = _ranges(parsed)
    ordered = _dealt(parsed, lows, _guests(_edges(parsed, lows)) if len(lows) > 1 else {})
    added = schema_of("text string, n_chars long, n_shared long, n_lines long")
    out = StructType([StructField("row", parsed.schema["row"].dataType), *added.fields])
    arrow = to_arrow_schema(out)

    def runs(batches) -> Iterator[tuple]:
        """(bucket and host, lines, {region: rows of the copies}) of every run."""
        key, lines, copies = None, None, {}
        for batch in batches:
            row, text = (batch.column(batch.schema.get_field_index(c)) for c in ("row", "lines"))
            bucket, host, digest, guest, region = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                   for c in ("bucket", "host", "digest", "guest", "region"))
            mine: dict[bytes, list[int]] = {}

            def keep():
                for r, at in mine.items():  # take() copies: a slice would hold the whole batch
                    copies.setdefault(r, []).append(row.take(pa.array(at)))
                mine.clear()

            for i, found in enumerate(zip(bucket, host, digest)):
                if found != key:
                    keep()
                    if key is not None:
                        yield key[:2], lines, copies
                    key, lines, copies = found, _unpacked(text[i].as_py()), {}
                if not guest[i]:
                    mine.setdefault(region[i], []).append(i)
            keep()
        if key is not None:
            yield key[:2], lines, copies

    def run(batches):
        rows, values, chars = [], [], 0

        def flush():
            nonlocal chars
            columns = [pa.concat_arrays(rows).cast(arrow.field("row").type)]
            columns += [pa.array(x, arrow.field(k + 1).type) for k, x in enumerate(zip(*values))]
            rows.clear()
            values.clear()
            chars = 0
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        def finish(before, run, after):
            nonlocal chars
            place, lines, copies = run
            if not copies:
                return
            shared = set().union(*(aligned(lines, x[1]) for x in (before, after) if x is not None and x[0] == place))
            for region, parts in copies.items():
                text = "\n".join(x for k, (x, r) in enumerate(zip(lines, region))
                                 if r == ARTICLE or r == PLAIN and k not in shared)
                step = max(1, min(BATCH_ROWS, BATCH_CHARS // max(len(text), 1)))
                for part in parts:
                    for at in range(0, len(part), step):
                        rows.append(part.slice(at, step))
                        values.extend([(text, len(text), len(shared), len(lines))] * len(rows[-1]))
                        chars += len(text) * len(rows[-1])
                        if len(values) >= BATCH_ROWS or chars >= BATCH_CHARS:
                            yield flush()

        before = held = None
        for page in runs(batches):
            if held:
                yield from finish(before, held, page)
            before, held = held and held[:2], page
        if held:
            yield from finish(before, held, None)
        if rows:
            yield flush()

    done = ordered.mapInArrow(run, out)
    return done.select("row.page_id", "row.url", "text", "n_chars", "n_shared", "n_lines")


def extract_report(pages: DataFrame) -> DataFrame:
    """The columns of ``op6_html_extract``."""
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
