"""Main text of web pages: pages of a host are compared with their nearest URL, and lines that both have are taken away."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.plans.positions import salted_lookup, with_places

# The elements of HTML by what they mean for text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("head script style noscript template svg math iframe object embed canvas audio video map".split())
BOILERPLATE = frozenset("nav aside footer form button select textarea fieldset datalist dialog menu search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id values that name menus, headers, footers, sidebars, notices, adverts, forms or reader comments.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar "
    "footer sidebar aside rail cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe signup login form comment comments disqus replies "
    "share sharing social related pagination pager toolbar widget".split())
#: What ends an open element of the same kind, unless one of the second kind lies between.
IMPLIED_ENDS = {"p": ("p", ()), "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
                "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")), "option": ("option", ("select",))}

_NAMES = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_KEEP, _SKIP, _HIDE = 0, 1, 2


class _Lines(HTMLParser):
    """Text blocks of a page with what their place says: in the marked article, in boilerplate, or elsewhere."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # element, state, in the article
        self.block: list[str] = []
        self.lines: list[tuple[str, int, bool]] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.block).split())
        self.block.clear()
        if text:
            state, article = self.stack[-1][1:] if self.stack else (_KEEP, False)
            if state != _HIDE:
                self.lines.append((text, state, article))

    def close_to(self, at: int) -> None:
        if any(tag not in INLINE for tag, *_ in self.stack[at:]):
            self.end_block()
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.block.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self.end_block()
            return
        inline = tag in INLINE
        state, article = self.stack[-1][1:] if self.stack else (_KEEP, False)
        own = self.judged(tag, dict(attrs), article)
        if inline:
            if own == _KEEP:
                return
            own = _HIDE  # the block around it goes on
        else:
            self.end_block()
            kinds, stops = IMPLIED_ENDS.get(tag, ("p", ()))
            for at in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[at][0]
                if open_tag in kinds.split():
                    self.close_to(at)
                    break
                if open_tag in stops or open_tag not in INLINE:
                    break
            state, article = self.stack[-1][1:] if self.stack else (_KEEP, False)
        marks = tag in ("article", "main") or dict(attrs).get("role") == "main" or dict(attrs).get("itemprop") == "articleBody"
        self.stack.append((tag, max(state, own), article or (marks and max(state, own) == _KEEP)))

    def judged(self, tag: str, attrs: dict[str, str | None], article: bool) -> int:
        if tag in NO_TEXT or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return _HIDE
        if tag in BOILERPLATE or (tag == "header" and not article) or (attrs.get("role") or "").lower() in BOILERPLATE_ROLES:
            return _SKIP
        if tag in ("html", "body", "main") or not attrs:
            return _KEEP
        for value in (attrs.get("class"), attrs.get("id")):
            for name in (value or "").split():
                words = [w.lower() for w in _NAMES.findall(name)]
                # "has-sidebar" says something about another element; a header inside an article is its title
                if words and words[0] not in ("has", "with", "no", "without") and any(w in BOILERPLATE_NAMES and not (article and w in ("header", "masthead")) for w in words):
                    return _SKIP
        return _KEEP

    def handle_startendtag(self, tag: str, attrs) -> None:
        # HTML knows no self-closing elements but void ones
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self.close_to(at)
                return
        if tag not in INLINE:
            self.end_block()

    def handle_data(self, data: str) -> None:
        if not self.stack or self.stack[-1][1] != _HIDE:
            self.block.append(data)


def page_lines(html: str) -> list[tuple[str, int, bool]]:
    """``(text, state, in article)`` of every visible block in page order; state 1 is boilerplate by its element."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.lines


# ---- longest common subsequence


def _lengths(a: list[int], where: dict[int, int], n: int) -> list[int]:
    """For each suffix-free row of the alignment one integer: zero bits mark where the LCS of a[:i] with b grows."""
    ones = (1 << n) - 1
    row, rows = ones, []
    for x in a:
        hit = where.get(x, 0) & row
        row = ((row + hit) | (row - hit)) & ones
        rows.append(row)
    return rows


def _aligned(a: list[int], b: list[int], bits: int) -> list[int]:
    """Places of ``a`` on one longest common subsequence with ``b``. Halves ``a`` until the rows to remember fit into ``bits``."""
    if not a or not b:
        return []
    n = len(b)
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    if len(a) * n > bits and len(a) > 1:
        # Hirschberg: where the best way crosses the middle row
        half = len(a) // 2
        top = _lengths(a[:half], where, n)[-1]
        back: dict[int, int] = {}
        for j, y in enumerate(reversed(b)):
            back[y] = back.get(y, 0) | 1 << j
        bottom = _lengths(a[:half - 1:-1], back, n)[-1]
        head = np.cumsum(np.append(0, [1 - (top >> j & 1) for j in range(n)]))
        tail = np.cumsum(np.append(0, [1 - (bottom >> j & 1) for j in range(n)]))[::-1]
        cut = int(np.argmax(head + tail))
        return _aligned(a[:half], b[:cut], bits) + [half + i for i in _aligned(a[half:], b[cut:], bits)]
    rows = _lengths(a, where, n)
    out, j = [], n - 1
    for i in range(len(a) - 1, -1, -1):
        # zeros at or below j that this row adds over the row before: the last of them is where a[i] is matched
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        above = rows[i - 1] if i else (1 << n) - 1
        zeros = (j + 1) - (rows[i] & ((1 << (j + 1)) - 1)).bit_count()
        before = (j + 1) - (above & ((1 << (j + 1)) - 1)).bit_count()
        if before < zeros:
            out.append(i)
            j -= 1
    return out[::-1]


def common_lines(a: list[int], b: list[int], bits: int = 1 << 26) -> list[int]:
    """Places of ``a`` on a longest common subsequence of both, bit-parallel in Python's long integers; equal beginnings and ends are matched as they are."""
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    inner = _aligned(a[start:len(a) - end], b[start:len(b) - end], bits)
    return [*range(start), *(start + i for i in inner), *range(len(a) - end, len(a))]


# ---- the job


def _digests(lines: list[tuple[str, int, bool]]) -> bytes:
    return np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t, *_ in lines], np.uint64).tobytes()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all lines of a page in page order."""
    for batch in batches:
        hashes = [_digests(page_lines(html.as_py() or "")) for html in batch["html"]]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("host", "path", "page_id")), pa.array(hashes, pa.binary())], names=["host", "path", "page_id", "hashes"])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all lines, which of them may be main text, and these texts, compressed for the way."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        hashes, fit, texts = [], [], []
        for html in batch["html"]:
            lines = page_lines(html.as_py() or "")
            marked = any(article and state == _KEEP for _, state, article in lines)
            # 2: in the marked article, 1: outside of boilerplate where no article is marked
            kinds = [0 if state or (marked and not article) else 1 + article for _, state, article in lines]
            hashes.append(_digests(lines))
            fit.append(bytes(kinds))
            texts.append(pack.compress("\n".join(t for (t, *_), kind in zip(lines, kinds) if kind).encode("utf-8", "replace")))
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in ("host", "path", "page_id", "url")), pa.array(hashes, pa.binary()), pa.array(fit, pa.binary()), pa.array(texts, pa.binary())],
            names=["host", "path", "page_id", "url", "hashes", "fit", "texts"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deletes the lines that a page shares with its partner and joins what is left of the main text."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out, gone = [], []
        for own, fit, texts, other in zip(*(batch[c].to_pylist() for c in ("hashes", "fit", "texts", "partner"))):
            a, b = (np.frombuffer(x or b"", np.uint64).tolist() for x in (own, other))
            shared = set(common_lines(a, b))
            at = [i for i, kind in enumerate(fit) if kind]
            free = [i for i in at if fit[i] == 1]
            # a neighbour that holds all of it is a copy of the page and tells nothing about its frame
            copy = bool(free) and all(i in shared for i in free)
            # a line holds no line break, as its white space is single spaces
            kept = [t for i, t in zip(at, unpack.decompress(texts).decode().split("\n")) if fit[i] == 2 or copy or i not in shared]
            out.append("\n".join(kept))
            gone.append(len(shared))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array(gone, pa.int64())], names=["page_id", "url", "text", "n_shared"])


def main_text(pages: DataFrame, bucket: int = 4096) -> DataFrame:
    """Main text of pages (``page_id``, ``url``, ``html``): ``page_id, url, text, n_chars, n_shared``.

    1. A page is cut into lines, the text blocks between block elements, with character references decoded and white space turned into single spaces. Elements, roles and
       class or id names for menus, headers, footers, sidebars, notices, adverts, forms and reader comments mark lines as boilerplate; ``article``, ``main`` and the
       like mark the article.
    2. The paths of a host are placed by one global sort, and a path's partner is the neighbour with the longer common beginning (on a tie the one before). A path stands
       for its page with the smallest id and content. Neighbours are found in stretches of places, so a hot host is spread over tasks.
    3. The lines of a page and of its partner (64-bit hashes) are aligned by their longest common subsequence, and shared lines are deleted. Lines inside a marked article
       stay even if shared, as copied articles are frequent and the text of an article has to be whole. Where no article is marked and a partner shares everything
       that could be main text, it is a copy of the page, and nothing is deleted.

    White space is what Unicode calls so. ``br`` is a space. Null html gives an empty text; a null url or one without host has no partner. Repeated rows give equal results.
    A page id may be null or repeated. An empty table gives an empty result; other columns are ignored. ``n_shared`` counts lines shared with the partner.
    """
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    named = rows.select("page_id", "url", F.nullif(host, F.lit("")).alias("host"), path.alias("path"), "html")
    # pages are parsed twice, once for hashes alone: that costs less than keeping their texts in between
    mine = named.filter("host IS NOT NULL").select("host", "path", "page_id", "html").mapInArrow(_hashed, "host string, path string, page_id bigint, hashes binary")
    least = F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "hashes"))
    stands = mine.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), least.alias("m")).select("host", "path", "n", F.col("m.hashes").alias("hashes"))
    placed = with_places(stands, ["host", "path"], "place")
    # the ends of a stretch are also part of the stretch beside it
    at = F.floor(F.col("place") / bucket)
    edge = F.pmod("place", F.lit(bucket))
    stretches = F.array_compact(F.array(at, F.when(edge == 0, at - 1), F.when(edge == bucket - 1, at + 1)))
    spread = placed.withColumn("own", at).withColumn("stretch", F.explode(stretches))
    line = Window.partitionBy("stretch").orderBy("place")
    kind = F.struct("host", "path", "hashes")
    beside = spread.withColumn("prev", F.lag(kind).over(line)).withColumn("next", F.lead(kind).over(line)).filter("own = stretch")

    def likeness(other: str):
        """Length of the common beginning of both paths; null for another host."""
        steps = F.array(*[F.lit(1 << i) for i in range(24, -1, -1)])
        alike = F.aggregate(steps, F.lit(0), lambda n, s: F.when(
            (n + s <= F.length("path")) & (F.substr(F.col("path"), F.lit(1), n + s) == F.substr(F.col(f"{other}.path"), F.lit(1), n + s)), n + s).otherwise(n))
        return F.when(F.col(f"{other}.host") == F.col("host"), alike)

    scored = beside.withColumn("to_prev", likeness("prev")).withColumn("to_next", likeness("next"))
    before = F.col("to_prev").isNotNull() & (F.col("to_next").isNull() | (F.col("to_prev") >= F.col("to_next")))
    partner = F.when(before, F.col("prev.hashes")).when(F.col("to_next").isNotNull(), F.col("next.hashes"))
    known = scored.select(F.struct("host", "path").alias("key"), "n", partner.alias("partner"))
    parsed = named.filter("host IS NOT NULL").mapInArrow(_parsed, "host string, path string, page_id bigint, url string, hashes binary, fit binary, texts binary")
    keyed = parsed.withColumn("key", F.struct("host", "path")).drop("host", "path")
    columns = ["page_id", "url", "hashes", "fit", "texts", "partner"]
    without = named.filter("host IS NULL").mapInArrow(_parsed, parsed.schema).withColumn("partner", F.lit(None).cast("binary"))
    met = salted_lookup(keyed, known, "key", "n").select(*columns).unionByName(without.select(*columns))
    cleaned = met.mapInArrow(_cleaned, "page_id bigint, url string, text string, n_shared bigint")
    return cleaned.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_shared")
