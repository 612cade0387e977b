"""Main text of web pages by consensus on each host's container paths.

Every page scores its containers; a container's path is the tags and classes
from the body down, with digits generalised, so pages made from one template
agree on it. Spark adds the scores up per host and path; each page is then
extracted again from the elements at its host's winning path, or from its own
best container if it has none there.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import slices

SALTS = 64

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|noscript|template|iframe|svg|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("aside button datalist dialog fieldset footer form header head label menu nav optgroup option output".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table body article main section div blockquote".split())
_CONTAINERS = frozenset("body article main section div td center blockquote".split())
_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
#: classes and ids whose elements are left out; whole names, not parts between hyphens
_JUNK = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment comments comment-list consent "
    "cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo promoted promotion recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|prose|story|text)(?:$|[\s_-])", re.I)


class Page:
    """Containers in document order, and the text blocks with the container each lies in."""

    def __init__(self, source: str) -> None:
        #: per container: path, tag and classes, the number of the last one inside it
        self.paths: list[str] = ["body"]
        self.prior: list[float] = [0.7]
        self.last: list[int] = [0]
        self.net, self.linked, self.junk = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        #: elements that stay in spite of their name, by place in the source
        self._stay: set[int] = set()
        while found := self._read(source):
            # such an element shows only once its outer one stays, so one reading per level
            self._stay |= found
            self.paths, self.prior, self.last = ["body"], [0.7], [0]
            self.net, self.linked, self.junk, self.blocks = [0], [0], [0], []

    def _read(self, source: str) -> set[int]:
        """Read the page; gives elements left out by their name alone that hold what the page is about.

        That is an article or main element while none is outside such elements, or
        most of the page's text outside links.
        """
        #: open elements: tag, container number, dropped
        stack: list[tuple[str, int, bool]] = [("body", 0, False)]
        #: elements dropped by name: [characters outside links, holds an article], by place in the source
        named_only: dict[int, list] = {}
        #: how deep the stack was at the open one, its place, how deep at an element within that is dropped for more than its name
        mark, mark_at, hard = 0, 0, 0
        plain, has_article = 0, False
        piece: list[str] = []
        at, links = 0, 0

        def flush() -> None:
            if piece:
                text = " ".join("".join(piece).split())
                piece.clear()
                if text:
                    self.blocks.append((stack[-1][1], text))

        def pop() -> None:
            if stack[-1][0] not in _INLINE:
                flush()
            nonlocal mark, hard
            _, number, _ = stack.pop()
            if len(stack) <= hard:
                hard = 0
            if len(stack) <= mark:
                mark = 0
            if number != stack[-1][1]:
                self.last[number] = len(self.paths) - 1

        for found in _TAG.finditer(source):
            if found.start() > at:
                text = source[at : found.start()]
                if stack[-1][2]:
                    self.junk[stack[-1][1]] += len(text)
                    if mark and not hard and not links:
                        named_only[mark_at][0] += len(text.strip())
                else:
                    piece.append(html.unescape(text) if "&" in text else text)
                    (self.linked if links else self.net)[stack[-1][1]] += len(text)
                    plain += 0 if links else len(text.strip())
            at = found.end()
            _, close, tag, attributes, close2, tag2, attributes2 = found.groups()
            tag = tag or tag2
            if not tag:
                continue
            close, attributes, tag = close or close2, attributes or attributes2 or "", tag.lower()
            if tag in _VOID:
                if tag == "br":
                    piece.append(" ")
                elif tag == "hr":
                    flush()
                continue
            if tag == "html" or tag == "body":
                continue
            if close:
                if tag == "a":
                    links = max(0, links - 1)
                if any(x[0] == tag for x in stack[1:]):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                elif tag not in _INLINE:
                    flush()
                continue
            if tag == "a":
                links += 1
            inline = tag in _INLINE
            if inline and not attributes.strip():
                continue
            if not inline:
                flush()
                closes = _CLOSES.get(tag)
                if closes:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] in closes:
                            while len(stack) > depth:
                                pop()
                            break
                        if stack[depth][0] in _SCOPE:
                            break
                elif stack[-1][0] == "p":
                    pop()
            named = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(attributes)} if attributes else {}
            label = f"{named.get('class', '')} {named.get('id', '')}"
            _, number, inside = stack[-1]
            firm = (
                tag in _DROPPED
                or "hidden" in named
                or named.get("aria-hidden") == "true"
                or named.get("role", "") in _ROLES
                or "display:none" in named.get("style", "").replace(" ", "")
            )
            dropped = inside or firm or (not _JUNK.isdisjoint(label.lower().split()) and found.start() not in self._stay)
            if dropped and not inside and not firm and not (inline and tag == "a"):
                mark, mark_at = len(stack), found.start()
                named_only[mark_at] = [0, False]
            elif mark and firm and not hard and not (inline and tag == "a"):
                hard = len(stack)
            if tag in ("article", "main"):
                if not dropped:
                    has_article = True
                elif mark and not hard:
                    named_only[mark_at][1] = True
            if inline:
                if dropped and tag != "a":
                    stack.append((tag, number, dropped))
                continue
            if tag in _CONTAINERS and not dropped:
                name = ".".join([tag, *sorted(re.sub(r"[0-9]+", "#", named.get("class", "")).split())])
                self.paths.append(f"{self.paths[number]}>{name}")
                self.prior.append(1.3 if tag in ("article", "main") or _CONTENT.search(label) else 1.0)
                self.last.append(len(self.paths) - 1)
                for sums in (self.net, self.linked, self.junk):
                    sums.append(0)
                number = len(self.paths) - 1
            stack.append((tag, number, dropped))
        rest = source[at:]
        plain += 0 if stack[-1][2] else len(rest.strip())
        if rest.strip() and not stack[-1][2]:
            piece.append(html.unescape(rest))
            self.net[stack[-1][1]] += len(rest)
        while len(stack) > 1:
            pop()
        flush()
        self.last[0] = len(self.paths) - 1
        whole = plain + sum(n for n, _ in named_only.values())
        return {at for at, (n, article) in named_only.items() if n and (2 * n > whole or (article and not has_article))}

    def scores(self) -> np.ndarray:
        """Per container: its share of the page's text outside links, times its purity and what its name promises."""
        whole = [np.concatenate([[0], np.cumsum(x)]) for x in (self.net, self.linked, self.junk)]
        first, end = np.arange(len(self.paths)), np.array(self.last) + 1
        net, linked, junk = (x[end] - x[first] for x in whole)
        total = max(1, int(net[0]))
        return net / total * net / np.maximum(1, net + linked + junk) * np.array(self.prior)

    def text(self, path: str | None) -> str:
        """The blocks of the containers at the path; of the best container if there are none with text."""
        chosen = [i for i, p in enumerate(self.paths) if p == path]
        for starts in (chosen, [int(np.argmax(self.scores()))]):
            inside = np.zeros(len(self.paths), bool)
            for i in starts:
                inside[i : self.last[i] + 1] = True
            blocks = [text for number, text in self.blocks if inside[number]]
            if blocks:
                return "\n".join(blocks)
        return ""


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the path with the highest sum of scores over the host's pages; of equal ones the first by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                hosts, paths, scores = [], [], []
                for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                    page = Page(source or "")
                    best: dict[str, float] = {}
                    for path, score in zip(page.paths, page.scores().tolist()):
                        best[path] = max(best.get(path, 0.0), score)
                    best = {p: s for p, s in best.items() if s > 0}
                    hosts += [host] * len(best)
                    paths += best
                    scores += best.values()
                # whole thousandths, so that sums don't depend on the order of addition
                points = pa.array([round(s * 1000) for s in scores], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), points], ["host", "path", "points"])

    votes = pages.select(_host("url").alias("host"), "html").mapInArrow(run, "host string, path string, points long")
    sums = votes.groupBy("host", "path").agg(F.sum("points").alias("points"))
    first = F.min(F.struct((-F.col("points")).alias("rank"), "path"))
    return sums.groupBy("host").agg(first.alias("best")).select("host", "best.path")


def _shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages compressed, as they are on their way to their host's path; a null page is empty."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for whole in batches:
        for batch in slices(whole, "html"):
            packed = [pack((source or "").encode()) for source in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(packed, pa.binary()), batch.column("host")]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "html", "host"])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    A null or empty page gives the empty text; a null url belongs to the host of
    the empty name; repeated rows are extracted each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in slices(whole, "html"):
                texts = [
                    Page(unpack(packed).decode()).text(path)
                    for packed, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    kind = dict(pages.dtypes)["page_id"]
    small = pages.select("page_id", "url", "html", _host("url").alias("host")).mapInArrow(
        _shrunk, f"page_id {kind}, url string, html binary, host string"
    )
    # a host may have a third of all pages: its pages go to SALTS places
    paths = host_paths(pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = small.withColumn("salt", F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int"))
    joined = salted.join(paths, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
