"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is an element's path of tags
and classes, with the blocks of text seen below it, at any depth (a block is its
text and the node that holds it), and the layouts of its children. Over the ``m`` pages that have a node,

* content importance is one less the mean entropy (base ``m``) of its blocks over
  the pages: text that returns on many pages says little;
* presentation importance is the entropy of its layouts;
* the kind of an element weighs both as odds: marked ones (menus, adverts and the
  like) and what stands beside an article count less, an article counts more. The
  value can outweigh any kind, the more so the more pages tell it.

The value is blended with that of the same path over all hosts, which weighs less
the more pages of the host have the node. A branch whose importance is under the cut is removed from every page of the host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts, written

#: Importance under which a branch goes.
CUT = 0.5
#: Odds of kinds to be main text: marked ones, unmarked ones of an article, and a factor of what stands beside one.
MARKED, ARTICLE, BESIDE = 1 / 9, 2.0, 1 / 9
#: Stands for all hosts; no host has a slash.
ALL = "/"
#: Pages that the value over all hosts, and doubt (an even value), each weigh as much as.
PULL = 4

#: Elements by kind.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset("script style template noscript iframe textarea title svg math select button object canvas audio video head".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MENUS = frozenset("nav aside footer form menu dialog search".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disqus "
    "footer menu nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe "
    "contentinfo complementary alert".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<more2>[^>]*+)(?:>|\Z)|(?P<text>[^<]++|<)",
    re.S,
)
#: Attributes are read one after another, so that a name inside a value is none.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?|["'=]""")
#: No-text elements that may hold one of their kind; others end where the next one begins.
_NESTED = frozenset("svg math object canvas audio video template".split())
#: Start tags that end svg and math, but not inside the elements of theirs that hold HTML.
_BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby "
    "s small span strong strike sub sup table tt u ul var".split()
)
_FOREIGN, _HTML_INSIDE = frozenset(("svg", "math")), frozenset(("foreignobject", "desc"))
_OPTIONS = frozenset(("option", "optgroup"))
_SILENT = re.compile(rf"<(/?)({'|'.join(sorted(NO_TEXT - RAW - {'head'}))})(?=[\s/>])", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
#: A class that begins so tells what a wrapper holds, not what it is.
_HOLDS = frozenset("has with no without is".split())


class Node:
    """An open element: its path in the style tree, zone, and whether it lies in boilerplate."""

    __slots__ = ("tag", "path", "article", "low", "children")

    def __init__(self, tag: str, path: int, article: bool, low: bool) -> None:
        self.tag, self.path, self.article, self.low = tag, path, article, low
        self.children: list[str] = []


def _label(tag: str, more: str) -> tuple[str, bool]:
    """Tag with its classes, role and mark, and whether it looks like boilerplate."""
    found: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(more) if more else ():
        if k:  # the first of two of a name counts
            found.setdefault(k.lower(), (v or "").strip("\"'").lower())
    names = [_PARTS.split(x) for k in ("class", "id", "role") for x in found.get(k, "").split()]
    words = {w for parts in names if parts[0] not in _HOLDS for w in parts}
    marked = tag not in ("html", "body", "main") and (tag in MENUS or bool(words & MARKS) or "hidden" in found)
    # marked and unmarked neighbours are nodes apart, also if only an id tells them apart
    return f"{tag}.{found.get('class', '')}.{found.get('role', '')}.{'!' if marked else ''}", marked


class Page:
    """Blocks of a page in order, each with the node that holds it; nodes in order, each below one before it."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, int]] = []
        # node above, depth, weight, article, layouts
        self.nodes: dict[int, tuple[int | None, int, float, bool, list[str]]] = {0: (None, 0, 1.0, False, [])}
        self.has_article = False
        self._read(source)

    @staticmethod
    def _closed(source: str) -> Callable[[str, int], bool]:
        """Whether an element without text that starts at a place has an end tag of its own."""
        last: dict[str, int] = {}
        ends: set[int] = set()
        before: dict[str, int] = {}
        for m in _SILENT.finditer(source):
            tag = m[2].lower()
            if m[1]:
                last[tag] = m.start()
                if tag in before:
                    ends.add(before.pop(tag))
            else:
                before[tag] = m.start()
        return lambda tag, at: at < last.get(tag, -1) if tag in _NESTED else at in ends

    def _read(self, source: str) -> None:
        root = Node("", 0, False, False)
        stack, held, at = [root], [], 0
        skip: list[str] = []  # open elements without text, "" one that was never closed, and blocks inside them
        closed = self._closed(source)

        def flush() -> None:
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                held.clear()
                if text:
                    self.blocks.append((text, stack[-1].path))

        def close(upto: int) -> None:
            flush()
            while len(stack) > upto:
                node = stack.pop()
                # equal neighbours count once, so that longer texts are no other layout
                layout = [c for i, c in enumerate(node.children) if not i or node.children[i - 1] != c]
                self.nodes[node.path][-1].append("/".join(layout))

        while at < len(source):
            m = _TOKEN.match(source, at)
            at = m.end()
            if m["text"]:
                if not skip:
                    held.append(m["text"])
                continue
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag, ends = tag.lower(), bool(m["end"] or m["end2"])
            if tag in RAW and not ends:
                stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                at = stop.start() if stop else len(source)
                continue
            if skip:
                if not ends and tag in _BREAKS and not _HTML_INSIDE & set(skip) and _FOREIGN & set(skip):
                    skip.clear()
                elif skip == [""] and tag in BLOCKS - _OPTIONS:
                    skip.clear()
                elif tag in ("body", "article", "main") and not ends:
                    skip.clear()
                elif ends and tag in skip:
                    del skip[len(skip) - 1 - skip[::-1].index(tag) :]
                    continue
                elif ends and tag in BLOCKS and any(n.tag == tag for n in stack):
                    skip.clear()  # what is around it ends it too
            if tag in NO_TEXT:
                if tag == "head":  # the others stand within a line
                    flush()
                if not ends and tag not in RAW and not m[0].endswith("/>"):
                    skip.append(tag if tag == "head" or closed(tag, m.start()) or tag in _FOREIGN else "")
                continue
            if skip:
                if not ends and (tag in BLOCKS - _OPTIONS or tag in _HTML_INSIDE) and tag not in VOID:
                    skip.append(tag)
                continue
            if tag == "br":
                held.append(" ")
            if tag not in BLOCKS:
                continue
            if ends:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                else:
                    flush()
                continue
            flush()
            shut = CLOSES.get(tag, frozenset()) | {"p"}
            k = len(stack)
            while k > 1 and stack[k - 1].tag in shut:
                k -= 1
            close(k)
            if tag in VOID:
                continue
            label, marked = _label(tag, m["more"] or m["more2"] or "")
            above = stack[-1]
            opens = tag in ("article", "main") and not marked and not above.low
            self.has_article |= opens
            marked |= tag == "header" and not above.article
            above.children.append(label)
            path = xxhash.xxh64_intdigest(f"{above.path}/{label}".encode()) >> 1
            article = above.article or opens
            if path not in self.nodes:
                # what stands around an article says nothing about it
                up, depth = (above.path, self.nodes[above.path][1] + 1) if above.article or not opens else (None, 0)
                self.nodes[path] = (up, depth, MARKED if marked else ARTICLE if article else 1.0, article, [])
            stack.append(Node(tag, path, article, above.low or marked))
        close(0)
        if self.has_article:
            # what stands beside an article is a node of its own
            beside = {p: p if n[3] else p ^ 1 for p, n in self.nodes.items()}
            self.nodes = {
                beside[p]: (beside.get(up), depth, weight if article else weight * BESIDE, article, layouts)
                for p, (up, depth, weight, article, layouts) in self.nodes.items()
            }
            self.blocks = [(t, beside[p]) for t, p in self.blocks]

    def statistics(self) -> set[tuple[int, int | None, int | None, float | None, int, int]]:
        """(path, path above, depth, weight, kind, feature): 0 a block, 1 a layout, 2 the node itself."""
        out = set()
        for path, (up, depth, weight, _, layouts) in self.nodes.items():
            out.add((path, up, depth, weight, 2, 0))
            for x in layouts:
                out.add((path, None, None, None, 1, xxhash.xxh64_intdigest(x.encode()) >> 1))
        for text, path in self.blocks:
            out.add((path, None, None, None, 0, xxhash.xxh64_intdigest(text.encode()) >> 1))
        return out

    def text(self, removed: set[int]) -> str:
        """Blocks outside the removed branches."""
        gone: dict[int | None, bool] = {None: False}
        for path, (up, *_) in self.nodes.items():
            gone[path] = path in removed or gone[up]
        return "\n\n".join(t for t, p in self.blocks if not gone[p])


def _below(tree: DataFrame) -> DataFrame:
    """``host, path, texts, spread``: summed over each node and all nodes below it.

    Pointer doubling: round ``k`` adds the sums of the nodes ``2^k`` below, as many
    rounds as the deepest node needs.
    """
    deepest, step = tree.agg(F.max("depth")).first()[0] or 0, 1
    sums = tree.select("host", "path", "up", "texts", "spread")
    while step <= deepest:
        more = sums.where("up is not null").groupBy("host", F.col("up").alias("path")).agg(
            F.sum("texts").alias("more_texts"), F.sum("spread").alias("more_spread")
        )
        far = sums.select("host", F.col("path").alias("up"), F.col("up").alias("far"))
        raised = sums.where("up is not null").join(far, ["host", "up"]).select("host", "path", F.col("far").alias("up"), "texts", "spread")
        sums = written(
            raised.unionByName(sums.where("up is null")).join(more, ["host", "path"], "left").select(
                "host", "path", "up",
                (F.col("texts") + F.coalesce("more_texts", F.lit(0))).alias("texts"),
                (F.col("spread") + F.coalesce("more_spread", F.lit(0.0))).alias("spread"),
            ),
            "sums",
        )
        step *= 2
    return sums.drop("up")


def parsed(pages: DataFrame, *keys: str) -> DataFrame:
    """The keys, the ``host`` and the ``found`` statistics of each page, as a table; ``pages`` has ``host`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(t.decode()).statistics() for t in texts(batch)]
            columns = list(zip(*(x for each in found for x in each))) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int64()]
            names = ["path", "up", "depth", "weight", "kind", "feature"]
            flat = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            ends = pa.array([0, *accumulate(map(len, found))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (*keys, "host")), pa.ListArray.from_arrays(ends, flat)], [*keys, "host", "found"]
            )

    rows = pages.select(*keys, "host", "text")
    kept = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in (*keys, "host"))
    return written(
        rows.mapInArrow(run, f"{kept}, found array<struct<path:bigint,up:bigint,depth:int,weight:double,kind:int,feature:bigint>>"), "parsed"
    )


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, path, importance`` of every node of every host's tree; ``pages`` is what ``parsed`` gives."""
    known = lambda: [F.max(c).alias(c) for c in ("up", "depth", "weight")]
    # a table, as hosts and the tree over all hosts both read it
    seen = written(
        pages.select("host", F.explode("found").alias("x")).select("host", "x.*")
        .groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("n"), *known()),
        "seen",
    )
    everywhere = seen.groupBy("path", "kind", "feature").agg(F.sum("n").alias("n"), *known()).select(F.lit(ALL).alias("host"), "*")

    def nodes(rows: DataFrame) -> DataFrame:
        at = lambda k, value: F.sum(F.when(F.col("kind") == k, value))
        return rows.groupBy("host", "path").agg(
            at(2, F.col("n")).alias("m"),
            F.count(F.when(F.col("kind") == 0, 1)).alias("texts"),
            F.coalesce(at(0, F.ln("n")), F.lit(0.0)).alias("spread"),
            (at(1, F.col("n") * F.ln("n")) / at(1, F.col("n"))).alias("same"),
            F.ln(at(1, F.col("n"))).alias("layouts"),
            *known(),
        )

    tree = written(nodes(seen).unionByName(nodes(everywhere)), "tree")
    value = F.when(F.col("m") <= 1, F.lit(1.0)).otherwise(
        F.greatest(
            F.when(F.col("texts") > 0, 1 - F.col("spread") / F.col("texts") / F.ln("m")).otherwise(F.lit(0.0)),
            (F.col("layouts") - F.col("same")) / F.greatest(F.ln("m"), "layouts"),
        )
    )
    valued = tree.drop("texts", "spread").join(_below(tree), ["host", "path"]).select("host", "path", "m", "weight", value.alias("value"))
    everywhere = valued.where(F.col("host") == ALL).select(
        "path", ((F.col("value") * (F.col("m") - 1) + PULL / 2) / (F.col("m") - 1 + PULL)).alias("common")
    )
    # a single page tells nothing; there is no number of pages at which the host's own tree sets in
    value = (F.col("value") * (F.col("m") - 1) + F.col("common") * PULL + PULL / 2) / (F.col("m") - 1 + 2 * PULL)
    return valued.where(F.col("host") != ALL).join(everywhere, "path").select(
        "host", "path", F.round(F.col("weight") * value / (F.col("weight") * value + 1 - value), 9).alias("importance")
    )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Null html is empty and gives the empty text; a null url is a host of its own.
    White space inside a block is one space, blocks are joined by an empty line;
    nothing else is dropped or cut. Repeated rows give equal results.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("text"),
    )
    # two hashes of all columns tell a page; rows that share them are equal
    rows = rows.withColumns({"a": F.xxhash64("page_id", "url", "text"), "b": F.xxhash64("text", "url", "page_id")})
    found = parsed(rows, "a", "b")
    low = written(style_tree(found).where(F.col("importance") < CUT).select("host", "path"), "low")
    # a page gets the removed paths it holds, whatever its host has besides; a table of its own,
    # so that the pages can be split in the join
    held = found.select("a", "b", "host", F.explode(F.expr("filter(found, x -> x.kind = 2).path")).alias("path"))
    low = written(held.join(low, ["host", "path"]).groupBy("a", "b").agg(F.collect_set("path").alias("low")), "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(t.decode()).text(set(low or ())) for t, low in zip(texts(batch), batch.column("low").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.join(low, ["a", "b"], "left").select("page_id", "url", "text", "low").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
