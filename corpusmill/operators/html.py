"""Web pages and wiki exports into markdown: a tree from the standard library's parser, walked by one function for each kind of element."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions.text import slugify, strip, whitespace_words
from corpusmill.operators.rank import ranked
from corpusmill.session import stored

# --- fixed values -------------------------------------------------------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements left out of the main content: tag, attribute, and what it must be or contain
CHROME = (("script", "", ""), ("style", "", ""), ("div", "id", "breadcrumb-section"), ("div", "id", "breadcrumbs"), ("div", "class", "page-metadata"), ("div", "id", "footer"), ("div", "class", "pageSection"))
CHROME_FOLDERS = ("attachments", "images", "styles")
#: a start tag of the key ends an open element of these
ENDS = {"p": "p", "li": "li", "tr": "tr td th", "td": "td th", "th": "td th", "dt": "dt dd", "dd": "dt dd", "option": "option"} | {t: "p" for t in "div ul ol table h1 h2 h3 h4 h5 h6 pre blockquote hr section article header footer nav form dl".split()}
#: what such an element cannot be ended across
FENCES = {"li": "ul ol", "tr": "table", "td": "table", "th": "table", "dt": "dl", "dd": "dl"}
# ------------------------------------------------------------------------------------------------------------------------------------------


COMMENT = "#comment"


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parts: list["Node | str"] = field(default_factory=list)

    def walk(self) -> Iterator["Node"]:
        for part in self.parts:
            if isinstance(part, Node):
                yield part
                yield from part.walk()

    def texts(self) -> Iterator[str]:
        for part in self.parts:
            if isinstance(part, Node):
                yield from part.texts()
            else:
                yield part

    def elements(self, *tags: str) -> list["Node"]:
        return [p for p in self.parts if isinstance(p, Node) and p.tag in tags]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ended = ENDS.get(tag, "").split()
        fences = {"table", "td", "th", "body", "#document"} | set(FENCES.get(tag, "").split())
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in ended:
                del self.open[depth:]
                break
            if self.open[depth].tag in fences:
                break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)

    def handle_comment(self, data: str) -> None:
        """Its text is nobody's, but what follows it is text behind the comment, not behind the element before."""
        self.open[-1].parts.append(Node(COMMENT))

    handle_pi = unknown_decl = handle_comment


def tree(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def inline(node: Node) -> str:
    return re.sub(r"\s+", " ", " ".join(node.texts())).strip()


def _is_chrome(node: Node) -> bool:
    for tag, attr, value in CHROME:
        if node.tag == tag and (not attr or (node.attrs.get("id") == value if attr == "id" else value in node.attrs.get("class", ""))):
            return True
    return False


def without_chrome(node: Node) -> Node:
    """The element without its chrome. What follows a removed element up to the next one, or to a comment, goes with it."""
    kept: list[Node | str] = []
    gone = False
    for part in node.parts:
        if isinstance(part, Node):
            gone = _is_chrome(part)
            if not gone:
                kept.append(without_chrome(part))
        elif not gone:
            kept.append(part)
    return Node(node.tag, node.attrs, kept)


@dataclass(frozen=True)
class _Place:
    depth: int = 0
    ordered: bool = False


def _inside(node: Node, at: _Place) -> str:
    return "".join(p if isinstance(p, str) else _element(p, at) for p in node.parts)


def _heading(node: Node, at: _Place) -> str:
    return f"\n{'#' * int(node.tag[1])} {text}\n\n" if (text := inline(node)) else ""


def _table(node: Node, at: _Place) -> str:
    grid = [[inline(c).replace("|", "\\|") for c in row.elements("td", "th")] for row in node.walk() if row.tag == "tr"]
    grid = [cells for cells in grid if cells]
    if not grid:
        return "\n"
    width = max(map(len, grid))
    head, *rest = (f"| {' | '.join(cells + [''] * (width - len(cells)))} |" for cells in grid)
    return "\n" + "\n".join([head, "|" + " --- |" * width, *rest]) + "\n\n"


def _code_block(node: Node, at: _Place) -> str:
    code = "".join(node.texts()).strip("\n")
    return f"\n```\n{code}\n```\n\n" if code.strip() else ""


def _list(node: Node, at: _Place) -> str:
    within = _Place(at.depth + 1, node.tag == "ol")
    items = [re.sub(r"\n{2,}", "\n", _inside(item, within).strip()) for item in node.elements("li")]
    marks = [f"{k}." if node.tag == "ol" else "-" for k in range(1, len(items) + 1)]
    return "\n" + "\n".join(f"{'  ' * at.depth}{m} {i}" for m, i in zip(marks, items, strict=True)) + "\n\n" if items else ""


def _link(node: Node, at: _Place) -> str:
    label, target = inline(node), node.attrs.get("href", "")
    return f"[{label}]({target})" if label and re.match("https?://", target) else label


def _image(node: Node, at: _Place) -> str:
    return f"({alt}) " if (alt := node.attrs.get("alt", "").strip()) else ""


def _marked(mark: str) -> Callable[[Node, _Place], str]:
    return lambda node, at: f"{mark}{text}{mark}" if (text := inline(node)) else ""


def _paragraph(node: Node, at: _Place) -> str:
    return f"{body}\n\n" if (body := _inside(node, at).strip()) else ""


def _quote(node: Node, at: _Place) -> str:
    body = _inside(node, at).strip()
    return "\n" + "\n".join(f"> {line}" for line in body.splitlines()) + "\n\n" if body else ""


ELEMENTS: dict[str, Callable[[Node, _Place], str]] = {
    **{f"h{k}": _heading for k in range(1, 7)}, "table": _table, "pre": _code_block, "ul": _list, "ol": _list, "a": _link, "img": _image,
    "br": lambda node, at: "\n", "hr": lambda node, at: "\n\n---\n\n", "strong": _marked("**"), "b": _marked("**"), "em": _marked("*"), "i": _marked("*"),
    "code": _marked("`"), "tt": _marked("`"), "p": _paragraph, "blockquote": _quote,
    COMMENT: lambda node, at: "",
}


def _element(node: Node, at: _Place) -> str:
    return ELEMENTS.get(node.tag, _inside)(node, at)


def convert_page(html: str, separator: str = " : ") -> tuple[str, str]:
    """Title, without what stands before the separator, and the main content as markdown."""
    if not html.strip():
        raise ValueError("empty page")
    root = tree(html)
    nodes = list(root.walk())
    named = next((n for n in nodes if n.tag == "title"), None)
    title = next((p for p in named.parts if isinstance(p, str)), "").strip() if named else ""
    title = title.split(separator, 1)[1].strip() if separator in title else title
    main = next((n for n in nodes if n.attrs.get("id") == "main-content"), None) or next((n for n in nodes if n.tag == "body"), root)
    body = re.sub(r"[ \t]+\n", "\n", _inside(without_chrome(main), _Place()))
    return title, re.sub(r"\n{3,}", "\n\n", body).strip()


@F.pandas_udf(StructType([StructField("title", StringType()), StructField("body", StringType()), StructField("error", StringType())]))
def _converted(pages: pd.Series) -> pd.DataFrame:
    out = []
    for page in pages:
        try:
            out.append((*convert_page(page or ""), None))
        except Exception as e:  # noqa: BLE001  one bad page doesn't end the run; it is reported
            out.append((None, None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(out, columns=["title", "body", "error"])


def convert_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds title, body and error (null where the page could be read)."""
    return pages.withColumn("__page", _converted(F.col(html))).select("*", "__page.title", "__page.body", "__page.error").drop("__page")


def page_path_kept(path: Column) -> Column:
    """Whether no folder of the path holds chrome."""
    return ~path.rlike("/(?:" + "|".join(CHROME_FOLDERS) + ")/")


def import_pages(pages: DataFrame, *, path: str = "path", html: str = "html", min_words: int = 10) -> DataFrame:
    """path, status (converted, stub or unparseable), slug (null unless converted), title and body.

    In the order of their paths each page takes its slug, or the slug with the first number from 2 on, that none before it has taken."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    rows = convert_pages(pages.select(path, html).where(page_path_kept(F.col(path))), html)
    status = F.when(F.col("error").isNotNull(), "unparseable").when(whitespace_words(F.col("body")) < min_words, "stub").otherwise("converted")
    rows = rows.select(F.col(path).alias("path"), status.alias("status"), F.when(strip(F.coalesce("title", F.lit(""))) != "", F.col("title")).otherwise(name).alias("title"), "body", name.alias("__stem"))
    own = F.coalesce(F.nullif(slugify(F.col("title")), F.lit("")), F.nullif(slugify(F.col("__stem")), F.lit("")), F.lit("page"))
    rows = stored(rows.select("path", "status", F.when(F.col("status") == "converted", own).alias("own"), "title", "body"))
    return rows.join(distinct_slugs(rows.where("own IS NOT NULL"), "path", "own"), "path", "left").select("path", "status", "slug", "title", "body")


#: a slug that ends in a number, as a repeated slug gets it
NUMBERED = r"^(.+)-([2-9]|[1-9][0-9]+)$"


def distinct_slugs(pages: DataFrame, path: str, own: str) -> DataFrame:
    """path and slug: each page's own slug, or the first of own-2, own-3, ... that no page with a smaller path has taken.

    A slug can only be taken by pages of that own slug or, if it ends in a number, by those of the slug without it. Where no such two slugs
    are there, a page's number is its rank among its slug's pages, and ranks are worked out over ranges, so that a slug that very many pages
    have fills no task. Slugs that can take each other's go by families (what is left without all numbers at the end), each in the order of
    paths, with one number kept for each slug of the family."""
    rows = pages.select(F.col(path).alias("path"), F.col(own).alias("own")).withColumn("family", F.regexp_replace("own", r"(-([2-9]|[1-9][0-9]+))+$", ""))
    slugs = rows.groupBy("own", "family").agg(F.count("*").alias("n"))
    parents = slugs.where("n > 1").select(F.col("own").alias("parent"))
    mixed = slugs.select("family", F.regexp_extract("own", NUMBERED, 1).alias("parent")).join(parents, "parent", "left_semi").select("family").distinct()
    rows = rows.join(mixed.withColumn("mixed", F.lit(True)), "family", "left")
    alone = ranked(rows.where("mixed IS NULL").select("path", "own"), ["own"], "path")
    alone = alone.select("path", F.when(F.col("rank") == 1, F.col("own")).otherwise(F.concat_ws("-", "own", "rank")).alias("slug"))

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family, following = None, {}  # the number that each slug of the family would try next
        for batch in batches:
            names = []
            for group, wanted in zip(batch["family"], batch["own"], strict=True):
                if group != family:
                    family, following = group, {}
                n = following.get(wanted)
                if n is None:
                    found = re.match(NUMBERED, wanted)
                    n = 2 if found and following.get(found[1], 0) > int(found[2]) else 1
                while n > 1 and f"{wanted}-{n}" in following:
                    n += 1
                following[wanted] = max(n + 1, 2)
                names.append(wanted if n == 1 else f"{wanted}-{n}")
            yield pd.DataFrame({"path": batch["path"], "slug": names})

    together = rows.where("mixed").select("family", "path", "own").repartition("family").sortWithinPartitions("family", "path")
    return alone.unionByName(together.mapInPandas(take, "path string, slug string"))
