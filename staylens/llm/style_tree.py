"""HTML extraction with site style trees.

The pages of one host are merged into a tree: an element node stands for all elements
with the same path of tags, classes and ids, and holds the styles (sequences of child
elements) and the contents that its pages show there. With m pages, a node's
presentation importance is the entropy (base m) of its styles, its content importance
is 1 less the mean entropy of its texts over pages: a text that all pages show has
entropy 1, a text of one page 0. Both are combined as (1 - g^l) * presentation
+ g^l * content, with l styles and g = 0.9. Branches of low importance are the site's
template and are cut from every page. A node that fewer than `FEW` pages show is
kept, and a page that would lose all its text keeps it. Pages of a host with the same
texts are one page to the tree, and a text counts once a page however often it stands
there. Inside a page's own article element only named nodes (below) can be cut: near
copies on one host share a body that is no template. Elsewhere text that all pages of a
host share is taken for its template.

What HTML itself marks as something else than the article counts as importance 0 on
every site: navigation, headers of the page, footers, sidebars, forms, scripts,
styles, hidden elements, and elements whose class, id or role names adverts, notices,
menus or reader comments. Ids of headings and sections are slugs of their text, so one
word of them says nothing, nor does one word of a longer name on an element of text.
Where a page has an article (or main) element with text, the text is taken from there.
Inside it a name counts when all its words are names, and only adverts, subscriptions
and reader comments in a class go at once; any other name halves the importance of its
node, and the tree decides.

A page is parsed once, and only its texts and paths are kept. Site statistics are
combinable aggregates over (host, path), so a host with a third of all pages is
counted in every task; pages meet the cut branches of their host in one join.

Null html is an empty page, a null url a page without a site. Pages of any length are
read whole. Rows that repeat a page are one page of the site's tree, and each gets its
text. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from staylens.llm.store import clear_of, if_small, written

GAMMA, LEAST, FEW = 0.9, 0.2, 5
NAMED = 0.5  # importance of a named node inside an article, as a part of what the tree says

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
NOT_TEXT = frozenset(
    "head script style title noscript template nav footer aside form button select option textarea iframe object "
    "svg canvas math audio video map dialog menu noembed noframes xmp datalist applet".split()
)
LANDMARKS = frozenset(("article", "main"))
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
SCOPES = frozenset(
    "html body article main section div table ul ol dl nav header footer aside form blockquote td th figure".split()
)
# Words in class, id and role that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert comment "
    "comments disqus respond share sharing social related recommended recommendations newsletter subscribe "
    "subscription popup modal overlay masthead footer widget widgets pagination pager toolbar complementary "
    "contentinfo search skip".split()
)
# Names that keep their meaning inside an article, words that only say where
# or in what box something stands, and elements that hold text.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored comment comments disqus respond "
    "newsletter subscribe subscription breadcrumb breadcrumbs pagination".split()
)
ROLES = frozenset("banner complementary contentinfo menu navigation search toolbar".split())
BOXES = frozenset(
    "area bar block body bottom box button buttons container content form group inner item items left links list main "
    "outer page post posts right section site slot top unit user wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | frozenset("p li dt dd td th tr caption blockquote pre figure figcaption".split()) | INLINE
HEADERS = frozenset(("header", "topbar"))
TITLES = frozenset("post article entry content title story".split())
NEGATED = frozenset("no has with without".split())

MARK = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'](?=[^\"'>]*>))*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
PART = re.compile(r"[a-z]+")


def number(*parts) -> int:
    """A 64-bit number for a path, a style or a text."""
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


def all_of(name: str, known: frozenset[str]) -> bool:
    """Whether a class or id consists of words of `known`, besides words for boxes."""
    words = set(PART.findall(name))
    return bool(words & known) and words <= known | BOXES


class Page:
    """The article text of a page by block, with the paths of the elements around it."""

    def __init__(self, source: str):
        self.blocks: list[tuple[list[int], str, bool]] = []
        self.children: dict[int, list[str]] = {}
        self.named: set[int] = set()
        self.stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
        self.pending: list[str] = []
        self.read(source)
        self.flush()

    def flush(self) -> None:
        """Ends a block: white space is one space, blocks without text are none."""
        if self.pending:
            text = " ".join(entities.unescape("".join(self.pending)).split())
            self.pending = []
            if text:
                # paths from the landmark (or the body) inwards; in an article those with a name
                main, article = self.stack[-1][3:]
                inside = [p for _, p, _, m, _ in self.stack if m or not main]
                inside = inside[1 if main else min(3, len(inside)) :]
                self.blocks.append(([p for p in inside if not article or p in self.named], text, main))

    def open(self, tag: str, attributes: str) -> None:
        _, path, muted, main, article = self.stack[-1]
        names, ids, hidden, role = [], [], False, ""
        if attributes and attributes.strip(" /"):
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "id":
                    ids += value.split()
                elif name in ("class", "role"):
                    names += value.split()
                    role = value if name == "role" else role
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    hidden = True
        key = tag + "".join("." + re.sub(r"\d+", "0", n) for n in sorted({*names, *ids}))
        own = number(path, key)
        if not muted:
            muted = hidden or tag in NOT_TEXT or (tag == "header" and not main) or self.other(tag, names, ids, role, main)
            if main and not muted and self.doubtful(tag, names, ids):
                self.named.add(own)
        self.children.setdefault(path, []).append(key)
        landmark = not muted and (main or tag in LANDMARKS or role in LANDMARKS)
        article = landmark and (article or "article" in (tag, role))
        self.stack.append((tag, own, muted, landmark, article))

    @staticmethod
    def other(tag: str, names: list[str], ids: list[str], role: str, main: bool) -> bool:
        """Whether class, id or role name something else than the article."""
        if tag in ("html", "body", "main"):
            return False
        if main or tag == "article":
            return (role in ROLES and tag != "article") or any(all_of(name, FOREIGN) for name in names)
        for name in names + ids:
            slug = tag in TEXTUAL or (tag == "section" and name in ids)
            words = set(PART.findall(name))
            if words & NEGATED or (tag in HEADINGS and name in ids):
                continue
            elif (all_of(name, NAMES) if slug else words & NAMES) or (words & HEADERS and not words & TITLES):
                return True
        return False

    @staticmethod
    def doubtful(tag: str, names: list[str], ids: list[str]) -> bool:
        """Whether an element inside the article has a name that lowers its importance."""
        if tag == "main":
            return False
        return any(all_of(n, NAMES) for n in (names if tag == "section" or tag in HEADINGS else names + ids))

    def close(self, tags: frozenset[str] | set[str], within: frozenset[str] = frozenset()) -> None:
        """Ends the innermost open element of `tags`, not beyond one of `within`."""
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at][0]
            if tag in tags:
                if any(t not in INLINE for t, *_ in self.stack[at:]):
                    self.flush()
                del self.stack[at:]
                return
            if tag in within:
                return

    def read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = MARK.search(source, at)
            stop = found.start() if found else end
            if stop > at and not self.stack[-1][2]:
                self.pending.append(source[at:stop])
            if not found:
                break
            at = found.end()
            closing, tag = found[1], found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if tag in ("p", "br") and not any(t == tag for t, *_ in self.stack):
                    self.flush()
                self.close({tag})
                continue
            if tag not in INLINE and tag not in ("script", "style"):
                self.flush()
                if tag in CLOSES:
                    self.close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select", "nav", "article")))
                self.close({"p"}, SCOPES)
            if tag in VOID:
                continue
            if tag in RAW:
                # raw text ends at its own closing tag, whatever it holds
                raw = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.I).search(source, at)
                at = raw.start() if raw else end
                skip = source.find(">", at)
                at = skip + 1 if raw and skip >= 0 else end
                continue
            if not found[3].endswith("/") or tag in NOT_TEXT or tag not in INLINE:
                self.open(tag, found[3])

    def article(self) -> list[tuple[list[int], str]]:
        """Blocks of the article elements, or of the page if they have no text."""
        main = [(paths, text) for paths, text, inside in self.blocks if inside]
        return main or [(paths, text) for paths, text, _ in self.blocks]

    def nodes(self) -> list[tuple[int, int, float]]:
        """Path, style (children, repeats in a row once) and prior importance of the
        elements around blocks."""
        used = {p for paths, _ in self.article() for p in paths}
        out = []
        for path in used:
            keys = self.children.get(path, [])
            style = number(*[k for i, k in enumerate(keys) if not i or keys[i - 1] != k])
            out.append((path, style, NAMED if path in self.named else 1.0))
        return out


def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.struct([("paths", pa.list_(pa.int64())), ("hash", pa.int64()), ("text", pa.string())])
    node = pa.struct([("path", pa.int64()), ("style", pa.int64()), ("prior", pa.float64())])
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            blocks, nodes = [], []
            for value in part.column(0):
                page = Page(value.as_py() or "")
                found = page.article()
                blocks.append([{"paths": p, "hash": number(t), "text": t} for p, t in found])
                nodes.append([{"path": p, "style": s, "prior": w} for p, s, w in page.nodes()])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(blocks, pa.list_(block)), pa.array(nodes, pa.list_(node))],
                names=[*batch.schema.names[1:], "blocks", "nodes"],
            )


def low_branches(pages: DataFrame, least: float, few: int) -> DataFrame:
    """`host`, `path` of the nodes of each site whose importance is below `least`, for
    pages with (`host`, `nodes`, `blocks`)."""
    # copies of a page have one number, so that each article of a host counts once
    numbered = pages.where("host IS NOT NULL").select(
        "host", F.xxhash64(F.transform("blocks", lambda b: b["hash"])).alias("page"), "nodes", "blocks"
    )
    styles = (
        numbered.select("host", "page", F.explode("nodes").alias("node"))
        .groupBy("host", F.col("node.path").alias("path"), "page")
        .agg(F.min("node.style").alias("style"), F.min("node.prior").alias("prior"))
        .groupBy("host", "path", "style")
        .agg(F.count(F.lit(1)).alias("n"), F.min("prior").alias("prior"))
    )
    shown = styles.groupBy("host", "path").agg(
        F.min("prior").alias("prior"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("kinds"),
        F.sum(F.col("n") * F.log("n")).alias("nlogn"),
    ).where(F.col("m") >= max(2, few))
    presentation = (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")
    texts = (
        numbered.select("host", "page", F.explode("blocks").alias("block"))
        .select("host", "page", F.col("block.hash").alias("hash"), F.explode("block.paths").alias("path"))
        .distinct()
        .groupBy("host", "path", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    same = texts.groupBy("host", "path").agg(F.avg(F.log("n")).alias("logn"))
    content = 1 - F.col("logn") / F.log("m")
    share = F.pow(F.lit(GAMMA), F.col("kinds"))
    return shown.join(same, ["host", "path"]).where(
        F.col("prior") * ((1 - share) * presentation + share * content) < least
    ).select("host", "path")


def main_text(
    pages: DataFrame, html: str = "html", url: str = "url", least: float = LEAST, few: int = FEW
) -> DataFrame:
    """All columns of `pages` but the html, and `text` (the article, blocks joined by a
    space, empty if there is none) and `n_chars`."""
    rest = [c for c in pages.columns if c != html and c not in ("text", "n_chars")]
    names = clear_of(["host", "blocks", "nodes"], *[f"c{i}" for i in range(len(rest))])
    host = F.lower(F.regexp_extract(F.col(url), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    kinds = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in zip(names, rest))
    found = written(
        pages.select(
            F.col(html).alias("html"), F.when(host != "", host).alias("host"),
            *[F.col(f"`{c}`").alias(n) for n, c in zip(names, rest)],
        ).mapInArrow(
            parsed,
            f"host string, {kinds}, blocks array<struct<paths:array<bigint>,hash:bigint,text:string>>, "
            "nodes array<struct<path:bigint,style:bigint,prior:double>>",
        )
    )
    low = written(low_branches(found, least, few))
    cut = low.groupBy("host").agg(F.collect_list("path").alias("_cut"))
    # one row per host, as wide as its cut branches; the count of all of them bounds it
    side = F.broadcast(cut) if low.count() * 64 <= 8 << 20 else cut
    none = F.array().cast("array<bigint>")
    kept = F.filter("blocks", lambda b: ~F.arrays_overlap(b["paths"], F.coalesce("_cut", none)))
    chosen = F.when(F.size(kept) > 0, kept).otherwise(F.col("blocks"))
    text = F.concat_ws(" ", F.transform(chosen, lambda b: b["text"]))
    return (
        found.join(side, "host", "left")
        .withColumn("_text", text)
        .select(*[F.col(n).alias(c) for n, c in zip(names, rest)], F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
    )
