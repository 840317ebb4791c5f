"""Main text of web pages, by a site style tree.

Pages become trees of block elements. The trees of one host are merged: a node of
the site tree is a path of (tag, classes) from the root, and it gathers over the
host's pages how its children are presented and what texts it holds. Importance
is by entropy, after Yi, Liu and Li's site style tree:

* a node's presentation importance is the entropy of its styles (the sequence of
  its children) over the m pages that have it, to the base m: a part laid out
  alike on every page is template;
* a text's importance is one minus log k / log m, for a text that k of the node's m
  pages hold: 1 for a page's own text, 0 for one that all pages repeat. A node's
  content importance is the mean over its texts, weighted by the pages of each,
  so that a few odd pages do not save a template;
* the composite importance of a node with children mixes its own presentation
  importance with the composite importance of its children, each as often as the
  styles show it: (1 - g^l) own + g^l children, for l styles. A leaf's is that of
  its content.

An importance is believed as far as pages support it: what a node lacks of
importance 1 is scaled by m / (m + ``prior_pages``), so a node on few pages is
never low, without a switch at some number of pages.

A branch is low where its composite importance is below ``threshold`` and no
node in it that at least ``rare`` of its pages hold is above. What lies below the
top of a low branch goes from every page, rare parts included; of the texts in
the top node itself, and anywhere else, those go whose own importance is below
the threshold. This runs over the whole page, before the markup's own words are
looked at. What is left is then settled by these: page furniture (menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader
comments) goes, and where a page marks its article, or its main part, the rest
goes too.

Composite importance needs sums over a node's descendants, and branch removal its
ancestors. A host's merged tree has a row for each path, not for each page; up to
``host_nodes`` rows it is judged in one task, level by level. Larger trees are judged
by joins, with pointer jumping over the nodes' parents: the number of rounds is
the logarithm of the depth, so elements nested by the thousand cost a dozen rounds.
Both ways give the same. Pages of a host with the same main text count once, so a
mirrored article is not taken for template. All statistics are partial
aggregates keyed by host and node; what goes is matched back to the blocks by
(host, node) and (host, node, text), never as a list per host.

Null or empty html gives an empty text. A null url is a host of its own. Broken
markup is read as far as it goes; pages of any length are read whole. Rows are
independent but for the host's statistics; repeated rows and ids are harmless. An
empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, whole
from stellate.operators.broadcast import broadcast_if_small

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(
    "head script style noscript template iframe svg canvas object audio video map select button textarea dialog".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp".split())
FURNITURE = frozenset("nav footer aside form menu fieldset".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table caption tbody tfoot "
    "thead tr ul head".split()
)
# names in class, id or role that tell of furniture
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead banner header topbar footer bottom sidebar aside "
    "complementary contentinfo widget widgets related recommended recommendations recirc promo promotion ad ads adv "
    "advert adverts advertisement advertising adsense sponsor sponsored sponsors cookie cookies consent gdpr notice "
    "popup modal overlay dialog alert newsletter subscribe subscription signup login social share sharing sharebar "
    "comment comments commentlist disqus respond reply replies pagination pager toolbar search skip outbrain taboola".split()
)
# of these, names that an article's own parts carry as well
OWN_PARTS = frozenset("header banner masthead topbar bottom search widget widgets".split())
# words that such names are combined with; inside an article a name with any other word (share-price) tells nothing
GENERIC = frozenset(
    "site page main post entry article user reader box bar list links link wrap wrapper container block area section "
    "inner outer buttons button icons icon tools items item panel group form posts stories articles top bottom left right".split()
)
KEPT_WHOLE = frozenset("html body main article".split())
P_ENDS = BLOCKS - {"tr", "tbody", "thead", "tfoot", "caption"}
# an element of the first kind is ended by the opening of one of these
SIBLINGS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "p": P_ENDS,
}
LIST_ROOTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "p": ("td", "th", "button")}

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

NODES = "array<struct<node:bigint,parent:bigint,depth:int,style:bigint,share:double,text:double,kids:boolean>>"
TEXTS = "array<struct<node:bigint,content:bigint>>"


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.25  # importance below which a branch or a text goes
    prior_pages: float = 2.5  # pages' worth of belief that a part is important
    damping: float = 0.9  # g: how much of a node with one style is its children
    rare: float = 0.1  # share of a branch's pages below which an important part in it does not save it
    host_nodes: int = 200_000  # nodes of a host's tree that one task may judge; larger trees are judged by joins
    marks: bool = True  # look at article marks and names of furniture as well


class Node:
    __slots__ = ("tag", "sign", "parent", "role", "texts", "children", "path", "style")

    def __init__(self, tag: str, sign: str, parent: Node | None, role: str):
        self.tag, self.sign, self.parent, self.role = tag, sign, parent, role
        self.texts: list[str] = []
        self.children: list = []


def _role(tag: str, attrs: str, inside: str) -> tuple[str, str]:
    """(signature, role) of an element: role is 'out', 'article', 'main' or ''."""
    sign = tag
    names: set[str] = set()
    within = inside in ("article", "main")
    if attrs and not attrs.isspace():
        for key, value in ATTR.findall(attrs):
            key = key.lower()
            value = value.strip("\"'")
            if key in ("class", "id", "role"):
                for word in value.split():
                    parts = {p.lower() for p in NAME_PARTS.findall(word)}
                    if not within or parts <= NAMES | GENERIC:
                        names |= parts
                if key == "class":
                    sign = f"{tag}.{'.'.join(sorted(value.split()))}"
                if key == "role" and value == "main":
                    return sign, "main"
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                return sign, "out"
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return sign, "out"
    if tag in HIDDEN or tag in FURNITURE:
        return sign, "out"
    if tag == "header" and not within:
        return sign, "out"
    telling = NAMES - OWN_PARTS if within else NAMES
    if names & telling and tag not in KEPT_WHOLE:
        return sign, "maybe"  # unless it holds the article
    if tag == "article":
        return sign, "maybe" if names & NAMES - {"header", "search", "widget"} else "article"
    return sign, "main" if tag == "main" else ""


def parse(text: str) -> Node:
    """The page's tree of block elements; text hangs in ``children`` as strings."""
    root = Node("", "", None, "")
    here = root
    region = [""]
    pos, size = 0, len(text)
    while pos < size:
        m = TAG.search(text, pos)
        if m is None:
            here.children.append(text[pos:])
            break
        if m.start() > pos:
            here.children.append(text[pos : m.start()])
        pos = m.end()
        cdata, closing, tag, attrs = m.groups()
        if tag is None:
            if cdata:
                here.children.append(cdata.replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCKS or tag in HIDDEN:
                up = here
                while up is not None and up.tag != tag:
                    up = up.parent
                if up is not None and up.parent is not None:
                    while here is not up:
                        here = here.parent
                        region.pop()
                    here = up.parent
                    region.pop()
            elif here.tag == tag and here.sign != tag:
                here = here.parent
                region.pop()
            elif tag in ("td", "th"):
                here.children.append(" ")
            continue
        if tag == "br" or tag in ("td", "th"):
            here.children.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, pos)
            pos = end.end() if end else size
            continue
        sign, role = _role(tag, attrs, region[-1])
        if tag not in BLOCKS and tag not in HIDDEN:
            if role not in ("out", "maybe") or attrs.rstrip().endswith("/"):
                continue  # inline: its text is its block's
        for kind, ends in SIBLINGS.items():
            if tag in ends:
                up, depth = here, 0
                while up is not None and up.tag != kind and up.tag not in LIST_ROOTS[kind] and up.tag not in KEPT_WHOLE:
                    if kind == "p" and up.tag in BLOCKS:
                        break
                    up, depth = up.parent, depth + 1
                if up is not None and up.tag == kind:
                    here = up.parent
                    del region[len(region) - depth - 1 :]
        node = Node(tag, sign, here, role)
        here.children.append(node)
        if tag == "hr" or attrs.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        here = node
        region.append("article" if role == "article" else role if role == "main" else region[-1])
    return root


def _holds(node: Node, roles: tuple[str, ...]) -> bool:
    stack = [c for c in node.children if type(c) is Node]
    while stack:
        n = stack.pop()
        if n.role in roles:
            return True
        stack += [c for c in n.children if type(c) is Node]
    return False


def _regions(root: Node) -> list[Node]:
    """The parts that hold the main text: articles, else main parts, else the whole page."""
    for role in ("article", "main"):
        found, stack = [], [root]
        while stack:
            n = stack.pop()
            if n.role == "out" or n.role == "maybe" and not _holds(n, ("article", "main")):
                continue
            if n.role == role:
                found.append(n)
                continue
            stack += [c for c in reversed(n.children) if type(c) is Node]
        if found:
            return found
    return [root]


def _name(*parts) -> int:
    import xxhash

    n = xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >> 63 else n


def _content(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


class _Walk:
    """The blocks of parts of a page, in page order, and what the site tree counts of its elements."""

    def __init__(self, marks: bool):
        self.marks = marks
        self.blocks: list[tuple[int, str]] = []
        self.seen: dict[int, list] = {}  # node: parent, depth, styles, children, texts, times

    def _skipped(self, node: Node) -> bool:
        if node.tag in HIDDEN:
            return True
        if self.marks or node.tag not in BLOCKS:  # a named inline element is no block: its text never counts
            return node.role == "out" or node.role == "maybe" and not _holds(node, ("article", "main"))
        return False

    def part(self, region: Node) -> None:
        signs, up = [], region
        while up is not None:
            signs.append(up.sign)
            up = up.parent
        start = 0
        for sign in reversed(signs):
            start = _name(start, sign)
        at: list[int] = []
        inline: list[str] = []

        def end_block() -> None:
            if inline:
                line = " ".join(entities.unescape("".join(inline)).split())
                if line:
                    self.blocks.append((at[-1], line))
                    self.seen[at[-1]][4] += 1
                inline.clear()

        # an explicit stack: broken pages may nest thousands of elements
        work: list = [(region, start, 0, 0)]
        while work:
            node, key, parent, depth = work.pop()
            if node is None:  # the end of an element
                if key:
                    end_block()
                at.pop()
                continue
            if type(node) is str:
                inline.append(node)
                continue
            block = node.tag in BLOCKS or not node.tag
            if node is not region and self._skipped(node):
                if block:
                    end_block()
                continue
            if block:
                end_block()
            kids = [c for c in node.children if type(c) is Node and not self._skipped(c)]
            found = self.seen.setdefault(key, [parent, depth, set(), 0, 0, 0])
            found[2].add(tuple(c.sign for c in kids))
            found[3] += len(kids)
            found[5] += 1
            at.append(key)
            work.append((None, block, 0, 0))
            for c in reversed(node.children):
                work.append((c, _name(key, c.sign), key, depth + 1) if type(c) is Node else (c, 0, 0, 0))
        end_block()

    def elements(self) -> list[dict]:
        """A row for each node of the page."""
        out = []
        for node, (parent, depth, styles, kids, texts, times) in self.seen.items():
            over = self.seen.get(parent)
            out.append({
                "node": node, "parent": parent if over else None, "depth": depth, "style": _name(*sorted(styles)),
                "share": times / (over[3] + over[4]) if over else 0.0, "text": texts / max(kids + texts, 1), "kids": kids > 0,
            })
        return out


def blocks(root: Node, marks: bool) -> list[tuple[int, str]]:
    """(node, text) of each block of the page's main part, in page order."""
    walk = _Walk(marks)
    for region in _regions(root) if marks else [root]:
        walk.part(region)
    return walk.blocks


def _seen_udf(s: Settings):
    @F.arrow_udf(f"struct<page:bigint,nodes:{NODES},texts:{TEXTS}>")
    def seen(pages):
        import pyarrow as pa

        rows = []
        for p in pages:
            root = parse(p.as_py())
            site = _Walk(False)
            site.part(root)
            main = _name(*(t for _, t in blocks(root, s.marks)))
            texts = {(n, _content(t)) for n, t in site.blocks}
            rows.append({"page": main, "nodes": site.elements(), "texts": [{"node": n, "content": c} for n, c in texts]})
        kinds = pa.struct([
            ("page", pa.int64()),
            ("nodes", pa.list_(pa.struct([
                ("node", pa.int64()), ("parent", pa.int64()), ("depth", pa.int32()), ("style", pa.int64()),
                ("share", pa.float64()), ("text", pa.float64()), ("kids", pa.bool_())]))),
            ("texts", pa.list_(pa.struct([("node", pa.int64()), ("content", pa.int64())]))),
        ])
        return pa.array(rows, kinds)

    return seen


def _text_udf(s: Settings):
    @F.arrow_udf("string")
    def text(pages, low):
        import pyarrow as pa

        out = []
        for p, gone in zip(pages, low, strict=True):
            drop = frozenset(gone.as_py() or ())
            found = blocks(parse(p.as_py()), s.marks)
            out.append("\n".join(t for n, t in found if not drop or n ^ _content(t) not in drop).encode("utf-8", "replace").decode())
        return pa.array(out, pa.string())

    return text


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _lack(k: Column, m: Column, s: Settings) -> Column:
    """What is missing of importance 1: log k / log m, as far as m pages support it."""
    return F.when(m > 1, F.log(k) / F.log(m) * m / (m + s.prior_pages)).otherwise(0.0)


def site_tree(seen: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(nodes, contents) of the hosts' merged trees.

    ``seen`` has host, page, nodes and texts. Nodes: host, node, parent, depth,
    m, styles, own (the part of the composite importance that is the node's
    own) and weight (with which the node counts in its parent's). Contents:
    host, node, content, importance.
    """
    keys = ["host", "node"]
    pages = seen.select("host", "page", F.explode("nodes").alias("n")).select("host", "page", "n.*")
    held = pages.groupBy(*keys, "page").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("style").alias("style"),
        F.avg("share").alias("share"), F.avg("text").alias("text"), F.max("kids").alias("kids"),
    )
    # copies of one main text are one page
    styles = held.groupBy(*keys, "style").agg(
        F.count(F.lit(1)).cast("double").alias("k"), F.min("parent").alias("parent"), F.min("depth").alias("depth"),
        F.sum("share").alias("share"), F.sum("text").alias("text"), F.max("kids").alias("kids"),
    )
    k = F.col("k")
    nodes = styles.groupBy(*keys).agg(
        F.sum(k).alias("m"), F.count(F.lit(1)).alias("styles"), F.sum(k * F.log(k)).alias("klogk"), F.min("parent").alias("parent"),
        F.min("depth").alias("depth"), F.sum("share").alias("share"), F.sum("text").alias("text"), F.max("kids").alias("kids"),
    )
    nodes = freeze(nodes, "nodes")
    texts = seen.select("host", "page", F.explode("texts").alias("t")).select("host", "page", "t.*").distinct()
    counted = texts.groupBy(*keys, "content").agg(F.count(F.lit(1)).cast("double").alias("k"))
    m = F.col("m")
    contents = counted.join(nodes.select(*keys, "m"), keys).withColumn("importance", 1 - _lack(k, m, s))
    contents = freeze(contents.select(*keys, "content", "k", "importance"), "contents")
    content = contents.groupBy(*keys).agg((F.sum(k * F.col("importance")) / F.sum(k)).alias("content"))
    # the entropy of the styles to the base m is 1 - sum(k log k) / (m log m)
    layout = 1 - F.when(m > 1, F.col("klogk") / (m * F.log(m)) * m / (m + s.prior_pages)).otherwise(0.0)
    damped = F.pow(F.lit(s.damping), F.col("styles"))
    content_part = F.coalesce("content", F.lit(0.0))
    own = F.when(F.col("kids"), (1 - damped) * layout + damped * F.col("text") / m * content_part)
    own = own.otherwise(F.coalesce("content", F.lit(1.0)))
    above = nodes.select("host", F.col("node").alias("parent"), (damped / m).alias("factor"))
    tree = nodes.join(content, keys, "left").join(above, ["host", "parent"], "left").select(
        *keys, "parent", "depth", "m", own.alias("own"), F.coalesce(F.col("factor") * F.col("share"), F.lit(0.0)).alias("weight")
    )
    return freeze(tree, "tree"), contents


def _jumps(tree: DataFrame) -> list[DataFrame]:
    """For each power of two below the depth: host, node, its ancestor so far above, and the product of the weights to it."""
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    out = [tree.where(F.col("parent").isNotNull()).select("host", "node", F.col("parent").alias("up"), "weight")]
    while 1 << len(out) <= deepest:
        far = out[-1].select("host", F.col("node").alias("up"), F.col("up").alias("far"), F.col("weight").alias("rest"))
        further = out[-1].join(far, ["host", "up"])
        out.append(freeze(further.select("host", "node", F.col("far").alias("up"), (F.col("weight") * F.col("rest")).alias("weight")), "jump"))
    return out


def _from_below(values: DataFrame, jumps: list[DataFrame], gather) -> DataFrame:
    """``values`` (host, node, value) gathered over each node and its descendants; ``gather`` is sum or max of value x weight."""
    for jump in jumps:
        lifted = jump.join(values, ["host", "node"]).groupBy("host", F.col("up").alias("node")).agg(gather(F.col("value"), F.col("weight")).alias("more"))
        both = values.join(lifted, ["host", "node"], "left")
        total = F.col("value") + F.col("more") if gather is _sum else F.greatest("value", "more")
        values = freeze(both.select("host", "node", F.coalesce(total, "value").alias("value")), "below")
    return values


def _sum(value: Column, weight: Column) -> Column:
    return F.sum(value * weight)


def _max(value: Column, weight: Column) -> Column:
    return F.max(value)


def _judged_by_joins(tree: DataFrame, s: Settings) -> DataFrame:
    """host, node of all that lies below the top of a low branch, for trees of any size."""
    jumps = _jumps(tree)
    composite = _from_below(tree.select("host", "node", F.col("own").alias("value")), jumps, _sum)
    judged = tree.select("host", "node", "m").join(composite, ["host", "node"])
    judged = freeze(judged.withColumnRenamed("value", "importance"), "importance")
    telling = judged.select("host", "node", F.when(F.col("importance") >= s.threshold, F.col("m")).otherwise(0.0).alias("value"))
    most = _from_below(telling, jumps, _max).withColumnRenamed("value", "most")
    low = judged.join(most, ["host", "node"]).where((F.col("importance") < s.threshold) & (F.col("most") < s.rare * F.col("m")))
    # nodes with a low one among their ancestors: those so many steps above, doubled
    below = freeze(low.select("host", F.col("node").alias("up")), "low")
    for jump in jumps:
        reached = jump.join(below, ["host", "up"], "left_semi").select("host", F.col("node").alias("up"))
        below = freeze(below.unionByName(reached).distinct(), "branch")
    parents = below.select("host", F.col("up").alias("parent"))
    return tree.select("host", "node", "parent").join(parents, ["host", "parent"], "left_semi").select("host", "node")


def _judge(s: Settings):
    """The same for the tree of one host, in one task."""

    def judge(table):
        import pyarrow as pa

        nodes, parents, depths, m, own, weight = (table.column(c).to_pylist() for c in ("node", "parent", "depth", "m", "own", "weight"))
        at = {n: i for i, n in enumerate(nodes)}
        up = [at.get(p) if p is not None else None for p in parents]
        deepest_first = sorted(range(len(nodes)), key=lambda i: (-depths[i], nodes[i]))
        value = list(own)
        for i in deepest_first:
            if up[i] is not None:
                value[up[i]] += weight[i] * value[i]
        most = [k if v >= s.threshold else 0.0 for k, v in zip(m, value, strict=True)]
        for i in deepest_first:
            if up[i] is not None:
                most[up[i]] = max(most[up[i]], most[i])
        low = [v < s.threshold and most[i] < s.rare * m[i] for i, v in enumerate(value)]
        for i in reversed(deepest_first):
            if up[i] is not None and low[up[i]]:
                low[i] = True
        below = [i for i in range(len(nodes)) if up[i] is not None and low[up[i]]]
        host = table.column("host")[0].as_py() if table.num_rows else ""
        return pa.table({"host": pa.array([host] * len(below), pa.string()), "node": pa.array([nodes[i] for i in below], pa.int64())})

    return judge


def low_branches(tree: DataFrame, s: Settings) -> DataFrame:
    """host, node of all that lies below the top of a low branch."""
    size = tree.groupBy("host").agg(F.count(F.lit(1)).alias("c"))
    large = freeze(size.where(F.col("c") > s.host_nodes).select("host"), "large")
    # hosts of more than host_nodes rows of the tree: few, or small beside it
    small = tree.join(broadcast_if_small(large), "host", "left_anti")
    columns = ("host", "node", "parent", "depth", "m", "own", "weight")
    found = small.select(*columns).groupBy("host").applyInArrow(_judge(s), "host string, node bigint")
    if large.isEmpty():
        return found
    return found.unionByName(_judged_by_joins(freeze(tree.join(large, "host", "left_semi"), "large-trees"), s))


def low_parts(seen: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(branches, contents): host, node of all that lies below the top of a low branch; host, node, content of low texts."""
    tree, contents = site_tree(seen, s)
    return low_branches(tree, s), contents.where(F.col("importance") < s.threshold).select("host", "node", "content")


def dropped(pages: DataFrame, s: Settings) -> DataFrame:
    """(host, key, low): for each page of which something goes, the blocks that go, named by node xor content."""
    seen = pages.select("host", "key", _seen_udf(s)("html").alias("s")).select("host", "key", "s.*")
    seen = freeze(seen, "seen")
    branches, contents = low_parts(seen, s)
    held = seen.select("host", "key", F.explode("texts").alias("t")).select("host", "key", "t.*").distinct()
    gone = held.join(branches, ["host", "node"], "left_semi").unionByName(
        held.join(contents, ["host", "node", "content"], "left_semi")
    )
    # one page's blocks: as long as the page
    return freeze(gone.groupBy("host", "key").agg(F.collect_set(F.col("node").bitwiseXOR(F.col("content"))).alias("low")), "dropped")


def main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", settings: Settings = Settings()
) -> DataFrame:
    """One row per page: page_id, url, text."""
    own = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), whole(html).alias("html"),
        host_of(F.col(url)).alias("host"), content_key(whole(html)).alias("key"),
    )
    joined = own.join(broadcast_if_small(dropped(own, settings)), ["host", "key"], "left")
    return joined.select("page_id", "url", _text_udf(settings)("html", "low").alias("text"))
