"""Operator 6, main text of web pages by wrapper induction.

Pages become trees of blocks, runs of like siblings counting as one repeated node. For each
of a host's usual layouts, the trees of its different pages are aligned with a reference
page by simple tree matching, and what stands at each aligned node is summed up over all of
them: how many pages have it, how often its text is the reference's, how much text it holds,
how much of that in links, and how its number of blocks varies. From the root on, the
varying slot with most running text is followed; its siblings that hold links, texts that
stay the same, or little text in a number of blocks that never varies, are template and cut.

A page may tell its article itself (``article``, ``main``). What it tells is its article:
the wrapper takes away what lies beside it and nothing of it, and texts that the wrapper
doesn't know but that lie outside go too. Where no page of the layout tells it, texts that
never change are template wherever they stand. What the contract names by kind (menus,
forms, scripts and the like) is left out by kind.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import htmltext as ht
from ledgerloom.llm import shared

#: A text is template where it stands in this share of the different pages that have its node, of at least so many.
CONSTANT, SUPPORT = 0.9, 5
#: A sibling is cut if more of its text is in links than this, or if it has no paragraph of its own and holds less running text than that part of the article's branch.
LINKED, SMALL = 0.5, 0.25
#: Variance of a node's number of blocks, by its mean, up to which the number counts as the same everywhere.
STEADY = 0.1
#: Levels of blocks that are told apart; cells of all alignment tables of a page, beyond which children are paired by kind and rank.
DEPTH, CELLS = 48, 50_000
_NOISE = frozenset("nav footer aside form script style noscript template iframe button select option input textarea svg canvas object dialog head title menu audio video datalist".split())
#: Whole words of class, id or role that mark what isn't the article's.
_NOISE_MARK = re.compile(
    r"(?:^| )(?:(?:(?:site|page|global|top|main|bottom|left|right|primary|secondary)[-_])?(?:header|masthead|nav|navbar|navigation|navigation-menu|nav-?menu|menubar|breadcrumbs?|sidebar|footer)"
    r"|(?:site|page|global|top|main|bottom|left|right|primary|secondary)[-_](?:menu|banner)"
    r"|(?:[a-z0-9]+[-_])?(?:ads?|advert|advertisement)(?:[-_](?:box|slot|unit|banner|container|wrapper))?|adsense|adsbygoogle|sponsor|sponsored|promo|promo-(?:box|banner)"
    r"|(?:cookies?|consent|gdpr)(?:[-_](?:notice|banner|bar|popup|consent|message|overlay))?|popup|modal|newsletter|subscribe|newsletter-signup|disqus|disqus_thread|comments|comments?-(?:list|section|area|form)"
    r"|share-?(?:buttons?|bar|links)|social|social-(?:share|links|media|buttons|icons)|related-(?:posts|articles|links|stories)|recommended|recommendations|hidden|complementary|contentinfo)(?= |$)"
)
#: Words that mark what isn't the article's unless they stand within it, on something that isn't made of links.
_NOISE_BESIDE = re.compile(r"(?:^| )(?:menu|banner|comment)(?= |$)")
#: Elements that marks can't make noise.
_NEVER = frozenset("#root html body article main h1 h2 h3 h4 h5 h6".split())


def _marked(n: ht.Node) -> bool:
    """By its marks; a menu, banner or comment may turn out to be the article's own (``_of_links``)."""
    return bool(n.marks) and (_NOISE_MARK.search(n.marks) or _NOISE_BESIDE.search(n.marks)) is not None


def _own_words(n: ht.Node) -> bool:
    """Within an article: a menu, banner or comment that is running text of the article, not links, a form or what readers said."""
    if n.tag in _NOISE or not n.marks or _NOISE_MARK.search(n.marks) or not _NOISE_BESIDE.search(n.marks):
        return False
    if "comment" in n.marks.split() and n.tag != "p":
        return False
    said = linked = 0
    todo = [(n, False)]
    while todo:
        x, in_link = todo.pop()
        for c in x.children:
            if isinstance(c, str):
                size = len(c.strip())
                said, linked = said + size, linked + size * in_link
            elif c.tag not in _NOISE:
                todo.append((c, in_link or c.tag == "a"))
    return said > 0 and linked <= LINKED * said


def _is_part(n: ht.Node) -> bool:
    return n.tag in ("article", "main") or "main" in n.marks and " main " in f" {n.marks} "


def noise(n: ht.Node) -> bool:
    """Elements that hold no article text by their kind; what an article stands in is none by its marks, nor is a form around it."""
    if n.tag in _NOISE:
        return n.tag != "form" or not n.holds
    return n.tag not in _NEVER and _marked(n) and not n.holds


def _outermost_parts(root: ht.Node) -> list[ht.Node]:
    found, stack = [], [iter(root.children)]
    while stack:
        c = next(stack[-1], None)
        if c is None:
            stack.pop()
        elif not isinstance(c, str) and not noise(c):
            if _is_part(c):
                found.append(c)
            else:
                stack.append(iter(c.children))
    return found


def main_parts(root: ht.Node) -> list[ht.Node]:
    """The outermost ``article`` and ``main`` elements outside of noise in page order, a ``main`` with some inside being replaced by these."""
    found, todo = [], _outermost_parts(root)[::-1]
    while todo:
        n = todo.pop()
        inner = [] if n.tag == "article" else _outermost_parts(n)
        todo += inner[::-1]
        if not inner:
            found.append(n)
    return found


def skip(n: ht.Node) -> bool:
    """Noise, and headers but for those within an article that hold its heading."""
    return noise(n) or n.tag == "header" and not any(isinstance(c, ht.Node) and c.tag in ("h1", "h2") for c in n.children)


def _hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf8", "surrogatepass"), digest_size=6).hexdigest()


_BIT = {t: 1 << i for i, t in enumerate(sorted(ht.BLOCK))}
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th tr ul ol dl table blockquote figcaption".split())


#: Elements that never hold text that is seen.
_UNSEEN = frozenset("script style noscript template head title iframe svg canvas object audio video datalist".split())


class Page:
    """A page's texts in page order and, where it is asked for, its outline: nodes [kind, numbers of own texts, children, kinds of blocks below]."""

    def __init__(self, html: str | None):
        page = ht.parse(html or "", lambda n: _is_part(n) and not _marked(n), _NOISE - {"form"})
        parts = {id(n) for n in main_parts(page)}
        self.bare = not parts
        # inline noise isn't told apart from the text around it, so it goes at once
        said, found = ht.blocks(page, lambda n: n.tag in _UNSEEN or n.tag not in ht.BLOCK and id(n) not in parts and noise(n), lambda n: id(n) in parts)
        inside, noisy = [False] * len(found), [False] * len(found)
        for i, (parent, n) in enumerate(found[1:], 1):
            inside[i] = inside[parent] or id(n) in parts
            header = n.tag == "header" if self.bare else skip(n)  # where no article is told a header is the site's
            noisy[i] = noisy[parent] or (noise(n) or header) and not (inside[parent] and _own_words(n))
        #: Of each text whether it is the article's as far as the page itself tells.
        self.article = [inside[h] and not noisy[h] for h, _, _ in said]
        self.noise = [noisy[h] for h, _, _ in said]
        self.texts, self.links = [t for _, t, _ in said], [n for _, _, n in said]
        self._holders, self._found = [h for h, _, _ in said], found

    @cached_property
    def hashes(self) -> list[str]:
        return [_hash(t) for t in self.texts]

    @cached_property
    def outline(self) -> list:
        found = self._found
        place, depth = [0] * len(found), [0] * len(found)
        kids, own, below = [[] for _ in found], [[] for _ in found], [0] * len(found)
        for i, (parent, _) in enumerate(found[1:], 1):
            up = place[parent]
            if depth[up] < DEPTH:
                place[i], depth[i] = i, depth[up] + 1
                kids[up].append(i)
            else:  # deeper blocks belong to the last node that is told apart
                place[i] = up
        for i in range(len(found) - 1, 0, -1):
            below[found[i][0]] |= below[i] | _BIT.get(found[i][1].tag, 0)
        for t, holder in enumerate(self._holders):
            own[place[holder]].append(t)
        kind = [f"{n.tag} {n.marks}" for _, n in found]

        def build(members: list[int]) -> list:
            runs: list[list[int]] = []
            by: dict[tuple, list[int]] = {}
            for m in members:
                for c in kids[m]:
                    key = (kind[c], below[c])
                    if len(members) > 1:  # the bodies of a repeated node are one
                        if key not in by:
                            by[key] = []
                            runs.append(by[key])
                        by[key].append(c)
                    elif runs and (kind[runs[-1][0]], below[runs[-1][0]]) == key:
                        runs[-1].append(c)
                    else:
                        runs.append([c])
            return [kind[members[0]], [t for m in members for t in own[m]], [build(r) for r in runs], below[members[0]]]

        return build([0])

    @property
    def layout(self) -> str:
        wide = self.outline  # the first node with several children
        while len(wide[2]) == 1:
            wide = wide[2][0]
        return _hash(f"{self.bare} {wide[0]}>{' '.join(c[0] for c in wide[2])}")

    def told(self) -> str:
        """The outline without the page: hash, length, length in links and number of texts, the number being -1 where the page tells the text as its article's."""

        def name(n: list) -> list:
            return [n[0], [[self.hashes[t], len(self.texts[t]), self.links[t], -1 if self.article[t] else t] for t in n[1]], [name(c) for c in n[2]], n[3]]

        return json.dumps(name(self.outline), separators=(",", ":"))

    def sayable(self) -> list[str | None]:
        """Its texts, without those that aren't the article's as far as the page itself tells."""
        return [t if (not noisy if self.bare else told) else None for t, noisy, told in zip(self.texts, self.noise, self.article, strict=True)]


def match(a: list, b: list, cells: list[int] | None = None) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the size of the largest order-preserving match of two trees with like roots, and its pairs.

    Beyond ``CELLS`` cells of all tables children are paired by kind and rank instead.
    """
    cells = [CELLS] if cells is None else cells
    if a[0] != b[0]:
        return 0, []
    m, n = len(a[2]), len(b[2])
    cells[0] -= m * n
    pairs = [(a, b)]
    if cells[0] < 0:
        of, seen, size = defaultdict(list), defaultdict(int), 1
        for c in b[2]:
            of[c[0]].append(c)
        for c in a[2]:
            if seen[c[0]] < len(of[c[0]]):
                w = match(c, of[c[0]][seen[c[0]]], cells)
                size += w[0]
                pairs += w[1]
            seen[c[0]] += 1
        return size, pairs
    best = [[0] * (n + 1) for _ in range(m + 1)]
    inner = {}
    for i in range(m):
        for j in range(n):
            w = inner[i, j] = match(a[2][i], b[2][j], cells)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[0])
    i, j = m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += inner[i, j][1]
    return best[m][n] + 1, pairs


def _paths(reference: list) -> dict[int, str]:
    paths = {}

    def name(n: list, path: str) -> None:
        paths[id(n)] = path
        for i, c in enumerate(n[2]):
            name(c, f"{path}.{i}")

    name(reference, "0")
    return paths


def _aligned(reference: list, outline: list) -> list[tuple[str, list, list]]:
    """(path of the reference node, reference node, the page's node) for matched nodes."""
    paths = _paths(reference)
    return [(paths[id(a)], a, b) for a, b in match(reference, outline)[1]]


def _below(n: list) -> list:
    """All texts below a node."""
    out, todo = [], [n]
    while todo:
        n = todo.pop()
        out += n[1]
        todo += n[2]
    return out


def host_of(url) -> F.Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _outlines(pages: DataFrame) -> DataFrame:
    """host, digest, layout, bare, texts, outline, copies of the different pages of each host: copies count once."""

    def one(html: str | None) -> tuple:
        page = Page(html)  # its tree goes before the next page is read
        return page.layout, page.bare, len(page.texts), page.told()

    def tell(html: pa.Array) -> list:
        return [list(c) for c in zip(*(one(x.as_py()) for x in html), strict=True)] or [[]] * 4

    told = pages.select("host", "digest", bw.told_by(tell, "layout string, bare boolean, texts long, outline string", F.col("html")).alias("told"))
    return told.groupBy("host", "digest").agg(F.first("told").alias("told"), F.count("*").alias("copies")).select("host", "digest", "told.*", "copies")


def _references(outlines: DataFrame) -> DataFrame:
    """host, layout, pages, outline of the reference page, for every layout of a host that SUPPORT different pages have.

    Of a layout's pages the one with most texts (then the greatest digest) is the reference.
    """
    layouts = outlines.groupBy("host", "layout").agg(F.count("*").alias("pages"), F.max(F.struct("texts", "digest", "outline")).alias("first")).filter(F.col("pages") >= SUPPORT)
    return layouts.select("host", "layout", "pages", F.col("first.outline").alias("outline"))


_STATS = "host string, layout string, path string, hash string, chars long, links long, blocks long"


def _statistics(outlines: DataFrame, references: DataFrame) -> DataFrame:
    """host, layout, path, hash, n, chars, links, blocks, squares: summed up over all different pages of a usual layout.

    Without a hash: how many pages have the node, and what stands below it. With a hash: how
    many pages have that text of the reference at the node.
    """

    def count(batches):
        kinds = (pa.string(),) * 4 + (pa.int64(),) * 3
        reference: dict[str, list] = {}
        for b in batches:
            rows = []
            for host, layout, outline, told in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if told not in reference:
                    reference = {told: json.loads(told)}
                for path, ref, own in _aligned(reference[told], json.loads(outline)):
                    below = _below(own)
                    rows.append((host, layout, path, None, sum(t[1] for t in below), sum(t[2] for t in below), len(below)))
                    rows += [(host, layout, path, h, 0, 0, 0) for h in {t[0] for t in ref[1]} & {t[0] for t in own[1]}]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _STATS.split(", ")])

    hot = shared.hot_keys(references, ["host", "layout"], "pages")
    each = shared.salted_join(outlines.select("host", "layout", "digest", "outline"), references.select("host", "layout", F.col("outline").alias("told")), ["host", "layout"], hot, F.col("digest"))
    counted = each.select("host", "layout", "outline", "told").mapInArrow(count, _STATS)
    return counted.groupBy("host", "layout", "path", "hash").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("chars", "links", "blocks")], F.sum(F.col("blocks") * F.col("blocks")).alias("squares"))


def _taken(outlines: DataFrame, wrappers: DataFrame) -> DataFrame:
    """host, digest, taken (of each text whether the wrapper takes it), n_taken of the pages that a wrapper takes texts from.

    A page meets the wrapper of its layout, a bare page of an unusual layout that of the host's most usual one.
    A layout's pages, and a host's layouts, are dealt over salts where they are very many.
    """

    def tell(batches):
        for b in batches:
            read, rows = {}, []
            for host, digest, own, reference, template in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if (reference, template) not in read:
                    read[reference, template] = json.loads(reference), json.loads(template)
                gone = _gone(*read[reference, template], json.loads(own))
                if gone:
                    rows.append((host, digest, [t in gone for t in range(max(gone) + 1)], len(gone)))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = pa.string(), pa.binary(), pa.list_(pa.bool_()), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["host", "digest", "taken", "n_taken"])

    layouts = outlines.groupBy("host", "layout").agg(F.first("bare").alias("bare"), F.count("*").alias("n"))  # a layout tells whether it is bare
    layouts = shared.materialize(layouts.join(wrappers.select("host", "layout", "pages"), ["host", "layout"], "left"), "layouts")
    first = wrappers.groupBy("host").agg(F.min(F.struct(-F.col("pages"), F.col("layout")))["layout"].alias("layout")).join(wrappers, ["host", "layout"]).select("host", "outline", "template")
    rare = layouts.filter("pages IS NULL AND bare").select("host", "layout")
    fewest = shared.materialize(rare.groupBy("host").agg(F.count("*").alias("n")), "rare")
    lent = shared.salted_join(rare, first, ["host"], shared.hot_keys(fewest, ["host"], "n"), F.col("layout"))
    every = wrappers.select("host", "layout", "outline", "template").union(lent.select("host", "layout", "outline", "template")).withColumnRenamed("outline", "reference")
    each = shared.salted_join(outlines.select("host", "layout", "digest", "outline"), every, ["host", "layout"], shared.hot_keys(layouts, ["host", "layout"], "n"), F.col("digest"))
    return each.select("host", "digest", "outline", "reference", "template").mapInArrow(tell, "host string, digest binary, taken array<boolean>, n_taken long")


#: Kinds of blocks that a sibling with words of its own has, however few these are.
_PARAGRAPHS = sum(_BIT[t] for t in "p h1 h2 h3 h4 h5 h6 blockquote pre table dl".split())


def _noise_kind(kind: str) -> bool:
    tag, marks = kind.split(" ", 1)
    return tag in _NOISE or tag not in _NEVER and _NOISE_MARK.search(marks) is not None


def _template(reference: list, at: dict[str, dict], same: dict[tuple[str, str], int]) -> dict:
    """What a layout's pages don't say themselves: paths of nodes to cut, and (path, hash) of texts that never change."""
    paths, cut, constant = _paths(reference), [], []
    told = lambda n: at.get(paths[id(n)], {"n": 0, "chars": 0, "links": 0, "blocks": 0, "squares": 0})
    fixed = lambda n: {t[0] for t in n[1] if told(n)["n"] >= SUPPORT and same.get((paths[id(n)], t[0]), 0) >= CONSTANT * told(n)["n"]}
    todo = [reference]
    while todo:
        n = todo.pop()
        constant += [[paths[id(n)], h] for h in fixed(n)]
        todo += n[2]
    n = reference
    said = lambda c: told(c)["chars"] - told(c)["links"]
    while True:
        best = max([c for c in n[2] if not _noise_kind(c[0])], key=said, default=None)
        if best is None or not best[2] or best[0].split(" ")[0] in _LEAVES:
            break
        for c in n[2]:
            x = told(c)
            if c is best or not x["n"]:
                continue
            mean = x["blocks"] / x["n"]
            steady = x["squares"] / x["n"] - mean * mean <= STEADY * mean
            linked = x["links"] > LINKED * x["chars"]
            small = x["n"] >= SUPPORT and steady and said(c) / x["n"] < SMALL * said(best) / max(told(best)["n"], 1)
            if linked or _noise_kind(c[0]) or small and not c[3] & _PARAGRAPHS and c[0].split(" ")[0] not in _LEAVES:
                cut.append(paths[id(c)])
        n = best
    return {"cut": sorted(cut), "constant": sorted(constant)}


def _wrappers(references: DataFrame, statistics: DataFrame) -> DataFrame:
    """host, layout, pages, outline and template (JSON) of each usual layout."""
    seen = statistics.groupBy("host", "layout").agg(F.collect_list(F.struct("path", "hash", "n", "chars", "links", "blocks", "squares")).alias("seen"))  # nodes and texts of one page

    def tell(batches):
        for b in batches:
            made = []
            for outline, rows in zip(*(b.column(i).to_pylist() for i in (3, 4)), strict=True):
                at = {r["path"]: r for r in rows or () if r["hash"] is None}
                same = {(r["path"], r["hash"]): r["n"] for r in rows or () if r["hash"] is not None}
                made.append(json.dumps(_template(json.loads(outline), at, same)))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(made, pa.string())], names=["host", "layout", "pages", "outline", "template"])

    joined = references.join(seen, ["host", "layout"], "left").select("host", "layout", "pages", "outline", "seen")
    return joined.mapInArrow(tell, "host string, layout string, pages long, outline string, template string")


def extract(pages: DataFrame, induce: bool = True) -> DataFrame:
    """page_id, url, text, n_chars, n_template (texts that the wrapper took away) of every row of ``pages``.

    Blocks are joined by newlines. A null or empty page has an empty text. Pages without a
    host in their URL form one group; repeated rows and ids are read each for itself, but
    exact copies count once in a wrapper; an empty table gives no rows. Very long and very
    deep pages are read whole, in time that grows with their size. Columns other than page_id,
    url and html are not looked at. Without ``induce`` only kinds are judged.
    """
    shared.bounded_batches(pages.sparkSession)
    slim = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"), pages["html"].cast("string").alias("html"), host_of(pages["url"].cast("string")).alias("host"))
    slim = slim.withColumn("digest", F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256)))
    said = slim.select("page_id", "url", "host", "digest", bw.told_by(lambda html: [[Page(x.as_py()).sayable() for x in html]], "said array<string>", F.col("html"))["said"].alias("said"))
    if induce:
        outlines = shared.materialize(_outlines(slim), "outlines")
        references = shared.materialize(_references(outlines), "references")
        wrappers = shared.materialize(_wrappers(references, _statistics(outlines, references)), "wrappers")
        taken = shared.materialize(_taken(outlines, wrappers), "taken")
        said = shared.salted_join(said, taken, ["host", "digest"], shared.hot_keys(outlines, ["host", "digest"], "copies"), F.struct("page_id", "url"), "left")
    else:
        said = said.withColumns({"taken": F.lit(None).cast("array<boolean>"), "n_taken": F.lit(None).cast("long")})
    stays = F.filter("said", lambda text, i: text.isNotNull() & ~F.coalesce(F.get("taken", i), F.lit(False)))
    text = said.select("page_id", "url", F.array_join(stays, "\n").alias("text"), "n_taken")
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.coalesce("n_taken", F.lit(0)).cast("long").alias("n_template"))


def _gone(reference: list, template: dict, outline: list) -> set[int]:
    """Numbers of the texts of an outline that are its wrapper's; of a told article the wrapper takes nothing.

    A page of an unusual layout is aligned with the host's most usual one.
    """
    gone: set[int] = set()
    if template["cut"] or template["constant"]:
        cut, constant = {*template["cut"]}, defaultdict(set)
        for path, h in template["constant"]:
            constant[path].add(h)
        for path, _, own in _aligned(reference, outline):
            gone |= {t[3] for t in _below(own)} if path in cut else {t[3] for t in own[1] if t[0] in constant[path]}
    return gone - {-1}


def _text(html: str | None) -> str:
    """The text of a page of an unknown host."""
    return "\n".join(t for t in Page(html).sayable() if t is not None)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(shared.read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
