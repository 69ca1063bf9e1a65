"""Main text of web pages as the maximum-scoring run of tokens.

A page is read as a sequence of tokens, words and tags. A word's score is the log odds, learnt from labelled
pages, that text in its surroundings is article text; tags score negative. The run of tokens with the
largest sum, found in one linear scan, is the content region, and of its blocks those with positive words are
the text: an advert or a list of comments within the article has negative words and is cut by the same scores.

A block's features are the names of the elements around it, the words of their class, id and role attributes,
whether it is mostly linked, and whether it stands before the page's first heading and outside of the element
that holds that heading (<header> and <hgroup> don't count as such, nor do <body> and <html>). Labelled blocks are those
of a table's pages which mark their article with an <article> or <main> element (neither name is a feature),
and those of `EXAMPLES`, small pages labelled by hand with furniture of many kinds, each of which counts as
`COPIES` pages; the examples also say what inside of the table's articles isn't article text. Each source
gives a feature odds; the most favourable count, of the sources that have it inside if one has. Features with odds of `CUT` at most decide alone: the
worst of them is the score. The other blocks' score is the log odds of their parent element among the
blocks that no such feature explains, so that a list isn't blamed for the menu that it often stands in.

At most about `training_pages` pages are learnt from, chosen by a hash of their id, and of the distinct sets
of features in them the `most_sets` commonest: which elements and attributes occur is what they tell.

Reading a page takes time in proportion to its length, also where tags or quotes aren't closed: a tag without
an end is text, and a quote without an end is none. The worst odds of the elements around a block are handed down
from element to element, however deep they are nested; what is learnt from a labelled block are the features of its
`LEARNT_DEPTH` innermost elements.

Output: character references are decoded, white space within a block becomes one space, blocks are
trimmed, empty ones go, and the rest are joined by two newlines.

Edge cases: a null or empty page, or one without text, has the empty text; without labelled pages in the
table the examples alone count; of runs that score the same the first is taken; text at a page's end behind so many tags that its words don't outweigh them is left out; a very long page is read
whole, in linear time; an empty table has no rows; unclosed and stray tags are tolerated; repeated rows each get a result;
further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import table

#: Elements within a line, elements without content, and elements whose content isn't shown as text of the page.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("script style noscript template textarea title iframe svg math select object audio video canvas".split())
#: What labels a page's content, and the attribute by which the examples take parts of it out.
_CONTENT, _OUT = frozenset(("article", "main")), "data-out"
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_STOP = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in UNSHOWN}
_IN_A, _AHEAD = "in a ", "before the first heading"
LEARNT_DEPTH = 48
#: Elements that hold a heading for the element around them, and those that hold all of a page.
_HEAD, _WHOLE = frozenset(("header", "hgroup")), frozenset(("html", "body"))
#: The largest score of a word, the score of a tag without evidence, and odds from which on a feature decides alone.
LARGEST, PRIOR_TAG, CUT = 4.0, -0.3, -2.0
#: Pages that an example counts as.
COPIES = 10

#: Small pages labelled by hand: what stands in <article> is content, but for what has the attribute data-out.
EXAMPLES = [
    "<body><header><div class=logo>Name</div><nav><ul><li><a>Home</a><li><a>News</a></ul></nav></header><article><h1>Title</h1><p>Text <a>link</a> text.</p><p><a>All linked text</a></p><ul><li>Point one</li><li>Point two</li></ul><ul class='list'><li class=item><a>Linked point</a></li></ul></article><aside class=sidebar><h3>More</h3><p>Other text</p><ul><li><a>Story</a></ul></aside><footer><p>Rights</p></footer></body>",
    "<body><div id=header><p>Name</p></div><div class='menu'><a>One</a><a>Two</a></div><div class=breadcrumbs><a>Home</a></div><div class='page site main wrapper container box'><article><div class='content block text'><h1>Title</h1><p class=byline>By somebody</p><p>Text.</p><blockquote>Words</blockquote><blockquote><p>Words</p></blockquote><pre>code</pre><table><thead><tr><th>head</th></tr></thead><tbody><tr><td>cell</td><td><p>cell</p></td></tr></tbody></table><div class='ad advert' data-out><p>Buy</p></div><p class='advertisement' data-out>Paid for</p><p>More text.</p></div></article></div><div id=footer><p>Rights</p></div></body>",
    "<body><div class='cookie consent banner' role=dialog><p>We use cookies</p><button>Accept</button></div><article><div class='post entry-content body'><h1>Title</h1><h2>Part</h2><p>Text.</p><div><p>Text in a box.</p></div><ol><li><p>Step</p></li></ol><div class='share social' data-out><a>Post it</a></div><div class='related recommended' data-out><h3>See also</h3><p>Story</p><ul><li><a>Story</a></ul></div></div><section id=comments data-out><h3>Comments</h3><ol><li><p>Nice words.</p></li></ol><div class='comment reply'><p>I agree.</p></div><form class=respond><p>Write one</p></form></section></article></body>",
    "<body><nav class='navbar' role=navigation><a>Home</a></nav><form class='search login' role=search><p>Find</p> <button>Go</button></form><article><section class='story'><h1>Title</h1><p>Text.</p><figure><figcaption>What is shown</figcaption></figure><dl><dt>Term</dt><dd>Meaning</dd></dl><details><summary>More</summary>Words</details><aside data-out><p>In brief</p></aside><div class='newsletter subscribe signup' data-out><p>Get our letter</p></div><form data-out><p>Address</p></form><div class='sponsored promo' data-out><p>Buy this</p></div><h4>Part</h4><h5>Part</h5><h6>Part</h6><p>End.</p></section></article><div class='pagination pager'><a>Next</a></div><div class='widget' role=complementary><p>Popular</p></div><div class=copyright role=contentinfo><p>Rights</p></div></body>",
    "<body><div class='alert warning notice' role=alert><p>Please note</p></div><div class='popup modal overlay'><p>Join</p></div><dialog><p>Sign in</p></dialog><article><div><div><h1>Title</h1><div>Text without a paragraph. <a>Link</a></div><div>More of it.</div><h3>Part</h3><p>Text.</p></div></div><footer data-out><p>Filed under</p></footer><header data-out><p>Print</p></header><nav data-out><ul><li><a>Up</a></ul></nav><button data-out>More</button></article><div class='disqus discussion'><h4>Readers say</h4><p>First!</p></div><div class='tags meta'><a>tag</a></div></body>",
    "<body><table><tr><td class=menu><a>Home</a></td><td><article><h1>Title</h1><p>Text.</p><div>Text.</div></article></td></tr></table></body>",
    "<article>Words alone, without any markup.</article>",
    "<article><p>A paragraph alone.</p><div>And a box.</div></article>",
]


@dataclass
class Block:
    """A block of text: the number of the element around it, that element's name as a feature, and its text."""

    around: int
    at: str
    parts: list[str]
    inside: bool
    words: int = 0
    linked: int = 0
    ahead: bool = False

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())

    def own_features(self) -> list[str]:
        """Features that don't come from the elements around it."""
        return [self.at, *["linked"] * (2 * self.linked > self.words), *[_AHEAD] * self.ahead]


def tags(source: str) -> Iterator[tuple[str, str, str]]:
    """(text before, tag name with / if it ends an element, attributes) of each tag; the last one's name is empty. Takes linear time."""
    at, begin, n, quotes = 0, 0, len(source), True
    last_end = source.rfind(">")
    while (at := source.find("<", at)) >= 0 and at < last_end:
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = n if end < 0 else end + 3
            yield source[begin:at], "!", ""
            at = begin = end
            continue
        if source[at + 1] in "!?":
            yield source[begin:at], "!", ""
            at = begin = source.find(">", at) + 1
            continue
        name = _NAME.match(source, at + 1)
        if not name:
            at += 1
            continue
        end = name.end()
        while stop := _STOP.search(source, end):
            if stop[0] == ">":
                break
            closed = source.find(stop[0][-1], stop.end()) if quotes else -1
            end = closed + 1 if closed >= 0 else stop.end()
        if not stop:  # all further ends lie within quotes: from here on, quotes don't count
            quotes = False
            continue
        yield source[begin:at], name[0].lower(), source[name.end() : stop.start()]
        at = begin = stop.end()
        if (own := name[0].lower()) in UNSHOWN:
            found = _END[own].search(source, at)
            at = begin = found.start() if found else n
    yield source[begin:], "", ""


def _marks(attributes: str) -> tuple[list[str], bool]:
    """Words of class, id and role, and whether the element is out of the examples' content."""
    marks, out = [], False
    for name, *values in _ATTRIBUTE.findall(attributes):
        if (name := name.lower()) in ("class", "id", "role"):
            marks += [m.lower().removesuffix("s") if len(m) > 2 else m.lower() for m in _MARK.findall("".join(values))]
        out = out or name == _OUT
    return marks, out


class Page:
    """A page's blocks of text, its elements as (number of the one around, features), and its tokens: (tag name, None, inside) or ("", block, inside)."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.tokens: list[tuple[str, Block | None, bool]] = []
        self.elements: list[tuple[int, tuple[str, ...]]] = [(0, ())]
        self.labelled = False
        # an entry: name, its number, the blocks before it, and what was counted of content and outs
        stack: list[tuple[str, int, int, bool, bool]] = []
        open_names: Counter = Counter()
        content = outs = 0
        fresh, linked, headed = True, False, False
        def close() -> None:
            nonlocal content, outs
            name, _, _, is_content, is_out = stack.pop()
            open_names[name] -= 1
            content -= is_content
            outs -= is_out

        for text, name, attributes in tags(source):
            if text:
                words = len(text.split())
                if words or not fresh:
                    if fresh:
                        at = "alone" if not stack else "at div" if stack[-1][0] in _CONTENT else f"at {stack[-1][0]}"
                        self.blocks.append(Block(stack[-1][1] if stack else 0, at, [], content > 0 and not outs))
                        fresh = False
                    block = self.blocks[-1]
                    block.parts.append(text)
                    if words:
                        block.words += words
                        block.linked += words * linked
                        self.tokens.append(("", block, block.inside))
            own = name.removeprefix("/")
            if not own or own == "!" or own in UNSHOWN:
                fresh = fresh or own in UNSHOWN
                continue
            if own == "br":
                if not fresh:
                    self.blocks[-1].parts.append(" ")
                continue
            if own in INLINE:
                linked = name == "a" if own == "a" else linked
                continue
            fresh = True
            ends = name[0] == "/"
            if ends:
                linked = False
                if open_names[own]:
                    while stack[-1][0] != own:
                        close()
                    close()
            elif stack and stack[-1][0] == "p":  # a block ends an open paragraph
                close()
            if own not in _CONTENT:
                self.tokens.append((name, None, content > 0 and not outs))
            if not ends and own not in VOID:
                marks, out = _marks(attributes) if attributes else ((), False)
                is_content = own in _CONTENT
                self.labelled = self.labelled or is_content
                if own == "h1" and not headed:
                    headed = True
                    holders = (entry for entry in reversed(stack) if entry[0] not in _HEAD)
                    holder = next(holders, None)
                    for block in self.blocks[: holder[2] if holder and holder[0] not in _WHOLE else None]:
                        block.ahead = True
                self.elements.append((stack[-1][1] if stack else 0, () if is_content or own in _WHOLE else (f"in {own}", *(_IN_A + m for m in marks))))
                stack.append((own, len(self.elements) - 1, len(self.blocks), is_content, out))
                open_names[own] += 1
                content += is_content
                outs += out

    def features(self, block: Block) -> tuple[str, ...]:
        """What is learnt from a block: its features and those of the innermost elements around it."""
        found, k = set(block.own_features()), block.around
        for _ in range(LEARNT_DEPTH):
            found.update(self.elements[k][1])
            k = self.elements[k][0]
        return tuple(sorted(found))

    def text(self, weights: Weights) -> str:
        """The blocks with positive words of the best run of tokens. Where nothing is left, as if the only heading came after the text, headings don't count."""
        return self._best(weights) or self._best(Weights({f: x for f, x in weights.cuts.items() if f != _AHEAD}, weights.parents, weights.other, weights.tags))

    def _best(self, weights: Weights) -> str:
        best, run, begin, found = 0.0, 0.0, 0, (0, 0)
        score, handed = {}, weights.handed_down(self)
        for k, (name, block, _) in enumerate(self.tokens):
            if block is None:
                run += weights.tags.get(name, PRIOR_TAG)
            else:
                if id(block) not in score:
                    score[id(block)] = weights.score(block, handed)
                run += score[id(block)] * block.words
            if run <= 0:
                run, begin = 0.0, k + 1
            elif run > best:
                best, found = run, (begin, k + 1)
        chosen = {id(block): block for _, block, _ in self.tokens[found[0] : found[1]] if block is not None and score[id(block)] > 0}
        return "\n\n".join(x for b in chosen.values() if (x := b.text()))


@dataclass
class Weights:
    """What is learnt: log odds of features that decide alone, of parent elements, of other blocks, and scores of tags."""

    cuts: dict[str, float]
    parents: dict[str, float]
    other: float
    tags: dict[str, float]

    def handed_down(self, page: Page) -> list[float]:
        """Of each element the worst odds that decide alone, its own or of one around it; 0 for none."""
        worst = [0.0]
        for around, features in page.elements[1:]:
            worst.append(min((self.cuts[f] for f in features if f in self.cuts), default=0.0))
            worst[-1] = min(worst[-1], worst[around])
        return worst

    def score(self, block: Block, handed: list[float]) -> float:
        """The score of each of a block's words."""
        worst = min([self.cuts.get(f, 0.0) for f in block.own_features()] + [handed[block.around]])
        return worst if worst < 0 else self.parents.get(block.at, self.other)


#: (features, inside) by number of blocks, and (tag name, inside) by number of tags.
Counts = tuple[dict[tuple[tuple[str, ...], bool], int], dict[tuple[str, bool], int]]


def counted(pages: list[Page], first: Weights | None = None) -> Counts:
    """Blocks and tags of labelled pages; `first` says which blocks inside of a page's content aren't of it."""
    blocks: Counter = Counter()
    names: Counter = Counter()
    for page in pages:
        if page.labelled:
            handed = first.handed_down(page) if first else []
            for block in page.blocks:
                if block.words:
                    blocks[page.features(block), block.inside and not (first and first.score(block, handed) < 0)] += 1
            names.update((name, inside) for name, block, inside in page.tokens if block is None)
    return dict(blocks), dict(names)


def _odds(inside: int, outside: int, all_inside: int, all_outside: int) -> float:
    return max(-LARGEST, min(LARGEST, log((inside + 1) / (outside + 1)) - log((all_inside + 1) / (all_outside + 1))))


def fit(sources: list[Counts]) -> Weights:
    """Weights from labelled blocks and tags of some sources."""
    sources = [s for s in sources if s[0]]

    def best(counts: list[dict], keys) -> dict:
        """The odds of each key: the most favourable of sources which have it inside; if none has, the least. keys: what an entry counts for."""
        held: dict = {}
        for blocks in counts:
            seen, totals = Counter(), Counter()
            for (what, inside), n in blocks.items():
                totals[inside] += n
                seen.update({(key, inside): n for key in keys(what)})
            for key in {key for key, _ in seen}:
                odds = _odds(seen[key, True], seen[key, False], totals[True], totals[False])
                held.setdefault(key, []).append((odds, seen[key, True] > 0))
        return {key: max((x for x, within in found if within), default=min(x for x, _ in found)) for key, found in held.items()}

    cuts = {f: x for f, x in best([blocks for blocks, _ in sources], lambda features: features).items() if x <= CUT and not _is_parent(f)}
    unexplained = [{k: n for k, n in blocks.items() if not cuts.keys() & set(k[0])} for blocks, _ in sources]
    parents = best(unexplained, lambda features: [f for f in features if _is_parent(f)])
    # without a known parent a block counts as content; its odds are those of standing inside
    totals: Counter = Counter()
    for blocks in unexplained:
        for (_, inside), n in blocks.items():
            totals[inside] += n
    other = max(0.5, _odds(totals[True], totals[False], 0, 0))
    # a quarter of a tag's log odds of standing inside, and never above 0
    tags_ = {t: min(-0.05, x / 4 - 0.05) for t, x in best([names for _, names in sources], lambda name: [name]).items()}
    return Weights(cuts, {f: x + other for f, x in parents.items()}, other, tags_)


def _is_parent(feature: str) -> bool:
    return feature == "alone" or feature.startswith("at ")


def examples() -> Counts:
    blocks, names = counted([Page(x) for x in EXAMPLES])
    return {k: n * COPIES for k, n in blocks.items()}, {k: n * COPIES for k, n in names.items()}


def learn(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", training_pages: int = 2000, most_sets: int = 20_000) -> Weights:
    """Weights from the examples and at most about training_pages of the table's pages."""
    own = examples()
    first = fit([own])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, names = counted([Page(x) for x in batch.column(0).to_pylist()], first)
            rows = [(list(f), inside, n) for (f, inside), n in blocks.items()] + [(["", t], inside, n) for (t, inside), n in names.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.string())), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.int64())], ["features", "inside", "n"])

    rows = pages.where(F.col(html).isNotNull()).select(F.xxhash64(page_id).alias("hash"), F.col(html).alias("html"))
    total, shares = pages.count(), 1 << 20
    sample = rows.where(F.pmod("hash", F.lit(shares)) < min(shares, max(1, shares * training_pages // max(total, 1)))).select("html")
    found = sample.mapInArrow(count, "features array<string>, inside boolean, n long").groupBy("features", "inside").agg(F.sum("n").alias("n"))
    found = found.orderBy(F.col("n").desc(), "features", "inside").limit(most_sets).collect()
    blocks = {(tuple(r.features), r.inside): r.n for r in found if r.features[0]}
    names = {(r.features[1], r.inside): r.n for r in found if not r.features[0]}
    return fit([own, (blocks, names)])


def extract(pages: DataFrame, weights: Weights, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([Page(x.as_py() or "").text(weights) for x in batch.column(2)], pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn(pages)).withColumn("n_chars", F.length("text").cast("long"))
