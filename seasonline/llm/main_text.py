"""The main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree. Each is content or not; what an element looks like
gives its own potential, and every parent-child pair has one for its two states. Sum-product messages up
to the root and down again give exact marginals. The weights are those of highest likelihood on labelled
pages, kept near a prior that says what a tag or a class name usually means.

All pages of a batch are one forest, and messages pass a level at a time as array operations.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name, hashed_sample

# Kinds of elements as HTML defines them.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())  # text up to the end tag
_FOREIGN = frozenset(("svg", "math"))
_UNSHOWN = frozenset("desc metadata annotation annotation-xml".split())  # in foreign elements
# Elements that open a block; all others, unknown ones too, stand within a line.
_BLOCKS = frozenset(
    "html head body address article aside blockquote button caption center colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPES = frozenset("ul ol menu dl table div article section main body aside nav form blockquote".split())
_MAIN = frozenset(("article", "main"))
_SIDE = frozenset("nav footer aside header form menu dialog button fieldset select".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = frozenset("p pre blockquote dd figcaption".split())
_LIST = frozenset("ul ol li dl dt table thead tbody tr td th".split())
# Words of class, id and role names that tell boilerplate and content, as pages commonly use them.
_BAD_NAMES = re.compile(
    r"(?i)(?:^|[\W_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|alert|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|login|search\w*|share|sharing|social|nav\w*|menu|breadcrumbs?|sidebar|aside|widget|"
    r"related|recommend\w*|footer|header|masthead|copyright|legal|comments?|replies|reply|respond|disqus|discussion|thread|"
    r"kommentare?|werbung|anzeigen?|seitenleiste|navigation|fusszeile|commentaires?|publicit\w*|barre-laterale|comentarios?|publicidad|anuncios?|"
    r"form|toolbar|pagination|pager|tags?|complementary|contentinfo)(?:$|[\W_])"
)
_GOOD_NAMES = re.compile(
    r"(?i)(?:^|[\W_])(?:article\w*|content|main|post|entry|story|body|text|articlebody|post-body)(?:$|[\W_])"
)
_FEATURES = (
    "bias main_tag side_tag heading prose list bad_name good_name length link_share all_link_share sentences share inside in_main".split()
)
_PRIOR = np.array([-0.5, 2.0, -4.0, 0.3, 0.6, -0.2, -4.0, 1.5, 0.5, -1.5, -1.0, 0.5, 0.5, -6.0, 4.0])
_PRIOR_PAIRS = np.array([[1.0, -0.5], [-1.0, 1.5]])  # [parent, child]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.DOTALL
)
_OPEN_VALUE = re.compile(r"=\s*[^\s\"']+\Z")  # a slash at the end of a value without quotes closes nothing
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


@dataclass
class Page:
    """The block elements of a page in page order, and its text by runs between block borders."""

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: ["#page"])
    names: list[str] = field(default_factory=lambda: [""])
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, characters in links


def parse(source: str) -> Page:
    """Read a page as browsers mostly do: unclosed and stray tags are put up with, nothing is dropped but
    what is never shown (scripts, styles, templates, the title in the head and the like). Only such text runs on
    to its end tag, and not from an element that closes itself."""
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]  # inline elements carry their block's number
    links, texts, linked, at, raw_end = 0, [], 0, 0, None
    foreign = hidden = choices = 0  # open drawings and formulas, open templates, open lists of choices

    def flush() -> None:
        nonlocal linked
        if texts:
            run = " ".join("".join(texts).split())
            if run:
                page.runs.append((stack[-1][1], run, min(linked, len(run))))
            texts.clear()
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal links, foreign, hidden, choices
        for name, _ in stack[depth:]:
            links -= name == "a"
            foreign -= name in _FOREIGN
            hidden -= name == "template"
            choices -= name == "select"
        if any(name in _BLOCKS for name, _ in stack[depth:]):
            flush()
        del stack[depth:]

    def add_text(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            texts.append(text)
            if links > 0:
                linked += len(text.strip())

    for token in _TOKEN.finditer(source):
        if raw_end is not None:
            if token.start() < raw_end:
                continue
            raw_end = None
        add_text(source[at : token.start()])
        at = token.end()
        closing, name, rest = token.group(1), (token.group(2) or "").lower(), token.group(3) or ""
        if not name:
            continue
        if closing:
            # An inline end tag stays within its block; a block's end tag closes all that is open in it.
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close_to(depth)
                    break
                if name not in _BLOCKS and stack[depth][0] in _BLOCKS:
                    break
            continue
        empty = rest.endswith("/") and not _OPEN_VALUE.search(rest)
        block = name in _CLOSES_P or name in _SIBLINGS or name in _SCOPES
        if empty and (name in _RAW or name in ("template", "select") or name in _UNSHOWN and foreign):
            continue
        if name in _RAW or name in _UNSHOWN and foreign:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(source, at)
            if end or name in _RAW:
                at = raw_end = end.end() if end else len(source)
            continue
        if choices and (block and name not in ("option", "hr") or name == "select"):
            for depth in range(len(stack) - 1, 0, -1):  # a block, or another one, ends an open list of choices
                if stack[depth][0] == "select":
                    close_to(depth)
                    break
        if name in _CLOSES_P or name in _SIBLINGS:
            wanted = _SIBLINGS.get(name, {"p"} if name in _CLOSES_P else set())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in wanted:
                    close_to(depth)
                    if name != "tr":
                        break
                elif stack[depth][0] in _SCOPES:
                    break
        if name not in _BLOCKS or name in _VOID:
            if name == "br":
                texts.append(" ")
            elif name not in _VOID and not rest.endswith("/"):
                links += name == "a"
                foreign += name in _FOREIGN
                stack.append((name, stack[-1][1]))
            elif name == "hr":
                flush()
            continue
        flush()
        hidden += name == "template"
        choices += name == "select"
        node = len(page.parents)
        page.parents.append(stack[-1][1])
        page.tags.append(name)
        page.names.append(" ".join("".join(m) for m in _ATTRIBUTE.findall(rest)))
        stack.append((name, node))
    if raw_end is None or raw_end < len(source):
        add_text(source[at:])
    flush()
    return page


def _sides(page: Page) -> tuple[list[bool], list[bool]]:
    """Of each element whether its tag, and whether its names, are those of navigation, forms, adverts, comments
    and the like.

    An element round the main part of the page is none of these, whatever it is called: one that holds the ``article`` or
    ``main`` of most text, or the first heading of that (of the page, where there is none) with most of the text outside
    links that lies in no such element deeper. Much text alone is not enough: a long thread of comments is no main part.
    """
    n = len(page.parents)
    prose = [0] * n
    for node, text, in_links in page.runs:
        prose[node] += len(text) - in_links
    in_main = [False] * n
    tagged, named = [False] * n, [False] * n
    for node in range(1, n):
        tag, names = page.tags[node], page.names[node]
        in_main[node] = in_main[page.parents[node]] or tag in _MAIN
        tagged[node] = tag in _SIDE and not (tag == "header" and in_main[node])  # an article's header holds its heading
        named[node] = bool(names) and tag not in ("html", "body") and _BAD_NAMES.search(names) is not None
    whole, free, all_prose = prose.copy(), prose.copy(), sum(prose)
    for node in range(n - 1, 0, -1):
        whole[page.parents[node]] += whole[node]
    mains = [node for node in range(1, n) if page.tags[node] == "main" or page.tags[node] in _MAIN and not named[node]]
    holder = max(mains, key=lambda node: whole[node], default=0)
    held = [holder == 0] * n
    for node in range(1, n):
        held[node] = held[page.parents[node]] or node == holder
    heading = next((i for tag in ("h1", "h2", "h3") for i in range(n) if held[i] and page.tags[i] == tag), 0)
    above = set()
    while heading > 0:
        above.add(heading)
        heading = page.parents[heading]
    for node in range(n - 1, 0, -1):
        if (tagged[node] or named[node]) and node in above and 2 * free[node] > all_prose:
            tagged[node] = named[node] = False
        if not (tagged[node] or named[node]):
            free[page.parents[node]] += free[node]
    while holder > 0:
        tagged[holder] = named[holder] = False
        holder = page.parents[holder]
    return tagged, named


def node_features(page: Page) -> np.ndarray:
    """What the model sees of each element."""
    n = len(page.parents)
    own, linked, ends = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text, in_links in page.runs:
        own[node] += len(text)
        linked[node] += in_links
        ends[node] += text.count(".") + text.count("!") + text.count("?")
    whole, all_linked = own.copy(), linked.copy()
    tagged, named = _sides(page)
    for node in range(n - 1, 0, -1):
        whole[page.parents[node]] += whole[node]
        all_linked[page.parents[node]] += all_linked[node]
    inside, main = [False] * n, [False] * n
    x = np.zeros((n, len(_FEATURES)))
    x[:, 0] = 1
    for node, (tag, names) in enumerate(zip(page.tags, page.names, strict=True)):
        x[node, 1] = tag in _MAIN
        x[node, 2] = tagged[node]
        x[node, 3] = tag in _HEADING
        x[node, 4] = tag in _PROSE
        x[node, 5] = tag in _LIST
        if names and tag not in ("html", "body"):
            x[node, 6] = named[node]
            x[node, 7] = _GOOD_NAMES.search(names) is not None and not x[node, 6]
        # Within navigation, forms, comments and the like, however deep.
        inside[node] = bool(node and inside[page.parents[node]] or x[node, 2] or x[node, 6])
        x[node, 13] = inside[node]
        # Within the article, and in nothing of the kind there: lists, tables and links too.
        main[node] = bool(node and main[page.parents[node]] or tag in _MAIN) and not inside[node]
        x[node, 14] = main[node]
    x[:, 8] = np.log1p(own) / 5
    x[:, 9] = linked / np.maximum(own, 1)
    x[:, 10] = all_linked / np.maximum(whole, 1)
    x[:, 11] = np.minimum(ends, 3) / 3
    x[:, 12] = whole / max(1.0, whole[0])
    return x


def known_labels(page: Page) -> np.ndarray | None:
    """Content marks of a page that names its main part itself; None for a page that does not.

    What lies in an ``article`` or ``main`` element is content, but for navigation, forms, adverts, comments and
    the like inside it; see ``_sides`` for what is taken for one.
    """
    if not _MAIN.intersection(page.tags):
        return None
    marks = np.zeros(len(page.tags), dtype=np.int64)
    blocked = [False] * len(page.tags)
    tagged, named = _sides(page)
    for node in range(1, len(page.tags)):
        parent, tag = page.parents[node], page.tags[node]
        blocked[node] = blocked[parent] or tagged[node] or named[node]
        marks[node] = not blocked[node] and (marks[parent] or tag in _MAIN)
    return marks


@dataclass
class Forest:
    """Trees in one numbering, with their nodes by level."""

    parents: np.ndarray
    levels: list[np.ndarray]


def forest(parents: list[list[int]]) -> Forest:
    joined: list[int] = []
    depths: list[int] = []
    for tree in parents:
        first = len(joined)
        for parent in tree:
            joined.append(-1 if parent < 0 else first + parent)
            depths.append(0 if parent < 0 else depths[first + parent] + 1)
    depth = np.array(depths)
    order = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1))
    return Forest(np.array(joined), np.split(order, edges))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def sum_product(trees: Forest, own: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact marginals: of each node (n, 2), and of each node with its parent (n, 2, 2).

    ``own`` are the log potentials of the nodes' states, ``pairs`` those of [parent, child].
    """
    inward = own.astype(float).copy()  # a node's potential with all messages from below
    up = np.zeros_like(inward)
    for level in reversed(trees.levels[1:]):
        up[level] = _log_sum(inward[level][:, None, :] + pairs[None], 2)
        np.add.at(inward, trees.parents[level], up[level])
    belief = inward.copy()
    together = np.zeros((len(own), 2, 2))
    for level in trees.levels[1:]:
        rest = belief[trees.parents[level]] - up[level]  # the parent without this child
        joint = rest[:, :, None] + pairs[None] + inward[level][:, None, :]
        belief[level] = _log_sum(joint, 1)
        flat = joint.reshape(len(level), 4)
        flat = np.exp(flat - flat.max(axis=1, keepdims=True))
        together[level] = (flat / flat.sum(axis=1, keepdims=True)).reshape(-1, 2, 2)
    top = np.exp(belief - belief.max(axis=1, keepdims=True))
    return top / top.sum(axis=1, keepdims=True), together


@dataclass
class TextModel:
    weights: np.ndarray
    pairs: np.ndarray

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """The probability of being content of every element of each page."""
        if not pages:
            return []
        x = np.concatenate([node_features(p) for p in pages])
        own = np.stack([np.zeros(len(x)), x @ self.weights], axis=1)
        marginals, _ = sum_product(forest([p.parents for p in pages]), own, self.pairs)
        return np.split(marginals[:, 1], np.cumsum([len(p.parents) for p in pages])[:-1])


def fit_text_model(pages: list[Page], *, rounds: int = 120, strength: float = 0.02) -> TextModel:
    """Weights of highest likelihood on the pages that name their main part, near the prior.

    Every such page is learned from twice: as it is, and without the tag that names the main part, so
    that pages without one are told by the rest. The prior alone where there is none.
    """
    weights, pairs = _PRIOR.copy(), _PRIOR_PAIRS.copy()
    known = [(p, m) for p in pages if (m := known_labels(p)) is not None]
    if not known:
        return TextModel(weights, pairs)
    plain = np.concatenate([node_features(p) for p, _ in known])
    masked = plain.copy()
    masked[:, [1, 14]] = 0
    x = np.concatenate([plain, masked])
    marks = np.concatenate([m for _, m in known] * 2)
    trees = forest([p.parents for p, _ in known] * 2)
    child = np.flatnonzero(trees.parents >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (marks[trees.parents[child]], marks[child]), 1)
    squares = np.concatenate([(weights * 0), pairs.ravel() * 0])
    for _ in range(rounds):
        own = np.stack([np.zeros(len(x)), x @ weights], axis=1)
        marginals, together = sum_product(trees, own, pairs)
        pull = x.T @ (marks - marginals[:, 1]) / len(x) - strength * (weights - _PRIOR) / len(_FEATURES)
        pair_pull = (seen - together[child].sum(axis=0)) / len(x) - strength * (pairs - _PRIOR_PAIRS) / 4
        step = np.concatenate([pull, pair_pull.ravel()])
        squares += step * step
        step *= 0.3 / np.sqrt(squares + 1e-9)
        weights += step[: len(weights)]
        pairs += step[len(weights) :].reshape(2, 2)
    return TextModel(weights, pairs)


def train_text_model(pages: DataFrame, *, sample: int = 400, key: Column, source: str = "html") -> TextModel:
    """Fit on about ``sample`` pages, chosen by a hash of ``key``; that bounds what is gathered.

    Pages over 200,000 characters are not learned from (they are extracted from as any other).
    """
    usable = pages.where(F.col(source).isNotNull() & (F.length(source) <= 200_000)).select(key.alias("key"), F.col(source).alias("html"))
    got = hashed_sample(usable, F.col("key"), sample).collect()
    got.sort(key=lambda r: r["html"])
    return fit_text_model([parse(r["html"]) for r in got])


def with_main_text(pages: DataFrame, model: TextModel, *, source: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with their main text: blocks in page order, joined by a line feed.

    Character references are decoded, white space inside a block is one blank. A null or empty page, or
    one without content, gives an empty text. Pages are read whole, and independently of each other, so repeated
    rows and an empty table need no rule. A column named ``into`` gives way. No shuffle.
    """
    weights, pairs = model.weights, model.pairs

    @F.pandas_udf(T.StringType())
    def extracted(sources: pd.Series) -> pd.Series:
        fitted, texts = TextModel(weights, pairs), []
        bodies = sources.tolist()
        for at in range(0, len(bodies), 200):
            parsed = [parse(b or "") for b in bodies[at : at + 200]]
            for page, content in zip(parsed, fitted.content(parsed), strict=True):
                texts.append("\n".join(text for node, text, _ in page.runs if content[node] >= 0.5))
        return pd.Series(texts, dtype=object)

    hold = free_name(pages, "extracted")
    return pages.withColumn(hold, extracted(F.col(source))).select(
        *[c for c in pages.columns if c != into], F.col(hold).alias(into)
    )
