"""Main text of web pages: the best-scoring contiguous run of words and tags, less what is not article inside it.

A page is a sequence of words and tags. A tag scores a small negative weight, a word the weight of the element it stands
in; both weights are log-odds of being content, learned from labelled pages: pages with an ``article`` (else ``main``)
element label their own words. One linear scan finds the contiguous run with the highest sum. A page that labels itself is
scanned once per labelled element, in which every word is positive and neighbouring tags cost less than one word together,
so that no block of an article is lost and nothing between two articles comes out. Elsewhere elements that no labelled page
has are weak content. Words and tags of menus, headers, footers, sidebars, notices, adverts, forms and reader comments score
nothing, so that they do not cut an article in two, and never come out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelmon.llm.common import arrow_rows, fixed

# Labelled pages used to learn the weights: at most so many, taken by a hash of page_id.
LABELLED_PAGES = 2_000
UNSEEN = 0.5
INSIDE_TAG = -0.02
LIMIT = 4.0

# Names of HTML elements by role.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math", "select", "button", "object", "canvas")
NOT_ARTICLE = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "fieldset", "search"}
CONTENT = {"article", "main"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr", "img",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements that may be left unclosed: they hold text but nothing is nested by them.
OPEN_ENDED = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot", "html", "body", "h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id and role that name what is not article, outside labelled elements: as a part of a name.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner|sidebar|side-bar|notices?|cookies?|consent|gdpr|comments?|commentlist|disqus|replies|"
    r"menu|navbar|nav|navigation|breadcrumbs?|footer|masthead|site-header|page-header|header|topbar|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"signup|login|popup|modal|overlay|pagination|pager|toolbar|widget|complementary|contentinfo|search|alert)(?:$|[\s_-])",
    re.I,
)
# Inside labelled elements: a whole class, id or role. What may be a section's subject or a kind of paragraph is kept there.
NAMED_INSIDE = re.compile(
    r"(?:^|\s)(?:ads?|ad-[\w-]+|advert[\w-]*|adbox|sponsor(?:ed|s)?(?:-[\w-]+)?|promo(?:tion)?s?|banner|sidebar|side-bar|(?:cookie|site|privacy)-?(?:notice|banner|bar)|"
    r"cookies?|consent|gdpr|comments?(?:-(?:section|list|area|form|body|thread))?|commentlist|disqus(?:_thread)?|replies|menu|navbar|nav|navigation|breadcrumbs?|"
    r"share|(?:social-?)?shar(?:e|ing)-?(?:buttons?|links?|bar|tools?|icons?)|social-?(?:buttons?|links?|bar|media)|related(?:-(?:posts?|articles?|links?|stories|content))?|"
    r"recommended|newsletter(?:-[\w-]+)?|subscribe|signup|login|popup|modal|pagination|pager|toolbar|complementary|contentinfo)(?=\s|$)",
    re.I,
)
# Names that exclude a block but not a paragraph or an inline element, and never by id: an anchor names its section's subject.
NAMED_BLOCK = re.compile(r"(?:^|\s)(?:notices?|alert(?:-[\w-]+)?|search|social|sharing|widget|overlay|footer)(?=\s|$)", re.I)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_ARTICLE = re.compile(r"<article[\s/>]", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")


def _marked(name: str, rest: str, names: list[tuple[str, str]], inside: bool) -> bool:
    """Whether an element's attributes name what is not article."""
    if _HIDDEN.search(rest):
        return True
    said = " ".join(value for _, value in names)
    if not inside:
        return bool(NAMED.search(said))
    if NAMED_INSIDE.search(said):
        return True
    blocks = " ".join(value for kind, value in names if kind.lower() != "id")
    return name not in INLINE and name not in OPEN_ENDED and bool(NAMED_BLOCK.search(blocks))


def events(page: str) -> Iterator[tuple[str, str, str, bool, int]]:
    """(kind, text, element, boilerplate, region) in page order; kind is "text", "inline" or "block" (a tag).

    region numbers the outermost content element (from 1) that a piece stands in; 0 is none.
    """
    at, end = 0, len(page)
    # Open elements: name, element with its names, boilerplate, region.
    stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]
    regions = 0
    articles = _ARTICLE.search(page) is not None
    last_close: dict[str, int] = {}
    while at < end:
        found = _MARKUP.search(page, at)
        if found is None:
            found_at, next_at = end, end
        else:
            found_at, next_at = found.span()
        if found_at > at:
            _, element, bad, region = stack[-1]
            yield "text", page[at:found_at], element, bad, region
        at = next_at
        if found is None:
            return
        close, name, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        _, element, bad, region = stack[-1]
        yield ("inline" if name in INLINE else "block"), name, element, bad, region
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        if name in _RAW_END:
            if rest.endswith("/") and name in ("svg", "math", "object"):
                continue
            stop = _RAW_END[name].search(page, at)
            at = stop.start() if stop else end
            continue
        if name in VOID or name in OPEN_ENDED and not rest or name in INLINE and not rest:
            continue
        names = [(kind, value.strip("\"'")) for kind, value in _NAMES.findall(rest)] if rest else []
        marked = bool(rest) and _marked(name, rest, names, region > 0)
        if name in INLINE or name in OPEN_ENDED:
            if not marked:
                continue
            # A marked block ends with its own closing tag only if it has one; the last of each name is looked up once.
            if name not in last_close:
                last_close[name] = max((m.start() for m in re.finditer(rf"</{re.escape(name)}\s*>", page, re.I)), default=-1)
            if last_close[name] < at:
                continue
        content = name == "article" or name == "main" and not articles
        wrong = bad or name in NOT_ARTICLE or marked or name == "header" and not region
        # The first content element is content even in a wrapper that is not, such as a form around the whole page.
        if content and not regions:
            wrong = False
        if content and not region and not wrong:
            regions += 1
            region = regions
        said = " ".join(value for _, value in names)
        stack.append((name, f"{name}.{said}" if said else name, wrong, region))


def learn(pages: Iterator[str]) -> Counter:
    """Counts of (kind, name, content) over labelled pages: words by element and tags by name, inside and outside content."""
    counts: Counter = Counter()
    for page in pages:
        pieces = list(events(page))
        if not any(region for *_, region in pieces):
            continue
        for kind, text, element, bad, region in pieces:
            inside = region > 0 and not bad
            if kind == "text":
                if n := len(text.split()):
                    counts["word", element, inside] += n
            else:
                counts["tag", text, inside] += 1
    return counts


def weights(counts: Counter) -> dict[tuple[str, str], float]:
    """Log-odds of content by (kind, name), within LIMIT; a tag's is never positive."""
    out = {}
    for kind, name in {(k, n) for k, n, _ in counts}:
        odds = math.log((counts[kind, name, True] + 0.5) / (counts[kind, name, False] + 0.5))
        odds = max(-LIMIT, min(LIMIT, odds))
        out[kind, name] = odds if kind == "word" else min(0.0, odds / LIMIT) - 0.1
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """(from, to) of the contiguous run with the highest positive sum, (0, 0) without one, in one scan.

    Of equal sums the one that ends first counts, and of its starts the last.
    """
    best = total = 0.0
    start, best_from, best_to = 0, 0, 0
    for at, score in enumerate(scores, 1):
        total += score
        if total <= 0:
            total, start = 0.0, at
        elif total > best:
            best, best_from, best_to = total, start, at
    return best_from, best_to


def _page_scores(pieces: list[tuple], known: dict[tuple[str, str], float]) -> list[float]:
    """Learned scores of the pieces of a page that does not label itself."""
    return [
        0.0 if bad else known.get(("tag", text), -0.1) if kind != "text" else len(text.split()) * known.get(("word", element), UNSEEN)
        for kind, text, element, bad, _ in pieces
    ]


def _region_scores(pieces: list[tuple], known: dict[tuple[str, str], float]) -> list[float]:
    """Scores inside a labelled element: words are worth UNSEEN or more, a run of tags and blanks INSIDE_TAG in all."""
    scores, words_before = [], True
    for kind, text, element, bad, _ in pieces:
        if bad:
            scores.append(0.0)
        elif kind == "text" and (n := len(text.split())):
            scores.append(n * max(known.get(("word", element), UNSEEN), UNSEEN))
            words_before = True
        else:
            scores.append(INSIDE_TAG if words_before and kind != "text" else 0.0)
            words_before = words_before and kind == "text"
    return scores


def _run_text(pieces: list[tuple]) -> str:
    """The words of a run by blocks, as one text."""
    blocks, now = [], []
    for kind, text, _, bad, _ in pieces:
        if kind == "text" and not bad:
            now.append(text)
        elif kind == "block":
            blocks.append(now)
            now = []
    blocks.append(now)
    texts = (_SPACE.sub(" ", html.unescape("".join(b))).strip() for b in blocks if b)
    return " ".join(t for t in texts if t)


def main_text(page: str | None, known: dict[tuple[str, str], float]) -> str:
    """The text of the best-scoring run of a page, or of each labelled element of it in page order.

    Null and empty pages and pages without content give an empty text.
    """
    pieces = list(events(page or ""))
    regions: dict[int, list[tuple]] = {}
    for piece in pieces:
        if piece[4]:
            regions.setdefault(piece[4], []).append(piece)
    if not any(kind == "text" and not bad and text.strip() for r in regions.values() for kind, text, _, bad, _ in r):
        regions = {}
    parts = [(r, _region_scores(r, known)) for _, r in sorted(regions.items())] or [(pieces, _page_scores(pieces, known))]
    texts = []
    for part, scores in parts:
        first, last = best_run(scores)
        texts.append(_run_text(part[first:last]))
    return " ".join(t for t in texts if t)


def learned(pages: DataFrame) -> dict[tuple[str, str], float]:
    """Weights from the LABELLED_PAGES different labelled pages (article or main element) with the smallest hashes.

    The hash is of page_id and html, so the sample is full wherever that many pages are labelled, and the same whatever
    the order and number of partitions. Only hashes are sorted; the pages are read where they lie.
    """
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)")).select(F.xxhash64("page_id", "html").alias("h"), "html")
    last = labelled.select("h").distinct().orderBy("h").limit(LABELLED_PAGES).agg(F.max("h")).first()[0]
    if last is None:
        return {}
    sample = labelled.where(F.col("h") <= last).groupBy("h").agg(F.first("html").alias("html")).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            counts.update(learn(t for t in batch.column("html").to_pylist() if t))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)]
            + [pa.array([k[2] for k in keys], pa.bool_()), pa.array([counts[k] for k in keys], pa.int64())],
            names=["kind", "name", "inside", "n"],
        )

    with arrow_rows(pages.sparkSession):
        rows = sample.mapInArrow(run, "kind string, name string, inside boolean, n long").groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect()
    return weights(Counter({(r.kind, r.name, r.inside): r.n for r in rows}))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html); n_chars counts code points.

    Null and empty pages give an empty text; pages are taken whole, however long. Of equally good runs the one that ends
    first counts. Repeated rows come out repeated, an empty table gives an empty one, further
    columns are ignored, and a null page_id or url is passed on.
    """
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    known = source.sparkSession.sparkContext.broadcast(learned(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, known.value) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = source.schema["page_id"].dataType.simpleString()
    return fixed(source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long"), "main-text")
