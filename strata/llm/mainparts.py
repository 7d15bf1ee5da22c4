"""HTML extraction (2): consensus host paths.

1. Each page is read into its block elements, and its containers are scored by
   the paragraphs they hold (length, commas, share of text in links). Elements that
   are menus, footers or asides by their tag count nowhere; headers, forms and
   elements marked by class, id, role or style as adverts, notices, sidebars and the
   like count nowhere unless they hold most of the page's score and no article or
   main element stands beside them: then the mark speaks of the page (a form around
   all of it, a layout name), not of a part. Comments stay out unless nearly all
   the score is theirs. The page votes for the generalised tag-class path of its
   best container.
2. Spark adds the votes by host and path (partial sums before the shuffle) and
   takes each host's winning path.
3. Pages join their host's path and are extracted anew from the elements on it; a
   page that has none uses its own best container, and one without containers
   all its text outside the parts named above.

Generalised: digits in a class count as one sign, and classes are sorted. White
space (a line break is one) becomes one space inside a block; blocks are joined by
one line end. A page is read in time linear in its length, malformed or not.

Defined results: null or empty html gives an empty text; a null url shares one
host with other urls that have none; a null page_id stays; repeated rows are
extracted (and vote) row by row; ties between paths go to the higher score, then
to the greater name; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, written

#: Each token ends somewhere whatever follows, so no text is looked at twice: a tag that is never closed
#: ends before the next "<" that stands in no quoted value.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^<>])*+)(?:>|(?=<)|\Z)",
    re.DOTALL,
)
#: Elements whose content is no text of the page, up to their end tag.
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^<>]*+>?", re.IGNORECASE) for t in
       "script style noscript template textarea title svg iframe select object canvas".split()}
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]++)))?")
ATTRIBUTES = frozenset("class id role hidden style aria-hidden".split())
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "head caption legend optgroup option".split())
CONTAINER = frozenset("article body center div form main section td".split())
#: Elements that are never main text; and those that are not unless the page's score is theirs.
DROPPED = frozenset("annotation annotation-xml aside button dialog footer head input label menu nav".split())
DOUBTFUL = frozenset("fieldset form".split())
ROLES = frozenset("alert banner complementary contentinfo dialog alertdialog form menu menubar navigation search".split())
COMMENTS = frozenset("comment comments respond replies disqus".split())
#: What a name must come down to, to mark a part as not main text.
MARKS = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner outbrain "
    "taboola cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription "
    "signup paywall share sharing social sidebar aside widget widgets related recommended recommendations menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead topbar footer login search searchbox pagination pager".split())
#: Marks that speak for the whole name where they begin it ("related-stories").
FIRST = frozenset("related recommended sponsored promoted newsletter".split())
#: Words of which a name may tell its place or form after what it is ("sidebar-inner", "comment-list").
FORM = frozenset(
    "area article articles bar block body bottom box button buttons card cards col column columns container content contents "
    "grid group heading holder icons inner item items label layout left link links list lists media message module outer "
    "panel post posts region right row section slot space text this title tools top unit units wrap wrapper zone".split())
#: "has-sidebar", "page-with-sidebar", "comments-open": states, which name no part.
BEFORE_STATE, STATE = frozenset("has with without no".split()), frozenset("allowed closed count disabled enabled off on open".split())
#: Words that show that a header is the article's own.
OWN = frozenset("article content entry post story".split())
#: An open element that another of the same group ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body html div article section main td".split())

NONE, PART, COMMENT = range(3)
#: Shares of the page's score at which a marked element is the page, not a part.
MOST, NEARLY_ALL = 0.5, 0.95


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if text.strip():
        for m in ATTRIBUTE.finditer(text):
            name = m[1].lower()
            if name in ATTRIBUTES:
                found.setdefault(name, m[2] or m[3] or m[4] or "")
    return found


def mark_of(name: str) -> str | None:
    """The mark that a class name or id comes down to: its last word, after words of state and form."""
    words = [w.lower() for w in WORD.findall(name) if len(w) > 1]
    for i, w in enumerate(words):
        if w in BEFORE_STATE:
            words = words[:i]
            break
    if not words or words[-1] in STATE:
        return None
    whole = set(words)
    while len(words) > 1 and words[-1] in FORM:
        words.pop()
    last = words[-1]
    if last == "header" and whole & OWN:
        return None
    return last if last in MARKS else words[0] if words[0] in FIRST else None


def marked(tag: str, a: dict[str, str], in_article: bool) -> int:
    """Whether an element says that it is no main text, or comments."""
    if tag in ("body", "html"):
        return NONE
    marks = {mark_of(n) for n in f"{a.get('class', '')} {a.get('id', '')}".split()} if a else set()
    if marks & COMMENTS:
        return COMMENT
    if tag in ("article", "main"):
        return NONE
    if marks - {None} or tag in DOUBTFUL or (tag == "header" and not in_article):
        return PART
    if a and ("hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES
              or "display:none" in a.get("style", "").replace(" ", "").lower()):
        return PART
    return NONE


def score_of(text: str, linked: int) -> float:
    """A paragraph's score: length and commas, less its share of text in links."""
    return (1 + min(len(text) / 100, 3) + text.count(",")) * (1 - min(1.0, linked / len(text)))


class Page:
    """Elements and text blocks of one page."""

    def __init__(self, source: str):
        # of each element: its parent, name, whether its text is never main text, its mark, the nearest marked element,
        # whether it is in a link or in an article, and the nearest container
        self.parent, self.key, self.tag, self.never, self.mark, self.marked = [-1], [""], ["#"], [False], [NONE], [0]
        self.link, self.own, self.home = [False], [False], [0]
        self._read_blocks: list[tuple[list, int]] = []  # (text, nearest marked element, in a link) of each run, block element
        self._read(source)
        self.blocks: list[tuple[str, int, int]] = []  # text, element, characters in links
        self._decide()

    def _read(self, source: str) -> None:
        stack, held, at = [0], [], 0
        tags = self.tag
        places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
        blocks, scopes = [0], [0]

        def flush():
            if held:
                self._read_blocks.append((held[:], stack[blocks[-1]]))
                held.clear()

        def add_text(text):
            top = stack[-1]
            if text and not self.never[top]:
                held.append((entities.unescape(text) if "&" in text else text, self.marked[top], self.link[top]))

        def space():
            if not self.never[stack[-1]]:
                held.append((" ", self.marked[stack[-1]], False))

        def cut(place):
            while len(stack) > place:
                t = tags[stack.pop()]
                places[t].pop()
                if t in BLOCK:
                    blocks.pop()
                if t in SCOPE:
                    scopes.pop()

        def last(tag):
            return places[tag][-1] if places.get(tag) else 0

        def end_in_scope(tag):
            place = last(tag)
            if place and place >= scopes[-1]:
                cut(place)

        while m := TOKEN.search(source, at):
            a, b = m.span()
            if a > at:
                add_text(source[at:a])
            at = b
            if m[2] is None:
                continue
            tag = m[2].lower()
            block = tag in BLOCK
            if m[1]:
                place = last(tag)
                if place and (block or blocks[-1] <= place) and (not block or tag in SCOPE or scopes[-1] <= place):
                    if block:
                        flush()
                    cut(place)
                continue
            closed = m[3].endswith("/")
            if tag in RAW:
                if tag != "svg" or not closed:
                    end = RAW[tag].search(source, at)
                    at = end.end() if end else len(source)
                if tag not in ("script", "style", "noscript", "template"):
                    space()
                continue
            if block:
                flush()
                for other in ENDS.get(tag, ()):
                    end_in_scope(other)
                end_in_scope("p")
            if tag in VOID or (tag == "math" and closed):
                space()
                continue
            top, own = stack[-1], attributes(m[3])
            article = self.own[top] or tag in ("article", "main")
            node = len(tags)
            mark = marked(tag, own, article)
            self.parent.append(top)
            tags.append(tag)
            self.key.append(f"{tag}.{'.'.join(generalised(own['class']))}" if own.get("class") else tag)
            self.never.append(self.never[top] or tag in DROPPED)
            self.mark.append(mark)
            self.marked.append(node if mark else self.marked[top])
            self.link.append(self.link[top] or tag == "a")
            self.own.append(article)
            self.home.append(node if tag in CONTAINER else self.home[top])
            if closed and not block:
                continue
            places.setdefault(tag, []).append(len(stack))
            if block:
                blocks.append(len(stack))
            if tag in SCOPE:
                scopes.append(len(stack))
            stack.append(node)
        add_text(source[at:])
        flush()

    def _decide(self) -> None:
        """Takes the blocks that are main text: marks hold unless the score says that they mean the page."""
        n = len(self.tag)
        score, own, found = [0.0] * n, [0.0] * n, []
        for runs, node in self._read_blocks:
            plain = [r for r in runs if r[1] == self.marked[node]]  # runs in marked inline elements count nowhere
            text = " ".join("".join(r[0] for r in plain).split())
            if text:
                s = score_of(text, sum(len(r[0].strip()) for r in plain if r[2]))
                score[node] += s
                own[node] += s if self.own[node] else 0
        for i in range(n - 1, 0, -1):
            score[self.parent[i]] += score[i]
            own[self.parent[i]] += own[i]
        out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]]
            if self.mark[i] and not out[i]:
                least = NEARLY_ALL if self.mark[i] == COMMENT else MOST
                out[i] = score[i] <= least * score[0] or own[0] - own[i] > 1e-9
        for runs, node in self._read_blocks:
            runs = [r for r in runs if not out[r[1]]]
            text = " ".join("".join(r[0] for r in runs).split())
            if text and not out[node]:
                found.append((text, node, sum(len(r[0].strip()) for r in runs if r[2])))
        self.blocks, self._read_blocks = found, []

    def best(self) -> tuple[int, float]:
        """(container with the highest score, score); (0, 0) without one."""
        scores: dict[int, float] = {}
        for text, node, linked in self.blocks:
            s = score_of(text, linked)
            for share in (1.0, 0.5):
                node = self.home[node]
                if node <= 0:
                    break
                scores[node] = scores.get(node, 0) + s * share * (1.5 if self.tag[node] in ("article", "main") else 1)
                node = self.parent[node]
        if not scores:
            return 0, 0.0
        top = max(scores, key=lambda n: (scores[n], -n))
        node, climbed = top, top
        while node > 0:
            if self.tag[node] in ("article", "main"):
                climbed = node
            node = self.parent[node]
        return climbed, scores[top]

    def paths(self) -> list[int]:
        """A hash of each element's path of generalised names."""
        out = [0] * len(self.key)
        for i in range(1, len(out)):
            out[i] = xxhash.xxh64_intdigest(self.key[i], out[self.parent[i]])
        return out

    def path_of(self, node: int) -> str:
        """The path's last names and the hash of all of it."""
        names, i = [], node
        while i > 0 and len(names) < 6:
            names.append(self.key[i])
            i = self.parent[i]
        return f"{'>'.join(reversed(names))}#{self.paths()[node]:016x}"

    def text(self, path: str | None) -> str:
        """Blocks below the elements on ``path``; without such blocks below those on the path of the page's own
        best container; without a container all blocks."""
        paths = self.paths()
        found = self._below(int(path.rpartition("#")[2], 16), paths) if path else []
        if not found:
            top, _ = self.best()
            found = self._below(paths[top], paths) if top else [t for t, _, _ in self.blocks]
        return "\n".join(found)

    def _below(self, wanted: int, paths: list[int]) -> list[str]:
        inside = [False] * len(paths)
        for i in range(1, len(paths)):
            inside[i] = inside[self.parent[i]] or paths[i] == wanted
        return [t for t, n, _ in self.blocks if inside[n]]


def generalised(classes: str) -> list[str]:
    return sorted({re.sub(r"[0-9]+", "#", c) for c in classes.split()})


def host() -> F.Column:
    """Lower-cased host of the url, without a port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): the vote of every page that has a container."""

    def run(batches):
        for batch in batches:
            hosts, paths, scores = [], [], []
            for name, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = Page(source or "")
                node, score = page.best()
                if node:
                    hosts.append(name)
                    paths.append(page.path_of(node))
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
                names=["host", "path", "score"])

    rows = pages.select(host().alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "host string, path string, score double")


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host."""
    counted = votes(pages).groupBy("host", "path").agg(F.count("*").alias("n"), F.round(F.sum("score"), 3).alias("s"))
    return counted.groupBy("host").agg(F.max(F.struct("n", "s", "path"))["path"].alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every row."""
    winners = written(winning_paths(pages), "host-paths")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host().alias("host"))
    rows = rows.join(winners, "host", "left").select("page_id", "url", "path", "html")

    def run(batches):
        for batch in batches:
            paths, sources = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = [Page(source or "").text(path) for source, path in zip(sources, paths)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                      pa.array([len(t) for t in texts], pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars", "path"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint, path string")


def op2_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
