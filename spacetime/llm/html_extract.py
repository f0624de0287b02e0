"""Main text of web pages by union-free regular-expression inference.

Pages of one host come from few templates.  A page is a stream of tokens (tags
with class and id, and texts).  Neighbouring repeats of a group fold into one
repeated group; the streams of a host's sample pages are then aligned one after
another with the wrapper so far: equal tokens stay, differing texts become a
text slot, and tokens only one side has become an optional group.  The result
is a regular expression over tokens with optional and repeated groups but no
alternatives.  The element that holds the host's running text in most sample
pages is marked in it; matching a page against the expression gives that
element's tokens.  A page that does not match (cut off, or of another template)
or has several such elements is searched for the marked elements themselves,
which are all taken; without one it is taken whole.

From the tokens found in an element that is no article or main element, the
host's own blocks go: those of texts that the wrapper has as constants at one
place of every page, as site names, slogans and terms are.  What
is left outside navigation, forms, adverts and the like is put together by block.

A host's wrapper is made from about ``sample_pages`` different pages, chosen by a
hash of their html, so that copies of a page change nothing; hosts are aligned
independently and no group holds more than the sample.  Every page is extracted,
whole, in time that grows with its length.

Edge cases: null or empty html gives an empty text; a null url is a host of its
own; a host with fewer than ``SURE_PAGES`` different pages keeps its constants;
unclosed elements end with the element around them; tags, comments and scripts
without an end run to the end of the page; repeated rows are extracted each; an
empty table gives no rows; columns of any other name are not looked at.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import bounded_broadcast, map_batches, stored

SAMPLE_PAGES = 16
#: Longest repeated group looked for, in tokens.
GROUP_TOKENS = 12
#: So many different pages must agree in a text for it to be the host's own.
SURE_PAGES = 4
BROADCAST_HOSTS = 20_000

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "noscript", "template", "iframe"))
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINER = frozenset(("article", "main", "section", "div", "body", "td"))
DROPPED = frozenset("nav footer aside form script style noscript template iframe button select option textarea svg canvas head title dialog menu object audio video header label input".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)

# A tag whose quotes do not close ends at the next ">"; without one it takes the rest of the page, so each
# character is looked at a few times at most.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[A-Za-z][^>]*+(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")

Token = tuple[str, str, str]  # kind: "<" open, ">" close, "t" text; name; class and id, or the text


def tokens(html: str | None) -> list[Token]:
    """A page as opening tags, closing tags and texts; comments, doctypes and
    the insides of raw elements are left out."""
    out: list[Token] = []
    if not html:
        return out
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            out.append(("t", "", html[at:]))
            break
        if m.start() > at:
            out.append(("t", "", html[at : m.start()]))
        at = m.end()
        tag = m.group()
        name = _NAME.match(tag)
        if name is None or not tag.endswith(">"):
            continue
        name = name.group(1).lower()
        if tag[1] == "/":
            out.append((">", name, ""))
            continue
        marks = " ".join(f"{k.lower()}={a or b or c}" for k, a, b, c in _MARK.findall(tag)) if "=" in tag else ""
        out.append(("<", name, marks))
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            out.append((">", name, ""))
    return [t for t in out if t[0] != "t" or not t[2].isspace()]


def dropped(token: Token) -> bool:
    """Whether an element is never part of the main text."""
    if token[1] in DROPPED:
        return True
    if not token[2] or token[1] in ("body", "html", "article", "main"):
        return False
    return not DROPPED_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", token[2].lower()))


def walk(page: list[Token]) -> Iterator[tuple[int, Token, list[Token], bool]]:
    """``(index, token, open elements, kept)`` along a page; closing tags pop
    to their opening one, block elements end an open paragraph."""
    stack: list[Token] = []
    bad = 0  # open elements that are dropped
    inside = 0  # open articles
    opened: Counter = Counter()  # open elements by name

    def pop() -> None:
        nonlocal bad, inside
        t = stack.pop()
        opened[t[1]] -= 1
        bad -= t[3]
        inside -= t[1] == "article"

    for i, t in enumerate(page):
        if t[0] == "<":
            if opened["p"] and t[1] in BLOCK and t[1] not in ("br", "hr"):
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][1] == "p"), None)
                if depth is not None and not any(s[1] in CONTAINER for s in stack[depth:]):
                    while len(stack) > depth:
                        pop()
            if t[1] not in VOID:
                out = dropped(t) and not (t[1] == "header" and inside)
                stack.append((*t, out, i))
                opened[t[1]] += 1
                bad += out
                inside += t[1] == "article"
        yield i, t, stack, bad == 0
        if t[0] == ">" and opened[t[1]]:
            while stack[-1][1] != t[1]:
                pop()
            pop()


def key_of(token: Token) -> str:
    return f"{token[1]} {token[2]}".strip()


def blocks(page: list[Token], own: frozenset[str] = frozenset()) -> str:
    """The kept text of tokens: one line per block, space runs as one space.  A
    block all of whose texts are in ``own`` is left out."""
    lines: list[str] = []
    piece: list[str] = []
    other = False  # the block has a text that is not in own

    def flush() -> None:
        nonlocal other
        line = _SPACE.sub(" ", "".join(piece)).strip()
        if line and (other or not own):
            lines.append(line)
        piece.clear()
        other = False

    for _, t, _, kept in walk(page):
        if t[0] == "t":
            if kept:
                piece.append(entities.unescape(t[2]))
                other = other or t[2] not in own
        elif t[1] in BLOCK:
            flush()
    flush()
    return "\n".join(lines)


def main_key(page: list[Token]) -> str | None:
    """The key of a page's main element: of the article or main elements, those
    of one key together, with three tenths of its kept text; else the innermost
    container with nine tenths of it and all of its top headings."""
    held: dict[int, tuple[int, int, str, int]] = {}  # by element: kept characters, depth, key, those of top headings
    together: Counter = Counter()  # by key of article and main elements, outermost of a key
    deep: dict[str, int] = {}
    total = heads = 0
    open_now: list[tuple[int, int, int, str | None]] = []  # element, characters before it, key if a container
    open_keys: Counter = Counter()

    def close() -> None:
        i, start, start_heads, key = open_now.pop()
        if key is not None:
            open_keys[key] -= 1
            held[i] = (total - start, len(open_now), key, heads - start_heads)
            if key.split(" ")[0] in ("article", "main") and not open_keys[key]:
                together[key] += total - start
                deep[key] = max(deep.get(key, 0), len(open_now))

    for _, t, stack, kept in walk(page):
        # what walk has closed since, and what it has opened
        while open_now and (len(open_now) > len(stack) or stack[len(open_now) - 1][4] != open_now[-1][0]):
            close()
        for s in stack[len(open_now) :]:
            key = key_of(s) if s[1] in CONTAINER else None
            open_now.append((s[4], total, heads, key))
            if key is not None:
                open_keys[key] += 1
        if t[0] == "t" and kept:
            total += len(t[2].strip())
            if any(s[1] == "h1" for s in stack[-4:]):
                heads += len(t[2].strip())
    while open_now:
        close()
    named = [k for k, n in together.items() if n >= 0.3 * total and n]
    if named:
        return max(named, key=lambda k: (together[k], deep[k]))
    full = [(depth, n, key) for n, depth, key, h in held.values() if n >= 0.9 * total and n and h == heads]
    return max(full)[2] if full else None


# Wrapper nodes: ("tag", kind, key), ("text", constant or None), ("opt", nodes), ("plus", nodes)
def shape(node: tuple) -> tuple:
    """A node without its texts."""
    if node[0] == "text":
        return ("text",)
    return node if node[0] == "tag" else (node[0], tuple(map(shape, node[1])))


def joined(a: tuple, b: tuple) -> tuple:
    """Two nodes of one shape as one: texts that differ become a slot."""
    if a[0] == "text":
        return a if a == b else ("text", None)
    return a if a[0] == "tag" else (a[0], tuple(map(joined, a[1], b[1])))


def whole(group: list[tuple]) -> bool:
    """Whether a group closes only elements it opened, and every container."""
    opened: Counter = Counter()
    for n in group:
        if n[0] == "tag":
            name = n[2].split(" ")[0]
            opened[name] += 1 if n[1] == "<" else -1
            if opened[name] < 0:
                return False
    return not any(opened[c] for c in CONTAINER)


def fold(nodes: list[tuple]) -> list[tuple]:
    """Neighbouring groups of one shape become a repeated group, shortest first."""
    for size in range(1, GROUP_TOKENS + 1):
        shapes = [shape(n) for n in nodes]
        out: list[tuple] = []
        i = 0
        while i < len(nodes):
            group = shapes[i : i + size]
            reps = 1
            if len(group) == size and group[0][0] != "text" and (size > 1 or group[0][0] != "plus") and whole(group):
                while shapes[i + reps * size : i + (reps + 1) * size] == group:
                    reps += 1
            if reps > 1:
                unit = nodes[i : i + size]
                for r in range(1, reps):
                    unit = [joined(a, b) for a, b in zip(unit, nodes[i + r * size : i + (r + 1) * size])]
                out.append(("plus", tuple(unit)))
                i += reps * size
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def nodes_of(page: list[Token]) -> list[tuple]:
    return fold([("text", t[2]) if t[0] == "t" else ("tag", t[0], key_of(t)) for t in page])


def lengths(a: list, b: list) -> list[int]:
    """For every prefix of ``b`` how many items it has in common with ``a``, in
    order: a row of the table of longest common subsequences, whose steps are
    the bits of one number."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full  # a zero where the row steps up
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    out, n = [0], 0
    for bit in reversed(f"{row:0{len(b)}b}"[-len(b) :] if b else ""):
        n += bit == "0"
        out.append(n)
    return out


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, by halving ``a``: the halves
    share out ``b`` where their rows add up to most.  Pages of any length are
    aligned in the square of it over the width of a machine word."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        if i == k or j == m:
            continue
        if k - i == 1:
            at = next((x for x in range(j, m) if b[x] == a[i]), None)
            if at is not None:
                out.append((i, at))
            continue
        half = (i + k) // 2
        left = lengths(a[i:half], b[j:m])
        right = lengths(a[half:k][::-1], b[j:m][::-1])[::-1]
        best = max(range(m - j + 1), key=lambda x: left[x] + right[x])
        todo += [(i, half, j, j + best), (half, k, j + best, m)]
    return sorted(out)


def align(wrapper: list[tuple], page: list[tuple]) -> list[tuple]:
    """The wrapper widened so that it also takes ``page``."""
    flat = [n[1] if n[0] == "opt" else (n,) for n in wrapper]
    ws = [(x, w[0] == "opt") for w, g in zip(wrapper, flat) for x in g]
    group = [k for k, g in enumerate(flat) for _ in g]
    out: list[tuple] = []
    matched = None  # the group of the token matched last
    i = j = 0
    for wi, pj in [*common([shape(n) for n, _ in ws], [shape(n) for n in page]), (len(ws), len(page))]:
        if wi > i or pj > j:
            matched = None
        while i < wi:  # only the wrapper has these: a group of its own each, those of one group together
            end = i + 1
            while end < wi and (group[end] if ws[end][1] else None) == (group[i] if ws[i][1] else None):
                end += 1
            out.append(("opt", tuple(n for n, _ in ws[i:end])))
            i = end
        if pj > j:
            out.append(("opt", tuple(page[j:pj])))
        if wi == len(ws):
            break
        n, opt = ws[wi]
        m = joined(n, page[pj])
        if opt and matched == group[wi]:
            out[-1] = ("opt", (*out[-1][1], m))  # its group goes on
        else:
            out.append(("opt", (m,)) if opt else m)
        matched = group[wi]
        i, j = wi + 1, pj + 1
    return out


def constants(wrapper: list[tuple]) -> list[str]:
    """Texts that stand at one place of every page: no slot, not optional and
    not repeated."""
    return sorted({n[1] for n in wrapper if n[0] == "text" and n[1] is not None})


def infer(pages: list[list[Token]]) -> tuple[list[tuple], str | None, list[str]]:
    """Wrapper of a host's sample pages, the key of its main element, and the
    host's own texts: the constants, if ``SURE_PAGES`` different pages agree."""
    votes = Counter(k for p in pages if (k := main_key(p)) is not None)
    wrapper: list[tuple] | None = None
    for p in pages:
        wrapper = nodes_of(p) if wrapper is None else align(wrapper, nodes_of(p))
    key = min(votes, key=lambda k: (-votes[k], k)) if votes else None
    return wrapper or [], key, constants(wrapper or []) if len(pages) >= SURE_PAGES else []


def main_span(nodes: list, key: str | None) -> tuple[int, int] | None:
    """First and last node of the main element: from its opening tag to the
    closing tag that leaves none of its name open.  None if it is not there, or
    if a group inside opens and closes that name unequally often."""
    start = next((i for i, n in enumerate(nodes) if n[0] == "tag" and n[1] == "<" and n[2] == key), None)
    if start is None:
        return None
    name = key.split(" ")[0]

    def opened(node: list) -> int:
        if node[0] == "tag":
            return (node[2].split(" ")[0] == name) * (1 if node[1] == "<" else -1)
        return sum(map(opened, node[1])) if node[0] in ("opt", "plus") else 0

    depth = 0
    for i in range(start, len(nodes)):
        n = opened(nodes[i])
        if n and nodes[i][0] != "tag":
            return None
        depth += n
        if depth == 0:
            return start, i
    return start, len(nodes) - 1


class Wrapper:
    """A host's expression, compiled over one character per token.  Groups are
    possessive, so matching takes one pass however many groups are optional."""

    def __init__(self, saved: str):
        nodes, self.key, own = json.loads(saved)
        # what an article says, it says, on however many pages
        named = self.key is not None and self.key.split(" ")[0] in ("article", "main")
        self.own = frozenset(() if named else own)
        self.code: dict[str, str] = {}
        span = main_span(nodes, self.key)
        parts = [self._regex(n) for n in nodes]
        self.match = None
        if span is not None:
            parts[span[0]] = "(?P<m>" + parts[span[0]]
            parts[span[1]] += ")"
            self.match = re.compile("".join(parts)).fullmatch

    def _regex(self, node: list) -> str:
        if node[0] == "tag":
            return self.code.setdefault(node[1] + node[2], chr(0xE000 + len(self.code)))
        if node[0] == "text":
            return "t?+"
        return "(?:" + "".join(map(self._regex, node[1])) + ")" + ("?+" if node[0] == "opt" else "++")

    def main(self, page: list[Token]) -> list[Token]:
        if self.match is not None and sum(t[0] == "<" and key_of(t) == self.key for t in page) == 1:
            coded = "".join("t" if t[0] == "t" else self.code.get(t[0] + key_of(t), "") for t in page)
            if len(coded) == len(page) and (m := self.match(coded)) is not None:
                return page[m.start("m") : m.end("m")]
        return element(page, self.key)


def element(page: list[Token], key: str | None) -> list[Token]:
    """Tokens of the elements called ``key``, else of article and main
    elements, else all.  Of several, those inside no other are taken, and none
    that is dropped if another is not."""
    for wanted in ((lambda t: key is not None and key_of(t) == key), (lambda t: t[1] in ("article", "main"))):
        starts = [i for i, t in enumerate(page) if t[0] == "<" and wanted(t)]
        if len(starts) > 1:
            some = set(starts)
            starts = [i for i, _, _, kept in walk(page) if kept and i in some] or starts
        out: list[Token] = []
        end = 0
        for start in starts:
            if start >= end:
                end = end_of(page, start)
                out += page[start:end]
        if starts:
            return out
    return page


def end_of(page: list[Token], start: int) -> int:
    """Where the element opened at ``start`` is over."""
    depth, name = 0, page[start][1]
    for i in range(start, len(page)):
        if page[i][1] == name and page[i][0] != "t":
            depth += 1 if page[i][0] == "<" else -1
            if depth == 0:
                return i + 1
    return len(page)


@lru_cache(maxsize=4096)
def _wrapper(saved: str) -> Wrapper:
    return Wrapper(saved)


def main_text(html: str | None, saved: str | None) -> str:
    page = tokens(html)
    if not saved:
        return blocks(element(page, None))
    wrapper = _wrapper(saved)
    return blocks(wrapper.main(page), wrapper.own)


def wrappers(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``host, wrapper`` from ``host, unit, html``; ``unit`` is a hash of the
    html in [0, 1).

    A page and its copies are one page: they share a hash, and a task hands on
    one of them."""
    counts = stored(pages.groupBy("host").agg(F.approx_count_distinct("unit", 0.02).alias("n")), "host-counts")
    chance = counts.select("host", F.least(F.lit(1.0), F.lit(2.0 * sample_pages) / F.greatest("n", F.lit(1))).alias("chance"))
    some = pages.where(F.col("html").isNotNull()).join(bounded_broadcast(chance, 20 * BROADCAST_HOSTS), "host").where("unit < chance")
    some = some.groupBy("host", "unit").agg(F.min("html").alias("html"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.sort_values(["unit", "html"]).head(sample_pages)
        return pd.DataFrame({"host": [first["host"].iloc[0]], "wrapper": [json.dumps(infer([tokens(h) for h in first["html"]]))]})

    return stored(some.groupBy("host").applyInPandas(run, "host string, wrapper string"), "wrappers")


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url_col, text, n_chars``."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    unit = F.pmod(F.xxhash64(F.col(html_col)), F.lit(1 << 40)) / float(1 << 40)
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), unit.alias("unit"), F.col(html_col).alias("html"))
    found = src.drop("unit").join(bounded_broadcast(wrappers(src.drop("id", "url"), sample_pages), BROADCAST_HOSTS), "host", "left").select("id", "url", "html", "wrapper")

    def make(batch: pa.RecordBatch) -> list:
        return [batch.column("id"), batch.column("url"), [main_text(h, w) for h, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())]]

    kind = src.schema["id"].dataType.simpleString()
    out = map_batches(found, make, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))
