"""Main text of web pages by occurrence vectors of tokens and the roles of elements.

A page becomes a sequence of tokens: an element start with the path of elements above it, or a text with its path.
The occurrence vector of a token is how often it occurs in each page of its host; it is held as a sum of page
hashes times counts, which adds up map-side, so no page list of a hot host is ever gathered. Tokens that occur
once in (nearly) every page of a host form classes of equal vectors. A text belongs to the template if an element around
it is of its class (the nearest one that stands once in the page): the two come and go together. A text whose element also stands in other pages
fills a slot and is no template. Classes are not nested. Text of the template is boilerplate. Of the other texts, those within
an article (or a main part) are extracted if the page has one, else those outside all elements
that are boilerplate by their kind or name.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, slices, texts_of
from .url_filters import url_parts

# The roles of HTML elements and common names of boilerplate parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html body caption legend li dd dt tbody td tfoot th thead tr summary".split())
BOILERPLATE = frozenset("head nav header footer aside form script style menu dialog button select option textarea noscript template iframe svg title object".split())
BOILERPLATE_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header masthead menu nav navbar navigation newsletter notice pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
#: A text counts as template where at least so many pages of the host are known, in this share of them.
LEAST_PAGES, SHARE = 8, 0.9
#: Hosts whose templates are handed to every task; more are joined by host.
BROADCAST_HOSTS = 20_000


@dataclass(frozen=True)
class Text:
    """A run of text: its path, the block it belongs to, its roles and the decoded words."""

    path: str
    block: int
    boilerplate: bool
    article: bool
    words: str


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def parse(page: str) -> tuple[list[str], list[Text]]:
    """Paths of all element starts, and the texts, of a page in order."""
    starts: list[str] = []
    texts: list[Text] = []
    # Open elements: name, path, boilerplate, article.
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
    block, at = 0, 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        name = m[2]
        if name is None:
            token = m[0]
            if token[0] == "<" and len(token) > 1 and token[1] in "!?":
                continue
            words = html.unescape(token)
            if texts and texts[-1].block == block and texts[-1].path == stack[-1][1]:
                # A stray "<" or a comment splits a text in two.
                last = texts.pop()
                words = last.words + words
            texts.append(Text(stack[-1][1], block, stack[-1][2], stack[-1][3], words))
            continue
        name = name.lower()
        if m[1]:
            if name in BLOCKS:
                block += 1
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
                if stack[depth][0] in ("article", "body", "main", "nav", "footer", "aside", "td") and name not in ("html", "body", "article", "main", "table", "tr"):
                    break
            continue
        if name in BLOCKS:
            block += 1
            if name in CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == "p":
                        del stack[depth:]
                        break
                    if stack[depth][0] in BLOCKS:
                        break
            elif name in ("li", "dt", "dd", "tr", "td", "th") and stack[-1][0] == name:
                stack.pop()
        names = sorted({w for _, a, b, c in _NAME.findall(m[3]) for w in re.split(r"[\s_-]+", (a or b or c).lower()) if w})
        above = stack[-1]
        path = above[1] + "/" + ".".join([name, *names])
        bad = above[2] or name in BOILERPLATE or not BOILERPLATE_NAMES.isdisjoint(names)
        starts.append(path)
        if name == "br":
            if texts and texts[-1].block == block:
                texts.append(Text(above[1], block, above[2], above[3], " "))
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((name, path, bad, above[3] or name in ("article", "main") or "main" in names and name in BLOCKS))
    return starts, texts


def tokens(page: str) -> Counter[tuple[int, int | None]]:
    """How often each token occurs in a page; a text with the token of the nearest element around it that occurs once."""
    starts, texts = parse(page)
    times = Counter(starts)
    found = Counter({(_hash("e", p), None): n for p, n in times.items()})
    holders: dict[str, int] = {}
    for t in texts:
        if t.words.isspace():
            continue
        if t.path not in holders:
            around = t.path
            while around and times[around] != 1:
                around = around.rpartition("/")[0]
            holders[t.path] = _hash("e", around)
        found[_hash("t", t.path, " ".join(t.words.split())), holders[t.path]] += 1
    return found


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the extracted slots, each with single spaces, joined by an empty line."""
    _, texts = parse(page)
    slots = [t for t in texts if not t.boilerplate and not (template and _hash("t", t.path, " ".join(t.words.split())) in template and not t.words.isspace())]
    if any(t.article and not t.words.isspace() for t in slots):
        slots = [t for t in slots if t.article]
    blocks: dict[int, list[str]] = {}
    for t in slots:
        blocks.setdefault(t.block, []).append(t.words)
    found = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(b for b in found if b)


def templates(pages: DataFrame) -> DataFrame:
    """host, template (hashes of text tokens) from ``host``, ``key`` and ``html`` of all pages.

    Tokens of a valid class occur once in at least ``SHARE`` of the host's pages, the same for all of them; its texts are those
    whose holder, the nearest element around that stands once, is of the class. Hosts of fewer than ``LEAST_PAGES`` pages have no template, nor hosts without such a text.
    Counts are added up per Arrow slice, then per host and token.
    """
    schema = pa.schema([("host", pa.string()), ("token", pa.int64()), ("holder", pa.int64()), ("vector", pa.int64()), ("pages", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            sums: dict[tuple[str, int, int | None], list[int]] = {}
            for host, key, page in zip(b.column("host").to_pylist(), b.column("key").to_pylist(), texts_of(b.column("html"))):
                salt = _hash("p", str(key), page)
                for (token, holder), n in (*tokens(page).items(), ((0, None), 1)):
                    s = sums.setdefault((host, token, holder), [0, 0, 0])
                    s[0] = (s[0] + n * salt) & (1 << 64) - 1
                    s[1] += 1
                    s[2] += n
            signed = [v[0] - (1 << 64) if v[0] >> 63 else v[0] for v in sums.values()]
            yield batch_of(schema, host=[h for h, _, _ in sums], token=[t for _, t, _ in sums], holder=[e for _, _, e in sums], vector=signed, pages=[v[1] for v in sums.values()], n=[v[2] for v in sums.values()])

    counted = pages.select("host", "key", "html").mapInArrow(count, "host string, token long, holder long, vector long, pages long, n long")
    # The vectors are sums modulo 2**64, taken in two halves that cannot overflow.
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("vector", 32).bitwiseAND(F.lit(0xFFFFFFFF))
    sums = counted.groupBy("host", "token").agg(
        F.min("holder").alias("holder"), F.max("holder").alias("_last"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.sum("pages").alias("pages"), F.sum("n").alias("n")
    )
    carry = F.shiftright("low", 32)
    sums = sums.select("host", "token", "holder", "_last", "pages", "n", F.shiftleft((F.col("high") + carry).bitwiseAND(F.lit(0xFFFFFFFF)), 32).bitwiseOR(F.col("low").bitwiseAND(F.lit(0xFFFFFFFF))).alias("vector"))
    sizes = sums.where("token = 0").select("host", F.col("pages").alias("host_pages")).where(F.col("host_pages") >= LEAST_PAGES)
    # A text whose nearest element is not the same one in all pages has none.
    valid = sums.where("token <> 0").where("n = pages AND holder <=> _last").join(sizes, "host").where(F.col("pages") >= F.col("host_pages") * SHARE)
    # The classes of a host, then their texts: as long as a template has tokens.
    elements, texts = F.collect_set(F.when(F.col("holder").isNull(), F.col("token"))), F.collect_list(F.when(F.col("holder").isNotNull(), F.struct("token", "holder")))
    classes = valid.groupBy("host", "vector").agg(elements.alias("elements"), texts.alias("texts")).where(F.size("texts") > 0)
    held = classes.select("host", F.filter("texts", lambda t: F.array_contains(F.col("elements"), t["holder"])).alias("texts"))
    return held.groupBy("host").agg(F.flatten(F.collect_list("texts.token")).alias("template")).where(F.size("template") > 0)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text, n_chars of every row.

    NULL and empty pages have an empty text; a page whose host has no template is extracted by the roles of
    its elements alone. Repeated rows get equal results, other columns are not read, an empty table stays empty.
    """
    host, _ = url_parts(F.col(url))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), host.alias("host"), F.col(page).cast("string").alias("html"))
    found = templates(rows.where(F.length("host") > 0))
    hosts = rows.select("host").distinct().count()
    found = F.broadcast(found) if hosts <= BROADCAST_HOSTS else found.hint("merge")
    schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, frozenset[int]] = {}
        for b in slices(batches, "html"):
            out = []
            for h, t, p in zip(b.column("host").to_pylist(), b.column("template"), texts_of(b.column("html"))):
                if h not in kept:
                    if len(kept) > 1000:
                        kept.clear()
                    kept[h] = frozenset(t.as_py() or ())
                out.append(main_text(p, kept[h]))
            yield batch_of(schema, key=b.column("key"), url=b.column("url"), text=out, n_chars=[len(t) for t in out])

    return rows.join(found, "host", "left").select("key", "url", "host", "html", "template").mapInArrow(run, "key long, url string, text string, n_chars long").withColumnRenamed("key", key)
