"""Main text of web pages by equivalence-class template deduction.

1. A page is read into tokens: tags with the path of sections that leads to them (each with its number among its like), and
   text blocks with their slot, that is the path of the enclosing sections and the innermost block element.
2. Tokens of a host that have the same occurrence vector over its pages form an equivalence class. Vectors are never
   gathered: each is a pair of sums of hashes of (page, count), so a host of any size is only counted.
3. A class is valid if it has two tokens or more, at least one of them a tag, on at least two pages and ``SUPPORT`` of the
   host's. Paths nest the tags of valid classes; they are the host's template. Text blocks of valid classes are fixed parts.
4. What a slot holds besides fixed parts is its text, outside of links and of sections that say they are no article. A
   section's weight is that of all slots inside. The article is the innermost template section with ``MOST`` of the host's
   weight, or the outermost on the way there that is an <article> or <main>. Slots that hold nothing but fixed parts are
   boilerplate. Slots inside the article are extracted, but for sections that are navigation, headers, footers, asides, forms,
   adverts, notices and reader comments by their element, role or name. Where sections of the article differ in
   rank (<article>, <main>; then names of content), those of the best rank are taken.
5. Pages without such a section (a host of one page, other markup) are read by sections alone.

Defined results: null or empty html has an empty text, as has a page without article text; a page whose every article
block is fixed (copies of one page) keeps them; an article's text that other pages repeat stays unless its whole slot is
fixed; a null url is a host of its own without template; broken markup, cut and very long pages are read as far as they
go; white space inside a block becomes one space, blocks are joined by two line ends; repeated rows and page_ids are kept
and count as often as they stand; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialise

SUPPORT = 0.6
#: Share of a host's text that the article's section holds.
MOST = 0.6
#: Bytes of templates that may be broadcast; more are joined by a shuffle, a host in ``SALTS`` parts.
MAX_BROADCAST_BYTES = 32 << 20
SALTS = 64
#: Pages of an Arrow batch that is handed on.
PAGES = 256

RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul button label".split()
)
SECTION = frozenset("article aside body center details dialog div fieldset figure footer form head header html main menu nav ol section select table ul button label span td dl".split())
PLAIN_BOILERPLATE = frozenset("nav footer aside form button select menu dialog fieldset label head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner promo promotion sponsor sponsored sponsors sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies respond disqus notice notices cookie cookies consent gdpr alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget toolbar "
    "pagination pager copyright legal disclaimer skip hidden".split()
)
OUTSIDE_ARTICLE = frozenset("header topbar title subtitle".split())
CONTENT = frozenset("article content post entry story main body text".split())
#: A header named after one of these belongs to the article.
OWN_HEADER = frozenset("article post entry story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>|<(?:/?[A-Za-z][^<>]*)?\Z", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Za-z0-9]+")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    """A text block: its text, whether its sections are boilerplate, how article-like they are (2, 1, 0), whether it is a link for the most part."""

    text: str
    boilerplate: bool
    rank: int
    link: bool
    token: int
    slot: int
    sections: tuple[int, ...]


class Page(NamedTuple):
    """Tokens in page order, text blocks, and the depth and rank of each section."""

    tokens: list[int]
    blocks: list[Block]
    sections: dict[int, tuple[int, int]]


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts))


def _section(name: str, attributes: str, inside_article: bool) -> tuple[bool, int, str]:
    """(boilerplate, rank, signature) of an element."""
    bad, rank, label = name in PLAIN_BOILERPLATE or name == "header" and not inside_article, 2 if name in ("article", "main") else 0, ""
    if attributes.strip():
        found = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes)}
        label = " ".join(found.get(k, "") for k in ("class", "id")).strip()
        names = {x.lower() for x in _NAME.findall(label)}
        role = found.get("role", "").lower()
        style = found.get("style", "").replace(" ", "").lower()
        bad |= bool(names & NAMES) or role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
        bad |= bool(names & OUTSIDE_ARTICLE) and not inside_article and not names & OWN_HEADER
        rank = max(rank, 2 if role in ("main", "article") else 1 if names & CONTENT else 0)
    return bad, rank, f"{name}.{label}"


def read_page(html: str) -> Page:
    tokens: list[int] = []
    blocks: list[Block] = []
    sections: dict[int, tuple[int, int]] = {}
    stack: list[tuple[str, bool, int, int]] = []  # element, boilerplate so far, rank so far, path
    inner: list[dict[str, int]] = [{}]  # sections of each kind that an open section, or the page, has had
    text: list[str] = []
    leaf, links, linked = "", 0, 0  # the block element at hand, open links, characters in links

    def path() -> int:
        return stack[-1][3] if stack else 0

    def close_block() -> None:
        nonlocal linked
        if text:
            raw = "".join(text)
            shown = _SPACE.sub(" ", unescape(raw)).strip()
            text.clear()
            if shown:
                bad, rank = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
                slot = _hash("slot", str(path()), leaf)
                token = _hash("text", str(slot), shown)
                tokens.append(token)
                blocks.append(Block(shown, bad, rank, 2 * linked > len(raw.strip()), token, slot, tuple(x[3] for x in stack)))
        linked = 0

    def put(part: str) -> None:
        nonlocal linked
        text.append(part)
        if links:
            linked += len(part.strip())

    at, raw_end = 0, None
    n = len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            put(html[at:])
            break
        if m.start() > at:
            put(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>"))
            elif m[0] == "<":
                put("<")
            continue
        name = name.lower()
        if m[1]:
            if name in BLOCK:
                close_block()
                leaf = ""
            links = max(0, links - (name == "a"))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close_block()
                    tokens.append(_hash("end", str(stack[k][3])))
                    del stack[k:], inner[k + 1 :]
                    break
            else:
                tokens.append(_hash("end", str(path()), name))
            continue
        if name in RAW:
            raw_end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            tokens.append(_hash("raw", str(path()), name))
            at = raw_end.end() if raw_end else n
            continue
        if name == "br":
            put(" ")
            continue
        links += name == "a"
        inside = bool(stack) and stack[-1][2] >= 2
        if name in BLOCK:
            close_block()
            leaf = f"{name} {m[3].strip()}"
        if name in SECTION and name not in VOID and not m[4]:
            bad, rank, sign = _section(name, m[3], inside)
            if name == "span" and not bad:
                continue
            close_block()
            leaf = ""
            up = stack[-1] if stack else ("", False, 0, 0)
            inner[-1][sign] = nth = inner[-1].get(sign, 0) + 1
            inner.append({})
            here = _hash("section", str(up[3]), sign, str(nth))
            stack.append((name, bad or up[1], max(rank, up[2]), here))
            sections[here] = (len(stack), max(rank, up[2]))
            tokens.append(here)
        else:
            tokens.append(_hash("tag", str(path()), name))
    close_block()
    return Page(tokens, blocks, sections)


def article(html: str | None, section: int | None = None, fixed: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """The article's blocks in page order; ``section`` and ``fixed`` (slots) are the host's template."""
    blocks = [b for b in read_page(html or "").blocks if not b.boilerplate]
    if section is not None:
        blocks = [b for b in blocks if section in b.sections] or blocks
    best = max((b.rank for b in blocks), default=0)
    blocks = [b for b in blocks if b.rank == best]
    return [b.text for b in blocks if b.slot not in fixed] or [b.text for b in blocks]


def _host(url: str = "url") -> F.Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: Kinds of token rows: tags, texts, and slots with the sections around them.
TAG, TEXT, SLOT = 0, 1, 2
_ROW = "host string, token long, kind int, slot long, chars long, depth int, rank int, sections array<long>, one long, two long"


def page_rows(page: Page, who: str) -> list[tuple]:
    """(token, kind, slot, chars, depth, rank, sections, and two hashes of the page and the token's count) of each token."""
    counts = Counter(page.tokens)
    texts = {b.token: b for b in page.blocks}
    out = []
    for t, n in counts.items():
        h = xxhash.xxh3_64_intdigest(f"{who} {n}")
        b = texts.get(t)
        depth, rank = page.sections.get(t, (-1, 0))
        own = (TEXT, b.slot, 0 if b.boilerplate or b.link else len(b.text) * n) if b else (TAG, None, 0)
        out.append((t, *own, depth, rank, None, h >> 33, h & 0x7FFFFFFF))
    return out + [(s, SLOT, s, 0, -1, 0, up, 0, 0) for s, up in {b.slot: b.sections for b in page.blocks}.items()]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["host", "token", "kind", "slot", "chars", "depth", "rank", "sections", "one", "two"]
    sign = lambda x: None if x is None else x - (1 << 64) if x >> 63 else x
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES):
            part = batch.slice(at, PAGES)
            hosts, rows = [], []
            for who, host, html in zip(*(part.column(c) for c in ("who", "host", "html"))):
                found = page_rows(read_page(html.as_py() or ""), str(who.as_py()))
                rows += found
                hosts += [host.as_py()] * len(found)
            token, kind, slot, chars, depth, rank, sections, one, two = zip(*rows) if rows else ((),) * 9
            yield pa.RecordBatch.from_arrays([
                pa.array(hosts, pa.string()), pa.array(map(sign, token), pa.int64()), pa.array(kind, pa.int32()), pa.array(map(sign, slot), pa.int64()), pa.array(chars, pa.int64()),
                pa.array(depth, pa.int32()), pa.array(rank, pa.int32()), pa.array([None if x is None else [sign(y) for y in x] for x in sections], pa.list_(pa.int64())),
                pa.array(one, pa.int64()), pa.array(two, pa.int64()),
            ], names)


def classes(tokens: DataFrame, sizes: DataFrame) -> DataFrame:
    """The tokens (host, token, kind, slot, chars, depth, rank) of valid equivalence classes, with the class (one, two, pages)."""
    common = tokens.where(f"kind <> {SLOT} AND pages >= 2").join(sizes, "host").where(F.col("pages") >= SUPPORT * F.col("n_pages"))
    vector = ["host", "one", "two", "pages"]
    valid = common.groupBy(*vector).agg(F.count("*").alias("n_tokens"), F.count_if(F.col("kind") == TAG).alias("n_tags")).where("n_tokens >= 2 AND n_tags >= 1")
    return common.join(valid.select(*vector), vector, "left_semi").select(*vector, "token", "kind", "slot", "chars", "depth", "rank")


def templates(pages: DataFrame) -> DataFrame:
    """host, the article's section (or null) and the fixed slots, of every host of two pages or more."""
    rows = pages.select(F.xxhash64("page_id", "url").alias("who"), _host().alias("host"), "html").where("host <> ''")
    sizes = materialise(rows.groupBy("host").agg(F.count("*").alias("n_pages")).where("n_pages >= 2"), "template-hosts", narrow=True)
    found = rows.mapInArrow(_occurrences, _ROW)
    tokens = found.groupBy("host", "token", "kind").agg(
        F.count("*").alias("pages"), F.sum("one").alias("one"), F.sum("two").alias("two"), F.sum("chars").alias("chars"), F.min("slot").alias("slot"),
        F.max("depth").alias("depth"), F.max("rank").alias("rank"), F.min("sections").alias("sections"),
    )
    tokens = materialise(tokens, "template-tokens")
    valid = materialise(classes(tokens, sizes), "template-classes")
    texts = tokens.where(f"kind = {TEXT}").groupBy("host", "slot").agg(F.sum("chars").alias("chars"), F.count("*").alias("n"))
    fixed = valid.where(f"kind = {TEXT}").groupBy("host", "slot").agg(F.sum("chars").alias("fixed_chars"), F.count("*").alias("n_fixed"))
    slots = texts.join(fixed, ["host", "slot"], "left").select("host", "slot", (F.col("chars") - F.coalesce("fixed_chars", F.lit(0))).alias("weight"), (F.col("n") == F.col("n_fixed")).alias("is_fixed"))
    slots = materialise(slots, "template-slots")
    inside = tokens.where(f"kind = {SLOT}").select("host", F.col("token").alias("slot"), "sections")
    weights = slots.where("weight > 0").join(inside, ["host", "slot"])
    sums = weights.select("host", "weight", F.explode("sections").alias("token")).groupBy("host", "token").agg(F.sum("weight").alias("weight"))
    total = weights.groupBy("host").agg(F.sum("weight").alias("total"))
    nodes = valid.where(f"kind = {TAG} AND depth >= 0").select("host", "token", "depth", "rank").join(sums, ["host", "token"]).join(total, "host").where(F.col("weight") >= MOST * F.col("total"))
    # These sections lie inside one another, as two that do not could not both have most of the weight.
    chosen = nodes.groupBy("host").agg(F.max_by("token", F.when(F.col("rank") == 2, 1_000_000 - F.col("depth")).otherwise(F.col("depth"))).alias("section"))
    set_ = slots.where("is_fixed").groupBy("host").agg(F.collect_set("slot").alias("fixed"))  # slots of the template
    return sizes.join(chosen, "host", "left").join(set_, "host", "left").select("host", "section", "fixed")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    known = materialise(templates(pages), "templates").where("section IS NOT NULL OR size(fixed) > 0").select(F.col("host").alias("_host"), "section", "fixed")
    weight = known.agg(F.sum(64 + F.length("_host") + 8 * F.greatest(F.size("fixed"), F.lit(0)))).first()[0] or 0
    rows = pages.select("page_id", "url", "html", _host().alias("_host"))
    if weight <= MAX_BROADCAST_BYTES:
        rows = rows.join(F.broadcast(known), "_host", "left")
    else:
        salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int")).join(salted, ["_host", "_salt"], "left")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, tuple] = {}
        for batch in found:
            for at in range(0, batch.num_rows, PAGES):
                part, texts = batch.slice(at, PAGES), []
                for html, host, section, fixed in zip(*(part.column(c) for c in ("html", "_host", "section", "fixed"))):
                    if (host := host.as_py()) not in sets:
                        if len(sets) >= 4 * PAGES:
                            sets.clear()
                        mask, one = (1 << 64) - 1, section.as_py()
                        sets[host] = (None if one is None else one & mask, frozenset(x & mask for x in fixed.as_py() or ()))
                    texts.append("\n\n".join(article(html.as_py(), *sets[host])))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = "page_id long, url string, text string"
    return rows.select("page_id", "url", "html", "_host", "section", "fixed").mapInArrow(batches, schema).withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


# The given pages have one article element each, with references that are listed here; SQL reads them by patterns alone.
_TEXT_SQL = "regexp_extract(coalesce(html, ''), '<article[^>]*>(.*)</article>', 1, 's')"
for _tag in ("<br */?>",):
    _TEXT_SQL = f"regexp_replace({_TEXT_SQL}, '{_tag}', ' ', 'g')"
_TEXT_SQL = f"regexp_replace({_TEXT_SQL}, '</?(p|h[1-6]|div|ul|ol|li|table|tr|td|blockquote|pre)( [^>]*)?>', chr(1), 'g')"
_TEXT_SQL = f"regexp_replace({_TEXT_SQL}, '</?[A-Za-z][^>]*>', '', 'g')"
for _name, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _TEXT_SQL = f"replace({_TEXT_SQL}, '{_name}', '{_char}')"
ORACLE = f"""
WITH p AS (SELECT page_id, url, list_transform(string_split({_TEXT_SQL}, chr(1)), lambda x: trim(regexp_replace(x, '[\\s\\v]+', ' ', 'g'))) AS parts FROM pages),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM p)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
