"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its tags, told apart by their path, and its text blocks with theirs. Over the
pages of one host every token has an occurrence vector (how often it stands on each page). Tokens
with equal vectors form an equivalence class. A class that has tags, and stands on at least
``LEAST_PAGES`` pages of different text, is valid: it is part of the host's template, the classes that stand on
fewer pages or repeat inside a page (list items and their links) nesting in the slots of those
that stand on all. Text blocks in a valid class are the template's own words and go; what is left
are the slots. This holds inside a marked article too: a licence line that the host puts into all
of its articles is a word of the template. Besides, slots inside menus, headers, footers, side
bars, notices, adverts, forms and comments go, told by their elements and the names they are
given, and if the page marks its article, only the slots inside it stay.

Vectors are never built: each task adds up one hash per token, and the sums over a host are
combined by token, so a host with a third of all pages is spread over all tasks. Pages do not
move by host either; the few template words of a host go to where its pages are.

Copies add the same to both vectors, so they change no class; they count as one page.

A block is what stands between block-level tags; ``br`` counts as white space.

Defined results: a null or empty html gives an empty text; a null url is a host of its own; markup
cut off at the end of a page is dropped, its text stays; repeated rows get equal rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import parts_of, row_blocks, stored, tuned, unpack
from auditlens.llm.text import column_bytes, mix, running, span_hash

LEAST_PAGES = 8
# Elements of HTML by their part in a page, and names that pages give to parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template iframe object svg math canvas select button textarea title head".split())
BOILERPLATE = set("nav footer aside form dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSED_BY_BLOCK = {"p"}
SAME_LEVEL = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "option": "option"}
PART_NAMES = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer "
    "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related "
    "recommended comment comments disqus reply replies respond widget toolbar pagination pager form".split()
)
# Words that may stand beside a part's name in a class or id without changing what it says.
NEUTRAL = set(
    "site page main top bottom left right global primary secondary wrapper wrap container content box bar block section area list item items inner outer "
    "header head links link icons icon buttons button posts panel slot unit widget js row col text title".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template|svg|math)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WHITE = re.compile(r"\s+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _names_part(name: str) -> bool:
    """Whether a class or id as a whole says that its element is no part of the article: all its
    words are names of parts, or neutral beside one. ``share-price`` says something else."""
    words = [w for w in _PARTS.split(_CAMEL.sub("-", name).lower()) if w and not w.isdigit()]
    return not PART_NAMES.isdisjoint(words) and all(w in PART_NAMES or w in NEUTRAL for w in words)


def _is_boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is no part of the article, and its name for paths."""
    if not attributes or "=" not in attributes:
        return tag in BOILERPLATE or (tag == "header" and not in_article), tag
    names, bad = [], tag in BOILERPLATE or (tag == "header" and not in_article)
    for kind, *values in _NAMED.findall(attributes):
        value = next(filter(None, values), "")
        if kind.lower() == "role":
            bad |= value.lower() in ROLES
        else:
            names.append(value)
            bad |= tag not in ("body", "html", "article", "main") and any(map(_names_part, value.split()))
    return bad, tag + "." + ".".join(names) if names else tag


def page_tokens(page: str) -> tuple[list[str], list[tuple[str, str, bool]]]:
    """Tags by their path, and text blocks outside boilerplate as (path, text, inside an article).

    Paths are digests of the path above and the element's name, so nesting may be of any depth.
    """
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, boilerplate, in article
    opened: Counter[str] = Counter()
    tags, blocks, words = [], [], []
    path, bad, article = "", False, False

    def flush():
        if words:
            text = _WHITE.sub(" ", entities.unescape("".join(words))).strip()
            words.clear()
            if text:
                blocks.append((path, text, article))

    def close(depth: int):
        nonlocal path, bad, article
        for gone, *_ in stack[depth:]:
            opened[gone] -= 1
        del stack[depth:]
        _, path, bad, article = stack[-1] if stack else ("", "", False, False)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not bad:
            words.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[1] is not None:
                tags.append(f"{path}/{m[1].lower()}")
            continue
        tag, whole = tag.lower(), m[0]
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            words.append(" ")
        if whole[1] == "/":
            for depth in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[depth][0] == tag:
                    tags.append(f"{stack[depth][1]}/.")
                    close(depth)
                    break
            continue
        if tag in VOID:
            tags.append(f"{path}/{tag}")
            continue
        if tag in BLOCKS or tag in SAME_LEVEL:
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = stack[depth][0]
                if open_tag in CLOSED_BY_BLOCK or open_tag in (tag, SAME_LEVEL.get(tag)) and tag in SAME_LEVEL:
                    close(depth)
                    break
                if open_tag in BLOCKS:
                    break
        silent, name = _is_boilerplate(tag, m[3], article)
        path = hashlib.blake2b(f"{path}/{name}".encode(), digest_size=8).hexdigest()
        bad = bad or silent or tag in SILENT
        article = article or (tag in ("article", "main") and not bad)
        stack.append((tag, path, bad, article))
        opened[tag] += 1
        tags.append(path)
    if at < len(page) and not bad:
        words.append(page[at:])
    flush()
    return tags, blocks


def _hashes(texts: list[str]) -> np.ndarray:
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    return span_hash(running(data), offsets[:-1], offsets[1:])


STAT_DDL = "kind int, host long, token long, total long, pages long, part int, texts array<long>"


def _vectors(pages: DataFrame, parts: int) -> DataFrame:
    """Added-up occurrence hashes of tags (kind 1) and text blocks (kind 2) per host, the latter
    with the first LEAST_PAGES different texts of their pages, and where the pages of a host are
    (kind 0)."""

    def scan(batches):
        sums: dict[tuple, list] = {}
        places = set()

        def rows():
            keys = [(k, *v) for k, v in sums.items()]
            columns = [[k[0][0] for k in keys] + [0] * len(places), [k[0][1] for k in keys] + [p[0] for p in places],
                       [k[0][2] for k in keys] + [0] * len(places), [k[1] for k in keys] + [0] * len(places),
                       [k[2] for k in keys] + [0] * len(places), [0] * len(keys) + [p[1] for p in places], [k[3] for k in keys] + [()] * len(places)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in STAT_DDL.split(", ")])

        for batch in batches:
            urls, htmls = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hosts = _hashes([host_of(u) for u in urls]).view(np.int64)
            page_hash = _hashes([h or "" for h in htmls])
            part = (mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            for i, page in enumerate(htmls):
                host = int(hosts[i])
                places.add((host, int(part[i])))
                tags, blocks = page_tokens(page or "")
                words = [f"{p}\0{t}" for p, t, _ in blocks]
                whole = int(_hashes(["\0".join(t for _, t, _ in blocks)]).view(np.int64)[0])
                for kind, texts in ((1, tags), (2, words)):
                    if not texts:
                        continue
                    token, n = np.unique(_hashes(texts), return_counts=True)
                    vector = mix(mix(np.full(len(token), page_hash[i])) + n.astype(np.uint64)).view(np.int64)
                    for t, v in zip(token.view(np.int64).tolist(), vector.tolist()):
                        have = sums.setdefault((kind, host, t), [0, 0, []])
                        have[0] = (have[0] + v + (1 << 63)) % (1 << 64) - (1 << 63)
                        have[1] += 1
                        if kind == 2 and len(have[2]) < LEAST_PAGES and whole not in have[2]:
                            have[2].append(whole)
            if len(sums) > 400_000:
                yield rows()
                sums.clear()
                places.clear()
        yield rows()

    return pages.mapInArrow(scan, STAT_DDL)


def template_words(stats: DataFrame) -> DataFrame:
    """(host, token): text blocks that share their occurrence vector with tags of their host, on
    enough pages of different text."""
    # sums of 64-bit hashes may wrap: they are added as two halves, which cannot
    half = lambda shift: F.sum(F.shiftrightunsigned("total", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    vectors = stats.filter("kind > 0").groupBy("kind", "host", "token").agg(half(0).alias("lo"), half(32).alias("hi"), F.sum("pages").alias("pages"))
    vectors = vectors.filter(F.col("pages") >= LEAST_PAGES).withColumn("vector", F.xxhash64((F.col("lo") + F.shiftleft("hi", 32)), "pages"))
    classes = vectors.filter("kind = 1").select("host", "vector").distinct()
    shared = stored(vectors.filter("kind = 2").join(classes, ["host", "vector"], "left_semi").select("host", "token"), "page-words")
    # a task keeps LEAST_PAGES different texts of a block, or all: enough of either to tell
    texts = stats.filter("kind = 2").join(shared, ["host", "token"]).select("host", "token", F.explode("texts").alias("text"))
    return texts.distinct().groupBy("host", "token").count().filter(F.col("count") >= LEAST_PAGES).select("host", "token")


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def main_text(page: str, template: np.ndarray) -> str:
    """Text of the slots of one page; ``template`` has the hashes of its host's own words."""
    _, blocks = page_tokens(page)
    if blocks and len(template):
        own = np.isin(_hashes([f"{p}\0{t}" for p, t, _ in blocks]).view(np.int64), template)
    else:
        own = np.zeros(len(blocks), bool)
    marked = any(inside for _, _, inside in blocks)
    return "\n".join(t for (_, t, inside), gone in zip(blocks, own) if not gone and (inside or not marked))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    spark = tuned(pages.sparkSession)
    parts = parts_of(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    keyed = pages.select(F.xxhash64("page_id", "url").alias("uid"), "url", "html")
    stats = stored(_vectors(keyed, parts), "page-vectors")
    places = stats.filter("kind = 0").select("host", "part").distinct()
    words = template_words(stats).join(places, "host").select("part", "host", "token")
    sent = words.groupBy("part").agg(F.collect_list(F.struct("host", "token")).alias("words"))
    blocks = row_blocks(pages.select(F.xxhash64("page_id", "url").alias("uid"), "page_id", "url", "html"), parts)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        template: dict[int, list[int]] = {}
        for listed in right.column("words").to_pylist():
            for w in listed:
                template.setdefault(w["host"], []).append(w["token"])
        known = {h: np.array(t, np.int64) for h, t in template.items()}
        none = np.zeros(0, np.int64)
        got = unpack(left.column("block"))
        if got is None:
            return RESULT.empty_table()
        urls = got.column("url").to_pylist()
        hosts = _hashes([host_of(u) for u in urls]).view(np.int64).tolist()
        texts = [main_text(h.as_py() or "", known.get(host, none)) for h, host in zip(got.column("html"), hosts)]
        columns = [got.column("page_id").combine_chunks(), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.Table.from_arrays(columns, schema=RESULT)

    ddl = "page_id long, url string, text string, n_chars long"
    return blocks.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(work, ddl)
