"""Main text of web pages by equivalence-class template deduction (EXALG, Arasu and
Garcia-Molina 2003).

1. Tokens are a page's tags, told apart by their element path, and its texts: the whole
   text of a block, and a link at a block's begin or end.  Per host and token Spark sums a
   hash of (page, number of occurrences) over the distinct pages: tokens with equal sums
   have equal occurrence vectors and form an equivalence class.
2. A class is valid if it has two tokens or more (a text counts as two, its begin and its
   end) and is on at least ``share`` of the host's pages (two pages at least, three for
   texts).  The valid classes that occur once a page make the template, ordered by
   position; classes that repeat nest in its slots.  On a page the longest run of template
   tags in the template's order counts; tags out of order are passed over.
3. A page's slots are the stretches between template tags of container elements and
   template texts.  Texts of the template go, once or repeated, unless they are over half
   of a page's text (a copy of other pages, which keeps them).
4. A slot is told by the template tag on its left and judged by its figures over all the
   host's distinct pages: characters a page, the share of them in links, and how many
   different texts it has.  The slot with most characters that are no links is the main one.
   Another goes if most of its text is links, or if it stands beside the main slot's element
   (neither in it nor around it) and either its texts come on two pages or more on average or
   it has a tenth of the main slot's characters a page or less.  Hosts of under ``SLOT_PAGES``
   distinct pages are not judged so.  Headings stay.
5. On each page a slot whose text is mostly links goes, except headings; a page of links only
   keeps them.  Last come the lists: if article and main elements hold more than half of the
   text left, they delimit it, and menus, headers, footers, sidebars, notices, adverts, forms
   and comments are left out, by element or by the words of class, id and role.

Text: character references decoded, white space inside a block becomes one space, ends
trimmed, blocks in page order joined by a line feed.  Defined cases: a null or empty page
gives an empty text; a null url counts as the empty host; a host of one page has no
template and its containers delimit the slots; unclosed and misnested elements are closed
as their parents end; repeated rows give a row each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .op2_url_filter import with_parts

SHARE = 0.5
#: Two pages that share a text may be copies of each other.
TEXT_PAGES = 3
#: Fewer distinct pages say too little about a slot.
SLOT_PAGES = 5
SIDE_SHARE = 0.1

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
DROP = frozenset("nav header footer aside form script style head title noscript iframe template select button textarea menu dialog svg canvas object".split())
BLOCK = frozenset("address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li "
                  "main ol p pre section summary table tbody td tfoot th thead tr ul".split()) | DROP
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Text that no reader sees, whatever the template.
UNSEEN = RAW - {"xmp"} | {"head"}
CONTAINER = frozenset("html body div section article main td nav header footer aside form".split())
_DROP_WORD = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|header|footer|sidebar|side|aside|notices?|cookies?|consent|"
                        r"popup|modal|newsletter|subscribe|share|sharing|social|related|comments?|reply|replies|respond|disqus|login|search|toolbar|pagination|"
                        r"complementary|contentinfo|navigation|alert)(?:$|[^a-z])")


def events(page: str):
    """(kind, name, attributes, text) in page order: kind is 'open', 'close' or 'text'."""
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            yield "text", "", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", "", page[at: m.start()]
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, attrs = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            yield "close", name, "", ""
            continue
        yield "open", name, attrs, ""
        if name in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else n


def is_boilerplate(name: str, attrs: str) -> bool:
    if name in DROP:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    return any(_DROP_WORD.search((a or b or c).lower()) for _, a, b, c in _NAMED.findall(attrs))


def role(name: str, attrs: str) -> str:
    """What tells elements of one name apart: class, else id, without numbers of three digits or more."""
    if name not in ("div", "section", "td") or not attrs:
        return ""
    named = {k.lower(): (a or b or c).lower() for k, a, b, c in _NAMED.findall(attrs)}
    return re.sub(r"(?:[^a-z0-9]|[0-9]{3,})+", ".", "." + (named.get("class") or named.get("id") or "")).rstrip(".")


def walk(page: str):
    """Events with the open elements kept: (kind, name, path, on a list, text).  Each
    element's path is its names from the root; a start tag that a block ends closes <p>."""
    stack: list[tuple[str, str, bool]] = []
    unseen = 0
    for kind, name, attrs, text in events(page):
        if name in UNSEEN and not attrs.rstrip().endswith("/"):
            unseen = max(0, unseen + (1 if kind == "open" else -1))
        if name in ("body", "article", "main"):
            unseen = 0  # an unclosed head ends here
        if kind == "text":
            if unseen:
                continue
            yield kind, "", stack[-1][1] if stack else "", bool(stack) and stack[-1][2], text
        elif kind == "open":
            if name in BLOCK and name != "br" and stack and stack[-1][0] == "p":
                stack.pop()
            path = f"{stack[-1][1] if stack else ''}/{name}{role(name, attrs)}" if name in CONTAINER or name in DROP else (stack[-1][1] if stack else "")
            drop = (bool(stack) and stack[-1][2]) or is_boilerplate(name, attrs)
            yield kind, name, path, drop, ""
            if name not in VOID and not attrs.rstrip().endswith("/"):
                stack.append((name, path, drop))
        else:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if k is None:
                yield kind, name, stack[-1][1] if stack else "", bool(stack) and stack[-1][2], ""
                continue
            yield kind, name, stack[k][1], stack[k][2], ""
            del stack[k:]


def token(kind: str, name: str, path: str) -> str:
    return ("/" if kind == "close" else "") + name + "|" + path


def flat(parts: list[tuple[str, int]]) -> str:
    return " ".join("".join(t for t, _ in parts).split())


def content(page: str) -> tuple[list[tuple[str, bool]], list[tuple]]:
    """Tags (token, is a container) and blocks (tags before it, path, inside an article, is
    a heading, on a list, parts) of a page; a part is (text, number of its link or 0)."""
    tags: list[tuple[str, bool]] = []
    blocks: list[tuple] = []
    article, link, heading = 0, 0, False
    open_block: dict[bool, list] = {}
    for kind, name, path, drop, text in walk(page):
        if kind == "text":
            if drop not in open_block:
                open_block[drop] = []
                blocks.append((len(tags), path, article > 0, heading, drop, open_block[drop]))
            open_block[drop].append((entities.unescape(text), link))
            continue
        if name in BLOCK:
            open_block, heading = {}, kind == "open" and name in HEADING
        if name == "a" or name in CONTAINER:
            link = len(tags) + 1 if kind == "open" and name == "a" else 0
        if name in ("article", "main") and not drop:
            article = max(0, article + (1 if kind == "open" else -1))
        tags.append((token(kind, name, path), name in CONTAINER))
    return tags, blocks


def text_token(kind: str, text: str, path: str) -> str:
    return f"#{kind}{hashlib.blake2b(text.encode('utf-8', 'replace'), digest_size=8).hexdigest()}|{path}"


def end_link(parts: list[tuple[str, int]], last: bool) -> tuple[str, list[tuple[str, int]]]:
    """Text of the link at the begin or end of a block ('' if there is none), and the rest."""
    step = -1 if last else 1
    run = parts[::step]
    lead = next((i for i, (t, _) in enumerate(run) if t.strip()), len(run))
    run = run[lead:]
    if not run or not run[0][1]:
        return "", parts
    n = next((i for i, (_, k) in enumerate(run) if k != run[0][1]), len(run))
    return flat(run[:n][::step]), run[n:][::step]


def page_tokens(page: str) -> dict[str, tuple[int, int]]:
    """token -> (occurrences, first position) for the tags and texts of a page."""
    tags, blocks = content(page)
    out: dict[str, list[int]] = {}
    for at, (t, _) in enumerate(tags):
        out.setdefault(t, [0, at])[0] += 1
    for at, path, _, _, _, parts in blocks:
        text = flat(parts)
        if not text:
            continue
        out.setdefault(text_token("", text, path), [0, at])[0] += 1
        for link in {end_link(parts, False)[0], end_link(parts, True)[0]} - {"", text}:
            out.setdefault(text_token("a", link, path), [0, at])[0] += 1
    return {k: tuple(v) for k, v in out.items()}


def _tokens_fn(batches):
    for b in batches:
        host, key, page = b.column("host"), b.column("key"), b.column("html")
        rows: tuple[list, ...] = ([], [], [], [], [])
        for i in range(b.num_rows):
            for t, (n, at) in page_tokens(page[i].as_py() or "").items():
                for c, v in zip(rows, (host[i].as_py(), key[i].as_py(), t, n, at)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32()))],
                                         names=["host", "key", "token", "n", "at"])


def deduce_templates(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, template): tokens of the valid classes with one occurrence a page, in page
    order, with their class; and the repeated classes nested between them.  Pages of equal
    ``key`` count once."""
    tok = pages.select("host", "key", "html").mapInArrow(_tokens_fn, "host string, key long, token string, n int, at int")
    tok = tok.groupBy("host", "key", "token").agg(F.min("n").alias("n"), F.min("at").alias("at"))
    vec = tok.groupBy("host", "token").agg(F.sum(F.xxhash64("key", "n").cast("decimal(38,0)")).alias("vector"), F.count(F.lit(1)).alias("support"),
                                           F.min("n").alias("least"), F.max("n").alias("most"), F.avg("at").alias("at"))
    vec = C.stored(vec.where("support > 1"), "op10-tokens")
    count = pages.select("host", "key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    is_text = F.col("token").startswith("#")
    cls = vec.groupBy("host", "vector", "support").agg(F.sum(F.when(is_text, 2).otherwise(1)).alias("size"))
    good = cls.join(count, "host").where((F.col("size") > 1) & (F.col("support") >= F.greatest(F.lit(2.0), F.col("pages") * share)))
    kept = vec.join(good.select("host", "vector", "support"), ["host", "vector", "support"]) \
        .where(~is_text | (F.col("support") >= TEXT_PAGES))
    return kept.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
        "at", "token", F.xxhash64("vector", "support").alias("class"), (F.col("most") == 1).alias("once")))).alias("template"))


def in_order(ranks: list[int]) -> list[int]:
    """Indices of the longest rising subsequence."""
    tails, last, before = [], [], []
    for i, r in enumerate(ranks):
        k = bisect_left(tails, r)
        before.append(last[k - 1] if k else -1)
        tails[k:k + 1], last[k:k + 1] = [r], [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def own_text(path: str, parts: list[tuple[str, int]], texts: frozenset[str]) -> list[tuple[str, int]]:
    """A block's parts without the template's texts."""
    if text_token("", flat(parts), path) in texts:
        return []
    for last in (False, True):
        while True:
            link, rest = end_link(parts, last)
            if not link or text_token("a", link, path) not in texts:
                break
            parts = rest
    return parts


def slot_lines(page: str, order: dict[str, int] | None, texts: frozenset[str], lists: bool) -> tuple[list[tuple], int]:
    """Lines (slot's left tag in the template or -1, slot of the page, inside an article, is
    a heading, on a list, text, characters of it in links) of a page without the template's
    texts, and the characters before those went."""
    tags, blocks = content(page)
    bounds = [i for i, (t, box) in enumerate(tags) if box and (order is None or t in order)]
    if order is not None:
        bounds = [bounds[k] for k in in_order([order[tags[i][0]] for i in bounds])]
    lines, extra, whole = [], 0, 0
    for at, path, inside, heading, listed, parts in blocks:
        text = flat(parts)
        if not text:
            continue
        whole += len(text) * (not (lists and listed))
        if texts:
            parts = own_text(path, parts, texts)
            text = flat(parts)
        if text:
            k = bisect_left(bounds, at)
            left = order[tags[bounds[k - 1]][0]] if order is not None and k else -1
            lines.append((left, k + extra, inside, heading, listed, text, sum(len(" ".join(t.split())) for t, n in parts if n)))
        else:
            extra += 1
    return lines, whole


def main_text(page: str, order: dict[str, int] | None = None, texts: frozenset[str] = frozenset(), side: frozenset[int] = frozenset(),
              lists: bool = True) -> str:
    """Main text of a page given its template: the places of the once-a-page tags (None: no
    template), the texts, and the left tags of the slots judged to be beside the main text.
    ``lists`` False leaves out the last step, the lists and the article rule."""
    lines, whole = slot_lines(page, order, texts, lists)
    if texts and 2 * sum(len(x[5]) for x in lines if not (lists and x[4])) < whole:
        return main_text(page, order, frozenset(), side, lists)
    lines = [x for x in lines if (x[0] not in side or x[3]) and not (lists and x[4])]
    size: dict[int, list[int]] = {}
    for x in lines:
        n = size.setdefault(x[1], [0, 0])
        n[0] += len(x[5])
        n[1] += x[6]
    kept = [x for x in lines if (lists and x[2]) or x[3] or 2 * size[x[1]][1] <= size[x[1]][0]] or lines
    article = [x for x in kept if x[2]]
    if lists and 2 * sum(len(x[5]) for x in article) > sum(len(x[5]) for x in kept):
        kept = article
    return "\n".join(x[5] for x in kept)


def _parts(template) -> tuple[dict[str, int], frozenset[str]]:
    """A template's tags with their places, and its texts."""
    tags = [x for x in template if not x.startswith("#")]
    return {x: n for n, x in enumerate(tags)}, frozenset(x for x in template if x.startswith("#"))


def _slots_fn(batches):
    for b in batches:
        host, key, page, template = (b.column(k) for k in ("host", "key", "html", "template"))
        known: dict[tuple, tuple] = {}
        rows: tuple[list, ...] = ([], [], [], [], [], [])
        for i in range(b.num_rows):
            t = tuple(template[i].as_py())
            if t not in known:
                known[t] = _parts(t)
            slots: dict[int, list] = {}
            for left, _, _, _, _, text, linked in slot_lines(page[i].as_py() or "", *known[t], lists=False)[0]:
                slots.setdefault(left, []).append((text, linked))
            for left, x in slots.items():
                sign = hashlib.blake2b("\n".join(a for a, _ in x).encode("utf-8", "replace"), digest_size=16).hexdigest()
                for c, v in zip(rows, (host[i].as_py(), key[i].as_py(), left, sum(len(a) for a, _ in x), sum(n for _, n in x), sign)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            names=["host", "key", "slot", "chars", "linked", "sign"])


def judge_slots(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, side): the slots beside the main text, by their left tag, from their figures
    over the host's distinct pages.  ``templates`` has host and template (tokens)."""
    seen = pages.join(templates, "host").select("host", "key", "html", "template") \
        .mapInArrow(_slots_fn, "host string, key long, slot int, chars long, linked long, sign string").dropDuplicates(["host", "key", "slot"])
    stats = seen.groupBy("host", "slot", "sign").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")) \
        .groupBy("host", "slot").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    stats = C.stored(stats, "op10-slots")
    # the element a slot's text stands in: a start tag's own, an end tag's parent
    tags = templates.select("host", F.filter("template", lambda t: ~t.startswith("#")).alias("tags"))
    tag = F.when(F.col("slot") >= 0, F.get("tags", F.col("slot"))).otherwise("|")
    path = F.substring_index(tag, "|", -1)
    stats = stats.join(tags, "host").select("host", "slot", "n", "texts", "chars", "linked",
                                            F.when(tag.startswith("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(path).alias("path"))
    count = pages.select("host", "key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= SLOT_PAGES)
    best = stats.groupBy("host").agg(F.max(F.struct((F.col("chars") - F.col("linked")).alias("own"), (-F.col("slot")).alias("first"),
                                                    F.col("path").alias("path"), (F.col("chars") / F.col("n")).alias("mean"))).alias("best"))
    main, root = F.col("best.path"), "^(/html)?(/body)?$"
    near = (F.col("path") == main) | (~main.rlike(root) & F.col("path").startswith(F.concat(main, F.lit("/")))) \
        | (~F.col("path").rlike(root) & main.startswith(F.concat(F.col("path"), F.lit("/"))))
    beside = ~near & ((2 * F.col("texts") <= F.col("n")) | (F.col("chars") / F.col("n") <= SIDE_SHARE * F.col("best.mean")))
    return stats.join(best, "host").join(count, "host").where((F.col("slot") != -F.col("best.first")) & ((2 * F.col("linked") > F.col("chars")) | beside)) \
        .groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias("side"))


def _extract_fn(lists: bool):
    def fn(batches):
        for b in batches:
            page, template, side, texts = b.column("html"), b.column("template"), b.column("side"), []
            known: dict[tuple, tuple] = {}
            for i in range(b.num_rows):
                t = template[i].as_py()
                if t is None:
                    texts.append(main_text(page[i].as_py() or "", lists=lists))
                    continue
                key = tuple(t)
                if key not in known:
                    known[key] = *_parts(key), frozenset(side[i].as_py() or ())
                texts.append(main_text(page[i].as_py() or "", *known[key], lists=lists))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["id", "url", "text", "n_chars"])
    return fn


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = SHARE, template: bool = True,
            lists: bool = True) -> DataFrame:
    """id, url, text, n_chars for every page.  ``template`` and ``lists`` False leave that
    part out, to see what it decides."""
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    src = with_parts(src).drop("path").withColumn("key", F.xxhash64("html"))
    if template:
        templates = deduce_templates(src, share).select("host", F.transform(F.filter("template", lambda t: t["once"] | t["token"].startswith("#")), lambda t: t["token"]).alias("template"))
        templates = C.stored(templates, "op10-templates")
        known = C.stored(templates.join(judge_slots(src, templates), "host", "left"), "op10-judged")
        out = src.join(known, "host", "left")
    else:
        out = src.withColumn("template", F.lit(None).cast("array<string>")).withColumn("side", F.lit(None).cast("array<int>"))
    kind = src.schema["id"].dataType.simpleString()
    return out.select("id", "url", "html", "template", "side").mapInArrow(_extract_fn(lists), f"id {kind}, url string, text string, n_chars long")


def op10_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: main text of every page."""
    return extract(C.read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
