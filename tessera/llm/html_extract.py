"""HTML extraction by consensus host paths.

Every page is parsed once into runs of text blocks, each under the generalised
tag-class path of its container (digits in names become ``N``).  Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out by tag, role or class name.  Containers are scored by the
text outside links that they hold; from the body, the page descends while one
child container holds most of the score and no heading is lost, and never below
an ``article``.  That is the page's vote.  Spark sums the votes of each host
and of each template of a host (its pages with the same set of container
paths).  A page is re-extracted with the host's winning path if that holds
``SHARE`` of what the page's own vote holds and all its headings; if not, with
its template's winning path, which mends pages whose own vote was misled; and
where no two pages of the template agree, with its own vote.  Pages without a
host have nobody to agree with and keep their own vote.
"""

from __future__ import annotations

import hashlib
import html
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.url_filter import host_and_path

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|math|select|object|canvas|audio|video|xmp)"
    r"(?=[\s/>])(?:(?:(?<=<svg)|(?<=<math))(?>[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+(?<=/)>"  # closed by its start tag
    r"|(?>[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?>[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.I | re.S)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("body div section article main td center".split())
#: Tags that a start tag closes when they are open, up to the nearest of the tags after it.
CLOSES = {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
P_KEEPS = frozenset("button td th caption table object".split())
LEFT_OUT_TAGS = frozenset("head nav footer aside form dialog menu button fieldset label".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
LEFT_OUT_NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer sidebar widget widgets ad ads advert adverts "
    "advertisement advertisements advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist reply replies respond discussion disqus pagination pager toolbar copyright "
    "skip".split())
HEADERS = frozenset("header head top".split())
#: These are left out even when they hold an article.
ALWAYS = frozenset("comment comments commentlist reply replies respond discussion disqus related recommended recommendations widget widgets".split())
NOT_A_NAME = frozenset("has with no without single open".split())
WHOLE = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2".split())
SHARE = 2 / 3


def words_of_name(name: str) -> list[str]:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower()
    return [w for w in re.split(r"[^a-z0-9]+", spaced) if w]


def left_out(tag: str, attrs: dict[str, str], in_article: bool) -> str:
    """Why an element is not part of the article, or an empty string."""
    if tag in LEFT_OUT_TAGS or tag == "header" and not in_article:
        return tag
    if attrs.get("role", "").lower() in LEFT_OUT_ROLES:
        return "role"
    if tag in ("html", "body"):
        return ""
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        words = words_of_name(name)
        if not words or NOT_A_NAME & set(words):
            continue
        hit = [w for w in words if w in LEFT_OUT_NAMES and (tag not in WHOLE or w in ALWAYS)]
        if hit:
            return next((w for w in hit if w in ALWAYS), hit[0])
        if not in_article and tag not in WHOLE and words[-1] in HEADERS:
            return "header"
    return ""


def step(tag: str, attrs: dict[str, str]) -> str:
    """One step of a generalised path."""
    names = attrs.get("class", "").split() or attrs.get("id", "").split()
    return ".".join([tag, *(re.sub(r"[0-9]+", "N", n).replace("/", "_") for n in sorted(names))])


def parse(page: str) -> list[tuple[str, str, int, bool]]:
    """``(container path, text, characters outside links, is a heading)`` of the blocks in page order."""
    blocks: list[tuple[str, str, int, bool]] = []
    # open elements: tag, container path, why it is left out, in an article, in a link
    stack: list[tuple[str, str, str, bool, bool]] = [("", "", "", False, False)]
    parts: list[str] = []
    plain = heading = 0

    def flush():
        nonlocal plain, heading
        if not parts:
            return
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((stack[-1][1], text, min(plain, len(text)), bool(heading)))
        parts.clear()
        plain = heading = 0

    def close(depth: int):
        if any(x[0] in BLOCKS for x in stack[depth:]):
            flush()
        del stack[depth:]

    def add(piece: str):
        nonlocal plain, heading
        if piece and not stack[-1][2]:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            plain += 0 if stack[-1][4] else len(piece)
            heading |= any(x[0] in HEADINGS for x in stack[-3:])

    at = 0
    for m in MARKUP.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        raw, end, tag, written = m.groups()
        if tag is None:
            if raw:
                add(" ")
            continue
        tag = tag.lower()
        if end:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][0] in WHOLE and tag not in BLOCKS:
                    break
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                add(" ")
            continue
        if tag in BLOCKS:
            flush()
            shut, stop = CLOSES.get(tag, ({"p"}, P_KEEPS))
            first = 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in stop:
                    break
                if stack[depth][0] in shut:
                    first = depth
            if first:
                close(first)
        _, path, why, in_article, in_link = stack[-1]
        attrs = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(written)} if "=" in written else {}
        if tag in ("article", "main") and why not in ALWAYS:
            why = left_out(tag, attrs, True)
        else:
            why = why or left_out(tag, attrs, in_article)
        if tag in CONTAINERS:
            path += "/" + step(tag, attrs)
        stack.append((tag, path, why, in_article or tag in ("article", "main"), in_link or tag == "a"))
    add(page[at:])
    flush()
    return blocks


def under(path: str, top: str) -> bool:
    return path == top or path.startswith(top + "/")


def vote(blocks: list[tuple[str, str, int, bool]]) -> str | None:
    """The path of the container that holds the article, as this page sees it."""
    held, headings = {}, set()
    for path, _, plain, heading in blocks:
        steps = path.split("/")
        for i in range(1, len(steps) + 1):
            top = "/".join(steps[:i])
            held[top] = held.get(top, 0) + plain
        if heading:
            headings.add(path)
    if not held:
        return None
    top = ""
    while not top.rsplit("/", 1)[-1].startswith("article"):
        below = [p for p in held if p.startswith(top + "/") and "/" not in p[len(top) + 1:] and held[p] >= SHARE * held[top]]
        if not below:
            break
        child = max(below, key=lambda p: (held[p], p))
        inside = child.rsplit("/", 1)[-1].startswith(("article", "main", "body"))
        if not inside and any(under(h, top) and not under(h, child) for h in headings):
            break
        top = child
    return top


def runs_of(blocks: list[tuple[str, str, int, bool]]) -> list[tuple[str, str]]:
    """Neighbouring blocks of one container, joined by a newline."""
    runs: list[tuple[str, list[str]]] = []
    for path, text, _, _ in blocks:
        if runs and runs[-1][0] == path:
            runs[-1][1].append(text)
        else:
            runs.append((path, [text]))
    return [(p, "\n".join(t)) for p, t in runs]


def weights_of(blocks: list[tuple[str, str, int, bool]]) -> list[tuple[int, bool]]:
    """For each run the characters outside links and whether a heading is in it."""
    runs = [list(found) for _, found in groupby(blocks, key=lambda b: b[0])]
    return [(sum(b[2] for b in found), any(b[3] for b in found)) for found in runs]


def template_of(blocks: list[tuple[str, str, int, bool]]) -> str:
    """Digest of the set of container paths that hold text."""
    return hashlib.md5("\n".join(sorted({b[0] for b in blocks})).encode("utf-8", "surrogatepass")).hexdigest()


RUN = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("plain", pa.int64()), ("heading", pa.bool_())]))


def parsed(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """``page_id, url, host, runs, vote, template`` of every page."""
    id_type = pages.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            runs, votes, templates = [], [], []
            for text in batch.column(3).to_pylist():
                blocks = parse(text or "")
                runs.append([{"path": p, "text": t, "plain": n, "heading": h} for (p, t), (n, h) in zip(runs_of(blocks), weights_of(blocks))])
                votes.append(vote(blocks))
                templates.append(template_of(blocks))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(runs, RUN), pa.array(votes, pa.string()), pa.array(templates, pa.string())],
                names=["page_id", "url", "host", "runs", "vote", "template"])

    source = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host_and_path(F.col(url))[0].alias("host"), page)
    return source.mapInArrow(run, f"page_id {id_type}, url string, host string, "
                                  "runs array<struct<path:string,text:string,plain:long,heading:boolean>>, vote string, template string")


def winning_paths(votes: DataFrame) -> DataFrame:
    """``host, template, top, near`` for the templates of each host: the path with
    most votes of the host, and that of the template if it has two votes; of
    equal ones the longer, then the smaller."""
    counted = votes.where("vote is not null and host <> ''").groupBy("host", "template", "vote").agg(F.count("*").alias("n"))
    counted = staged(counted, "votes")
    most = F.max_by("vote", F.struct("n", F.length("vote"), "vote"))
    hosts = counted.groupBy("host", "vote").agg(F.sum("n").alias("n")).groupBy("host").agg(most.alias("top"))
    near = counted.groupBy("host", "template").agg(most.alias("near"), F.max("n").alias("n"))
    return (near.join(hosts.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"))
                .select("host", "template", "top", F.when(F.col("n") > 1, F.col("near")).alias("near")))


def is_under(path: Column, top: Column) -> Column:
    return (path == top) | F.startswith(path, F.concat(top, F.lit("/")))


def text_under(runs: str, top: Column) -> Column:
    inside = F.filter(runs, lambda r: is_under(r["path"], top))
    return F.array_join(F.transform(inside, lambda r: r["text"]), "\n")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars, host, path``.

    ``text`` is the article: character references decoded, white space inside a
    block as one space, blocks in page order joined by a newline; empty if the
    page has none (null and empty pages included).  A null url has an empty
    host, whose pages don't vote together.  Repeated rows vote once each.  An
    empty table gives an empty result; other columns are not read.

    Pages are parsed once; votes are partial counts before the shuffle, and a
    host with a third of all pages is a hot join key that AQE splits.
    """
    table = staged(parsed(pages, key, url, page), "parsed")
    winners = staged(winning_paths(table), "winners").withColumnRenamed("host", "_host").withColumnRenamed("template", "_template")
    joined = table.join(winners, (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")), "left")
    own = joined.withColumn("own", F.filter("runs", lambda r: is_under(r["path"], F.col("vote"))))
    held = F.aggregate("own", F.lit(0).cast("long"), lambda n, r: n + r["plain"])
    shared = F.aggregate("own", F.lit(0).cast("long"), lambda n, r: n + F.when(is_under(r["path"], F.col("top")), r["plain"]).otherwise(0))
    beheaded = F.exists("own", lambda r: r["heading"] & ~is_under(r["path"], F.col("top")))
    fits = (shared >= SHARE * held) & ~beheaded & F.exists("runs", lambda r: is_under(r["path"], F.col("top")))
    path = F.when(fits, F.col("top")).otherwise(F.coalesce("near", "vote"))
    found = own.select("page_id", "url", "host", "runs", path.alias("path"))
    found = found.select("page_id", "url", "host", "path", F.coalesce(text_under("runs", F.col("path")), F.lit("")).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "host", "path")
