"""HTML extraction by templates deduced from the pages of a host.

1. A page is read into tokens: opening and closing tags of its structural elements, each with
   the path of elements around it, and its blocks of text with theirs. For every host and
   token the occurrence vector (how often the token is on each page) is summed up to a
   fingerprint and a count of pages; sums combine before they are shuffled, so a host with
   very many pages is no special case.
2. Tokens of a host with the same occurrence vector form an equivalence class. A class is valid
   where it holds the opening and the closing token of an element, on most pages of
   the host. Valid elements nest by their paths: that is the template, and what lies
   directly in each element is a slot. A block on most pages of a host is constant; all
   others vary. Where no block varies (copies of one page), none counts as constant.
3. The article is an ``article`` or ``main`` of the template, else the smallest element around
   all slots whose text varies. Where that is the body or no element, each
   outermost slot below it is an article.
4. A page's text is its article, or without an ``article`` or ``main`` all blocks but the constant
   ones outside the article, a line for each block. Nothing that varies is outside.

Left out in any case, by meaning: menus, headers, footers, sidebars, scripts, styles and hidden
elements, by their tags and roles (``LEFT_OUT``, ``LEFT_OUT_ROLES``). Forms and elements with a class or
id of adverts, notices, comments and the like (``LEFT_OUT_NAMES``) are left out unless they
hold more than half of what varies on the host; an h1 in one stays if it varies. Class words
say nothing about html, body, main, article and headings.

A page without that element, or alone on its host, gives a template by itself. White space in a
block becomes one space, character references are decoded. A null html is an empty
page, whose text is empty. A null url makes a host of its own. Repeated rows are extracted
each, and count as pages each. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm.tables import kept
from billsift.llm.texts import mix

BROADCAST_HOSTS = 200_000
BROADCAST_BLOCKS = 2_000_000  # constant blocks of all hosts
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_READ = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
_WORD = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[>!^\x01]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
STRUCTURE = frozenset(
    "html body main article section nav header footer aside div form ul ol table dialog details figure".split()
)
BLOCKS = STRUCTURE | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dl dt dd tr td th tbody thead caption blockquote pre address br hr figcaption summary head title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")}
LEFT_OUT = frozenset("head nav header footer aside button select dialog menu object canvas".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar note".split())
LEFT_OUT_NAMES = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner "
    "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup login share sharing social related recommended "
    "breadcrumb breadcrumbs pagination pager comment comments respond reply replies disqus widget toolbar search form masthead".split()
)
UNNAMED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())  # class words say nothing about these
SIBLINGS = frozenset("li dt dd tr td th".split())


class Element:
    """``around`` is the text before an inline element that may be left out."""

    __slots__ = ("name", "path", "out", "around")

    def __init__(self, name: str, path: str, out: bool, around: list[str] | None = None):
        self.name, self.path, self.out, self.around = name, path, out, around


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if "=" in text or "hidden" in text.lower():
        for m in _ATTRIBUTE.finditer(text):
            name = m[1].lower()
            if name in _READ:
                found.setdefault(name, (m[2] or "").strip("\"'"))
    return found


def _is_left_out(name: str, attributes: dict[str, str]) -> bool:
    if name in LEFT_OUT:
        return True
    if not attributes:
        return False
    return attributes.get("role", "").lower() in LEFT_OUT_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"


def _is_named_so(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is a form, or its class or id says advert, notice, comment and the like."""
    if name == "form":
        return True
    if name in UNNAMED or not attributes:
        return False
    names = _CAMEL.sub(" ", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower()
    return not LEFT_OUT_NAMES.isdisjoint(_WORD.findall(names))


def read_page(html: str, stay: frozenset[str] = frozenset()) -> tuple[list[tuple[str, str]], list[str]]:
    """Blocks of text that are not left out by tag or role, each with its path, and all structural tokens.

    In a path, ! ends an element left out by its name unless it is in ``stay``, and ^ an h1.
    """
    blocks: list[tuple[str, str]] = []
    tokens: list[str] = []
    stack = [Element("", "", False)]
    buffer: list[str] = []
    at = 0

    def flush() -> None:
        if buffer:
            text = "".join(buffer)
            buffer.clear()
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((stack[-1].path, text))

    def close(depth: int) -> None:
        """Close all elements from a depth on; an inline one gives back the text around it."""
        while len(stack) > depth:
            around = stack[-1].around
            if around is not None:
                flush()
                buffer.extend(around)
            elif stack[-1].name in BLOCKS:
                flush()
            stack.pop()

    while True:
        tag = _TAG.search(html, at)
        if not stack[-1].out:
            buffer.append(html[at : tag.start() if tag else len(html)])
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        if tag[1] or tag[4]:
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    if name in STRUCTURE:
                        tokens.append(f"/{stack[depth].path}")
                    close(depth)
                    break
                if stack[depth].name in STRUCTURE and name not in STRUCTURE:
                    break
            continue
        if name in BLOCKS:
            flush()
            if stack[-1].name == "p" or stack[-1].name == name and name in SIBLINGS:
                close(len(stack) - 1)
        if name in RAW:
            end = RAW[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in VOID:
            continue
        attributes = _attributes(tag[3] or tag[6] or "")
        out = stack[-1].out or _is_left_out(name, attributes)
        named = not out and _is_named_so(name, attributes)
        path = stack[-1].path
        if named or name in STRUCTURE:
            label = name
            if attributes:
                label += "".join(f".{w}" for w in attributes.get("class", "").split()[:1]) + "".join(f"#{w}" for w in attributes.get("id", "").split()[:1])
                label = _MARKS.sub("_", re.sub(r"\d+", "0", label))
            path = f"{path.rstrip('^')}>{label}"
            if named and f"{path}!" not in stay:
                path += "!"
        if name in STRUCTURE:
            tokens.append(path)
            stack.append(Element(name, path, out))
        elif named and path[-1] == "!" and name not in BLOCKS:
            stack.append(Element(name, path, out, buffer.copy()))
            buffer.clear()
        elif named:
            stack.append(Element(name, path, out))
        elif name == "h1" and not out:
            stack.append(Element(name, f"{path.rstrip('^')}^", out))
        elif out or name == "p":
            # Other elements matter only where they are left out, and a paragraph as it ends by itself.
            if out != stack[-1].out or name == "p" and out:
                stack.append(Element(name, path, out))
    flush()
    close(1)
    flush()
    return blocks, tokens


def _ends_in(path: str, names: tuple[str, ...]) -> bool:
    return re.split(r"[.#]", path.rpartition(">")[2], maxsplit=1)[0] in names


def _is_inside(path: str, element: str) -> bool:
    return not element or path == element or path.startswith(f"{element}>")


def article_path(elements: dict[str, int], slots: list[str]) -> str:
    """The path of the article among valid elements, given with the text in each, and slots that vary."""
    total: dict[str, int] = defaultdict(int)
    for path, chars in elements.items():
        while path:
            total[path] += chars
            path = path.rpartition(">")[0]
    for names in (("article",), ("main",)):
        named = [p for p in elements if _ends_in(p, names) and "!" not in p and total[p]]
        if named:
            return max(named, key=lambda p: (total[p], -len(p), p))
    if not slots:
        return max(elements, key=lambda p: (elements[p], p), default="")
    now = slots[0]
    while now and not (now in elements and all(_is_inside(s, now) for s in slots)):
        now = now.rpartition(">")[0]
    return now


def _roots(article: str, slots: list[str]) -> list[str]:
    """The article, or where that is no more than the body, the outermost slots below it."""
    if article and not _ends_in(article, ("html", "body")):
        return [article]
    below = sorted({s for s in slots if s != article and s and not _ends_in(s, ("html", "body"))})
    return [s for s in below if not any(s != o and _is_inside(s, o) for o in below)]


def _digest(path: str, text: str) -> int:
    return int.from_bytes(blake2b(f"{path}\x01{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_STATS = "host string, token string, pages long, vector_a long, vector_b long, chars long"


def _token_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per host and token over the pages of a batch."""
    for batch in batches:
        sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        page_ids = np.array([hash(p) & 0x7FFFFFFFFFFFFFFF for p in batch.column("page_id").to_pylist()], np.uint64)
        for page, host, html in zip(mix(page_ids), batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks, tokens = read_page(html or "")
            counts: dict[str, int] = defaultdict(int)
            chars: dict[str, int] = defaultdict(int)
            for token in tokens:
                counts[token] += 1
            for path, text in blocks:
                chars[path.rstrip("^")] += len(text)
                token = f"{path}\x01{_digest(path, text)}"
                counts[token] += 1
                chars[token] = len(text)
            counts[""] = 1
            marks = mix(page + np.fromiter(counts.values(), np.uint64, len(counts))).tolist()
            for (token, _), mark in zip(counts.items(), marks, strict=True):
                own = sums[host, token]
                own[0] += 1
                own[1] += mark & 0x7FFFFFFF
                own[2] += mark >> 33
                own[3] += chars.get(token, 0)
        rows = [(host, token, *values) for (host, token), values in sums.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
        names = ["host", "token", "pages", "vector_a", "vector_b", "chars"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, roots = [], []
        for row in batch.select(["elements", "slots", "stay"]).to_pylist():
            stay = row["stay"] or []
            slots = sorted({_named(p.rstrip("^"), stay) for p in row["slots"] or []})
            slots = [p for p in slots if "!" not in p]
            elements: dict[str, int] = defaultdict(int)
            for e in row["elements"] or []:
                elements[_named(e["path"], stay)] += e["chars"]
            found.append(article_path(elements, slots))
            roots.append(_roots(found[-1], slots))
        arrays = [batch.column("host"), pa.array(found, pa.string()), pa.array(roots, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*arrays, batch.column("stay"), batch.column("constant")], ["host", "article", "roots", "stay", "constant"])


def _named(path: str, stay: list[str]) -> str:
    """A path as it reads where the elements in ``stay`` are not left out."""
    for element in sorted(stay, key=len, reverse=True):
        if path == element or path.startswith(f"{element}>"):
            path = path[: len(element) - 1] + path[len(element) :]
    return path


def _host_templates(pages: DataFrame) -> DataFrame:
    """Per host: its article, the roots in which constant blocks stay, the elements that stay despite
    their names, and the constant blocks.

    A list holds only what is on most pages of a host, so its length is that of a page.
    """
    stats = pages.mapInArrow(_token_stats, _STATS).groupBy("host", "token")
    stats = stats.agg(*(F.sum(c).alias(c) for c in ("pages", "vector_a", "vector_b", "chars")))
    stats = kept(stats, "page-tokens")
    whole = kept(stats.filter("token = ''").select("host", F.col("pages").alias("n")), "hosts")
    is_text = F.instr("token", "\x01") > 0
    tokens = stats.filter("token <> ''").filter(~is_text).join(whole, "host").filter(F.col("pages") * 2 >= F.col("n"))
    path = F.regexp_replace("token", "^/", "")
    closes = F.max(F.when(F.col("token").startswith("/"), 1)).alias("closes")
    opens = F.max(F.when(~F.col("token").startswith("/"), 1)).alias("opens")
    # An opening and a closing token are in one class if their occurrence vectors are equal.
    classes = tokens.groupBy("host", path.alias("path"), "vector_a", "vector_b").agg(opens, closes, F.sum("chars").alias("chars"))
    valid = classes.filter("opens = 1 and closes = 1")
    elements = valid.groupBy("host").agg(F.collect_list(F.struct("path", "chars")).alias("elements"))

    constant = (F.col("pages") * 2 > F.col("n")) & (F.col("pages") > 1)
    split = [F.substring_index("token", "\x01", n).alias(c) for n, c in ((1, "path"), (-1, "block"))]
    texts = stats.filter(is_text).join(whole, "host").select("host", "n", "pages", "chars", *split, constant.alias("is_constant"))
    sums = texts.groupBy("host", "n", "path").agg(
        F.sum(F.when(~F.col("is_constant"), F.col("chars"))).alias("varies"), F.sum("chars").alias("all"),
        F.sum(F.when(~F.col("is_constant"), F.col("pages"))).alias("times"),
    )
    sums = kept(sums, "page-texts")
    totals = sums.groupBy("host").agg(F.sum("varies").alias("host_varies"), F.sum("all").alias("host_all"))
    slots = sums.filter(F.col("times") * 2 >= F.col("n")).groupBy("host").agg(F.collect_list("path").alias("slots"))
    around = F.expr("explode(transform(sequence(1, length(path) - length(replace(path, '!', ''))), i -> concat(substring_index(path, '!', i), '!')))")
    named = sums.filter(F.instr("path", "!") > 0).select("host", "varies", "all", around.alias("path"))
    named = named.groupBy("host", "path").agg(F.sum("varies").alias("varies"), F.sum("all").alias("all")).join(totals, "host")
    held = F.when(F.col("host_varies").isNull(), F.col("all") * 2 > F.col("host_all")).otherwise(F.col("varies") * 2 > F.col("host_varies"))
    stay = named.filter(held).groupBy("host").agg(F.collect_list("path").alias("stay"))
    fixed = texts.filter("is_constant").join(totals.filter("host_varies is not null").select("host"), "host")
    fixed = fixed.groupBy("host").agg(F.collect_list(F.col("block").cast("long")).alias("constant"))
    hosts = whole.select("host")
    for part in (elements, slots, stay, fixed):
        hosts = hosts.join(part, "host", "left")
    return hosts.mapInArrow(_articles, "host string, article string, roots array<string>, stay array<string>, constant array<long>")


def deduce_templates(pages: DataFrame) -> DataFrame:
    """``host, article``: the path of the article in the template of each host.

    ``pages`` has ``page_id``, ``host`` and ``html``.
    """
    return _host_templates(pages).select("host", "article")


def _text(html: str, article: str, roots: list[str], stay: list[str], constant: frozenset[int]) -> str:
    blocks, tokens = read_page(html)
    # Paths are as the host's tokens have them; what stays despite its name is read again without the mark.
    changed = set(_digest(p, t) for p, t in blocks) & constant if constant else set()
    if stay:
        left = {_named_text(p, t, stay) for p, t in blocks if _digest(p, t) in changed}
        blocks, tokens = read_page(html, _stay_paths(stay))
    else:
        left = {(p, t) for p, t in blocks if _digest(p, t) in changed}
    blocks = [(p, t, (p, t) in left) for p, t in blocks]
    if not _ends_in(article, ("article", "main")) or article not in tokens:
        own = {t: 0 for t in tokens if t[0] != "/"}
        for p, t, _ in blocks:
            p = p.rstrip("^")
            own[p] = own.get(p, 0) + len(t)
        article = article_path({p: n for p, n in own.items() if p}, [""])
    is_named = _ends_in(article, ("article", "main"))
    lines = []
    for path, text, is_constant in blocks:
        place = path.rstrip("^")
        if "!" in place and (path[-1:] != "^" or is_constant):
            continue
        if is_named and not _is_inside(place, article):
            continue
        if not is_named and is_constant and not any(_is_inside(place, r) for r in roots):
            continue
        lines.append(text)
    return "\n".join(lines)


def _named_text(path: str, text: str, stay: list[str]) -> tuple[str, str]:
    return _named(path, stay), text


def _stay_paths(stay: list[str]) -> frozenset[str]:
    """As ``read_page`` meets them: an element's own mark stands, those around it that stay are gone."""
    return frozenset(_named(p[:-1], stay) + "!" for p in stay)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for row in batch.select(["html", "article", "roots", "stay", "constant"]).to_pylist():
            texts.append(_text(row["html"] or "", row["article"] or "", row["roots"] or [], row["stay"] or [], frozenset(row["constant"] or [])))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), sizes]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_texts(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars`` (its code points)."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    templates = kept(_host_templates(pages.select("page_id", "host", "html")), "templates")
    size = templates.agg(F.count("*").alias("hosts"), F.sum(F.greatest(F.size("constant"), F.lit(0))).alias("blocks")).first()
    few = F.broadcast(templates) if size.hosts <= BROADCAST_HOSTS and (size.blocks or 0) <= BROADCAST_BLOCKS else templates
    joined = pages.join(few, "host", "left").select("page_id", "url", "html", "article", "roots", "stay", "constant")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
