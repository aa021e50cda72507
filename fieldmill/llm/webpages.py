"""Main text of web pages by equivalence-class template deduction.

1. Every page becomes tokens: tags and text blocks, each with the path above it, those of
   articles included. For each host and token the pages that have it are summed up as an
   occurrence vector: number of pages, number of occurrences, and a sum of hashes of page
   and count. Tokens with equal sums occur equally often in the very same pages.
2. Tokens of a host with equal vectors form a class. A class is valid if it covers enough
   of the host's pages and has tags that nest; a text belongs to it if it stands below a
   tag of the template. Text that repeats without tags of its own is a value of a slot.
   The valid classes, nested by their paths, are the host's template; a host of few
   different pages has the tags that any page has.
3. Text that is no template token is the slots. Names choose among them: slots below the
   template's article or main tags; on a page without these, slots below its own; on a
   page without any, all that do not stand in a boilerplate container.

Occurrence vectors are sums, so a host with a third of all pages is added up in parts;
templates go to the pages by a join on host and salt.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package

LEAST_PAGES = 5
COVER = 0.5
SALTS = 32
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# tags whose content is no article text
OUTSIDE = frozenset(
    "head script style noscript template textarea title iframe nav header footer aside form button select "
    "option input dialog menu svg math canvas object audio video map".split()
)
MAIN = frozenset(("article", "main"))
BOILERPLATE = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|adv|advert\w*|adsense|banner|breadcrumbs?|byline-links|comments?|commentlist|consent|"
    r"cookies?|disclaimer|disqus|feedback|footer|gdpr|header|legal|login|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notice|notification|overlay|pagination|pager|paywall|popup|promo\w*|recommend\w*|"
    r"related|replies|respond|reviews?|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|tags?|toolbar|"
    r"widget)(?:$|[-_\s\d])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
CLOSES = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option", "optgroup")),
}


def _shut(tag: str, text: str) -> bool:
    """Whether an open tag's names say that it holds no article text."""
    if not text:
        return False
    for name, *values in ATTRIBUTE.findall(text):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and BOILERPLATE.search(value):
            return True
    return False


class Page:
    """Tokens of one page: tags with their paths, and blocks of text."""

    def __init__(self, source: str):
        self.tags: list[str] = []
        self.blocks: list[tuple[str, str, bool, bool]] = []  # text, path, outside, in article
        stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
        words: list[str] = []

        def flush() -> None:
            text = " ".join(references.unescape("".join(words)).split())
            words.clear()
            if text:
                _, path, outside, inside = stack[-1]
                self.blocks.append((text, path, outside, inside))

        def close(depth: int) -> None:
            flush()
            while len(stack) > depth:
                self.tags.append(stack[-1][1] + "/end")
                stack.pop()

        at = 0
        for found in TOKEN.finditer(source):
            if found.start() < at:
                continue
            ending, tag = found.group(1), (found.group(2) or "").lower()
            words.append(source[at : found.start()])
            at = found.end()
            if not tag or tag in INLINE:
                continue
            if ending:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                else:
                    flush()
                continue
            flush()
            if tag in CLOSES or tag in CLOSES["p"]:
                for depth in range(len(stack) - 1, 0, -1):
                    name = stack[depth][0]
                    if tag in CLOSES.get(name, ()):
                        close(depth)
                        break
                    if name not in CLOSES and name not in INLINE:
                        break
            text = found.group(3) or ""
            _, path, outside, inside = stack[-1]
            outside = outside or tag in OUTSIDE or _shut(tag, text)
            if tag == "header" and inside and not stack[-1][2]:
                outside = stack[-1][2] or _shut(tag, text)  # an article's own heading
            named = re.search(r"class\s*=\s*[\"']?([\w-]+)", text)
            path = f"{path}/{tag}" + (f".{named.group(1)}" if named else "")
            self.tags.append(path)
            if tag in VOID or text.endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(f"</{tag}\\b[^>]*(?:>|$)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            stack.append((tag, path, outside, inside or (tag in MAIN and not outside)))
        words.append(source[at:])
        close(1)
        flush()


def _key(token: str) -> int:
    digest = hashlib.blake2b(token.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _text_token(text: str, path: str) -> str:
    return f"{path}#{text}"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, above, depth, pages, times, sum of hashes of page and count).

    ``above`` is the token of the tag that holds this one, ``depth`` the number of tags in
    the path of a tag, negative at its end, 0 for text.
    """
    for batch in batches:
        held: dict[tuple[str, str], list] = {}
        hosts, pages = batch.column("host").to_pylist(), batch.column("page").to_pylist()
        for host, number, source in zip(hosts, pages, batch.column("html")):
            page = Page(source.as_py() or "")
            counts: dict[str, int] = {}
            place: dict[str, tuple[str, int]] = {}
            for tag in page.tags:
                counts[tag] = counts.get(tag, 0) + 1
                if tag not in place:
                    path = tag.removesuffix("/end")
                    place[tag] = path.rpartition("/")[0], path.count("/") * (1 if path == tag else -1)
            for text, path, _, _ in page.blocks:
                token = _text_token(text, path)
                counts[token] = counts.get(token, 0) + 1
                place[token] = path, 0
            for token, count in counts.items():
                own = held.setdefault((host, token), [0, 0, 0, *place[token]])
                own[0] += 1
                own[1] += count
                own[2] = (own[2] + _key(f"{number} {count}")) % (1 << 62)
        keys = {path: _key(path) for path in {v[3] for v in held.values()}}
        columns = [
            pa.array([h for h, _ in held], pa.string()),
            pa.array([_key(t) for _, t in held], pa.int64()),
            pa.array([keys[v[3]] for v in held.values()], pa.int64()),
            *(pa.array([v[k] for v in held.values()], pa.int64()) for k in (4, 0, 1, 2)),
        ]
        names = ["host", "token", "above", "depth", "pages", "times", "vector"]
        yield pa.RecordBatch.from_arrays(columns, names)


def valid_tokens(tokens: pd.DataFrame) -> list[int]:
    """Tokens of a host's valid classes, nested into a template.

    ``tokens`` has token, above, depth, pages, times and vector. A class is valid if it has
    a tag that stands below a tag of the template; its other tags and texts that do are
    template tokens too. Classes of more pages come first.
    """
    rows = tokens.assign(level=tokens["depth"].abs())
    classes = [g for _, g in rows.groupby(["pages", "times", "vector"])]
    classes.sort(key=lambda g: (-int(g["pages"].iloc[0]), int(g["times"].iloc[0]), int(g["level"].max())))
    template = {_key("")}
    out: list[int] = []
    for group in classes:
        tags = group[group["depth"] != 0].sort_values("level", kind="stable")
        nested = 0
        for token, above, depth in zip(tags["token"], tags["above"], tags["depth"]):
            if above in template:
                out.append(int(token))
                nested += 1
                if depth > 0:
                    template.add(int(token))
        if nested:
            texts = group[group["depth"] == 0]
            out += [int(k) for k, above in zip(texts["token"], texts["above"]) if above in template]
    return out


def _template(frame: pd.DataFrame) -> pd.DataFrame:
    keys = np.array(valid_tokens(frame), np.int64)
    return pd.DataFrame({"host": frame["host"].iloc[:1], "template": [keys.tobytes()]})


def _marked(path: str, template: frozenset[int]) -> bool:
    """Whether an article or main tag of the template stands in ``path``."""
    names = path.split("/")
    return any(
        name.partition(".")[0] in MAIN and _key("/".join(names[: k + 1])) in template
        for k, name in enumerate(names)
    )


def main_text(source: str, template: frozenset[int]) -> str:
    """Content slots of a page, in page order."""
    page = Page(source)
    slots = [b for b in page.blocks if not b[2]]
    marked = {t for t in set(page.tags) if t.rpartition("/")[2].partition(".")[0] in MAIN and _key(t) in template}
    if marked:
        within = {path: _marked(path, template) for path in {b[1] for b in slots}}
        chosen = [b for b in slots if within[b[1]]]
    else:
        chosen = [b for b in slots if b[3]] or slots
    if template:
        chosen = [b for b in chosen if _key(_text_token(b[0], b[1])) not in template]
    return " ".join(b[0] for b in chosen)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, template in zip(batch.column("html"), batch.column("template")):
            keys = frozenset(np.frombuffer(template.as_py() or b"", np.int64).tolist())
            texts.append(main_text(source.as_py() or "", keys))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def host_of(url):
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")


def templates(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(host, template): keys of the tokens of each host's valid classes."""
    ship_package(pages.sparkSession)
    own = pages.select(
        host_of(F.col(url)).alias("host"), F.xxhash64(page_id, url).alias("page"), F.col(source).alias("html")
    )
    kind = "host string, token long, above long, depth long, pages long, times long, vector long"
    tokens = own.mapInArrow(_occurrences, kind).groupBy("host", "token").agg(
        F.first("above").alias("above"), F.first("depth").alias("depth"), F.sum("pages").alias("pages"),
        F.sum("times").alias("times"),
        # sums, as page hashes that are XORed cancel where rows repeat; by halves, against overflow
        F.sum(F.col("vector").bitwiseAND((1 << 31) - 1)).alias("low"),
        F.sum(F.shiftright("vector", 31)).alias("high"),
    )
    tokens = tokens.withColumn("vector", F.xxhash64("low", "high")).drop("low", "high")
    # copies of one page say nothing about a template
    contents = own.groupBy("host", F.xxhash64("html").alias("content")).agg(F.count(F.lit(1)).alias("n"))
    sizes = contents.groupBy("host").agg(F.sum("n").alias("all_pages"), F.count(F.lit(1)).alias("contents"))
    # at most 1 / COVER times the tokens of an average page are left for a host
    wide = tokens.where(F.col("pages") >= COVER * LEAST_PAGES).join(sizes, "host").where(
        (F.col("contents") >= LEAST_PAGES) & (F.col("pages") >= COVER * F.col("all_pages"))
    )
    return wide.groupBy("host").applyInPandas(_template, "host string, template binary")


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``.

    Null and empty pages give an empty text. Pages without a host share the empty host;
    hosts of fewer than LEAST_PAGES pages have no template of their own. Broken markup is
    read as far as it goes. Repeated rows give a row each; other columns are ignored.
    """
    found = templates(pages, page_id, url, source)
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"),
        host_of(F.col(url)).alias("host"),
        F.pmod(F.xxhash64(page_id, url), F.lit(SALTS)).cast("int").alias("salt"),
    )
    joined = own.join(salted, ["host", "salt"], "left").select("page_id", "url", "html", "template")
    kind = T.StructType(
        [
            T.StructField("page_id", own.schema["page_id"].dataType),
            T.StructField("url", own.schema["url"].dataType),
            T.StructField("text", T.StringType()),
        ]
    )
    return joined.mapInArrow(_extracted, kind)
