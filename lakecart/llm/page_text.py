"""Main text of web pages by nearest-URL page differencing.

Pages of one site share their template; what a page does not share with its
nearest neighbour is its own.

1. Every page is cut into text lines (blocks, see ``page_blocks``).
2. The distinct pages of each host (by lines; the smallest path stands for
   copies) are numbered in order of (host, path): the page with the longest
   common path beginning is the one before or after.
3. The lines of a page and of that neighbour are aligned by a longest common
   subsequence, and the shared lines are deleted.
4. Markup checks what is left: lines in menus, headers, footers, sidebars,
   notices, adverts, forms and reader comments go even if they are the page's
   own (an advert that differs on every page), and of the rest the surest
   container with text counts (article, main, content, page).

A line inside an ``article`` element stays although the neighbour has it too:
there the page itself says that it is the article, and articles do share
passages, license lines or whole texts.  For the same reason a neighbour that
shares more than ``COPY`` of the characters in question is another version of
the page and deletes nothing.

Only line hashes (64 bits) travel to the neighbours; a host that holds a third
of all pages is spread over the range partitions of the numbering.  What is
deleted is kept per distinct (host, lines) and joined to the pages, broadcast
only if its counted bytes are within ``BROADCAST_BYTES``.

Defined results: null or empty html, or a page without text -> empty text; a
null url or one without host -> its own "host" of the empty name; repeated
rows give repeated rows; ties of the path take the neighbour before; very long
pages are taken whole (alignment in bounded memory); extra columns are left
aside; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.ids import dense_row_id
from lakecart.llm.alignment import shared
from lakecart.llm.page_blocks import ARTICLE, ASIDE, blocks
from lakecart.llm.storage import materialize
from lakecart.llm.url_rules import url_parts

COPY = 0.95
BROADCAST_BYTES = 64 << 20
SEPARATOR = "\n\n"
_BLOCKS = "array<struct<part:int,text:string>>"
#: What becomes of a line: it goes, it stays unless the neighbour has it, it stays.
GOES, OWN, STAYS = -1, 0, 1


def parts(found: list[tuple[int, str]]) -> list[int]:
    """What markup says of each block: only those in the surest container with text count, and an article's stay."""
    top = max((level for level, _ in found), default=ASIDE)
    return [GOES if level == ASIDE or level < top else STAYS if top == ARTICLE else OWN for level, _ in found]


def page_blocks(html: Column) -> Column:
    """The blocks of a page: array of (part, text)."""

    @F.arrow_udf(_BLOCKS)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            part, texts, ends = [], [], [0]
            for page in pages:
                found = blocks(page.as_py() or "")
                part += parts(found)
                texts += [text for _, text in found]
                ends.append(len(part))
            rows = pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(texts, pa.string())], ["part", "text"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return cut(html)


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda b: F.xxhash64(b["text"]))


def _key(lines: Column) -> Column:
    return F.unhex(F.md5(F.array_join(lines.cast("array<string>"), ",").cast("binary")))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page which lines its nearest neighbour shares, where there are any."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            sides = [(p, r[f"{s}_lines"]) for s in ("before", "after") if (p := r[f"{s}_path"]) is not None]
            _, lines = max(sides, key=lambda s: len(os.path.commonprefix([r["path"], s[0]])))
            flags = shared(np.array(r["lines"], np.int64), np.array(lines, np.int64))
            if flags.any():
                rows.append((r["host"], r["key"], flags.tolist()))
        yield pa.RecordBatch.from_pydict(
            {"host": [r[0] for r in rows], "key": [r[1] for r in rows], "shared": [r[2] for r in rows]},
            schema=pa.schema([("host", pa.string()), ("key", pa.binary()), ("shared", pa.list_(pa.bool_()))]))


def shared_lines(pages: DataFrame) -> DataFrame:
    """(host, key, shared): per distinct page of a host, which of its lines its nearest neighbour by URL path shares.

    ``pages`` has host, path and ``lines`` (the hashes of its lines).
    """
    sites = pages.withColumn("key", _key(F.col("lines"))).groupBy("host", "key").agg(
        F.min("path").alias("path"), F.first("lines").alias("lines"))
    order = dense_row_id(materialize(sites, "page-lines"), ["host", "path", "key"], "at")

    def neighbour(name: str, step: int) -> DataFrame:
        return order.select((F.col("at") + step).alias("at"), F.col("host").alias(f"{name}_host"),
                            F.col("path").alias(f"{name}_path"), F.col("lines").alias(f"{name}_lines"))

    pairs = order.join(neighbour("before", 1), "at", "left").join(neighbour("after", -1), "at", "left")
    for name in ("before", "after"):
        near = F.col(f"{name}_host") == F.col("host")
        pairs = pairs.withColumn(f"{name}_path", F.when(near, F.col(f"{name}_path")))
    pairs = pairs.filter("before_path is not null or after_path is not null").select(
        "host", "key", "path", "lines", "before_path", "before_lines", "after_path", "after_lines")
    return materialize(pairs.mapInArrow(_align, "host string, key binary, shared array<boolean>"), "page-shared")


def main_text(found: Column, deleted: Column) -> Column:
    """The article's text from the blocks of a page and what its neighbour shares (null: nothing)."""
    gone = lambda i: F.coalesce(F.get(deleted, i), F.lit(False))
    own = F.filter(found, lambda b: b["part"] > GOES)
    kept = F.filter(found, lambda b, i: (b["part"] == STAYS) | (b["part"] == OWN) & ~gone(i))
    size = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda n, b: n + F.length(b["text"]))
    version = size(kept) < (1 - COPY) * size(own)  # what is left would be next to nothing: another version of the page
    return F.array_join(F.when(version, own["text"]).otherwise(kept["text"]), SEPARATOR)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"),
                        page_blocks(F.col(html_col)).alias("blocks"))
    same = shared_lines(rows.select("host", "path", _hashes(F.col("blocks")).alias("lines")))
    held = same.agg(F.sum(F.size("shared") + F.length("host") + 64)).first()[0] or 0
    same = F.broadcast(same) if held <= BROADCAST_BYTES else same
    out = rows.withColumn("key", _key(_hashes(F.col("blocks")))).join(same, ["host", "key"], "left")
    return (out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), main_text(F.col("blocks"), F.col("shared")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("bigint")))
