"""Items above a size limit, cut into pieces under it at natural boundaries, with a given overlap.

A text is a run of tokens (words, spaces, marks); the prefix sums of their lengths are the offsets at which it
may be cut.  Each offset has a rank: paragraph, line, sentence, clause, word.  For each piece the last
boundary under the limit is found by binary search in the sorted offsets of a rank, best rank first; a rank
counts only if the piece would keep at least ``min_fill`` of the limit.  The next piece begins exactly the
overlap before the cut.  Where there is no boundary at all the cut is hard, at the limit.

Defined results: characters are code points.  Null and empty texts and texts within the limit have no pieces
(they need none).  Sizes: an item of exactly ``max_chars`` isn't cut.  ``overlap_chars`` null or negative counts as 0
and is honoured for every value below ``max_chars``; one
of ``max_chars`` or more counts as ``max_chars - 1``, so that every piece advances (``overlap`` tells what was taken).  A limit that is null or below 1 cuts nothing.
Removing the first ``overlap`` characters of each piece but the first and joining gives the text back.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_FILL = 0.5
#: Tokens: blank lines, line breaks, spaces, words, CJK characters one by one, other marks one by one.
_TOKEN = re.compile(r"[^\S\n]*\n(?:[^\S\n]*\n)+[^\S\n]*|[^\S\n]*\n|[^\S\n]+|[^\W぀-ヿ㐀-鿿가-힯]+|.", re.S)
_PARAGRAPH, _LINE, _SENTENCE, _CLAUSE, _WORD = range(5)
_ENDS, _PAUSES, _CLOSERS, _WIDE_ENDS = ".!?…", ",;:—–", "\"'”’»)]", "。！？"


def boundaries(text: str) -> list[list[int]]:
    """Sorted cut offsets by rank; a better rank's offsets aren't repeated in a lesser one."""
    tokens = _TOKEN.findall(text)
    offsets = list(accumulate(map(len, tokens)))
    ranks: list[list[int]] = [[] for _ in range(5)]
    last = ""  # the mark that the words so far end with, closers aside
    for token, end in zip(tokens, offsets, strict=True):
        head = token[0]
        if head.isspace():
            breaks = token.count("\n")
            ranks[_PARAGRAPH if breaks > 1 else _LINE if breaks else _SENTENCE if last in _ENDS and last else _CLAUSE if last in _PAUSES and last else _WORD].append(end)
        elif head in _WIDE_ENDS:
            ranks[_SENTENCE].append(end)
            last = head
        elif head in "，、；：":
            ranks[_CLAUSE].append(end)
            last = head
        elif "぀" <= head <= "鿿" or "가" <= head <= "힯":
            ranks[_WORD].append(end)
            last = ""
        elif head not in _CLOSERS:
            last = token[-1] if not token[-1].isalnum() else ""
    return ranks


def cut(text: str, limit: int, overlap: int, min_fill: float = MIN_FILL) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut at the end) of each piece, in order."""
    overlap = max(0, min(overlap, limit - 1))
    names = ("paragraph", "line", "sentence", "clause", "word")
    ranks, pieces, start = boundaries(text), [], 0
    while len(text) - start > limit:
        floor = start + max(overlap + 1, int(limit * min_fill))
        end, kind = start + limit, "hard"
        for least in (floor, start + overlap + 1):  # a poor fill is better than a cut inside a word
            for rank, name in enumerate(names):
                at = bisect_right(ranks[rank], start + limit) - 1
                if at >= 0 and ranks[rank][at] >= least:
                    end, kind = ranks[rank][at], name
                    break
            if kind != "hard":
                break
        pieces.append((start, end, kind))
        start = end - overlap
    pieces.append((start, len(text), "end"))
    return pieces


def split_oversized(items: DataFrame, keys: list[str], text: str, max_chars: str, overlap_chars: str, *, min_fill: float = MIN_FILL) -> DataFrame:
    """``keys, piece_no, start, n_chars, overlap, cut, piece`` for the items longer than their limit.

    ``max_chars`` and ``overlap_chars`` are columns of ``items``.  The size test runs in the scan's stage, so only
    oversized items leave the JVM; each is cut by itself, whatever its length, and nothing is shuffled.
    """
    fields = [items.schema[k] for k in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "piece_no bigint, start bigint, n_chars bigint, overlap bigint, cut string, piece string"])
    names = [*keys, "piece_no", "start", "n_chars", "overlap", "cut", "piece"]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out, size = [], 0
            for *key, body, limit, overlap in batch.itertuples(index=False, name=None):
                done = 0
                for n, (start, end, kind) in enumerate(cut(body, int(limit), int(overlap), min_fill)):
                    out.append((*key, n, start, end - start, done - start, kind, body[start:end]))
                    done, size = end, size + end - start
                    if size > 8_000_000:
                        yield pd.DataFrame(out, columns=names)
                        out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)

    over = items.select(*keys, F.col(text).alias("_t"), F.col(max_chars).cast("long").alias("_m"), F.greatest(F.coalesce(F.col(overlap_chars).cast("long"), F.lit(0)), F.lit(0)).alias("_o"))
    return over.where((F.col("_m") >= 1) & (F.length("_t") > F.col("_m"))).mapInPandas(run, schema)


def joined_blocks(blocks: str = "blocks"):
    """The non-null, non-empty text blocks in order, joined by one blank line; null where there are none."""
    texts = F.expr(f"transform(filter({blocks}, b -> b.kind = 'text' AND length(b.text) > 0), b -> b.text)")
    return F.when(F.size(texts) > 0, F.array_join(texts, "\n\n"))


def sized_items(layout_kids: DataFrame, page_units: DataFrame, size_limits: DataFrame) -> DataFrame:
    """``table_name, doc_id, item_id, body, max_chars, overlap_chars`` of both tables, each with its limit."""
    kids = layout_kids.select(F.lit("layout_kids").alias("table_name"), "doc_id", F.col("id").cast("long").alias("item_id"), F.col("content").alias("body"))
    pages = page_units.select(F.lit("page_units").alias("table_name"), "doc_id", F.col("number").cast("long").alias("item_id"), joined_blocks().alias("body"))
    # one row a table name; Catalyst broadcasts it by its size
    limits = size_limits.groupBy("table_name").agg(F.max("max_chars").alias("max_chars"), F.max("overlap_chars").alias("overlap_chars"))
    return kids.unionByName(pages).join(limits, "table_name")


def oversized_pieces(layout_kids: DataFrame, page_units: DataFrame, size_limits: DataFrame) -> DataFrame:
    """The pieces of both tables' oversized items; a key's repeated deliveries count once."""
    items = sized_items(layout_kids, page_units, size_limits).where(F.length("body") > F.col("max_chars"))
    one = items.groupBy("table_name", "doc_id", "item_id").agg(F.max("body").alias("body"), F.max("max_chars").alias("max_chars"), F.max("overlap_chars").alias("overlap_chars"))
    return split_oversized(one, ["table_name", "doc_id", "item_id"], "body", "max_chars", "overlap_chars")
