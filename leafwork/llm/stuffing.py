"""Keyword-stuffed, link-list and tag pages among commits.

Every line that a commit brings in (its message, its added lines) is reduced to a shape of counts: words, capitals,
separators, links, tags, code marks, whether a sentence ends in it, and how many of its words are copies of others in
it.  Lines are grouped by document, part and shape before any shuffle; a part (message or added text) is stuffed if a
few shapes that no sentence or code has hold most of its characters.

Shapes of links with few words each and of tags or prices are stuffing by themselves.  Lists of separators, lines of
copied words and open lines (several words, no end of a sentence) are it only where the part's words repeat: the
copies of its ten most frequent words are a large share of them.  So no list of words of any language decides, and
prose without a full stop stays.  Change logs and references have many words beside each link, dependency lists,
constants, translations and manifests have code marks or few words a line, so they fall out.

The largest MOST_SHAPES stuffing shapes decide; how many there are besides doesn't count, as it grows with the length
of a page.

Defined results: null, empty and blank texts are never stuffed.  Each document is judged by itself, whole;
repeated documents each count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A part is stuffed from this share of its characters in its MOST_SHAPES largest stuffing shapes, if it has so many words or links in any.
STUFFED_SHARE, LEAST_WORDS, LEAST_LINKS, MOST_SHAPES = 0.5, 12, 4, 12
#: A link with more words beside it than this stands in a sentence.  Copies in a line make it a line of copies.
LINK_WORDS, COPIES_IN_LINE = 8, 0.25
#: Open lines, lists and lines of copies count if the copies of the TOP_WORDS most frequent words are so many of their words.
TOP_WORDS, OPEN_REPEATED, LIST_REPEATED = 10, 0.33, 0.15
#: Open lines beside closed sentences of this share of their size are prose that goes on over lines.
PROSE_SHARE = 0.25
_LINK = r"(?:https?://|www\.)[^\s<>\"'\])]+"
#: Marks around a link that aren't code: Markdown and HTML anchors, list marks, line ends of markup.
_ANCHOR = r'(?i)<a\s[^<>]*href\s*=\s*["\']?@["\']?[^<>]*>|</a>|<br\s*/?>|</?(?:li|ul|ol|p|div|td|tr|h\d|b|strong|span)\b[^<>]*>|\]\(\s*@[^)]*\)|^\s*[-*+]\s*\[|\['
_CODE = r"[(){}=<>\[\]_`\\$#&]|\"|::|->|^\s*(?://|/\*|--)|\w@\d"
_PRICE, _BRACKETS = r"\d[.,]\d\d\s+\p{L}{2,3}\b", r"[(){}=<>\[\]\"`]"
_HASHTAG = r"(?<![^\s,;|])#\p{L}[\p{L}\p{N}-]*"
_WORD = r"(?<![\p{L}\d])\p{L}{2,}+(?!\d)"
_END = r"(?:\p{L}{3,}|\d\d)[.!?…。！？][\"'”’»)]*(?:\s|$)"
HEADERS = r"^(?:commit [0-9a-f]{7,64}\b|Author:|AuthorDate:|Commit:|CommitDate:|Date:|From:? |To: |Cc: |Message-Id: |Merge: |---$|(?:Reviewed|Signed-off|Acked|Tested|Co-authored|Reported)-by: )"


def added_and_message(text: str | Column) -> tuple[Column, Column]:
    """The lines of the message and the added lines of a rendered commit, as two arrays."""
    text = F.col(text) if isinstance(text, str) else text
    body = F.concat(F.lit("\n"), text)
    at = F.locate("\ndiff --", body)
    head = F.when(at > 0, F.substr(body, F.lit(2), F.greatest(at - 2, F.lit(0)))).otherwise(text)
    tail = F.when(at > 0, F.substr(body, at + 1)).otherwise(F.lit(""))
    message = F.transform(F.split(head, "\n"), lambda s: F.regexp_replace(s, r"^Subject:\s*(?:\[PATCH[^\]]*\])?", ""))
    return F.filter(message, lambda s: ~s.rlike(HEADERS)), F.regexp_extract_all(tail, F.lit(r"(?m)^\+(?!\+\+ )(.*)$"), F.lit(1))


def line_shapes(lines: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """``keys, shape, kind, n_lines, chars, words, links, seps, plain``: the lines of each group of ``keys`` by shape.

    ``kind`` is link, tag, list, copies, open, sentence, code or short and follows from the shape's counts; ``plain``
    holds the words of lists, lines of copies and open lines.
    """
    s = F.trim(F.col(line))
    linked = lines.where(F.length(s) > 0).select(*keys, s.alias("_s"), F.when(s.contains("://") | s.contains("www."), F.regexp_replace(s, _LINK, "@")).otherwise(s).alias("_l"))
    has_link = (F.col("_l") != F.col("_s")) | F.col("_s").rlike(_LINK)
    bare = F.when(has_link, F.regexp_replace(F.col("_l"), _ANCHOR, " ")).otherwise(F.col("_l"))
    counted = linked.select(*keys, F.length("_s").alias("_chars"), has_link.alias("_linked"), bare.alias("_b"))
    # most lines are code; the counts are made only for the others
    counted = counted.withColumn("tags", F.when(F.instr("_b", "#") > 0, F.regexp_count("_b", F.lit(_HASHTAG))).otherwise(0))
    counted = counted.withColumn("priced", (F.instr("_b", "tag:") > 0) | F.col("_b").rlike(_PRICE))
    counted = counted.withColumn("code", ~F.col("_linked") & (F.col("tags") < 2) & F.col("_b").rlike(_CODE) & (~F.col("priced") | F.col("_b").rlike(_BRACKETS)))
    plain = lambda value, other: F.when(~F.col("code"), value).otherwise(other)
    counted = counted.select(
        *keys, "_chars", "_b", "tags", "priced", "code", F.when(F.col("_linked"), F.greatest(F.lit(1), F.regexp_count("_b", F.lit("@")))).otherwise(0).alias("links"),
        plain(F.regexp_extract_all(F.lower("_b"), F.lit(f"({_WORD})"), F.lit(1)), F.array().cast("array<string>")).alias("_w"), plain(F.regexp_count("_b", F.lit(r"[,;|]")), 0).alias("seps"),
    )
    counted = counted.withColumn("words", F.size("_w"))
    counted = counted.withColumn("copies", F.when(F.col("words") >= 4, (F.col("words") - F.size(F.array_distinct("_w"))) / F.col("words")).otherwise(0.0))
    counted = counted.withColumn("ends", F.when(F.col("words") >= 4, F.col("_b").rlike(_END)).otherwise(False))
    kind = (
        F.when((F.col("links") > 0) & (F.col("words") <= LINK_WORDS * F.col("links")), "link")
        .when(F.col("links") > 0, "sentence")
        .when(F.col("code"), "code")
        .when((F.col("tags") >= 2) & (2 * F.col("tags") >= F.col("words")), "tag")
        .when(F.col("priced") & ~F.col("ends"), "tag")
        .when((F.col("words") >= 6) & (F.col("copies") >= COPIES_IN_LINE), "copies")
        .when((F.col("seps") >= 3) & (F.col("words") <= 5 * F.col("seps")) & ~F.col("ends"), "list")
        .when(F.col("words") < 4, "short")
        .when(~F.col("ends"), "open")
        .otherwise("sentence")
    )
    capitals = F.when(F.col("_b").rlike(r"^\P{L}*\p{Lu}"), "C").otherwise("c")
    bucket = lambda c, *edges: F.concat(*[F.when(F.col(c) >= e, "+").otherwise("") for e in edges])
    shape = F.when(F.col("code"), "code").otherwise(
        F.concat_ws(
            "/", F.concat(F.lit("w"), bucket("words", 1, 4, 8, 16)), capitals, F.concat(F.lit("s"), bucket("seps", 1, 3, 6)), F.concat(F.lit("l"), bucket("links", 1, 2, 4)),
            F.concat(F.lit("t"), bucket("tags", 1, 2, 4), F.when(F.col("priced"), "p").otherwise("")), F.concat(F.lit("r"), bucket("copies", COPIES_IN_LINE, 0.5)), F.when(F.col("ends"), ".").otherwise("-"),
        )
    )
    return (
        counted.select(*keys, shape.alias("shape"), kind.alias("kind"), "_chars", "words", "links", "_w")
        .groupBy(*keys, "shape", "kind")
        .agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum("_chars").alias("chars"), F.sum("words").alias("words"), F.sum("links").alias("links"),
            F.flatten(F.collect_list(F.when(F.col("kind").isin("list", "copies", "open"), F.col("_w")))).alias("plain"),
        )
    )


def part_shapes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    message, added = added_and_message(F.col(text))
    parts = documents.where(F.length(F.trim(text)) > 0).select(doc_id, F.explode(F.create_map(F.lit("message"), message, F.lit("added"), added)).alias("part", "lines"))
    return line_shapes(parts.select(doc_id, "part", F.explode("lines").alias("line")), [doc_id, "part"])


def repeated_share(words: Column) -> Column:
    """The copies of the TOP_WORDS most frequent words as a share of all; one of each isn't a copy.

    The words are sorted and their runs counted, so it takes no longer than sorting.
    """

    def of_sorted(w: Column) -> Column:
        n = F.size(w)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))

        def of_starts(s: Column) -> Column:
            runs = F.transform(s, lambda at, k: F.coalesce(F.get(s, k + 1), n) - at)
            top = F.slice(F.sort_array(runs, asc=False), 1, TOP_WORDS)
            return F.aggregate(top, F.lit(0), lambda a, b: a + b - 1) / n

        return F.transform(F.array(starts), of_starts)[0]

    return F.when(F.size(words) > 0, F.transform(F.array(F.array_sort(words)), of_sorted)[0]).otherwise(0.0)


def stuffed_parts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, part, share, words, links, shapes`` of the stuffed messages and added texts."""
    rows = F.struct("kind", "chars", "words", "links")
    by = part_shapes(documents, doc_id, text).groupBy(doc_id, "part").agg(F.sum("chars").alias("_chars"), F.collect_list(rows).alias("_rows"), F.flatten(F.collect_list("plain")).alias("_plain"))
    by = by.where(F.exists("_rows", lambda r: ~r["kind"].isin("code", "short", "sentence")))

    sum_up = lambda sizes: F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
    chars = lambda kind: sum_up(F.transform("_rows", lambda r: F.when(r["kind"] == kind, r["chars"]).otherwise(F.lit(0))))

    def stuffing(repeated: Column) -> Column:
        listed, opened = repeated >= LIST_REPEATED, (repeated >= OPEN_REPEATED) & (chars("sentence") < PROSE_SHARE * chars("open"))
        return F.filter("_rows", lambda r: r["kind"].isin("link", "tag") | (r["kind"].isin("list", "copies") & listed) | ((r["kind"] == "open") & opened))

    by = by.select(doc_id, "part", "_chars", F.transform(F.array(repeated_share(F.col("_plain"))), stuffing)[0].alias("_stuff"))
    total = lambda field: sum_up(F.transform("_stuff", lambda r: r[field]))
    largest = sum_up(F.slice(F.sort_array(F.transform("_stuff", lambda r: r["chars"]), asc=False), 1, MOST_SHAPES))
    out = by.where(largest >= STUFFED_SHARE * F.col("_chars")).select(doc_id, "part", (total("chars") / F.col("_chars")).alias("share"), total("words").alias("words"), total("links").alias("links"), F.size("_stuff").cast("bigint").alias("shapes"))
    return out.where((F.col("words") >= LEAST_WORDS) | (F.col("links") >= LEAST_LINKS))


def find_stuffed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` of the documents of which the message or the added text is stuffed."""
    return stuffed_parts(documents, doc_id, text).select(doc_id).distinct()
