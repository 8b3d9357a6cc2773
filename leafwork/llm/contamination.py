"""Evaluation passages inside training text: which documents hold them, which items leaked, and the text without them.

A set of hashed word n-grams of the test items goes to every task; the windows of each document's normalised
words are looked up in it, all windows of a batch at once.  Documents with a hit are verified by aligning the
item's own words with the words around the hits, and a case needs enough words in the item's order.

Normalisation: tags are taken out, letters lower-cased, and words are runs of letters and digits; so layout,
comment and diff marks, case, punctuation and spacing don't count.  A word divided by a hyphen at a break of line
is put together.  Sentences that several items share (instructions) are no part of an item's own passage.

Defined results: null and empty texts and items hold nothing.  Repeated documents each count.  Items of fewer
words than an n-gram can't be found.  Texts are read whole.  The documents are never shuffled.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.runtime import materialize

#: Words in a window; matched words that make a case; their share of the words between the first and the last
#: match in the passage (a few may be replaced) and in the document (layout may put words between).
NGRAM, MIN_WORDS, MIN_KEPT, MIN_DENSITY = 5, 20, 0.8, 0.6
#: Words of test items in one block: what a task holds at once, about 100 bytes a word.
BLOCK_WORDS = 1_000_000
_TAG = re.compile(r"</?[A-Za-z][^<>\n]{0,200}>|&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]+);|\\u[0-9a-fA-F]{4}|\\[nrt]")
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐­¬]\s*\n[+\-\s#/*>|;%]*(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")
_MIX = 0x9E3779B97F4A7C15


def _untag(m: re.Match) -> str:
    s = m.group()
    return html.unescape(s) if s[0] == "&" else chr(int(s[2:], 16)) if s[:2] == "\\u" else " "


def normal_words(text: str) -> list[str]:
    if "<" in text or "&" in text or "\\" in text:
        text = _TAG.sub(_untag, text)
    if "-\n" in text or "‐" in text or "­" in text or "¬" in text:
        text = _HYPHEN.sub("", text)
    return _WORD.findall(text.lower())


def _sentences(text: str) -> list[list[str]]:
    return [normal_words(s) for s in re.split(r"(?<=[.!?])\s+|\n+", text)]


def own_passages(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, passage, n_words): the words of each item without the sentences that other items have too.

    Sentences are counted over all items, so it doesn't matter in which block an item is taken later.  Of several
    texts of one item the greatest counts.
    """
    kind = items.schema[item_id].dataType.simpleString()
    one = items.where(F.length(text) > 0).groupBy(F.col(item_id).alias("item_id")).agg(F.max(text).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = [(key, at, " ".join(words), len(words)) for key, body in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True) for at, words in enumerate(_sentences(body)) if words]
            yield pd.DataFrame(rows, columns=["item_id", "at", "sentence", "n"])

    sentences = one.mapInPandas(run, f"item_id {kind}, at int, sentence string, n bigint")
    shared = sentences.groupBy("sentence").agg(F.count_distinct("item_id").alias("_items")).where("_items > 1").select("sentence")
    own = sentences.join(shared, "sentence", "left_anti")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "sentence"))), lambda r: r["sentence"]), " ")
    return own.groupBy("item_id").agg(words.alias("passage"), F.sum("n").alias("n_words"))


def _grams(ids):
    """Hashes of all windows of NGRAM word numbers; 0 where a window holds a word that no item has."""
    import numpy as np

    n = len(ids) - NGRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(NGRAM):
        part = ids[k : k + n]
        known &= part > 0
        h = (h ^ part.astype(np.uint64)) * np.uint64(_MIX)
        h ^= h >> np.uint64(29)
    h[~known] = 0
    return h


def _index(passages: dict[int, list[str]]) -> tuple[dict, dict, object, list]:
    """What a task needs of a block of items, in plain types: passages, word numbers, sorted n-grams, the items of each."""
    import numpy as np

    vocabulary, where = {}, defaultdict(list)
    for i, words in passages.items():
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64)
        for g in set(_grams(ids).tolist()):
            where[g].append(i)
    return passages, vocabulary, np.array(sorted(where), np.uint64), [where[g] for g in sorted(where)]


def align(passage: list[str], words: list[str]) -> tuple[int, int, int] | None:
    """(matched words, first word, last word) of the best run of ``words`` that follows the passage's order.

    Only matches of two words or more in a row count.  Where the matched words lie too thin, in the passage or
    in the document, the run is cut at its widest gap and the better part is taken.
    """
    blocks = [b for b in SequenceMatcher(None, passage, words, autojunk=False).get_matching_blocks() if b.size > 1]
    while blocks:
        matched = sum(b.size for b in blocks)
        first, last = blocks[0].b, blocks[-1].b + blocks[-1].size - 1
        within = blocks[-1].a + blocks[-1].size - blocks[0].a
        if matched >= MIN_KEPT * within and matched >= MIN_DENSITY * (last - first + 1):
            return matched, first, last
        gap = max(range(1, len(blocks)), key=lambda k: max(blocks[k].b - blocks[k - 1].b, blocks[k].a - blocks[k - 1].a) - blocks[k - 1].size)
        blocks = max(blocks[:gap], blocks[gap:], key=lambda part: sum(b.size for b in part))
    return None


def _runs(passage: list[str], words: list[str], low: int, high: int, places: list[int]) -> Iterator[tuple[int, int, int]]:
    """(matched words, first word, last word) of every verified run of the passage in ``words[low:high]``; places: where n-grams of it begin, sorted.

    The words left and right of a run are aligned again.  Only a few times the passage's length is aligned at once, so
    many copies in a row cost in proportion to their number.
    """
    enough, window, open_ = min(MIN_WORDS, len(passage)), 4 * len(passage) + 80, [(low, high)]
    while open_:
        low, high = open_.pop()
        if high - low < enough or bisect_right(places, high - NGRAM) - bisect_left(places, low) + NGRAM - 1 < MIN_WORDS // 3:
            continue
        end = min(high, low + window)
        got = align(passage, words[low:end])
        if not got:
            if end < high:
                open_.append((end - 2 * len(passage), high))
            continue
        first, last = got[1] + low, got[2] + low
        if end < high and last + len(passage) >= end and first > low:  # it may go on beyond the window
            open_ += [(low, first), (first, high)]
            continue
        if got[0] >= enough:
            yield got[0], first, last
        open_ += [(low, first), (last + 1, high)]


def _verify(passages: dict, items: list, words: list[str], hits: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list]]:
    """(item, matched, first, last, spans) of each item that is really there.  hits: (position, gram number).

    The first numbers are those of the best run; ``spans`` are all verified ones.
    """
    near: dict[int, list[int]] = defaultdict(list)
    for at, g in hits:
        for i in items[g]:
            near[i].append(at)
    found = []
    for i, places in near.items():
        passage = passages[i]
        reach, runs, group = len(passage), set(), [places[0]]
        for at in [*places[1:], None]:
            if at is not None and at - group[-1] <= reach:
                group.append(at)
                continue
            if len(group) + NGRAM - 1 >= MIN_WORDS // 3:
                runs.update(_runs(passage, words, max(0, group[0] - 40), min(len(words), group[-1] + NGRAM + 40), places))
            group = [at]
        if runs:
            best = max(runs, key=lambda r: (r[0], -r[1]))
            found.append((i, *best, sorted({(first, last) for _, first, last in runs})))
    return found


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", *, spans: bool = False) -> DataFrame:
    """``doc_id, item_id, matched_words, passage_words``, one row for each leaked pair.

    With ``spans`` also ``first_word`` and ``last_word``, the place of the best run in the document's normalised words,
    and ``spans``, the places of all verified runs: a passage may stand in a document more than once.
    Beyond BLOCK_WORDS the items are taken in blocks of about that size by a hash of the item, each of which passes
    over the documents once, is written, and is released before the next; results are the same.
    """
    d, i = documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {d}, item_id {i}, matched_words bigint, passage_words bigint, first_word bigint, last_word bigint, spans array<struct<first_word:bigint,last_word:bigint>>"
    names = ["doc_id", "item_id", "matched_words", "passage_words", "first_word", "last_word", "spans"]
    docs = documents.select(doc_id, doc_text).where(F.length(doc_text) > 0)
    own = materialize(own_passages(items, item_id, item_text), "passages")
    blocks = -(-(own.agg(F.sum("n_words")).first()[0] or 0) // BLOCK_WORDS)
    found = None
    for block in range(blocks):
        mine = own.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else own
        passages = {r[0]: r[1].split(" ") for r in mine.select("item_id", "passage").toLocalIterator()}
        if not passages:
            continue
        shared = documents.sparkSession.sparkContext.broadcast(_index(passages))

        def run(batches: Iterator, shared=shared) -> Iterator:
            import numpy as np
            import pandas as pd

            passages, vocabulary, known, owners = shared.value
            number = vocabulary.get
            for batch in batches:
                keys, all_words, starts, ids = batch.iloc[:, 0].tolist(), [], [0], []
                for text in batch.iloc[:, 1]:
                    words = normal_words(text)
                    all_words.append(words)
                    ids.extend([number(w, 0) for w in words])
                    ids.extend([0] * NGRAM)  # no window reaches into the next document
                    starts.append(len(ids))
                grams = _grams(np.array(ids, np.int64))
                at = np.flatnonzero(grams)
                place = np.searchsorted(known, grams[at])
                place[place == len(known)] = 0
                real = known[place] == grams[at] if len(known) else np.zeros(len(at), bool)
                at, place = at[real], place[real]
                owner = np.searchsorted(np.array(starts), at, side="right") - 1
                out = []
                for doc in np.unique(owner).tolist():
                    mine = owner == doc
                    hits = list(zip((at[mine] - starts[doc]).tolist(), place[mine].tolist(), strict=True))
                    for item, matched, first, last, runs in _verify(passages, owners, all_words[doc], hits):
                        out.append((keys[doc], item, matched, len(passages[item]), first, last, [{"first_word": a, "last_word": b} for a, b in runs]))
                if out:
                    yield pd.DataFrame(out, columns=names)

        part = docs.mapInPandas(run, schema)
        if blocks > 1:  # one block at a time in the memory of a task and of the driver
            part = materialize(part, "leaks")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = documents.sparkSession.createDataFrame([], schema)
    return found if spans else found.drop("first_word", "last_word", "spans")


def leaked_items(leaks: DataFrame, items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Every item with the number of documents that hold it and the greatest share of its words found in one."""
    by = leaks.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max(F.col("matched_words") / F.col("passage_words")).alias("max_share"))
    return items.select(F.col(item_id).alias("item_id")).distinct().join(by, "item_id", "left").select("item_id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce(F.least("max_share", F.lit(1.0)), F.lit(0.0)).alias("max_share"), F.col("n_docs").isNotNull().alias("leaked"))


def without_leaks(documents: DataFrame, leaks: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", *, drop_share: float = 0.5) -> DataFrame:
    """``doc_id, text, removed_spans``: the documents of ``leaks`` (with spans) with the passages cut out.

    A document of which the passages make up ``drop_share`` of the words or more has a null text: drop it.
    Documents without leaks aren't returned; they stay as they are.
    """
    d = documents.schema[doc_id].dataType.simpleString()
    spans = leaks.select(F.col("doc_id").alias(doc_id), F.explode("spans").alias("_span")).groupBy(doc_id).agg(F.collect_set(F.array("_span.first_word", "_span.last_word")).alias("_spans"))
    some = documents.select(doc_id, doc_text).join(spans, doc_id)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for key, text, found in batch.itertuples(index=False, name=None):
                places = word_places(text)
                gone, kept, at = 0, [], 0
                for first, last in merged([(int(a), int(b)) for a, b in found]):
                    kept.append(text[at : places[first][0]])
                    at = places[last][1]
                    gone += last - first + 1
                kept.append(text[at:])
                out.append((key, None if gone >= drop_share * len(places) else "".join(kept), len(found)))
            yield pd.DataFrame(out, columns=["doc_id", "text", "removed_spans"])

    return some.mapInPandas(run, f"doc_id {d}, text string, removed_spans bigint")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def word_places(text: str) -> list[tuple[int, int]]:
    """(start, end) in ``text`` of each of its normalised words, in the numbering of ``normal_words``."""
    origin = None
    low = text
    for pattern, put in ((_TAG, _untag), (_HYPHEN, lambda m: "")):
        if pattern is _TAG and not ("<" in low or "&" in low or "\\" in low) or pattern is _HYPHEN and not ("-\n" in low or re.search("[‐­¬]", low)):
            continue
        parts, back, at = [], [], 0
        old = origin if origin is not None else range(len(low))
        for m in pattern.finditer(low):
            new = put(m)
            parts += [low[at : m.start()], new]
            back += [*old[at : m.start()], *[old[m.start()]] * len(new)]
            at = m.end()
        parts.append(low[at:])
        back += old[at:]
        low, origin = "".join(parts), back
    lowered = low.lower()
    if len(lowered) != len(low):  # a letter whose small form is longer
        wide = [k for k, ch in enumerate(low) for _ in ch.lower()]
        origin = wide if origin is None else [origin[k] for k in wide]
    if origin is None:
        return [m.span() for m in _WORD.finditer(lowered)]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer(lowered)]
