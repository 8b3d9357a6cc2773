"""Text from scanned pages: divided words, misread characters, running headers and page numbers.

Misread words: all words are counted; for each rare word, candidates are looked up among the more frequent ones by
an inverted join on character q-grams, and gradient-boosted trees choose the replacement, or none, from the cost of
the confusions that turn one into the other, both frequencies and the shared q-grams.  Lines: trees judge each line
(furniture or text) from its form and its neighbours, and each pair of lines with a hyphen at the break (one word or
a real compound) from how often the halves, the whole and the compound occur.  The trees are trained here, on a
bounded sample of frequent words (``SAMPLE_WORDS``) with noise put in and on generated line pairs; counts, candidates
and decisions cover all data.

Defined results: null and blank texts aren't cases.  Repeated rows of a key count once; a key is a case if any of its
texts is.  Texts are read whole.  Runs of letters longer than ``MAX_WORD``, with marks of an encoding inside, or in
scripts without spaces aren't words and are never replaced.  A text without a case is returned by no query.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm import boosting
from leafwork.llm.furniture import NUMBERED, PAGE_NUMBER, ROMAN_NUMBERED, SENTENCE_END, headline
from leafwork.runtime import broadcast_if_small, materialize

#: Words the ranker is trained on; how much rarer than its replacement a misread word is; accepted probabilities.
SAMPLE_WORDS, RARER, ACCEPT, ACCEPT_LINE, ACCEPT_FURNITURE = 3000, 6.0, 0.5, 0.5, 0.65
QGRAM, SHARED, MIN_WORD, MAX_WORD = 2, 0.3, 3, 24
#: What a scanner reads for what is printed.
CONFUSIONS = (
    ("m", "rn"), ("rn", "m"), ("d", "cl"), ("cl", "d"), ("w", "vv"), ("u", "ii"), ("n", "ri"), ("h", "li"), ("li", "h"),
    ("e", "c"), ("c", "e"), ("h", "b"), ("b", "h"), ("t", "f"), ("f", "t"), ("i", "l"), ("l", "i"), ("l", "1"), ("i", "1"), ("o", "0"),
    ("s", "5"), ("b", "6"), ("g", "9"), ("z", "2"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("g", "q"), ("b", "8"),
    ("u", "v"), ("v", "u"), ("n", "u"), ("u", "n"),
)
_SEEN = {}
for _true, _seen in CONFUSIONS:  # noqa: B007
    _SEEN.setdefault(_seen, []).append(_true)
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\W_]+")
_BLOB = re.compile(r"[/+=@\\<>{}]|^\S{31,}$")
_NO_PROSE = re.compile(r"[/+=@\\<>{}]|\S{31}|[぀-ヿ㐀-鿿가-힯]")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_HYPHENS = "-‐¬­‑"
_BREAK = re.compile(r"([^\W\d_]+|[^\W_]*[^\W\d_])([-‐¬­‑])[ \t]*$")
#: The same for whole texts and for both engines: a word divided at a break of line, put together.
DIVIDED = r"(?<!\p{L})(\p{L}++)[-‐¬\u00AD‑][ \t]*\n[ \t]*(\p{L}+)"
#: A last word without a mark after it may be cut; a piece of a word is like too many words.  It is judged unless a
#: frequent word begins with it.
CUT_OFF = r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++\s*+(?:\[?(?:\.{3}|…|\x{FFFD})\]?)?\s*+(?:\(more\))?\s*+$"
_DIVIDED = re.compile(r"(?<![^\W\d_])([^\W\d_]++)[-‐¬­‑][ \t]*\n[ \t]*([^\W\d_]+)")
_NEXT = re.compile(r"^[ \t]*([^\W_]+)")
_COMPOUND = re.compile(r"(?<![^\W_])([^\W\d_]{2,})-([^\W\d_]{2,})(?![^\W_])")
_SPACED = re.compile(r"(?<![^\s(\"'])([^\W\d_](?: [^\W\d_]){2,})(?![^\W_])")


def tokens_of(text: str) -> list[str]:
    """The tokens of a text, as written, without blobs and scripts without spaces."""
    if "\n" in text:
        text = _DIVIDED.sub(r"\1\2", text)
    if not _NO_PROSE.search(text):
        return _TOKEN.findall(text)
    return [w for chunk in _CHUNK.findall(text) if not (_BLOB.search(chunk) or _WIDE.search(chunk)) for w in _TOKEN.findall(chunk)]


def plausible(w: str) -> bool:
    """Letters, with at most two digits that look like letters, in a word that isn't a code."""
    if w.isalpha():
        return True
    digits = [c for c in w if not c.isalpha()]
    small = sum(c.islower() for c in w)
    return len(digits) <= 2 and small >= 2 and small + 1 >= len(w) - len(digits) and all(c in "01568929" for c in digits)


def vocabulary(texts: DataFrame) -> DataFrame:
    """(kind, word, n): w for small-letter words, c for compounds with a hyphen inside a line; over all texts."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            raw: Counter = Counter()
            seen: Counter = Counter()
            for text in batch.iloc[:, 0]:
                raw.update(tokens_of(text))
                if "-" in text:
                    seen.update(("c", f"{a.lower()}-{b.lower()}") for a, b in _COMPOUND.findall(text))
            for w, n in raw.items():  # each distinct token of a batch is judged once
                if MIN_WORD <= len(w) <= MAX_WORD and plausible(w):
                    seen["w", w.lower()] += n
            yield pd.DataFrame([(k, w, n) for (k, w), n in seen.items()], columns=["kind", "word", "n"])

    return texts.select("text").mapInPandas(run, "kind string, word string, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"))


def confusion_cost(seen: str, true: str, limit: float = 3.0) -> tuple[float, int, int]:
    """(cost, confusions, other changes) of the cheapest way from ``true`` to ``seen``: 0.3 a confusion, 1 a change."""
    n, m = len(seen), len(true)
    best: list[list[tuple[float, int, int]]] = [[(99.0, 0, 0)] * (m + 1) for _ in range(n + 1)]
    best[0][0] = (0.0, 0, 0)
    for i in range(n + 1):
        for j in range(max(0, i - 4), min(m, i + 4) + 1):
            cost, c, o = best[i][j]
            if cost > limit:
                continue
            if i < n and j < m and seen[i] == true[j] and cost < best[i + 1][j + 1][0]:
                best[i + 1][j + 1] = (cost, c, o)
            for size in (1, 2):
                for was in _SEEN.get(seen[i : i + size], ()) if i + size <= n else ():
                    k = j + len(was)
                    if true[j:k] == was and cost + 0.3 < best[i + size][k][0]:
                        best[i + size][k] = (cost + 0.3, c + 1, o)
            for di, dj in ((1, 1), (1, 0), (0, 1)):
                if i + di <= n and j + dj <= m and cost + 1 < best[i + di][j + dj][0]:
                    best[i + di][j + dj] = (cost + 1, c, o + 1)
    return best[n][m]


def _qgrams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[k : k + QGRAM] for k in range(len(padded) - QGRAM + 1)]


def rank_features(seen: str, true: str, n_seen: float, n_true: float) -> list[float]:
    import math

    cost, confusions, others = confusion_cost(seen, true)
    a, b = set(_qgrams(seen)), set(_qgrams(true))
    tail = abs(len(seen) - len(true)) if seen.startswith(true) or true.startswith(seen) else 0
    return [
        min(cost, 9.0), confusions, others, cost / len(true), math.log((n_true + 1) / (n_seen + 1)), math.log(n_true + 1), len(seen), len(a & b) / len(a | b),
        float(any(c.isdigit() or c in "ﬁﬂ" for c in seen)), float(tail), float(seen[0] != true[0]),
    ]


def clean_sample(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The sample without words that are one or two confusions away from a much more frequent one: they may be noise."""
    by_gram: dict[str, list[tuple[str, int]]] = {}
    kept = []
    for w, n in sorted(sample, key=lambda x: (-x[1], x[0])):
        grams = set(_qgrams(w))
        shared = Counter(k for g in grams for k in by_gram.get(g, ()))
        if any(m >= RARER * n and c >= SHARED * len(grams) and confusion_cost(w, v, 0.7)[0] <= 0.6 for (v, m), c in shared.items()):
            continue
        kept.append((w, n))
        for g in grams:
            by_gram.setdefault(g, []).append((w, n))
    return kept


def frequent_sample(words: DataFrame) -> list[tuple[str, int]]:
    """At most SAMPLE_WORDS frequent words, chosen by hash, cleaned."""
    common = words.where((F.col("n") >= RARER) & F.col("word").rlike(r"^\p{L}+$"))
    return clean_sample([(r[0], r[1]) for r in common.orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS).collect()])


def train_ranker(sample: list[tuple[str, int]], seed: int = 7) -> dict:
    """Trees that tell a misread word and its true one from two words that are only alike."""
    import random

    rng = random.Random(seed)
    common = [(w, n) for w, n in sample if w.isalpha() and len(w) >= MIN_WORD]
    by_gram: dict[str, list[int]] = {}
    for k, (w, _) in enumerate(common):
        for g in set(_qgrams(w)):
            by_gram.setdefault(g, []).append(k)

    def alike(word: str, but: int) -> list[int]:
        shared = Counter(k for g in set(_qgrams(word)) for k in by_gram.get(g, ()))
        return [k for k, _ in shared.most_common(4) if k != but][:3]

    x, y = [], []
    for k, (w, n) in enumerate(common):
        seen = corrupt(w, rng)
        if seen and seen != w:
            few = rng.choice((1, 1, 2, 3))
            x.append(rank_features(seen, w, few, n))
            y.append(1)
            for other in alike(seen, k):
                x.append(rank_features(seen, common[other][0], few, common[other][1]))
                y.append(0)
        letters = list(w)
        for _ in range(rng.choice((1, 1, 2))):  # a rare real word a letter or two away is no misread one
            letters[rng.randrange(len(w))] = rng.choice("abcdefghijklmnopqrstuvwxyz")
        f = rank_features("".join(letters), w, rng.choice((1, 1, 2, 3)), n)
        if f[2] > 0:
            x.append(f)
            y.append(0)
        for other in alike(w, k):  # real words, some of them as rare as noise
            x.append(rank_features(w, common[other][0], rng.choice((1, 2, n)), common[other][1]))
            y.append(0)
    return boosting.fit(x, y) if len(set(y)) == 2 else {"start": -9.0, "trees": []}


def corrupt(word: str, rng) -> str | None:
    """The word with one or two confusions, or None if it has nothing to confuse."""
    for _ in range(1 if rng.random() < 0.8 else 2):
        places = [(at, true, seen) for true, seen in CONFUSIONS for at in range(len(word)) if word.startswith(true, at)]
        if not places:
            return None
        at, true, seen = rng.choice(places)
        word = word[:at] + seen + word[at + len(true) :]
    return word


def corrections(words: DataFrame, sample: list[tuple[str, int]]) -> DataFrame:
    """(seen, true, p): the replacement chosen for each misread word; words: word, n, over all texts.

    The inverted join is on pairs of q-gram and its place, give or take one, between words of about the same length,
    where one is RARER than the other; so it grows with the words and not with the texts.
    """
    common = words.where((F.col("n") >= RARER) & F.col("word").rlike(r"^\p{L}+$"))
    model = train_ranker(sample)
    top = words.agg(F.max("n")).first()[0] or 0
    size = F.length("word")

    def grams(df: DataFrame) -> DataFrame:
        padded = F.concat(F.lit("^"), "word", F.lit("$"))
        return df.select("word", "n", F.posexplode(F.transform(F.sequence(F.lit(1), size + 3 - QGRAM), lambda k: F.substring(padded, k, QGRAM))).alias("at", "gram"))

    left = grams(words.where(F.col("n") * RARER <= top)).select(F.col("word").alias("seen"), F.col("n").alias("n_seen"), "gram", "at")
    right = grams(common).select(F.col("word").alias("true"), F.col("n").alias("n_true"), "gram", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)).alias("at"))
    # the q-grams are many times the words they come from, so their size on disk must not choose a broadcast
    near = left.join(right.hint("merge"), ["gram", "at"]).where((F.col("n_true") >= RARER * F.col("n_seen")) & (F.abs(F.length("seen") - F.length("true")) <= 2))
    pairs = near.groupBy("seen", "true").agg(F.count(F.lit(1)).alias("shared"), F.max("n_seen").alias("n_seen"), F.max("n_true").alias("n_true"))
    pairs = pairs.where(F.col("shared") >= SHARED * (F.length("seen") + 1))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows, x = [], []
            for seen, true, n_seen, n_true in batch.itertuples(index=False, name=None):
                f = rank_features(seen, true, n_seen, n_true)
                if f[0] <= 3.0:  # beyond that no way from one to the other was found
                    rows.append((seen, true))
                    x.append(f)
            p = boosting.predict(model, x) if x else []
            yield pd.DataFrame([(s, t, float(q)) for (s, t), q in zip(rows, p, strict=True) if q >= ACCEPT], columns=["seen", "true", "p"])

    ranked = pairs.select("seen", "true", "n_seen", "n_true").mapInPandas(run, "seen string, true string, p double")
    ligatures = words.where(F.col("word").rlike("[ﬀ-ﬄ]")).select(F.col("word").alias("seen"), F.expr("replace(replace(replace(replace(replace(word,'ﬀ','ff'),'ﬁ','fi'),'ﬂ','fl'),'ﬃ','ffi'),'ﬄ','ffl')").alias("true"), F.lit(1.0).alias("p"))
    return ranked.unionByName(ligatures).groupBy("seen").agg(F.max(F.struct("p", "true")).alias("best")).select("seen", "best.true", "best.p")


def page_features(lines: list[str]) -> tuple[list[int], list[list[float]]]:
    """The indexes of the lines that aren't blank and, for each, its form and what its neighbours say: does the sentence go on across it?"""
    kept = [k for k, s in enumerate(lines) if s.strip()]
    stripped = [lines[k].strip() for k in kept]
    usual, total = _usual(lines), sum(map(len, stripped))
    rows = []
    for at, (k, s) in enumerate(zip(kept, stripped, strict=True)):
        before, after = stripped[at - 1] if at else "", stripped[at + 1] if at + 1 < len(kept) else ""
        letters = sum(map(str.isalpha, s))
        open_before = bool(before) and not SENTENCE_END.search(before)
        digit = any(map(str.isdigit, s))
        rows.append([
            float(bool(PAGE_NUMBER.match(s))), float((digit and bool(NUMBERED.search(s))) or bool(ROMAN_NUMBERED.search(s))), float(headline(s)), len(s) / usual, letters / max(1, len(s)),
            sum(map(str.isupper, s)) / max(1, letters), float(bool(SENTENCE_END.search(s))), float(s.count(" | ")), float(bool(re.match(r"(?:[-*•]|\d{1,2}[.)])\s", s))),
            float(open_before), float(after[:1].islower()), float(not before), float(not after), float(bool(before) and before[-1] in _HYPHENS), float(len(s.split())),
            float(s[:1].islower()), float(open_before and after[:1].islower() and not s[:1].islower()), float(k > 0 and not lines[k - 1].strip()), float(k + 1 < len(lines) and not lines[k + 1].strip()), float(before.count(" | ") + after.count(" | ")), float(s[-1] in _HYPHENS), len(s) / max(1, len(before)),
            float(bool(re.match(r"#{1,6}\s|[=*_]{2}", s))), float(s in (before, after)), len(s) / (total / len(kept)),
            (usual - len(s) - 1 - len(after.split(" ", 1)[0])) / usual if after else 0.0,  # would the next word have found room?
        ])
    return kept, rows


def train_furniture(sample: list[str], seed: int = 11) -> dict:
    """Trees for furniture, on pages made of the sample's words with generated headers and numbers put in."""
    import random

    rng = random.Random(seed)
    words = [w for w in sample if w.isalpha()] or ["word", "line", "page"]
    x, y = [], []

    def title(n):
        return " ".join(rng.choice(words).capitalize() for _ in range(n))

    def spelled(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def number():
        n = rng.randint(1, 400)
        return rng.choice([f"{n}", f"- {n} -", f"— {n} —", f"[{n}]", f"p. {n}", f"Page {n} of {n + 9}", f"Seite {n}", f"{n} / {n + 50}", rng.choice(["ii", "iv", "vii", "viii", "xi", "xii", "xxii", "xvii"])])

    def furniture():
        """(line, whether it shows by its form alone)"""
        t = title(rng.randint(2, 3))
        if rng.random() < 0.35:  # lines that only their place gives away
            return rng.choice([spelled(1).capitalize(), spelled(2), f"{spelled(2)}, {spelled(2)}", f"{spelled(2)}, {spelled(3)}", spelled(3), f"{spelled(1).capitalize()} {spelled(rng.randint(1, 2))}", title(1), f"{title(1)} {rng.choice(words)}", f"{rng.choice(words)} {number()}"]), False
        return rng.choice([number(), number(), number(), f"{rng.randint(1, 300)} | {t}", f"Chapter {rng.randint(1, 20)}   {t}   {rng.randint(1, 300)}", f"{t.upper()}   {number()}", t.upper(), f"{t} {rng.randint(1990, 2030)}", f"{title(1)} & {title(1)}: {t}", f"{title(2)} · {title(1)} · Vol. {rng.randint(1, 40)}", f"{t} {number()}", t]), True

    for _ in range(1400):
        width, lines = rng.randint(40, 70), []
        for _ in range(rng.randint(1, 4)):
            text = " ".join([rng.choice(words).capitalize(), *(rng.choice(words) if rng.random() < 0.88 else rng.choice([title(1), title(2), str(rng.randint(1, 2030))]) for _ in range(rng.randint(9, 26)))]) + rng.choice(".....?!")
            lines += text.split()
        page, row = [], ""
        for w in lines:
            if len(row) + len(w) > width:
                page.append(row)
                row = w
            else:
                row = f"{row} {w}".strip()
            if row == w and len(w) > 6 and page and rng.random() < 0.15:  # a word divided by the break
                page[-1] += " " + w[:3] + "-"
                row = w[3:]
        page.append(row)
        if rng.random() < 0.25:  # broken off
            page[-1] = page[-1][: rng.randint(3, max(4, len(page[-1])))].rstrip() or "x"
        wide = len(page)
        extra = rng.random()
        if extra < 0.2:
            page += ["", *(f"- {rng.choice(words)}-{rng.choice(words)} {rng.choice(words)}" if rng.random() < 0.7 else f"- {rng.randint(1, 40)} {rng.choice(words)}" for _ in range(3))]
        elif extra < 0.4:
            page += [f"{title(1)} | {rng.randint(2009, 2025)} | {rng.randint(2009, 2025)}", *(f"{title(rng.randint(1, 2))} | {rng.randint(1, 99)} | {rng.randint(1, 99)}" for _ in range(2))]
        elif extra < 0.5:
            page += [rng.choice([f"{k + 1}. {spelled(rng.randint(1, 4))}", f"{k + 1}) {title(1)} {spelled(2)}"]) for k in range(rng.randint(2, 4))]
        elif extra < 0.6:
            page = [f"{rng.choice(words)}: {spelled(rng.randint(1, 3))}" if rng.random() < 0.5 else f"{title(1)} {rng.choice(words)}: {rng.randint(1, 900)}" for _ in range(rng.randint(2, 6))]
            wide = len(page)
        elif extra < 0.65:  # a heading of its own above the text
            page[:0] = [rng.choice([title(2), f"{title(1)} {spelled(2)}"]), ""]
            wide += 2
        elif extra < 0.72:
            page += ["", rng.choice([f"Source: {title(1)} {rng.choice(words)} survey, {rng.randint(2009, 2025)}", f"{title(1)} = {rng.randint(2, 9)}x + {rng.randint(2, 99)}", f"({spelled(3)})"])]
        elif extra < 0.82:  # sections with headings
            page = [x for k in range(rng.randint(1, 3)) for x in (rng.choice([f"{'#' * rng.randint(1, 4)} {title(rng.randint(1, 3))}", f"**{title(2)}**"]), "", *page, *([""] if rng.random() < 0.7 else []))]
            wide = 0
        elif extra < 0.86:  # lines of a word or two, often the same
            w = spelled(1)
            page = [rng.choice([w, w.capitalize(), spelled(1)]) if rng.random() < 0.3 else w for _ in range(rng.randint(3, 14))]
            wide = 0
        elif extra < 0.91:  # a message or a caption on a few short lines
            page = [rng.choice([f"{title(2)}", f"{title(1).upper()} {rng.randint(1, 900)} - {title(2)}", f"{title(1)} {spelled(1)} {rng.randint(1, 99999999)}", f"{title(1).upper()} - {spelled(1)}", f"{title(1)} {spelled(rng.randint(2, 4))}"]) for _ in range(rng.randint(2, 3))]
        marks = [0] * len(page)
        for _ in range(rng.choice((0, 0, 1, 1, 2)) if extra < 0.82 else 0):
            line, shows = furniture()
            inner = [k for k in range(1, wide) if page[k - 1].strip() and page[k].strip() and not SENTENCE_END.search(page[k - 1]) and page[k][:1].islower() and not marks[k - 1] and not marks[k]]
            if not shows and not inner:
                continue
            at = rng.choice((0, len(page), rng.randint(0, len(page)))) if shows else rng.choice(inner)
            new = [line] if rng.random() < 0.7 else ["", line, ""]
            page[at:at], marks[at:at] = new, [int(bool(s)) for s in new]
            wide += len(new) if at < wide else 0
        kept, rows = page_features(page)
        x += rows
        y += [marks[k] for k in kept]
    return boosting.fit(x, y, trees=70, depth=4)


def _usual(lines: list[str]) -> float:
    sizes = sorted(len(s.strip()) for s in lines if s.strip())
    return float(max(12, sizes[(len(sizes) * 3) // 4])) if sizes else 40.0


def join_features(left: str, mark: str, right: str, n_left: float, n_right: float, n_whole: float, n_compound: float) -> list[float]:
    import math

    return [math.log(n_left + 1), math.log(n_right + 1), math.log(n_whole + 1), math.log(n_compound + 1), float(mark != "-"), len(left), len(right), float(right[:1].islower()), math.log(n_whole + 1) - math.log(n_compound + 1)]


def train_joins(sample: list[tuple[str, int]], compounds: list[tuple[str, int]], counts: dict[str, int], seed: int = 13) -> dict:
    """Trees for the hyphen at a break of line: words cut anywhere against compounds cut at their hyphen."""
    import random

    rng = random.Random(seed)
    x, y = [], []
    for w, n in sample:
        if len(w) < 5 or not w.isalpha():
            continue
        at = rng.randint(2, len(w) - 2)
        whole = n if rng.random() < 0.8 else 0  # the whole may be misread
        halves = [max(counts.get(h, 0), rng.choice((0, 0, 30, 300)) if whole else 0) for h in (w[:at], w[at:])]  # a half may be a word
        x.append(join_features(w[:at], rng.choice("--‐¬­"), w[at:], *halves, whole, 0))
        y.append(1)
    for c, n in compounds:
        a, b = c.split("-", 1)
        for _ in range(max(1, 800 // max(1, len(compounds)))):
            seen = n if rng.random() < 0.7 else 0
            x.append(join_features(a, "-", b, max(counts.get(a, 0), rng.choice((0, 5, 40))), max(counts.get(b, 0), rng.choice((3, 20, 90))), 0, seen))
            y.append(0)
    if len(set(y)) < 2:
        return {"start": 3.0, "trees": []}
    return boosting.fit(x, y, trees=40)


def page_lines(texts: DataFrame, keys: list[str], model: dict) -> DataFrame:
    """``keys, furniture, breaks, spaced`` for the texts of several lines: indexes of furniture lines, hyphens at breaks."""
    schema = ", ".join([*(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keys), "furniture array<int>, breaks array<struct<line:int,left:string,mark:string,right:string>>, spaced boolean"])
    names = [*keys, "furniture", "breaks", "spaced"]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            pages, x = [], []
            for *key, text in batch.itertuples(index=False, name=None):
                lines = text.split("\n")
                asked, rows = page_features(lines)  # every line is judged
                x.extend(rows)
                pages.append((key, text, lines, asked))
            p = boosting.predict(model, x).tolist() if x else []
            out, at = [], 0
            for key, text, lines, asked in pages:
                gone = [k for k, q in zip(asked, p[at : at + len(asked)], strict=True) if q >= ACCEPT_FURNITURE]
                at += len(asked)
                breaks, kept = [], [k for k, s in enumerate(lines) if s.strip() and k not in gone]
                for a, b in zip(kept, kept[1:]):
                    if lines[a].rstrip()[-1:] not in _HYPHENS:
                        continue
                    m, n = _BREAK.search(lines[a]), _NEXT.match(lines[b])
                    if m and n:
                        breaks.append({"line": a, "left": m[1], "mark": m[2], "right": n[1]})
                spaced = any(len(m[1]) > 4 for m in _SPACED.finditer(text))
                if gone or breaks or spaced:
                    out.append((*key, gone, breaks, spaced))
            if out:
                yield pd.DataFrame(out, columns=names)

    return texts.where(F.col("text").contains("\n")).select(*keys, "text").mapInPandas(run, schema)


def judge(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For ``keys`` and ``text``: misread words (keys, seen, true, small), lines (of ``page_lines``) and joins (keys, line, join)."""
    texts = df.select(*keys, "text").where(F.length("text") > 0)
    counts = materialize(vocabulary(texts), "vocabulary")
    words = counts.where("kind = 'w'").select("word", "n")
    sample = frequent_sample(words)
    compounds = [(r[0], r[1]) for r in counts.where("kind = 'c'").select("word", "n").orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS // 10).collect()]
    fixed = broadcast_if_small(corrections(words, sample), "corrections")
    joined = F.when(F.col("text").contains("\n"), F.regexp_replace("text", DIVIDED, "$1$2")).otherwise(F.col("text"))

    def words_of(text: Column) -> Column:
        """The distinct words; the last one, if no mark stands after it, only behind a hyphen."""
        split = lambda s: F.split(s, r"[^\p{L}\p{N}]+")
        apart = F.transform(F.array(F.regexp_replace(text, CUT_OFF, "")), lambda w: F.concat(F.array_distinct(split(w)), F.array(F.concat(F.lit("-"), split(F.substr(text, F.length(w) + 1))[0]))))
        return F.flatten(apart)

    tokens = texts.select(*keys, F.explode(F.flatten(F.transform(F.array(joined), words_of))).alias("_t"))
    tokens = tokens.select(*keys, F.ltrim(F.col("_t"), F.lit("-")).alias("token"), F.startswith("_t", F.lit("-")).alias("last")).where(F.length("token").between(MIN_WORD, MAX_WORD)).withColumn("seen", F.lower("token"))
    tokens = tokens.where((F.length("token") > MIN_WORD) | ~F.col("token").rlike(r"^\p{Lu}"))  # a short name is like too many words
    common = words.where((F.col("n") >= RARER) & F.col("word").rlike(r"^\p{L}+$") & (F.length("word") > MIN_WORD))
    begun = common.select(F.explode(F.transform(F.sequence(F.lit(MIN_WORD), F.length("word") - 1), lambda k: F.substring("word", 1, k))).alias("seen")).join(fixed.select("seen"), "seen", "left_semi").distinct().withColumn("begun", F.lit(True))
    fixed = broadcast_if_small(fixed.join(begun, "seen", "left").select("seen", "true", F.coalesce("begun", F.lit(False)).alias("begun")), "fixed")
    misread = tokens.join(fixed, "seen").where(~(F.col("last") & F.col("begun"))).select(*keys, F.col("token").alias("seen"), "true", F.col("token").rlike(r"^[\p{Ll}\d]").alias("small")).distinct()
    lines = materialize(page_lines(texts, keys, train_furniture([w for w, _ in sample])), "lines")
    breaks = lines.select(*keys, F.explode("breaks").alias("b")).select(*keys, "b.line", "b.left", "b.mark", "b.right").distinct()
    halves = {"n_left": F.lower("left"), "n_right": F.lower("right"), "n_whole": F.lower(F.concat("left", "right"))}
    for name, word in halves.items():
        breaks = breaks.withColumn("_w", word).join(words.select(F.col("word").alias("_w"), F.col("n").alias(name)), "_w", "left").drop("_w")
    known = counts.where("kind = 'c'").select(F.col("word").alias("_w"), F.col("n").alias("n_compound"))
    breaks = breaks.withColumn("_w", F.lower(F.concat_ws("-", "left", "right"))).join(known, "_w", "left").drop("_w")
    model = train_joins(sample, compounds, dict(sample))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys), "line int, join boolean"])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            batch = batch.fillna({"n_left": 0, "n_right": 0, "n_whole": 0, "n_compound": 0})
            x = [join_features(*r) for r in batch[["left", "mark", "right", "n_left", "n_right", "n_whole", "n_compound"]].itertuples(index=False, name=None)]
            batch["join"] = boosting.predict(model, x) >= ACCEPT_LINE if x else []
            yield batch[[*keys, "line", "join"]]

    return misread, lines, breaks.select(*keys, "line", "left", "mark", "right", "n_left", "n_right", "n_whole", "n_compound").mapInPandas(run, schema)


def find_scan_noise(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of the texts with a divided word, a misread word or furniture, one row for each key.

    One misread word counts if it is written small; of capitalised ones, which may be rare names, it takes two.
    """
    misread, lines, joins = judge(df, keys)
    words = misread.groupBy(*keys).agg(F.sum(F.when(F.col("small"), 2).otherwise(1)).alias("_n")).where("_n >= 2").select(*keys)
    return words.unionByName(lines.where((F.size("furniture") > 0) | F.col("spaced")).select(*keys)).unionByName(joins.where("join").select(*keys)).distinct()


def reflow(text: str, furniture: set[int], joins: set[int], words: dict[str, str]) -> str:
    """The text as paragraphs: furniture out, lines put together, words repaired; lists and tables keep their lines."""
    lines = text.split("\n")
    paragraphs: list[str] = []
    fresh, last, gap = True, -1, False
    for k, line in enumerate(lines):
        if k in furniture:
            continue
        s = line.strip()
        if not s:
            gap = True
            continue
        structured = bool(re.match(r"[-*•]\s", s)) or " | " in s
        open_ = last >= 0 and not SENTENCE_END.search(lines[last].strip())
        if last in joins:
            paragraphs[-1] = paragraphs[-1].rstrip().rstrip(_HYPHENS) + s
        elif fresh or structured or (gap and not (open_ and (last + 1 != k) and s[:1].islower())):
            paragraphs.append(s)
        elif paragraphs[-1][-1:] in "-‐‑" and last >= 0 and _BREAK.search(lines[last]):
            paragraphs[-1] += s
        else:
            paragraphs[-1] += " " + s
        fresh, last, gap = structured, k, False
    whole = _SPACED.sub(lambda m: m[1].replace(" ", ""), "\n".join(paragraphs))
    return _TOKEN.sub(lambda m: _recase(m[0], words[m[0]]) if m[0] in words else m[0], whole)


def _recase(seen: str, true: str) -> str:
    if seen.isupper() and len(seen) > 1:
        return true.upper()
    return true[:1].upper() + true[1:] if seen[:1].isupper() else true


def repair(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, repaired`` of the cases: each noisy text as continuous paragraphs."""
    misread, lines, joins = judge(df, keys)
    words = misread.groupBy(*keys).agg(F.collect_set(F.struct("seen", "true")).alias("words"), F.sum(F.when(F.col("small"), 2).otherwise(1)).alias("_n"))
    whole = joins.where("join").groupBy(*keys).agg(F.collect_set("line").alias("joins"))
    one = lines.groupBy(*keys).agg(F.max("furniture").alias("furniture"), F.max("spaced").alias("spaced"))
    facts = words.join(whole, keys, "full_outer").join(one, keys, "full_outer")
    facts = facts.where((F.col("_n") >= 2) | F.col("joins").isNotNull() | (F.size("furniture") > 0) | F.col("spaced"))
    texts = df.where(F.length("text") > 0).groupBy(*keys).agg(F.max("text").alias("text"))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys), "repaired string"])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            some = lambda v: v if v is not None and not isinstance(v, float) else []
            batch["repaired"] = [
                reflow(t, {int(k) for k in some(f)}, {int(k) for k in some(j)}, {x["seen"]: x["true"] for x in some(w)})
                for t, f, j, w in zip(batch["text"], batch["furniture"], batch["joins"], batch["words"], strict=True)
            ]
            yield batch[[*keys, "repaired"]]

    return facts.join(texts, keys).select(*keys, "text", "furniture", "joins", "words").mapInPandas(run, schema)


def scanned_texts(images: DataFrame, layout_kids: DataFrame) -> DataFrame:
    """``table_name, doc_id, item_id, text`` of both tables."""
    return images.select(F.lit("images").alias("table_name"), "doc_id", F.col("image_id").cast("long").alias("item_id"), F.col("description").alias("text")).unionByName(
        layout_kids.select(F.lit("layout_kids").alias("table_name"), "doc_id", F.col("id").cast("long").alias("item_id"), F.col("content").alias("text"))
    )
