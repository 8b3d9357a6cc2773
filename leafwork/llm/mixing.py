"""Mixing sources to target shares of the tokens, with a cap on repeats.

Sizes are tokens of a public tokenizer.  The rates come from entropy balancing: among all document rates that give
each source its tokens and stay under its cap, those nearest to one copy each in relative entropy.  They are
exponentially tilted in the document's size, ``min(cap, exp(lambda * tokens / mean))``, and the lambdas solve a
convex dual by Newton steps, safeguarded by a bracket; every step is one aggregate over the counts of documents by
source and size, which hold all that the dual needs.

The total is the greatest at which every source with documents can have its exact share.  Rates are rounded into
copies by a hash of the document, and a threshold for each source is moved until the source's tokens come within
about one document of their target; the threshold is found on histograms, so nothing is sorted.

Defined results: a document without tokens (null, empty text) or without a targeted source isn't in the mixture.  A
target without documents has the actual share 0 and the others share its part in proportion.  A share that is null
or not above 0 takes nothing; ``max_repeats`` null is 1, below 0 is 0.  Repeated targets of one source: the greatest
counts.  An empty table gives an empty mixture.
"""

from __future__ import annotations

import base64
import math
import warnings
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.runtime import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to byte-level vocabularies of this kind; a fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BINS, _ROUNDS, _TOLERANCE, _STEPS = 4096, 3, 1e-10, 400
#: A vocabulary file is sent to the tasks; a larger one is refused.
VOCABULARY_BYTES = 64 << 20


def count_tokens(documents: DataFrame, keep: list[str], text: str = "text", *, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``keep`` and ``tokens``: the length of each whole text in tokens; 0 for null and empty texts."""
    schema = ", ".join([*(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep), "tokens bigint"])
    with open(tokenizer, "rb") as f:  # read here, so executors need no copy of it
        vocabulary = f.read(VOCABULARY_BYTES + 1)
    if len(vocabulary) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large")
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator) -> Iterator:
        import tiktoken

        made = tiktoken.__dict__.setdefault("_leafwork_made", {})  # stays in the worker from task to task
        if (tokenizer, pattern) not in made:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
            made[tokenizer, pattern] = tiktoken.Encoding("leafwork", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encode = made[tokenizer, pattern].encode_ordinary
        for batch in batches:
            texts = batch.pop("_text")
            batch["tokens"] = [len(encode(t)) if t else 0 for t in texts]
            yield batch

    return documents.select(*keep, F.col(text).alias("_text")).mapInPandas(run, schema)


def _targets(mix_targets: DataFrame, at_most: int = 100_000) -> dict[str, tuple[float, int]]:
    rows = mix_targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share"), F.max(F.coalesce("max_repeats", F.lit(1)))).limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError("the table of targets is meant to be small")
    return {s: (float(share), int(cap)) for s, share, cap in rows if share and share > 0 and not math.isnan(share)}


def _by_source(values: dict[str, float], default: float = 0.0) -> Column:
    pairs = [x for s, v in values.items() for x in (F.lit(s), F.lit(float(v)))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("source")), F.lit(default)) if pairs else F.lit(default)


def _rate(lam: dict[str, float], mean: dict[str, float], cap: dict[str, int]) -> Column:
    """The tilted rate of a document; the exponent is bounded so that it can't overflow."""
    return F.least(_by_source(cap), F.exp(F.least(F.lit(700.0), _by_source(lam) * F.col("tokens") / _by_source(mean, 1.0))))


def balance(sizes: DataFrame, goal: dict[str, float], mean: dict[str, float], cap: dict[str, int]) -> dict[str, float]:
    """The lambda of each source with ``sum(n * tokens * rate) = goal``; sizes: source, tokens, n."""
    lam = dict.fromkeys(goal, 0.0)
    low, high = dict.fromkeys(goal, -math.inf), dict.fromkeys(goal, math.inf)
    open_ = set(goal)
    for _ in range(_STEPS):
        if not open_:
            break
        rate = _rate(lam, mean, cap)
        x = F.col("tokens") / _by_source(mean, 1.0)
        got = sizes.select("source", (F.col("n") * F.col("tokens")).alias("m"), rate.alias("w"), x.alias("x")).groupBy("source").agg(
            F.sum(F.col("m") * F.col("w")).alias("g"), F.sum(F.when(F.col("w") < _by_source(cap), F.col("m") * F.col("w") * F.col("x")).otherwise(0.0)).alias("h")
        )
        for s, g, h in got.collect():
            if s not in open_:
                continue
            off = g - goal[s]
            if abs(off) <= _TOLERANCE * goal[s]:
                open_.discard(s)
                continue
            if off > 0:
                high[s] = lam[s]
            else:
                low[s] = lam[s]
            if high[s] - low[s] < 1e-13 * max(1.0, abs(lam[s])):
                open_.discard(s)
                continue
            step = lam[s] - off / h if h > 0 else math.nan
            if not low[s] < step < high[s]:  # also where the step isn't a number
                step = lam[s] - 2.0 * max(1.0, abs(lam[s])) if low[s] == -math.inf else lam[s] + 2.0 * max(1.0, abs(lam[s])) if high[s] == math.inf else (low[s] + high[s]) / 2
            lam[s] = step
    if open_:
        warnings.warn(f"{len(open_)} sources haven't converged after {_STEPS} steps; shares() tells how near they came", RuntimeWarning, stacklevel=2)
    return lam


def _round(rated: DataFrame, goal: dict[str, float]) -> dict[str, float]:
    """For each source the least score at which a document gets its extra copy; rated: source, tokens, rate, score."""
    low, high = dict.fromkeys(goal, -1.0), dict.fromkeys(goal, 1.0)
    base = {s: float(t) for s, t in rated.groupBy("source").agg(F.sum(F.col("tokens") * F.floor("rate"))).collect()}
    above = dict.fromkeys(goal, 0.0)  # the extra tokens of the documents above ``high``
    extra = rated.where("extra")
    for _ in range(_ROUNDS):
        lo, width = _by_source(low), (_by_source(high) - _by_source(low)) / _BINS
        inside = extra.where((F.col("score") >= lo) & (F.col("score") < _by_source(high)))
        bins = inside.groupBy("source", F.least(F.floor((F.col("score") - lo) / width), F.lit(_BINS - 1)).alias("bin")).agg(F.sum("tokens").alias("t"))
        tokens: dict[str, dict[int, int]] = {}
        for s, b, t in bins.collect():  # at most _BINS rows a source
            tokens.setdefault(s, {})[int(b)] = t
        for s in goal:
            step, total = (high[s] - low[s]) / _BINS, above[s]
            for b in sorted(tokens.get(s, {}), reverse=True):
                more = tokens[s][b]
                if base.get(s, 0.0) + total + more > goal[s]:
                    low[s], high[s], above[s] = low[s] + b * step, low[s] + (b + 1) * step, total
                    break
                total += more
            else:
                high[s], above[s] = low[s], total
    # the last bin holds a document or two: all of it or none, whichever is nearer
    lo, hi = _by_source(low), _by_source(high)
    left = {s: float(t or 0) for s, t in extra.where((F.col("score") >= lo) & (F.col("score") < hi)).groupBy("source").agg(F.sum("tokens")).collect()}
    return {s: low[s] if abs(base.get(s, 0.0) + above[s] + left.get(s, 0.0) - goal[s]) <= abs(base.get(s, 0.0) + above[s] - goal[s]) else high[s] for s in goal}


def mix(documents: DataFrame, mix_targets: DataFrame, doc_id: str = "doc_id", text: str = "text", *, seed: int = 42, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The mixture ``doc_id, source, tokens, copies`` (copies of 1 or more), and what there was: ``source, tokens, n``."""
    targets = _targets(mix_targets)
    wanted = documents.where(F.col("source").isin(*targets)) if targets else documents.where("false")
    counted = materialize(count_tokens(wanted.select(F.col(doc_id).alias("doc_id"), "source", F.col(text).alias("_t")), ["doc_id", "source"], "_t", tokenizer=tokenizer).where("tokens > 0"), "tokens")
    sizes = materialize(counted.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "sizes")
    have = {s: (int(n), int(t)) for s, n, t in sizes.groupBy("source").agg(F.sum("n"), F.sum(F.col("n") * F.col("tokens"))).collect()}
    cap = {s: max(0, targets[s][1]) for s in have}
    usable = {s: t for s, (_, t) in have.items() if cap[s] > 0}
    total = min((cap[s] * t / targets[s][0] for s, t in usable.items()), default=0.0)
    goal = {s: targets[s][0] * total for s in usable}
    mean = {s: have[s][1] / have[s][0] for s in usable}
    full = {s for s in usable if goal[s] >= cap[s] * usable[s] * (1 - 1e-12)}
    lam = balance(sizes, {s: g for s, g in goal.items() if s not in full}, mean, cap) | dict.fromkeys(full, math.inf)
    lam = {s: 1e6 if v == math.inf else v for s, v in lam.items()}
    unit = (F.xxhash64("doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    rated = counted.where(F.col("source").isin(*goal)) if goal else counted.where("false")
    rated = rated.select("doc_id", "source", "tokens", F.when(_by_source({s: s in full for s in goal}) > 0, _by_source(cap)).otherwise(_rate(lam, mean, cap)).alias("rate"), unit.alias("u"))
    part = F.col("rate") - F.floor("rate")
    rated = rated.select("doc_id", "source", "tokens", "rate", (F.col("u") + part - 1.0).alias("score"), ((part > 1e-12) & (F.col("rate") < _by_source(cap))).alias("extra"))
    at = _round(rated, goal) if goal else {}
    copies = F.least(F.floor("rate") + F.when(F.col("extra") & (F.col("score") >= _by_source(at)), 1).otherwise(0), _by_source(cap)).cast("long")
    mixture = rated.select("doc_id", "source", "tokens", copies.alias("copies")).where("copies > 0")
    return mixture, sizes


def shares(mixture: DataFrame, sizes: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """For each target ``source, target_share, max_repeats, documents, available_tokens, mixture_tokens, actual_share``."""
    targets = _targets(mix_targets)
    have = {s: (n, t) for s, n, t in sizes.groupBy("source").agg(F.sum("n"), F.sum(F.col("n") * F.col("tokens"))).collect()}
    used = {s: t for s, t in mixture.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies"))).collect()}
    whole = sum(used.values()) or 1
    rows = [(s, share, cap, *have.get(s, (0, 0)), used.get(s, 0), used.get(s, 0) / whole) for s, (share, cap) in targets.items()]
    return mixture.sparkSession.createDataFrame(rows, "source string, target_share double, max_repeats int, documents bigint, available_tokens bigint, mixture_tokens bigint, actual_share double")
