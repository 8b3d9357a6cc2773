"""Recall against a ground truth, and tallies of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tokens(texts: DataFrame, keys: list[str], pattern_set) -> DataFrame:
    """``keys, token``, distinct; ``pattern_set`` builds the array of a text's tokens."""
    return texts.select(*keys, F.explode(pattern_set).alias("token")).distinct()


def recall(reference: DataFrame, output: DataFrame, keys: list[str], every: DataFrame | None = None) -> DataFrame:
    """``keys, n_reference, n_found, recall``: the share of the reference's distinct tokens found in the output, in percent.

    Both are ``keys, token``, distinct.  With ``every`` (keys, distinct) each of its keys is listed, those without
    reference tokens with 0 and a recall of 0.0; else only keys with reference tokens are.
    """
    found = reference.join(output.select(*keys, "token", F.lit(1).alias("_hit")), [*keys, "token"], "left")
    by = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reference"), F.count("_hit").alias("n_found"))
    if every is not None:
        by = every.join(by, keys, "left").fillna(0, ["n_reference", "n_found"])
    return by.withColumn("recall", F.when(F.col("n_reference") > 0, F.lit(100.0) * F.col("n_found") / F.col("n_reference")).otherwise(0.0))


def recall_of(reference, output):
    """The same for two arrays of distinct tokens in one row; 0.0 for an empty reference."""
    return F.when(F.size(reference) > 0, F.lit(100.0) * F.size(F.array_intersect(reference, output)) / F.size(reference)).otherwise(0.0)


#: What a run is measured by.
METRICS = ("n_calls", "input_tokens", "output_tokens", "render_s", "api_s", "wall_s")


def tally(calls: DataFrame, keys: list[str], sums: tuple[str, ...] = ("input_tokens", "output_tokens")) -> DataFrame:
    """``keys, n_calls`` and the sums; null counts as 0."""
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_calls"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums])


def mean_runs(runs: DataFrame, approach: str = "approach", metrics: tuple[str, ...] = METRICS, trial: str = "trial") -> DataFrame:
    """``approach, n_slides, trials`` and the means of the metrics; n_slides is the first trial's."""
    return runs.groupBy(approach).agg(F.min_by("n_slides", trial).alias("n_slides"), F.count(F.lit(1)).alias("trials"), *[F.avg(m).alias(m) for m in metrics])


def cost(runs: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """``runs`` with ``cost``: tokens times the price of a million; prices: model, input, output.  An unknown model's cost is null.

    A price list is one row a model; of repeated rows the greatest prices count.
    """
    known = prices.groupBy(F.col("model").alias(model)).agg(F.max("input").alias("_in"), F.max("output").alias("_out"))
    total = F.col("input_tokens") / F.lit(1e6) * F.col("_in") + F.col("output_tokens") / F.lit(1e6) * F.col("_out")
    return runs.join(known, model, "left").withColumn("cost", total).drop("_in", "_out")


def compare(means: DataFrame, base: str, other: str, approach: str = "approach") -> DataFrame:
    """One row: the other approach in percent of the base, by cost (null unless both have one above 0), input tokens and wall time.

    A base of less than 1 token counts as 1, of less than a billionth of a second as that.
    """
    pick = lambda a, m: F.max(F.when(F.col(approach) == a, F.col(m)))
    one = means.agg(*[pick(a, m).alias(f"{side}_{m}") for side, a in (("b", base), ("o", other)) for m in ("cost", "input_tokens", "wall_s")])
    both = (F.col("b_cost") != 0) & (F.col("o_cost") != 0)
    return one.select(
        F.when(both, F.col("o_cost") / F.col("b_cost") * 100).alias("cost_pct"), F.when(both, (1 - F.col("o_cost") / F.col("b_cost")) * 100).alias("saving_pct"),
        (F.col("o_input_tokens") / F.greatest("b_input_tokens", F.lit(1.0)) * 100).alias("input_tokens_pct"), (F.col("o_wall_s") / F.greatest("b_wall_s", F.lit(1e-9)) * 100).alias("wall_pct"),
    )


def report_line(run: dict) -> str:
    """A run as a line of text; numbers are rounded as C does."""
    price = "add price" if run.get("cost") is None else "$%.4f" % run["cost"]
    return "%-9s | calls %5.1f | in %9.0f | out %7.0f | %10s | render %5.1fs | api %6.1fs | wall %6.1fs" % (run["approach"], run["n_calls"], run["input_tokens"], run["output_tokens"], price, run["render_s"], run["api_s"], run["wall_s"])


def score(outputs: DataFrame, truth: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``outputs`` with ``words, word_recall, num_recall`` against the truth's text of the same keys; no truth counts as an empty one."""
    from leafwork.functions import text as T

    both = outputs.join(truth.select(*keys, F.col(text).alias("_truth")), keys, "left")
    share = lambda of: recall_of(F.coalesce(of("_truth"), F.array().cast("array<string>")), F.coalesce(of(text), F.array().cast("array<string>")))
    return both.select(*outputs.columns, F.coalesce(F.size(T.word_set(text)), F.lit(0)).alias("words"), share(T.word_set).alias("word_recall"), share(T.number_set).alias("num_recall"))


def usage(reply, key_in: tuple[str, ...] = ("input_tokens", "prompt_tokens"), key_out: tuple[str, ...] = ("output_tokens", "completion_tokens")):
    """(input, output) tokens of a reply under either naming; missing is 0."""
    first = lambda keys: F.coalesce(*[F.get_json_object(reply, f"$.{k}").cast("long") for k in keys], F.lit(0))
    return first(key_in), first(key_out)
