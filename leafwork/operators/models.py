"""Calls of a model as a DataFrame operator: a text, the tokens used and the seconds, for each row.

A model is a plain function of the payload columns.  It gives a text, or a text with the tokens it took in and gave
out.  It travels to the workers, so a client that can't should be made inside it, on first use (``cached``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS

RESULT = ("text", "input_tokens", "output_tokens", "seconds", "error")


def cached(make: Callable[[], object]) -> Callable[[], object]:
    """A function that makes its client once in each worker process."""
    kept: list = []

    def client() -> object:
        if not kept:
            kept.append(make())
        return kept[0]

    return client


def call(df: DataFrame, keys: list[str], payload: list[str], model: Callable, *, failed: str | None = "[call failed: {}]", at_once: int = DEFAULTS.max_workers, threads: int = DEFAULTS.max_workers) -> DataFrame:
    """``keys, text, input_tokens, output_tokens, seconds, error``: one call a row; this is the call log too.

    At most ``at_once`` calls run at a time over the whole cluster: rows are spread over so many tasks as that needs,
    ``threads`` calls in each.  A call that fails gives ``failed`` (with the reason) as its text and stops nothing;
    ``failed=None`` raises instead.  Texts are stripped; a model that gives nothing gives ''.
    """
    threads = max(1, min(threads, at_once))
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator) -> Iterator:
        import time
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        def one(row):
            key, given, began = row[: len(keys)], row[len(keys) :], time.perf_counter()
            try:
                got = model(*[bytes(x) if isinstance(x, (bytearray, memoryview)) else x for x in given])
                text, n_in, n_out = got if isinstance(got, tuple) else (got, 0, 0)
                return (*key, (text or "").strip(), int(n_in or 0), int(n_out or 0), time.perf_counter() - began, None)
            except Exception as e:
                if failed is None:
                    raise
                return (*key, failed.format(e), 0, 0, time.perf_counter() - began, str(e))

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(one, batch.itertuples(index=False, name=None))), columns=[*keys, *RESULT])

    spread = df.select(*keys, *payload).repartition(max(1, at_once // threads))
    return spread.mapInPandas(run, f"{fields}, text string, input_tokens bigint, output_tokens bigint, seconds double, error string")


#: The types a file's model takes, by suffix.
MODEL_TYPES = (("png", "image/png"), ("jpg", "image/jpeg"), ("jpeg", "image/jpeg"), ("webp", "image/webp"))


def file_data_url(name, blob):
    """A data URL of a picture file by its name's suffix; other types are an error."""
    from leafwork.functions import text as T

    mime = F.element_at(F.create_map(*[F.lit(x) for pair in MODEL_TYPES for x in pair]), T.ext_of(name))
    return F.when(mime.isNotNull(), F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(blob), r"[\r\n]", ""))).otherwise(F.raise_error(F.concat(F.lit("unsupported picture type: "), F.col(name) if isinstance(name, str) else name)))


def pdf_data_url(blob):
    return F.concat(F.lit("data:application/pdf;base64,"), F.regexp_replace(F.base64(blob), r"[\r\n]", ""))
