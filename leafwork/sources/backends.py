"""Readers and renderers that need a library or a program that isn't here: contracts and a registry.

A backend is a plain function; register it under its name in the driver and ``leafwork.convert`` sends it to the workers
where there is work for it.  Without one that work raises; ``decode`` falls back to the digest of the raw bytes.
"""

from __future__ import annotations

from collections.abc import Callable

#: name -> what the function takes and gives
CONTRACTS = {
    "ppt": "bytes -> [(slide_number, title, text, [(content_type, width, height, image_index, bytes)])]",
    "pdf_pages": "bytes -> [(page, width, height)]",
    "pdf_spans": "bytes -> [(page, block, line, span, text, x0, y0, x1, y1)]",
    "pdf_images": "bytes -> [(page, idx, x0, y0, x1, y1, w, h, ext, bytes)]",
    "render_page": "(bytes, page) -> png bytes",
    "stitch": "(top bytes, bottom bytes) -> png bytes",
    "svg": "bytes -> png bytes",
    "deck_to_pdf": "bytes -> pdf bytes",
    "split_pdf": "(bytes, [page]) -> {page: bytes}",
    "decode": "bytes -> bytes of a canonical form of the picture",
}
_registered: dict[str, Callable] = {}


def register(name: str, function: Callable) -> None:
    if name not in CONTRACTS:
        raise KeyError(f"no such backend: {name}")
    _registered[name] = function


def get(name: str, default: Callable | None = None) -> Callable:
    found = _registered.get(name, default)
    if found is None:
        raise LookupError(f"no backend for {name}: register a function {CONTRACTS[name]}")
    return found


def has(name: str) -> bool:
    return name in _registered


def rows_of(files, name: str, schema: str):
    """The rows that the reader ``name`` makes of each file's bytes, as ``doc_id`` and ``schema``; files: doc_id, content."""
    read = get(name)
    columns = ["doc_id", *(c.strip().split()[0] for c in schema.split(", "))]

    def run(batches):
        import pandas as pd

        for batch in batches:
            for key, content in batch.itertuples(index=False, name=None):
                rows = [(key, *r) for r in read(bytes(content))]
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return files.select("doc_id", "content").mapInPandas(run, f"doc_id string, {schema}")
