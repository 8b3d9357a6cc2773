"""Thresholds of the document operators, in one frozen object that builders take."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Results depend on them, so they are stated here once."""

    word_cap: int = 60
    vision_pic_fraction: float = 0.45
    vision_text_below: int = 30
    sparse_text: int = 5
    sparse_pic_fraction: float = 0.10
    vision_graphic_shapes: int = 2
    vision_deck_fraction: float = 0.5
    min_image_dim: int = 150
    min_figure_dim: int = 64
    scanned_text_max_chars: int = 20
    scanned_image_cover: float = 0.60
    edge_tol: float = 0.06
    x_align_tol: float = 0.05
    placement_text_cap: int = 600
    max_workers: int = 8
    no_description: str = "(no description)"
    no_content: str = "_[no content]_"
    no_md_description: str = "_[no description]_"


DEFAULTS = Config()
