"""Operators on ``TileMatrix`` / ``TileVector``: layout changes, per-cell maps,
element-wise zips, products and reductions."""

from . import layout, mapops, product, reduce, zipops  # noqa: F401
