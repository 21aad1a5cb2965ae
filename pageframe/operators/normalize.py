"""Whitespace and comment normalisation of node tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.node import is_collapsible_ws, is_text_empty
from .rewrite import renumber_kept


def _drop(nodes: DataFrame, condition, reindex: bool) -> DataFrame:
    kept = nodes.filter(~F.coalesce(condition, F.lit(False)))
    return renumber_kept(kept) if reindex else kept


def normalize_dom(nodes: DataFrame, skip_comments: bool = False, reindex: bool = True) -> DataFrame:
    """Remove CR/LF/tab-only text outside whitespace-preserving elements, optionally comments.

    Template contents are treated alike."""
    drop = (F.col("node_type") == "text") & ~F.col("preserve_ws") & is_collapsible_ws()
    if skip_comments:
        drop = drop | (F.col("node_type") == "comment")
    return _drop(nodes, drop, reindex)


def normalize_for_display(nodes: DataFrame, reindex: bool = True) -> DataFrame:
    """Remove every whitespace-only text node outside preserving elements and every comment."""
    drop = ((F.col("node_type") == "text") & ~F.col("preserve_ws") & is_text_empty()) | (
        F.col("node_type") == "comment")
    return _drop(nodes, drop, reindex)
