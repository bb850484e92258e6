"""Incremental batches with carried state (T2): encode with the saved dictionaries,
grow the saved graph, commit the new state. Idempotent per ``batch_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.encode import encode_transactions
from ..operators.graph import build_edges, merge_edges
from ..session import freeze
from ..sources.state import latest_batch, load_state, save_state


def update_state(spark: SparkSession, raw: DataFrame, state_dir: str, batch_id: int,
                 order_by: str = "row_id") -> tuple[DataFrame | None, object]:
    """Apply one batch. Returns (encoded batch or None when already committed, state)."""
    if batch_id <= latest_batch(spark, state_dir):
        return None, load_state(spark, state_dir)
    state = load_state(spark, state_dir)
    encoded, st = encode_transactions(raw, state, batch_id=batch_id, order_by=order_by)[:2]
    encoded = freeze(encoded, "encoded")
    st.new_edges = new_edges = build_edges(encoded)
    st.edges = new_edges if state.edges is None else merge_edges(state.edges, new_edges)
    return encoded, save_state(spark, st, state_dir)
