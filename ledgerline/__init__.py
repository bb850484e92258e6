"""ledgerline: transaction-risk analytics on Spark (DataFrame / SQL / ML / Structured Streaming).

Names are imported from their modules when they are first used, so that a Python worker that needs
one operator does not load them all.
"""

from importlib import import_module

_MODULES = {
    "operators.eda": (
        "amount_summary cardinality clean describe_numeric describe_strings find_negative find_nulls "
        "flagged info null_counts quality_report score_summary slice_by_label value_counts"
    ),
    "operators.encode": "State encode_transactions extend_dictionary first_seen_codes fit_anchor label_encode",
    "operators.enrich": "edge_list edge_list_lines enrich",
    "operators.graph": "build_edges clustering empty_edges graph_counts merge_edges node_features node_stats nodes",
    "operators.metrics": "binary_metrics classification_report confusion",
    "operators.model": "ForestScorer assemble_features fit_scorer",
    "operators.quality": "compare_profiles drift histogram infer_expectations profile validate",
    "operators.running": "add_batch running_profile",
    "operators.rank": "head_by_index rank_unique with_row_index",
    "operators.resample": "oversample_latent",
    "operators.scale": "apply_minmax fit_minmax",
    "operators.split": "split",
    "plans.jobs": "load_latest retrain_job score_job train_job",
    "sinks.writers": "append_training to_records write_csv write_checked write_predictions",
    "sources.readers": "infer_types parse_records read_inferred read_snapshot read_transactions",
    "sources.graph_state": "GraphState",
    "sources.registry": "latest_model save_model",
    "sources.state": "compact_state load_state save_state",
    "streaming.score_stream": "stream_score stream_transactions",
    "streaming.state_update": "update_state",
}
_WHERE = {name: module for module, names in _MODULES.items() for name in names.split()}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name not in _WHERE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f".{_WHERE[name]}", __name__), name)
