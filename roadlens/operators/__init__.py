"""Batch operators.  Each takes DataFrames and parameters and returns a lazy
DataFrame; the answer does not depend on the input partitioning."""

from roadlens.operators.devices import (
    add_period, error_cameras_of_bitmaps, error_monitors_of_bitmaps, kept_bitmaps, merged, seen_bitmaps,
)
from roadlens.operators.frequent import frequent_keys, top_monitors_of_many, top_speeding_monitors_of_many, top_words
from roadlens.operators.graph import common_friend_weight, pair_weights, recommend_friends, relation_pairs
from roadlens.operators.text import remove_top_word, word_count, word_count_distinct, words
from roadlens.operators.traffic import (
    busiest_hours, conversion_matrix, conversion_rate, error_cameras, error_monitors, sample_vehicles, sample_vehicles_of_many,
    status_summary, top_monitors, top_speed_readings, top_speeding_monitors,
    top_speeding_monitors_sql, vehicle_trace,
)
from roadlens.operators.windows import (
    closing_time, congestion_status, latest_speed, latest_speed_of_log, windowed_avg_speed, windowed_count,
)

__all__ = [
    "add_period", "error_cameras_of_bitmaps", "error_monitors_of_bitmaps", "kept_bitmaps", "merged", "seen_bitmaps",
    "frequent_keys", "top_monitors_of_many", "top_speeding_monitors_of_many", "top_words", "sample_vehicles_of_many",
    "words", "word_count", "word_count_distinct", "remove_top_word",
    "relation_pairs", "common_friend_weight", "pair_weights", "recommend_friends",
    "top_monitors", "top_speed_readings", "top_speeding_monitors", "top_speeding_monitors_sql",
    "busiest_hours", "error_monitors", "error_cameras", "status_summary",
    "conversion_rate", "conversion_matrix", "sample_vehicles", "vehicle_trace",
    "windowed_avg_speed", "windowed_count", "closing_time", "latest_speed", "latest_speed_of_log", "congestion_status",
]
