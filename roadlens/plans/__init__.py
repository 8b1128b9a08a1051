"""Reusable physical building blocks shared by the operators."""

from roadlens.plans.broadcast import bounded_broadcast
from roadlens.plans.checkpoint import checkpoint_root, finished_ids, remove_folder, scratch_path, written_once
from roadlens.plans.sequence import ordered_steps

__all__ = ["bounded_broadcast", "checkpoint_root", "scratch_path", "remove_folder", "written_once",
           "finished_ids", "ordered_steps"]
