"""Thresholds and switches of the three programs: cleaner, thread grouper, bulk filter."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    tfidf_threshold: float = 0.59
    jaccard_threshold: float = 0.35
    near_identical: float = 0.99
    automation_threshold: float = 0.95
    thread_vocabulary: int = 5_000
    bulk_vocabulary: int = 15_000
    max_df: float = 0.95
    bulk_min_df: int = 2
    #: Jaccard wins if the cosine cohesion is under this part of its own
    cohesion_ratio: float = 0.8
    min_length: int = 10
    test_share: float = 0.2
    seed: int = 42
    max_iter: int = 3_000


DEFAULT = Config()
