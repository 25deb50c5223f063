"""Parameters of the stages, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Stage1Config:
    lang: str = "en"
    confidence: float = 0.90
    nsfw_threshold: float = 0.95
    toxicity_threshold: float = 0.95
    quality_threshold: float = 0.8
    min_words: int = 6
    max_chars_per_line: int = 500
    enable_language: bool = True
    enable_super_quality: bool = True
    enable_nsfw: bool = True
    enable_toxicity: bool = False
    enable_quality: bool = True
    safe_label: str = "safe"
    good_label: str = "good"


@dataclass(frozen=True)
class DedupConfig:
    num_hashes: int = 128
    num_bands: int = 16
    num_grams: int = 5
    threshold_tenths: int = 8  # Jaccard similarity in tenths, compared in whole numbers
    exact: bool = True  # links from an exact join; otherwise from shared bands of signatures
