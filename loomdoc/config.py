"""Settings, checked on the driver before any plan is built."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkingConfig:
    """Word limits of chunks. max_words is hard; overlap must stay below min_words."""

    min_words: int = 500
    max_words: int = 2000
    target_words_low: int = 1200
    target_words_high: int = 1500
    overlap_words_low: int = 100
    overlap_words_high: int = 200
    words_per_token: float = 0.75

    def __post_init__(self):
        for ok, what in (
            (self.min_words >= 1 and self.max_words >= 100, "min_words is at least 1, max_words at least 100"),
            (self.min_words <= self.max_words, "min_words is at most max_words"),
            (self.target_words_low <= self.target_words_high, "target_words_low is at most target_words_high"),
            (0 <= self.overlap_words_low <= self.overlap_words_high, "overlap_words_low is at most overlap_words_high"),
            (self.overlap_words_high < self.min_words, "overlap_words_high is below min_words"),
            (self.words_per_token > 0, "words_per_token is positive"),
        ):
            if not ok:
                raise ValueError(what)

    @property
    def target(self) -> int:
        return (self.target_words_low + self.target_words_high) // 2

    @property
    def overlap(self) -> int:
        return (self.overlap_words_low + self.overlap_words_high) // 2

    @property
    def max_tokens_estimate(self) -> float:
        return self.max_words / self.words_per_token


@dataclass(frozen=True)
class IntakeLimits:
    """Size and suffixes that intake accepts; None accepts all."""

    max_bytes: int | None = 500 * 1024 * 1024
    allowed_suffixes: frozenset[str] | None = None


def load_settings(path: str) -> dict:
    """A YAML file whose root is a mapping; an empty one gives none."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f)
    if data is None:
        return {}
    if not isinstance(data, dict):
        raise ValueError(f"{path}: the root must be a mapping")
    return data


#: Thresholds of the quality rules.
EMPTY_PAGE_CHARS = 40
MIN_NATIVE_CHARS = 40
LOW_CHUNK_SCORE = 0.45
LOW_SECTION_CONFIDENCE = 0.42
REVIEW_CONFIDENCE = 0.72
REVIEW_EMPTY_PERCENT = 18.0
REVIEW_OCR_CONFIDENCE = 0.65
#: Row caps of tables in files, and bytes of a portal file.
MAX_TABLE_ROWS = 100_000
PORTAL_BYTES = 9 * 1024 * 1024
