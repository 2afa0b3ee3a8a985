"""Settings as frozen values with named profiles; nothing is read by executing a file."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Profile:
    """Thresholds of all stages. Override with ``with_options``; None means "keep", 0 and "" are values."""

    train_ratio: float = 0.8
    dev_ratio: float = 0.1
    test_ratio: float = 0.1
    seed: int = 42
    unknown_severity: str = "unknown"
    severity_bins: int = 3
    min_segment_score: float = 0.35
    min_duration_sec: float = 1.0
    max_duration_sec: float = 30.0
    min_coverage: float = 0.45
    file_filter: bool = False
    file_min_score: float = 0.35
    file_min_segments: int = 1
    file_min_coverage: float = 0.45
    file_min_matched: float = 0.3
    align_group: int = 3
    align_min_score: float = 0.28
    align_word_chunk: int = 12
    align_pause_ms: int = 250
    align_skip_chunk: float = -0.08
    align_skip_sentence: float = -0.12
    long_segment_sec: float = 20.0
    nbest_beams: int = 5
    nbest_sequences: int = 5
    nbest_max_length: int = 256
    nbest_beam_groups: int = 5
    nbest_diversity: float = 0.3
    nbest_top_p: float = 0.95
    nbest_temperature: float = 0.8
    padding_sec: float = 0.15
    sample_rate: int = 16000
    min_extract_sec: float = 0.05
    shard_dirs: int = 256

    def with_options(self, **options) -> Profile:
        names = {f.name for f in fields(self)}
        if unknown := set(options) - names:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        out = replace(self, **{k: v for k, v in options.items() if v is not None})
        out.check()
        return out

    def check(self) -> None:
        if abs(self.train_ratio + self.dev_ratio + self.test_ratio - 1.0) > 1e-6:
            raise ValueError("the three split ratios must add up to 1")
        if self.severity_bins < 1:
            raise ValueError("at least one bin is needed")


DEFAULT = Profile()
STRICT = Profile(
    min_segment_score=0.6,
    min_duration_sec=2.0,
    max_duration_sec=20.0,
    min_coverage=0.7,
    file_filter=True,
    file_min_score=0.55,
    file_min_segments=3,
    file_min_coverage=0.7,
    file_min_matched=0.6,
)
PROFILES = {"default": DEFAULT, "strict": STRICT}
