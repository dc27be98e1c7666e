"""Default parameters of the curation queries, each with its comparison side."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    # Thresholds of the curation pipeline.
    closeup_area: float = 0.4  # rejected from here on
    faraway_area: float = 0.001  # rejected under this
    min_pixels: int = 160_000  # rejected under this
    phash_distance: int = 8  # duplicate up to this
    temporal_min_seq: int = 5  # thinned from here on
    temporal_keep_distance: int = 10  # similar under this
    temporal_max_gap: int = 60  # near up to this
    rider_overlap: float = 0.3  # pair skipped under this
    rider_height_ratio: float = 1.0  # contaminated over this
    variety_min_instances: int = 1  # rejected under this
    capture_conf: float = 0.1
    conf_threshold: float = 0.45  # dropped under this
    lookalike_overlap: float = 0.6  # dropped over this
    lookalike_classes: tuple[int, ...] = (1, 3, 12, 31, 36)
    implausible_classes: tuple[int, ...] = (40, 42, 44, 57, 59, 60, 61, 62, 64, 65, 66, 68, 69, 70, 71, 72, 78, 79)
    dup_containment: float = 0.9  # match from here on
    dup_min_matches: int = 4  # duplicate from here on
    mining_conf_low: float = 0.05
    mining_conf_hit: float = 0.25
    mining_iou: float = 0.5
    mining_max: int = 300
    mining_dedup_dist: int = 12  # near up to this
    similarity_floor: float = 0.5  # a duplicate less alike than this is rescued
    small_side: int = 32
    medium_side: int = 96
    valid_frac: float = 0.15
    seed: int = 42
    target_class: int = 80
    person_class: int = 0

    @classmethod
    def from_env(cls, prefix: str = "FRAMELOOM_") -> Params:
        """Defaults overridden by variables of the environment: int, float or comma-separated ints."""
        got = {}
        for f in fields(cls):
            raw = os.environ.get(prefix + f.name.upper())
            if raw is not None:
                default = f.default
                got[f.name] = tuple(int(x) for x in raw.split(",") if x.strip()) if isinstance(default, tuple) else type(default)(raw)
        return cls(**got)


DEFAULTS = Params()
