"""Settings with their checks."""

from __future__ import annotations

import dataclasses
import warnings
from dataclasses import dataclass, field, fields
from typing import Any


def _positive(obj: Any, *names: str) -> None:
    for name in names:
        if not getattr(obj, name) > 0:
            raise ValueError(f"{name} must be greater than 0, got {getattr(obj, name)}")


@dataclass(frozen=True)
class SelectParams:
    seed: int
    target_hours: float
    language_mix: dict[str, float]
    min_segment_seconds: float
    max_segment_seconds: float
    max_hours_per_channel: float
    holdout_hours: float
    catalog_path: str = ""
    exclude_channels_file: str = ""
    drive_root: str = ""
    drive_index_path: str = ""

    def __post_init__(self) -> None:
        _positive(self, "target_hours", "min_segment_seconds", "max_segment_seconds", "max_hours_per_channel", "holdout_hours")
        total = sum(self.language_mix.values())
        if abs(total - 1) > 0.01 + 1e-12:
            raise ValueError(f"language_mix must sum to 1, got {total}")


@dataclass(frozen=True)
class ShardParams:
    shard_size: int
    min_cut_seconds: float
    target_cut_seconds: float
    max_cut_seconds: float
    output_dir: str = ""
    format: str = "flac"

    def __post_init__(self) -> None:
        _positive(self, "shard_size", "min_cut_seconds", "target_cut_seconds", "max_cut_seconds")
        if self.format not in ("flac", "wav"):
            raise ValueError(f"format must be flac or wav, got {self.format}")
        if self.max_cut_seconds < 2 * self.min_cut_seconds:
            raise ValueError("a window of a split item could be shorter than min_cut_seconds: max_cut_seconds must be twice that at least")
        if self.max_cut_seconds < self.target_cut_seconds + self.min_cut_seconds:
            raise ValueError("a merged item could be longer than max_cut_seconds: it must be target_cut_seconds + min_cut_seconds at least")


#: The least and the greatest value of a setting, and whether the least itself is permitted; names and limits are fixed values.
PRETRAIN_RANGES: dict[str, tuple[float, float | None, bool]] = {
    "max_updates": (0, None, False),
    "warmup_updates": (0, None, True),
    "peak_lr": (0, None, False),
    "hold_ratio": (0, 1, True),
    "adam_eps": (0, None, False),
    "weight_decay": (0, None, True),
    "max_grad_norm": (0, None, False),
    "target_batch_seconds": (0, None, False),
    "per_device_max_seconds": (0, None, False),
    "num_workers": (0, None, True),
    "max_gpu_memory_fraction": (0, 1, False),
    "mask_time_prob": (0, 1, True),
    "mask_time_length": (0, None, False),
    "diversity_loss_weight": (0, None, True),
    "max_gumbel_temperature": (0, None, False),
    "min_gumbel_temperature": (0, None, False),
    "gumbel_temperature_decay": (0, 1, False),
    "save_every_updates": (0, None, False),
    "eval_every_updates": (0, None, False),
    "keep_last_n_checkpoints": (0, None, False),
}


@dataclass(frozen=True)
class PretrainParams:
    """Settings of a training run; the schedules, intervals, batches and retained checkpoints of this library follow them."""

    base_model: str
    max_updates: int
    warmup_updates: int
    peak_lr: float
    hold_ratio: float
    adam_betas: tuple[float, ...]
    adam_eps: float
    weight_decay: float
    max_grad_norm: float
    target_batch_seconds: float
    per_device_max_seconds: float
    num_workers: int
    mask_time_prob: float
    mask_time_length: int
    diversity_loss_weight: float
    max_gumbel_temperature: float
    min_gumbel_temperature: float
    gumbel_temperature_decay: float
    save_every_updates: int
    eval_every_updates: int
    keep_last_n_checkpoints: int
    milestone_checkpoints: tuple[int, ...]
    output_dir: str
    precision: str = "bf16"
    freeze_feature_encoder: bool = True
    lr_schedule: str = "tri_stage"
    optimizer: str = "adamw"
    max_gpu_memory_fraction: float = 0.8

    def __post_init__(self) -> None:
        for name, (least, most, inclusive) in PRETRAIN_RANGES.items():
            value = getattr(self, name)
            if value < least or value == least and not inclusive or most is not None and value > most:
                raise ValueError(f"{name} must be {'at least' if inclusive else 'above'} {least}" + (f" and at most {most}" if most is not None else "") + f", got {value}")
        if self.precision not in ("bf16", "fp16", "fp32"):
            raise ValueError(f"precision must be bf16, fp16 or fp32, got {self.precision}")
        if self.precision == "fp16":
            warnings.warn("fp16 may overflow; bf16 has the range of fp32", stacklevel=3)


@dataclass(frozen=True)
class MonitorParams:
    """So many readings in a row below the floor stop a run; there is a reading each eval_every_updates."""

    perplexity_floor: float = 10.0
    consecutive_alerts: int = 5

    def __post_init__(self) -> None:
        _positive(self, "perplexity_floor", "consecutive_alerts")


SECTIONS = {"select": SelectParams, "shard": ShardParams, "pretrain": PretrainParams, "monitoring": MonitorParams}
#: What a field of a type takes; numbers may be whole where fractions are asked for, not the other way round.
TAKES = {"int": int, "float": (int, float), "str": str, "bool": bool}


def _section(name: str, kind: type, values: dict[str, Any]) -> tuple[Any, dict[str, Any]]:
    """A section's settings, and those that it doesn't know."""
    if not isinstance(values, dict):
        raise ValueError(f"{name} must have settings by name, got {values!r}")
    known = {f.name: f for f in fields(kind)}
    missing = [n for n, f in known.items() if n not in values and f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    own = {}
    for key, value in values.items():
        if key in known:
            takes = TAKES.get(str(known[key].type))
            if takes and (not isinstance(value, takes) or isinstance(value, bool) and takes is not bool):
                raise ValueError(f"{name}.{key} must be of type {known[key].type}, got {value!r}")
            own[key] = tuple(value) if isinstance(value, list) else value
    return kind(**own), {k: v for k, v in values.items() if k not in known}


@dataclass(frozen=True)
class Params:
    select: SelectParams | None = None
    shard: ShardParams | None = None
    pretrain: PretrainParams | None = None
    monitoring: MonitorParams = field(default_factory=MonitorParams)
    other: dict = field(default_factory=dict)

    @classmethod
    def of(cls, settings: dict, strict: bool = True) -> Params:
        """From nested dicts. Sections of other programs are kept in other; keys that a known section doesn't know are refused, or kept there too unless strict."""
        made, other = {}, {k: v for k, v in settings.items() if k not in SECTIONS}
        for name, kind in SECTIONS.items():
            if name in settings:
                made[name], rest = _section(name, kind, settings[name])
                if rest and strict:
                    raise ValueError(f"{name} doesn't know {', '.join(map(str, rest))}")
                if rest:
                    other[name] = rest
        return cls(**made, other=other)

    @classmethod
    def from_yaml(cls, path: str, strict: bool = True) -> Params:
        import yaml

        with open(path) as f:
            return cls.of(yaml.safe_load(f) or {}, strict)

    def asdict(self) -> dict:
        return dataclasses.asdict(self)
