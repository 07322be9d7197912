"""Frozen settings, presets, files and checks."""

from __future__ import annotations

import json
import warnings
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    """Parameters of the model, the pages and the outputs; change them with dataclasses.replace."""

    engine_type: str = "batched"
    model_name: str = ""
    cache_dir: str = "./models"
    device: str = "cuda"
    dtype: str = "bfloat16"
    max_num_seqs: int = 100
    gpu_memory_utilization: float = 0.9
    block_size: int = 256
    tensor_parallel_size: int = 1
    num_workers: int = 64
    base_size: int = 1024
    image_size: int = 640
    crop_mode: bool = True
    min_crops: int = 2
    max_crops: int = 6
    max_new_tokens: int = 8192
    temperature: float = 0.0
    ngram_size: int = 20
    ngram_window: int = 50
    pdf_dpi: int = 200
    extract_text: bool = True
    save_images: bool = True
    output_dir: str = "./outputs"
    image_output_dir: str = "./outputs/cropped_images"
    context_radius: float = 0.2
    context_window: int = 2
    context_budget: int = 500
    table_complexity_threshold: float = 0.3
    diagram_complexity_threshold: int = 10
    max_keywords: int = 10
    min_keyword_length: int = 2

    def validate(self) -> Settings:
        """self, after an error for a device or number type that is unknown, and warnings for odd sizes."""
        if self.device not in ("cuda", "cpu"):
            raise ValueError(f"device {self.device!r} is neither 'cuda' nor 'cpu'")
        if self.dtype not in ("float16", "float32", "bfloat16"):
            raise ValueError(f"dtype {self.dtype!r} is unknown")
        if (self.device, self.dtype) == ("cuda", "float32"):
            warnings.warn("float32 may not fit into small GPUs", stacklevel=2)
        if self.base_size not in (512, 640, 1024, 1280):
            warnings.warn(f"base size {self.base_size} is unusual", stacklevel=2)
        if self.pdf_dpi < 150:
            warnings.warn(f"{self.pdf_dpi} dpi may be too coarse to read", stacklevel=2)
        return self

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, found: dict) -> Settings:
        known = {f.name for f in fields(cls)}
        if extra := set(found) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(extra))}")
        return cls(**found)


DEFAULT = Settings()
PRESETS = {
    "rtx4060": replace(DEFAULT, dtype="float16", max_num_seqs=10, gpu_memory_utilization=0.75, num_workers=32, max_crops=4),
    "rtx4090": DEFAULT,
    "cpu": replace(DEFAULT, device="cpu", dtype="float32", base_size=640, image_size=512),
}


def read_flat(text: str) -> dict:
    """`key: value` lines, or a JSON object; values are JSON where they parse, else plain strings."""
    if text.lstrip().startswith("{"):
        return json.loads(text)
    out = {}
    for line in text.splitlines():
        key, colon, value = line.partition(":")
        if colon and key.strip() and not key.lstrip().startswith("#") and key == key.lstrip():
            value = value.strip()
            try:
                out[key.strip()] = json.loads(value)
            except ValueError:
                out[key.strip()] = value.strip("'\"")
    return out


def load(path: str | None = None, preset: str | None = None) -> Settings:
    """Settings of a file, else of a preset in any case, else the defaults."""
    if path:
        return Settings.from_dict(read_flat(Path(path).read_text(encoding="utf-8")))
    if preset is None:
        return DEFAULT
    if preset.lower() not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; there are {', '.join(PRESETS)}")
    return PRESETS[preset.lower()]


def save(settings: Settings, path: str) -> None:
    lines = [f"{k}: {json.dumps(v, ensure_ascii=False)}" for k, v in settings.to_dict().items()]
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")
