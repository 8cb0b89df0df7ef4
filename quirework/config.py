"""Settings of the engine, from defaults, an environment file and the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path

PREFIX = "QUIREWORK_"


@dataclass(frozen=True)
class Settings:
    """Every value can be overridden by an environment variable of the same name in capitals after the prefix."""

    image_dpi: int = 192
    min_pdf_image_dim: int = 1024
    min_image_dim: int = 1536
    max_output_tokens: int = 12384
    bbox_scale: int = 1000
    image_format: str = "JPEG"
    image_quality: int = 92
    api_key: str = "EMPTY"
    api_base: str = "http://localhost:8000/v1"
    model_name: str = "page-model"
    gpus: str = "0"
    max_retries: int = 6
    client_timeout: float = 1200.0
    device: str | None = None
    attention: str | None = None
    pages_per_part: int = 2000
    extra: dict[str, str] = field(default_factory=dict, compare=False)


def env_file(folder: str | Path = ".") -> Path | None:
    """The environment file of a folder: ``.env`` before ``local.env``."""
    return next((p for name in (".env", "local.env") if (p := Path(folder) / name).is_file()), None)


def _read(path: Path) -> dict[str, str]:
    out = {}
    for line in path.read_text(encoding="utf-8").splitlines():
        name, equals, value = line.partition("=")
        if equals and not name.strip().startswith("#"):
            out[name.strip()] = value.strip().strip("\"'")
    return out


def load(folder: str | Path = ".", environ: dict[str, str] | None = None) -> Settings:
    """Settings of a folder; the environment goes before the file, unknown names are ignored."""
    path = env_file(folder)
    given = (_read(path) if path else {}) | dict(os.environ if environ is None else environ)
    values: dict[str, object] = {}
    for f in fields(Settings):
        text = given.get(PREFIX + f.name.upper())
        if text is None or f.name == "extra":
            continue
        values[f.name] = int(text) if f.type == "int" else float(text) if f.type == "float" else (text or None if "None" in str(f.type) else text)
    return Settings(**values)
