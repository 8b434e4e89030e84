"""Settings, read once on the driver."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    theme_chunk_words: int = 8000
    triple_chunk_words: int = 2500
    overlap_words: int = 50
    normalize_text: bool = True
    token_batch: int = 50
    registry_entities: int = 100
    compress_fields: tuple[str, ...] = ("subject", "predicate", "object")
    distance_threshold: float = 0.15
    projection: str = "centered_pca"
    overlap_threshold: float = 0.80
    resolution: float = 1.0
    min_community_size: int = 4
    default_domain: str = "General"
    provider: str = "offline"
    base_url: str = ""
    model: str = ""
    context: int = 8192
    context_source: str = "dynamic"
    api_key: str = ""
    credentials: str = ""
    project: str = ""
    location: str = ""
    endpoint: str = ""
    max_concurrent: int = 3
    max_tasks: int = 0
    calls_per_task: int = 32
    retry_wait: float = 1.0
    encoder: str = "offline"

    def __post_init__(self) -> None:
        if self.provider not in ("offline", "http", "predict"):
            raise ValueError("provider must be offline, http or predict")
        if self.provider != "offline" and not (self.base_url or self.endpoint):
            raise ValueError("this provider needs base_url, or an endpoint")
        if self.max_concurrent <= 0 or self.calls_per_task <= 0 or self.max_tasks < 0:
            raise ValueError("max_concurrent and calls_per_task must be positive, max_tasks not negative")
        if min(self.theme_chunk_words, self.triple_chunk_words, self.token_batch) <= 0:
            raise ValueError("chunk and batch sizes must be positive")
        if self.projection not in ("centered_pca", "none"):
            raise ValueError("projection must be centered_pca or none")
        if not set(self.compress_fields) <= {"subject", "predicate", "object"}:
            raise ValueError("compress_fields may name subject, predicate and object only")


#: Other names of settings that a file may use, and those that it may have but that change nothing here.
ALIASES = {
    "max_concurrent_llm_calls": "max_concurrent",
    "theme_chunk_max_words": "theme_chunk_words",
    "triple_chunk_max_words": "triple_chunk_words",
    "similarity_threshold": "distance_threshold",
    "inheritance_overlap_threshold": "overlap_threshold",
    "leiden_resolution": "resolution",
    "domain": "default_domain",
    "model_name": "model",
    "fixed_num_ctx": "context",
    "google_credentials_path": "credentials",
    "vertex_project": "project",
    "vertex_location": "location",
    "vertex_endpoint": "endpoint",
}
WITHOUT_EFFECT = ("use_async", "verbose", "manage_vram", "embedding_model", "compression_mode", "spectral_variance_retention", "hypernym_resolution", "community_detection", "schemas_dir", "graphs_dir", "checkpoints_dir", "logs_dir")


def load_config(path: str | Path | None = None, **changes: object) -> Config:
    """Defaults, then the file's settings, in sections or not, then changes.

    A setting may have one of the ALIASES as its name. api_backend names the provider:
    vertexai is predict, any other http, but for offline. Names WITHOUT_EFFECT warn,
    unknown ones raise, as does a file that can't be read.
    """
    found: dict[str, object] = {}
    if path is not None:
        import yaml

        names, idle = {f.name for f in fields(Config)}, []
        told = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        for section, rows in told.items():
            for k, v in rows.items() if isinstance(rows, dict) else [(section, rows)]:
                k = ALIASES.get(k, k)
                if k == "api_backend":
                    k, v = "provider", {"vertexai": "predict", "offline": "offline"}.get(str(v), "http")
                if k in names:
                    found[k] = tuple(v) if isinstance(v, list) else v
                elif k in WITHOUT_EFFECT:
                    idle.append(k)
                elif v is not None:
                    raise ValueError(f"{path}: unknown setting {k}")
        if idle:
            warnings.warn(f"{path}: without effect here: {', '.join(idle)}", stacklevel=2)
    return replace(Config(), **{**{k: v for k, v in found.items() if v is not None}, **changes})
