"""Settings of a pipeline run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


class ConfigError(ValueError):
    """A setting is missing or unusable."""


@dataclass(frozen=True)
class EngineConfig:
    """Typed settings. ``compat`` keeps the quirks of the established behaviour (a missing note
    reads "None"); ``force_reload`` ignores cached concept and embedding tables; ``parallel``
    bounds the model calls that run at a time."""

    model: str
    data_folder: str
    output_folder: str = "output"
    api_key: str = ""
    max_tokens: int = 800_000
    minutes_per_batch: int = 20
    force_reload: bool = True
    top_k: int = 10
    compat: bool = True
    parallel: int | None = None

    def __post_init__(self):
        if not self.model:
            raise ConfigError("MODEL is not set")
        if not self.data_folder:
            raise ConfigError("DATA_FOLDER is not set")
        if self.parallel is not None and self.parallel < 1:
            raise ConfigError("parallel calls must be at least 1")
        if self.minutes_per_batch < 0 or self.max_tokens < 0 or self.top_k < 0:
            raise ConfigError("minutes, tokens and top_k must not be negative")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> EngineConfig:
        env = os.environ if env is None else env

        def number(name: str, default: int) -> int:
            raw = env.get(name)
            try:
                return default if raw in (None, "") else int(raw)
            except ValueError:
                raise ConfigError(f"{name} is not a whole number: {raw!r}") from None

        calls = number("PARALLEL_CALLS", 0)
        return cls(model=env.get("MODEL", ""), data_folder=env.get("DATA_FOLDER", ""), api_key=env.get("OPENAI_API_KEY", ""),
                   output_folder=env.get("OUTPUT_FOLDER", "output"), max_tokens=number("TOKEN_LIMIT", 800_000),
                   parallel=calls or None, minutes_per_batch=number("MINUTES_PER_BATCH", 20), force_reload=env.get("FORCE_RELOAD", "true").strip().lower() == "true")
