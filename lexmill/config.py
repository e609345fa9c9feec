"""Settings, from the environment or given."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    input_dir: str = "input"
    archive_dir: str = "archive"
    state_dir: str = "state"
    archive_processed: bool = False
    zip_filename_encoding: str = "cp866"
    zip_force_reextract: bool = False
    dpi: int = 200
    max_pages_per_doc: int | None = None
    poll_interval_seconds: int = 10
    stale_processing_minutes: int = 120
    extractor: str = "rules"
    llm_base_url: str = "http://localhost:11434"
    llm_model: str = "llama3.1:8b"
    llm_pages_per_chunk: int = 4
    llm_max_chars_per_chunk: int = 12_000
    llm_request_timeout: int = 600
    name_repair: str = "compat"
    max_attempts: int | None = None

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        """Settings from variables of the fields' names in capitals; an empty optional number is none."""
        env, given = os.environ if env is None else env, {}
        for f in fields(cls):
            text = env.get(f.name.upper())
            if text is None:
                continue
            if f.type == "bool":
                given[f.name] = text.strip().lower() in ("1", "true", "yes")
            elif f.type.startswith("int"):
                if text.strip():
                    given[f.name] = int(text)
            else:
                given[f.name] = text
        return cls(**given)
