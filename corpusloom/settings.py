"""Settings of the pipelines: YAML files to checked dataclasses, on the driver."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

# Names under which a step's thinking switch may be given, in the order in which they are tried.
STEP_ALIASES = {
    1: ("1", "step1", "step_1", "question", "question_prompt"),
    2: ("2", "step2", "step_2", "answer", "answer_prompt"),
    3: ("3", "step3", "step_3", "thinking", "thinking_prompt"),
    4: ("4", "step4", "step_4", "refine", "refine_answer", "refine_answer_prompt"),
    5: ("5", "step5", "step_5", "eval", "eval_prompt"),
}
_TRUE, _FALSE = ("true", "1", "yes", "on"), ("false", "0", "no", "off")


def optional_bool(value: Any) -> bool | None:
    if isinstance(value, str) and (low := value.strip().lower()) in _TRUE + _FALSE:
        return low in _TRUE
    return None if value is None else bool(value)


def thinking_switches(raw: Any) -> dict[int, bool | None]:
    """Step -> switch; a step that no alias names is left out, so nothing is sent for it."""
    if not isinstance(raw, Mapping):
        return {}
    named = {step: next((a for a in aliases if a in raw), None) for step, aliases in STEP_ALIASES.items()}
    return {step: optional_bool(raw[alias]) for step, alias in named.items() if alias is not None}


def load_yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


@dataclass(frozen=True)
class Endpoint:
    """A chat-completion service."""

    base_url: str = "http://localhost:8000/v1"
    model: str = ""
    api_key: str = ""
    max_tokens: int = 2048
    temperature: float = 0
    top_p: float = 1.0
    timeout: float = 600
    connect_timeout: float = 5
    keepalive_expiry: float = 120
    max_retries: int = 3
    wait_seconds: float = 5
    retry_jitter_seconds: float = 0.2
    retry_max_delay: float = 30
    max_in_flight: int = 4

    @classmethod
    def of(cls, raw: Mapping[str, Any], **defaults: Any) -> Endpoint:
        """From the settings' infer_config and the retry keys beside it; the environment fills an unset URL and model."""
        infer = dict(raw.get("infer_config") or {})
        if infer.get("openrouter"):
            where = {"base_url": infer.get("openrouter_url", "https://openrouter.ai/api/v1"), "model": infer.get("openrouter_model", ""), "api_key": infer.get("openrouter_api_key", os.environ.get("OPENROUTER_API_KEY", ""))}
        else:
            where = {"base_url": infer.get("SERVER_URL") or os.environ.get("SERVER_URL") or cls.base_url, "model": infer.get("MODEL_NAME") or os.environ.get("MODEL_NAME", ""), "api_key": infer.get("api_key", "")}
        known = {f.name for f in fields(cls)}
        found = {k: v for k, v in {**defaults, **infer, **raw, **where}.items() if k in known and v is not None}
        found.setdefault("max_in_flight", raw.get("batch_size", cls.max_in_flight))
        return cls(**found)


@dataclass(frozen=True)
class CptSettings:
    """Chunk data for continued pre-training."""

    target_key: str = "content"
    title_key: str = "title"
    id_key: str = "id"
    text_key: str = "text"
    include_title: bool = True
    min_chars: int = 128
    max_chars: int = 4096
    overlap_chars: int = 256
    train_ratio: float = 0.98
    seed: int = 42
    shuffle: bool = True
    deduplicate: bool = True
    dedup_window: int | None = None  # null: over everything; n: within windows of n candidates
    copyright_mitigation: bool = False
    copyright_failure_policy: str = "fail"
    keep_intermediate: bool = False
    enable_thinking: bool | None = None
    max_in_flight: int = 4
    batch_rows: int = 5000  # results that are saved at once
    output_path: str = "./test_output/cpt"
    prompts: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.max_chars <= 0 or not 0 <= self.overlap_chars < self.max_chars:
            raise ValueError("max_chars must be positive and overlap_chars between 0 and max_chars")
        if self.max_in_flight < 1 or self.batch_rows < 1:
            raise ValueError("max_in_flight and batch_rows must be positive")
        if not 0 < self.train_ratio <= 1:
            raise ValueError("train_ratio must be above 0 and at most 1")

    @property
    def falls_back(self) -> bool:
        """Whether the original text stands in for a failed rewrite."""
        return self.copyright_failure_policy in ("original", "use_original", "fallback_original")

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> CptSettings:
        known = {f.name for f in fields(cls)} - {"prompts"}
        named = {"max_in_flight": raw.get("batch_size"), **raw, "enable_thinking": optional_bool(raw.get("cpt_enable_thinking"))}
        return cls(**{k: v for k, v in named.items() if k in known and (v is not None or k == "enable_thinking")}, prompts=load_prompts(raw.get("prompts") or []))


@dataclass(frozen=True)
class QaSettings:
    """Questions and answers from texts by a chain of model calls."""

    prompts: Mapping[str, str] = field(default_factory=dict)
    thinking: Mapping[int, bool | None] = field(default_factory=dict)
    seed: int = 0
    output_path: str = "./json_output/qa"
    cache_unsaved: bool = False  # also remember keys of rows that were not saved
    batch_rows: int = 5000  # results that are saved at once

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> QaSettings:
        return cls(prompts=load_prompts(raw.get("prompts") or []), thinking=thinking_switches(raw.get("thinking_enabled_by_step")), seed=int(raw.get("seed", 0)), output_path=raw.get("output_path", cls.output_path), batch_rows=int(raw.get("batch_rows") or cls.batch_rows))


def load_prompts(entries: list[Mapping[str, str]], lenient: bool = False) -> dict[str, str]:
    """Templates of an ordered list of {name: path}; with lenient, files that don't exist are left out."""
    paths = {name: Path(path) for entry in entries for name, path in entry.items()}
    return {name: path.read_text(encoding="utf-8") for name, path in paths.items() if not lenient or path.exists()}
