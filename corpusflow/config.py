"""Typed settings with their defaults."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field, fields
from typing import Any

log = logging.getLogger(__name__)

DEFAULT_PROMPT = (
    "You help software engineers. You explain source code, read technical "
    "documents and answer questions about how systems are built."
)

# Limits that decide which rows exist and how long they are.
MAX_CODE_CHARS = 4096
MIN_CODE_CHARS = 50
MIN_BODY_CHARS = 30
MIN_SECTION_CHARS = 100
MAX_SECTION_CHARS = 6000
MIN_PAIR_CODE_CHARS = 40
MAX_PAIR_CODE_CHARS = 4096
MIN_PAIR_DOC_CHARS = 30
MAX_PAIR_DOC_CHARS = 2000
MIN_PAIR_BODY_CHARS = 20
MAX_PACKAGE_DOC_CHARS = 500
MIN_PACKAGE_UNITS = 3
MAX_PACKAGE_FILES = 15
MAX_PACKAGE_NAMES = 12
MIN_TURNS_WITH_PROMPT = 3
VALIDATION_SHARE = 0.05
DEFAULT_SEED = 42
MAX_SEQ_LENGTH = 2048
MAX_FILE_BYTES = 2_000_000_000

# Share of each example type that is kept when nothing is configured.
DEFAULT_WEIGHTS = {
    "code_explanation": 1.0,
    "code_completion": 0.6,
    "type_documentation": 0.8,
    "package_overview": 1.0,
    "spec_explanation": 1.0,
}


@dataclass(frozen=True)
class Wording:
    """Texts of generated questions and answers. Names in braces are filled per row."""

    method: str = "method `{name}` of `{receiver}`"
    function: str = "function `{name}`"
    explain: str = "What does the {entity} do? It belongs to package `{module}` of {project}."
    located: str = "It is declared in `{file}` (package `{package}`)."
    signature: str = "Its signature is `{signature}`"
    complete: str = "Write the missing body of this function:"
    describe_type: str = "What is the type `{name}` for? It belongs to package `{module}` of {project}."
    members: str = "The type has {count} {label}."
    fields_label: str = "fields"
    methods_label: str = "methods"
    overview: str = "Give an overview of package `{module}` from {project}: what is it for and what is in it?"
    overview_fallback: str = "Package `{package}` belongs to {project} and is imported as `{module}`."
    files: str = "Files: {names}"
    types: str = "Public types ({count}): {names}"
    functions: str = "Public functions and methods ({count}): {names}"
    sections: tuple[str, ...] = (
        "How does the {domain} define \"{title}\"?",
        "Summarise the part of the {domain} on \"{title}\".",
        "Please go through \"{title}\" in the {domain}.",
        "I am reading the {domain}. What do I need to know about \"{title}\"?",
    )
    pair_explain: str = "What does the following function do?"
    pair_complete: str = "Fill in the body of the following function:"
    fence: str = "go"


@dataclass(frozen=True)
class SourceConfig:
    """A landed source tree."""

    name: str
    path: str
    type: str = "go_code"
    domain: str | None = None


@dataclass(frozen=True)
class DatasetConfig:
    """A landed external dataset.

    `type` is 'table' (rows of a dataset in the given `format`) or 'jsonl' (chat rows and
    code rows, one per line). `file_format` is the format of the landed files of a table.
    """

    name: str
    path: str
    type: str = "jsonl"
    format: str = "code"
    file_format: str = "parquet"
    max_samples: int = 0
    # Parts of a landed hub dataset: folders below `path`.
    subset: str | None = None
    split: str | None = None
    filter_field: str | None = None
    filter_value: Any = None


@dataclass(frozen=True)
class CorpusConfig:
    system_prompt: str = DEFAULT_PROMPT
    sources: tuple[SourceConfig, ...] = ()
    datasets: tuple[DatasetConfig, ...] = ()
    # A Parquet table (source, path, content) with the files of all sources, in place of folders.
    landed_files: str | None = None
    # Where `run_corpus` writes if it isn't told.
    output: str = "./data"
    # Codec of the written JSON lines, such as gzip; None writes them plain.
    output_compression: str | None = None
    # Larger files are left out and counted; a row can't hold more than the default.
    max_file_bytes: int = MAX_FILE_BYTES
    weights: dict[str, float] = field(default_factory=dict)
    max_code_chars: int = MAX_CODE_CHARS
    min_code_chars: int = MIN_CODE_CHARS
    include_tests: bool = True
    skip_generated: bool = True
    skip_patterns: tuple[str, ...] = ()
    skip_patterns_at_root: bool = False
    sample_all: bool = False
    seed: int = DEFAULT_SEED
    max_seq_length: int = MAX_SEQ_LENGTH
    chars_per_token: float = 4.0
    wording: Wording = field(default_factory=Wording)

    def __post_init__(self):
        for kind, entries in (("source", self.sources), ("dataset", self.datasets)):
            names = [e.name for e in entries]
            twice = sorted({n for n in names if names.count(n) > 1})
            if twice:
                raise ValueError(f"{kind} names must differ: {', '.join(twice)}")

    def weight(self, example_type: str) -> float:
        return float(self.weights.get(example_type, DEFAULT_WEIGHTS[example_type]))

    @classmethod
    def from_dict(cls, raw: dict[str, Any] | None, folder: str | None = None) -> CorpusConfig:
        """Settings from a nested mapping; unknown keys are ignored, missing ones defaulted.

        Relative paths start at `folder`, the folder of the settings file. A dataset without a
        name is called by its position.
        """

        def placed(path: str) -> str:
            if folder is None or "://" in path or path.startswith(("/", "file:", "hdfs:", "dbfs:")):
                return path
            return f"{folder.rstrip('/')}/{path.removeprefix('./')}"

        raw = raw or {}
        data, training = raw.get("data") or {}, raw.get("training") or {}
        base = (raw.get("repos") or {}).get("dir", "./repos")
        sources = tuple(
            SourceConfig(
                name=s["name"],
                path=placed(s.get("path") or f"{base}/{s['name']}"),
                type=s.get("type", "go_code"),
                domain=s.get("domain"),
            )
            for s in raw.get("sources") or []
        )
        names = {f.name for f in fields(DatasetConfig)}
        # Accepted names of settings.
        listed = raw.get("datasets") or raw.get("golang_datasets") or []
        landing = (raw.get("landing") or {}).get("dir", "./datasets")
        datasets = []
        for number, entry in enumerate(listed):
            known = {k: v for k, v in entry.items() if k in names and v is not None}
            known.setdefault("name", f"dataset-{number}")
            # Hub datasets are landed first; a row of theirs then reads like any table.
            if known.get("type") == "huggingface":
                known["type"] = "table"
            known["path"] = placed(known.get("path") or f"{landing}/{known['name']}")
            datasets.append(DatasetConfig(**known))
        # Names of settings that stand as they are.
        named = (
            "max_code_chars", "min_code_chars", "include_tests", "skip_generated",
            "skip_patterns_at_root", "sample_all", "max_file_bytes",
        )
        plain = {k: data[k] for k in named if data.get(k) is not None}
        if data.get("landed_files"):
            plain["landed_files"] = placed(data["landed_files"])
        if "seed" in training:
            plain["seed"] = training["seed"]
        if "max_seq_length" in training:
            plain["max_seq_length"] = training["max_seq_length"]
        return cls(
            system_prompt=raw.get("system_prompt", DEFAULT_PROMPT),
            sources=sources,
            datasets=tuple(datasets),
            output=placed(data.get("output_dir") or "./data"),
            output_compression=data.get("output_compression"),
            weights=dict(data.get("weights") or {}),
            skip_patterns=tuple(data.get("skip_patterns") or ()),
            **plain,
        )

    @classmethod
    def from_yaml(cls, path: str) -> CorpusConfig:
        """Settings from a file. Without the file all settings have their defaults."""
        if not os.path.exists(path):
            log.warning("settings %s not found, using defaults", path)
            return cls.from_dict({})
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading YAML settings needs the yaml package") from missing
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f), os.path.dirname(os.path.abspath(path)))
