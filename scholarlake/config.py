"""Settings of a run: read from JSON or YAML, checked, and never holding secrets.

Keys and tokens stay in the environment; ``configured`` only tells which of them are
there, so that no credential becomes a column or a plan's text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

#: Environment variables of services by the service that needs them (fixed values).
CREDENTIALS = {
    "semantic_scholar": "SEMANTIC_SCHOLAR_API_KEY",
    "openalex": "OPENALEX_API_KEY",
    "unpaywall": "UNPAYWALL_EMAIL",
    "core": "CORE_API_KEY",
    "crossref": "CROSSREF_EMAIL",
    "wiley": "WILEY_TDM_TOKEN",
    "elsevier": "ELSEVIER_API_KEY",
    "elsevier_institution": "ELSEVIER_INST_TOKEN",
}


class ConfigurationError(ValueError):
    """Settings that cannot be used."""


@dataclass(frozen=True)
class Resolution:
    prefer_publisher_version: bool = True
    allow_preprints: bool = True
    allow_title_fallback: bool = True
    title_similarity_threshold: float = 0.90
    stop_when_confident: bool = True
    stop_confidence_threshold: float = 0.75
    source_priority: tuple[str, ...] | None = None
    trusted_domains: tuple[str, ...] | None = None
    denied_hosts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Files:
    min_pdf_bytes: int = 1024
    max_pdf_bytes: int = 250_000_000
    allowed_content_types: tuple[str, ...] = ("application/pdf",)
    landing_page_max_bytes: int = 2_000_000


@dataclass(frozen=True)
class Recovery:
    similarity_threshold: float = 0.85
    min_abstract_len: int = 80


@dataclass(frozen=True)
class Output:
    root_dir: str = "output"


@dataclass(frozen=True)
class Settings:
    resolution: Resolution = field(default_factory=Resolution)
    files: Files = field(default_factory=Files)
    recovery: Recovery = field(default_factory=Recovery)
    output: Output = field(default_factory=Output)


_SECTIONS = {"resolution": Resolution, "files": Files, "recovery": Recovery, "output": Output}


def parse(text: str, kind: str = "json") -> Settings:
    """Settings of a document; what it leaves out has its default, and a key that no
    section knows is an error."""
    try:
        if kind == "json":
            raw = json.loads(text)
        elif kind in ("yaml", "yml"):
            try:
                import yaml
            except ImportError as missing:
                raise ConfigurationError("YAML settings need PyYAML") from missing
            raw = yaml.safe_load(text)
        else:
            raise ConfigurationError(f"no settings of kind {kind!r}")
    except ConfigurationError:
        raise
    except ValueError as broken:
        raise ConfigurationError(f"settings that are no {kind}: {broken}") from broken
    if not isinstance(raw, Mapping):
        raise ConfigurationError("settings must be an object")
    if unknown := sorted(set(raw) - set(_SECTIONS)):
        raise ConfigurationError(f"unknown sections: {', '.join(unknown)}")
    made = {}
    for name, section in _SECTIONS.items():
        values = raw.get(name) or {}
        known = {f.name for f in fields(section)}
        if not isinstance(values, Mapping) or (unknown := sorted(set(values) - known)):
            raise ConfigurationError(f"{name}: unknown keys {unknown}" if isinstance(values, Mapping) else f"{name} must be an object")
        made[name] = section(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
    return checked(Settings(**made))


def checked(settings: Settings) -> Settings:
    """The settings, if they can be used."""
    r, f = settings.resolution, settings.files
    rules = [
        (0.0 <= r.title_similarity_threshold <= 1.0, "resolution.title_similarity_threshold must be from 0 to 1"),
        (0.0 <= r.stop_confidence_threshold <= 1.0, "resolution.stop_confidence_threshold must be from 0 to 1"),
        (r.source_priority is None or len(r.source_priority) > 0, "resolution.source_priority must name a provider"),
        (f.min_pdf_bytes > 0, "files.min_pdf_bytes must be above 0"),
        (f.max_pdf_bytes > f.min_pdf_bytes, "files.max_pdf_bytes must be above files.min_pdf_bytes"),
        (f.landing_page_max_bytes > 0, "files.landing_page_max_bytes must be above 0"),
        (0.0 <= settings.recovery.similarity_threshold <= 1.0, "recovery.similarity_threshold must be from 0 to 1"),
        (settings.recovery.min_abstract_len >= 0, "recovery.min_abstract_len must not be below 0"),
        (bool(str(settings.output.root_dir).strip()), "output.root_dir must not be empty"),
    ]
    for good, message in rules:
        if not good:
            raise ConfigurationError(message)
    return settings


def load(spark, path: str) -> Settings:
    """Settings of a file on any file system the session reads."""
    try:
        text = spark.read.text(path, wholetext=True).first()[0]
    except Exception as missing:
        raise ConfigurationError(f"no settings at {path}") from missing
    return parse(text, path.rsplit(".", 1)[-1].lower())


def configured(environment: Mapping[str, str] | None = None) -> set[str]:
    """The services whose key or address is in the environment."""
    found = os.environ if environment is None else environment
    return {service for service, name in CREDENTIALS.items() if (found.get(name) or "").strip()}


def graph_options(options: Mapping | None = None, **shorthand) -> dict:
    """Options of a graph, given as an object or one by one, but not both."""
    short = {k: v for k, v in shorthand.items() if v is not None and v is not False}
    if options is not None and short:
        raise ValueError(f"options are given twice: as an object and as {', '.join(sorted(short))}")
    return dict(options) if options is not None else short
