"""Settings of a run, read from YAML or nested mappings. All problems are gathered before any is raised."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


class ConfigError(ValueError):
    """All problems of a configuration, a line each."""


@dataclass
class Config:
    values: dict
    base: str = "."
    problems: list[str] = field(default_factory=list)

    def get(self, path: str, default=None):
        now = self.values
        for part in path.split("."):
            if not isinstance(now, dict) or part not in now:
                return default
            now = now[part]
        return now

    def number(self, path: str, default: float, low: float | None = None, high: float | None = None) -> float:
        raw = self.get(path, default)
        try:
            value = float(raw)
        except (TypeError, ValueError):
            self.problems.append(f"{path}: {raw!r} is not a number")
            return default
        if low is not None and value < low or high is not None and value > high:
            self.problems.append(f"{path}: {value:g} is out of range")
        return value

    def file(self, path: str, needed: bool = True) -> str | None:
        raw = self.get(path)
        if not raw:
            if needed:
                self.problems.append(f"{path}: missing")
            return None
        return raw if os.path.isabs(raw) or "://" in raw else os.path.join(self.base, raw)

    def check(self) -> None:
        if self.problems:
            raise ConfigError("\n".join(self.problems))


def load(path: str) -> Config:
    """Settings of a YAML file; relative paths in it start at its folder. A file that is no mapping is a problem like others."""
    import yaml

    with open(path, encoding="utf-8") as f:
        values = yaml.safe_load(f)
    config = Config(values if isinstance(values, dict) else {}, os.path.dirname(os.path.abspath(path)))
    if not isinstance(values, dict):
        config.problems.append(f"{path}: not a mapping of settings")
    return config


def archive_samples(config: Config, names: list[str], end: str = ".tar.gz") -> list[str]:
    """The samples of archive files, in order. Names with a dot before the ending are other files and left out; no sample at all is a problem."""
    found = sorted(n.removesuffix(end) for n in names if n.endswith(end) and "." not in n.removesuffix(end))
    if not found:
        config.problems.append(f"no archives named after a sample among {len(names)} files")
    return found


def input_mode(config: Config) -> str:
    """existing_overhangs before samples before accessions; none of them is a problem."""
    for mode in ("existing_overhangs", "samples", "accessions"):
        if config.get(f"inputs.{mode}"):
            return mode
    config.problems.append("inputs: none of existing_overhangs, samples and accessions is given")
    return "none"
