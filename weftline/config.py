"""Settings of a corpus: sites, crawl, extraction and folders, from a TOML file."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

MODES = ("all", "changed-only", "new-only", "force-full")


@dataclass(frozen=True)
class Site:
    name: str
    seed_url: str
    allowed_domain: str


@dataclass(frozen=True)
class Settings:
    """All of a file's settings; `folder` holds the tables."""

    sites: tuple[Site, ...]
    user_agent: str
    folder: str
    mode: str = "all"
    use_sitemap: bool = True
    delay: float = 1.0
    per_site: int = 0
    per_host: int = 0
    retry_transient: bool = True
    min_words: int = 50
    other: dict = field(default_factory=dict)


def find(start: Path | None = None, name: str = "config.toml") -> Path:
    """The file in start or the nearest folder above it."""
    at = (start or Path.cwd()).resolve()
    for folder in (at, *at.parents):
        if (folder / name).is_file():
            return folder / name
    raise FileNotFoundError(f"no {name} in {at} or above it")


def load(path: Path | None = None) -> Settings:
    """Settings of a file, with relative folders taken from where it lies; ValueError if a value is out of range."""
    path = (path or find()).resolve()
    data = tomllib.loads(path.read_text("utf-8"))
    crawl, extract = data.get("crawl", {}), data.get("extract", {})
    sites = tuple(Site(s["name"], s["seed_url"], s["allowed_domain"]) for s in data.get("sites", ()))
    if not sites:
        raise ValueError("at least one site is needed")
    mode = str(crawl.get("recheck", "all"))
    if mode not in MODES:
        raise ValueError(f"crawl.recheck is {mode!r}, not one of {', '.join(MODES)}")

    def least(where: dict, key: str, default, bound, kind=int):
        value = kind(where.get(key, default))
        if value < bound:
            raise ValueError(f"{key} is {value}, under {bound}")
        return value

    least(crawl, "workers_per_host", 1, 1)
    folder = data["storage"].get("folder") or data["storage"]["raw_dir"]
    return Settings(
        sites, crawl["user_agent"], folder if "://" in folder else str((path.parent / folder).resolve()), mode, bool(crawl.get("use_sitemap", True)), least(crawl, "request_delay_seconds", 1.0, 0.0, float),
        least(crawl, "max_pages", 0, 0), least(crawl, "max_pages_per_host", 0, 0), bool(crawl.get("retry_transient_errors", True)), least(extract, "min_words", 50, 0), data,
    )


def choose(settings: Settings, names: list[str] | None) -> tuple[Site, ...]:
    """The sites with these names or domains, all without names; SystemExit for one that no site has."""
    if not names:
        return settings.sites
    unknown = [n for n in names if not any(n in (s.name, s.allowed_domain) for s in settings.sites)]
    if unknown:
        raise SystemExit(f"no site is called {', '.join(unknown)}; there are {', '.join(s.name for s in settings.sites)}")
    return tuple(s for s in settings.sites if s.name in names or s.allowed_domain in names)
