"""Settings: sections of plain values, defaults overlaid with a TOML file."""

from __future__ import annotations

import tomllib
from functools import partial
from pathlib import Path
from typing import Any

# --- fixed values: the sections and keys that settings files hold, with the values that count where they are absent ---------------------------
FIXED = """
[paths]
raw_dir = "Data/raw"
chunks_dir = "Data/chunks"
chroma_dir = "Data/chroma"
index_json = "Data/index.json"
index_md = "Data/index.md"
archive_dir = "Data/archive"

[chunking]
target_tokens = 320
max_tokens = 480
min_tokens = 40
respect_headings = true

[model]
base_url = "http://localhost:5001/v1"
model = "koboldcpp"
api_key = ""
temperature = 0.2
max_tokens = 1024
timeout = 120
retries = 2

[embeddings]
collection_name = "chunks"
alias_strategy = "append"

[index]
root_min_count = 3
root_min_distinct = 2
root_top_k = 8
sibling_threshold = 0.30

[provenance]
source_type = "human-authored"
default_authority = "canonical"
default_confidence = 0.8
author = ""
original_source = ""

[temporal]
decay_class = "evergreen"

[salience]
related_max = 2
related_min_overlap = 0.20

[tokens]
mode = "estimate"
"""
# ------------------------------------------------------------------------------------------------------------------------------------------
#: what this engine adds: the names that packs carry, which consumers may expect otherwise, and the index file's heading
OWN = """
[pack]
schema = "knowledge-pack/1"
tool = "corpusmill"
chunk_schema = "chunk-frontmatter/1"
index_title = "Categorical Index"
"""
DEFAULTS: dict[str, dict[str, Any]] = tomllib.loads(FIXED + OWN)


class Section:
    """One section's values as attributes; a key that the section doesn't have is an error."""

    def __init__(self, name: str, **values: Any):
        if unknown := sorted(values.keys() - DEFAULTS[name].keys()):
            raise TypeError(f"[{name}] has no {', '.join(unknown)}")
        self.__dict__.update(DEFAULTS[name], **values)

    def __repr__(self) -> str:
        return ", ".join(f"{k}={v!r}" for k, v in vars(self).items())


Chunking, Model, Index, Related = (partial(Section, name) for name in ("chunking", "model", "index", "salience"))


class Config:
    """All sections as attributes; those given, as a Section or as a table of values, take the place of the defaults."""

    def __init__(self, **sections: Section | dict[str, Any]):
        for name in DEFAULTS:
            given = sections.get(name) or {}
            setattr(self, name, given if isinstance(given, Section) else Section(name, **given))


def load_config(path: str | Path | None = None) -> Config:
    """Defaults overlaid with a TOML file; sections unknown here are passed over. Relative paths count from the folder above the file's own
    folder, or from the working folder; a path with a scheme is taken as it is."""
    file = Path(path) if path is not None else None
    given = tomllib.loads(file.read_text(encoding="utf-8")) if file and file.exists() else {}
    base = file.resolve().parent.parent if given else Path.cwd()
    config = Config(**given)
    config.paths = Section("paths", **{k: v if "://" in v else str(base / v) for k, v in vars(config.paths).items()})
    return config
