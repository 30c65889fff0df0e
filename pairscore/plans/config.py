"""Run configuration from arguments, environment variables and a .env file."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from pathlib import Path

from ..sources.models import ChatModel


@dataclass(frozen=True)
class EvalConfig:
    model_a: ChatModel
    model_b: ChatModel
    input_md: str
    output_dir: str
    gold_jsonl: str | None = None


def project_root(start: Path | None = None) -> Path:
    """The nearest folder upwards with a .env or pyproject.toml; the start itself if there is none."""
    here = (start or Path.cwd()).resolve()
    return next((p for p in (here, *here.parents) if any((p / n).exists() for n in (".env", "pyproject.toml"))), here)


def read_env_file(path: Path) -> dict[str, str]:
    """KEY=value lines; comments, blank lines and an ``export`` before the key are allowed, and quotes are taken off."""
    if not path.exists():
        return {}
    found = {}
    for line in path.read_text(encoding="utf-8").splitlines():
        key, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and not key.startswith("#"):
            value = value.strip()
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
            found[key.strip()] = value[1:-1] if quoted else value.split(" #")[0].strip()
    return found


# The variables that describe a run.
MODEL_FIELDS = {"base_url": "BASE_URL", "api_key": "API_KEY", "name": "NAME"}
PATH_FIELDS = {"input_md": "INPUT_MD", "output_dir": "OUTPUT_DIR"}
GOLD_VARIABLE = "GOLD_JSONL"
# The generating model's variables; its provider may only be one that speaks chat completions.
GENERATOR_FIELDS = {"name": "LOCAL_MODEL", "base_url": "LOCAL_MODEL_BASE_URL", "api_key": "LOCAL_MODEL_API_KEY"}
PROVIDER_VARIABLE, PROVIDER = "LOCAL_MODEL_PROVIDER", "openai"


def variables(env_path: str | Path | None = None) -> dict[str, str]:
    """What is set: by the environment, or else by the file, the project's own if none is named."""
    return read_env_file(Path(env_path) if env_path else project_root() / ".env") | dict(os.environ)


def settled(found: dict[str, str], wanted: dict[str, str], given: dict[str, str | None] | None = None) -> dict[str, str]:
    """A value for each field of ``wanted`` (field: variable), ``given`` ones first. Raises ValueError with the names of all
    variables that are missing or blank."""
    values = {field: (given or {}).get(field) or found.get(variable, "").strip() for field, variable in wanted.items()}
    if missing := [wanted[field] for field, value in values.items() if not value]:
        raise ValueError("required settings are not set: " + ", ".join(missing))
    return values


def load_config(input_md: str | None = None, output_dir: str | None = None, env_path: str | Path | None = None) -> EvalConfig:
    """The evaluation's settings: two models, and the two paths unless they are given."""
    sides = {f"{side}.{field}": f"MODEL_{side}_{variable}" for side in "AB" for field, variable in MODEL_FIELDS.items()}
    found = variables(env_path)
    values = settled(found, sides | PATH_FIELDS, {"input_md": input_md, "output_dir": output_dir})
    models = {f"model_{side.lower()}": ChatModel(**{field: values[f"{side}.{field}"] for field in MODEL_FIELDS}) for side in "AB"}
    return EvalConfig(**models, **{field: values[field] for field in PATH_FIELDS}, gold_jsonl=found.get(GOLD_VARIABLE) or None)


def load_generator(env_path: str | Path | None = None) -> ChatModel:
    """The model that generates and judges questions, at the temperature its server chooses."""
    found = variables(env_path)
    provider = found.get(PROVIDER_VARIABLE) or PROVIDER
    if provider != PROVIDER:
        raise ValueError(f"{PROVIDER_VARIABLE}={provider} is not supported, only {PROVIDER} is")
    return ChatModel(**settled(found, GENERATOR_FIELDS), temperature=None)


_SIZE = re.compile(r"\s*(\d+(?:\.\d+)?)\s*([kmg]?)b?\s*", re.I)


def byte_size(size: int | str) -> int:
    """Bytes of a size such as 10MB, 1.5 GB or 4096; anything else raises ValueError."""
    found = _SIZE.fullmatch(str(size))
    if not found:
        raise ValueError(f"not a size: {size!r}")
    amount, unit = found.groups()
    return int(float(amount) * 2 ** (10 * " kmg".index(unit.lower() or " ")))
