"""What the driver says of a run: on the console and, if a file is named, in that file too. Executors log through Spark."""

from __future__ import annotations

import logging
import logging.config
from pathlib import Path

from .config import byte_size

LINE = "{asctime} {levelname} {name} | {message}"
_FILES: dict[str, dict[str, dict]] = {}


def driver_logger(name: str = "pairscore", file: str | None = None, size: int | str = "10MB", files: int = 10, level: int = logging.INFO) -> logging.Logger:
    """The logger of a name. Each file that it was ever given is written to; one of ``size`` is put aside, and ``files`` of
    those are kept. Nothing is set up again unless a file is new."""
    known = _FILES.get(name)
    path = str(Path(file).resolve()) if file else None
    if known is None or (path and path not in known):
        known = _FILES.setdefault(name, {})
        if path:
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            known[path] = {"class": "logging.handlers.RotatingFileHandler", "filename": path, "maxBytes": byte_size(size), "backupCount": files, "encoding": "utf-8", "formatter": "line"}
        handlers = {f"{name} console": {"class": "logging.StreamHandler", "formatter": "line"}, **{f"{name} {p}": h for p, h in known.items()}}
        logging.config.dictConfig({
            "version": 1, "disable_existing_loggers": False, "formatters": {"line": {"format": LINE, "style": "{"}},
            "handlers": handlers, "loggers": {name: {"level": level, "handlers": list(handlers), "propagate": False}},
        })
    return logging.getLogger(name)
