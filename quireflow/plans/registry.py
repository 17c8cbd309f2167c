"""Named stages, configuration and the plan builder."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable
from copy import deepcopy
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame


_LOG = logging.getLogger(__name__)


class LayoutError(Exception):
    """Base error, with details."""

    def __init__(self, message: str, **details: Any) -> None:
        super().__init__(message + (f" ({', '.join(f'{k}={v}' for k, v in details.items())})" if details else ""))
        self.details = details


class InputError(LayoutError): ...


class ConfigError(LayoutError): ...


class ModelError(LayoutError): ...


class PipelineError(LayoutError): ...


class Registry:
    """Names to stage functions or backends; a later registration replaces an earlier one."""

    def __init__(self) -> None:
        self._held: dict[str, Callable] = {}

    def register(self, name: str) -> Callable:
        def keep(f: Callable) -> Callable:
            self._held[name] = f
            return f

        return keep

    def get(self, name: str) -> Callable:
        if name not in self._held:
            raise PipelineError("unknown name", name=name)
        return self._held[name]

    def names(self) -> list[str]:
        return list(self._held)


STAGES, BACKENDS = Registry(), Registry()


def parse_value(text: str) -> Any:
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    try:
        return float(text) if "." in text else int(text)
    except ValueError:
        return text


def merge(base: dict, over: dict) -> dict:
    out = deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else deepcopy(v)
    return out


@dataclass
class Config:
    """Defaults, then a YAML file, then the environment, then the caller's values."""

    values: dict = field(default_factory=dict)

    @classmethod
    def load(cls, defaults: dict, path: str | None = None, environ: dict | None = None, prefix: str = "QUIREFLOW_", runtime: dict | None = None) -> Config:
        values = deepcopy(defaults)
        if path is not None:
            if not os.path.exists(path):
                raise ConfigError("no such file", path=path)
            import yaml

            with open(path, encoding="utf-8") as f:
                values = merge(values, yaml.safe_load(f) or {})
        for key, text in (os.environ if environ is None else environ).items():
            if key.startswith(prefix):
                rest = key[len(prefix) :].lower()
                # the longest section name that fits
                section = max((s for s in values if isinstance(values[s], dict) and rest.startswith(f"{s}_")), key=len, default=None)
                if section is not None:
                    values = merge(values, {section: {rest[len(section) + 1 :]: parse_value(text)}})
        return cls(merge(values, runtime or {}))

    def get(self, key: str, default: Any = None) -> Any:
        at: Any = self.values
        for part in key.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at


@dataclass
class Context:
    """What stages share: the configuration, named tables, values, each stage's result, and the stage that is being built."""

    config: Config = field(default_factory=Config)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    values: dict[str, Any] = field(default_factory=dict)
    results: dict[str, DataFrame] = field(default_factory=dict)
    stage: str | None = None
    scratch: Any = None

    def get(self, key: str, default: Any = None) -> Any:
        """A value of the configuration."""
        return self.config.get(key, default)

    def written(self, df: DataFrame) -> Any:
        """This run's tables in the shared folder."""
        if self.scratch is None:
            from quireflow.tables import Tables

            self.scratch = Tables(df.sparkSession, "pages")
        return self.scratch

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """A frame that is read more than once, written to the shared folder."""
        return self.written(df).cut(df, name)


    def close(self) -> None:
        """Deletes the tables that were written for this run; what reads them can't be used any more."""
        if self.scratch is not None:
            self.scratch.close()
            self.scratch = None


class Stage:
    """Base of a stage with a state of its own: made once a pipeline; ``setup`` runs before the plan is built and ``teardown`` after it."""

    def __init__(self, context: Context) -> None:
        self.context = context

    def setup(self) -> None: ...

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def teardown(self) -> None: ...


@dataclass
class Pipeline:
    """Composes registered stages to one plan; ``results`` has every stage's DataFrame by name.

    A stage is a function of a frame and the context, or a subclass of Stage. ``stages`` is the given list, else the
    configuration's ``pipeline.stages``, else every registered stage; those in ``skip`` or ``pipeline.skip_stages`` pass
    their frame on unchanged.
    """

    stages: list[str] | None = None
    config: Config = field(default_factory=Config)
    skip: list[str] = field(default_factory=list)
    results: dict[str, DataFrame] = field(default_factory=dict)
    context: Context | None = None

    def __post_init__(self) -> None:
        self.context = self.context or Context(self.config, results=self.results)
        names = self.stages or self.config.get("pipeline.stages") or STAGES.names()
        self.skip = [*self.skip, *(self.config.get("pipeline.skip_stages") or [])]
        self._built = []
        for name in [*names, *self.skip]:  # an unknown name fails here, also if skipped
            STAGES.get(name)
        for name in names:
            made = STAGES.get(name)
            self._built.append((name, made(self.context) if isinstance(made, type) else made))

    def run(self, df: DataFrame) -> DataFrame:
        from quireflow.tables import ship

        ship(df.sparkSession)
        for name, stage in self._built:
            if name not in self.skip:
                self.context.stage = name
                _LOG.info("stage %s", name)
                try:
                    df = _applied(stage, df, self.context)
                except LayoutError:
                    raise
                except Exception as e:
                    raise PipelineError(str(e), stage=name) from e
            self.results[name] = df
        self.context.stage = None
        return df


def _applied(stage: Any, df: DataFrame, context: Context) -> DataFrame:
    if not isinstance(stage, Stage):
        return stage(df, context)
    stage.setup()
    try:
        return stage.apply(df)
    finally:
        stage.teardown()


def setup_logging(level: str = "INFO", file: str | None = None, form: str = "%(asctime)s %(name)s %(levelname)s %(message)s") -> logging.Logger:
    """The package's logger, to the console and to a file if one is named. A second call changes the level only."""
    logger = logging.getLogger("quireflow")
    logger.setLevel(level.upper())
    if not logger.handlers:
        for handler in [logging.StreamHandler(), *([logging.FileHandler(file, encoding="utf-8")] if file else [])]:
            handler.setFormatter(logging.Formatter(form))
            logger.addHandler(handler)
    return logger
