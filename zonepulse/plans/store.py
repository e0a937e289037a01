"""Trained models in storage, by name and version."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from zonepulse.sources import files
from zonepulse.sources.versions import Versions


class ModelStore:
    """Each model name has its folders and a version file that is written last: a training run
    that fails half way leaves the old model in use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _history(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.path}/{name}")

    def save(self, name: str, model: PipelineModel, **facts: object) -> int:
        """Stores a model with some facts about it and makes it the current one."""
        folder = f"model-{uuid.uuid4().hex}"
        model.write().save(f"{self.path}/{name}/{folder}")
        return self._history(name).publish(lambda now: {"folder": folder, "facts": facts})

    def load(self, name: str, version: int | None = None) -> PipelineModel:
        """The current model, or an older one that is still kept."""
        history = self._history(name)
        content = history.current() if version is None else history.content(version)
        if content is None:
            raise ValueError(f"no model {name}")
        return PipelineModel.load(f"{self.path}/{name}/{content['folder']}")

    def facts(self, name: str) -> dict:
        now = self._history(name).current()
        return {**now["facts"], "version": now["version"]} if now else {}

    def clean_up(self, name: str, keep: int = 2) -> int:
        """Removes all but the newest versions and what runs that failed have left."""
        kept = {content["folder"] for content in self._history(name).keep(keep)}
        gone = [n for n in files.names(self.spark, f"{self.path}/{name}") if n.startswith("model-") and n not in kept]
        for folder in gone:
            files.remove(self.spark, f"{self.path}/{name}/{folder}")
        return len(gone)
