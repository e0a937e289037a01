"""Numbered descriptions of what lies in a folder, of which the newest counts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from zonepulse.sources import files

FOLDER = "_versions"


class Versions:
    """JSON files 0, 1, … below `path`; each appears whole and none is ever changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, f"{path.rstrip('/')}/{FOLDER}"

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in files.names(self.spark, self.folder) if n.endswith(".json"))

    def content(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.folder}/{number:08d}.json"))

    def current(self) -> dict | None:
        """The newest version and its number, None before the first."""
        known = self.numbers()
        return {**self.content(known[-1]), "version": known[-1]} if known else None

    def publish(self, change: Callable[[dict | None], dict]) -> int:
        """Makes the next version from the newest one; starts over if another writer was first."""
        while True:
            now = self.current()
            number = now["version"] + 1 if now else 0
            if files.publish_text(self.spark, f"{self.folder}/{number:08d}.json", json.dumps(change(now))):
                return number

    def keep(self, newest: int) -> list[dict]:
        """Removes all but the newest versions and returns what those say."""
        known = self.numbers()
        for number in known[:-newest]:
            files.remove(self.spark, f"{self.folder}/{number:08d}.json")
        return [self.content(n) for n in known[-newest:]]
