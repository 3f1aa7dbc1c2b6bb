"""What a run has done so far, written before and after every step, so that a run that ended can go on.

``<path>/<run>/plan`` says what the run is about, ``<path>/<run>/<table>.<step>`` that a step was reached and what
it found, ``<path>/<run>/over`` that nothing is left to do.  Files are created, never changed.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tablelift import storage

STARTED, EXPORTED, LOADING, COMMITTED, FINISHED = "started", "exported", "loading", "committed", "finished"
#: Outcomes after which a table is not moved again in the same run.
DONE = ("SUCCESS", "SKIPPED", "WARNING")


class Journal:
    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.folder, self.run = spark, f"{path.rstrip('/')}/{run}", run
        self.numbers: dict[str, int] = {}
        self.facts: dict[tuple[str, str], dict] = {}

    @classmethod
    def open(cls, spark: SparkSession, path: str, tables: list[str], about: str, resume: bool) -> Journal:
        """A new run, or with ``resume`` the last one if it is not over.  A run goes on only for the plan it was begun with."""
        runs = storage.names(spark, path)
        if resume and runs and not storage.exists(spark, f"{path.rstrip('/')}/{runs[-1]}/over"):
            journal = cls(spark, path, runs[-1])
            plan = json.loads(storage.read(spark, f"{journal.folder}/plan"))
            if plan["about"] != about:
                raise ValueError(f"run {journal.run} was begun with another plan: {plan['about']}")
            journal.numbers = {t: i for i, t in enumerate(plan["tables"])}
            for name in storage.names(spark, journal.folder):
                number, _, step = name.partition(".")
                if step:
                    journal.facts[plan["tables"][int(number)], step.split(".")[0]] = json.loads(storage.read(spark, f"{journal.folder}/{name}"))
            return journal
        now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        journal = cls(spark, path, now)
        journal.numbers = {t: i for i, t in enumerate(tables)}
        if not storage.create(spark, f"{journal.folder}/plan", json.dumps({"about": about, "tables": tables})):
            raise FileExistsError(journal.folder)
        return journal

    def note(self, table: str, step: str, **facts) -> None:
        """A step may be reached again by a later attempt; the last one counts."""
        self.facts[table, step] = facts
        text, again = json.dumps(facts, default=str), 0
        while not storage.create(self.spark, f"{self.folder}/{self.numbers[table]:06d}.{step}.{again:03d}", text):
            again += 1

    def found(self, table: str, step: str) -> dict | None:
        return self.facts.get((table, step))

    def finished(self, table: str) -> dict | None:
        """The job row of a table that needs nothing more."""
        job = self.found(table, FINISHED)
        return job | {"run_at": datetime.fromisoformat(job["run_at"])} if job and job["status"] in DONE else None

    def close(self) -> None:
        if all(self.finished(t) for t in self.numbers):
            storage.create(self.spark, f"{self.folder}/over", "")
