"""A pipeline of named stages with statuses, configuration and resumption."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators import corpus, dedup
from ..sources.documents import read_documents, write_documents
from ..sources.storage import read_file, write_file

SEEDED, SPAWNED, RUNNING, COMPLETED, FAILED = "seeded", "spawned", "running", "completed", "failed"
Function = Callable[..., DataFrame]


def _filter(docs: DataFrame, least: str | None = None, languages: list[str] | None = None, drop: str | None = None, keep: str | None = None, detect=None) -> DataFrame:
    """Language, length, list of URLs to drop, list of URLs to keep, in this order."""
    from ..sources.crawl import read_list

    if languages:
        docs = corpus.filter_languages(docs, languages, detect)
    if least:
        docs = corpus.filter_length(docs, least)
    if drop:
        docs = corpus.drop_urls(docs, read_list(docs.sparkSession, drop))
    if keep:
        docs = corpus.keep_urls(docs, read_list(docs.sparkSession, keep))
    return docs


def _near_dedup(docs: DataFrame, threshold: float = 0.9, perms: int = 256, n: int = 5) -> DataFrame:
    from pyspark.sql import functions as F

    from ..functions.text import content

    b, r = dedup.optimal_bands(threshold, perms)
    sigs = dedup.signatures(docs.select("id", content(F.col("paragraphs")).alias("t")), ["id"], "t", perms, n)
    return dedup.apply_result(docs, dedup.self_dedup(sigs, b, r))


#: Stage functions by name; a call adds to them.
STAGES: dict[str, Function] = {"clean": corpus.clean, "filter": _filter, "remove_repeats": corpus.remove_repeats, "near_dedup": _near_dedup}


@dataclass
class Step:
    name: str
    function: str
    params: dict = field(default_factory=dict)
    status: str = SEEDED
    comment: str = ""


@dataclass
class Pipeline:
    """Ordered steps; each one's result is written below ``folder`` and read by the next.

    The state is a JSON file there: a run goes on after the last completed step.
    """

    name: str
    steps: list[Step]
    folder: str

    @property
    def _state(self) -> str:
        return f"{self.folder.rstrip('/')}/{self.name}.json"

    @property
    def status(self) -> str:
        states = [s.status for s in self.steps]
        return FAILED if FAILED in states else COMPLETED if all(s == COMPLETED for s in states) else RUNNING if RUNNING in states or COMPLETED in states else states[0] if states else COMPLETED

    def save(self) -> None:
        write_file(SparkSession.active(), self._state, json.dumps([vars(s) for s in self.steps]))

    def load(self) -> Pipeline:
        if (text := read_file(SparkSession.active(), self._state)) is not None:
            old = {s["name"]: s for s in json.loads(text)}
            for s in self.steps:
                if (o := old.get(s.name)) and o["function"] == s.function and o["params"] == s.params:
                    s.status, s.comment = o["status"], o["comment"]
                else:
                    break  # a changed step and those after it run again
        return self

    def path(self, i: int) -> str:
        return f"{self.folder.rstrip('/')}/{self.name}/{i:02d}-{self.steps[i].name}"

    def run(self, docs: DataFrame) -> DataFrame:
        """Runs the steps that aren't completed. A step that fails is marked, with the error, and the error is raised."""
        spark = docs.sparkSession
        for i, s in enumerate(self.steps):
            if s.status != COMPLETED:
                s.status, s.comment = RUNNING, ""
                self.save()
                try:
                    STAGES[s.function](docs, **s.params).write.mode("overwrite").parquet(self.path(i))
                except Exception as e:
                    s.status, s.comment = FAILED, str(e)[:500]
                    self.save()
                    raise
                s.status = COMPLETED
                self.save()
            docs = spark.read.parquet(self.path(i))
        return docs


def substitute(value, variables: dict[str, str]):
    """Replaces ``${name}`` in strings at any depth; an unknown name is an error."""
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: str(variables[m[1]]), value)
    if isinstance(value, dict):
        return {k: substitute(v, variables) for k, v in value.items()}
    return [substitute(v, variables) for v in value] if isinstance(value, list) else value


def build(config: dict, name: str, folder: str, **variables: str) -> Pipeline:
    """A pipeline from ``{"variables": {}, "defaults": {}, "steps": {step: {function, params}}, "pipelines": {name: [step]}}``."""
    known = {**config.get("variables", {}), **variables}
    steps = []
    for step in config["pipelines"][name]:
        spec = config["steps"][step]
        params = {**config.get("defaults", {}).get(spec["function"], {}), **spec.get("params", {})}
        steps.append(Step(step, spec["function"], substitute(params, known), SPAWNED))
    return Pipeline(name, steps, substitute(folder, known)).load()


#: The usual order after a download.
POST_DOWNLOAD = {
    "steps": {
        "clean": {"function": "clean"},
        "filter": {"function": "filter", "params": {"least": "${least}"}},
        "repeats": {"function": "remove_repeats"},
        "dedup": {"function": "near_dedup"},
    },
    "variables": {"least": "500c"},
    "pipelines": {"post_download": ["clean", "filter", "repeats", "dedup"]},
}


def main(arguments: list[str] | None = None) -> None:
    """``python -m tessera.plans.pipeline CONFIG NAME FOLDER OUT INPUT...``: runs a pipeline of a JSON config (``-``: the usual one)."""
    import sys

    config, name, folder, out, *inputs = arguments or sys.argv[1:]
    spark = SparkSession.builder.appName(name).getOrCreate()
    spec = POST_DOWNLOAD if config == "-" else json.loads(Path(config).read_text())
    write_documents(build(spec, name, folder).run(read_documents(spark, inputs)), out, per_file=2500)


if __name__ == "__main__":
    main()
