"""The step pipeline: a registry of named steps and a manifest, so that a run resumes where it stopped."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path

import yaml
from pyspark.sql import SparkSession

from terracell.sources import store

log = logging.getLogger("terracell")

STEPS = [
    "rasterize_buildings", "distance_allocation", "canyon_width", "width_features", "dem_features", "lcz_features", "building_features",
    "train_model", "predict_heights", "rasterize_heights", "height_allocation", "canyon_width_final", "canyon_length", "roads",
    "industrial", "land_cover", "lcz", "terrain", "multiband",
]


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def find_config(name: str = "config.yaml", start: str = ".") -> str | None:
    """The nearest file of that name in ``start`` or a folder above it."""
    here = Path(start).resolve()
    return next((str(d / name) for d in (here, *here.parents) if (d / name).exists()), None)


def log_to(path: str | None = None, level: int = logging.INFO) -> None:
    """Messages go to standard output and, with a path, to that file as well; calling again replaces both."""
    for handler in list(log.handlers):
        log.removeHandler(handler)
        handler.close()
    handlers = [logging.StreamHandler(sys.stdout), *([logging.FileHandler(path, encoding="utf-8")] if path else [])]
    for handler in handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    log.setLevel(level)


@dataclass
class Manifest:
    """What ran: JSON beside the outputs, rewritten whole after each step.

    With a session the file is in any store that Spark reads, else local.
    """

    path: str
    spark: SparkSession | None = None
    outputs: dict[int, dict] = field(default_factory=dict)
    times: dict[int, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> Manifest:
        m = cls(path, spark)
        text = store.read_text(spark, path) if spark else Path(path).read_text(encoding="utf-8") if Path(path).exists() else None
        if text is not None:
            raw = json.loads(text)
            m.outputs = {int(k): v for k, v in raw["outputs"].items()}
            m.times = {int(k): v for k, v in raw["times"].items()}
        return m

    def done(self, step: int) -> bool:
        return step in self.outputs

    def _write(self) -> None:
        text = json.dumps({"outputs": self.outputs, "times": self.times})
        if self.spark:
            store.write_text(self.spark, self.path, text)
        else:
            draft = Path(self.path).with_suffix(".draft")
            draft.write_text(text, encoding="utf-8")
            draft.replace(self.path)

    def save(self, step: int, outputs: dict) -> None:
        self.outputs[step] = outputs
        self.times[step] = datetime.now(timezone.utc).isoformat()
        self._write()

    def verify(self) -> list[int]:
        """Forgets steps of which an output is not there or not whole, and returns them; without a session nothing is checked."""
        if self.spark is None:
            return []
        gone = [k for k, outputs in self.outputs.items() if not all(store.complete(self.spark, p) for p in outputs.values())]
        for k in gone:
            log.warning("step %d: %s: its outputs are not whole, so it has to run again", k, STEPS[k - 1])
            del self.outputs[k], self.times[k]
        if gone:
            self._write()
        return gone

    def first_open(self) -> int:
        """The first step that has not run."""
        return next((k for k in range(1, len(STEPS) + 1) if not self.done(k)), len(STEPS) + 1)

    def reset(self) -> None:
        self.outputs, self.times = {}, {}
        if self.spark:
            store.remove(self.spark, self.path)
        else:
            Path(self.path).unlink(missing_ok=True)

    def status(self) -> dict:
        steps = [{"step": k, "name": STEPS[k - 1], "time": self.times[k].split("T")[1][:8]} for k in sorted(self.outputs)]
        return {"completed": steps, "next": self.first_open(), "is_complete": len(self.outputs) >= len(STEPS)}


Step = Callable[[SparkSession, dict, dict], dict]


def run_pipeline(spark: SparkSession, config: dict, steps: dict[str, Step], manifest: Manifest, start: int | None = None, end: int = len(STEPS), only: list[int] | None = None) -> dict:
    """Runs steps in order; each takes (spark, config, outputs of all steps so far) and returns its outputs.

    By default a run starts at the first step that has not run or whose
    outputs are not whole. With ``only`` just those steps run. Steps that are
    not run count by their saved outputs.
    """
    manifest.verify()
    wanted = sorted(only) if only else range(start or manifest.first_open(), end + 1)
    for k in wanted:
        name = STEPS[k - 1]
        log.info("step %d: %s", k, name)
        before = {STEPS[i - 1]: manifest.outputs[i] for i in manifest.outputs}
        manifest.save(k, steps[name](spark, config, before))
    return manifest.status()


def parse_steps(text: str) -> list[int]:
    """``3-7`` or ``1,2``."""
    first, dash, last = text.partition("-")
    return list(range(int(first), int(last) + 1)) if dash else [int(x) for x in text.split(",")]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terracell", description="Runs the urban-parameter pipeline.")
    p.add_argument("--config", default="config.yaml")
    p.add_argument("--manifest", default="manifest.json")
    p.add_argument("--log", help="a file that gets all messages as well")
    p.add_argument("--start-from", type=int, help="number of the first step")
    p.add_argument("--only-step", type=int, help="number of the one step to run")
    p.add_argument("--range", help="steps as first-last")
    p.add_argument("--steps", help="steps as a list with commas")
    p.add_argument("--reset", action="store_true", help="forget what ran; with no choice of steps only")
    p.add_argument("--status", action="store_true", help="print what ran and stop")
    return p


def main(argv: list[str], spark: SparkSession, steps: dict[str, Step]) -> dict:
    """Precedence: status, steps, only-step, range, default."""
    a = parser().parse_args(argv)
    manifest = Manifest.load(a.manifest, spark)
    if a.status:
        print(json.dumps(manifest.status(), indent=1), file=sys.stdout)
        return manifest.status()
    log_to(a.log)
    config = load_config(find_config(a.config) or a.config)
    if a.steps or a.only_step or a.range:
        chosen = parse_steps(a.steps) if a.steps else [a.only_step] if a.only_step else parse_steps(a.range)
        return run_pipeline(spark, config, steps, manifest, only=chosen)
    if a.reset:
        manifest.reset()
    return run_pipeline(spark, config, steps, manifest, start=a.start_from)
