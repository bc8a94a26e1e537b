"""Settings of a load, from defaults and the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Where a load reads and writes. Each can be set as QUILLGRAPH_<NAME> in the environment."""

    dictionary: str = "data/DD.zwr"
    roots: str = "data/DIC.zwr"
    packages: str = "data/Packages.csv"
    output: str = "graph"

    @classmethod
    def from_env(cls) -> Settings:
        return cls(**{f.name: v for f in fields(cls) if (v := os.environ.get(f"QUILLGRAPH_{f.name.upper()}"))})

    def missing(self) -> list[str]:
        """Local inputs that don't exist; paths with a scheme are left to Spark's readers."""
        return [p for p in (self.dictionary, self.packages) if "://" not in p and not Path(p).exists()]


#: Where a session on one machine, as in tests, keeps what it stores when it names no folder.
ONE_MACHINE = "/tmp/quillgraph-checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. A session on several machines that names none is refused:
    each executor would write to a disk of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "local").partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    return ONE_MACHINE
