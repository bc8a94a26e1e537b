"""python -m quillgraph: load a dictionary, save its graph and report on it."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import records as R
from .operators.upsert import clear
from .plans import build as B
from .plans import questions as Q
from .plans.graph import Graph, saved_rows
from .sources.settings import Settings


def report(graph: Graph, whole: bool) -> None:
    Q.validate(graph).orderBy("measure").show(50, truncate=False)
    if whole:
        Q.check_minima(graph).orderBy("type").show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    s = Settings.from_env()
    p = argparse.ArgumentParser(prog="quillgraph", description=__doc__)
    p.add_argument("--phase", type=int, default=2, help="1: packages, files, fields; 2: also cross-references, sub-files, variable pointers")
    for name in ("dictionary", "roots", "packages", "output"):
        p.add_argument(f"--{name}", default=getattr(s, name))
    p.add_argument("--clear", action="store_true", help="delete the saved graph first")
    p.add_argument("--validate-only", action="store_true", help="report on the saved graph")
    a = p.parse_args(argv)
    if a.phase not in (1, 2):
        print(f"phase {a.phase} is not implemented")
        return 1
    spark = SparkSession.builder.appName("quillgraph").getOrCreate()
    if a.clear:
        clear(spark, a.output)
    if not a.validate_only:
        if missing := Settings(a.dictionary, a.roots, a.packages, a.output).missing():
            print("missing:", *missing)
            return 1
        # phase 2 goes on from the phase 1 that is saved there, if there is one
        there = a.phase == 2 and "File" in saved_rows(spark, a.output)
        with B.reading(spark, a.dictionary) as entries:
            if there:
                written = B.add_phase_2(spark, a.output, R.cross_references(entries), R.variable_targets(entries))
            else:
                roots = a.roots if not Settings(dictionary=a.roots, packages=a.packages).missing() else None
                written = B.store(a.output, *B.records(spark, entries, a.packages, roots)[: 3 if a.phase == 1 else 5])
        for name, n in written.items():
            print(f"{name}: {n} written")
        Graph.vacuum(spark, a.output)
    report(Graph.load(spark, a.output), a.phase == 2)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
