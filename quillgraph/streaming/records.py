"""Records of exports that arrive as files: kept current, file by file, whatever the order in which they come.

A line's place is the name of its file and its place in the file, so what a late file tells falls where it belongs, and what is told again changes nothing. Each
batch is summed to what it tells of a key, and that is added to what is kept of the key (operators.keyed): only parts of the tables with
such keys are written. All that is kept is a last or first line of its kind, or a row by its line, so a batch that is done twice, after a failure,
counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import records as R
from ..operators.keyed import Keyed
from ..operators.stored import Rounds
from ..sources.exports import clean_bytes, line_place, parse_lines
from .exports import keep_up

#: Key of what is kept of each kind of record.
KEYS = {
    "files": ("number",),
    "fields": ("file_number", "number", "line_no"),
    "cross_references": ("file_number", "field_number", "xref_number"),
    "variable_targets": ("file_number", "field_number", "v_number", "line_no"),
}


def stream_lines(spark: SparkSession, directory: str, files_at_once: int = 100) -> DataFrame:
    """file, block, raw of the lines of files as they arrive in a directory: where each line's split begins."""
    text = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(directory)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), clean_bytes(F.col("value")).alias("raw"))


@dataclass(frozen=True)
class KeptRecords:
    """Records of these kinds, kept in tables under a folder, each in so many parts."""

    spark: SparkSession
    folder: str
    kinds: tuple[str, ...] = tuple(KEYS)
    parts: int = 64

    def table(self, kind: str) -> Keyed:
        return Keyed(self.spark, f"{self.folder}/{kind}", KEYS[kind], self.parts)

    def take(self, batch: DataFrame, number: int = 0) -> None:
        """Add the lines of a batch (file, block, raw)."""
        with Rounds(self.spark) as rounds:
            entries = rounds.put(parse_lines(batch.select(line_place().alias("line_no"), "raw")))
            for kind in self.kinds:
                if kind == "files":
                    self._add(kind, R.files_told(entries), R.add_files)
                elif kind == "cross_references":
                    self._add(kind, R.cross_references_told(entries), R.add_cross_references)
                else:
                    rows = R.fields(entries) if kind == "fields" else R.variable_targets(entries)
                    self.table(kind).upsert(rows, ["line_no"])

    def _add(self, kind: str, told: DataFrame, add) -> None:
        self.table(kind).merge(told, lambda old, new: add(new if old is None else old.unionByName(new)))

    def records(self, kind: str) -> DataFrame | None:
        """The records as they are now; None before any batch."""
        told = self.table(kind).read()
        if told is None:
            return None
        if kind == "cross_references":  # asked by field: as many tasks as there are parts
            return R.cross_references_of(told.repartition(self.parts, "file_number", "field_number"))
        return R.files_of(told) if kind == "files" else told

    def follow(self, lines: DataFrame, once: bool = True) -> StreamingQuery:
        """Take in a stream of lines; with once, all files that are there. Begun again, it goes on where it ended."""
        return keep_up(lines, self.take, f"{self.folder}/progress", once)
