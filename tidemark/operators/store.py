"""The control tables on storage: three append-only journals.

Plain Parquet has no transactions and no update, so nothing is rewritten: each
entry has a folder of its own, named by what it records. Writing an entry again
replaces that entry only, which makes replays harmless, and two loads that
append at the same time never share an output folder. Each table has one writer
per source at a time.

Entries are small files. `compact` gathers them into the base of a new generation, which
the journals then continue in. It may run beside loads:

1. It opens the new generation. Entries go there from now on; readers take it together
   with the one before.
2. It gathers the old generation into the new one's base, which nobody reads yet.
3. It completes the new generation, and readers leave the old one.

An entry that was on its way to the old generation meanwhile may miss the gathering, so
whoever appends looks again after writing: if a newer generation has been opened, the entry
is written there too. An entry that came into both is read once. One compaction runs at a
time; what an unfinished one has left counts for nothing.

Beside the journals lies a snapshot of the registry with a small file per source, so that
finding one source's row doesn't fold them. It is written by one fold for all sources,
and from then on with every registry change and every advance of a mark.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.model import (
    RUN_JOURNAL,
    SOURCE_JOURNAL,
    SOURCE_OBJECT,
    WATERMARK_HISTORY,
)
from tidemark.operators.journals import (
    last_source_rows,
    last_run_rows,
    registry_state,
    run_state,
    watermark_state,
)
from tidemark.sources.zones import zone

TABLES = {
    "source_object": SOURCE_JOURNAL,
    "ingestion_run": RUN_JOURNAL,
    "watermark_history": WATERMARK_HISTORY,
}

OPEN, COMPLETE = "open", "complete"

# What tells one advance of a mark from another.
_ADVANCE = ["SourceObjectId", "WatermarkHistoryId", "RunId"]


class ControlStore:
    """Journals under the metadata zone of `base`."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._known: tuple[int, int] | None = None

    def create(self) -> ControlStore:
        """Write an empty first entry to each journal, so all can be read."""
        self._open(0)
        self._begin(0, COMPLETE)
        return self

    def append(self, table: str, rows: DataFrame, entry: str) -> None:
        written, (_, current) = None, self._generations(fresh=True)
        while written != current:
            self._write(table, rows, current, entry)
            written, (_, current) = current, self._generations(fresh=True)

    def append_rows(self, table: str, rows: list[dict], entry: str) -> None:
        frame = self.spark.createDataFrame(
            [tuple(row.get(name) for name in TABLES[table].names) for row in rows],
            TABLES[table],
        )
        self.append(table, frame.coalesce(1), entry)

    def journal(self, table: str) -> DataFrame:
        """All rows of a journal. While a compaction runs, that of two generations."""
        complete, current = self._generations()
        return self._entries(table, complete, current)

    def _entries(self, table: str, complete: int, last: int) -> DataFrame:
        paths = [self._base(table, complete)] if complete else []
        paths += [self._path(table, n) for n in range(complete, last + 1)]
        reader = self.spark.read.schema(TABLES[table])
        return reader.option("recursiveFileLookup", True).parquet(*paths)

    def runs(self) -> DataFrame:
        return run_state(self.journal("ingestion_run"))

    def history(self) -> DataFrame:
        """The advances of marks, each once."""
        rows = self.journal("watermark_history")
        # Only a compaction can have taken up an entry that was also written later.
        return rows.dropDuplicates(_ADVANCE) if self.generation() else rows

    def registry(self) -> DataFrame:
        """The registry with the marks as last applied."""
        state = registry_state(self.journal("source_object"))
        return watermark_state(state, self.history())

    def save_registry(self, registry: DataFrame, version: int) -> None:
        """Append registry rows as a new version of these sources."""
        self.append(
            "source_object",
            registry.withColumn("Version", F.lit(version).cast("bigint")),
            f"version-{version}",
        )
        if self._one("begun", 0, "key int") is not None:
            self._save_rows(watermark_state(registry, self.history()))

    def advance(self, row: dict) -> None:
        """Append an advance of a mark to the history."""
        self.append_rows("watermark_history", [row], row["RunId"])
        if self._one("begun", 0, "key int") is not None:
            self._save_mark(row["SourceObjectId"], row["NewWatermarkValue"])

    # --- The snapshot -----------------------------------------------------------

    def save_snapshot(self) -> None:
        """Fold the journals once, into a file per source.

        Marks that advance from here on have files of their own, newer than the rows.
        """
        spark = self.spark
        none = spark.createDataFrame([], "LastWatermarkValue timestamp_ntz")
        none.write.mode("overwrite").parquet(self._snapshot("marks"))
        begun = spark.range(1).select(F.lit(0).alias("key"))
        begun.write.mode("overwrite").parquet(f"{self._snapshot('begun')}/key=0")
        self._save_rows(self.registry())

    def source_row(self, source_id: int) -> Row | None:
        """One source's registry row with its mark: two small files, not the journals.

        Files that are being written anew, or a store without a snapshot, cost a fold.
        """
        try:
            row = self._one("rows", source_id, SOURCE_OBJECT)
            marks = self._one("marks", source_id, "LastWatermarkValue timestamp_ntz")
        except Exception:  # replaced between the listing and the read
            row = None
        if row is None:
            mine = F.col("SourceObjectId") == source_id
            return self.registry().where(mine).first()
        if marks is None:
            return row
        return Row(**(row.asDict() | marks.asDict()))

    def _save_rows(self, registry: DataFrame) -> None:
        # Each source's row lies in a folder of its own; others stay.
        (
            registry.select(SOURCE_OBJECT.names)
            .withColumn("key", F.col("SourceObjectId"))
            .repartition("key")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("key")
            .parquet(self._snapshot("rows"))
        )

    def _save_mark(self, source_id: int, mark: datetime) -> None:
        frame = self.spark.range(1).select(ntz(mark).alias("LastWatermarkValue"))
        frame.write.mode("overwrite").parquet(f"{self._snapshot('marks')}/key={source_id}")

    def _one(self, part: str, source_id: int, schema) -> Row | None:
        path = f"{self._snapshot(part)}/key={source_id}"
        try:
            return self.spark.read.schema(schema).parquet(path).first()
        except AnalysisException:  # there is none
            return None

    def _snapshot(self, part: str) -> str:
        return f"{zone(self.base, 'metadata')}/snapshot/{part}"

    # --- Generations ----------------------------------------------------------

    def generation(self) -> int:
        """The generation that entries go to, as last looked up."""
        return self._generations()[1]

    def _generations(self, fresh: bool = False) -> tuple[int, int]:
        """The last complete generation, and the last one opened."""
        if self._known is None or fresh:
            begun = self.spark.read.schema("Generation int, State string").option(
                "recursiveFileLookup", True
            )
            done = F.when(F.col("State") == COMPLETE, F.col("Generation"))
            row = begun.parquet(self._marks()).agg(F.max(done), F.max("Generation")).first()
            self._known = (row[0], row[1])
        return self._known

    def compact(self) -> None:
        """Gather all entries into few files, as a new generation.

        Loads may go on. The old generation is left where it is, late entries of which
        are in the new one as well.
        """
        following = self._generations(fresh=True)[1] + 1
        self._open(following)
        self._begin(following, OPEN)
        complete, _ = self._generations()
        folds = {
            "source_object": last_source_rows,
            "ingestion_run": last_run_rows,
            "watermark_history": lambda journal: journal.dropDuplicates(_ADVANCE),
        }
        for table, fold in folds.items():
            gathered = fold(self._entries(table, complete, following - 1)).to(TABLES[table])
            gathered.hint("rebalance").write.mode("overwrite").parquet(
                self._base(table, following)
            )
        self._begin(following, COMPLETE)

    def _open(self, generation: int) -> None:
        """An empty first entry in each journal, so that all can be read."""
        for table, schema in TABLES.items():
            self._write(table, self.spark.createDataFrame([], schema), generation, "created")

    def _begin(self, generation: int, state: str) -> None:
        row = self.spark.createDataFrame(
            [(generation, state)], "Generation int, State string"
        ).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self._marks()}/entry={generation}-{state}")
        self._generations(fresh=True)

    def _marks(self) -> str:
        return f"{zone(self.base, 'metadata')}/generations"

    def _path(self, table: str, generation: int) -> str:
        return f"{zone(self.base, 'metadata')}/{table}/generation={generation}"

    def _base(self, table: str, generation: int) -> str:
        return f"{zone(self.base, 'metadata')}/{table}/base={generation}"

    def _write(self, table: str, rows: DataFrame, generation: int, entry: str) -> None:
        rows.to(TABLES[table]).write.mode("overwrite").parquet(
            f"{self._path(table, generation)}/entry={entry}"
        )
