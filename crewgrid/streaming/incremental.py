"""Incremental ingestion: each workbook that was not seen before is processed once.

The file source's checkpoint keeps what has been seen, per file, so a new
file never makes old ones run again; a run ends when all that is there has been
taken (availableNow). Changed and deleted files are found by the manifest
(sources.files.diff).
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schema import CELLS
from ..session import ship
from ..sources.xlsx import failure, workbook_cells


def new_files(spark: SparkSession, path: str, pattern: str = "*.xls*", per_batch: int = 1000) -> DataFrame:
    """path and content of files, as a stream."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", per_batch).load(path).select("path", "content")


def cells_of(files: DataFrame) -> DataFrame:
    """The cells relation of files with path and content; unreadable ones are one row with the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in CELLS.split(", ")]
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(path, *cell) for cell in workbook_cells(io.BytesIO(content))]
                except Exception as error:  # noqa: BLE001 - one bad file must not stop the others
                    rows.append((path, None, None, None, None, failure(error)))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({c: "Int32" for c in ("sheet_idx", "row_idx", "col_idx")})

    ship(files.sparkSession)
    return files.mapInPandas(run, CELLS)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand every batch of what is there now to `each`, then end. A batch that failed comes again with the same number."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
