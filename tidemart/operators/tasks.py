"""How rows are laid out between steps: kept in the shared work folder, dealt over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.session import work_path

DEALT_ROWS = 100_000  # in one task


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared work folder and read again, so that what made them runs once."""
    path = work_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dealt(rows: DataFrame, columns: list[str], per_task: int = DEALT_ROWS) -> DataFrame:
    """``rows`` dealt by a hash of ``columns`` over so many tasks that none has more than about ``per_task``.

    A few splits of well-packed files hold any number of rows, and a task would sort all of its own.
    """
    tasks = -(-rows.count() // per_task)
    return rows.repartition(tasks, *columns) if tasks > 1 else rows
