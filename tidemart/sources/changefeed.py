"""Change feed from a table snapshot and a log of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.sinks.state_table import Pointer

ENVELOPE = ["op", "db", "before", "after", "source", "ts_ms"]
NO_IMAGE = "map<string,string>"


def payload_of(columns: list[str], **changed: Column) -> Column:
    """A map of text values from ``columns``; ``changed`` replaces some of them."""
    cells: list[Column] = []
    for name in columns:
        cells += [F.lit(name), changed.get(name, F.col(name)).cast("string")]
    return F.create_map(*cells)


def source_of(db: str, table: Column) -> Column:
    return F.create_map(F.lit("db"), F.lit(db), F.lit("table"), table)


def snapshot_to_envelope(
    df: DataFrame, db: str, table: str, ts_ms: int = 0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Every row of a table as a snapshot (``op = 'r'``) envelope."""
    return df.select(
        *keep,
        F.lit("r").alias("op"),
        F.lit(db).alias("db"),
        F.lit(None).cast(NO_IMAGE).alias("before"),
        payload_of([c for c in df.columns if c not in keep]).alias("after"),
        source_of(db, F.lit(table)).alias("source"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )


def change_feed(log: DataFrame, snapshot: DataFrame | None = None, startup: str = "initial") -> DataFrame:
    """``initial`` is the snapshot and then the log, ``latest`` the log alone."""
    if startup == "latest":
        return log
    if startup != "initial" or snapshot is None:
        raise ValueError("startup is 'latest', or 'initial' with a snapshot")
    return snapshot.unionByName(log)


def bootstrap_batches(read_chunk, chunks: int, key: str, position: str, send):
    """S4 ``initial`` on a stream: a ``foreachBatch`` function for the log that reads the snapshot along the way.

    Each batch of the log takes one more chunk of the table, until all ``chunks``
    have been read; then the log goes on alone. ``read_chunk(i)`` gives the rows of
    a chunk as ``op = 'r'`` envelopes, as they are in the table while the batch is
    open: after its first log row and before the first of the next. A row that the
    batch's log also has is left out of the chunk, as the log is at least as new;
    what the log has in later batches comes after. Which batch read which chunk is
    written to ``position`` before it is read, so a replay takes the same one.
    ``send(rows, batch_id)`` gets log rows and chunk rows with equal columns.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        pointer = Pointer(batch.sparkSession, position)
        taken = pointer.read() or {"chunks": {}}
        if str(batch_id) not in taken["chunks"] and len(taken["chunks"]) < chunks:
            taken["chunks"][str(batch_id)] = len(taken["chunks"])
            pointer.write(taken)
        chunk = taken["chunks"].get(str(batch_id))
        if chunk is None:
            return send(batch, batch_id)
        image = F.coalesce("after", "before")[key]
        known = batch.select(image.alias("_key")).distinct()
        rows = read_chunk(chunk).withColumn("_key", image).join(known, "_key", "left_anti").drop("_key")
        return send(batch.unionByName(rows.select(*batch.columns)), batch_id)

    return write
