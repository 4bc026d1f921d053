"""Repair of the new-visitor flag, batch form.

Per device and in order, a small state (one date) decides whether a record that
claims to be a first visit really is one. A window over a whole device would put
all rows of a hot device into one task, so the work is cut by ``chunk``, a coarse
prefix of the order:

1. every (device, chunk) is summarised by a partial aggregate,
2. a window over the summaries of a device gives the state each chunk starts with,
3. rows meet their chunk's starting state and a window inside (device, chunk)
   finishes the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemart.functions.dates import DAY_MS, local_date
from tidemart.operators.applog import field, set_flag
from tidemart.operators.joins import join_small
from tidemart.operators.tasks import kept

CHUNK_ROWS = 1_000_000
CHUNK_MS = 600_000
# Of an order of arrival in text: path and split of a file, or the offset without its last six digits.
ARRIVAL_CHUNK = "if(contains(seq, '\u0001'), substring_index(seq, '\u0001', 2), substring(seq, 1, 13))"


def event_cuts(df: DataFrame, chunk_ms: int, bound: int) -> DataFrame:
    """(mid, ts, cut, own) for the windows of ``chunk_ms`` in which a device has more than ``bound`` rows.

    Rows are counted per time, and times gathered per window. The times of a window
    are cut where their running count passes the bound; a time that is over the
    bound alone (``own``) is a cut of its own, to be cut by arrival.
    """
    window = F.expr(f"ts div {chunk_ms}").alias("_w")
    times = df.select("mid", "ts").filter(_usable()).groupBy("mid", window, "ts").count()
    # a window has at most chunk_ms times
    ordered = Window.partitionBy("mid", "_w").orderBy("ts")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum("count").over(before), F.lit(0))
    whole = F.sum("count").over(Window.partitionBy("mid", "_w"))
    full = times.select("mid", "ts", "count", upto.alias("_upto"), whole.alias("_all")).filter(F.col("_all") > bound)
    return full.select("mid", "ts", F.floor(F.col("_upto") / bound).alias("cut"), (F.col("count") > bound).alias("own"))


def _kept_with_cuts(source: DataFrame, order: str, chunk_size: int | None, bound: int) -> tuple[DataFrame, DataFrame | None]:
    """The four columns of the repair and their cuts. An order of event time reads them several times, so they are kept."""
    keys = source.select("mid", "is_new", "ts", "seq")
    if order != "event_time":
        return keys, None
    keys, size = kept(keys, "visitor-keys"), chunk_size or CHUNK_MS
    windows = keys.filter(_usable()).groupBy("mid", F.expr(f"ts div {size}").alias("_w")).count()
    if windows.filter(F.col("count") > bound).isEmpty():
        return keys, None
    return keys, kept(event_cuts(keys, size, bound), "visitor-cuts")


def _with_cuts(df: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """``df`` with the cut of each row.

    The cuts follow the number of rows, so they are not broadcast. A key has at most ``bound`` rows unless its cut is
    its own (a time that is over the bound alone); only where there are such cuts the keys get a salt.
    """
    if cuts is None:
        return df.withColumns({"cut": F.lit(0).cast("bigint"), "own": F.lit(False)})
    if cuts.filter("own").isEmpty():
        return df.join(cuts, ["mid", "ts"], "left")
    return join_small(df, cuts, ["mid", "ts"], "left", max_rows=0)


def _prepared(
    df: DataFrame, order: str, tz: str, chunk_size: int | None, cuts: DataFrame | None = None, bound: int = CHUNK_ROWS
) -> DataFrame:
    if order == "seq":
        rank, chunk = "seq", f"seq div {chunk_size or CHUNK_ROWS}"
    elif order == "arrival":
        rank, chunk = "seq", ARRIVAL_CHUNK
    elif order == "event_time":
        rank, window = "struct(ts, seq)", f"ts div {chunk_size or CHUNK_MS}"
        chunk = f"struct({window} AS w, coalesce(cut, 0L) AS cut, coalesce(own, false) AS own, if(own, seq div {bound}, 0L) AS at)"
        df = _with_cuts(df, cuts)
    else:
        raise ValueError(f"unknown order {order!r}")
    return df.select(
        "*",
        F.expr(rank).alias("_rank"),
        F.expr(chunk).alias("_chunk"),
        F.expr("coalesce(is_new = '1', false)").alias("_one"),
        local_date(F.col("ts"), tz).alias("_day"),
        local_date(F.col("ts") - F.lit(DAY_MS), tz).alias("_eve"),
    )


def _before(*keys: str, by: str) -> WindowSpec:
    return (
        Window.partitionBy(*keys)
        .orderBy(by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )


def _summary_as_coded(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mid", "_chunk").agg(
        F.expr("min(if(_one, _rank, null))").alias("first_one"),
        F.expr("min_by(_day, if(_one, _rank, null))").alias("first_day"),
        F.expr("max(if(_one, null, _rank))").alias("last_zero"),
        F.expr("max_by(_eve, if(_one, null, _rank))").alias("last_eve"),
    )


def _chain_as_coded(summary: DataFrame) -> DataFrame:
    w = _before("mid", by="_chunk")
    before = F.coalesce("_init", F.first("first_day", ignorenulls=True).over(w))
    seeded = summary.withColumn("seed", before)
    # A record with flag 0 counts only after the first record with flag 1.
    counts = F.col("seed").isNotNull() | (F.col("last_zero") > F.col("first_one"))
    marked = seeded.withColumn("mark", F.when(counts, F.col("last_eve")))
    last_mark = F.last("mark", ignorenulls=True).over(w)
    return marked.withColumns(
        {
            "_carry": F.coalesce(last_mark, "seed"),
            "_after": F.coalesce("mark", last_mark, "seed", "first_day"),
        }
    )


def _summary_as_documented(rows: DataFrame) -> DataFrame:
    start = F.when(F.col("_one"), F.col("_day")).otherwise(F.col("_eve"))
    return rows.groupBy("mid", "_chunk").agg(F.min_by(start, "_rank").alias("start"))


def _chain_as_documented(summary: DataFrame) -> DataFrame:
    first = F.first("start", ignorenulls=True).over(_before("mid", by="_chunk"))
    carried = summary.withColumn("_carry", F.coalesce("_init", first))
    return carried.withColumn("_after", F.coalesce("_carry", "start"))


def _state_as_coded(rows: DataFrame) -> DataFrame:
    w = _before("mid", "_chunk", by="_rank")
    own_day = F.first(F.when(F.col("_one"), F.col("_day")), ignorenulls=True).over(w)
    rows = rows.withColumn("_seed", F.coalesce("_carry", own_day))
    mark = F.when(~F.col("_one") & F.col("_seed").isNotNull(), F.col("_eve"))
    rows = rows.withColumn("_mark", mark)
    last_mark = F.last("_mark", ignorenulls=True).over(w)
    return rows.withColumn("_state", F.coalesce(last_mark, "_seed"))


def _state_as_documented(rows: DataFrame) -> DataFrame:
    w = _before("mid", "_chunk", by="_rank")
    start = F.when(F.col("_one"), F.col("_day")).otherwise(F.col("_eve"))
    return rows.withColumn("_state", F.coalesce("_carry", F.first(start, ignorenulls=True).over(w)))


RULES = {
    "as_coded": (_summary_as_coded, _chain_as_coded, _state_as_coded),
    "as_documented": (_summary_as_documented, _chain_as_documented, _state_as_documented),
}


def _usable() -> Column:
    return F.col("mid").isNotNull() & F.col("ts").isNotNull()


def _chained(
    df: DataFrame, rule: str, order: str, tz: str, chunk_size: int | None, initial: DataFrame | None,
    cuts: DataFrame | None = None, bound: int = CHUNK_ROWS,
) -> DataFrame:
    """Per (device, chunk): the state it starts with and the one it leaves behind."""
    summarise, chain, _ = RULES[rule]
    rows = df.select("mid", "is_new", "ts", "seq").filter(_usable())
    summary = summarise(_prepared(rows, order, tz, chunk_size, cuts, bound))
    if initial is None:
        known = summary.withColumn("_init", F.lit(None).cast("date"))
    else:
        known = summary.join(initial.select("mid", F.col("d").alias("_init")), "mid", "left")
    return chain(known)


def repair_visitors(
    df: DataFrame,
    rule: str = "as_coded",
    order: str = "seq",
    tz: str = "UTC",
    chunk_size: int | None = None,
    narrow: DataFrame | None = None,
    initial: DataFrame | None = None,
    bound: int = CHUNK_ROWS,
) -> DataFrame:
    """Rewrite ``is_new`` of ``df(mid, is_new, ts, seq, ...)``.

    ``order`` is ``seq`` (numbers), ``arrival`` (texts of ``topic_stream``) or
    ``event_time``. A chunk is ``chunk_size`` arrival numbers, or milliseconds with
    ``order="event_time"``; there, a window in which a device has more than ``bound``
    rows is cut further, so that no chunk holds more than twice the bound.

    ``seq`` is a unique number in arrival order. ``narrow`` may be a cheaper frame
    with the same four columns of the same rows; the summaries are taken from it.
    ``initial(mid, d)`` gives states to start from. Rows without a device or a time
    pass through unchanged.
    """
    source, cuts = _kept_with_cuts(df if narrow is None else narrow, order, chunk_size, bound)
    if narrow is None and set(df.columns) == set(source.columns):
        df = source.select(*df.columns)
    carry = _chained(source, rule, order, tz, chunk_size, initial, cuts, bound)
    carry = carry.filter(F.col("_carry").isNotNull()).select("mid", "_chunk", "_carry")

    rows = _prepared(df, order, tz, chunk_size, cuts, bound).join(carry, ["mid", "_chunk"], "left")
    rows = RULES[rule][2](rows)
    stale = _usable() & F.col("_one") & (F.col("_state") != F.col("_day"))
    return rows.withColumn(
        "is_new", F.when(stale, F.lit("0")).otherwise(F.col("is_new"))
    ).select(*df.columns)


def visitor_states(
    df: DataFrame,
    rule: str = "as_coded",
    order: str = "seq",
    tz: str = "UTC",
    chunk_size: int | None = None,
    initial: DataFrame | None = None,
    bound: int = CHUNK_ROWS,
) -> DataFrame:
    """(mid, d): the state of every device in ``df`` after its last record."""
    source, cuts = _kept_with_cuts(df, order, chunk_size, bound)
    chained = _chained(source, rule, order, tz, chunk_size, initial, cuts, bound)
    last = chained.groupBy("mid").agg(F.max_by("_after", "_chunk").alias("d"))
    return last.filter(F.col("d").isNotNull())


def repair_log(df: DataFrame, narrow: DataFrame | None = None, **options) -> DataFrame:
    """``repair_visitors`` on log records, rewriting ``common.is_new`` in ``record``.

    ``narrow`` gives the keys (``seq``, ``ts``, ``mid``, ``is_new``) from a cheaper parse.
    """
    record = F.col("record")
    keyed = df.withColumns({"mid": field(record["common"], "$.mid"), "is_new": field(record["common"], "$.is_new")})
    fixed = repair_visitors(keyed, narrow=narrow, **options)
    return fixed.withColumn("record", set_flag(record, F.col("is_new"))).select(*df.columns)
