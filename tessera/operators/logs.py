"""Sessions in log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}


def parse(lines: DataFrame, col: str = "line") -> DataFrame:
    """``date time - pid - LEVEL - message`` lines in columns; others get nulls."""
    part = lambda i: F.regexp_extract(col, r"^(\S+ \S+) - (\d+) - ([A-Z]+) - (.*)$", i)
    blank = part(2) == ""
    return lines.withColumns({n: F.when(~blank, part(i)) for i, n in ((1, "time"), (2, "pid"), (3, "level"), (4, "message"))})


def sessions(log: DataFrame, is_start, is_end, by: str = "pid", order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """Adds ``session`` (from 1) to the rows from a process's start line to its end line; rows outside get null."""
    w = Window.partitionBy(by).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.sum(F.when(is_start, 1).otherwise(0)).over(upto)
    last_start = F.last(F.when(is_start, F.struct(*order)), ignorenulls=True).over(upto)
    last_end = F.last(F.when(is_end, F.struct(*order)), ignorenulls=True).over(before)
    open_ = last_start.isNotNull() & (last_end.isNull() | (last_end < last_start))
    return log.withColumn("session", F.when(open_, starts).cast("long"))


def messages_by_file(log: DataFrame, file, is_start, is_end, least: str = "WARNING", by: str = "pid", order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``file, messages``: what a process said at ``least`` level while it worked on a file."""
    rank = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    own = sessions(log, is_start, is_end, by, order).where("session is not null")
    w = Window.partitionBy(by, "session").orderBy(*order)
    own = own.withColumn("file", F.first(F.when(is_start, file), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    loud = own.where((F.try_element_at(rank, F.col("level")) >= LEVELS[least]) & ~is_start & ~is_end)
    return loud.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, "message"))), lambda x: x["message"]).alias("messages"))
