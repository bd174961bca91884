"""Numbering, chunks, splits, shuffles and samples that are the same in every run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Row numbers from 1 in the order of columns, without one task that holds all rows.

    The rows are range partitioned and sorted; a row's number is its place in its partition plus the sizes of
    those before, which are one row each.
    """
    from ..sources.storage import stored

    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed, "ordered")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_p", before.alias("_start"))
    return placed.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn(name, (F.col("_start") + inside + 1).cast("long")).drop("_p", "_at", "_start")


def rechunk(df: DataFrame, size: int, order: list[str], first: int = 1, name: str = "batch") -> DataFrame:
    """Numbers batches of ``size`` rows in order."""
    return numbered(df, order, "_n").withColumn(name, (F.floor((F.col("_n") - 1) / size) + first).cast("long")).drop("_n")


def _fold(groups: list[str], size: str, most: int, full: bool, first: int):
    """Numbers of containers that are filled row by row in each group of a sorted partition; only the running state is kept.

    full: a container closes once it has ``most`` or more; else before the row that would bring it above ``most``.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, filled = None, first, 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(size)).to_numpy(zero_copy_only=False)
            keys = list(zip(*(batch.column(batch.schema.get_field_index(g)).to_pylist() for g in groups))) if groups else [()] * len(sizes)
            out = np.empty(len(sizes), dtype=np.int64)
            for i, (k, n) in enumerate(zip(keys, sizes.tolist())):
                n = n if n == n and n is not None else 0
                if k != key:
                    key, number, filled = k, first, 0
                elif filled >= most if full else filled and filled + n > most:
                    number, filled = number + 1, 0
                filled += n
                out[i] = number
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "_number"])

    return fold


def pack_files(files: DataFrame, size: int, file: str = "file", n: str = "n", first: int = 1) -> DataFrame:
    """``file, batch``: whole files, in order, to batches that close once they have ``size`` rows or more; a new batch starts from 0.

    Each decision needs the one before, so one task goes over the files (a row each) and keeps a running sum.
    """
    rows = files.where(F.col(n) > 0).select(file, F.col(n).cast("long").alias("_size")).repartition(1).sortWithinPartitions(file)
    kind = dict(files.dtypes)[file]
    return rows.mapInArrow(_fold([], "_size", size, True, first), f"`{file}` {kind}, _size long, _number long").select(file, F.col("_number").alias("batch"))


def rotate(df: DataFrame, most_bytes: int, size, order: list[str], within: list[str], name: str = "file_no", first: int = 1) -> DataFrame:
    """Numbers output files of at most ``most_bytes`` within each group; a row that doesn't fit opens the next file, where the size starts from 0.

    A group's rows go over one task in order, as they would to its files; the task keeps a running sum only.
    """
    rows = df.withColumn("_size", F.coalesce(size, F.lit(0)).cast("long")).repartition(*within).sortWithinPartitions(*within, *order)
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", _number long"
    return rows.mapInArrow(_fold(within, "_size", most_bytes, False, first), schema).withColumnRenamed("_number", name).drop("_size")


def equal_split(df: DataFrame, parts: int, order: list[str], name: str = "part") -> DataFrame:
    """Numbers ``parts`` contiguous parts from 1 whose sizes differ by at most one, larger ones first."""
    out = numbered(df, order, "_n")
    total = out.count()
    small, extra = divmod(total, parts)
    n = F.col("_n") - 1
    cut = extra * (small + 1)
    return out.withColumn(name, (F.when(n < cut, F.floor(n / (small + 1))).otherwise(extra + F.floor((n - cut) / max(1, small))) + 1).cast("long")).drop("_n")


def weighted_split(df: DataFrame, weights: dict[str, float], order: list[str], name: str = "host") -> DataFrame:
    """Contiguous parts in proportion to the hosts' weights; the last host has the remainder."""
    out = numbered(df, order, "_n")
    total, whole, at = out.count(), sum(weights.values()), 0
    hosts = list(weights)
    host = F.lit(hosts[-1])
    cuts = []
    for h in hosts[:-1]:
        at += int(total * weights[h] / whole)
        cuts.append((h, at))
    for h, c in reversed(cuts):
        host = F.when(F.col("_n") <= c, h).otherwise(host)
    return out.withColumn(name, host).drop("_n")


def pack_groups(sizes: DataFrame, weights: dict[str, float], group: str = "domain", n: str = "n") -> list[tuple[str, str]]:
    """(group, host): groups by falling size, each to the host whose load, divided by its weight, is then least.

    A plan for hosts without a cluster manager: the driver goes over one row for each group.
    """
    load = dict.fromkeys(weights, 0.0)
    out = []
    for r in sizes.orderBy(F.desc(n), group).select(group, n).toLocalIterator():
        h = min(load, key=lambda h: ((load[h] + r[1]) / weights[h], h))
        load[h] += r[1]
        out.append((r[0], h))
    return out


def unit(seed: int, key: str = "id"):
    """A number from 0 to 999,999 from a key and a seed."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(1_000_000))


def split(df: DataFrame, percent: float, seed: int = 1, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """A sample of about so many percent, and the rest."""
    chosen = unit(seed, key) < int(percent * 10_000)
    return df.where(chosen), df.where(~chosen)


def shuffled(df: DataFrame, seed: int = 1, key: str = "id", per_file: int | None = None, name: str = "file_no") -> DataFrame:
    """Rows in a random order that the seed decides. per_file: they are numbered into files of at most so many."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    if per_file is None:
        return df.orderBy(h, key)
    return rechunk(df.withColumn("_h", h), per_file, ["_h", key], name=name).drop("_h")


def first_of_group(df: DataFrame, n: int, group: str, order: list[str]) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def unprocessed(batches: DataFrame, done: DataFrame, key: str = "batch") -> DataFrame:
    """Batches that the table of processed ones lacks."""
    return batches.join(done.select(key).distinct(), key, "left_anti")
