"""Operator 2: mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, checkpointed, fresh, hash_id

#: Name under which documents without a source are counted.
NO_SOURCE = ""


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, max_epochs: float = 4.0, budget: float | None = None, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Repetitions of every source: ``source, chars, weight, target_chars, clamped, rate``.

    The budget (characters, by default as many as there are) is shared out by weight (equal ones by
    default). A source whose share is above ``max_epochs`` times its size is clamped to that, and the
    excess goes to the others in proportion to their weights, until no share is above its clamp. As the
    clamp divided by the weight orders the sources, the clamped ones are a prefix of that order, so a
    running sum finds the fixed point without a loop: source i is clamped if, with all before it clamped,
    its share of the rest is above its own clamp. When all are clamped, the budget isn't used up.

    Sources with weight 0 or, where weights are given, without one get rate 0. A null source counts as
    the source ``''``; null texts have 0 characters. A source without characters has rate ``max_epochs``
    if its weight is above 0.
    """
    src = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(NO_SOURCE))
    sizes = docs.groupBy(src.alias("source")).agg(F.coalesce(F.sum(F.length(F.col(f"`{text_col}`")).cast("long")), F.lit(0)).cast("long").alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        if any(not w >= 0 for w in weights.values()):
            raise ValueError("weights must be 0 or more")
        given = docs.sparkSession.createDataFrame([(NO_SOURCE if k is None else k, float(v)) for k, v in weights.items()] or [("", 0.0)], "source string, weight double").groupBy("source").agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(given, "source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    cap = F.lit(float(max_epochs)) * F.col("chars")
    everything = Window.partitionBy(F.lit(0))  # one row for each source
    order = everything.orderBy(F.when(F.col("weight") > 0, cap / F.col("weight")), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("chars").over(everything).cast("double") if budget is None else F.lit(float(budget))
    active = sizes.where("weight > 0").withColumn("rest", total - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
    if budget is None:  # sources of weight 0 count in the size of the whole
        active = sizes.withColumn("all_chars", F.sum("chars").over(everything).cast("double")).where("weight > 0").withColumn("rest", F.col("all_chars") - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
    active = active.withColumn("level", F.col("rest") / F.sum("weight").over(after)).withColumn("clamped", F.col("level") * F.col("weight") >= cap)
    # the first source that isn't clamped sets the level for itself and all after it
    level = F.min(F.when(~F.col("clamped"), F.struct(cap / F.col("weight"), F.col("source"), F.col("level")))).over(everything)
    active = active.withColumn("level", level["level"])
    target = F.when(F.col("clamped"), cap).otherwise(F.col("level") * F.col("weight"))
    active = active.select("source", "chars", "weight", target.alias("target_chars"), "clamped")
    rate = F.when(F.col("chars") > 0, F.col("target_chars") / F.col("chars")).otherwise(F.lit(float(max_epochs)))
    zero = sizes.where("weight <= 0").select("source", "chars", "weight", F.lit(0.0).alias("target_chars"), F.lit(False).alias("clamped"), F.lit(0.0).alias("rate"))
    return active.withColumn("rate", F.least(rate, F.lit(float(max_epochs)))).unionByName(zero)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, max_epochs: float = 4.0, budget: float | None = None, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", epoch_col: str | None = "epoch") -> DataFrame:
    """The documents, each repeated as often as its source's rate says, with the repetition's number from 0.

    A rate of 2.3 gives every document twice, and a third time those whose seeded hash of the id is under
    0.3; the same seed and id give the same choice, wherever the row is. ``epoch_col=None`` leaves the
    number out, and a clash with a column of docs gives it another name (``epoch_``).

    The rates are one row for each source; they are broadcast up to ``BROADCAST_ROWS`` sources and joined
    by shuffle beyond. Documents aren't shuffled in the first case.

    Nulls: a null source is the source ``''``; a null id counts as the id ``''`` in the hash; a null text
    stays null. Repeated rows are each taken by themselves (with the same choice). Empty tables give an
    empty result; other columns stay as they are.
    """
    rates = checkpointed(source_rates(docs, weights, max_epochs, budget, source_col, text_col), "rates").select("source", "rate")
    s, r, e = fresh(docs, "mix_source", "mix_rate", "epoch" if epoch_col is None else epoch_col)
    rates = rates.select(F.col("source").alias(s), F.col("rate").alias(r))
    if rates.count() <= BROADCAST_ROWS:
        rates = F.broadcast(rates)
    key = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(NO_SOURCE))
    joined = docs.join(rates, key == F.col(s))
    whole = F.floor(F.col(r)).cast("int")
    drawn = F.coalesce(hash_id(f"`{id_col}`", seed), hash_id_of_null(seed))
    n = whole + (drawn < F.col(r) - whole).cast("int")
    out = joined.where(n > 0).select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(0), n - 1)).alias(e))
    return out if epoch_col is not None else out.drop(e)


def hash_id_of_null(seed: int):
    h = F.md5(F.lit(f"{seed}:").cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def mix_sql(columns: str, relation: str = "documents", max_epochs: float = 4.0, seed: int = 17) -> str:
    """DuckDB SQL for :func:`mix` with equal weights and the default budget."""
    return f"""
WITH sizes AS (SELECT coalesce(source, '') AS s, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars, 1.0::DOUBLE AS weight FROM {relation} GROUP BY 1),
a AS (SELECT *, {max_epochs}::DOUBLE * chars AS cap, CAST(sum(chars) OVER () AS DOUBLE) AS total FROM sizes),
b AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM a),
c AS (SELECT *, level * weight >= cap AS clamped FROM b),
d AS (SELECT *, (SELECT arg_min(level, (cap / weight, s)) FROM c WHERE NOT clamped) AS final FROM c),
rates AS (SELECT s, least(CASE WHEN chars > 0 THEN (CASE WHEN clamped THEN cap ELSE final * weight END) / chars ELSE {max_epochs} END, {max_epochs}::DOUBLE) AS rate FROM d),
n AS (SELECT x.*, CAST(floor(rate) AS INTEGER) + CASE WHEN CAST(('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END AS reps
  FROM {relation} x JOIN rates ON coalesce(source, '') = s)
SELECT {columns}, CAST(epoch AS INTEGER) AS epoch FROM (SELECT n.*, unnest(generate_series(0, reps - 1)) AS epoch FROM n WHERE reps > 0)
"""
