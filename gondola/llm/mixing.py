"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within its source the documents stand in the order of their keys; a document is taken as far as the
words before it leave of its source's budget, and a budget beyond the source's size repeats the source whole first (an epoch each).

The prefix sums are distributed: the leading bits of the key cut a source into about sqrt(rows) ranges of equal width, so a running sum
over the rows of a range and one over the ranges of a source both touch at most about sqrt(rows) rows, also in a source that holds a third
of all. What passes through a single task has one row for each source.

Cases: null text or a text of white space has no words and takes none; a null source is a source of its own; rows with equal id and equal
size share a key and are interchangeable, the cut falls on one of them; null ids share one key; an empty table gives an empty mix; other columns
may have any name, for those kept are renamed while the mix is made.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import stage

#: Bits of a key: fifteen hexadecimal digits.
KEY_BITS = 60
#: Weights of the sources in the order of their code points, repeating.
CYCLE = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key(doc_id: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> Column:
    """A weight for each row of ``sources`` (one row a source) by its place in code-point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    return F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int"))


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``mix_target``: ``share`` of all words dealt out by ``mix_weight``, none above ``most`` times its source's ``mix_size``.

    Dealing the excess out again and again ends where every source below its limit gets the same words for a unit of weight. Sources that
    reach their limit come first in the order of limit by weight, so two running sums find them.
    """
    limit = F.lit(most) * F.col("mix_size")
    everything = Window.partitionBy()
    earlier = Window.orderBy(limit / F.col("mix_weight"), F.col("mix_source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = sources.withColumns(
        {
            "mix_limit": limit,
            "mix_all": F.lit(share) * F.sum("mix_size").over(everything),
            "mix_weights": F.sum("mix_weight").over(everything),
            "mix_limits_before": F.coalesce(F.sum(limit).over(earlier), F.lit(0.0)),
            "mix_weights_before": F.coalesce(F.sum("mix_weight").over(earlier), F.lit(0)),
        }
    )
    full = (F.col("mix_all") - F.col("mix_limits_before")) * F.col("mix_weight") >= F.col("mix_limit") * (
        F.col("mix_weights") - F.col("mix_weights_before")
    )
    rows = rows.withColumn("mix_full", full)
    left = F.col("mix_all") - F.sum(F.when(F.col("mix_full"), F.col("mix_limit")).otherwise(0.0)).over(everything)
    open_weights = F.sum(F.when(F.col("mix_full"), 0).otherwise(F.col("mix_weight"))).over(everything)
    target = F.when(F.col("mix_full"), F.col("mix_limit")).otherwise(F.col("mix_weight") * left / open_weights)
    return rows.withColumn("mix_target", target).select("mix_null", "mix_text", "mix_size", "mix_target")


def mix(docs: DataFrame, keep: list[str], share: float = 1.5, most: float = 2.0, weights: DataFrame | None = None, seed: str = "mix") -> DataFrame:
    """The columns ``keep`` of every document, with ``size``, ``source_size``, ``target`` and ``taken``; the document at the border is cut to the word.

    ``weights`` has ``source`` and a positive ``weight``; sources without a row there weigh nothing and get nothing. Without it the weights
    are those of ``cycle_weights``.
    """
    rows = _mixed(docs, keep, share, most, weights, seed)
    taken = F.col("mix_epochs") * F.col("mix_words") + F.greatest(F.lit(0), F.least("mix_words", F.col("mix_rest") - F.col("mix_start")))
    return rows.select(
        *[F.col(f"mix_keep_{c}").alias(c) for c in keep],
        F.col("mix_words").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.coalesce("mix_target", F.lit(0.0)).alias("target"),
        taken.cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: DataFrame | None = None, seed: str = "mix") -> DataFrame:
    """The rows of the mix, whole documents with the columns of ``docs``: a row for each time a document is taken.

    The document at the border is taken if half of it or more fits. Documents without words are not taken.
    """
    rows = _mixed(docs, docs.columns, share, most, weights, seed)
    last = (F.col("mix_rest") > 0) & (2 * F.col("mix_start") + F.col("mix_words") <= 2 * F.col("mix_rest"))
    times = F.when(F.col("mix_words") > 0, F.col("mix_epochs") + last.cast("int")).otherwise(0).cast("int")
    rows = rows.where(times > 0).withColumn("mix_time", F.explode(F.sequence(F.lit(1), times)))
    return rows.select(*[F.col(f"mix_keep_{c}").alias(c) for c in docs.columns])


def _mixed(docs: DataFrame, keep: list[str], share: float, most: float, weights: DataFrame | None, seed: str) -> DataFrame:
    rows = docs.select(
        *[F.col(c).alias(f"mix_keep_{c}") for c in keep],
        F.col("source").isNull().alias("mix_null"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_text"),
        F.col("doc_id").alias("mix_id"),
        words(F.col("text")).alias("mix_words"),
        key(F.col("doc_id"), seed).alias("mix_key"),
    )
    rows = stage(rows, "mix")
    bits = math.ceil(math.log2(max(2, rows.count())) / 2)
    rows = rows.withColumn("mix_range", F.shiftright("mix_key", KEY_BITS - bits))
    place = ["mix_null", "mix_text"]
    ranges = rows.groupBy(*place, "mix_range").agg(F.sum("mix_words").alias("mix_words"))
    sources = ranges.groupBy(*place).agg(F.sum("mix_words").alias("mix_size"))
    sources = sources.withColumn("mix_source", F.when(~F.col("mix_null"), F.col("mix_text")))
    if weights is None:
        sources = sources.withColumn("mix_weight", cycle_weights(sources))
    else:
        given = weights.select(F.col("source").alias("mix_given"), F.col("weight").alias("mix_weight"))
        sources = sources.join(given, F.col("mix_source").eqNullSafe(F.col("mix_given"))).drop("mix_given")
    before = Window.partitionBy(*place).orderBy("mix_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumn("mix_range_before", F.sum("mix_words").over(before) - F.col("mix_words")).drop("mix_words")
    ranges = ranges.join(targets(sources, share, most), place, "left")
    inside = Window.partitionBy(*place, "mix_range").orderBy("mix_key", "mix_id", "mix_words").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("mix_inside", F.sum("mix_words").over(inside) - F.col("mix_words")).join(ranges, [*place, "mix_range"])
    budget = F.floor(F.coalesce("mix_target", F.lit(0.0))).cast("long")
    source_size = F.coalesce("mix_size", F.lit(0)).cast("long")
    epochs = F.when(source_size > 0, F.floor(budget / source_size)).otherwise(0).cast("long")
    rest = budget - epochs * source_size
    return rows.withColumns(
        {"mix_source_size": source_size, "mix_epochs": epochs, "mix_rest": rest, "mix_start": F.col("mix_range_before") + F.col("mix_inside")}
    )


ORACLE = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as place
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size,
         [3, 1, 2][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
  from sized group by source
), ordered as (
  select *, 2.0::double * source_size as most, 1.5::double * (select sum(source_size) from sources) as everything,
         (select sum(weight) from sources) as weights,
         coalesce(sum(2.0::double * source_size) over earlier, 0.0) as most_before, coalesce(sum(weight) over earlier, 0) as weight_before
  from sources
  window earlier as (order by 2.0::double * source_size / weight, source nulls first rows between unbounded preceding and 1 preceding)
), marked as (
  select *, (everything - most_before) * weight >= most * (weights - weight_before) as is_full from ordered
), rates as (
  select any_value(everything) - coalesce(sum(most) filter (is_full), 0.0) as remaining, sum(weight) filter (not is_full) as open_weights from marked
), aims as (
  select source, source_size, case when is_full then most else weight * remaining / open_weights end as target from marked, rates
), budgets as (
  select *, cast(floor(target) as bigint) as budget,
         case when source_size > 0 then cast(floor(target) as bigint) // source_size else 0 end as epochs from aims
), placed as (
  select d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size as rest,
         sum(d.size) over (partition by d.source order by d.place, d.doc_id, d.size rows between unbounded preceding and current row) - d.size as start_at
  from sized d join budgets b on d.source is not distinct from b.source
)
select doc_id, size, source_size, target, cast(epochs * size + greatest(0, least(size, rest - start_at)) as bigint) as taken from placed
"""
