"""Mix the documents of several sources to target weights, by words.

Every document gets a hash-random key. The documents of a source are sorted in ranges of the key, prefix sums of their
words run along that order over all ranges, and the source is cut at its exact budget: whole epochs of the source count
for every document, and the last, partial epoch takes the documents before the cut and of the one at the cut the words
that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import settle
from feedloom.operators.keyed import enumerate_positions

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its own words.
EPOCHS = 3
#: Rows of a source in one range of the key.
ROWS_PER_RANGE = 10_000

# Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: str) -> Column:
    """A key that depends on a document's id and size alone, so rows that share it are alike and reruns agree."""
    parts = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def targets(sources: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Rows (source, source_size, target) of sources (source, source_size).

    Sources take `weights` by turns in code point order of their names, null last, and share the words of all in
    proportion. A target above `epochs` times its source stops there, and what is too much is shared anew among the
    others, until none is above. Each round looks at one sum over the sources, so any number of them may take part.
    """
    placed = enumerate_positions(sources, [], [F.asc_nulls_last("source")], name="_place")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    live = settle(placed.select("source", "source_size", weight.cast("long").alias("_weight")), "mix-sources")
    most = F.col("source_size") * epochs
    total = live.agg(F.sum("source_size")).first()[0] or 0
    rest, share, capped = total, None, -1
    while True:
        above = F.lit(False) if share is None else most.cast("double") <= share
        sums = live.agg(
            F.sum(F.when(above, most)).alias("most"), F.sum(F.when(~above, F.col("_weight"))).alias("weight"), F.count_if(above).alias("n")
        ).first()
        rest, open_weight = total - (sums["most"] or 0), sums["weight"] or 0
        if sums["n"] == capped or not open_weight:
            break
        capped = sums["n"]
        share = F.col("_weight") * F.lit(rest).cast("double") / F.lit(open_weight).cast("double")
    target = most.cast("double") if share is None else F.least(most.cast("double"), share)
    return live.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    seed: str = "mix",
    epochs: int = EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken), one per row of `docs` (doc_id, source, text).

    `size` counts the words of the whole text, none in a null or empty one; `taken` is how many the mix takes, repeats
    counted: floor(target) over each source, to the word, and at most `epochs` times the size of each document. A null
    source is a source. Rows that share id and size share their place in the order and are interchangeable, so results do not depend
    on partitions. An empty table, or one without words, gives no words. Other columns are not read.

    A source of any size is spread over ranges of the key; only one row per source and range is summed up along it.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    sized = settle(sized.withColumn("_key", random_key(seed)), "mix-sizes")
    ranges = max(1, math.ceil(sized.count() / rows_per_range))
    fraction = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * ranges
    # A source is a group also where it is null.
    ranged = sized.withColumn("_range", F.shiftright(fraction, 32).cast("int")).withColumn("_source", F.struct("source"))
    counts = settle(ranged.groupBy("_source", "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    sources = counts.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    goal = targets(sources.select("_source.source", "source_size"), epochs, weights)
    goal = goal.select(F.struct("source").alias("_source"), "source_size", "target")
    along = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_source", "_range", F.coalesce(F.sum("_words").over(along), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_source", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0)
    left = F.col("_budget") - F.col("_epochs") * F.col("source_size") - F.col("_before") - F.col("_within")
    taken = F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return (
        placed.join(before.join(goal, "_source"), ["_source", "_range"])
        .withColumn("_budget", budget.cast("long"))
        .withColumn("_epochs", whole.cast("long"))
        .select("doc_id", F.col("_source.source").alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"))
    )


#: The same mix: the sources in order of words per weight, the first of them capped, as many as have to be.
ORACLE = """WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
      CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY source),
    o AS (SELECT *, 3 * source_size / w AS ratio, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k FROM s),
    l AS (SELECT k, ratio, CAST((SELECT sum(source_size) FROM s) - (sum(3 * source_size) OVER below - 3 * source_size) AS DOUBLE) AS rest,
      CAST((SELECT sum(w) FROM s) - (sum(w) OVER below - w) AS DOUBLE) AS open_w FROM o WINDOW below AS (ORDER BY k)),
    cut AS (SELECT rest, open_w FROM l WHERE rest / open_w <= ratio ORDER BY k LIMIT 1),
    t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * rest / open_w) AS target FROM s, cut),
    b AS (SELECT source, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
      CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
    p AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size)
      ROWS UNBOUNDED PRECEDING) - size AS ahead FROM d)
    SELECT doc_id, size, source_size, target,
      CAST(epochs * size + greatest(0, least(budget - epochs * source_size - ahead, size)) AS BIGINT) AS taken
    FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source"""
