"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; its rows are then copied ``target / size of the source`` times each on
average. The whole part of that rate is fixed; the fractional parts are rounded by the pivotal method: two rows
exchange mass (probability times words) at random until one of them is whole, the other goes on to meet the next row.
Both the expected copies of every row and the words of every source are kept by each exchange.

Groups are bounded: rows that are alike in every column are one entry, entries of a source are dealt by hash into buckets
of about ``LEAF_ROWS``, each bucket leaves at most one that is not whole, and these residuals meet in a reduction tree of
``FAN_IN`` buckets a step. Only hashes and numbers go through the buckets; texts are joined to the outcome.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.llm.common import broadcast_if_small, fresh_names, materialise, read_table, words

#: Weights of the sources in order, repeating; the mix's words over all words; the most copies of a row.
WEIGHTS, BUDGET, MOST_COPIES = (5.0, 2.0, 1.0), 1.5, 2.0
LEAF_ROWS, FAN_IN = 2_000, 64
#: Copies of a row made in one step.
STRIDE = 1_000
ADDED = ("h", "g", "m", "size", "source_size", "target", "total")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = MOST_COPIES) -> DataFrame:
    """Target words of each source by weight, none above ``cap`` times its size.

    ``sizes`` has one row per source: source (nullable), source_size, n_docs. The excess over a cap is shared among the
    others by weight until none is above. In closed form: with the sources in order of cap over weight, the capped ones
    are a prefix, and the rest share what the prefix leaves. Adds target and source_no (0-based, null source last).
    An empty source has target 0. The windows hold one row per source, not the corpus.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("_ratio", "source_no")
    everything = Window.partitionBy()
    no = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(cap))
    df = (
        sizes.withColumn("source_no", no.cast("long"))
        .withColumn("_weight", weight)
        .withColumn("_cap", limit)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_weight_left", F.sum("_weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("_share", (F.col("_total") - F.col("_cap_before")) / F.col("_weight_left"))
        .withColumn("_capped", F.col("_share") * F.col("_weight") >= F.col("_cap"))
        .withColumn("_rate", F.min(F.when(~F.col("_capped"), F.struct("_ratio", "source_no", "_share"))).over(everything)["_share"])
    )
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_rate") * F.col("_weight")))
    return df.withColumn("target", target.cast("double")).drop("_weight", "_cap", "_ratio", "_cap_before", "_weight_left", "_total", "_share", "_capped", "_rate")


def pivot(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round ``p`` so that all but at most one entry are 0 or 1 and the sum of ``p * size`` stays the same."""
    p = p.copy()
    u = rng.random(len(p))
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        mass, other, full, room = p[at] * size[at], p[j] * size[j], float(size[at]), float(size[j])
        up, down = min(full - mass, other), min(mass, room - other)
        if u[j] * (up + down) < down:
            mass, other, to_one, from_zero = mass + up, other - up, up == full - mass, up == other
            p[at], p[j] = (1.0 if to_one else mass / full), (0.0 if from_zero else other / room)
        else:
            to_zero, from_one = down == mass, down == room - other
            p[at], p[j] = (0.0 if to_zero else (mass - down) / full), (1.0 if from_one else (other + down) / room)
        p[at], p[j] = (_whole(p[at]), _whole(p[j]))
        at = at if 0.0 < p[at] < 1.0 else (j if 0.0 < p[j] < 1.0 else -1)
    return p


def _whole(p: float) -> float:
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


def _pivot_tables(seed: int, level: int, last: bool):
    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("g", "ascending")])
        rng = np.random.default_rng([seed, level, key[0].as_py(), key[1].as_py()])
        size, p = table["size"].to_numpy(), table["p"].to_numpy()
        p = pivot(size, p, rng)
        if last:
            p = np.where((p > 0) & (p < 1), (rng.random(len(p)) < p).astype(float), p)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return one


def class_copies(rows: DataFrame, seed: int, leaf_rows: int, **targets) -> DataFrame:
    """h, g, m, size, source_size, target, total: of all rows alike in h and g, m in number, how often they are taken together.

    ``rows`` has h, g (the hashes that say which rows are alike), source and size, and should be written. Of m rows alike
    at a rate r, floor(m * r) copies are certain; only what is left over goes through the pivot, as one row.
    """
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    table = materialise(source_targets(per_source, **targets), "mix-sources")
    largest = table.agg(F.max("n_docs")).first()[0] or 0
    small = broadcast_if_small(table.withColumnRenamed("source", "of"))
    rate = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    classes = rows.groupBy("source", "h", "g").agg(F.min("size").alias("size"), F.count(F.lit(1)).alias("m"))
    entries = (
        classes.join(small, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("mass", F.col("m") * rate)
        .withColumn("sure", F.floor(F.col("mass") + 1e-9).cast("long"))
        .select(F.col("source_no").alias("no"), F.pmod("h", F.ceil(F.col("n_docs") / leaf_rows)).alias("bucket"), "h", "g", "m", "size", "source_size", "target", "sure", F.greatest(F.col("mass") - F.col("sure"), F.lit(0.0)).alias("p"))
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in entries.schema])
    leaves = materialise(entries.groupBy("no", "bucket").applyInArrow(_pivot_tables(seed, 0, largest <= leaf_rows), schema), "mix-leaves")
    buckets, level = math.ceil(largest / leaf_rows), 0
    whole = F.col("p").isin(0.0, 1.0)
    done, left = [leaves.where(whole)], leaves.where(~whole)
    while buckets > 1:
        level, buckets = level + 1, math.ceil(buckets / FAN_IN)
        left = left.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
        left = materialise(left.groupBy("no", "bucket").applyInArrow(_pivot_tables(seed, level, buckets == 1), schema), "mix-residuals")
        done, left = [*done, left.where(whole)], left.where(~whole)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("h", "g", "m", "size", "source_size", "target", (F.col("sure") + F.col("p").cast("long")).alias("total"))


def _rounded(docs: DataFrame, size: Column, source: str, seed: int, leaf_rows: int, **targets) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with one row for all rows that are alike in every column, and what ``class_copies`` says of them, under the names given."""
    names = dict(zip(ADDED, fresh_names(docs, *ADDED)))
    plain = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    # A null is skipped by the hash, so that each value's being null is hashed too.
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in docs.columns])
    marked = docs.withColumns({names["h"]: F.xxhash64(F.lit(seed), nulls, *plain), names["g"]: F.xxhash64(F.lit(~seed), nulls, *plain)})
    rows = marked.select(F.col(names["h"]).alias("h"), F.col(names["g"]).alias("g"), F.col(f"`{source}`").alias("source"), size.cast("long").alias("size"))
    found = class_copies(materialise(rows, "mix-rows"), seed, leaf_rows, **targets)
    found = materialise(found.select(*[F.col(c).alias(names[c]) for c in ADDED]), "mix-copies")
    joined = marked.join(broadcast_if_small(found), [names["h"], names["g"]])
    out = joined.where(F.col(names["m"]) == 1)
    if found.where(F.col(names["m"]) > 1).limit(1).count():
        out = out.unionByName(joined.where(F.col(names["m"]) > 1).dropDuplicates([names["h"], names["g"]]))
    return out, names


def _times(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Every row n times, with its number from 1, by two short steps."""
    step = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), of - 1))
    far = df.where(n > 0).withColumn(name, step(F.ceil(n / STRIDE).cast("long")))
    near = F.least(F.lit(STRIDE).cast("long"), n - F.col(name) * STRIDE)
    return far.withColumn(name, F.explode(F.transform(F.sequence(F.lit(1).cast("long"), near), lambda i: F.col(name) * STRIDE + i)))


def mix(docs: DataFrame, size: Column, source: str = "source", seed: int = 7, leaf_rows: int = LEAF_ROWS, **targets) -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_source_size``, ``_mix_target`` and ``_mix_copies``, the times a row is taken.

    Rows that are alike in every column share what they are taken together, evenly. Rows without words are not taken;
    a null source is a source of its own; a null id is a value like any other. An empty table gives an empty result.
    Rounding draws depend on the seed, the source and a hash of the row only, so that reruns agree. Columns of ``docs``
    that have these four names are replaced.
    """
    made = ["_mix_size", "_mix_source_size", "_mix_target", "_mix_copies"]
    kept = [c for c in docs.columns if c not in made]
    rows, names = _rounded(docs, size, source, seed, leaf_rows, **targets)
    nth = fresh_names(rows, "nth")[0]
    each = _times(rows, F.col(names["m"]), nth)
    total, m = F.col(names["total"]), F.col(names["m"])
    base = F.floor(total / m).cast("long")
    copies = base + F.when(F.col(nth) <= total - base * m, 1).otherwise(0)
    added = [F.col(names["size"]), F.col(names["source_size"]), F.col(names["target"]), copies.cast("long")]
    return each.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for c, n in zip(added, made)])


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each, at 150 % of all words and weights 5, 2, 1."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("n_words"))
    return mix(sized, F.col("n_words")).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"), "source", F.col("_mix_copies").alias("copies"),
    )


def take(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """``docs``, all columns, each row as often as the mix of their sources takes it. Texts stay out of Python."""
    rows, names = _rounded(docs, words(F.col("text")), "source", seed, LEAF_ROWS, **targets)
    return _times(rows, F.col(names["total"]), fresh_names(rows, "nth")[0]).select(*[F.col(f"`{c}`") for c in docs.columns])
