"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

The weighted terms of a text are its word shingles and their counts. For each of ``SAMPLES`` samples a term has two draws of
the gamma distribution of shape 2, r and c, and one uniform b, all hashed from the term and the sample alone. A term of
weight w falls to the step t = floor(ln w / r + b), to the weight y = exp(r (t - b)) below w, and to a = c / (y exp(r)). The
sample is the term of least a, with its t: it is the same in two texts with a chance equal to the generalised Jaccard
similarity of their weights (the sum of the lesser weights by that of the greater).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import broadcast_if_small, materialise, read_table

#: Words of a shingle; samples of a fingerprint.
WIDTH, SAMPLES = 5, 64
#: Samples that are drawn in one row, so that generated code stays small enough to be compiled.
BLOCK = 8
#: The least draw lies below this by the text's whole weight, but for a chance of exp(-24).
SURE = 24.0
#: Rows of a bucket of neighbouring ids, on average; ranges of ids that hold as many rows each, cut into buckets.
BUCKET_ROWS, RANGES, STRIDE = 128, 1024, 1 << 32
SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(tokens: Column, width: int = WIDTH) -> Column:
    """Hash of every run of ``width`` words, repeats included; of all words if they are fewer; empty without words."""
    n = F.size(tokens)
    one = lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), one)).otherwise(F.array().cast("array<bigint>"))


def draw(h: Column, w: Column, reach: Column, s: Column) -> Column:
    """The draw of a term in sample ``s`` as a number: ln a above, 16 bits of the hash of term, sample and step below.

    With u the product of the two uniforms of r, and v that of c, a is at least u (1 - v) / w. Logarithms are taken only
    if u (1 - v) is at most ``reach``. Other terms come after all of these, by hash.
    """
    x = F.xxhash64(h, s)
    z = F.xxhash64(x)
    uniform = lambda k: F.shiftrightunsigned(x, 16 * k).bitwiseAND(F.lit(65535)) + F.lit(0.5)
    u, v = [uniform(k) * uniform(k + 1) * F.lit(1 / float(1 << 32)) for k in (0, 2)]
    b = (F.shiftrightunsigned(z, 48) + F.lit(0.5)) * F.lit(1 / 65536)
    r, log_c = -F.ln(u), F.ln(-F.ln(v))
    t = F.floor(F.ln(w) / r + b)
    packed = lambda log_a, step: F.shiftleft(F.floor((log_a + 128.0) * float(1 << 39)), 16).bitwiseOR((z.bitwiseAND(F.lit(65535)) + step).bitwiseAND(F.lit(65535)))
    # a single occurrence falls to step 0
    found = F.when(w == 1.0, packed(log_c - r * (1.0 - b), F.lit(0))).otherwise(packed(log_c - r * (t - b + 1.0), t))
    return F.when(u * (1.0 - v) <= reach, found).otherwise(F.shiftrightunsigned(x, 2).bitwiseOR(F.lit(1 << 62)))


def least_draws(weighted: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys, block, least_0, least_1, ...: the least draws among a key's terms, ``BLOCK`` samples a row.

    ``weighted`` has the keys, ``h``, ``w`` and ``total``, the weight of all terms of the text. The least a of a text
    exceeds ``SURE`` by its total with a chance of exp(-SURE), 4e-11; only then is a sample drawn by hash.
    """
    reach = F.col("w") / F.col("total") * F.lit(SURE)
    blocks = weighted.select(*keys, "h", F.col("w").cast("double").alias("w"), reach.alias("reach"), F.explode(F.array(*[F.lit(k) for k in range(0, samples, BLOCK)])).alias("block"))
    least = lambda k: F.min(draw(F.col("h"), F.col("w"), F.col("reach"), F.col("block") + k)).alias(f"least_{k}")
    return blocks.groupBy(*keys, "block").agg(*[least(k) for k in range(min(BLOCK, samples))])


def signed(draws: DataFrame, keys: list[str], marks: dict[str, str]) -> DataFrame:
    """keys and, for each name and column prefix of ``marks``, every sample's number (2 hex digits) and 16 bits of its winner (4), in order; null without terms."""
    code = lambda c, k: F.lpad(F.lower(F.hex((F.col("block") + k).cast("long") * 65536 + F.col(c).bitwiseAND(F.lit(65535)))), 6, "0")
    own = lambda prefix: [c for c in draws.columns if c.startswith(prefix)]
    block = lambda prefix: F.when(F.col(own(prefix)[0]).isNotNull(), F.array(*[code(c, k) for k, c in enumerate(own(prefix))]))
    all_of = lambda prefix: F.flatten(F.array_sort(F.collect_list(block(prefix))))
    return draws.groupBy(*keys).agg(*[F.when(F.count(own(prefix)[0]) > 0, all_of(prefix)).alias(name) for name, prefix in marks.items()])


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys, signature (``signed``). ``terms`` has the keys and ``h``, one row for each occurrence of a term."""
    weighted = terms.groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("w")).withColumn("total", F.sum("w").over(Window.partitionBy(*keys)))
    return signed(least_draws(weighted, keys, samples), keys, {"signature": "least_"})


def paired_signatures(terms: DataFrame, keys: list[str]) -> DataFrame:
    """keys, mark, edited_mark: the signatures of a text and of its edit; null without terms.

    ``terms`` has the keys, ``edit`` (0 or 1), ``total`` (occurrences in that text) and ``h``. Terms that both hold with
    the same weight are drawn once for both.
    """
    of = lambda e, c: F.coalesce(F.max(F.when(F.col("edit") == e, F.col(c))), F.lit(0)).cast("long")
    counted = terms.groupBy(*keys, "h").agg(*[F.count_if(F.col("edit") == e).alias(f"w{e}") for e in (0, 1)], *[of(e, "total").alias(f"n{e}") for e in (0, 1)])
    row = lambda part, w, n: F.struct(F.lit(part).alias("part"), w.alias("w"), n.alias("total"))
    w0, w1, n0, n1 = [F.col(c) for c in ("w0", "w1", "n0", "n1")]
    apart = F.when(w1 == 0, F.array(row(0, w0, n0))).when(w0 == 0, F.array(row(1, w1, n1))).otherwise(F.array(row(0, w0, n0), row(1, w1, n1)))
    parts = counted.select(*keys, "h", F.explode(F.when(w0 == w1, F.array(row(2, w0, F.least(n0, n1)))).otherwise(apart)).alias("p")).select(*keys, "h", "p.*")
    drawn = least_draws(parts, [*keys, "part"])
    least = lambda e, k: F.min(F.when(F.col("part") != 1 - e, F.col(f"least_{k}"))).alias(f"of_{e}_{k}")
    texts = drawn.groupBy(*keys, "block").agg(*[least(e, k) for e in (0, 1) for k in range(BLOCK)])
    return signed(texts, keys, {"mark": "of_0_", "edited_mark": "of_1_"})


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that drew the same; 0 if only one text has terms, 1 if neither has."""
    used = lambda s: F.transform(s, lambda c: F.substring(c, 1, 2))
    both = F.size(F.array_union(used(a), used(b)))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both).cast("double")


def dealt_to_buckets(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``range``, ``bucket`` and ``h``: buckets rise with doc_id, and within one id fall with h, a hash of the text.

    Ranges hold as many rows each, by quantiles, whatever the ids are; a range is cut into buckets of equal width. The rows
    of an id that fills ranges alone, and those without an id, are dealt by h.
    """
    n, nulls, most = docs.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.max("doc_id")).first()
    ranges = max(1, min(RANGES, math.ceil((n - nulls) / BUCKET_ROWS)))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(ranges)], 10_000)).first()[0] or [0]
    bounds = sorted(set(cuts))
    parts = max(1, math.ceil((n - nulls) / ranges / BUCKET_ROWS))
    heavy = [parts * m if (m := cuts.count(x)) > 1 else 0 for x in bounds]
    widths = [float(y - x) for x, y in zip(bounds, [*bounds[1:], max(most or 0, bounds[-1]) + 1])]
    array = lambda values, kind: F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    step = lambda at, add: F.when((at + add < len(bounds)) & (F.get(array(bounds, "bigint"), at + add) <= F.col("doc_id")), at + add).otherwise(at)
    halves = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    found = F.when(F.col("doc_id").isNull(), -1).otherwise(F.aggregate(array(halves, "int"), F.lit(0), step))
    own = docs.withColumns({"range": found, "h": F.xxhash64("text")})
    far = F.col("doc_id") - F.get(array(bounds, "bigint"), F.col("range"))
    alone = F.get(array(heavy, "bigint"), F.col("range"))
    by_hash = lambda many: many - 1 - F.least(F.floor((F.col("h") / float(1 << 64) + 0.5) * many), many - 1)
    place = F.least(F.floor(far / F.get(array(widths, "double"), F.col("range")) * parts), F.lit(parts - 1).cast("long"))
    sub = F.when(F.col("doc_id").isNull(), by_hash(F.lit(max(1, math.ceil(nulls / BUCKET_ROWS))).cast("long"))).when((alone > 0) & (far == 0), by_hash(alone)).otherwise(alone + place)
    return own.withColumn("bucket", F.col("range").cast("long") * STRIDE + sub.cast("long"))


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows dealt to buckets, with ``guest`` rows: each bucket's last row is followed by the next lower one's first.

    The first rows of buckets are joined to the bucket above: within its range, or by the first of each range, RANGES + 1
    rows; the highest goes to the lowest bucket.
    """
    dealt = dealt_to_buckets(docs)
    # bitwise not turns the order round without an overflow
    head = F.min(F.struct(F.bitwise_not("doc_id").alias("id"), "h"))
    heads = materialise(dealt.groupBy("range", "bucket").agg(head.alias("head")), "heads")
    lows = heads.groupBy("range").agg(F.min("bucket").alias("low"))
    firsts = lows.select("range", F.coalesce(F.lead("low").over(Window.orderBy("range")), F.min("low").over(Window.partitionBy())).alias("next_low"))
    above = F.coalesce(F.lead("bucket").over(Window.partitionBy("range").orderBy("bucket")), F.col("next_low"))
    to = heads.join(F.broadcast(firsts), "range").select(F.col("bucket").alias("from"), F.bitwise_not("head.id").alias("head_id"), F.col("head.h").alias("head_h"), above.alias("to"))
    to = broadcast_if_small(materialise(to, "above"))
    guests = dealt.join(to, (dealt.bucket == to["from"]) & dealt.doc_id.eqNullSafe(to["head_id"]) & (dealt.h == to["head_h"]))
    own = dealt.select("bucket", F.lit(0).alias("guest"), "doc_id", "h", "text")
    return own.unionByName(guests.select(F.col("to").alias("bucket"), F.lit(1).alias("guest"), "doc_id", "h", "text"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256 and the fingerprints of every text and of its edit with the next document's text.

    The next document has the next smaller doc_id; rows of one doc_id follow each other by a hash of the text, a null
    doc_id comes last, and the first row follows the last. A null text counts as empty; an empty text has an empty fingerprint.
    Repeated rows each have their row. An empty table gives an empty result.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, key = neighbours(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))), ["bucket", "place"]
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "h", "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("following"), F.lit(1), half))
    placed = (
        rows.repartition(parts, "bucket")
        .withColumn("place", F.row_number().over(order))
        .withColumn("following", F.coalesce(F.lead("text").over(order), F.lit("")))
        .select(*key, "guest", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    )
    tokens = lambda c: F.array_remove(F.split(c, SPACE), "")
    both = placed.select(*key, F.explode(F.array(F.struct(F.lit(0).alias("edit"), F.col("text").alias("t")), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("t")))).alias("v"))
    split = both.select(*key, "v.edit", tokens(F.col("v.t")).alias("tokens"))
    total = F.greatest(F.size("tokens") - WIDTH + 1, F.lit(1))
    marks = paired_signatures(split.select(*key, "edit", total.alias("total"), F.explode(shingle_hashes(F.col("tokens"))).alias("h")), key)
    none = F.array().cast("array<string>")
    # Written first, so that the texts' shuffle is dropped before the terms' pass shuffles them again.
    facts = materialise(placed.select(*key, "guest", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256")), "edits")
    joined = facts.join(marks, key, "left").withColumns({c: F.coalesce(c, none) for c in ("mark", "edited_mark")})
    after = joined.withColumn("next_mark", F.coalesce(F.lead("mark").over(Window.partitionBy("bucket").orderBy("place")), none))
    return after.where("guest = 0").select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("mark", "").alias("fingerprint"), F.array_join("edited_mark", "").alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"), likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edit, and how near they are to it and to the next document."""
    return edited_fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text"))
