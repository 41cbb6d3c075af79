"""Mixing sources to target shares of the total size.

Method: low-discrepancy source schedule. Every source's documents are put in a
pseudo-random order and laid end to end, once per repetition, and cut into
blocks of equal token count. The schedule is the van der Corput sequence in
base 2: its points, mapped through the cumulative weights of the sources (their
blocks), say which source comes next; the k-th slot of a source takes its k-th
block. Weights are whole numbers of blocks, so every source gets exactly as
many slots as it has blocks, and any stretch of the mix is close to the target
shares.

All running sums are two-level (within buckets of bounded size, then over the
buckets' totals), so a source with a third of all rows is spread like any
other. Neither sources nor documents reach the driver.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 8192
SENT_SOURCES = 10_000  # rows of the plan up to which it is broadcast; beyond, it is joined
CELLS = 1 << 12
_CHUNK_BITS = 16
_BUCKET_TOKENS = 1 << 20


@lru_cache(maxsize=4)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, key: str, source: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc, source, n_tokens) of every row; a null or empty text has 0 tokens. Whole texts are encoded.

    The vocabulary file is read here and sent to the tasks, which need no copy.
    """
    src = docs.select(F.col(key).alias("doc"), F.col(source).alias("source"), F.col(text).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in src.schema}
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # the size of a vocabulary

    def count(batches):
        encode = _encoding(sent.value).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc", "source", "n_tokens"])

    return src.mapInArrow(count, f"doc {kinds['doc']}, source {kinds['source']}, n_tokens bigint")


def plan(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, total, quota, reaches) of every targeted source.

    total is the token count of all documents, those without source or target
    included; quota is the share's tokens or what max_repeats allows, if less.
    A source without documents has 0 tokens. Of repeated targets the greatest
    values hold; null shares count as 0 and null repeats as 1.
    """
    have = counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).select("source", "tokens", F.lit(None).cast("double").alias("share"), F.lit(None).cast("int").alias("repeats"))
    want = targets.where(F.col("source").isNotNull()).select(
        "source", F.lit(0).cast("bigint").alias("tokens"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce(F.col("max_repeats").cast("int"), F.lit(1)).alias("repeats")
    )
    both = have.unionByName(want).groupBy("source").agg(F.sum("tokens").alias("tokens"), F.max("share").alias("share"), F.max("repeats").alias("repeats"))
    # one row per source by now
    all_of_it = both.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    reach = F.col("repeats") * F.col("tokens")
    goal = F.col("share") * F.col("total")
    return all_of_it.where(F.col("share").isNotNull()).select(
        "source",
        F.col("share").alias("target_share"),
        F.col("repeats").alias("max_repeats"),
        "tokens",
        "total",
        F.least(reach.cast("double"), goal).alias("quota"),
        (reach >= goal).alias("reaches"),
    )


def _laid_out(counts: DataFrame, plans: DataFrame, few: bool, seed: int) -> DataFrame:
    """Documents end to end per source and repetition: (source, doc, epoch, n_tokens, start), those within the quota."""
    per = plans.where((F.col("tokens") > 0) & (F.col("quota") > 0)).select(
        "source",
        "quota",
        F.ceil(F.col("quota") / F.col("tokens")).cast("int").alias("epochs"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / _BUCKET_TOKENS)).cast("bigint").alias("buckets"),
    )
    h = F.xxhash64("doc", "epoch", F.lit(seed))
    rows = (
        counts.join(F.broadcast(per) if few else per, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
        .withColumn("h", F.shiftrightunsigned(h, 1))
        .withColumn("bucket", F.col("h") % F.col("buckets"))
    )
    inner = Window.partitionBy("source", "epoch", "bucket").orderBy("h", "doc").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("source").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("source", "epoch", "bucket").agg(F.sum("n_tokens").alias("size"))
    before = sums.select("source", "epoch", "bucket", (F.sum("size").over(outer) - F.col("size")).alias("before"))
    return (
        rows.withColumn("within", F.sum("n_tokens").over(inner) - F.col("n_tokens"))
        .join(before, ["source", "epoch", "bucket"])
        .withColumn("start", F.col("before") + F.col("within"))
        .where(F.col("start") < F.col("quota"))
        .select("source", "doc", "epoch", "n_tokens", "start")
    )


def reversed_bits(c: Column, bits: int) -> Column:
    """The lowest `bits` bits of a number in reverse order: the van der Corput point of c, times 2^bits."""
    for step, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        m = F.lit(mask)
        c = F.shiftleft(c.bitwiseAND(m), step).bitwiseOR(F.shiftrightunsigned(c, step).bitwiseAND(m))
    return F.shiftrightunsigned(c, 64 - bits)


def schedule(spark, blocks: DataFrame, total: int) -> DataFrame:
    """(slot, source, block) for `blocks` (source, blocks), whose sum is `total`.

    Every source has the interval of its blocks in 0..total; slot i belongs to
    the source whose interval holds the i-th point. Points and intervals meet
    in cells of equal width, so each point is compared with the sources of one
    cell only.
    """
    bits = max(1, (total - 1).bit_length())
    width = max(1, total // CELLS)
    upto = F.sum("blocks").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, 0))
    ranges = blocks.select("source", (upto - F.col("blocks")).alias("lo"), upto.alias("hi"))
    cells = ranges.withColumn("cell", F.explode(F.sequence((F.col("lo") / width).cast("bigint"), ((F.col("hi") - 1) / width).cast("bigint"))))
    points = spark.range(1 << bits).select(F.col("id").alias("slot"), reversed_bits(F.col("id"), bits).alias("at"))
    points = points.where(F.col("at") < total).withColumn("cell", (F.col("at") / width).cast("bigint"))
    drawn = points.join(cells, "cell").where("at >= lo AND at < hi").select("slot", "source", F.shiftright("slot", _CHUNK_BITS).alias("chunk"))
    inner = Window.partitionBy("chunk", "source").orderBy("slot")
    outer = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    per = drawn.groupBy("chunk", "source").agg(F.count("*").alias("k"))
    before = per.select("chunk", "source", (F.sum("k").over(outer) - F.col("k")).alias("before"))
    ranked = drawn.withColumn("rank", F.row_number().over(inner) - 1).join(before, ["chunk", "source"])
    return ranked.select("slot", "source", (F.col("before") + F.col("rank")).alias("block"))


def mix(counts: DataFrame, targets: DataFrame, block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mix (slot, source, block, doc, epoch, n_tokens, start) and the plan it follows.

    Rows ordered by (slot, start) are the mix. No document appears more than
    max_repeats times; a source's tokens are its quota, over by less than one
    document. Sources without a target give nothing. Repeated rows are
    documents of their own.
    """
    spark = counts.sparkSession
    counts = materialise(counts)
    plans = materialise(plan(counts, targets))
    blocks = plans.where((F.col("tokens") > 0) & (F.col("quota") > 0)).select("source", F.ceil(F.col("quota") / block).cast("bigint").alias("blocks"))
    size = blocks.agg(F.count("*").alias("n"), F.coalesce(F.sum("blocks"), F.lit(0)).alias("total")).first()
    laid = _laid_out(counts, plans, size["n"] <= SENT_SOURCES, seed).withColumn("block", F.floor(F.col("start") / block).cast("bigint"))
    if not size["total"]:
        return laid.select(F.lit(0).cast("bigint").alias("slot"), "source", "block", "doc", "epoch", "n_tokens", "start"), plans
    out = laid.join(schedule(spark, blocks, size["total"]), ["source", "block"])
    return out.select("slot", "source", "block", "doc", "epoch", "n_tokens", "start"), plans


def report(mixed: DataFrame, plans: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, mixed_tokens, actual_share, share_of_total, reaches).

    actual_share is of the mix; share_of_total is of the token count of all
    documents, which is what target_share refers to; reaches is whether what
    was drawn makes up the target share.
    """
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"))
    both = plans.join(got, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    total = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0)))
    return both.select(
        "source",
        "target_share",
        "max_repeats",
        "tokens",
        "mixed_tokens",
        F.when(total > 0, F.col("mixed_tokens") / total).otherwise(0.0).alias("actual_share"),
        F.when(F.col("total") > 0, F.col("mixed_tokens") / F.col("total")).otherwise(0.0).alias("share_of_total"),
        (F.col("mixed_tokens") >= F.col("target_share") * F.col("total")).alias("reaches"),
    )
