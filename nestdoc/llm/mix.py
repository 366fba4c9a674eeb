"""Mixing sources to target weights by Pareto order sampling.

Sources share a number of words by weight; a source's target stops at `most` times its size and
the excess is shared anew. Each document of a source is due `target / size` times. The whole
part of that is certain: so many whole copies. The rest is an inclusion probability p, and the
documents are ranked by Pareto's variable: random odds u / (1 - u) over inclusion odds
p / (1 - p). The documents of the lowest ranks make the sample, which has a fixed size: as many
words as the source lacks. With `weight`, documents of one source are due in proportion to it
(no more than `most` times each), so that p differs from document to document; it is a column or
a function of the document's size, such as `by_length`.

The rank at which a source has enough is found by counting words in cells of rank, then in the
cells of the one where the sum crosses, and so on: every step is a sum over (source, cell), so
no task ever sees all documents of a source.

Defined results: a document's size is its words `[^\\x20\\x09-\\x0D]+`; null and empty texts
have size 0 and are taken 0 times; null sources are one source, which comes last; documents that
repeat (same id and text) draw the same number and come in or stay out together when they meet
at the border; a null weight is 0; an empty table gives an empty result. Reruns agree: the draw
depends on id, text and seed alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import free_name, n_words, pinned, quoted, release, sent, table, unit_hash

WEIGHTS = (1, 2, 3)
MOST = 3
#: Cells that a stretch of ranks is cut into at each step, and the steps.
CELLS = 1024
STEPS = 4


def by_length(size: Column) -> Column:
    """Longer documents are likelier: the binary logarithm of 1 + size."""
    return F.log2(1 + size)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) to the same with the target in words, a double.

    Water filling: with words T to share and weights w, a source is due w * T / W. Those that
    this takes over `most` sizes are fixed there, and the others share what is left, until none
    is over. Rows are numbered by one sorted pass over the sources, not over documents.
    """
    spark = sizes.sparkSession
    schema = T.StructType([*sizes.schema.fields, T.StructField("weight", T.LongType())])
    in_order = sizes.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    numbered = spark.createDataFrame(
        in_order.map(lambda x: (*x[0], weights[x[1] % len(weights)])), schema
    )
    shares = pinned(numbered)
    over = F.lit(False)
    while True:
        left = shares.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(over, most * F.col("source_size"))), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight"),
            F.sum(over.cast("long")).alias("n_over"),
        ).first()
        if not left["weight"]:
            break
        due = F.col("weight") * F.lit(float(left["all"] - left["fixed"])) / F.lit(float(left["weight"]))
        over = over | (due > most * F.col("source_size"))
        if shares.where(over).count() == left["n_over"]:
            break
    share = F.lit(0.0) if not left["weight"] else due
    return shares.select(
        "source", "source_size", F.when(over, (most * F.col("source_size")).cast("double")).otherwise(share).alias("target")
    )


def _per_word(ranked: DataFrame, most: int) -> DataFrame:
    """`due` copies in proportion to weight: source targets are met though none is due more than
    `most`. Each pass fixes the documents that are at `most` and rescales the others."""
    capped, last = F.lit(False), ranked
    while True:
        by_source = ranked.groupBy("source").agg(
            F.sum(F.when(capped, most * F.col("size")).otherwise(0)).alias("fixed"),
            F.sum(F.when(~capped, F.col("weight") * F.col("size")).otherwise(0.0)).alias("open"),
            F.sum(capped.cast("long")).alias("n_capped"),
        )
        scale = by_source.select(
            F.col("source").alias("s"), F.when(F.col("open") > 0, F.col("open")).alias("open"), "fixed", "n_capped"
        )
        joined = ranked.join(scale, F.col("source").eqNullSafe(F.col("s")), "left")
        due = F.when(capped, F.lit(float(most))).otherwise(
            F.coalesce((F.col("target") - F.col("fixed")) * F.col("weight") / F.col("open"), F.lit(0.0))
        )
        new = pinned(joined.select(*ranked.columns, F.least(due, F.lit(float(most))).alias("new_due"), capped.alias("was")))
        ranked = new.select(*[c for c in ranked.columns if c != "due"], F.col("new_due").alias("due"), "was")
        more = ranked.where(~F.col("was") & (F.col("due") >= most)).limit(1).count()
        release(last)
        last, ranked = ranked, ranked.drop("was")
        if not more:
            return ranked
        capped = F.col("due") >= most


def mix_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | Callable[[Column], Column] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: the `keep` columns, then size, source_size, target, copies and taken
    (words, copies counted) under these names, or with underscores in front where `keep` has them."""
    keep = [doc_id] if keep is None else keep
    names = {c: free_name(docs.select(*[quoted(k) for k in keep]), c) for c in ("size", "source_size", "target", "copies", "taken")}
    base = docs.select(
        F.struct(*[quoted(c) for c in keep]).alias("kept"),
        quoted(source).cast("string").alias("source"),
        n_words(quoted(text)).alias("size"),
        unit_hash(quoted(doc_id), quoted(text), F.lit(seed)).alias("u"),
        (quoted(weight).cast("double") if isinstance(weight, str) else F.lit(1.0)).alias("weight"),
    )
    if callable(weight):
        base = base.withColumn("weight", weight(F.col("size")).cast("double"))
    base = pinned(base.withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = pinned(source_targets(sizes, weights, most))
    targets = targets.withColumnRenamed("source", "s")
    ranked = base.join(sent(targets), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    if weight:
        ranked = _per_word(pinned(ranked.withColumn("due", F.lit(0.0))), most)
    else:
        ranked = ranked.withColumn("due", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    p = F.col("due") - F.floor("due")
    odds = F.try_divide(F.col("u") / (1 - F.col("u")), p / (1 - p))
    ranked = pinned(
        ranked.withColumn("whole", F.when(F.col("size") > 0, F.floor("due")).otherwise(0))
        # Pareto's rank on 0..1, which keeps the order: r / (1 + r)
        .withColumn("rank", F.when((F.col("size") > 0) & (p > 0), odds / (1 + odds)))
    )

    # Words lacking after the whole copies, and the stretch [low, low + width) of ranks where
    # the sum over the lowest ranks crosses them.
    border = ranked.groupBy("source").agg(
        (F.first("target", ignorenulls=True) - F.sum(F.col("whole") * F.col("size"))).alias("lack"),
        F.lit(0.0).alias("low"),
    )
    width = 1.0
    for _ in range(STEPS):
        width /= CELLS
        at = border.select(F.col("source").alias("s"), "lack", "low")
        cell = F.floor((F.col("rank") - F.col("low")) / F.lit(width))
        cells = (
            ranked.select("source", "rank", "size").where(F.col("rank").isNotNull())
            .join(sent(at), F.col("source").eqNullSafe(F.col("s")))
            .where((cell >= 0) & (cell < CELLS))
            .groupBy("source", "lack", "low", cell.alias("cell"))
            .agg(F.sum("size").alias("words"))
        )
        # At most CELLS rows of a source: fold them in order to the cell that crosses.
        steps = cells.groupBy("source", "lack", "low").agg(F.sort_array(F.collect_list(F.struct("cell", "words"))).alias("c"))
        start = F.struct(F.col("lack"), F.lit(CELLS).cast("long").alias("cell"))
        fold = F.aggregate(
            "c",
            start,
            lambda a, x: F.when((a["cell"] < CELLS) | (x["words"] > a["lack"]), F.struct(a["lack"], F.least(a["cell"], x["cell"]).alias("cell")))
            .otherwise(F.struct((a["lack"] - x["words"]).alias("lack"), a["cell"])),
        )
        found = steps.select("source", "low", fold.alias("f")).select(
            "source", F.col("f.lack").alias("lack"), (F.col("low") + F.col("f.cell") * F.lit(width)).alias("low")
        )
        old = border.select(F.col("source").alias("s"), F.col("lack").alias("lack0"), F.col("low").alias("low0"))
        border = pinned(
            old.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
                F.col("s").alias("source"), F.coalesce("lack", "lack0").alias("lack"), F.coalesce("low", "low0").alias("low")
            )
        )
    # What meets at the border comes in if that leaves less lacking than leaving it out.
    last = border.select(F.col("source").alias("s"), "lack", "low")
    at_border = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + F.lit(width))
    meet = (
        ranked.where(F.col("rank").isNotNull()).join(last, F.col("source").eqNullSafe(F.col("s"))).where(at_border)
        .groupBy("source").agg(F.sum("size").alias("meeting"))
    )
    last = last.join(meet, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "s", "lack", (F.col("low") + F.when(F.coalesce(F.col("meeting"), F.lit(0)) < 2 * F.col("lack"), F.lit(width)).otherwise(0.0)).alias("cut")
    )
    last = pinned(last)
    out = ranked.join(sent(last), F.col("source").eqNullSafe(F.col("s")), "left")
    copies = (F.col("whole") + F.when(F.col("rank") < F.col("cut"), 1).otherwise(0)).cast("long")
    return out.select(
        *[F.col("kept")[c].alias(c) for c in keep],
        F.col("size").alias(names["size"]),
        F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]),
        copies.alias(names["copies"]),
        (copies * F.col("size")).alias(names["taken"]),
    )


def take_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", copies: str = "copies", **options) -> DataFrame:
    """The documents that the mix takes, with their own columns and a column that says how many
    copies of each row it takes. Rows that repeat id and text are taken equally often."""
    th, id_ = free_name(docs, "mix_hash"), free_name(docs, "mix_id")
    keyed = docs.select(
        quoted(doc_id).alias("doc_id"), quoted(text).alias("text"), quoted(source).alias("source"), F.xxhash64(quoted(text)).alias("th")
    )
    taken = mix_documents(keyed, keep=["doc_id", "th"], **options).where(F.col("copies") > 0)
    taken = taken.groupBy(F.col("doc_id").alias(id_), F.col("th").alias(th)).agg(F.max("copies").alias(free_name(docs, copies)))
    met = quoted(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(quoted(text)) == F.col(th))
    return docs.join(sent(pinned(taken)), met).drop(id_, th)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken for a mix of the sources by weights 1, 2, 3, in which longer
    documents are likelier than short ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_documents(docs, weight=by_length)
