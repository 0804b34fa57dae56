"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Words stand for tokens. The documents of a source are dealt over shards and put in a seeded order; the words of a
shard, in that order, form blocks of `block_words`. Blocks go to sources, then to the shards of each source, by highest
quotients weight / 1, 3, 5, ... A shard with quota q and b blocks gives all blocks q div b times, and q mod b blocks,
counted round from a seeded first block, once more. So a document is taken whole except at the two ends of that stretch,
and what is taken follows from interval arithmetic: one light window per shard, no rows for single blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Workspace, seeded_order

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 64
SHARD_WORDS = 2_000_000
SEED = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, words, target from rows of (source, size).

    Sources take the weights in turn, by code point with NULL last. Together they get `share` times all words; none
    gets more than `repeats` times its own, and the excess is shared again by weight. With sources ordered by
    limit / weight that has a closed form: those before the first source whose ratio reaches the level of the
    remaining ones are full. The windows hold one row per source.
    """
    everywhere = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    level = (F.col("total") - F.col("full")) / F.col("rest")
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("words"))
        .withColumns({"weight": weight.cast("double"), "limit": F.col("words") * F.lit(float(repeats))})
        .withColumns({"ratio": F.col("limit") / F.col("weight"), "total": F.sum("words").over(everywhere) * F.lit(share)})
        .withColumns(
            {
                "place": F.row_number().over(by_ratio),
                "full": F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)),
                "rest": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
            }
        )
        .withColumn("full", F.coalesce("full", F.lit(0.0)))
        .withColumn("level", F.min(F.when(F.col("ratio") >= level, F.struct("place", level.alias("value")))).over(everywhere))
        .select("source", "words", F.least("limit", F.coalesce(F.col("level.value"), F.col("ratio")) * F.col("weight")).alias("target"))
    )


def apportion(parts: DataFrame, group: list[str], key: list[str], weight: str, house: str) -> DataFrame:
    """Adds `quota`: the seats of `house` that each part of a group gets by Sainte-Lague's highest quotients.

    Ties go to the part that comes first by `key`. Only quotients near a part's proportional share are in doubt: the
    outcome lies within half its share of the number of parts, plus 1.5, of that share. So a group with n parts ranks
    about 4n quotients rather than one per seat. Parts of weight zero get nothing.
    """
    within = Window.partitionBy(*group)
    order = Window.partitionBy(*group).orderBy(F.col("_quotient").desc(), *[F.col(k).asc_nulls_last() for k in key])
    names = parts.columns
    part = F.col(weight) / F.when(F.sum(weight).over(within) > 0, F.sum(weight).over(within))
    ideal, spread = F.col("_part") * F.col(house), F.col("_part") * (F.col("_n") + 2) / 2 + 2
    doubtful = (
        parts.withColumns({"_part": F.coalesce(part, F.lit(0.0)), "_n": F.count(F.lit(1)).over(within)})
        .withColumns({"_sure": F.greatest(F.lit(0.0), F.floor(ideal - spread)).cast("long"), "_last": F.floor(ideal + spread).cast("long") + 1})
        .withColumn("_open", F.col(house) - F.sum("_sure").over(within))
        .withColumn("_seat", F.explode(F.expr("sequence(_sure + 1, _last)")))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_seat") - 1))
        .withColumn("_won", ((F.row_number().over(order) <= F.col("_open")) & (F.col("_quotient") > 0)).cast("long"))
    )
    return doubtful.groupBy(*names).agg((F.min("_sure") + F.sum("_won")).alias("quota"))


def _taken(rows: DataFrame, sizes: DataFrame, space: Workspace, block_words: int, shard_words: int, seed: int, weights, share, repeats) -> DataFrame:
    """Adds to rows of (source, size, order, ...) what the mix takes of each: source_size, target, passes, and the word
    ranges [from1, to1) and [from2, to2) of the document that one more pass covers."""
    targets = source_targets(sizes, weights, share, repeats)
    shards = F.greatest(F.lit(1), F.ceil(F.col("words") / shard_words)).cast("long")
    quotas = apportion(
        targets.withColumns({"house": F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"), "shards": shards}),
        [], ["source"], "target", "house",
    )
    # A written table has a known size, so Spark broadcasts it while it is small and shuffles when it is not.
    quotas = space.table("quotas", quotas)

    def sharded(df: DataFrame) -> DataFrame:
        joined = df.join(quotas.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        return joined.drop("_source").withColumn("shard", F.pmod("order", "shards"))

    shard_sizes = sharded(sizes).groupBy("source", "quota", "shard").agg(F.sum("size").alias("shard_size"))
    plan = apportion(
        shard_sizes.withColumnRenamed("quota", "source_quota").withColumn("weight", F.col("shard_size").cast("double")),
        ["source"], ["shard"], "weight", "source_quota",
    )
    blocks = F.ceil(F.col("shard_size") / block_words).cast("long")
    plan = (
        plan.withColumn("blocks", F.greatest(F.lit(1), blocks))
        .withColumn("quota", F.least("quota", repeats * F.col("blocks")))
        .select(
            F.col("source").alias("_source"),
            F.col("shard").alias("_shard"),
            "shard_size",
            F.expr("quota div blocks").alias("passes"),
            (F.pmod(seeded_order(seed, F.col("source"), F.col("shard")), F.col("blocks")) * block_words).alias("begin"),
            (F.pmod("quota", "blocks") * block_words).alias("length"),
            (F.col("blocks") * block_words).alias("round"),
        )
    )
    plan = space.table("plan", plan)
    placed = sharded(rows).withColumn("_place", F.struct("order", "doc_id", "size"))
    ahead = Window.partitionBy("source", "shard").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    located = placed.withColumn("end", F.sum("size").over(ahead)).withColumn("start", F.col("end") - F.col("size"))
    met = located.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))

    def cut(low: Column, high: Column) -> tuple[Column, Column]:
        begin = F.least(F.greatest(low - F.col("start"), F.lit(0)), "size")
        return begin, F.greatest(begin, F.least(high - F.col("start"), F.col("size")))

    # The stretch may run past the last block and go on with the first; the second range is then the earlier one.
    stop = F.col("begin") + F.col("length")
    from1, to1 = cut(F.col("begin"), F.least(stop, F.col("round")))
    from2, to2 = cut(F.lit(0), stop - F.col("round"))
    return met.withColumns(
        {"source_size": F.col("words"), "from1": from1, "to1": to1, "from2": from2, "to2": to2}
    ).withColumn("taken", F.col("passes") * F.col("size") + (F.col("to1") - F.col("from1")) + (F.col("to2") - F.col("from2")))


def _rows(docs: DataFrame, seed: int, *payload: Column) -> DataFrame:
    doc_id = docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        word_count(docs["text"].cast("string")).alias("size"),
        # The text tells rows without an id, or with one id, apart, so that they spread over the shards of their source.
        seeded_order(seed, doc_id, F.md5(docs["text"].cast("binary"))).alias("order"),
        *payload,
    )


def mix_plan(docs: DataFrame, space: Workspace, *, weights=WEIGHTS, share=SHARE, repeats=REPEATS, block_words=BLOCK_WORDS, shard_words=SHARD_WORDS, seed=SEED) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken, passes.

    NULL or empty text has size 0 and nothing taken. A NULL source is a source of its own, the last. Rows with a NULL
    doc_id, and repeated rows, are documents like any other; repeated rows lie side by side and, being equal, may
    exchange their shares. Rows are ordered by a seeded hash of doc_id and text; ties go by doc_id, then size. An empty table gives no rows. Other
    columns are ignored. Texts are read once; sizes are kept in the shared folder.
    """
    sizes = space.table("sizes", _rows(docs, seed))
    taken = _taken(sizes, sizes, space, block_words, shard_words, seed, weights, share, repeats)
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken", "passes")


def mixed_documents(docs: DataFrame, space: Workspace, *, weights=WEIGHTS, share=SHARE, repeats=REPEATS, block_words=BLOCK_WORDS, shard_words=SHARD_WORDS, seed=SEED) -> DataFrame:
    """The mix itself, with the columns of `docs`: each document as many times as it is taken whole, and once more with
    the words of a part of it. A part keeps the blanks after its words; documents of which nothing is taken, empty
    ones among them, are absent. `n_chars`, where there is one, is that of the new text."""
    sizes = space.table("sizes", _rows(docs, seed))
    rows = _rows(docs, seed, F.struct(*[docs[name] for name in docs.columns]).alias("row"))
    taken = _taken(rows, sizes, space, block_words, shard_words, seed, weights, share, repeats)
    text = F.col("row.text").cast("string")
    words = F.regexp_extract_all(text, F.lit(rf"({WORD}[\x20\x09-\x0D]*)"), 1)
    cut = lambda low, high: F.slice(words, F.col(low).cast("int") + 1, (F.col(high) - F.col(low)).cast("int"))
    extra = (F.col("to1") - F.col("from1")) + (F.col("to2") - F.col("from2"))
    part = F.when(extra == F.col("size"), text).when(extra > 0, F.concat(F.array_join(cut("from2", "to2"), ""), F.array_join(cut("from1", "to1"), "")))
    copies = F.when(F.col("size") > 0, F.array_repeat(text, F.col("passes").cast("int"))).otherwise(F.array().cast("array<string>"))
    texts = F.concat(copies, F.when(extra > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    mixed = taken.select("row", F.explode(texts).alias("new"))
    columns = []
    for field in docs.schema:
        value = F.col(f"row.`{field.name}`")
        if field.name == "text":
            value = F.col("new")
        elif field.name == "n_chars":
            value = F.char_length("new").cast(field.dataType)
        columns.append(value.alias(field.name))
    return mixed.select(*columns)
