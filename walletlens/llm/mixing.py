"""Mixing sources to target weights by Sainte-Lague apportionment.

All words of a source lie on lines, one per shard, in a seeded order of documents; a line is cut
into blocks of equally many words.  Whole blocks are dealt to sources, and then to the shards of a
source, by highest quotients weight / (2 seats + 1).  A shard with n blocks and q seats takes every
block q // n times, and q % n blocks once more: a run of neighbours (around the end of the line)
that starts at a seeded block.  The order of documents is seeded, so the run is a seeded choice of
documents, and at most its two ends cut one.

Only counts per source and per shard are ever gathered; documents are never grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.llm.common import WORD, free_name

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# Words of a block at most; fewer where a source would have less than so many blocks.
BLOCK_WORDS = 64
LEAST_BLOCKS = 200
SHARD_WORDS = 1_000_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(*parts) -> Column:
    """A number from 0 up to 2 ** 60 by md5, the same in every engine; parts are joined as text, null as empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def place_of(seed: int) -> Column:
    """Where a row lies in the seeded order: from its id and text, so reruns and repeated rows agree."""
    return seeded(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def source_targets(sources: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with ``weight``, ``target`` and the total.

    Weights repeat over sources in code point order, null last. All words are shared out by weight;
    a target stops at ``most_repeats`` times its source's size and the excess goes to the others by
    weight until none is above. With caps sorted by size per weight this is one running sum:
    the k sources of least cap per weight are capped exactly if the level of the rest exceeds theirs.
    """
    by_name = Window.partitionBy().orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy()
    ratio = F.col("cap") / F.col("weight")
    by_ratio = Window.partitionBy().orderBy("ratio", F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1)
    )
    # Windows over all sources see one row per source, never documents.
    levelled = (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most_repeats)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("ratio", ratio)
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        # The first source whose cap lies above the level sets the level of all from there on.
        .withColumn(
            "first",
            F.min(F.when(F.col("ratio") >= F.col("level"), F.struct(F.row_number().over(by_ratio), "level")))
            .over(everything)["level"],
        )
    )
    target = F.when(F.col("ratio") > F.col("first"), F.col("first") * F.col("weight")).otherwise(F.col("cap"))
    return levelled.select("source", "source_size", "weight", "total", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], share: str, seats: str, most: str, order: list[str]) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group dealt by Sainte-Lague to ``share``.

    A party gets its seats below the exact share less two outright (all those quotients lie above
    those in question), and the remaining seats go to the highest quotients among its next ones, never
    more than ``most`` for a party. Ties go by ``order``. Shares of a group must sum to about its seats.
    """
    sure = F.greatest(F.lit(0), F.floor(F.col(share)).cast("long") - 2)
    base = parties.withColumn("sure", F.least(sure, F.col(most)))
    everyone = Window.partitionBy(*group)
    rest = base.withColumn("rest", F.col(seats) - F.sum("sure").over(everyone))
    seat = F.explode(F.sequence(F.col("sure"), F.col("sure") + 5)).alias("seat")
    quotients = rest.select(*group, *order, "rest", share, most, seat).where(F.col("seat") < F.col(most))
    ranked = quotients.withColumn(
        "place",
        F.row_number().over(everyone.orderBy((F.col(share) / (2 * F.col("seat") + 1)).desc(), *order, "seat")),
    )
    won = ranked.where("place <= rest").groupBy(*group, *order).agg(F.count("*").alias("won"))
    keys = [*group, *order]
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    joined = base.alias("p").join(won.alias("w"), on=same, how="left")
    return joined.select("p.*", (F.col("p.sure") + F.coalesce("w.won", F.lit(0))).alias("quota")).drop("sure")


def block_size(sources: DataFrame, most: int = BLOCK_WORDS, least_blocks: int = LEAST_BLOCKS) -> int:
    """Words of a block, the same for all: the smallest source with words has ``least_blocks`` of them, or one a word."""
    smallest = sources.where("source_size > 0").agg(F.min("source_size")).first()[0]
    return max(1, min(most, (smallest or 0) // least_blocks))


def plan_mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_words: int | None = None,
    shard_words: int = SHARD_WORDS,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and what is taken.

    ``passes`` whole passes and, in one more pass, words [from1, to1) and [from2, to2) (the second
    range is empty unless the run goes around the end of its line); ``taken`` counts all of them and
    never exceeds ``most_repeats`` times the size. Null texts have size 0; a null source is a source of
    its own; repeated rows are documents of their own, side by side; equal seeds give equal results
    whatever the partitioning. An empty table gives no rows. ``block_words`` is ``block_size`` unless given.
    """
    sized = written(
        docs.select("doc_id", "source", words(F.col("text")).alias("size"), place_of(seed).alias("place")), "sizes"
    )
    sources = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    block_words = block_words or block_size(sources)
    targets = source_targets(sources, weights, most_repeats)
    blocks = F.ceil(F.col("source_size") / block_words)
    seats = F.round(F.first("total").over(Window.partitionBy(F.lit(0))) / block_words).cast("long")
    quotas = written(
        apportion(
            targets.withColumn("all", F.lit(0))
            .withColumn("share", F.col("target") / block_words)
            .withColumn("seats", seats)
            .withColumn("most", most_repeats * blocks),
            ["all"], "share", "seats", "most", ["source"],
        ).select(
            "source", "source_size", "target", F.col("quota").alias("seats"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
        ),
        "quotas",
    )
    # One row per source: the planner broadcasts it only while its stored size is below its limit.
    s, q = sized.alias("s"), quotas.alias("q")
    located = s.join(q, on=F.col("s.source").eqNullSafe(F.col("q.source")), how="inner").select(
        "s.*", "source_size", "target", "seats", F.pmod("place", F.col("shards")).alias("shard")
    )
    line = Window.partitionBy("source", "shard").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = written(located.withColumn("end", F.sum("size").over(line)), "lines")
    shards = (
        placed.groupBy("source", "shard")
        .agg(F.sum("size").alias("shard_size"), F.first("source_size").alias("whole"), F.first("seats").alias("seats"))
        .withColumn("blocks", F.ceil(F.col("shard_size") / block_words))
        .withColumn("share", F.col("seats") * F.col("shard_size") / F.greatest(F.col("whole"), F.lit(1)))
        .withColumn("most", most_repeats * F.col("blocks"))
    )
    dealt = apportion(shards, ["source"], "share", "seats", "most", ["shard"])
    n = F.greatest(F.col("blocks"), F.lit(1))
    start = F.pmod(seeded(F.lit(seed), F.col("source"), F.col("shard")), n)
    shard_plan = written(
        dealt.select(
            "source", "shard", "shard_size",
            F.floor(F.col("quota") / n).alias("passes"),
            (start * block_words).alias("run_from"),
            # Where the run goes around, its second part begins at 0.
            ((start + F.col("quota") % n) * block_words).alias("run_to"),
            (n * block_words).alias("line_words"),
        ),
        "shards",
    )
    p, k = placed.alias("p"), shard_plan.alias("k")
    same = F.col("p.source").eqNullSafe(F.col("k.source")) & (F.col("p.shard") == F.col("k.shard"))
    begin = F.col("end") - F.col("size")

    def inside(low: Column, high: Column) -> tuple[Column, Column]:
        first = F.least(F.greatest(low - begin, F.lit(0)), F.col("size"))
        return first, F.greatest(first, F.least(high - begin, F.col("size")))

    from1, to1 = inside(F.col("run_from"), F.col("run_to"))
    from2, to2 = inside(F.lit(0), F.greatest(F.col("run_to") - F.col("line_words"), F.lit(0)))
    return p.join(k, on=same, how="inner").select(
        "p.doc_id", "p.source", "size", "source_size", "target", "place", "passes",
        from1.alias("from1"), to1.alias("to1"), from2.alias("from2"), to2.alias("to2"),
        (F.col("passes") * F.col("size") + (to1 - from1) + (to2 - from2)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: int = 7, **settings) -> DataFrame:
    """The mix itself, in the columns of ``docs``: each row once per whole pass, and the part of one more.

    A part keeps the taken words, joined by single spaces; ``n_chars`` follows it where ``docs`` has it.
    Documents that the mix takes no word of are left out, those without any word as well. Null ids and sources stay
    null, repeated rows count one by one, other columns stay as they are, and an empty table gives no rows.
    """
    plan = plan_mix(docs, seed=seed, **settings)
    # Repeated rows share a place: number them on both sides to pair them one to one.
    numbered = Window.partitionBy("place", "doc_id").orderBy("from1", "to1", "from2", "to2")
    plan = plan.withColumn("copy", F.row_number().over(numbered))
    at, nth = free_name(docs, "mix_place"), free_name(docs, "mix_copy")
    copies = Window.partitionBy(at, "doc_id").orderBy(at)
    keyed = docs.withColumn(at, place_of(seed)).withColumn(nth, F.row_number().over(copies))
    same = (
        (F.col(f"d.{at}") == F.col("p.place"))
        & F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
        & (F.col(f"d.{nth}") == F.col("p.copy"))
    )
    taken = plan.where("taken > 0").select(
        "doc_id", "place", "copy", "size", "passes", "from1", "to1", "from2", "to2"
    )
    found = F.regexp_extract_all(F.col("d.text"), F.lit(f"({WORD})"), F.lit(1))
    cut = lambda a, b: F.slice(found, (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int"))
    part = F.when(
        (F.col("to1") - F.col("from1")) + (F.col("to2") - F.col("from2")) >= F.col("p.size"), F.col("d.text")
    ).otherwise(F.array_join(F.concat(cut("from1", "to1"), cut("from2", "to2")), " "))
    rows = F.explode(
        F.concat(
            F.array_repeat(F.col("d.text"), F.col("p.passes").cast("int")),
            F.when(F.col("to1") + F.col("to2") > F.col("from1") + F.col("from2"), F.array(part)).otherwise(
                F.array().cast("array<string>")
            ),
        )
    )
    columns = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = keyed.alias("d").join(taken.alias("p"), on=same, how="inner").select(
        *[F.col(f"d.{c}") for c in columns], rows.alias("text")
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
