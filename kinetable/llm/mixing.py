"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, and the rates closest to one (in relative entropy, by words)
that meet the token target of each source are exponentially tilted: the rate is the
exponential of its source's dual variable.  The dual is convex, and as each word has one
source its Hessian is diagonal, so Newton's iterations run for all sources in parallel, on
one row each.  Rates are then rounded: all documents of a source get the whole part as
copies, and documents in the order of an id digest get one more as long as they fit.  Where
a long document ends that, the others that still fit are tried in the same way, again and
again until none fits.  One more document is taken where that comes nearer to the target
than what is left, so a source misses its target by half of its smallest document at most.

Each order is cut with two levels of 4096 digest ranges per source, so no source is sorted
or gathered anywhere, and a cut is as fine as a 16-millionth of a source.  The table of
sources has one row each; it is broadcast only after its size is checked.

Null texts have no words, so they never change what is taken.  A null source is a source
of its own, the last.  Rows with one id fall together; rows without id go by their text.
Sources without words have target 0.  Empty tables give empty results.  Extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import WORD

MOST_COPIES = 3
NEWTON_STEPS = 64
# Each round takes a document at least from every source where one fits, mostly many, so
# that a handful are enough; this many would be an error.
MOST_ROUNDS = 40
DIGITS = 3
# Characters of a source table that may be broadcast.
BROADCAST_CHARS = 4_000_000


def words(text: str | Column = "text") -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("bigint")


def _digest(doc_id: Column, text: Column) -> Column:
    key = F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")))
    return F.substring(key, 1, 2 * DIGITS)


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Weights 1, 2, 3 repeat along the sources.  A target is its weight times a common
    level, or its cap; sources are below their cap from the first on at which the words
    left, shared by the weights left, stay below it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    cap = F.col("source_size") * MOST_COPIES
    by_cap = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(whole) - capped) / weight_left
    levels = weighted.withColumn("level", level)
    # Once a source is below its cap, its level is that of all later ones.
    free = F.when(F.col("weight") * F.col("level") <= cap, F.col("level"))
    common = F.first(free, ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shared = levels.withColumn("common", common)
    target = F.coalesce(F.col("weight") * F.col("common"), cap).cast("double")
    return shared.select("source", "source_size", target.alias("target"))


def tilted_rates(targets: DataFrame) -> DataFrame:
    """With ``rate``: the exponential of the dual variable after Newton's iterations."""
    ratio = F.col("target") / F.col("source_size")
    dual = F.aggregate(
        F.sequence(F.lit(1), F.lit(NEWTON_STEPS)),
        F.lit(0.0),
        lambda dual, _: dual - 1 + F.col("ratio") * F.exp(-dual),
    )
    solved = targets.withColumn("ratio", ratio).withColumn(
        "rate", F.when(F.col("ratio") > 0, F.least(F.exp(dual), F.lit(float(MOST_COPIES))))
    )
    return solved.withColumn("rate", F.coalesce("rate", F.lit(0.0))).drop("ratio")


def _fitting(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``of, until, used``: how far documents fit into the words left, and their words."""
    within = Window.partitionBy("source").orderBy("range")

    def ranges(rows: DataFrame, digest: Column, *more: str) -> DataFrame:
        summed = rows.groupBy("source", "left", *more, digest.alias("range")).agg(
            F.sum("size").alias("words")
        )
        return summed.withColumn("upto", F.sum("words").over(within))

    coarse = ranges(sized, F.substring("digest", 1, DIGITS))
    # The first range that does not fit as a whole is looked at more closely.
    crossed = coarse.where("upto > left").groupBy("source").agg(
        F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("before"))).alias("at")
    )
    crossed = crossed.select(F.col("source").alias("of"), "at.range", "at.before")
    inside = F.col("source").eqNullSafe(F.col("of")) & F.col("digest").startswith(F.col("range"))
    close = sized.join(crossed, inside).withColumnRenamed("range", "first")
    fine = ranges(close, F.col("digest"), "first", "before")
    upto = F.col("before") + F.col("upto")
    cut = fine.withColumn("fits", upto <= F.col("left")).groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("range"))), F.min("first")).alias("until"),
        F.coalesce(F.max(F.when(F.col("fits"), upto)), F.min("before")).alias("used"),
    )
    whole = coarse.groupBy("source").agg(F.sum("words").alias("used"), F.max("left").alias("left"))
    whole = whole.where("used <= left").select("source", F.lit("g").alias("until"), "used")
    return cut.select("source", "until", "used").union(whole).withColumnRenamed("source", "of")


def _taken(rounds: int) -> Column:
    """Whether a document has one more copy after so many rounds."""
    return F.coalesce(F.col("digest") == F.col("extra"), F.lit(False)) | _fitted(rounds)


def _fitted(rounds: int) -> Column:
    taken = F.lit(False)
    for turn in range(rounds):
        taken = taken | (
            (F.col("size") <= F.col(f"most_{turn}")) & (F.col("digest") <= F.col(f"until_{turn}"))
        )
    return taken


def _plan(sized: DataFrame, stage: StageArea) -> tuple[DataFrame, int]:
    """One row for each source, and the number of rounds.

    A row has the source's target, its whole copies, and the limits of one more.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = tilted_rates(source_targets(sizes)).withColumn(
        "whole", F.floor(F.col("rate") + 1e-9).cast("int")
    )
    left = F.col("target") - F.col("whole") * F.col("source_size")
    plan = plan.withColumn("left", left).withColumnRenamed("source", "named")
    plan = stage.table(plan, "plan")
    same = F.col("source").eqNullSafe(F.col("named"))
    for turn in range(MOST_ROUNDS):
        most = F.col("left") if turn else F.col("source_size").cast("double")
        plan = plan.withColumn(f"most_{turn}", most)
        open_rows = sized.join(_checked(plan), same).where(
            ~_fitted(turn) & (F.col("size") > 0) & (F.col("size") <= F.col(f"most_{turn}"))
        )
        found = _fitting(open_rows.select("source", "size", "digest", "left"), plan)
        plan = plan.join(found, F.col("named").eqNullSafe(F.col("of")), "left").drop("of")
        plan = plan.withColumn(f"until_{turn}", F.coalesce("until", F.lit(""))).withColumn(
            "left", F.col("left") - F.coalesce("used", F.lit(0))
        )
        plan = stage.table(plan.drop("until"), f"plan-{turn}")
        if not plan.agg(F.max("used")).first()[0]:
            return _with_extra(sized, plan.drop("used"), turn + 1, stage), turn + 1
        plan = plan.drop("used")
    raise RuntimeError(f"documents still fit after {MOST_ROUNDS} rounds")


def _with_extra(sized: DataFrame, plan: DataFrame, rounds: int, stage: StageArea) -> DataFrame:
    """With ``extra``: the digest of a document that brings the source nearer to its target."""
    rest = sized.join(_checked(plan), F.col("source").eqNullSafe(F.col("named"))).where(
        ~_fitted(rounds) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left"))
    )
    # Rows with one digest go together.
    groups = rest.groupBy(F.col("source").alias("of"), "digest", "left").agg(
        F.sum("size").alias("words")
    )
    missed = F.abs(F.col("words") - F.col("left"))
    nearest = groups.where(missed < F.col("left")).groupBy("of").agg(
        F.min(F.struct(missed, "digest")).alias("best")
    )
    nearest = nearest.select("of", F.col("best.digest").alias("extra"))
    plan = plan.join(nearest, F.col("named").eqNullSafe(F.col("of")), "left").drop("of")
    return stage.table(plan, "plan-extra")


def _checked(plan: DataFrame) -> DataFrame:
    rows, chars = plan.agg(
        F.count("*"), F.coalesce(F.sum(F.length("named")), F.lit(0))
    ).first()
    return F.broadcast(plan) if chars + 50 * rows <= BROADCAST_CHARS else plan


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        *more,
        "doc_id",
        "source",
        words().alias("size"),
        _digest(F.col("doc_id"), F.col("text")).alias("digest"),
    )


def _with_copies(rows: DataFrame, plan: DataFrame, rounds: int) -> DataFrame:
    joined = rows.join(_checked(plan), F.col("source").eqNullSafe(F.col("named")))
    return joined.withColumn("copies", F.col("whole") + _taken(rounds).cast("int"))


def mix_sources(docs: DataFrame, stage: StageArea | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for each document."""
    stage = stage or StageArea(docs.sparkSession)
    sized = stage.table(_sized(docs), "sized")
    return _with_copies(sized, *_plan(sized, stage)).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns."""
    stage = StageArea(docs.sparkSession)
    plan, rounds = _plan(stage.table(_sized(docs), "sized"), stage)
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    sized = _sized(docs.withColumn("_row", row), F.col("_row"))
    repeated = _with_copies(sized, plan, rounds).where("copies > 0")
    return repeated.select("_row", F.explode(F.expr("sequence(1, copies)"))).select("_row.*")
