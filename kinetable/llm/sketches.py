"""Near duplicates by bottom-k sketches of one hash function.

A document's set is its distinct word shingles, as 64-bit hashes.  Its sketch is the k
smallest of them.  Inverted lists of retained values bring documents together, an estimate
on the union of two sketches filters the pairs, and the full sets decide.  Between the last
two stands a bound that loses nothing: each set has a bit for every residue of its hashes
that an odd number of them has, and two sets differ in at least as many shingles as bits.

What makes it work on large input:

- Equal sets are one node, so exact copies cost one row each, however many there are.
- A list belongs to three values that follow each other in a sketch.  Documents that share
  a frequent word pair or line rarely share such a run by chance.  If two sets have
  similarity 0.8, their union's 40 smallest values hold no run of three shared ones with a
  probability of about 1e-6; sets that fit into that always share one (below six values,
  runs of two count as well, and below three the whole set).
- First the documents of a list are compared with its least document only, then each with
  the likeliest partner in its longest list.  What is left are pairs of documents that no
  links connect yet; they are compared in blocks of bounded size, and those that pass the
  estimate are confirmed.  So every link that connects anything is found, without the
  pairs within a group of copies.

Null texts and texts without words have an empty set, are linked with nothing and are their
own component.  Where ids repeat or are null, the least id that is not null names the
component; a row is kept if its id is that name.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import map_batches, map_each, map_rows
from .components import components
from .words import hashed_words

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Settings:
    """Shingle length, similarity in percent, sketch size, and members of a block."""

    words: int = 5
    percent: int = 80
    kept: int = 64
    # Of those, the smallest that make lists.
    listed: int = 40
    block: int = 2048
    # Residues of the parity bits, and texts to confirm that may be looked up by broadcast.
    residues: int = 4096
    broadcast: int = 200_000
    # Members whose counts with a whole block are held at once.
    at_once: int = 64

    def most_apart(self, sizes):
        """Shingles that are in one of two linked sets only, at most; ``sizes`` is their sum."""
        return sizes * (100 - self.percent) / (100 + self.percent) + 1e-6

    def least_shared(self, union, sizes, root):
        """Shared values that links have in a sample of their union, less five deviations.

        ``sizes`` is the sum of both sets' sizes.  A sample that is the whole union has
        no deviation.
        """
        share = self.percent / 100
        unseen = 1 - union * (1 + share) / sizes
        unseen = (unseen + root(unseen * unseen)) / 2
        return share * union - 5 * root(share * (1 - share) * union * unseen) - 1e-6


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, settings: Settings):
        self.settings = settings

    def __call__(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass")
        # Bytes: lowers A-Z only, and words lie between the six white characters.
        _, hashes, _ = hashed_words(raw.lower())
        if not len(hashes):
            return np.empty(0, np.uint64)
        length = min(self.settings.words, len(hashes))
        mixed = np.full(len(hashes) - length + 1, length, np.uint64)
        for step in range(length):
            mixed = (mixed ^ hashes[step : step + len(mixed)]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        mixed *= _FINAL
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def _signed(values: np.ndarray) -> list[int]:
    """Unsigned hashes as signed longs in the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64).tolist()


def _parities(values: np.ndarray, residues: int) -> list[int]:
    """A bit for each residue that an odd number of values has, in longs."""
    counts = np.bincount((values % np.uint64(residues)).astype(np.int64), minlength=residues)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).tolist()


def sketch_documents(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, sketch, bits``; keys are 128-bit digests."""

    def make():
        shingler = Shingler(settings)

        def each(doc_id, text):
            found = shingler(text)
            text_key = hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest()
            set_key = hashlib.md5(found.tobytes()).digest()
            sketch, bits = _signed(found[: settings.kept]), _parities(found, settings.residues)
            return doc_id, text_key, len(found), set_key, sketch, bits

        return each

    ddl = "doc_id long, text_key binary, n_shingles long, set_key binary, "
    ddl += "sketch array<long>, bits array<long>"
    return map_each(docs.select("doc_id", "text"), ddl, make)


def text_key(text: str | Column = "text") -> Column:
    """The digest by which equal texts are recognised."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def _postings(sets: DataFrame, settings: Settings) -> DataFrame:
    """``(list, n, set_key)`` for each run of three values of a sketch."""
    values = F.slice("sketch", 1, settings.listed)
    size = F.size(values)

    def runs(length: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), size - length),
            lambda at: F.xxhash64(
                F.lit(length), *(F.element_at("sketch", at + 1 + step) for step in range(length))
            ),
        )

    whole = F.array(F.xxhash64("sketch"))
    lists = F.when(size < 3, whole).when(size < 6, F.concat(runs(2), runs(3))).otherwise(runs(3))
    return sets.select("n", "set_key", F.explode(F.array_distinct(lists)).alias("list"))


def _estimated(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose sketches allow a link: sizes, then the union's shared values."""
    one = sets.select(
        F.col("set_key").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"),
        F.col("bits").alias("bits_a"),
    )
    two = sets.select(
        F.col("set_key").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"),
        F.col("bits").alias("bits_b"),
    )
    joined = pairs.join(one, "a").join(two, "b")
    odd = F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    odd = F.aggregate(odd, F.lit(0), lambda total, x: total + x)
    joined = joined.where(odd <= settings.most_apart(F.col("n_a") + F.col("n_b")))

    def reach(n: str, sketch: str) -> Column:
        # A sketch that is its whole set knows all values.
        last = F.array_max(sketch)
        return F.when(F.col(n) <= settings.kept, F.lit((1 << 63) - 1)).otherwise(last)

    limit = F.least(reach("n_a", "s_a"), reach("n_b", "s_b"))
    shared = F.size(F.array_intersect("s_a", "s_b"))

    def below(sketch: str) -> Column:
        return F.size(F.filter(sketch, lambda value: value <= F.col("reach")))

    joined = joined.withColumn("reach", limit).withColumn("shared", shared)
    union = below("s_a") + below("s_b") - F.col("shared")
    found = joined.withColumn("union", union)
    sizes = F.col("n_a") + F.col("n_b")
    least = settings.least_shared(F.col("union"), sizes, F.sqrt)
    return found.where(F.col("shared") >= least).select("a", "b")


class SharedValues:
    """Number of values that some sketches share with each of a block's.

    Only values of the few sketches make columns, so memory is bounded by their number
    times that of the block.
    """

    def __init__(self, sketches: list[np.ndarray]):
        self.count = len(sketches)
        self.values = np.concatenate(sketches)
        self.member = np.repeat(np.arange(self.count), [len(sketch) for sketch in sketches])

    def __call__(self, some: list[np.ndarray]) -> np.ndarray:
        columns, place = np.unique(np.concatenate(some), return_inverse=True)
        left = np.zeros((len(some), len(columns)), np.float32)
        left[np.repeat(np.arange(len(some)), [len(sketch) for sketch in some]), place] = 1
        at = np.minimum(np.searchsorted(columns, self.values), len(columns) - 1)
        known = columns[at] == self.values
        right = np.zeros((self.count, len(columns)), np.float32)
        right[self.member[known], at[known]] = 1
        return left @ right.T


def _block_pairs(settings: Settings, likeliest: bool):
    """Pairs of a block, or of two, that are not connected and pass the estimate.

    With ``likeliest`` only the best one of each member.
    """
    largest = np.iinfo(np.int64).max
    ratio = settings.percent / 100 - 1e-9

    class Side:
        def __init__(self, members: pa.StructArray):
            self.keys, self.roots, sizes, sketches, bits = members.flatten()
            self.bits = bits.flatten().to_numpy().view(np.uint64).reshape(len(members), -1)
            self.sizes = sizes.to_numpy()
            lengths = pc.list_value_length(sketches).to_numpy()
            self.sketches = np.split(sketches.flatten().to_numpy(), np.cumsum(lengths)[:-1])
            reach = np.asarray([sketch[-1] for sketch in self.sketches])
            self.reach = np.where(self.sizes <= settings.kept, largest, reach)

    def pairs(one: Side, two: Side | None):
        other = two or one
        shared_with = SharedValues(other.sketches)
        roots = pa.concat_arrays([one.roots, other.roots]).dictionary_encode().indices.to_numpy()
        own, theirs = roots[: len(one.sizes)], roots[len(one.sizes) :]
        best = np.zeros(len(other.sizes), np.float32), np.zeros(len(other.sizes), np.int64)
        for low in range(0, len(one.sizes), settings.at_once):
            some = slice(low, low + settings.at_once)
            shared = shared_with(one.sketches[some])
            limit = np.minimum(one.reach[some, None], other.reach[None, :])
            union = -shared
            for i, sketch in enumerate(one.sketches[some]):
                union[i] += np.searchsorted(sketch, limit[i], "right")
            for j, sketch in enumerate(other.sketches):
                union[:, j] += np.searchsorted(sketch, limit[:, j], "right")
            union = np.maximum(union, 1)
            sizes = one.sizes[some, None] + other.sizes[None, :]
            passed = shared >= settings.least_shared(union, sizes, np.sqrt)
            small = np.minimum(one.sizes[some, None], other.sizes[None, :])
            passed &= small >= ratio * (sizes - small)
            passed &= own[some, None] != theirs[None, :]
            if not likeliest:
                if not two:
                    passed &= np.arange(len(passed))[:, None] + low < np.arange(len(theirs))
                yield from near(one, other, *np.nonzero(passed), low)
                continue
            score = np.where(passed, shared / union, 0)
            rows, columns = np.arange(len(score)), score.argmax(1)
            found = score[rows, columns] > 0
            yield from near(one, other, rows[found], columns[found], low)
            # The other block's members have their best over all the parts.
            greatest = score.max(0)
            better = greatest > best[0]
            best[0][better], best[1][better] = greatest[better], score.argmax(0)[better] + low
        if likeliest and two:
            columns = np.flatnonzero(best[0])
            yield from near(one, other, best[1][columns], columns, 0)

    def near(one: Side, other: Side, rows: np.ndarray, columns: np.ndarray, low: int):
        """The keys of pairs whose bits allow a link."""
        for start in range(0, len(rows), 8192):
            i, j = rows[start : start + 8192] + low, columns[start : start + 8192]
            apart = np.bitwise_count(one.bits[i] ^ other.bits[j]).sum(1)
            kept = apart <= settings.most_apart(one.sizes[i] + other.sizes[j])
            for x, y in zip(i[kept].tolist(), j[kept].tolist(), strict=True):
                a, b = one.keys[x].as_py(), other.keys[y].as_py()
                yield min(a, b), max(a, b)

    def each(batches):
        for batch in batches:
            for left, right in zip(*batch.columns, strict=True):
                yield from pairs(Side(left.values), Side(right.values) if len(right) else None)

    return each


def _confirmed(pairs: DataFrame, chosen: DataFrame, docs: DataFrame, settings, stage, name):
    """The pairs whose full sets reach the similarity; sets are made of texts once more."""
    needed = pairs.select(F.col("a").alias("set_key")).union(
        pairs.select(F.col("b").alias("set_key"))
    )
    keys = chosen.join(needed.distinct(), "set_key").select("text_key", "set_key")
    keys = stage.table(keys, f"{name}-keys")
    if keys.count() <= settings.broadcast:
        # Counted: these digests take a few megabytes, and no text is shuffled for them.
        keys = F.broadcast(keys)
    texts = docs.select(text_key().alias("text_key"), "text")
    texts = texts.join(keys, "text_key", "left_semi").groupBy("text_key").agg(
        F.first("text").alias("text")
    )

    def make():
        shingler = Shingler(settings)

        def each(_, text):
            found = shingler(text)
            return hashlib.md5(found.tobytes()).digest(), found.tobytes()

        return each

    full = map_each(texts, "set_key binary, values binary", make)
    full = stage.table(full, f"{name}-sets")

    def made():
        def each(rows):
            for a, b, one, two in rows:
                left, right = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= settings.percent * (len(left) + len(right) - shared):
                    yield a, b

        return each

    one = full.select(F.col("set_key").alias("a"), F.col("values").alias("one"))
    two = full.select(F.col("set_key").alias("b"), F.col("values").alias("two"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return stage.table(map_rows(both, "a binary, b binary", made), f"{name}-links")


def _blocks(lists: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Members of lists with more than one component, as arrays of bounded size.

    Lists above the block size are dealt into parts by digest, and each two parts meet.
    """
    sizes = lists.groupBy("list").agg(
        F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    open_lists = sizes.where(F.col("low") != F.col("high")).select(
        "list", F.ceil(F.col("members") / settings.block).alias("parts")
    )
    dealt = lists.join(open_lists, "list").withColumn(
        "part", F.pmod(F.xxhash64("set_key"), F.col("parts"))
    )
    dealt = dealt.join(sets.select("set_key", "n", "sketch", "bits"), "set_key")
    member = F.struct("set_key", "root", "n", "sketch", "bits")
    whole = dealt.where("parts = 1").groupBy("list").agg(F.collect_list(member).alias("left"))
    whole = whole.select("left", F.array().cast(whole.schema["left"].dataType).alias("right"))
    # A part stands on the left against parts after it, on the right against those before.
    spread = dealt.where("parts > 1").withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    on_left = F.col("part") <= F.col("other")
    split = (
        spread.withColumn("low", F.least("part", "other"))
        .withColumn("high", F.greatest("part", "other"))
        .groupBy("list", "low", "high")
        .agg(
            F.collect_list(F.when(on_left, member)).alias("left"),
            F.collect_list(F.when(~on_left, member)).alias("right"),
        )
        .where((F.size("left") > 0) & ((F.col("low") == F.col("high")) | (F.size("right") > 0)))
        .select("left", "right")
    )
    return whole.union(split)


def _classes(docs: DataFrame, settings: Settings, stage: StageArea) -> tuple[DataFrame, DataFrame]:
    """Keys of all documents, and ``(node, root)`` of the sets that have links."""
    full = stage.table(sketch_documents(docs, settings), "sketches")
    sketches = stage.table(full.drop("sketch", "bits"), "documents")
    sets = (
        full.where(F.col("n_shingles") > 0)
        .groupBy("set_key")
        .agg(
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bits").alias("bits"),
            F.min("text_key").alias("text_key"),
        )
    )
    sets = stage.table(sets, "sets")
    stage.drop("sketches")
    postings = _postings(sets, settings)
    shared = postings.groupBy("list").agg(
        F.count("*").alias("members"), F.min(F.struct("set_key", "n")).alias("pivot")
    )
    lists = stage.table(postings.join(shared.where("members > 1"), "list"), "lists")
    tested = found = links = None

    def round_of(pairs: DataFrame, name: str) -> None:
        nonlocal tested, found, links
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage.table(pairs, f"{name}-pairs")
        if found is not None and pairs.isEmpty():
            return
        more = _confirmed(pairs, sets, docs, settings, stage, name)
        tested = pairs if tested is None else tested.union(pairs)
        if found is not None and more.isEmpty():
            return
        links = more if links is None else links.union(more)
        found = components(links, stage, name)

    def rooted(rows: DataFrame) -> DataFrame:
        roots = found.withColumnRenamed("node", "set_key")
        rows = rows.select("list", "set_key").join(roots, "set_key", "left")
        return rows.withColumn("root", F.coalesce("root", "set_key"))

    def block_pairs(rows: DataFrame, likeliest: bool) -> DataFrame:
        blocks = _blocks(rooted(rows), sets, settings)
        return map_batches(
            blocks, "a binary, b binary", lambda: _block_pairs(settings, likeliest)
        ).distinct()

    like = F.least("n", "pivot.n") >= (settings.percent / 100 - 1e-9) * F.greatest("n", "pivot.n")
    stars = lists.where((F.col("pivot.set_key") != F.col("set_key")) & like).select(
        F.col("pivot.set_key").alias("a"), F.col("set_key").alias("b")
    )
    round_of(_estimated(stars.distinct(), sets, settings), "pivots")
    longest = lists.groupBy("set_key").agg(F.max_by("list", F.struct("members", "list")).alias("list"))
    round_of(block_pairs(longest, True), "likeliest")
    round_of(block_pairs(lists, False), "others")
    return sketches, found


def near_duplicates(
    docs: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for each document."""
    settings = settings or Settings()
    stage = stage or StageArea(docs.sparkSession)
    sketches, found = _classes(docs, settings, stage)
    narrow = sketches.select("doc_id", "text_key", "n_shingles", "set_key")
    roots = found.withColumnRenamed("node", "set_key")
    by_set = (
        narrow.where(F.col("n_shingles") > 0)
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("least"))
        .join(roots, "set_key", "left")
        .withColumn("root", F.coalesce("root", "set_key"))
    )
    by_set = stage.table(by_set, "set-roots")
    names = by_set.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_set.join(names, "root").select("set_key", "component_id", "root")
    return (
        narrow.join(named, "set_key", "left")
        .withColumn(
            "component_id",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "text_key", "n_shingles", "component_id", "kept", "root")
    )


def keep_one_of_each(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents left when one of each group stays, with all their columns.

    The one with the least id stays; among rows with that id, one with the least text
    digest.  Documents without words all stay.
    """
    stage = StageArea(docs.sparkSession)
    found = near_duplicates(docs, settings, stage)
    grouped = found.where(F.col("root").isNotNull())
    best = (
        grouped.where("kept")
        .groupBy("root")
        .agg(F.min("text_key").alias("_text_key"), F.first("doc_id").alias("_doc_id"))
    )
    rows = grouped.where("kept").groupBy("root", "text_key").agg(F.count("*").alias("_rows"))
    best = best.join(
        rows.withColumnRenamed("text_key", "_text_key"), ["root", "_text_key"]
    ).select("_text_key", "_doc_id", "_rows", F.lit(True).alias("_stays"))
    best = stage.table(best, "best")
    empty = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == ""
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row")
    marked = docs.select(row, "doc_id", text_key().alias("_key"), empty.alias("_empty"))
    matches = (F.col("_key") == F.col("_text_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    kept = marked.join(best, matches, "left")
    single = kept.where("_empty or (_stays and _rows = 1)").select("_row.*")
    if best.where("_rows > 1").isEmpty():
        return single
    repeated = kept.where("not _empty and _stays and _rows > 1").dropDuplicates(["_key", "doc_id"])
    return single.union(repeated.select("_row.*"))
