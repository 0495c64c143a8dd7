"""Collocations of two to four words, by marginalising counts of the longest windows.

Each word opens one window: itself and the next three words of its piece as lead columns, with
nothing (null) behind the piece's end.  Only these longest windows are counted.  A phrase's
frequency is the sum over all windows that begin with it, so one ROLLUP over the window's
columns gives the words' counts, then all pairs, triples and quadruples, and each language's
number of words; nothing shorter is ever taken from the texts.

Most windows of natural text stand once and could never add up to a candidate.  Therefore
hashes of neighbouring pairs are first counted by blocks of documents, and each block learns
which of its pairs stand often enough; then the same for phrases of three and four words made
of such pairs.  Where a pair does not, no candidate spans it, and the lead columns after it are
left empty like those behind a piece's end; where a longer phrase does not, those after its
beginning are.  A block adds up its equal windows before they travel.  That is pruning alone:
equal hashes only keep more, and every frequency comes from the windows.

Hashes travel as sorted steps and come back as one bit each (see ``blocks.Names``).  Texts are
parsed three times, which costs less than moving every window.

Words are 64-bit hashes in the windows; a table of the words that stand in phrases names them
and would raise an error if two of a language had one hash.  Integer arithmetic is exact:
products go through decimals of 38 digits.

Null texts have no words; null languages are ``und``.  A language holding most rows is not a
hot key: windows are added up before the shuffle and ranked in parts first.  Repeated rows
count as often as they stand.  Extra columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .blocks import NAME_BITS, SENT, Names, among, enough, in_blocks, map_blocks, together
from .words import MASK, hashed_words

_CUT = b"\xff"  # never a byte of UTF-8
# Marks between pieces become a byte of their own; all other white space belongs to words.
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _CUT * 10)
_COLUMNS = ("w1", "w2", "w3", "w4")


@dataclass(frozen=True)
class Settings:
    least: int = 30
    longest: int = 4
    scale: int = 2_000_000
    # A phrase within one that has this share of its occurrences is dropped.
    percent: int = 80
    ranked: int = 2_000
    # Texts of a block, and their characters, if they are more than one.
    block_rows: int = 8_192
    block_size: int = 4 << 20
    # Parts in which a language is ranked before the whole.
    parts: int = 64
    # Characters of the texts that are taken together, if they are more than one.
    together: int = 1 << 21


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0xFF]] = True


class Pieces:
    """Hashes of the words of some texts in their order; 0 stands between pieces."""

    def __init__(self, texts: list[str | None]):
        raw = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        blob = _CUT.join(raw).lower().translate(_PIECES)  # bytes: lowers A-Z only
        self.blob = blob
        self.at, first, _ = hashed_words(blob, _SPACE)
        cuts = np.cumsum(np.frombuffer(blob, np.uint8) == _CUT[0])
        piece = cuts[self.at] if len(self.at) else np.empty(0, np.int64)
        # A gap after each piece's last word.
        opens = np.flatnonzero(np.diff(piece, prepend=-1))
        place = np.arange(len(first)) + np.searchsorted(opens, np.arange(len(first)), "right")
        self.words = np.zeros(len(first) + len(opens) + self._tail, np.uint64)
        self.words[place] = first
        self.hashes = first

    # Empty places at the end, so that every word has lead columns.
    _tail = 4

    def spelled(self, chosen: list[int]) -> list[bytes]:
        """The bytes of the words with those numbers."""
        found = []
        for at in self.at[chosen].tolist():
            end = at
            while end < len(self.blob) and not _SPACE[self.blob[end]]:
                end += 1
            found.append(self.blob[at:end])
        return found


_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_names(words: np.ndarray, first: np.ndarray, size: int, lang: int) -> np.ndarray:
    """Hashes of the phrases of that many words at those places, as names of blocks."""
    found = np.full(len(first), (lang + size) & MASK, np.uint64)
    for step in range(size):
        found = (found ^ words[first + step]) * _MIX
        found ^= found >> np.uint64(32)
    return found * _MIX >> np.uint64(64 - NAME_BITS)


def _pairs(words: np.ndarray) -> np.ndarray:
    """Places of the words with a neighbour after them."""
    return np.flatnonzero((words[:-1] != 0) & (words[1:] != 0))


def _marked(words: np.ndarray, first: np.ndarray, size: int, lang: int, known: np.ndarray):
    """For each word, whether the phrase of that size at it is one of the places' and known."""
    found = np.zeros(len(words), bool)
    found[first[among(known, gram_names(words, first, size, lang))]] = True
    return found


def _longer(linked: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes above two, and where all pairs of such a phrase are linked."""
    whole = linked
    for size in range(3, longest + 1):
        whole = whole & np.append(linked[size - 2 :], np.zeros(size - 2, bool))
        yield size, np.flatnonzero(whole)


def _lang_number(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _by_language(row: dict, settings: Settings) -> Iterator[tuple[str, Pieces]]:
    """The texts of a block by language, in parts of bounded size."""
    groups: dict[str, list] = {}
    for lang, text in zip(row["lang"].as_py(), row["text"].as_py(), strict=True):
        groups.setdefault(lang, []).append(text)
    for lang, texts in groups.items():
        for low, high in together(texts, settings.together):
            yield lang, Pieces(texts[low:high])


def _pair_names(row: dict, settings: Settings, parts: int) -> Names:
    found = [np.empty(0, np.uint64)]
    for lang, pieces in _by_language(row, settings):
        found.append(gram_names(pieces.words, _pairs(pieces.words), 2, _lang_number(lang)))
    return Names(np.concatenate(found), parts)


def _linked(pieces: Pieces, lang: int, known: np.ndarray) -> np.ndarray:
    """For each word, whether the pair that it opens is known."""
    return _marked(pieces.words, _pairs(pieces.words), 2, lang, known)


def _longer_names(row: dict, settings: Settings, parts: int, known: np.ndarray) -> Names:
    """Names of the phrases above two words whose pairs are all known."""
    found = [np.empty(0, np.uint64)]
    for lang, pieces in _by_language(row, settings):
        number = _lang_number(lang)
        for size, first in _longer(_linked(pieces, number, known), settings.longest):
            found.append(gram_names(pieces.words, first, size, number))
    return Names(np.concatenate(found), parts)


def _sent_pairs(blocks: DataFrame, settings: Settings, parts: int) -> DataFrame:
    def each(row):
        yield from _pair_names(row, settings, parts).sent(row["block"].as_py(), settings.least)

    return map_blocks(blocks, SENT, each)


def _sent_longer(blocks: DataFrame, settings: Settings, parts: int) -> DataFrame:
    def each(row):
        known = _pair_names(row, settings, parts).chosen(row, "pairs")
        names = _longer_names(row, settings, parts, known)
        yield from names.sent(row["block"].as_py(), settings.least)

    return map_blocks(blocks, SENT, each)


# --- windows ----------------------------------------------------------------------------------


def _batch_of(lang: str, columns: list[np.ndarray], times: np.ndarray, words=None) -> pa.RecordBatch:
    size = len(times)
    arrays = [pa.array([lang]).take(pa.array(np.zeros(size, np.int32)))]
    arrays += [pa.array(column.view(np.int64), mask=column == 0) for column in columns]
    arrays.append(pa.array(times, pa.int64()))
    arrays.append(pa.nulls(size, pa.string()) if words is None else pa.array(words, pa.string()))
    return pa.RecordBatch.from_arrays(arrays, names=["lang", *_COLUMNS, "times", "word"])


def _added_up(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal windows once, with their numbers; should hashes collide, some stand apart."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for one in columns:
        mixed = (mixed ^ one) * _MIX
        mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed)
    columns = [one[order] for one in columns]
    opens = np.zeros(len(order), bool)
    opens[:1] = True
    for one in columns:
        opens[1:] |= one[1:] != one[:-1]
    first = np.flatnonzero(opens)
    return [one[first] for one in columns], np.diff(np.append(first, len(order)))


def _windows(blocks: DataFrame, settings: Settings, parts: int) -> DataFrame:
    """``lang, w1, w2, w3, w4, times`` of the padded windows, and the words in them.

    Rows with ``word`` name the hash ``w1`` and have no count.
    """

    def of_pieces(lang: str, pieces: Pieces, pairs: np.ndarray, longer: np.ndarray, named: set):
        words, number = pieces.words, _lang_number(lang)
        linked = _linked(pieces, number, pairs)
        # A word without a candidate after it is a window of itself; those are added up.
        alone, times = np.unique(words[(words != 0) & ~linked], return_counts=True)
        none = np.zeros(len(alone), np.uint64)
        yield _batch_of(lang, [alone, none, none, none], times)
        opening = np.flatnonzero(linked)
        columns, still = [words[opening], words[opening + 1]], np.ones(len(opening), bool)
        for size, first in _longer(linked, settings.longest):
            still = still & _marked(words, first, size, number, longer)[opening]
            columns.append(np.where(still, words[opening + size - 1], np.uint64(0)))
        columns, times = _added_up(columns)
        for low in range(0, len(times), 1 << 16):
            part = [column[low : low + (1 << 16)] for column in columns]
            yield _batch_of(lang, part, times[low : low + (1 << 16)])
        values, where = np.unique(pieces.hashes, return_index=True)
        where = where[np.isin(values, np.concatenate(columns[:2]))]
        new = [at for at in where.tolist() if (lang, int(pieces.hashes[at])) not in named]
        named.update((lang, int(value)) for value in pieces.hashes[new])
        if new:
            spelled = [word.decode("utf-8", "surrogatepass") for word in pieces.spelled(new)]
            none = np.zeros(len(new), np.uint64)
            hashes = pieces.hashes[new]
            yield _batch_of(lang, [hashes, none, none, none], np.zeros(len(new), np.int64), spelled)

    def each(row):
        pairs = _pair_names(row, settings, parts).chosen(row, "pairs")
        longer = _longer_names(row, settings, parts, pairs).chosen(row, "longer")
        named = set()
        for lang, pieces in _by_language(row, settings):
            yield from of_pieces(lang, pieces, pairs, longer, named)

    ddl = "lang string, w1 long, w2 long, w3 long, w4 long, times long, word string"
    return map_blocks(blocks, ddl, each, packed=True)


def phrase_counts(docs: DataFrame, settings: Settings, stage: StageArea) -> tuple[DataFrame, DataFrame]:
    """``lang, size, w1..w4, f`` for each language (size 0) and frequent phrase, and the words."""
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    blocks = in_blocks(texts, stage, "texts", settings.block_rows, settings.block_size)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = enough(_sent_pairs(blocks, settings, parts), "pairs", settings.least)
    blocks = blocks.join(stage.table(pairs, "pairs"), "block", "left")
    longer = enough(_sent_longer(blocks, settings, parts), "longer", settings.least)
    rows = _windows(blocks.join(stage.table(longer, "longer"), "block", "left"), settings, parts)
    top = rows.groupBy("lang", *_COLUMNS, "word").agg(F.sum("times").alias("times"))
    top = stage.table(top, "top-order", compression="zstd")
    windows = top.where(F.col("word").isNull())
    # GROUPING_ID tells a column that was summed over from one that is empty in a window.
    shorter = windows.rollup("lang", *_COLUMNS[:3]).agg(
        F.sum("times").alias("f"), F.grouping_id().alias("left_out")
    )
    shorter = shorter.where(F.col("left_out") < 15).select(
        "lang",
        *_COLUMNS[:3],
        F.lit(None).cast("long").alias("w4"),
        "f",
        (F.lit(3) - F.bit_count("left_out")).alias("size"),
    )
    longest = windows.select("lang", *_COLUMNS, F.col("times").alias("f"), F.lit(4).alias("size"))
    summed = shorter.union(longest)
    filled = [F.col(f"w{n}").isNotNull() | (F.col("size") < n) for n in range(1, 5)]
    whole = filled[0] & filled[1] & filled[2] & filled[3]
    kept = (F.col("size") == 0) | (F.col("f") >= settings.least)
    counts = stage.table(
        summed.where(whole & kept).select("lang", "size", *_COLUMNS, "f"), "phrases"
    )
    words = top.where(F.col("word").isNotNull()).groupBy("lang", F.col("w1").alias("hash")).agg(
        F.min("word").alias("word"), F.max("word").alias("other")
    )
    same = F.when(
        F.col("word") != F.col("other"), F.raise_error(F.lit("two words have one hash"))
    ).otherwise(F.col("word"))
    return counts, words.select("lang", "hash", same.alias("word"))


# --- scores -----------------------------------------------------------------------------------


def _key(columns: list[Column]) -> Column:
    """Some words in a row as one value."""
    return F.array(*columns)


def _scored(counts: DataFrame, settings: Settings) -> DataFrame:
    """``lang, phrase, size, a, l, r, score`` of the candidates by their lowest cut."""
    keyed = counts.where("size > 0").select(
        "lang", "size", F.filter(_key([F.col(name) for name in _COLUMNS]), F.isnotnull).alias("phrase"), "f"
    )
    candidates = keyed.where("size >= 2").withColumnRenamed("f", "a")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns(
        {
            "head": F.slice("phrase", 1, F.col("k")),
            "rest": F.slice("phrase", F.col("k") + 1, F.col("size") - F.col("k")),
        }
    )
    heads = keyed.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = keyed.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    wide = "decimal(38,0)"
    product = F.lit(settings.scale).cast(wide) * F.col("a").cast(wide)
    both = both.withColumn("product", product.cast(wide)).withColumn(
        "score", F.expr("product div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))")
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("lowest")
    found = both.groupBy("lang", "phrase", "size", "a").agg(lowest)
    return found.select("lang", "phrase", "size", "a", "lowest.l", "lowest.r", "lowest.score")


def _without_parts(scored: DataFrame, settings: Settings) -> DataFrame:
    """The candidates that no longer one accounts for."""
    inner = scored.where("size >= 3").select("lang", "phrase", "size", F.col("a").alias("longer"))
    inner = inner.withColumn("n", F.explode(F.expr("sequence(2, size - 1)")))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size - n + 1)")))
    inner = inner.select("lang", F.expr("slice(phrase, at, n)").alias("phrase"), "longer")
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = scored.join(most, ["lang", "phrase"], "left")
    wide = "cast({} as decimal(38,0))"
    covered = F.expr(
        f"100 * {wide.format('longer')} >= {settings.percent} * {wide.format('a')}"
    )
    return joined.where(~F.coalesce(covered, F.lit(False))).drop("longer")


def _spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases as text."""
    placed = found.select("lang", "phrase", F.posexplode("phrase").alias("place", "hash"))
    spelled = placed.join(words, ["lang", "hash"]).groupBy("lang", "phrase").agg(
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("all")
    )
    text = F.concat_ws(" ", F.transform("all", lambda one: one["word"]))
    spelled = spelled.select("lang", "phrase", text.alias("text"))
    return found.join(spelled, ["lang", "phrase"]).drop("phrase").withColumnRenamed("text", "phrase")


def collocations(
    docs: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best candidates."""
    settings = settings or Settings()
    stage = stage or StageArea(docs.sparkSession)
    counts, words = phrase_counts(docs, settings, stage)
    scored = stage.table(_scored(counts, settings), "scored")
    left = _spelled(_without_parts(scored, settings), words)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(settings.parts)).alias("part")
    first = left.select("*", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    )
    first = first.where(F.col("rank") <= settings.ranked)
    ranked = first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ).where(F.col("rank") <= settings.ranked)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
