"""Removal of long strings that stand more than once, by sorted suffixes.

Every string of ``length`` bytes holds an anchor: the byte at which the hash of the next
``gram`` bytes is least.  Equal strings have it at the same place, so only suffixes that
start at anchors (one byte in 180) are ever compared, to the right of the anchor and, read
backwards, to the left of it.

1. Anchors whose whole context (as far as any string through them can reach) stands twice
   are settled by counting context digests; copies cost nothing more.
2. Contexts that differ are grouped by four parts of 309 bytes, one of which is in any
   string through the anchor.  Most contexts are alone in their groups and drop out.
3. In a group, suffixes are sorted by mergesort.  Two suffixes are compared by binary
   search for the longest equal prefix hash (polynomial, modulo 2^64); the order is checked
   on the bytes, and sorted by them should hashes have collided.  The common extensions of
   sorted neighbours give those of all.
4. A group above ``Settings.group`` members is not gathered: the names of its strings are
   counted by blocks, and those that stand twice once more by digest.

Neighbouring texts make a block.  Texts are moved once, into blocks, and joined to what is
found about them without a shuffle; a block counts its contexts and parts by itself first.
Rows keep their places, so nothing depends on document ids: null, repeated or tied ids each
get the result of their text.  Null texts count as empty, texts below ``length`` bytes lose
nothing.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .blocks import COUNTED, NAME_BITS, SENT, Names, among, column, counts, enough, frequent
from .blocks import in_blocks, map_blocks, numbers, places_among
from .common import map_each, map_rows


@dataclass(frozen=True)
class Settings:
    length: int = 400
    gram: int = 32
    bands: int = 4
    group: int = 2000
    # Groups up to this size compare sorted members with each other directly.
    small: int = 16
    # Texts of a block, and their characters, if they are more than one.
    block_rows: int = 8_192
    block_size: int = 4 << 20

    @property
    def most_left(self) -> int:
        """Bytes before an anchor that a string through it can reach."""
        return self.length - self.gram

    def band(self, number: int) -> tuple[int, int]:
        """Distances from a string's start to its anchor that belong to a band."""
        step = -(-(self.most_left + 1) // self.bands)
        return number * step, min(self.most_left + 1, (number + 1) * step)


# --- prefix hashes and anchors ---------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as needed so far."""

    def __init__(self):
        self.count = 0

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > self.count:
            self.count = 2 * count
            inverse = pow(_BASE, -1, 1 << 64)
            self.tables = tuple(self._table(base) for base in (_BASE, inverse))
        return self.tables[0][:count], self.tables[1][:count]

    def _table(self, base: int) -> np.ndarray:
        found, have = np.ones(self.count, np.uint64), 1
        while have < self.count:
            more = min(have, self.count - have)
            found[have : have + more] = found[:more] * np.uint64(pow(base, have, 1 << 64))
            have += more
        return found


_POWERS = Powers()


def prefix_hashes(data: bytes) -> np.ndarray:
    """Polynomial hash of every prefix; entry ``n`` is that of the first ``n`` bytes."""
    powers, _ = _POWERS.upto(len(data) + 1)
    found = np.zeros(len(data) + 1, np.uint64)
    terms = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[:-1]
    np.cumsum(terms, out=found[1:])
    return found


def _sliding(values: np.ndarray, width: int, best: np.ufunc, filler: int) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, from runs within fixed blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, filler, values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = best.accumulate(square, axis=1).ravel()
    behind = best.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return best(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: bytes, settings: Settings) -> np.ndarray:
    """Places with the least hash of some string of the length, in rising order."""
    if len(data) < settings.length:
        return np.empty(0, np.int64)
    sums = prefix_hashes(data)
    _, inverse = _POWERS.upto(len(sums))
    grams = (sums[settings.gram :] - sums[: -settings.gram]) * inverse[: -settings.gram]
    grams ^= grams >> np.uint64(33)
    grams *= np.uint64(0xFF51AFD7ED558CCD)
    grams ^= grams >> np.uint64(29)
    width = settings.length - settings.gram + 1
    least = _sliding(grams, width, np.minimum, _MASK)
    edge = np.zeros(width - 1, np.uint64)
    reached = _sliding(np.concatenate([edge, least, edge]), width, np.maximum, 0)
    return np.flatnonzero(reached == grams)


def _context(data: bytes, anchor: int, settings: Settings) -> tuple[int, bytes]:
    """Bytes before the anchor, and the context with them."""
    left = min(anchor, settings.most_left)
    return left, data[anchor - left : anchor + settings.length]


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _occurrences(blocks: DataFrame, settings: Settings) -> DataFrame:
    """A block's anchors as arrays: text, place, context digest ``a, b``, and the bands' parts.

    A part is 0 where the text ends inside of it.
    """
    bands = [settings.band(number) for number in range(settings.bands)]

    def each(row):
        numbers_, places, digests, parts = [], [], [], []
        for number, text in enumerate(row["text"].as_py()):
            data = _raw(text)
            for anchor in anchors(data, settings).tolist():
                left, context = _context(data, anchor, settings)
                numbers_.append(number)
                places.append(anchor)
                digests.append(xxhash.xxh3_128_digest(left.to_bytes(2, "big") + context))
                for low, high in bands:
                    end = anchor + settings.length - high + 1
                    if left >= low and end <= len(data):
                        part = xxhash.xxh3_64_intdigest(data[anchor - low : end], low)
                        parts.append((part or 1) - (1 << 63))
                    else:
                        parts.append(0)
        if places:
            a, b = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T.tolist()
            yield row["block"].as_py(), numbers_, places, a, b, parts

    ddl = "block long, number array<int>, at array<int>, a array<long>, b array<long>, "
    return map_blocks(blocks.select("block", "text"), ddl + "parts array<long>", each)


class Anchors:
    """A block's anchors, and what is known of their contexts."""

    def __init__(self, row: dict):
        self.number, self.at = numbers(row, "number"), numbers(row, "at")
        self.a, self.b = numbers(row, "a"), numbers(row, "b")
        known = [column(row, "contexts", name) for name in ("a", "b", "first")]
        found = places_among(self.a, self.b, *known[:2])
        self.repeated = found >= 0
        self.first = np.ones(len(found), bool)
        if self.repeated.any():
            self.first[self.repeated] = known[2][found[self.repeated]]

    def representatives(self) -> np.ndarray:
        """One anchor for each context, in the first block that has it."""
        order = np.lexsort((np.arange(len(self.a)), self.b, self.a))
        a, b = self.a[order], self.b[order]
        opens = np.ones(len(a), bool)
        opens[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return np.sort(order[opens & self.first[order]])


def _context_counts(places: DataFrame) -> DataFrame:
    def each(row):
        a, b = numbers(row, "a"), numbers(row, "b")
        yield counts(row["block"].as_py(), a, b, np.ones(len(a), np.int64), 2)

    return map_blocks(places.select("block", "a", "b"), COUNTED, each, packed=True)


class Parts:
    """The parts of a block's representatives: a row for each, a column for each band."""

    def __init__(self, row: dict, settings: Settings, ranges: int):
        self.anchors = Anchors(row)
        self.found = self.anchors.representatives()
        self.parts = numbers(row, "parts").reshape(-1, settings.bands)[self.found]
        bands = np.arange(1, settings.bands + 1, dtype=np.uint64) * np.uint64(_BASE)
        self.named = _names(self.parts.view(np.uint64) + bands)
        self.some = self.parts != 0
        self.names = Names(self.named[self.some], ranges)

    def among(self, row: dict, column: str) -> np.ndarray:
        """Which parts' names came back in that column."""
        return among(self.names.chosen(row, column), self.named) & self.some


def _names(hashes: np.ndarray) -> np.ndarray:
    """Hashes of 64 bits as names of blocks."""
    mixed = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return mixed >> np.uint64(64 - NAME_BITS)


def _sent_parts(placed: DataFrame, settings: Settings, ranges: int) -> DataFrame:
    """Distinct contexts with each part of a band."""
    most = settings.group + 1  # whether a group is larger is all that is asked

    def each(row):
        yield from Parts(row, settings, ranges).names.sent(row["block"].as_py(), most)

    return map_blocks(placed, SENT, each)


def _members(blocks: DataFrame, settings: Settings, ranges: int) -> DataFrame:
    """``part, band, context, before, bytes`` of contexts that share a part with a few.

    The bytes are those that a string of the band can reach.  ``context`` is the digest and
    the block, or empty where the context stands more than once and is settled by that.
    """

    def each(row):
        parts, texts, block = Parts(row, settings, ranges), row["text"], row["block"].as_py()
        anchors_, number, data = parts.anchors, -1, b""
        few = parts.among(row, "shared") & ~parts.among(row, "large")
        for place in np.flatnonzero(few.ravel()).tolist():
            anchor, band = int(parts.found[place // settings.bands]), place % settings.bands
            if anchors_.number[anchor] != number:
                number = int(anchors_.number[anchor])
                data = _raw(texts[number].as_py())
            low, high = settings.band(band)
            at = int(anchors_.at[anchor])
            before = min(at, high - 1)
            context = b""
            if not anchors_.repeated[anchor]:
                context = np.array([anchors_.a[anchor], anchors_.b[anchor], block], "<i8").tobytes()
            reached = data[at - before : at + settings.length - low]
            yield int(parts.parts[place // settings.bands, band]), band, context, before, reached

    ddl = "part long, band int, context binary, before int, bytes binary"
    return map_blocks(blocks, ddl, each)


# --- groups that are too large to sort ---------------------------------------------------


class Strings:
    """A block's strings through anchors whose part stands in too many contexts to be sorted.

    Their names are counted in all blocks; where a name stands twice, the digest decides.
    """

    def __init__(self, row: dict, settings: Settings, ranges: int):
        parts, self.settings = Parts(row, settings, ranges), settings
        place = np.flatnonzero(parts.among(row, "large").ravel())
        anchor, band = parts.found[place // settings.bands], place % settings.bands
        number, at = parts.anchors.number[anchor], parts.anchors.at[anchor]
        self.texts, names = [], [np.empty(0, np.uint64)]
        ends = [*np.flatnonzero(np.diff(number, prepend=-1)).tolist(), len(number)]
        for low, high in zip(ends, ends[1:], strict=False):
            data = _raw(row["text"][int(number[low])].as_py())
            starts = self._starts(len(data), at[low:high].tolist(), band[low:high].tolist())
            sums = prefix_hashes(data)
            _, inverse = _POWERS.upto(len(sums))
            hashes = (sums[starts + settings.length] - sums[starts]) * inverse[starts]
            self.texts.append((int(number[low]), data, starts))
            names.append(_names(hashes))
        self.named = names[1:]
        self.names = Names(np.concatenate(names), ranges)

    def _starts(self, size: int, places: list[int], bands: list[int]) -> np.ndarray:
        """Each start once, whichever anchors the string goes through."""
        found = np.zeros(size, bool)
        for at, band in zip(places, bands, strict=True):
            low, high = self.settings.band(band)
            found[max(0, at - high + 1) : min(at - low, size - self.settings.length) + 1] = True
        return np.flatnonzero(found)

    def digests(self, row: dict) -> tuple[np.ndarray, ...]:
        """Text, start and digest ``a, b`` of the strings whose names came back."""
        known = self.names.chosen(row, "strings")
        numbers_, starts, digests = [], [], []
        for (number, data, all_starts), names in zip(self.texts, self.named, strict=True):
            for start in all_starts[among(known, names)].tolist():
                numbers_.append(number)
                starts.append(start)
                digests.append(xxhash.xxh3_128_digest(data[start : start + self.settings.length]))
        a, b = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T
        return np.array(numbers_, np.int64), np.array(starts, np.int64), a, b


def _sent_strings(blocks: DataFrame, settings: Settings, ranges: int) -> DataFrame:
    def each(row):
        yield from Strings(row, settings, ranges).names.sent(row["block"].as_py(), 2)

    return map_blocks(blocks, SENT, each)


def _string_counts(blocks: DataFrame, settings: Settings, ranges: int) -> DataFrame:
    def each(row):
        _, _, a, b = Strings(row, settings, ranges).digests(row)
        yield counts(row["block"].as_py(), a, b, np.ones(len(a), np.int64), 2)

    return map_blocks(blocks, COUNTED, each, packed=True)


# --- sorted suffixes -------------------------------------------------------------------


def _common(one: list[int], two: list[int]) -> int:
    """Length of the longest common prefix, by binary search over prefix hashes."""
    low, high = 0, min(len(one), len(two)) - 1
    while low < high:
        middle = (low + high + 1) // 2
        if one[middle] == two[middle]:
            low = middle
        else:
            high = middle - 1
    return low


def sort_suffixes(suffixes: list[bytes]) -> tuple[list[int], list[int]]:
    """The suffixes' order, and what each has in common with the one before it."""
    hashes = [prefix_hashes(suffix).tolist() for suffix in suffixes]

    def compare(i: int, j: int) -> int:
        at = _common(hashes[i], hashes[j])
        one, two = suffixes[i][at : at + 1], suffixes[j][at : at + 1]
        return (one > two) - (one < two)

    order = sorted(range(len(suffixes)), key=cmp_to_key(compare))  # a mergesort
    common = [_common(hashes[i], hashes[j]) for i, j in zip(order, order[1:], strict=False)]
    for i, j, length in zip(order, order[1:], common, strict=False):
        one, two = suffixes[i], suffixes[j]
        if one[:length] != two[:length] or one[length : length + 1] > two[length : length + 1]:
            break
        if length < min(len(one), len(two)) and one[length] == two[length]:
            break
    else:
        return order, [0, *common]
    # Hashes collided: the bytes decide.
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    common = [0]
    for i, j in zip(order, order[1:], strict=False):
        pairs = zip(suffixes[i], suffixes[j], strict=False)
        limit = min(len(suffixes[i]), len(suffixes[j]))
        common.append(next((n for n, (a, b) in enumerate(pairs) if a != b), limit))
    return order, common


def _ranges_between(order: list[int], common: list[int]) -> dict[tuple[int, int], int]:
    """Common prefix of any two: the least one between them in the order."""
    found = {}
    for first in range(len(order)):
        least = 1 << 30
        for second in range(first + 1, len(order)):
            least = min(least, common[second])
            i, j = order[first], order[second]
            found[min(i, j), max(i, j)] = least
    return found


def reaches(members: list[tuple[int, bytes]], low: int, high: int, settings: Settings):
    """How far repeated strings through each member's anchor reach left and right.

    Strings start ``low`` to ``high - 1`` bytes before the anchor.  A pair of numbers for
    each member, or None where no string of the band stands in another member.
    """
    trimmed: dict[tuple[bytes, bytes], list[int]] = {}
    for member, (left, context) in enumerate(members):
        right = context[left : left + settings.length - low]
        trimmed.setdefault((context[max(0, left - high + 1) : left][::-1], right), []).append(member)
    lefts, rights = ([pair[side] for pair in trimmed] for side in range(2))
    most, least = _extremes(lefts, rights, low, high, settings)
    for place, same in enumerate(trimmed.values()):
        if len(same) > 1:
            # Members that agree in all the band can see share all of its strings.
            last = min(high - 1, len(lefts[place]))
            first = max(low, settings.length - len(rights[place]))
            if first <= last:
                most[place], least[place] = last, first
        if most[place] >= 0:
            for member in same:
                yield member, int(most[place]), settings.length - int(least[place])


def _extremes(lefts: list[bytes], rights: list[bytes], low: int, high: int, settings: Settings):
    """The most and least distances of a repeated string from its start, for each member."""
    most, least = [-1] * len(lefts), [high] * len(lefts)
    if len(lefts) < 2:
        return most, least
    by_right, by_left = sort_suffixes(rights), sort_suffixes(lefts)
    if len(lefts) <= settings.small:
        ahead, behind = _ranges_between(*by_right), _ranges_between(*by_left)
        for pair, right in ahead.items():
            first, last = max(low, settings.length - right), min(high - 1, behind[pair])
            if first <= last:
                for member in pair:
                    most[member] = max(most[member], last)
                    least[member] = min(least[member], first)
        return most, least
    order = [np.array(found[0]) for found in (by_right, by_left)]
    common = [np.array(found[1]) for found in (by_right, by_left)]
    most, least = np.array(most), np.array(least)
    right_sizes, left_sizes = (np.array(list(map(len, side))) for side in (rights, lefts))
    classes = [np.empty(len(lefts), np.int64) for _ in range(2)]
    # Classes and lengths change at a few distances only; those in between are one run.
    limits = np.concatenate(
        [settings.length - common[0], common[1] + 1, settings.length - right_sizes, left_sizes + 1]
    )
    starts_of_runs = np.unique(np.append(limits[(limits > low) & (limits < high)], low)).tolist()
    for distance, after in zip(starts_of_runs, [*starts_of_runs[1:], high], strict=True):
        for side, needed in enumerate((settings.length - distance, distance)):
            starts = common[side] < needed
            starts[0] = True
            classes[side][order[side]] = np.cumsum(starts)
        both = classes[0] * (len(lefts) + 1) + classes[1]
        _, place, times = np.unique(both, return_inverse=True, return_counts=True)
        found = (times[place] > 1) & (right_sizes >= settings.length - distance)
        found &= left_sizes >= distance
        most[found] = after - 1
        least[found & (least > distance)] = distance
    return most, least


# --- the operator ----------------------------------------------------------------------


def _sorted_reaches(members: DataFrame, settings: Settings) -> DataFrame:
    """``context, left, right`` from groups that fit into a task."""
    # One shuffle and sort bring a group's rows behind each other; nothing is collected.
    names = ("part", "band", "context", "before", "bytes")
    dealt = members.select(*names).repartition("part", "band")

    def make():
        def each(rows) -> Iterator[tuple]:
            for (_, band), group in groupby(rows, key=lambda row: row[:2]):
                group = list(group)
                contexts = [row[3:] for row in group]
                for member, left, right in reaches(contexts, *settings.band(band), settings):
                    yield group[member][2], left, right

        return each

    ddl = "context binary, left int, right int"
    return map_rows(dealt.sortWithinPartitions("part", "band"), ddl, make)


def _reaches(members: DataFrame, settings: Settings) -> DataFrame:
    """``block`` and, as an array, its contexts that stand once with how far they reach."""
    found = _sorted_reaches(members, settings)
    found = found.where(F.length("context") > 0).groupBy("context")
    found = found.agg(F.max("left").alias("left"), F.max("right").alias("right"))

    def make():
        def each(context, left, right):
            a, b, block = np.frombuffer(context, "<i8").tolist()
            return block, a, b, left, right

        return each

    reached = map_each(found, "block long, a long, b long, left int, right int", make)
    one = F.struct("a", "b", "left", "right")
    return reached.groupBy("block").agg(F.collect_list(one).alias("reaches"))


def remove_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal runs removed."""
    kept, at, runs, end = [], 0, 0, -1
    for start, stop in sorted(spans):
        stop = min(stop, len(data))
        if start > end:
            runs += 1
            kept.append(data[at:start])
        end = max(end, stop)
        at = max(at, stop)
    return b"".join([*kept, data[at:]]), runs


def deduplicated(docs: DataFrame, settings: Settings | None = None, stage=None) -> DataFrame:
    """``doc_id, kept, n_bytes, n_spans``: each document's remaining bytes."""
    return _with_spans(
        docs, settings, stage, "doc_id long, kept binary, n_bytes long, n_spans long",
        lambda doc_id, data, kept, runs: (doc_id, kept, len(data), runs),
    )


def removal_digests(docs: DataFrame, settings: Settings | None = None, stage=None) -> DataFrame:
    """Sizes and digest of what is left, made where the bytes are removed."""
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_spans(
        docs, settings, stage, ddl,
        lambda doc_id, data, kept, runs: (
            doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()
        ),
    )


def _spans(row: dict, settings: Settings, ranges: int) -> dict[int, list[tuple[int, int]]]:
    """What to remove of each text of a block, as starts and ends."""
    if not row["at"].is_valid:
        return {}
    found = Anchors(row)
    known = [column(row, "reaches", name) for name in ("a", "b", "left", "right")]
    places = places_among(found.a, found.b, *known[:2])
    # A context that stands twice goes as a whole; reaches end at the text's ends.
    left = np.where(found.repeated, settings.most_left, -1)
    right = np.where(found.repeated, settings.length, -1)
    some = (places >= 0) & ~found.repeated
    if some.any():
        left[some], right[some] = (side[places[some]] for side in known[2:])
    spans: dict[int, list[tuple[int, int]]] = {}
    some = left >= 0
    starts, ends = np.maximum(found.at - left, 0), found.at + right
    for number, start, end in zip(
        found.number[some].tolist(), starts[some].tolist(), ends[some].tolist(), strict=True
    ):
        spans.setdefault(number, []).append((start, end))
    number, start, a, b = Strings(row, settings, ranges).digests(row)
    repeated = places_among(a, b, *(column(row, "repeated", name) for name in "ab")) >= 0
    for number, start in zip(number[repeated].tolist(), start[repeated].tolist(), strict=True):
        spans.setdefault(number, []).append((start, start + settings.length))
    return spans


def _with_spans(docs, settings, stage, ddl: str, row_of) -> DataFrame:
    settings = settings or Settings()
    stage = stage or StageArea(docs.sparkSession)
    blocks = in_blocks(
        docs.select("doc_id", "text"), stage, "texts", settings.block_rows, settings.block_size
    )
    places = stage.bucketed(_occurrences(blocks, settings), "places", "block", compression="zstd")
    contexts = stage.table(frequent(_context_counts(places), "contexts", 2), "contexts")
    placed = places.join(contexts, "block", "left")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = stage.table(_sent_parts(placed, settings, ranges), "parts", compression="zstd")
    for name, least in (("shared", 2), ("large", settings.group + 1)):
        placed = placed.join(stage.table(enough(sent, name, least), name), "block", "left")
    stage.drop("parts")
    texts = blocks.select("block", "text").join(placed, "block")
    members = stage.table(_members(texts, settings, ranges), "members", compression="zstd")
    reaches = stage.table(_reaches(members, settings), "reaches")
    stage.drop("members")
    strings = stage.table(enough(_sent_strings(texts, settings, ranges), "strings", 2), "strings")
    counted = _string_counts(texts.join(strings, "block"), settings, ranges)
    repeated = stage.table(frequent(counted, "repeated", 2), "repeated")
    everything = blocks.join(placed, "block", "left")
    for found in (reaches, strings, repeated):
        everything = everything.join(found, "block", "left")

    def each(row):
        spans = _spans(row, settings, ranges)
        texts = zip(row["doc_id"].as_py(), row["text"].as_py(), strict=True)
        for number, (doc_id, text) in enumerate(texts):
            data = _raw(text)
            yield row_of(doc_id, data, *remove_spans(data, spans.get(number, [])))

    return map_blocks(everything, ddl, each)
