"""Removal of long word passages that stand more than once, by recompression.

Words become symbols, and rounds replace runs of one symbol and pairs of neighbours by new
symbols.  Which neighbours make a pair is decided by a side that each symbol has in each
round (a left one followed by a right one), so equal passages are parsed alike wherever
they stand, but for a few symbols at their ends.  A name is a fingerprint of what it stands
for, so every task gives a pair the same name without a dictionary; what needs the whole
corpus, namely which names stand more than once, are three Spark rounds:

1. *Reveal.*  After a few rounds each symbol covers some words, and its context is known: the
   words that decided how it was parsed.  A window that holds the whole context of a symbol
   standing once in the corpus cannot stand twice.  This leaves few windows besides those
   that do.  (Names are taken by a digit of their hash, the same ones everywhere; leaving
   some out costs windows to count, never a result.)
2. *Verify.*  The windows left are parsed up to the top.  A name of at least ``length`` words
   that stands twice proves all windows inside it, with a second fingerprint of the words
   against collisions.  Copies of whole documents end here, one row for each of their names.
3. *Edges.*  The windows that no shared name holds are counted by two 64-bit fingerprints of
   their words; each shared name adds its windows once, from one of its places.

Neighbouring rows make a block.  The texts are moved once, into blocks, and joined to what is
found about them without a shuffle; a block counts its names by itself first, so a name
that stands in a third of all documents is one row for each block.

Null texts and texts without words have no words; they and texts below ``length`` words lose
nothing.  Rows are never joined by id: null, repeated or tied ids each keep their row.  Extra
columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ..sources.staging import StageArea
from .blocks import COUNTED, column, counts, frequent, in_blocks, map_blocks, numbers, places_among, together
from .words import MASK, RUN, hashed_words, mixed


@dataclass(frozen=True)
class Settings:
    length: int = 35
    # Rounds before the reveal; more of them make longer symbols with longer contexts.
    low_rounds: int = 4
    # One name of so many is counted at the reveal.
    sampled: int = 2
    high_rounds: int = 60
    # Texts of a block, and their characters, if they are more than one.
    block_rows: int = 8_192
    block_size: int = 4 << 20
    # Characters of the texts that are parsed together, if they are more than one.
    together: int = 1 << 21


# --- words -------------------------------------------------------------------------------


class Piece:
    """Some texts as one row of words, with a gap before, between and after them."""

    def __init__(self, texts: list[str | None]):
        self.texts = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        at, first, second = hashed_words(b" ".join(self.texts))
        ends = np.cumsum([len(text) + 1 for text in self.texts])
        upto = np.searchsorted(at, ends)
        self.sizes = np.diff(upto, prepend=0)
        self.starts = np.cumsum(np.concatenate([[1], self.sizes + 1]))[:-1]
        self.total = len(at) + len(texts) + 1
        places = np.arange(len(at)) + np.repeat(np.arange(1, len(texts) + 1), self.sizes)
        self.first, self.second = np.zeros(self.total, np.uint64), np.zeros(self.total, np.uint64)
        self.first[places], self.second[places] = first, second

    def windows(self, length: int) -> np.ndarray:
        """For each place, whether a window starts there."""
        change = np.zeros(self.total + 1, np.int64)
        some = self.sizes >= length
        np.add.at(change, self.starts[some], 1)
        np.add.at(change, (self.starts + self.sizes)[some] - length + 1, -1)
        return np.cumsum(change)[:-1] > 0


# --- rounds ------------------------------------------------------------------------------


class Parse:
    """Symbols of a piece: names, words ``[start, end)``, and contexts ``[low, high)``.

    The gap between texts is the symbol 0, which joins nothing; a context that reaches it
    lies in no window.  Contexts rise with their symbols, so those of a group are the
    first one's low and the last one's high.
    """

    def __init__(self, symbols: np.ndarray):
        place = np.arange(len(symbols), dtype=np.int64)
        self.names = symbols
        self.start, self.end = place, place + 1
        self.low, self.high = place, place + 1

    def keep(self, mask: np.ndarray) -> None:
        """Leave out the symbols of whole texts."""
        self.names = self.names[mask]
        self._grouped(*(np.flatnonzero(mask),) * 4)

    def _grouped(self, first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.start, self.end = self.start[first], self.end[last]
        self.low, self.high = self.low[low], self.high[high]

    def name_runs(self) -> None:
        """A maximal run of one symbol becomes a symbol; both neighbours decide on it."""
        names = self.names
        opens = np.ones(len(names), bool)
        opens[1:] = (names[1:] != names[:-1]) | (names[1:] == 0)
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(names)) - 1
        times = last - first + 1
        runs = names[first]
        again = times > 1
        runs[again] = mixed(runs[again] ^ (times[again].astype(np.uint64) * np.uint64(RUN))) | np.uint64(1)
        self.names = runs
        self._grouped(first, last, np.maximum(first - 1, 0), np.minimum(last + 1, len(names) - 1))

    def name_pairs(self, turn: int) -> None:
        """A left symbol and the right one after it become a symbol."""
        names = self.names
        salt = np.uint64((2 * turn + 1) * RUN & MASK)
        side = (mixed(names + salt) >> np.uint64(63)).astype(bool)
        left, right = side & (names != 0), ~side & (names != 0)
        joined = np.zeros(len(names), bool)
        joined[:-1] = left[:-1] & right[1:]
        taken = np.zeros(len(names), bool)
        taken[1:] = joined[:-1]
        first = np.flatnonzero(~taken)
        pair = joined[first]
        last = first + pair
        # A pair is decided by itself, a lone left symbol by the next, a lone right one by
        # the one before.
        low = np.where(~pair & right[first], np.maximum(first - 1, 0), first)
        high = np.where(~pair & left[first], np.minimum(first + 1, len(names) - 1), last)
        new = names[first]
        new[pair] = mixed(mixed(new[pair]) + names[last[pair]]) | np.uint64(1)
        self.names = new
        self._grouped(first, last, low, high)


def low_parse(piece: Piece, settings: Settings) -> Parse:
    """The symbols of the reveal: runs of words, then pairs."""
    parse = Parse(piece.first)
    parse.name_runs()
    for turn in range(settings.low_rounds):
        parse.name_pairs(turn)
    return parse


def _chosen(parse: Parse, settings: Settings) -> np.ndarray:
    digit = (parse.names >> np.uint64(7)) % np.uint64(settings.sampled)
    short = parse.high - parse.low <= settings.length
    return (parse.names != 0) & short & (digit == 0)


def _revealed(names: np.ndarray) -> np.ndarray:
    """Five bytes of a name: a collision only makes a symbol look shared."""
    return (names >> np.uint64(24)).view(np.int64)


def open_windows(piece: Piece, shared: np.ndarray, settings: Settings) -> tuple[np.ndarray, Parse]:
    """Whether a window that may stand twice starts at each place; ``shared`` is sorted."""
    parse = low_parse(piece, settings)
    chosen = np.flatnonzero(_chosen(parse, settings))
    names = _revealed(parse.names[chosen])
    if len(shared):
        place = np.minimum(np.searchsorted(shared, names), len(shared) - 1)
        chosen = chosen[shared[place] != names]
    # Windows from high - length to low hold the context.
    change = np.zeros(piece.total + 1, np.int64)
    np.add.at(change, np.maximum(parse.high[chosen] - settings.length, 0), 1)
    np.add.at(change, parse.low[chosen] + 1, -1)
    return piece.windows(settings.length) & (np.cumsum(change)[:-1] == 0), parse


def long_names(piece: Piece, parse: Parse, found: np.ndarray, settings: Settings):
    """``name, check, start, end`` of the symbols with an open window, up to the top."""
    before = np.concatenate([[0], np.cumsum(found)])
    sums = Fingerprints(piece.second)
    last = piece.starts + piece.sizes
    with_open = before[last] > before[piece.starts]
    wanted = np.repeat(np.append(with_open, False), np.append(piece.sizes + 1, 0))
    parse.keep((parse.names == 0) | np.concatenate([[False], wanted])[parse.start])
    done = int((parse.names == 0).sum() + with_open.sum())
    parts = []
    for turn in range(settings.high_rounds):
        if turn:
            parse.name_runs()
            parse.name_pairs(settings.low_rounds + turn)
        sized = np.flatnonzero(parse.end - parse.start >= settings.length)
        inside = before[parse.end[sized] - settings.length + 1] - before[parse.start[sized]]
        sized = sized[(inside > 0) & (parse.names[sized] != 0)]
        if len(sized):
            start, end = parse.start[sized], parse.end[sized]
            parts.append((parse.names[sized].view(np.int64), sums.of(start, end), start, end))
        if len(parse.names) == done:
            break
    if not parts:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    names, checks, starts, ends = (np.concatenate(column) for column in zip(*parts, strict=True))
    # A symbol that a round left alone is listed once.
    _, once = np.unique(np.stack([names, starts]), axis=1, return_index=True)
    return names[once], checks[once], starts[once], ends[once]


class Fingerprints:
    """Polynomial fingerprints of passages, from sums over prefixes, modulo 2^64."""

    base = 0x9E3779B97F4A7C15 | 5
    inverse = pow(base, -1, 1 << 64)

    def __init__(self, words: np.ndarray):
        terms = words * self._powers(self.base, len(words))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.back = self._powers(self.inverse, len(words) + 1)

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        found, have = np.ones(max(count, 1), np.uint64), 1
        while have < count:
            more = min(have, count - have)
            found[have : have + more] = found[:more] * np.uint64(pow(base, have, 1 << 64))
            have += more
        return found[:count]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        passage = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(passage + (end - start).astype(np.uint64)).view(np.int64)


# --- the rounds over blocks ------------------------------------------------------------------


def _low_names(blocks: DataFrame, settings: Settings) -> DataFrame:
    """The names of the reveal."""

    def each(row):
        texts = row["text"].as_py()
        parts = [np.empty(0, np.int64)]
        for low, high in together(texts, settings.together):
            parse = low_parse(Piece(texts[low:high]), settings)
            parts.append(_revealed(parse.names[_chosen(parse, settings)]))
        names = np.concatenate(parts)
        nothing, once = np.zeros(len(names), np.int64), np.ones(len(names), np.int64)
        yield counts(row["block"].as_py(), names, nothing, once, 2)

    return map_blocks(blocks.select("block", "text"), COUNTED, each, packed=True)


def _revealed_blocks(blocks: DataFrame, settings: Settings) -> DataFrame:
    """Open windows of each block, as ranges of places, and the long names over them.

    Places count the words of all the block's texts, with one more after each text.
    """

    def each(row):
        texts = row["text"].as_py()
        shared = np.sort(column(row, "low", "a"))
        spans, names, offset = [], [], 0
        for low, high in together(texts, settings.together):
            piece = Piece(texts[low:high])
            found, parse = open_windows(piece, shared, settings)
            spans.append(_ranges(found) + offset)
            names.append(np.stack(long_names(piece, parse, found, settings)))
            names[-1][2:] += offset
            offset += piece.total - 1
        spans = np.concatenate(spans, axis=1)
        if spans.shape[1]:
            yield row["block"].as_py(), *spans.tolist(), *np.concatenate(names, axis=1).tolist()

    ddl = "block long, open_start array<int>, open_end array<int>, "
    ddl += "a array<long>, b array<long>, name_start array<int>, name_end array<int>"
    return map_blocks(blocks.select("block", "text", "low"), ddl, each)


def _ranges(mask: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
    return edges.reshape(-1, 2).T


def _filled(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places that lie in one of the ranges."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change)[:-1] > 0


def numbers(row: dict, name: str) -> np.ndarray:
    return row[name].values.to_numpy()


def _long_counts(revealed: DataFrame, settings: Settings) -> DataFrame:
    def each(row):
        a, b = numbers(row, "a"), numbers(row, "b")
        yield counts(row["block"].as_py(), a, b, np.ones(len(a), np.int64), 2)

    return map_blocks(revealed.select("block", "a", "b"), COUNTED, each, packed=True)


class Judged:
    """A block's windows: which a shared name proves, and which are left to count."""

    def __init__(self, row: dict, settings: Settings):
        self.texts = row["text"].as_py()
        self.sizes = [len((text or "").encode("utf-8", "surrogatepass").split()) for text in self.texts]
        self.starts = np.cumsum([1, *(size + 1 for size in self.sizes)])
        self.total, self.length = int(self.starts[-1]), settings.length
        found = places_among(
            numbers(row, "a"), numbers(row, "b"), column(row, "long", "a"), column(row, "long", "b")
        )
        starts, ends = numbers(row, "name_start"), numbers(row, "name_end") - settings.length + 1
        proving = giving = found >= 0
        if proving.any():
            giving = proving & column(row, "long", "first")[found]
        self.proved = _filled(self.total, starts[proving], ends[proving])
        self.giving = _filled(self.total, starts[giving], ends[giving])
        self.left = _filled(self.total, numbers(row, "open_start"), numbers(row, "open_end"))
        self.left &= ~self.proved

    def fingerprints(self, places: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Two fingerprints of the windows that start at the places, which rise."""
        a, b = np.empty(len(places), np.int64), np.empty(len(places), np.int64)
        for low, high in together(self.texts, settings.together):
            start = self.starts[low]
            some = slice(*np.searchsorted(places, [start, self.starts[high]]))
            if some.start == some.stop:
                continue
            piece = Piece(self.texts[low:high])
            at = places[some] - start + 1
            for lane, out in ((piece.first, a), (piece.second, b)):
                out[some] = Fingerprints(lane).of(at, at + settings.length)
        return a, b


def _window_counts(blocks: DataFrame, settings: Settings) -> DataFrame:
    """Windows that no shared name proves, and those of shared names from one place."""

    def each(row):
        judged = Judged(row, settings)
        places = np.flatnonzero(judged.left | judged.giving)
        times = np.where(judged.giving[places], 2, 1)
        yield counts(row["block"].as_py(), *judged.fingerprints(places, settings), times, 2)

    return map_blocks(blocks, COUNTED, each, packed=True)


def _judged(blocks: DataFrame, ddl: str, settings: Settings, row_of) -> DataFrame:
    """``row_of``'s results for each text, from its words and which of them go."""

    def each(row):
        ids = row["doc_id"].as_py()
        if not row["open_start"].is_valid:
            for doc_id, text in zip(ids, row["text"].as_py(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                yield row_of(doc_id, words, np.zeros(len(words), bool))
            return
        judged = Judged(row, settings)
        places = np.flatnonzero(judged.left)
        found = places_among(
            *judged.fingerprints(places, settings),
            *(column(row, "windows", name) for name in ("a", "b")),
        )
        starts = np.flatnonzero(judged.proved)
        starts = np.concatenate([starts, places[found >= 0]])
        gone = _filled(judged.total, starts, starts + settings.length)
        for doc_id, text, start, size in zip(
            ids, judged.texts, judged.starts.tolist(), judged.sizes, strict=False
        ):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            yield row_of(doc_id, words, gone[start : start + size])

    return map_blocks(blocks, ddl, each)


def _kept(words: list[bytes], gone: np.ndarray) -> bytes:
    if gone.any():
        words = [words[at] for at in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


def _with_findings(docs: DataFrame, settings: Settings | None, stage: StageArea | None, ddl, row_of):
    settings = settings or Settings()
    stage = stage or StageArea(docs.sparkSession)
    blocks = in_blocks(
        docs.select("doc_id", "text"), stage, "texts", settings.block_rows, settings.block_size
    )
    low = frequent(_low_names(blocks, settings), "low", 2)
    revealed = _revealed_blocks(blocks.join(low, "block", "left"), settings)
    revealed = stage.table(revealed, "revealed", compression="zstd")
    long = stage.table(frequent(_long_counts(revealed, settings), "long", 2), "long-names")
    opened = blocks.join(revealed, "block").join(long, "block", "left")
    windows = frequent(_window_counts(opened, settings), "windows", 2)
    everything = blocks.join(revealed, "block", "left").join(long, "block", "left")
    return _judged(everything.join(windows, "block", "left"), ddl, settings, row_of)


def deduplicated(
    docs: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """``doc_id, kept, n_words, n_removed``: each document's remaining words."""

    def row_of(doc_id, words, gone):
        kept = _kept(words, gone).decode("utf-8", "surrogatepass")
        return doc_id, kept, len(words), int(gone.sum())

    ddl = "doc_id long, kept string, n_words long, n_removed long"
    return _with_findings(docs, settings, stage, ddl, row_of)


def removal_digests(
    docs: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """Sizes and digest of what is left, made where the words are removed."""

    def row_of(doc_id, words, gone):
        digest = hashlib.sha256(_kept(words, gone)).hexdigest()
        return doc_id, len(words), int(gone.sum()), digest

    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_findings(docs, settings, stage, ddl, row_of)
