"""Quality rules: compression bands.

A text is compressed as a whole and in fixed chunks.  Ratios (compressed over raw bytes)
below a band mean repetition, ratios above it mean noise; the band depends on the length,
because short texts carry the frame and an untrained model.

Limits follow from what encodings and repetition give in any text, not from a table.  Base64
carries 6 bits in 8, so it cannot fall below 0.75 (0.74 in lines of 76, with the frame 0.75
and more); ordinary text, prose of dense scripts included, stays below 0.70 in 2 KB, and
prose above 0.40 (tables and lists may lie lower).  Where half a chunk repeats, its ratio halves.  Hexadecimal digits and symbols between
words lie where prose does, so ratios cannot tell them; and a run of less than two chunks
may share each of its chunks with prose and pass.

Null texts count as empty.  Texts without a full chunk are judged as a whole only.  Rows
are judged one by one, so ties, repeated rows and extra columns change nothing, and an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .common import filter_rows, map_each

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of the rules.

    ``whole`` has ``(bytes below which it holds, lowest ratio, highest ratio)`` in rising
    order, the last without a limit.  A full chunk is bad outside ``chunk_low`` to
    ``chunk_high``, the rest after the last one outside the limits of its length; a rest
    below ``least_rest`` says nothing and is judged with the chunk before.  A text fails if
    more than ``bad_chunks`` of its bytes lie in bad chunks.
    """

    level: int = 3
    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.25, 1.20),
        (512, 0.25, 0.84),
        (1024, 0.28, 0.77),
        (4096, 0.28, 0.72),
        (16384, 0.25, 0.70),
        (float("inf"), 0.20, 0.66),
    )
    chunk_bytes: int = 2048
    least_rest: int = 256
    chunk_low: float = 0.33
    chunk_high: float = 0.72
    bad_chunks: float = 0.2
    least_words: int = 50
    most_repeated_percent: int = 50


def _counts(text: str, raw: bytes) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated 3-word windows."""
    words = raw.split()  # bytes split at exactly the six characters of the word pattern
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    repeated_lines = len(lines) - len(set(lines))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words)
    )
    if len(ids) < 3:
        return len(words), len(text) - spaces, symbols, repeated_lines, 0
    # Two steps of pairing keep the number of a window below the square of the length.
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[place] > 1)
    covered = np.zeros(len(ids), bool)
    for step in range(3):
        covered[starts + step] = True
    return len(words), len(text) - spaces, symbols, repeated_lines, int(covered.sum())


class Judge:
    """Counts and verdict for one text; holds a compressor."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.packer = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)

    def ratio(self, raw: bytes) -> float:
        return len(self.packer.compress(raw)) / len(raw)

    def limits(self, size: int) -> tuple[float, float]:
        return next(band[1:] for band in self.bands.whole if size < band[0])

    def is_bad(self, part: bytes) -> bool:
        bands = self.bands
        full = len(part) >= bands.chunk_bytes
        low, high = (bands.chunk_low, bands.chunk_high) if full else self.limits(len(part))
        return not low <= self.ratio(part) <= high

    def ratios(self, raw: bytes) -> tuple[float, int, int, int]:
        """Ratio of the whole, number of chunks, number of bad ones, bytes in bad ones."""
        step, size = self.bands.chunk_bytes, len(raw)
        starts = list(range(0, size, step)) if size >= step else []
        if starts and size - starts[-1] < self.bands.least_rest:
            starts.pop()
        ends = [*starts[1:], size]
        bad = [end - at for at, end in zip(starts, ends) if self.is_bad(raw[at:end])]
        return self.ratio(raw) if raw else 0.0, len(starts), len(bad), sum(bad)

    def in_bands(self, size: int, whole: float, chunks: int, bad: int, bad_bytes: int) -> bool:
        low, high = self.limits(size)
        return low <= whole <= high and bad_bytes <= self.bands.bad_chunks * size

    def __call__(self, text: str | None) -> tuple:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words, chars, symbols, lines, repeated = _counts(text, raw)
        bands = self.bands
        failed = (
            words < bands.least_words or 100 * repeated > bands.most_repeated_percent * words
        )
        whole, chunks, bad, bad_bytes = self.ratios(raw)
        kept = not failed and self.in_bands(len(raw), whole, chunks, bad, bad_bytes)
        return words, chars, symbols, lines, repeated, failed, kept, whole, chunks, bad


RULE_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def compression_rules(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """Counts, ratios and verdict for each document, by ``doc_id``."""
    bands = bands or Bands()

    def make():
        judge = Judge(bands)
        return lambda doc_id, text: (doc_id, *judge(text))

    return map_each(docs.select("doc_id", "text"), f"doc_id long, {RULE_COLUMNS}", make)


def keep_compressible(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The documents that pass, with all their columns."""
    bands = bands or Bands()

    def make():
        judge = Judge(bands)
        return lambda text: judge(text)[6]

    return filter_rows(docs, "text", make)
