"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece exactly one token can end its encoding.  It is the token whose
own prefix has a last token that may stand before it, and two tokens may be neighbours
exactly if the merges of their joined bytes give these two tokens again.  So a table of
last tokens is extended byte by byte, appended to without looking back further than the
longest token, and after an edit computed anew from the edited byte on.

The vocabulary is read on the driver and handed to the tasks (less than a megabyte).
Null texts count as empty: no tokens, and the digests of empty strings.  Rows are encoded
one by one; extra columns, ties, repeated rows and empty tables change nothing.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import cache, cached_property
from pathlib import Path

import ahocorasick
import regex
from pyspark.sql import DataFrame

from .common import map_each

# Distinct pieces whose tokens a task remembers, and the longest of them in bytes.
REMEMBERED = 400_000
REMEMBERED_BYTES = 64
_ODD_SPACE = re.compile(r"\s |[ ]\s|\A\s|\s\Z").search


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 bytes and a number."""
    split = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in split}


class Vocabulary:
    """Ranks by bytes, bytes by rank, and which tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.neighbours: dict[int, bool] = {}
        self.alone: set[int] = set()

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts joined last when merges build the token; None if none do."""
        if token in self._halves:
            return self._halves[token]
        parts, found = [token[i : i + 1] for i in range(len(token))], None
        while len(parts) > 1:
            joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
            ranks = [self.ranks.get(part, self.never) for part in joined]
            least = min(ranks)
            if least == self.never:
                break
            at = ranks.index(least)
            if len(parts) == 2:
                found = parts[0], parts[1]
            parts[at : at + 2] = [joined[at]]
        self._halves[token] = found
        return found

    never = 1 << 40

    def stands_alone(self, rank: int) -> bool:
        """Whether the merges of the token's own bytes give the token."""
        token = self.tokens[rank]
        if len(token) == 1 or self.halves(token) is not None:
            self.alone.add(rank)
        return rank in self.alone

    @cached_property
    def finder(self) -> ahocorasick.Automaton:
        """All tokens by the places where they end in a byte string, longest first."""
        automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        return automaton

    def may_follow(self, left: int, right: int) -> bool:
        known = self.neighbours.get(left << 32 | right)
        if known is None:
            if len(self.neighbours) > REMEMBERED:
                self.neighbours.clear()
            one, two = self.tokens[left], self.tokens[right]
            known = self.stands_alone(right) and self._stay_apart(one, two)
            self.neighbours[left << 32 | right] = known
        return known

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border between two tokens.

        The merges are followed backwards.  What touches the border at some time are an
        end of the left token and a beginning of the right one; the later built of the
        two is taken apart next.  Joining them would have come first if its rank is
        below that of the merge which ended that time; at equal ranks the merge further
        left comes first.
        """
        ranks, ends = self.ranks, self.never
        crossing_wins_ties = True
        while True:
            crossing = ranks.get(left + right, self.never)
            if crossing < ends or crossing == ends != self.never and crossing_wins_ties:
                return False
            built_left = ranks[left] if len(left) > 1 else -1
            built_right = ranks[right] if len(right) > 1 else -1
            if built_left < 0 and built_right < 0:
                return True
            if built_left > built_right:
                # Ties with a merge inside the left token: that one stands further left.
                ends, left, crossing_wins_ties = built_left, self.halves(left)[1], False
            else:
                ends, right, crossing_wins_ties = built_right, self.halves(right)[0], True


class PrefixTable:
    """The last token of each prefix of a byte string, kept through appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend by bytes; entries of earlier prefixes never change."""
        vocabulary, last = self.vocabulary, self.last
        lengths, known, alone = vocabulary.lengths, vocabulary.neighbours.get, vocabulary.alone
        done = len(last)
        start = max(0, done - vocabulary.longest)
        self.data += more
        recent = self.data[start:] if start else self.data
        for place, token in vocabulary.finder.iter(recent.decode("latin-1")):
            end = start + place
            if end < done:
                continue
            before = end - lengths[token]
            if before < 0:
                if token not in alone and not vocabulary.stands_alone(token):
                    continue
            else:
                fits = known(last[before] << 32 | token)
                if fits is None:
                    fits = vocabulary.may_follow(last[before], token)
                if not fits:
                    continue
            last.append(token)
            done += 1
        if done < len(self.data):
            raise ValueError(f"no token ends at byte {done} of {self.data!r}")

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in the place of the bytes from start to end."""
        rest = self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new + rest)

    def tokens(self) -> list[int]:
        """The encoding, read backwards from the last prefix."""
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end - 1])
            end -= self.vocabulary.lengths[found[-1]]
        return found[::-1]


class Encoder:
    """Texts to token ids and back, piece by piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pieces = regex.compile(pattern).findall
        self.space_begins = self.pieces("a b. c") == ["a", " b", ".", " c"]
        self._known: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    def piece_ids(self, piece: bytes) -> list[int]:
        """A piece that is itself a token is that token; others go through the table."""
        rank = self.vocabulary.ranks.get(piece)
        return [rank] if rank is not None else PrefixTable(self.vocabulary, piece).tokens()

    def _piece(self, piece: str) -> bytes:
        found = self._known.get(piece)
        if found is None:
            raw = piece.encode("utf-8", "replace")
            found = array("i", self.piece_ids(raw)).tobytes()
            if len(raw) <= REMEMBERED_BYTES:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[piece] = found
        return found

    def chunks(self, text: str) -> list[str]:
        """Parts of the text that the pattern splits independently of each other.

        A single space between two characters that are not white space begins a piece,
        whatever stands further off.  A text with other spaces is one part.
        """
        if not self.space_begins or _ODD_SPACE(text):
            return [text]
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]

    def encode(self, text: str) -> list[int]:
        known, packed = self._chunks, []
        for chunk in self.chunks(text):
            found = known.get(chunk)
            if found is None:
                found = b"".join(map(self._piece, self.pieces(chunk)))
                if len(chunk) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[chunk] = found
            packed.append(found)
        return array("i", b"".join(packed)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@cache
def _decimal(limit: int) -> list[str]:
    return list(map(str, range(limit)))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """The worker's encoder for a vocabulary, so that tasks share what it remembers."""
    key = hashlib.sha256(vocabulary).hexdigest(), pattern
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(vocabulary), pattern)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, text, ids, decoded`` for each document; ``decoded`` is bytes."""
    lines = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def make():
        encoder = _encoder(lines.value, pattern)

        def each(doc_id, text):
            ids = encoder.encode(text or "")
            return doc_id, text, ids, encoder.decode(ids)

        return each

    ddl = "doc_id long, text string, ids array<int>, decoded binary"
    return map_each(docs.select("doc_id", "text"), ddl, make)


def encoding_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes, made where texts are encoded."""
    lines = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def make():
        encoder = _encoder(lines.value, pattern)
        decimal = _decimal(max(encoder.vocabulary.tokens, default=0) + 1)

        def each(doc_id, text):
            ids = encoder.encode(text or "")
            listed = ",".join(map(decimal.__getitem__, ids))
            return (
                doc_id,
                len(ids),
                hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(encoder.decode(ids)).hexdigest(),
            )

        return each

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_each(docs.select("doc_id", "text"), ddl, make)
