"""Personal data by weak supervision.

Fixed patterns give the base spans, which always stay.  Looser patterns give candidates
(addresses spelled out, numbers without a country code).  Three labelers vote on every base
and loose candidate: its form, gazetteers, and the words before it; a vote is for, against
or none.  Expectation-maximisation estimates how reliable the labelers are without any
label, and a logistic span classifier is trained on the posteriors.  Loose candidates that
it accepts become spans of the same kinds.

What is learned are counts of vote and feature combinations over all documents.  They are
counted in the tasks and summed, at most 324 rows, so the driver fits on a bounded table
whatever the size of the corpus.

Null texts count as empty.  Every pattern runs in time linear in the text.  Rows are
labelled one by one: ties, repeated rows, extra columns and empty tables change nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_each, map_rows, replace_texts

KINDS = ("email", "ip", "card", "phone")

# --- base spans ----------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits, so looking at run starts only is the same.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_DIGIT = re.compile(r"[0-9]").search


def _emails(text: str):
    """Each match has one @, with the run before it and a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            # The run before this @ is looked at once only.
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(digit), 10)) for digit in digits[-2::-2])
    return (odd + even) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Code point spans by kind, in order of their start."""
    found = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if not _DIGIT(text):
        return found
    for match in _IP(text):
        if all(map(_small, match.group().split("."))):
            found["ip"].append(match.span())
    for match in _CARD(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(match.span())
    if "+" in text:
        for match in _PHONE(text):
            if 9 <= sum(map(str.isdigit, match.group())) <= 15:
                found["phone"].append(match.span())
    return found


# --- candidates, votes and features ----------------------------------------------------

_SPELLED = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9_][\w.+-]{0,63} ?[\[(]? ?(?:at|AT|@) ?[\])]? ?"
    r"[A-Za-z0-9-]{1,63}(?: ?[\[(]? ?(?:dot|DOT) ?[\])]? ?[A-Za-z]{2,24}){1,4}(?![\w])"
)
_NATIONAL = re.compile(r"(?<![\w+.(-])\(?[2-9][0-9]{2}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![\w-])")
_SIX = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
# Fixed values of the gazetteers: endings of hosts, and words before personal data.
_ENDINGS = frozenset("com org net edu gov info de fr es uk eu io co at ch it nl".split())
_BEFORE = {
    "email": frozenset("mail email e-mail contact write correo kontakt courriel".split()),
    "ip": frozenset("ip host server address client adresse".split()),
    "card": frozenset("card visa mastercard credit payment karte carte tarjeta".split()),
    "phone": frozenset("phone call tel telephone mobile fax telefon téléfono".split()),
}
_AGAINST = frozenset("version isbn issn order serial doi page invoice section figure".split())
_WORDS = re.compile(r"[^\W\d_][\w-]*")


def loose_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found = {kind: [] for kind in KINDS}
    lowered = " dot " in text or "dot" in text or "DOT" in text
    if lowered:
        found["email"] = [match.span() for match in _SPELLED.finditer(text)]
    if _DIGIT(text):
        found["phone"] = [match.span() for match in _NATIONAL.finditer(text)]
        if ":" in text:
            found["ip"] = [match.span() for match in _SIX.finditer(text)]
    return found


def _form_vote(kind: str, span: str, before: str, after: str) -> int:
    """Against spans glued to other characters, for those of the usual length."""
    if before[-1:].isalnum() or after[:1].isalnum():
        return -1
    if kind in ("card", "phone"):
        return 1 if 10 <= len(_digits(span)) <= 19 else -1
    return 1 if 7 <= len(span) <= 64 else 0


def _gazetteer_vote(kind: str, span: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[ .)\]]", span)[-1].lower() in _ENDINGS else -1
    digits = _digits(span)
    if kind == "card":
        return 1 if digits[:1] in "3456" else -1
    if kind == "phone":
        return -1 if len(set(digits)) < 3 else 1
    return -1 if span.startswith(("0.", "127.", "255.")) else 1


def _context_vote(kind: str, before: str) -> int:
    words = {word.lower() for word in _WORDS.findall(before)[-4:]}
    return -1 if words & _AGAINST else int(bool(words & _BEFORE[kind]))


def candidate_key(text: str, kind: str, start: int, end: int, loose: bool) -> tuple:
    """Kind, whether a looser pattern found it, and the three votes."""
    span, before, after = text[start:end], text[max(0, start - 60) : start], text[end : end + 1]
    return (
        KINDS.index(kind),
        int(loose),
        _form_vote(kind, span, before, after),
        _gazetteer_vote(kind, span),
        _context_vote(kind, before),
        int(after[:1] in ("", " ", ".", ",", "\n")),
    )


def _candidates(text: str):
    """``(kind, start, end, loose)``; loose ones do not touch base spans."""
    base = base_spans(text)
    taken = sorted(chain(*base.values()))
    starts = [start for start, _ in taken]
    furthest = list(accumulate((end for _, end in taken), max))
    for kind, spans in base.items():
        yield from ((kind, start, end, False) for start, end in spans)
    for kind, spans in loose_spans(text).items():
        for start, end in spans:
            # Of the base spans that begin before its end, one may reach behind its start.
            before = bisect_left(starts, end)
            if not before or furthest[before - 1] <= start:
                yield kind, start, end, True


# --- learning --------------------------------------------------------------------------

KEY = ("kind", "loose", "form", "gazetteer", "context", "border")


def vote_counts(docs: DataFrame) -> DataFrame:
    """How often each combination of votes and features occurs, over all documents."""

    def make():
        def each(rows):
            counted = Counter()
            for (text,) in rows:
                text = text or ""
                counted.update(
                    candidate_key(text, *candidate) for candidate in _candidates(text)
                )
            yield from ((*key, number) for key, number in counted.items())

        return each

    ddl = ", ".join(f"{name} int" for name in KEY) + ", n long"
    return map_rows(docs.select("text"), ddl, make).groupBy(*KEY).agg(F.sum("n").alias("n"))


def estimate(keys: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each combination, by expectation-maximisation over the votes.

    Labelers start as slightly better than chance; counts are smoothed by one, so a
    labeler that never votes says nothing.
    """
    votes = keys[:, 2:5]
    prior, right = np.full(len(KINDS), 0.7), np.full((3, 2, 3), 1 / 3)
    right[:, 1] = (0.15, 0.25, 0.6)
    right[:, 0] = (0.5, 0.35, 0.15)
    posterior = np.zeros(len(keys))
    for _ in range(rounds):
        odds = np.log(prior[keys[:, 0]]) - np.log(1 - prior[keys[:, 0]])
        for labeler in range(3):
            column = votes[:, labeler] + 1
            odds += np.log(right[labeler, 1, column]) - np.log(right[labeler, 0, column])
        posterior = 1 / (1 + np.exp(-odds))
        for kind in range(len(KINDS)):
            of = keys[:, 0] == kind
            prior[kind] = (counts[of] @ posterior[of] + 7) / (counts[of].sum() + 10)
        for labeler in range(3):
            for state, weight in enumerate((1 - posterior, posterior)):
                share = np.array(
                    [(counts * weight)[votes[:, labeler] == vote - 1].sum() for vote in range(3)]
                )
                start = (0.5, 0.35, 0.15) if state == 0 else (0.15, 0.25, 0.6)
                right[labeler, state] = (share + 20 * np.asarray(start)) / (share.sum() + 20)
    return posterior


def _features(keys: np.ndarray) -> np.ndarray:
    kinds = np.eye(len(KINDS))[keys[:, 0]]
    return np.hstack([np.ones((len(keys), 1)), kinds, keys[:, 1:]])


def fit_classifier(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on the posteriors, by Newton's iterations."""
    rows, wanted = _features(keys), estimate(keys, counts)
    weight, ridge = np.zeros(rows.shape[1]), np.eye(rows.shape[1])
    scaled = counts / max(1.0, counts.sum()) * 1000
    for _ in range(30):
        guess = 1 / (1 + np.exp(-np.clip(rows @ weight, -30, 30)))
        slope = rows.T @ (scaled * (guess - wanted)) + weight
        bend = (rows * (scaled * guess * (1 - guess))[:, None]).T @ rows + ridge
        weight -= np.linalg.solve(bend, slope)
    return weight


def learn(docs: DataFrame) -> dict[tuple, bool]:
    """Which of the combinations that occur are personal data."""
    found = vote_counts(docs).orderBy(*KEY).collect()
    if not found:
        return {}
    keys = np.array([row[:-1] for row in found])
    weight = fit_classifier(keys, np.array([row[-1] for row in found], float))
    accepted = _features(keys) @ weight >= 0
    return {tuple(map(int, key)): bool(yes) for key, yes in zip(keys, accepted, strict=True)}


# --- applying --------------------------------------------------------------------------


def find_spans(text: str, accepted: dict[tuple, bool]) -> tuple[list, list]:
    """Base spans, and all spans, as ``(kind, start, end)`` by kind and start."""
    base, every = [], []
    for kind, start, end, loose in _candidates(text):
        if not loose:
            base.append((kind, start, end))
        elif not accepted.get(candidate_key(text, kind, start, end, loose), False):
            continue
        every.append((kind, start, end))

    def order(span):
        return KINDS.index(span[0]), span[1], span[2]

    return sorted(base, key=order), sorted(every, key=order)


def _listed(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of each document."""
    accepted = learn(docs)

    def make():
        def each(doc_id, text):
            base, every = find_spans(text or "", accepted)
            counts = Counter(kind for kind, _, _ in base)
            digest = hashlib.sha256(_listed(base).encode()).hexdigest()
            return doc_id, *(counts[kind] for kind in KINDS), digest, _listed(every)

        return each

    ddl = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    return map_each(
        docs.select("doc_id", "text"), ddl + "base_sha256 string, spans string", make
    )


def redact(text: str | None, accepted: dict[tuple, bool]) -> str | None:
    """The text with a mark in the place of each span; touching spans share the first's."""
    if not text:
        return text
    parts, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in find_spans(text, accepted)[1]):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced, and all their columns."""
    accepted = learn(docs)
    return replace_texts(docs, lambda: lambda text: redact(text, accepted))
