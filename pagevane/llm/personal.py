"""Personal data: fixed rules, and a semi-Markov conditional random field that adds spans.

The rules give the base spans. The field then looks at candidate segments of the whole text,
spans of characters that could be an address, a number or a phone written in another way
(``jo at mail dot org``, ``4111.1111...``, a phone without ``+``). Whole-span features score
each segment for each kind: the count of digits and groups, separators, a passed check sum, parts in
range, the words before it. Segments that aren't named by a kind are outside, at score 0, so that
the best segmentation is found by a dynamic programme over the candidates, bounded by their
length, which chooses boundaries and kinds together. Base spans are fixed segments in it.

The weights are trained by the likelihood of segmentations on a bounded sample of documents, whose
base spans, also rewritten in the other ways, are the examples; near misses are the counterexamples.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind; code points

# --- base spans ----------------------------------------------------------------------
# The patterns are those of the rules, written so that no text makes them quadratic: where a
# match can only begin at the start of a run, a look behind says so, and runs are possessive.

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_SIGNS = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end(), "email"))
            done = found.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)
    return out


def _fits(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    digits = _digits(s)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules, by start, then kind as listed."""
    out = _emails(text)
    if _DIGITS.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if _fits(kind, m[0])]
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# --- candidate segments and their features -------------------------------------------

# Spelt-out separators of addresses, and groups of digits with single separators.
_AT = r"(?: ?[\[({] ?(?:at|AT|@) ?[\])}] ?| (?:at|AT) | @ | ?＠ ?)"
_DOT = r"(?: ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?| (?:dot|DOT) )"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SPELT = re.compile(rf"(?<=[A-Za-z0-9._%+-]){_AT}(?={_LABEL}(?:{_DOT}|\.){_LABEL})")
_FIRST = re.compile(_LABEL)
_NEXT = re.compile(rf"(?:{_DOT}|\.){_LABEL}")
_PARTED = frozenset("._%+-")
# The standards' longest local part and host name.
_LOCAL_LENGTH, _HOST_LENGTH = 64, 253
_SPELT_SIGN = re.compile(r"\b(?:at|AT)\b|＠|@")
_GROUP = re.compile(r"[0-9]+")
_GAP = re.compile(r"[ ().:,/_\[\]-]{1,3}")  # between two groups of a segment
_NUMERALS = frozenset("0123456789")
_LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LONGEST = 64  # characters of a segment of digits
_CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
}


def candidates(text: str) -> list[tuple[int, int]]:
    """Segments that could be personal data, by start; all parts of groups within a number."""
    return sorted({*_spelt(text), *_parts(text, [], None)})


def _spelt(text: str) -> Iterator[tuple[int, int]]:
    """Spelt-out addresses: from each part of what stands before the sign to each label from the second on."""
    if not _SPELT_SIGN.search(text):
        return
    for sign in _SPELT.finditer(text):
        at = sign.start()
        first = at
        while first and at - first < _LOCAL_LENGTH and text[first - 1] in _LOCAL:
            first -= 1
        starts = [s for s in range(first, at) if s == first or (text[s - 1] in _PARTED and text[s] not in _PARTED)]
        end = _FIRST.match(text, sign.end()).end()
        while (label := _NEXT.match(text, end)) and label.end() - sign.end() <= _HOST_LENGTH:
            end = label.end()
            if end == len(text) or not (text[end] in _LETTER or text[end] in _NUMERALS or text[end] == "-"):
                yield from ((s, end) for s in starts)


def _parts(
    text: str, taken: list[tuple[int, int]], worth: Callable[[int, int, frozenset[str]], bool] | None
) -> Iterator[tuple[int, int]]:
    """Each one or more neighbouring groups of digits within ``_LONGEST`` characters, by start.

    Those that overlap one of ``taken`` (disjoint, sorted), and those whose number of digits and groups
    and separators ``worth`` rules out, are left out. A sign or bracket in front makes another one.
    """
    if not _DIGITS.search(text):
        return
    groups = [m.span() for m in _GROUP.finditer(text)]
    at = 0
    for i, (s, first) in enumerate(groups):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        limit = taken[at][0] if at < len(taken) else len(text)
        starts = [s] if s == 0 or text[s - 1] not in _LETTER else []
        if s and text[s - 1] in "+(" and not (s > 1 and (text[s - 2] in _LETTER or text[s - 2] in _NUMERALS)):
            if not at or taken[at - 1][1] < s:
                starts.append(s - 1)
        if not starts:
            continue
        digits, end, inside = 0, s, frozenset()
        for j in range(i, len(groups)):
            b, e = groups[j]
            if e > limit or e - s > _LONGEST or (j > i and (b - end > 3 or not _GAP.fullmatch(text, end, b))):
                break
            if not inside.issuperset(text[end:b]):
                inside = inside.union(text[end:b])
            digits, end = digits + e - b, e
            if worth and not worth(digits, j - i + 1, inside):
                continue
            if e == len(text) or text[e] not in _LETTER:
                yield from ((a, e) for a in starts if e - a <= _LONGEST)


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    """Names of the whole-span features that hold, each for one kind."""
    shape, before = _shape(text, start, end), _before(text, start)
    return [f"{kind}:{f}" for f in shape + ["cue"] * any(cue in before for cue in _CUES[kind])]


def _before(text: str, start: int) -> str:
    return text[max(0, start - 24) : start].lower()


def _shape(text: str, start: int, end: int) -> list[str]:
    """The features that are the same for each kind."""
    s = text[start:end]
    digits = _digits(s)
    groups = [g for g in re.split(r"[^0-9]+", s) if g]
    out = ["bias", f"digits{min(len(digits), 20)}", f"groups{min(len(groups), 8)}"]
    letters = any(c.isalpha() for c in s)
    out.append("letters" if letters else "noletters")
    if letters:
        parts = re.split(_AT, s, maxsplit=1)
        spelt = len(parts) == 2
        out.append("spelt" if spelt else "unspelt")
        ends = re.split(rf"{_DOT}|\.", parts[-1])
        out.append("suffix" if len(ends) > 1 and 2 <= len(ends[-1]) <= 6 and ends[-1].isalpha() else "nosuffix")
        # Where it could begin or end otherwise: in the middle of a name, before a further label, at a new sentence.
        out.append("cut" if start and (text[start - 1] in _PARTED or text[start - 1] in _LETTER) else "uncut")
        further = _NEXT.match(text, end)
        word = further and re.search(rf"{_LABEL}\Z", further[0])[0]
        out.append("ends" if not word else "sentence" if word[0].isupper() else "goes on")
        out.append("capital" if ends[-1][:1].isupper() and not ends[0][:1].isupper() else "nocapital")
        out.append(f"labels{min(len(ends), 6)}")
        dots = {x.strip() for x in re.findall(rf"{_DOT}|\.", parts[-1])}
        out.append("unlike dots" if len(dots) > 1 else "like dots")
        marked = re.search(r"[\[({＠@]|\b(?:dot|DOT)\b", s) is not None
        out.append("marked" if marked else "unmarked")
    else:
        inside = {c for c in s if not c.isdigit()}
        out += [f"sep{c}" for c in sorted(inside)]
        out.append("mixed" if len(inside - set("+()")) > 1 else "plain")
        out.append(f"lead{s[0]}" if s[0] in "+(" else "lead")
        four = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
        out.append("octets" if four else "nooctets")
        card = 14 <= len(digits) <= 19
        out.append("luhn" if card and luhn(digits) else "noluhn")
        out.append("even" if len({len(g) for g in groups[:-1]} or {0}) == 1 else "uneven")
        if len(digits) >= 10:
            out.append("tenplus")
    return out


# --- the semi-Markov field -----------------------------------------------------------

Weights = dict[str, float]


def _score(weights: Weights, text: str, start: int, end: int, kind: str) -> float:
    return sum(weights.get(f, 0.0) for f in features(text, start, end, kind))


def _scores(weights: Weights, text: str, start: int, end: int) -> list[tuple[str, float]]:
    """Each kind with its score."""
    shape, before = _shape(text, start, end), _before(text, start)
    out = []
    for kind in KINDS:
        score = sum(weights.get(f"{kind}:{f}", 0.0) for f in shape)
        out.append((kind, score + weights.get(f"{kind}:cue", 0.0) * any(cue in before for cue in _CUES[kind])))
    return out


class _Worth:
    """Whether a segment of so many digits and groups, with these separators, can score above 0 at all.

    By upper bounds, so that what it rules out is no option whatever its groups and the words before.
    """

    def __init__(self, weights: Weights):
        self.weights = weights
        self.known: dict[tuple[int, int, frozenset[str]], bool] = {}

    def __call__(self, digits: int, groups: int, inside: frozenset[str]) -> bool:
        key = (min(digits, 20), min(groups, 8), inside)
        if key not in self.known:
            self.known[key] = any(self._most(k, *key) > 1e-12 for k in KINDS)
        return self.known[key]

    def _most(self, kind: str, digits: int, groups: int, inside: frozenset[str]) -> float:
        w = lambda f: self.weights.get(f"{kind}:{f}", 0.0)
        total = w("bias") + w(f"digits{digits}") + w(f"groups{groups}") + w("noletters") + w("tenplus") * (digits >= 10)
        total += max(w("octets"), w("nooctets")) if groups == 4 else w("nooctets")
        total += max(w("luhn"), w("noluhn")) if 14 <= digits <= 19 else w("noluhn")
        total += w("mixed") if len(inside - set("+()")) > 1 else w("plain")
        total += max(w("even"), w("uneven")) + max(0.0, w("cue")) + sum(w(f"sep{c}") for c in inside)
        return total + max(w("lead"), *(w(f"lead{c}") + w(f"sep{c}") * (c not in inside) for c in "+("))


_known: _Worth | None = None  # of the weights used last


def segment(text: str, fixed: list[Span], weights: Weights) -> list[Span]:
    """The added spans of the best segmentation: none overlaps another or a fixed span."""
    global _known
    if _known is None or _known.weights is not weights:
        _known = _Worth(weights)
    taken: list[tuple[int, int]] = []
    for s, e, _ in sorted(fixed):
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    spelt = []
    for s, e in _spelt(text):
        after = bisect_right(taken, s, key=lambda t: t[1])
        if after == len(taken) or taken[after][0] >= e:
            spelt.append((s, e))
    options: list[tuple[int, int, str, float]] = []
    for s, e in sorted({*spelt, *_parts(text, taken, _known)}):
        kind, score = max(_scores(weights, text, s, e), key=lambda x: x[1])
        if score > 0:
            options.append((s, e, kind, score))
    options.sort(key=lambda o: (o[1], o[0]))
    # best[i]: of segments that end at the i-th end or before.
    ends: list[int] = [0]
    best: list[tuple[float, tuple | None, int]] = [(0.0, None, -1)]
    for s, e, kind, score in options:
        before = bisect_right(ends, s) - 1
        total = best[before][0] + score
        if total > best[-1][0]:
            entry = (total, (s, e, kind), before)
        else:
            entry = (best[-1][0], None, len(best) - 1)
        ends.append(e)
        best.append(entry)
    out, i = [], len(best) - 1
    while i > 0:
        _, span, before = best[i]
        if span:
            out.append(span)
        i = before
    return out[::-1]


def train(examples: list[tuple[str, list[Span]]], rounds: int = 60, step: float = 0.5, ridge: float = 0.01) -> Weights:
    """Weights by gradient ascent on the log-likelihood of the examples' segmentations.

    An example is a short window with its spans. Expected features come from the forward and
    backward sums over all segmentations of its candidates.
    """
    # Many examples are alike in all that counts: they are one, so many times.
    alike: Counter[tuple] = Counter()
    number: dict[str, int] = {}  # of features
    for text, spans in examples:
        segments = sorted(set(candidates(text)) | {(s, e) for s, e, _ in spans}, key=lambda x: (x[1], x[0]))
        place = {c: i for i, c in enumerate(sorted({0} | {x for segment in segments for x in segment}))}
        gold = set(spans)
        names = [[tuple(number.setdefault(f, len(number)) for f in features(text, *x, k)) for k in KINDS] for x in segments]
        hits = tuple((s, e, k) in gold for s, e in segments for k in KINDS)
        if segments:
            alike[tuple((place[s], place[e]) for s, e in segments), tuple(f for fs in names for f in fs), hits] += 1
    if not alike:
        return {}
    rows = [f for _, fs, _ in alike for f in fs]
    length = np.array([len(f) for f in rows])
    flat, first = np.concatenate([np.array(f) for f in rows]), np.cumsum(length) - length
    hit = np.concatenate([np.array(h, float) for *_, h in alike])
    times = np.concatenate([np.full(len(h), n, float) for (*_, h), n in alike.items()])
    weights, total = np.zeros(len(number)), sum(alike.values())
    for _ in range(rounds):
        scores = np.add.reduceat(weights[flat], first).reshape(-1, len(KINDS))
        # A segment's score is that of all its kinds together, which then share its probability.
        whole = np.logaddexp.reduce(scores, axis=1)
        listed, each, at = whole.tolist(), [], 0
        for segments, _, _ in alike:
            each += _marginals(segments, listed[at : at + len(segments)])
            at += len(segments)
        chance = (np.array(each)[:, None] * np.exp(scores - whole[:, None])).ravel()
        gradient = np.bincount(flat, np.repeat(times * (hit - chance), length), len(number))
        weights += step * (gradient / math.sqrt(total) - ridge * weights)
    return dict(zip(number, weights.tolist()))


def _marginals(rows: Sequence[tuple], scores: list[float]) -> list[float]:
    """Probability of each labelled segment, over all sets of segments that don't overlap."""
    cuts = sorted({0} | {s for s, *_ in rows} | {e for _, e, *_ in rows})
    number = {c: i for i, c in enumerate(cuts)}
    ending, beginning = defaultdict(list), defaultdict(list)
    for i, (s, e, *_) in enumerate(rows):
        ending[number[e]].append(i)
        beginning[number[s]].append(i)
    n = len(cuts)
    forward, backward = [0.0] * n, [0.0] * n
    for c in range(1, n):
        forward[c] = _log_sum([forward[c - 1]] + [forward[number[rows[i][0]]] + scores[i] for i in ending[c]])
    for c in range(n - 2, -1, -1):
        backward[c] = _log_sum([backward[c + 1]] + [backward[number[rows[i][1]]] + scores[i] for i in beginning[c]])
    total = forward[-1]
    return [
        math.exp(forward[number[s]] + x + backward[number[e]] - total) for (s, e, *_), x in zip(rows, scores)
    ]


def _log_sum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


# --- examples ------------------------------------------------------------------------

SAMPLE = 200  # documents with base spans that are read for training
_SPANS = 4  # base spans of each that are made examples
_WINDOW = 60


def _chosen(text: str) -> list[Span]:
    """At most ``_SPANS`` base spans of a whole text, those with the smallest hashes, in order."""

    def chance(span: Span) -> bytes:
        return hashlib.sha256(f"{span[0]} {text[span[0] : span[1]]}".encode()).digest()

    return sorted(sorted(base_spans(text), key=chance)[:_SPANS], key=_order)


def make_examples(texts: Iterable[str]) -> list[tuple[str, list[Span]]]:
    """Windows around base spans, as they are, rewritten, and with near misses in their place."""
    out: list[tuple[str, list[Span]]] = []
    for number, text in enumerate(texts):
        chance = random.Random(number)
        for s, e, kind in _chosen(text):
            before, span, after = text[max(0, s - _WINDOW) : s], text[s:e], text[e : e + _WINDOW]
            # Sentences around it without spans of their own.
            before, after = (re.sub(r"[0-9@+]", "", x) for x in (before, after))
            if before and not before[-1].isspace():
                before += " "
            if after and after[0].isalnum():
                after = " " + after
            for form, hit in [(span, True), *_rewritten(span, kind, chance)]:
                gold = [(len(before), len(before) + len(form), kind)] if hit else []
                out.append((before + form + after, gold))
            if kind == "email":
                # A further word after the address, and a sentence that begins without a space.
                words = re.findall(r"[A-Za-z]{2,}", text[e : e + 2000]) or ["Thanks"]
                for form in [f for f, hit in _rewritten(span, kind, chance) if hit]:
                    gold = [(len(before), len(before) + len(form), kind)]
                    for between in (" dot ", "."):
                        out.append((before + form + between + chance.choice(words).capitalize() + " " + after, gold))
                continue
            # Neighbouring numbers: where one ends and the next begins.
            for form in [f for f, hit in _rewritten(span, kind, chance) if hit]:
                years = [str(y) for y in range(1950, 2030)]
                # Also a year with which the whole passes the check sum of a card.
                passing = [y for y in years if luhn(_digits(y + form))]
                cases = [(form, ", "), (form, " "), (chance.choice(years), ", "), (chance.choice(passing), ", ")]
                for first, between in cases:
                    at = len(before) + len(first) + len(between)
                    gold = [(at, at + len(form), kind)]
                    if first == form:
                        gold.insert(0, (len(before), len(before) + len(form), kind))
                    out.append((before + first + between + form + after, gold))
    return out


# Years, months, days, hours, minutes and seconds of near misses.
_CLOCK = ((1990, 2030), (1, 13), (1, 29), (0, 24), (0, 60), (0, 60))


def _rewritten(span: str, kind: str, chance: random.Random) -> list[tuple[str, bool]]:
    digits = _digits(span)
    if kind == "email":
        name, host = span.split("@", 1)
        dotted = host.replace(".", " dot ")
        return [
            (f"{name} at {dotted}", True),
            (f"{name}[at]{host.replace('.', '[dot]')}", True),
            (f"{name} (at) {host}", True),
            (f"{name} @ {host}", True),
            (f"{name} at mail dot {dotted}", True),
            (f"{name} at mx dot mail dot dept dot {dotted}", True),
            (f"{name} at {host.split('.')[0]} place", False),
            (f"meet at {host.split('.')[0]}.Then", False),
        ]
    if kind == "ip":
        parts = span.split(".")
        return [
            ("[.]".join(parts), True),
            (" . ".join(parts), True),
            (".".join([*parts[:3], str(256 + chance.randrange(600))]), False),
            ("/".join(parts[:3]), False),
            (".".join(parts[:3]), False),
            ("{}-{:02}-{:02} {:02}:{:02}:{:02}".format(*(chance.randrange(*r) for r in _CLOCK)), False),
            (" ".join(str(chance.randrange(1, 300)) for _ in range(8)), False),
        ]
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + chance.randrange(9)) % 10)
        if luhn(wrong):
            wrong = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        return [
            (".".join(four), True),
            ("_".join(four), True),
            (" - ".join(four), True),
            (wrong, False),
            (".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), False),
            (digits[:9], False),
        ]
    tail = digits[-10:]
    return [
        (f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", True),
        (f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", True),
        (f"00{digits[0]} {digits[1:4]} {digits[4:7]} {digits[7:]}", True),
        (f"{tail[:4]}-{tail[4:6]}-{tail[6:8]}", False),
        (f"{tail[:2]},{tail[2:5]},{tail[5:8]}", False),
        (f"{tail[:2]}:{tail[2:4]}:{tail[4:6]}", False),
        (tail, False),
    ]


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Weights:
    """Weights learnt on at most ``sample`` texts that hold a digit or ``@``, the same each time.

    The sample is the texts with the smallest hashes, as a whole. Each gives the examples of at most
    ``_SPANS`` spans, wherever they stand, and all examples are learnt from.
    """
    texts = docs.select(text_of(docs[text]).alias("t"))
    texts = texts.filter(F.col("t").rlike(r"@[A-Za-z0-9-]+\.|[0-9][0-9 .-]{8}"))
    chosen = texts.select("t", F.xxhash64("t").alias("h")).distinct().orderBy("h", "t").limit(sample)
    return train(make_examples(r["t"] for r in chosen.collect()))


# --- the operator --------------------------------------------------------------------


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=_order))


def find_spans(text: str, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a whole text."""
    if not _SIGNS.search(text) and not _SPELT_SIGN.search(text):
        return [], []
    base = base_spans(text)
    return base, segment(text, base, weights)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, and what spans overlap, replaced by the first one's kind in brackets."""
    out, at = [], 0
    for s, e, kind in sorted(spans, key=_order):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
            at = e
        elif e > at:
            at = e
    return "".join([*out, text[at:]])


def span_digest(docs: DataFrame, id: str = "doc_id", text: str = "text", weights: Weights | None = None) -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of each row.

    Null and empty texts have no spans. One row for each row, null and repeated ids included.
    """
    small_batches(docs.sparkSession)
    known = fit(docs, text) if weights is None else weights

    def digest(texts: pa.Array) -> pa.Array:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        shas, spans = [], []
        for t in texts.to_pylist():
            base, added = find_spans(t, known)
            for k in KINDS:
                counts[k].append(sum(x[2] == k for x in base))
            shas.append(hashlib.sha256(_written(base).encode()).hexdigest())
            spans.append(_written(base + added))
        columns = [pa.array(counts[k], pa.int64()) for k in KINDS] + [pa.array(shas), pa.array(spans, pa.string())]
        return pa.StructArray.from_arrays(columns, [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    fields = [*(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"]
    udf = F.arrow_udf(digest, ", ".join(fields)).asNondeterministic()
    rows = docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text"))
    return rows.select("id", udf("text").alias("d")).select(F.col("id").alias(id), "d.*")


def mask(text, weights: Weights):
    """A text column with its personal data replaced by kinds in brackets; null stays null."""

    def cover(texts: pa.Array) -> pa.Array:
        out = [None if t is None else masked(t, reduce(add, find_spans(t, weights))) for t in texts.to_pylist()]
        return pa.array(out, pa.string())

    return F.arrow_udf(cover, "string").asNondeterministic()(text)
