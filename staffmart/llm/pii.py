"""Personal data by patterns and a semi-Markov conditional random field (operator 4).

The base patterns (email, ip, card, phone) find the plain forms. The model
adds forms that they miss, such as a phone number without its plus sign or an
address with "(at)". Text around digits or an at-sign is cut into *islands*,
which are decoded apart, exactly; one of more than 100,000 code points in pieces
that overlap by half. The model adds only what an island admits:
numbers of seven digits or more joined by blanks, dots, hyphens, slashes and
parentheses (Unicode's blanks and dashes too), four dotted octets, and at-signs
and dots plain, spelt out or in brackets, in either case, with or without blanks.
Numbers in words or with other separators, addresses spelt in another way and
entities of more than ``MAX_TOKENS`` tokens are not found, and of a local part
its last 64 characters. Base spans need no island.

Inside an island every stretch of at most ``MAX_TOKENS`` tokens is a candidate
segment, scored as a whole (digits, groups, separators, checksum, octets, at-
sign and domain, edges) for each type; tokens outside entities are segments of
one token. Transitions join the types of neighbours. The forward-backward
recursion over segments gives the probability of each, the Viterbi recursion
the best cut; its segments are reported from probability ``SURE`` on.

Weights are fitted here, by stochastic gradients on the log-likelihood (islands
of like length side by side, a fixed number of steps, some seconds on the
driver at any size): of a sample of ``SAMPLE`` islands at most, the smallest by a hash of their document,
and of rewritten copies of their entities and of ``SEEDS`` made-up ones (plus
sign or country code dropped, separators changed, at-sign or dots spelt out, a
digit spoilt), so that the model learns the shape and not the pattern. What the
base patterns find is true; that they find nothing says little, so islands that
hold a plausible form beside the base spans are left out and never teach that
it is none, however common it is.

Defined results: a null text is empty; spans found by the model never overlap
base spans; rows are judged one by one, so null and repeated ids change
nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import slices

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 1000
MAX_TOKENS = 24
SURE = 0.9
STEPS = 2000
BATCH = 64
RATE = 2.0
SEEDS = 25
SEED = 3

# Fixed values of the contract, each written so that it takes linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def is_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The plain forms, by kind and start."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(is_octet(p) for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# -------------------------------------------------------------------- islands

_NUMERIC = re.compile(r"[+(]{0,2}[0-9](?:[0-9 ().+/-]*[0-9])?")
_AT = re.compile(r"@| ?[\[({] ?[aA][tT] ?[\])}] ?| [aA][tT] ")
_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_AFTER = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[({] ?(?:\.|[dD][oO][tT]) ?[\])}] ?| [dD][oO][tT] )[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.| ?[\[({] ?(?:\.|[dD][oO][tT]) ?[\])}] ?| [dD][oO][tT] )"
                     r"[0-9]{1,3}){3}(?![0-9])")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
MIN_DIGITS = 7


_ODD = re.compile("[\u00a0\u2000-\u200a\u202f\u3000\u00ad\u2010-\u2015\u2212\ufe63\uff0d]")
_PLAIN = dict.fromkeys([0xA0, *range(0x2000, 0x200B), 0x202F, 0x3000], " ") | dict.fromkeys(
    [0xAD, *range(0x2010, 0x2016), 0x2212, 0xFE63, 0xFF0D], "-")


def plain(text: str) -> str:
    """The text with Unicode's blanks and dashes as ASCII ones, at the same places."""
    return text if text.isascii() or not _ODD.search(text) else text.translate(_PLAIN)


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold an entity that the model can add, in order, without overlaps."""
    text = plain(text)
    found = [(m.start(), m.end()) for m in _NUMERIC.finditer(text)
             if m.end() - m.start() >= MIN_DIGITS and len(digits_of(m.group())) >= MIN_DIGITS]
    found += [(m.start(), m.end()) for m in _DOTTED.finditer(text)]
    for m in _AT.finditer(text):
        before = _BEFORE.search(text[max(0, m.start() - 64):m.start()])
        after = _AFTER.match(text, m.end()) if before else None
        # a plain " at " is a word of prose unless the dots are spelt out too
        if after and (m.group().lower() != " at " or " dot " in after.group().lower()):
            found.append((m.start() - len(before.group()), after.end()))
    found.sort()
    merged: list[tuple[int, int]] = []
    for start, end in found:
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


# ------------------------------------------------------------------- features

_DIGIT_STEPS = [9, 10, 11, 12, 13, 16, 17, 20]
_SPELT_AT = re.compile(r"[\[({] ?[aA][tT] ?[\])}]| [aA][tT] ")
FEATURES = ["bias", *[f"digits<{d}" for d in _DIGIT_STEPS], "digits more", "plus", "paren first",
            "parens closed", "one group", "two groups", "three groups", "four groups", "more groups",
            "octets", "checksum", "fours", "dots", "hyphens", "blanks", "one separator", "sign at",
            "spelt at", "domain", "left edge", "right edge", "plus inside", "card length", "alone"]
N = len(FEATURES)
_PLACE = {f: i for i, f in enumerate(FEATURES)}


def features(text: str, left: str, right: str, alone: bool) -> list[int]:
    """Numbers of the features that hold for a whole segment; left, right: its neighbours; alone: no more digits."""
    out = [0]
    digits = digits_of(text)
    n = len(digits)
    for i, d in enumerate(_DIGIT_STEPS):
        if n < d:
            out.append(1 + i)
            break
    else:
        out.append(_PLACE["digits more"])
    groups = re.findall(r"[0-9]+", text)
    separators = {c for c in text if not c.isalnum()}
    has = {
        "plus": text.startswith("+"), "paren first": text.startswith("("),
        "parens closed": "(" in text and text.count("(") == text.count(")"),
        "octets": bool(_DOTTED.fullmatch(text)) and all(map(is_octet, groups)),
        "checksum": n >= 13 and luhn(digits), "fours": [len(g) for g in groups] == [4, 4, 4, 4],
        "dots": "." in text, "hyphens": "-" in text, "blanks": " " in text,
        "one separator": len(separators) == 1, "sign at": "@" in text,
        "spelt at": bool(_SPELT_AT.search(text)),
        "domain": bool(re.search(r"(\.| [dD][oO][tT] |[\[({] ?(\.|[dD][oO][tT]) ?[\])}] ?)[A-Za-z]{2,}\Z", text)),
        "left edge": not left.isalnum() and left not in "+@_",
        "right edge": not right.isalnum() and right not in "@_([{",
        "plus inside": "+" in text[1:], "card length": 13 <= n <= 19, "alone": alone,
        ["one group", "one group", "two groups", "three groups", "four groups"][len(groups)]
        if len(groups) <= 4 else "more groups": True,
    }
    out += [_PLACE[f] for f, on in has.items() if on]
    return out


class Island:
    """Tokens of an island, and its candidate segments with their features."""

    def __init__(self, text: str, left: str = " ", right: str = " "):
        text = plain(text)
        self.bounds = [0, *[m.end() for m in _TOKEN.finditer(text)]]
        self.size = len(self.bounds) - 1
        padded = left[-1:] + text + right[:1]
        digits = np.concatenate([[0], np.cumsum([c.isdigit() for c in text])]) if text else np.zeros(1)
        marks = [m.start() for m in re.finditer(r"@|\b[aA][tT]\b", text)]
        self.segments: list[tuple[int, int]] = []
        self.on: list[list[int]] = []
        for i in range(self.size):
            a = self.bounds[i]
            if not (text[a].isalnum() or text[a] in "+("):
                continue
            for j in range(i + 1, min(self.size, i + MAX_TOKENS) + 1):
                b = self.bounds[j]
                if not text[b - 1].isalnum():
                    continue
                if digits[b] - digits[a] < MIN_DIGITS and not (
                        digits[b] - digits[a] >= 4 and text[a:b].count(".") + text[a:b].lower().count("dot") == 3) and not any(
                            a < m < b and text[a].isalnum() for m in marks):
                    continue
                self.segments.append((i, j))
                self.on.append(features(text[a:b], padded[a:a + 1], padded[b + 1:b + 2],
                                        digits[b] - digits[a] == digits[-1]))
        self.matrix = np.zeros((len(self.segments), N))
        for k, row in enumerate(self.on):
            self.matrix[k, row] = 1.0
        self.ending: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(self.segments):
            self.ending.setdefault(j, []).append(k)


# ---------------------------------------------------------------------- model

OUTSIDE = len(KINDS)  # label of a token outside entities


class Model:
    """Weights of features by kind, and of transitions between neighbouring labels."""

    def __init__(self):
        self.by_kind = np.zeros((N, len(KINDS)))
        self.move = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def forward(self, island: Island, scores: np.ndarray) -> np.ndarray:
        """alpha[j, y]: log-sum over cuts of the first j tokens whose last label is y."""
        alpha = np.full((island.size + 1, len(KINDS) + 1), -np.inf)
        alpha[0, OUTSIDE] = 0.0
        for j in range(1, island.size + 1):
            alpha[j, OUTSIDE] = _logsum(alpha[j - 1] + self.move[:, OUTSIDE])
            own = island.ending.get(j)
            if own:
                starts = [island.segments[k][0] for k in own]
                into = _logsum(alpha[starts][:, :, None] + self.move[None, :, :OUTSIDE], axis=1)
                alpha[j, :OUTSIDE] = _logsum(into + scores[own], axis=0)
        return alpha

    def backward(self, island: Island, scores: np.ndarray) -> np.ndarray:
        """beta[i, y]: log-sum over cuts of the tokens from i on, after label y."""
        beta = np.full((island.size + 1, len(KINDS) + 1), -np.inf)
        beta[island.size] = 0.0
        starting: dict[int, list[int]] = {}
        for k, (i, _) in enumerate(island.segments):
            starting.setdefault(i, []).append(k)
        for i in range(island.size - 1, -1, -1):
            ways = [(beta[i + 1, OUTSIDE] + self.move[:, OUTSIDE])[None, :]]
            own = starting.get(i)
            if own:
                after = beta[[island.segments[k][1] for k in own]][:, :OUTSIDE] + scores[own]
                ways.append(_logsum(self.move[None, :, :OUTSIDE] + after[:, None, :], axis=2))
            beta[i] = _logsum(np.concatenate(ways), axis=0)
        return beta

    def probabilities(self, island: Island) -> tuple[np.ndarray, np.ndarray]:
        """P(segment k has kind y), and the expected number of moves between labels."""
        scores = island.matrix @ self.by_kind
        alpha, beta = self.forward(island, scores), self.backward(island, scores)
        whole = _logsum(alpha[island.size])
        moves = np.zeros_like(self.move)
        out = np.zeros_like(scores)
        for k, (i, j) in enumerate(island.segments):
            each = np.exp(alpha[i][:, None] + self.move[:, :OUTSIDE] + scores[k][None, :]
                          + beta[j, :OUTSIDE][None, :] - whole)
            out[k] = each.sum(axis=0)
            moves[:, :OUTSIDE] += each
        outside = alpha[:-1] + self.move[:, OUTSIDE][None, :] + beta[1:, OUTSIDE][:, None] - whole
        moves[:, OUTSIDE] += np.exp(outside).sum(axis=0)
        return out, moves

    def best(self, island: Island) -> list[tuple[int, int, int]]:
        """(segment, kind, end) of the best cut's entities: the Viterbi recursion."""
        scores = island.matrix @ self.by_kind
        value = np.full((island.size + 1, len(KINDS) + 1), -np.inf)
        value[0, OUTSIDE] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j in range(1, island.size + 1):
            step = value[j - 1] + self.move[:, OUTSIDE]
            y = int(np.argmax(step))
            value[j, OUTSIDE], back[j, OUTSIDE] = step[y], (j - 1, y, -1)
            for k in island.ending.get(j, []):
                i = island.segments[k][0]
                step = value[i][:, None] + self.move[:, :OUTSIDE] + scores[k][None, :]
                for kind in range(len(KINDS)):
                    y = int(np.argmax(step[:, kind]))
                    if step[y, kind] > value[j, kind]:
                        value[j, kind], back[j, kind] = step[y, kind], (i, y, k)
        out, j, label = [], island.size, int(np.argmax(value[island.size]))
        while j > 0:
            i, y, k = back[j, label]
            if k >= 0:
                out.append((k, label, j))
            j, label = i, y
        return out[::-1]


def _logsum(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        out = np.log(np.sum(np.exp(x - safe), axis=axis, keepdims=True)) + safe
    return out.reshape(()) if axis is None else np.squeeze(out, axis=axis)


class Batch:
    """Islands whose recursions run side by side; their segments lie one after the other."""

    def __init__(self, islands: list[Island], truths: list[list[tuple[int, int]]]):
        self.sizes = np.array([x.size for x in islands])
        self.length, self.n = int(self.sizes.max()), len(islands)
        count = [len(x.segments) for x in islands]
        self.matrix = np.concatenate([x.matrix for x in islands])
        self.island = np.repeat(np.arange(self.n), count)
        self.first, self.last = np.array([s for x in islands for s in x.segments]).T
        self.starting = self._by_place(self.first, range(self.length))
        self.ending = self._by_place(self.last, range(1, self.length + 1))
        self.target = np.zeros((len(self.matrix), len(KINDS)))
        self.seen = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
        offsets = np.cumsum([0, *count])
        for x, true, offset in zip(islands, truths, offsets[:-1], strict=True):
            label, at = OUTSIDE, 0
            ends = sorted((*x.segments[k], kind, k) for k, kind in true)
            for i, j, kind, k in [*ends, (x.size, x.size, None, None)]:
                if i > at:
                    self.seen[label, OUTSIDE] += 1
                    self.seen[OUTSIDE, OUTSIDE] += i - at - 1
                    label = OUTSIDE
                if kind is not None:
                    self.target[offset + k, kind] = 1.0
                    self.seen[label, kind] += 1
                    label, at = kind, j

    def _by_place(self, places: np.ndarray, over: range) -> dict[int, tuple[np.ndarray, ...]]:
        """Per place its segments in order of island, where each island's begin, and which it is."""
        out = {}
        for place in over:
            own = np.flatnonzero(places == place)
            if len(own):
                islands, starts = np.unique(self.island[own], return_index=True)
                out[place] = (own, starts, islands)
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """P(segment k has kind y), and the expected moves between labels over all islands."""
        labels = len(KINDS) + 1
        scores, move = self.matrix @ model.by_kind, model.move
        alpha = np.full((self.n, self.length + 1, labels), -np.inf)
        into = np.full((self.n, self.length + 1, labels), -np.inf)  # log-sum of a cut and the move to y
        alpha[:, 0, OUTSIDE] = 0.0
        for j in range(self.length + 1):
            if j:
                alpha[:, j, OUTSIDE] = into[:, j - 1, OUTSIDE]
                if j in self.ending:
                    own, starts, islands = self.ending[j]
                    ways = into[self.island[own], self.first[own], :OUTSIDE] + scores[own]
                    alpha[islands, j, :OUTSIDE] = np.logaddexp.reduceat(ways, starts, axis=0)
            into[:, j] = _logsum(alpha[:, j, :, None] + move, axis=1)
        beta = np.zeros((self.n, self.length + 1, labels))
        rest = np.full((self.n, self.length, labels), -np.inf)  # log-sum of what may follow as y
        for i in range(self.length - 1, -1, -1):
            rest[:, i, OUTSIDE] = beta[:, i + 1, OUTSIDE]
            if i in self.starting:
                own, starts, islands = self.starting[i]
                ways = scores[own] + beta[self.island[own], self.last[own], :OUTSIDE]
                rest[islands, i, :OUTSIDE] = np.logaddexp.reduceat(ways, starts, axis=0)
            beta[:, i] = np.where((i < self.sizes)[:, None], _logsum(move + rest[:, i, None, :], axis=2), 0.0)
        whole = _logsum(alpha[np.arange(self.n), self.sizes], axis=1)
        out = np.exp(into[self.island, self.first, :OUTSIDE] + scores
                     + beta[self.island, self.last, :OUTSIDE] - whole[self.island, None])
        inside = np.arange(self.length) < self.sizes[:, None]
        each = alpha[:, :-1, :, None] + move + rest[:, :, None, :] - whole[:, None, None, None]
        return out, np.exp(each[inside]).sum(axis=0)


def fit(examples: list[tuple[str, str, str, list[Span]]], steps: int = STEPS) -> Model:
    """Stochastic gradients on the log-likelihood of (text, left, right, true spans).

    Islands of like length are taken ``BATCH`` at a time; each weight's step
    shrinks with the squares of its gradients so far.
    """
    model, rng = Model(), np.random.default_rng(SEED)
    ready = []
    for text, left, right, spans in examples:
        island = Island(text, left, right)
        place = {b: t for t, b in enumerate(island.bounds)}
        index = {s: k for k, s in enumerate(island.segments)}
        true = [(index.get((place.get(a, -1), place.get(b, -1))), kind) for kind, a, b in spans]
        if island.segments and all(k is not None for k, _ in true):
            ready.append((island, true))
    ready = [ready[n] for n in rng.permutation(len(ready))]
    ready.sort(key=lambda r: r[0].size)
    batches = [Batch(*map(list, zip(*ready[n:n + BATCH], strict=True))) for n in range(0, len(ready), BATCH)]
    squares = [np.full_like(w, 1e-6) for w in (model.by_kind, model.move)]
    order: list[int] = []
    for _ in range(steps if batches else 0):
        order = order or rng.permutation(len(batches)).tolist()
        batch = batches[order.pop()]
        expected, moves = batch.expected(model)
        for w, square, up in ((model.by_kind, squares[0], batch.matrix.T @ (batch.target - expected)),
                              (model.move, squares[1], batch.seen - moves)):
            slope = up / batch.n - 1e-4 * w
            square += slope ** 2
            w += RATE * slope / np.sqrt(square)
    return model


def rewritten(text: str, kind: int, rng: np.random.Generator) -> list[tuple[str, int | None]]:
    """Copies of a true entity in forms that the patterns miss, and spoilt ones that are none."""
    out: list[tuple[str, int | None]] = []
    if KINDS[kind] == "email":
        local, _, domain = text.partition("@")
        for at, dot in ((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", "."),
                        (" (at) ", " (dot) "), (" [at] ", " [dot] ")):
            out.append((local + at + domain.replace(".", dot), kind))
    elif KINDS[kind] == "phone":
        bare = text.lstrip("+")
        out += [(bare, kind), (bare.replace("-", " "), kind), (text.replace("-", "."), kind),
                (bare.replace("-", "/"), kind)]
        groups = re.findall(r"[0-9]+", text)
        national = groups[1:] if len(groups[0]) <= 3 else groups
        if len(national) > 1 and len("".join(national)) >= 9:
            out += [(sep.join(national), kind) for sep in ("-", " ", ".", "/")]
            out += [(f"({national[0]}) {'-'.join(national[1:])}", kind),
                    (f"({national[0]}) {' '.join(national[1:])}", kind),
                    (f"{national[0]}/{'-'.join(national[1:])}", kind)]
        digits = digits_of(text)
        out += [(digits[:4], None), (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", None), (digits, None)]
    elif KINDS[kind] == "card":
        digits = digits_of(text)
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        out += [(".".join(fours), kind), ("  ".join(fours), kind), ("/".join(fours), kind)]
        spoilt = digits[:-1] + str((int(digits[-1]) + int(rng.integers(1, 10))) % 10)
        out += [(spoilt, None), (" ".join(spoilt[i:i + 4] for i in range(0, len(spoilt), 4)), None)]
    else:
        parts = text.split(".")
        out += [(dot.join(parts), kind) for dot in ("[.]", "(.)", "(dot)", "[dot]", " dot ")]
        out += [("[.]".join(parts[:2]) + "." + ".".join(parts[2:]), kind), (".".join(parts[:3]) + "[.]" + parts[3], kind)]
        out += [(".".join([*parts[:3], "999"]), None), (".".join([*parts, "7"]), None),
                ("[.]".join([*parts[:3], "999"]), None)]
    return out


_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-./])[0-9]{1,2}\1[0-9]{1,2}|"
                   r"[0-9]{1,2}([-./])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?![0-9])")
_NATIONAL = re.compile(r"\([0-9]{2,5}\) ?[0-9]{2,}|(?<![0-9])[0-9]{3}([ ./-])[0-9]{3}\1[0-9]{4}(?![0-9])|"
                       r"(?<![0-9])[0-9]{3}-[0-9]{4}(?![0-9])")


def plausible(text: str) -> bool:
    """Whether text outside the base spans may be or hold an entity in a form that they miss."""
    text = plain(text)
    if "@" in text or _SPELT_AT.search(text):
        return True
    if any(all(map(is_octet, re.findall("[0-9]+", m.group()))) for m in _DOTTED.finditer(text)):
        return True
    text = _DATE.sub("_", text)
    if _NATIONAL.search(text):
        return True
    for m in _NUMERIC.finditer(text):
        digits, groups = digits_of(m.group()), re.findall("[0-9]+", m.group())
        if 9 <= len(digits) <= 15 and (len(groups) > 1 or len(digits) <= 12):
            return True
        if 13 <= len(digits) <= 19 and luhn(digits):
            return True
    return False


def seeds(rng: np.random.Generator) -> list[tuple[str, str, str]]:
    """Made-up entities in plain forms, for tables that have few or none."""
    def number(n: int) -> str:
        return str(rng.integers(2, 10)) + "".join(map(str, rng.integers(0, 10, n - 1)))

    out = []
    for _ in range(SEEDS):
        a, b, c = number(3), number(3), number(4)
        card = number(15)
        card += next(d for d in "0123456789" if luhn(card + d))
        out += [f"{number(1)}name.{a}@host{b}.example.com", f"mail{a}@example.org",
                ".".join(map(str, rng.integers(1, 256, 4))), card,
                " ".join(card[i:i + 4] for i in range(0, 16, 4)), f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}",
                f"+{number(2)} {a} {b} {c}"]
    return [(text, " ", " ") for text in out]


def training_set(sample: list[tuple[str, str, str]]) -> list[tuple[str, str, str, list[Span]]]:
    """Islands whose truth the base spans tell, and rewritten copies of each entity."""
    rng, out = np.random.default_rng(SEED), []
    for text, left, right in [*sample, *(seeds(rng) if sample else [])]:
        spans = without_overlaps(base_spans(text))
        ends = [0, *[b for _, _, b in spans]]
        starts = [*[a for _, a, _ in spans], len(text)]
        if not any(plausible(text[a:b]) for a, b in zip(ends, starts, strict=True)):
            out.append((text, left, right, spans))
        for kind, a, b in spans:
            for new, label in rewritten(text[a:b], kind, rng):
                out.append((new, left, right, [] if label is None else [(label, 0, len(new))]))
    return out


def without_overlaps(spans: list[Span]) -> list[Span]:
    """Of overlapping spans the one of the earlier kind, in order of position."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[0], s[1])):
        if all(s[2] <= o[1] or o[2] <= s[1] for o in out):
            out.append(s)
    return sorted(out, key=lambda s: s[1])


def model_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """What the model finds beyond the base spans."""
    out, taken = [], sorted((a, b) for _, a, b in base)
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else []
    starts = [a for a, _ in taken]
    for start, end in islands(text):
        if end - start > 100_000:
            parts = [(start + o, min(end, start + o + 100_000)) for o in range(0, end - start, 50_000)]
        else:
            parts = [(start, end)]
        for s, e in parts:
            lo = int(np.searchsorted(starts, e))
            if any(a <= s and e <= b for a, b in taken[max(0, lo - 2):lo]):
                continue  # one base span covers it all
            island = Island(text[s:e], text[s - 1:s] or " ", text[e:e + 1] or " ")
            if not island.segments:
                continue
            best = model.best(island)
            if not best:
                continue
            sure, _ = model.probabilities(island)
            for k, kind, _ in best:
                i, j = island.segments[k]
                a, b = s + island.bounds[i], s + island.bounds[j]
                # the first base span that begins at or after b cannot overlap; check those before
                lo = int(np.searchsorted(starts, b))
                overlaps = lo > 0 and ends[lo - 1] > a
                if sure[k, kind] >= SURE and not overlaps and (not out or out[-1][2] <= a):
                    out.append((kind, a, b))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[0], s[1])))


# -------------------------------------------------------------------- on Spark


def sampled_islands(docs: DataFrame, limit: int = SAMPLE) -> list[tuple[str, str, str]]:
    """At most ``limit`` islands of at most 200 code points, by a hash of document and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    for a, b in islands(text or ""):
                        if b - a <= 200:
                            digest = hashlib.blake2b(text[max(0, a - 40):b + 40].encode("utf-8", "surrogatepass"),
                                                     digest_size=8).hexdigest()
                            rows.append((digest, text[a:b], text[a - 1:a] or " ", text[b:b + 1] or " "))
                # no task needs to send more than the sample holds
                rows = sorted(set(rows))[:limit]
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns],
                                                 names=["digest", "text", "before", "after"])

    found = docs.select("text").mapInArrow(run, "digest string, text string, before string, after string")
    chosen = found.distinct().orderBy("digest", "text", "before", "after").limit(limit).collect()
    return [(r["text"], r["before"], r["after"]) for r in chosen]


def trained(docs: DataFrame) -> Model:
    return fit(training_set(sampled_islands(docs)))


def found_spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the four counts, base_sha256 and all spans of every row; no shuffle."""
    schema = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
              "spans string, n_added long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    more = model_spans(text, base, model)
                    rows.append((*[sum(s[0] == k for s in base) for k in range(len(KINDS))],
                                 hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more),
                                 len(more)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]],
                     *[pa.array(c, pa.string()) for c in columns[4:6]], pa.array(columns[6], pa.int64())],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# --------------------------------------------------------------- the query


def op4_personal_data(docs: DataFrame) -> DataFrame:
    return found_spans(docs, trained(docs))
