"""Personal data: span candidates, boosted trees, calibrated thresholds.

Strict patterns give the base spans (email, ip, card, phone), which always
stay. High-recall generators propose further, overlapping candidates of each
kind (spaced or bracketed addresses with each start of the local part and each end
of the domain, every run of neighbouring digit groups with a fitting digit count);
boosted trees score them from format and context features, and those at or above
their kind's threshold are added, best first, unless they overlap a kept span.

Each kind's trees learn from a bounded sample of documents
(``SAMPLE_DOCS``, chosen by a hash over the whole table; at most
``SAMPLE_CANDIDATES`` candidates), and only from candidates that no base span
covers, the kind they are asked about later. Each base span is written again in
its place in forms that the strict patterns miss (other separators, no ``+``, ``@``
spelled out, in a list, beside other numbers): the candidate that is such a copy is
positive, others that touch it have the wrong extent or kind and are negative.
Negative are also made look-alikes (failed check digits, order and version
numbers, dates, prose with ``@``) and the text's own candidates that speak
against themselves (``_refuted``); its other candidates are not judged and not used.
A third of the documents is held aside to calibrate the probabilities and to set
each kind's threshold: the lowest at which the share of positives among all held
candidates above it is at least ``PRECISION``, and never under ``LEAST``. A kind
without base spans in the sample gets no additions.

Edge cases: a null text is empty, no span; without candidates or with one class
only in the sample nothing is added; equal scores go to the earlier, then
longer candidate; repeated rows get equal results; texts of any length are
searched whole. Input columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import boosting
from larder.llm.common import add_columns, slices

# fixed values: kinds in order, base patterns
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, tried at the first digit of a run only, so a long run is read once.
IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_DOCS = 40000
SAMPLE_CANDIDATES = 20000
PRECISION = 0.98
LEAST = 0.9
CONTEXT = 40

# generators: looser forms of the same kinds
WIDE_AT = re.compile(r"\s?(?:@|\(at\)|\[at\]|\{at\})\s?|\sat\s(?=[A-Za-z0-9-]{1,63}\sdot\s)", re.I)
WIDE_LABEL = re.compile("[A-Za-z0-9-]{1,63}")
WIDE_DOT = re.compile(r"\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?(?=[A-Za-z0-9-])|\sdot\s(?=[A-Za-z0-9-])", re.I)
#: Parts of an address are proposed up to this length of its local part and this many dots; a longer one only whole.
MOST_LOCAL = 64
MOST_DOTS = 5
#: Tried at the start of every digit group, so a run of five groups gives two.
WIDE_IP = re.compile(r"(?<![0-9])(?=([0-9]{1,4}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,4}){3})(?![0-9]))")
GROUP = re.compile("[0-9]+")
GAP = re.compile(r"[\x20()./-]{0,3}")
#: Fewest and most digits of a card and of a phone.
CARD_DIGITS, PHONE_DIGITS = (12, 20), (7, 15)
CUE = re.compile(r"[@0-9]|[(\[{][aA][tT][)\]}]|\s[dD][oO][tT]\s")
WORDS = {
    "email": ("mail", "contact", "write to", "kontakt", "correo"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "telefon", "llame"),
}
DATE = re.compile(r"(?:(?:19|20)[0-9]{2}[./ -]{1,2}[0-9]{1,2}[./ -]{1,2}[0-9]{1,2}|[0-9]{1,2}[./ -]{1,2}[0-9]{1,2}[./ -]{1,2}(?:19|20)[0-9]{2}"
                  r"|(?:19|20)[0-9]{2}[/ -]{1,3}(?:19|20)[0-9]{2})(?![0-9])")
#: What parts a span of numbers from digits beside it.
GAP_BEFORE = re.compile(r"(?<![0-9])([0-9]+)([^0-9A-Za-z]{1,3})$")
GAP_AFTER = re.compile(r"([^0-9A-Za-z]{1,3})([0-9]+)")
NOT_PERSONAL = ("version", "token", "password", "isbn", "order", "id", "key", "license", "http", "www")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strict patterns, sorted."""
    found = []
    free, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > free and text[left - 1] in LOCAL:
            left -= 1
        if left < at and (m := DOMAIN.match(text, at + 1)):
            found.append((left, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _emails(text: str) -> Iterator[tuple[int, int, int]]:
    """At each mark every start of the local part (after each of its separators) with every end of the domain.

    A run longer than ``MOST_LOCAL`` characters or ``MOST_DOTS`` dots is taken
    whole on that side, not in parts, so that no span cuts it; a domain also up
    to its first dot beside a blank, which may end a sentence.
    """
    for at in WIDE_AT.finditer(text):
        left = at.start()
        while left > 0 and text[left - 1] in LOCAL:
            left -= 1
        if at.start() - left > MOST_LOCAL:
            starts = [left]
        else:
            starts = [i for i in range(left, at.start()) if text[i].isalnum() and (i == left or not text[i - 1].isalnum())]
            if left < at.start() and left not in starts:
                starts.append(left)
        ends, end, tight = [], WIDE_LABEL.match(text, at.end()), 0
        while starts and end and (dot := WIDE_DOT.match(text, end.end())):
            end = WIDE_LABEL.match(text, dot.end())
            if dot.group() == "." and tight == len(ends):
                tight += 1
            ends.append(end.end())
        if len(ends) > MOST_DOTS:
            ends = [ends[tight - 1], ends[-1]] if 0 < tight < len(ends) else ends[-1:]
        for start in starts:
            for e in ends:
                yield start, 0, e


def _numbers(text: str) -> Iterator[tuple[int, int, int]]:
    """Every run of neighbouring digit groups whose digits fit a card or a phone, with ``+`` and an opened bracket before it."""
    run: list[tuple[int, int]] = []  # the last groups, as many as a number from them may hold

    def ending(group: tuple[int, int]) -> Iterator[tuple[int, int, int]]:
        run.append(group)
        n = 0
        for i in range(len(run) - 1, -1, -1):
            n += run[i][1] - run[i][0]
            if n > CARD_DIGITS[1]:
                del run[:i + 1]
                break
            start, end = run[i][0], group[1]
            if text[start - 1:start] == "(" and text.find(")", start, end) >= 0:
                start -= 1
            if text[start - 1:start] == "+":
                start -= 1
            if CARD_DIGITS[0] <= n:
                yield start, 2, end
            if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                yield start, 3, end

    last = None
    for m in GROUP.finditer(text):
        if last is None or not GAP.fullmatch(text, last, m.start()):
            run.clear()
        last = m.end()
        yield from ending(m.span())


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Overlapping (start, kind, end) proposals of the generators; one number is proposed as card and as phone."""
    yield from _emails(text)
    for m in WIDE_IP.finditer(text):
        yield m.start(1), 1, m.end(1)
    yield from _numbers(text)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format of the span and its surroundings."""
    start, kind, end = span
    s = text[start:end]
    digits = _digits(s)
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    left, right = text[max(0, start - CONTEXT):start].lower(), text[end:end + CONTEXT].lower()
    before, after = left[-1:], right[:1]
    parts = re.findall("[0-9]+", s)
    stuck = len(re.search("[^\\W_]*$", left).group()) + len(re.match("[^\\W_]*", right).group())
    last = re.search("[A-Za-z0-9-]*$", s).group()
    more = WIDE_DOT.match(text, end) if kind == 0 else None
    first_gap, last_gap = GAP_BEFORE.search(left), GAP_AFTER.match(right)
    row = [float(kind == k) for k in range(4)]
    row += [len(s), len(digits), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0,
            groups[-1] if groups else 0, max((int(p[:6]) for p in parts), default=0), float(bool(digits) and luhn(digits)),
            s.startswith("+"), s.count("("), s.count("-"), s.count("."), s.count(" "), s.count("/"), s.count("@"),
            "(at)" in s or "[at]" in s, "dot" in s, sum(c.isalpha() for c in s), len(s.rsplit(".", 1)[-1]),
            before.isalnum(), after.isalnum(), before in "=:#$/_", after in "=:#$/_%",
            any(w in left for w in WORDS[KINDS[kind]]), any(w in left for w in NOT_PERSONAL), len(set(digits)), stuck]
    row += [*(groups + [0] * 5)[:5], int(digits[:1] or -1), len(set(re.findall("[^0-9+(]+", s))), len(last), last[:1].isupper(), last.isdigit(),
            ")" in s, all(_small(p) for p in parts), bool(DATE.match(s)), any(re.search(rf"\\b{w}\\b", left) for w in NOT_PERSONAL),
            *((len(first_gap[1]), len(first_gap[2]), first_gap[2] in s) if first_gap else (0, -1, False)),
            *((len(more.group()), more.group() in s, text[more.end()].isupper()) if more else (0, False, False)),
            text[start - 1:start] in LOCAL if start else False,
            *((len(last_gap[2]), len(last_gap[1]), last_gap[1] in s) if last_gap else (0, -1, False)), s.count("\n")]
    return [float(v) for v in row]


def _by_kind(base: list) -> list[tuple[list, list]]:
    """Starts and ends of the base spans of each kind; both rise, since spans of one kind don't overlap."""
    return [([s for s, k, _ in base if k == kind], [e for _, k, e in base if k == kind]) for kind in range(len(KINDS))]


def _covered(span: tuple, by_kind: list) -> bool:
    starts, ends = by_kind[span[1]]
    last = bisect_left(starts, span[2]) - 1
    return last >= 0 and ends[last] > span[0]


class Model:
    """Each kind's trees (None without both classes) and threshold."""

    def __init__(self, trees: list[boosting.Boosted | None], thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def probability(self, text: str, spans: list[tuple]) -> np.ndarray:
        out = np.zeros(len(spans))
        for kind, trees in enumerate(self.trees):
            own = [i for i, c in enumerate(spans) if c[1] == kind] if trees else []
            if own:
                out[own] = trees.probability(np.array([features(text, spans[i]) for i in own]))
        return out


def _refuted(text: str, span: tuple) -> bool:
    """What speaks against a candidate without asking the strict patterns: check digit, range, named otherwise, inside a word, a date."""
    start, kind, end = span
    s, left, after = text[start:end], text[max(0, start - CONTEXT):start].lower(), text[end:end + 1]
    if kind == 0:
        return not any(c.isalpha() for c in s.rsplit(".", 1)[-1])
    if kind == 1 and not all(_small(p) for p in re.findall("[0-9]+", s)) or kind == 2 and not luhn(_digits(s)):
        return True
    named = any(re.search(rf"\b{w}\b[^\w]*\w{{0,3}}[^\w]*$", left) for w in NOT_PERSONAL)
    return named or left[-1:].isalnum() or after.isalnum() or bool(kind == 3 and DATE.match(s))


def _regrouped(digits: str, sizes: list[int], gap: str) -> str:
    parts, at = [], 0
    for n in sizes:
        parts.append(digits[at:at + n])
        at += n
    return gap.join([p for p in [*parts, digits[at:]] if p])


def _phone(groups: list[str], r: random.Random) -> str:
    """The number without ``+``, with or without its first group, its groups joined anew."""
    digits = "".join(groups)
    if len(groups) < 3:
        groups = [g for g in (digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]) if g]
    if sum(map(len, groups[1:])) >= 7 and r.random() < 0.7:
        groups = groups[1:]
    gap = r.choice(("-", " ", ".", "/", "-", " "))
    if len(groups) > 2 and r.random() < 0.3:
        at = 0 if len(groups) == 3 else 1
        return gap.join([*groups[:at], f"({groups[at]}) " + gap.join(groups[at + 1:])])
    return gap.join(groups)


def _card(digits: str, r: random.Random, loose: bool = True) -> str:
    sizes = [4, 6] if len(digits) == 15 else [4] * 4
    return _regrouped(digits, sizes, r.choice((".", "/", "  ", " - ", "--") if loose else (" ", "-", ".", "")))


def _varied(kind: int, s: str, r: random.Random) -> str:
    """Another strict value of the kind, so that the trees don't hold on to the few shapes of a corpus."""
    if kind == 0:
        local, domain = s.split("@", 1)
        labels = domain.split(".")
        local = r.choice((local, local[:2], re.split("[._%+-]", local)[0] or local, f"{local[:2]}.{local}", f"{local}_{r.randint(1, 99)}"))
        labels = r.choice((labels, labels[-2:], [labels[0], labels[-1]]))
        return local + "@" + ".".join([*labels[:-1], r.choice((labels[-1], "com", "org", "de", "io"))])
    if kind == 1:
        return ".".join(r.choice((p, str(r.randint(0, 255)), r.choice(("0", "1", "10", "255")))) for p in s.split("."))
    if kind == 3:
        return re.sub("[0-9]", lambda m: r.choice((m.group(), str(r.randint(1, 9)))), s)
    body = r.choice("3456") + "".join(r.choice((d, str(r.randint(0, 9)))) for d in _digits(s)[1:-1])
    return body + next(c for c in "0123456789" if luhn(body + c))


def loosened(kind: int, s: str, r: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """A base span's value in a form that the strict patterns miss: text and the places of the values in it."""
    s = _varied(kind, s, r) if r.random() < 0.5 else s
    digits = _digits(s)
    if kind == 0:
        local, domain = s.split("@", 1)
        at = r.choice((" @ ", "@ ", " @", " (at) ", "(at)", " [at] ", "[at]", "{at}", " (AT) ", " at "))
        dot = " dot " if at == " at " else r.choice((".", ".", " . ") if "@" in at else (".", " (dot) ", "(dot)", " [dot] ", "[dot]", "{dot}"))
        got = local + at + domain.replace(".", dot)
        return got + r.choice(("", "", "", ". The", " . And")), [(0, len(got))]
    if kind == 1:
        got = s.replace(".", r.choice((" . ", ". ", " .", "[.]", "(.)")))
        return got, [(0, len(got))]
    if kind == 2 and r.random() < 0.5:
        got, tail = _card(digits, r), ""
    elif kind == 2:  # as strict, but beside other digits
        got = _regrouped(digits, [4, 6] if len(digits) == 15 else [4] * 4, r.choice((" ", "-")))
        tail = r.choice((f" {r.randint(1, 12):02d}/{r.randint(24, 35)}", f" {r.randint(1, 12):02d}/{r.randint(24, 35)} {r.randint(100, 999)}",
                         f" {r.randint(1, 12):02d} {r.randint(24, 35)}", f" {got}"))
    else:
        groups = re.findall("[0-9]+", s)
        got = _phone(groups, r)
        tail = r.choice(("", "", " ", ", ", " / "))
        tail = tail and tail + _phone([*groups[:-1], str(r.randint(10 ** (len(groups[-1]) - 1), 10 ** len(groups[-1]) - 1))], r)
    at = len(got) + len(tail) - len(tail.lstrip(" ,/"))
    return got + tail, [(0, len(got))] + ([(at, len(got + tail))] if kind == 3 and tail or tail == f" {got}" else [])


def lookalike(kind: int, s: str, left: str, r: random.Random) -> str:
    """Text of a like form that is no value of the kind."""
    digits = _digits(s)

    def number(n: int) -> str:
        return str(r.randint(10 ** (n - 1), 10 ** n - 1))

    if kind == 0:
        words = (re.findall("[A-Za-z]{2,}", left) or ["we"])[-3:]
        a, b, c = (r.choice(words) for _ in range(3))
        at = r.choice((" @ ", " (at) ", " [at] ", "@ "))
        return r.choice((f"{a}{at}{b}. {c.capitalize()}", f"{a}{at}{b}. {c.capitalize()}", f"{a}{at}{b} . {c.capitalize()}", f"{number(1)} @ {number(1)}.{number(2)}",
                         f"{a} @ {number(2)}.{number(2)}"))
    if kind == 1:
        p = s.split(".")
        wrong = list(p)
        wrong[r.randrange(len(p))] = str(r.randint(256, 1999))
        gap = r.choice((" . ", ". ", " .", "[.]"))
        return r.choice((gap.join(wrong), gap.join(wrong), "version " + gap.join(p), gap.join([*p, number(1)]), "1. 2. 3. 4", f"{number(1)}. {number(1)}. {number(4)}. {number(1)}"))
    if kind == 2:
        at = r.randrange(len(digits))
        wrong = digits[:at] + str((int(digits[at]) + r.randint(1, 9)) % 10) + digits[at + 1:]
        if luhn(wrong):
            wrong = wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
        return r.choice(("order ", "id: ", "", "", "")) + _card(wrong, r, r.random() < 0.5) + r.choice(("", "", " 12/27"))
    name = r.choice(("order ", "order no. ", "id ", "id: ", "isbn ", "version ", "key ", "token "))
    groups = re.findall("[0-9]+", s)
    date = f"{r.randint(1950, 2035)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"
    return r.choice((name + _phone(groups, r), name + number(r.randint(7, 12)), number(r.randint(7, 12)), date, f"{date} {r.randint(0, 23):02d}{r.choice(': -')}{r.randint(0, 59):02d}",
                     ".".join(reversed(date.split("-"))), f"{r.randint(1900, 1999)}-{r.randint(2000, 2035)}", "isbn 978-3-16-" + number(6) + "-0",
                     "-".join(number(r.choice((2, 4, 5, 6))) for _ in range(3)), " ".join(number(r.choice((1, 2, 3))) for _ in range(r.randint(5, 9)))))


#: Copies and look-alikes of each base span, and the words kept around each.
COPIES = 3
AROUND = 200


def _touch(a: tuple, b: tuple) -> bool:
    return a[0] < b[2] and b[0] < a[2]


def examples(text: str) -> Iterator[tuple[str, tuple, bool]]:
    """(text, candidate, positive) for every candidate that no base span covers and whose label is known."""
    base = base_spans(text)
    by_kind = _by_kind(base)
    for c in candidates(text):
        if not any(_covered((c[0], k, c[2]), by_kind) for k in range(len(KINDS))) and _refuted(text, c):
            yield text, c, False
    for start, kind, end in base:
        if end - start > AROUND:
            continue
        s, left, right = text[start:end], text[max(0, start - AROUND):start], text[end:end + AROUND]
        r = random.Random(hashlib.md5(f"{left}|{s}|{kind}".encode("utf-8", "replace")).digest())
        for copy in range(2 * COPIES):
            piece, places = loosened(kind, s, r) if copy < COPIES else (lookalike(kind, s, left, r), [])
            cue = r.choice(("", "", f"{r.choice(WORDS[KINDS[kind]])} ", f"{r.choice(WORDS[KINDS[kind]])}: "))
            if kind == 3 and copy >= COPIES and not DATE.match(piece):
                cue = ""  # a number that a cue calls a phone may be one
            before = left if r.random() < 0.7 else left[-left[::-1].find(" "):] if " " in left else ""
            new, at = before + cue + piece + right, len(before + cue)
            whole = (at, kind, at + len(piece))
            good = {(at + a, kind, at + b) for a, b in places}
            now = _by_kind(base_spans(new))
            for c in candidates(new):
                if _touch(c, whole) and not _covered(c, now):
                    yield new, c, c in good


def sample(docs: DataFrame, most_docs: int = SAMPLE_DOCS, most: int = SAMPLE_CANDIDATES) -> list:
    """Labelled candidates (features, positive, held aside) of a bounded sample of the documents that may hold one."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    total = docs.count()
    if not total:
        return []
    draw = F.pmod(F.xxhash64("text", F.lit("pii")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = texts.where(draw < min(1.0, most_docs / total))

    def batch_of(rows: list) -> pa.RecordBatch:
        h, x, y, aside = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.bool_()),
                                           pa.array(aside, pa.bool_())], names=["h", "x", "y", "aside"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                if not CUE.search(text):
                    continue
                aside = hashlib.md5(text.encode("utf-8", "replace")).digest()[0] % 3 == 2
                for where, span, good in examples(text):
                    key = f"{where[max(0, span[0] - 20):span[2] + 20]}:{span}"
                    h = int.from_bytes(hashlib.md5(key.encode("utf-8", "replace")).digest()[:7], "big")
                    rows.append((h, features(where, span), good, aside))
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return chosen.mapInArrow(run, "h long, x array<double>, y boolean, aside boolean").orderBy("h", "y", "x").limit(most).collect()


def fit(rows: list) -> Model | None:
    """Trees, calibration and a threshold for each kind; None where the sample has one class only."""
    y = np.array([float(r["y"]) for r in rows])
    if len(y) < 30 or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in rows], float)
    by_place = np.arange(len(y)) % 3 == 2
    by_doc = np.array([r["aside"] for r in rows], bool) if "aside" in rows[0] else by_place
    trees, thresholds = [], []
    for k in range(len(KINDS)):
        own = x[:, k] == 1
        # few documents may leave a side with one class: then candidates are dealt
        aside = next((a[own] for a in (by_doc, by_place) if all(0 < y[own & s].sum() < (own & s).sum() for s in (a, ~a))), None)
        if aside is None:
            trees.append(None)
            thresholds.append(2.0)
            continue
        x_own, y_own = x[own], y[own]
        fitted = boosting.fit(x_own[~aside], y_own[~aside])
        boosting.calibrate(fitted, x_own[aside], y_own[aside])
        p = fitted.probability(x_own[aside])
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(y_own[aside][order]) / np.arange(1, aside.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        lowest = float(p[order][good[-1]]) if len(good) else 2.0
        trees.append(fitted)
        thresholds.append(max(LEAST, lowest))
    return Model(trees, thresholds)


def train(docs: DataFrame) -> Model | None:
    return fit(sample(docs))


def spans(text: str | None, model: Model | None) -> tuple[list, list]:
    """Base spans and all kept spans (start, kind, end), each sorted."""
    if not text or not CUE.search(text):
        return [], []
    base = base_spans(text)
    kept = list(base)
    by_kind = _by_kind(base)
    more = (c for c in candidates(text) if not _covered(c, by_kind)) if model else iter(())
    good = []
    while part := list(islice(more, 4096)):
        p = model.probability(text, part)
        good += [(-q, c[0], c[0] - c[2], c) for q, c in zip(p, part) if q >= model.thresholds[c[1]]]
    if good:
        taken = bytearray(len(text))
        for s, _, e in base:
            taken[s:e] = b"\1" * (e - s)
        for *_, c in sorted(good):
            if taken.find(1, c[0], c[2]) < 0:
                taken[c[0]:c[2]] = b"\1" * (c[2] - c[0])
                kept.append(c)
    return base, sorted(kept)


def _joined(found: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


FIELDS = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType())]


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with base counts, the digest of the base spans, and all spans."""

    def start() -> Callable:
        def run(texts: list) -> dict:
            out: dict[str, list] = {f.name: [] for f in FIELDS}
            for text in texts:
                base, kept = spans(text, model)
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(b[1] == k for b in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(kept))
                out["n_added"].append(len(kept) - len(base))
            return out

        return run

    return add_columns(docs, "text", T.StructType(FIELDS), start)


def redacted(text: str, kept: list) -> str:
    """The text with each span as its kind in brackets; overlapping spans become one, named by the first."""
    parts, at = [], 0
    for start, kind, end in kept:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` with every span replaced in ``text``; n_chars follows, other columns stay. Null texts stay null."""

    def start() -> Callable:
        def run(texts: list) -> dict:
            new = [None if t is None else redacted(t, spans(t, model)[1]) for t in texts]
            return {"text": new, "n_chars": [None if t is None else len(t) for t in new]}

        return run

    fields = [T.StructField("text", T.StringType())]
    if "n_chars" in docs.columns:
        fields.append(T.StructField("n_chars", T.LongType()))

    def chosen() -> Callable:
        run = start()
        return lambda texts: {k: v for k, v in run(texts).items() if k in {f.name for f in fields}}

    return add_columns(docs, "text", T.StructType(fields), chosen, replace=True)
