"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for what they miss.

The base patterns find e-mail addresses, IPv4 addresses, card numbers and international phone numbers. Around digits
and disguised addresses the field then scores whole candidate spans: their digits, grouping, checksum, separators and
neighbours. One dynamic program over the atoms of such a place chooses boundaries and kinds together. How far an entity
reaches follows from its kind (digits of a card, local part and host of an address), so the work is linear in the text. Base
spans always stay; a span of the field that overlaps one is left out. By what addresses and numbers can be, the field looks for local parts of
up to 64 characters, hosts of up to 127 names and numbers with up to 16 marks in a row; base spans have no such limits.

The weights are fitted by conditional likelihood on the driver. All rows are searched for base spans; of each kind the ``SAMPLE``
different spans with the smallest hashes, each with a few characters around it, are examples: once as they stand, once rewritten
into a form the patterns do not know. A kind of which no row holds a base span has no weights.

Nulls: a null text is empty. An empty text has no spans. Repeated rows give repeated rows. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_left
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import map_batches, written

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = "-"
# Digits of the longest number that is an entity, and marks in a row inside one.
MAX_DIGITS = 19
MAX_MARKS = 16
# Examples of each kind, and of places that hold none; what is around an example, and the longest one, in characters.
SAMPLE = 300
AROUND = 30
EXAMPLE_CHARS = 400
EPOCHS = 20
# An added span is believed from so much posterior odds against no entity at all.
MARGIN = 1.0

# The base patterns. A match of digits begins where a run of digits does; saying so spares a try at each digit of a long run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")
_PLACE = re.compile(r"(?:\+|\()?[0-9][0-9\x20()./+-]{5,}[0-9]|[\[(](?:at|AT|At)[\])]")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail pattern. Each @ is tried once, from where the run of characters before it begins: where that fails, so
    would any later start, and the time taken grows with the text only."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _EMAIL.match(text, begin) if begin < at else None
        if found:
            out.append(found.span())
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return out


def _octet(part: str) -> bool:
    """Whether it is at most 255, however many digits it has."""
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, by start, then in the order of KINDS."""
    found = [(b, 0, e) for b, e in _emails(text)]
    if _HAS_DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return [(b, KINDS[k], e) for b, k, e in sorted(found)]


_HAS_DIGIT = re.compile("[0-9]")


class Place:
    """A stretch of text that may hold entities: its atoms and where they start."""

    def __init__(self, text: str, begin: int, end: int) -> None:
        self.text = text
        self.at = [m.start() for m in _ATOM.finditer(text, begin, end)] + [end]
        self.n = len(self.at) - 1
        # Of each [at]: where its local part may begin and ends, and where its host begins and may end.
        self.marks = []
        for m in _AT.finditer(text, begin, end):
            if host := _HOST.match(text, m.end(), end):
                local = m.start()
                while local > max(begin, m.start() - _LOCAL_CHARS) and text[local - 1] in _LOCAL:
                    local -= 1
                self.marks.append((local, m.start(), m.end(), host.end()))

    def starts(self, j: int):
        """Atoms at which a number or a disguised address that ends with atom j - 1 may begin, nearest first."""
        digits = marks = 0
        for i in range(j - 1, -1, -1):
            atom = self.text[self.at[i] : self.at[i + 1]]
            if _DIGITS.fullmatch(atom):
                digits, marks = digits + len(atom), 0
            elif _NUMERIC.fullmatch(atom):
                marks += 1
            else:
                break
            if digits > MAX_DIGITS or marks > MAX_MARKS:
                break
            yield i
        for local, mark, host, last in self.marks:
            if host < self.at[j] <= last:
                yield from range(bisect_left(self.at, mark) - 1, bisect_left(self.at, local) - 1, -1)

    def candidates(self, j: int):
        """(i, kind, features) of each segment that ends at atom j."""
        yield j - 1, OUTSIDE, ()
        end = self.at[j]
        last = self.text[end - 1]
        if not last.isalnum():
            return
        for i in self.starts(j):
            first = self.text[self.at[i]]
            if first.isalnum() or first in "+(":
                yield from ((i, kind, f) for kind, f in features(self.text, self.at[i], end))


def places(text: str, base: list[tuple[int, str, int]]) -> list[Place]:
    """Stretches between white space around each place that may hold an entity and is no base span already."""
    out: list[tuple[int, int]] = []
    for m in _PLACE.finditer(text):
        begin, end = m.span()
        if text[begin] in "[(" and not text[begin + 1].isdigit():
            # An address in disguise takes in the words next to it.
            begin, end = _word_before(text, begin), _words_after(text, end)
        else:
            if sum(c.isdigit() for c in m[0]) < 7 or any(b <= begin and end <= e for b, _, e in base):
                continue
            begin = _word_before(text, begin) if begin and not text[begin - 1].isspace() else begin
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return [Place(text, b, e) for b, e in out]


def _word_before(text: str, at: int) -> int:
    while at > 0 and text[at - 1] == " ":
        at -= 1
    while at > 0 and not text[at - 1].isspace():
        at -= 1
    return at


def _words_after(text: str, at: int) -> int:
    """Past the next word, and past the words joined to it by a spelled-out dot."""
    while True:
        begin = at
        while at < len(text) and text[at] == " ":
            at += 1
        while at < len(text) and not text[at].isspace():
            at += 1
        goes_on = text[at : at + 6].lstrip(" ").lower().startswith(_DOTS) or text[max(begin, at - 5) : at].lower().endswith(_DOTS)
        if at == begin or not goes_on:
            return at


_DOTS = ("[dot]", "(dot)")


_DISGUISED = re.compile(r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]+)+", re.I)
_AT = re.compile(r" ?[\[(]at[\])] ?", re.I)
# A local part has at most 64 characters, a name of the host 63, a host 127 names.
_LOCAL_CHARS = 64
_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,126}", re.I)
_GROUPS = re.compile(r"[^0-9]+")
_MORE_HOST = re.compile(r"\.?[A-Za-z0-9]| ?[\[(]dot[\])]", re.I)
_MORE_DIGITS = re.compile(r"[\x20()./-]{1,2}[0-9]")
_DIGITS_BEFORE = re.compile(r"[0-9][\x20()./-]{1,2}$")
_NUMERIC = re.compile(r"[0-9\x20()./+-]+")


def features(text: str, begin: int, end: int):
    """(kind, names of features) for each kind the span might be; whole-span features, so not one per atom."""
    span = text[begin:end]
    if _NUMERIC.fullmatch(span):
        digits = digits_of(span)
        n = len(digits)
        groups = [len(g) for g in _GROUPS.split(span) if g]
        marks = {c for c in span if not c.isdigit()}
        tight = (begin == 0 or not (text[begin - 1].isalnum() or text[begin - 1] in "+(")) and (end == len(text) or not text[end].isalnum())
        common = ["tight" if tight else "cut", f"marks{min(3, len(marks - {' '}))}"]
        if 7 <= n <= 16:
            yield "phone", [
                *common, "plus" if span[0] == "+" else "zeros" if span.startswith("00") else "open" if span[0] == "(" else "bare",
                f"n{n}" if n < 10 or n > 13 else "n10-13", "grouped" if len(groups) >= 3 and max(groups) <= 5 else "plain",
                "dots" if "." in marks else "nodots", "slash" if "/" in marks else "noslash",
                "goes-on" if _MORE_DIGITS.match(text, end) or _DIGITS_BEFORE.search(text, max(0, begin - 3), begin) else "ends",
            ]
        if 13 <= n <= 19 and span[0].isdigit():
            even = len(set(groups[:-1])) <= 1
            yield "card", [*common, "luhn" if luhn(digits) else "noluhn", "n16" if n == 16 else "nother", "even" if even else "uneven"]
        if len(groups) == 4 and n <= 12 and "." in marks and span[0].isdigit():
            yield "ip", [*common, "octets" if all(int(g) <= 255 for g in _GROUPS.split(span)) else "large", "spaced" if " " in marks else "close"]
    elif "at" in span.lower() and _DISGUISED.fullmatch(span):
        tight = (begin == 0 or text[begin - 1] not in _LOCAL) and not _MORE_HOST.match(text, end)
        yield "email", ["tight" if tight else "cut", "ends-word" if span.rsplit(".")[-1][-2:].isalpha() else "ends-other"]


class Field:
    """Weights of (kind, feature), and the dynamic programs over a place."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.weights = dict(weights or {})

    def score(self, kind: str, names) -> float:
        w = self.weights
        return 0.0 if kind == OUTSIDE else w.get(kind, 0.0) + sum(w.get(f"{kind}:{f}", 0.0) for f in names)

    def best(self, place: Place) -> list[tuple[int, str, int]]:
        """Entities of the most probable segmentation."""
        top, back = [0.0] + [-math.inf] * place.n, [None] * (place.n + 1)
        for j in range(1, place.n + 1):
            for i, kind, names in place.candidates(j):
                s = top[i] + self.score(kind, names) - (MARGIN if kind != OUTSIDE else 0.0)
                if s > top[j]:
                    top[j], back[j] = s, (i, kind)
        out, j = [], place.n
        while j:
            i, kind = back[j]
            if kind != OUTSIDE:
                out.append((place.at[i], kind, place.at[j]))
            j = i
        return out[::-1]

    def gradient(self, place: Place, truth: set[tuple[int, str, int]], into: list[list]) -> dict[str, float]:
        """Features of the true segmentation less those expected under the model; ``into`` are the candidates of each end."""
        scores = [[self.score(k, f) for _, k, f in row] for row in into]
        ahead, behind = [0.0] + [-math.inf] * place.n, [-math.inf] * place.n + [0.0]
        for j in range(1, place.n + 1):
            ahead[j] = _log_sum([ahead[i] + s for (i, _, _), s in zip(into[j - 1], scores[j - 1], strict=True)])
        for j in range(place.n, 0, -1):
            for (i, _, _), s in zip(into[j - 1], scores[j - 1], strict=True):
                behind[i] = _log_sum([behind[i], behind[j] + s])
        out: dict[str, float] = defaultdict(float)
        for j in range(1, place.n + 1):
            for (i, kind, names), s in zip(into[j - 1], scores[j - 1], strict=True):
                if kind == OUTSIDE:
                    continue
                p = math.exp(ahead[i] + s + behind[j] - ahead[place.n])
                step = ((place.at[i], kind, place.at[j]) in truth) - p
                for f in (kind, *(f"{kind}:{f}" for f in names)):
                    out[f] += step
        return out

    def fit(self, examples: list[tuple[Place, set]]) -> "Field":
        squares: dict[str, float] = defaultdict(lambda: 1e-6)
        known = [(place, truth, [list(place.candidates(j)) for j in range(1, place.n + 1)]) for place, truth in examples]
        for _ in range(EPOCHS):
            for place, truth, into in known:
                for f, g in self.gradient(place, truth, into).items():
                    g -= 1e-3 * self.weights.get(f, 0.0)
                    squares[f] += g * g
                    self.weights[f] = self.weights.get(f, 0.0) + 0.5 * g / math.sqrt(squares[f])
        return self


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in xs))


def rewritten(kind: str, value: str, turn: int) -> str:
    """The same entity in a form that the base patterns do not know."""
    if kind == "email":
        local, _, host = value.partition("@")
        return f"{local} [at] {host}" if turn % 2 else f"{local}(at){host.replace('.', ' (dot) ')}"
    if kind == "phone":
        return "00" + value[1:] if turn % 2 else value[1:].replace(" ", "/").replace("/", " ", 1)
    if kind == "card":
        d = digits_of(value)
        return ".".join(d[i : i + 4] for i in range(0, len(d), 4)) if turn % 2 else "/".join(d[i : i + 4] for i in range(0, len(d), 4))
    return value.replace(".", " . ") if turn % 2 else value.replace(".", ". ")


def stretches(text: str):
    """(kind, begin, end, line, spans) of each base span no other one touches, and, as kind OUTSIDE, of each place.

    ``line`` is a stretch of the text around it; the other positions count from its start, and ``spans`` are the entities.
    """
    base = base_spans(text)
    found = []
    for b, kind, e in base:
        if e - b <= EXAMPLE_CHARS and not any(o != (b, kind, e) and o[0] < e and b < o[2] for o in base):
            found.append((kind, b, e, [(b, kind, e)]))
    for place in places(text, base):
        b, e = place.at[0], place.at[-1]
        if e - b <= EXAMPLE_CHARS:
            found.append((OUTSIDE, b, e, [s for s in base if b <= s[0] and s[2] <= e]))
    for kind, b, e, spans in found:
        start = max(0, b - AROUND)
        yield kind, b - start, e - start, text[start : e + AROUND], _joined([(x - start, k, y - start) for x, k, y in spans])


def sampled(docs: DataFrame) -> DataFrame:
    """Of each kind the SAMPLE different stretches of all rows with the smallest hashes: h, kind, line, begin, end, spans.

    A task sends no more than these of its own rows.
    """
    hit = F.coalesce("text", F.lit("")).rlike(r"@[A-Za-z0-9-]+\.|\+[0-9][\x20().0-9-]{8}|[0-9][0-9\x20-]{12}|[0-9]\.[0-9]+\.[0-9]")
    schema = "h long, kind string, line string, begin int, end int, spans string"
    names = ("h", "kind", "line", "begin", "end", "spans")

    def run(batches):
        least: dict = defaultdict(dict)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for kind, begin, end, line, spans in stretches(text):
                    h = hashlib.blake2b(f"{begin}:{end}:{line}".encode(), digest_size=8).digest()
                    least[kind][int.from_bytes(h, "big", signed=True)] = (kind, line, begin, end, spans)
            for kind, rows in least.items():
                if len(rows) > SAMPLE:
                    least[kind] = {h: rows[h] for h in heapq.nsmallest(SAMPLE, rows)}
        rows = [(h, *row) for kind in sorted(least) for h, row in least[kind].items()]
        types = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
        yield {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types, strict=True))}

    rows = written(map_batches(docs.where(hit).select("text"), run, schema), "stretches").dropDuplicates(["kind", "h"])
    best = Window.partitionBy("kind").orderBy("h")
    return rows.withColumn("number", F.row_number().over(best)).where(F.col("number") <= SAMPLE)


def train(docs: DataFrame) -> Field:
    """A field fitted on base spans of all rows, SAMPLE of each kind, and on as many places with digits that are none."""
    examples = []
    rows = sampled(docs).collect()  # at most (kinds + 1) * SAMPLE
    for r in sorted(rows, key=lambda r: (r["number"], r["kind"])):
        if r["kind"] == OUTSIDE:
            spans = (s.split(":") for s in r["spans"].split(",") if s)
            examples.append((Place(r["line"], r["begin"], r["end"]), {(int(b), kind, int(e)) for kind, b, e in spans}))
            continue
        before, value, after = r["line"][: r["begin"]], r["line"][r["begin"] : r["end"]], r["line"][r["end"] :]
        for form in (value, rewritten(r["kind"], value, r["number"])):
            line = f"{before}{form}{after}"
            examples.append((Place(line, 0, len(line)), {(len(before), r["kind"], len(before) + len(form))}))
        # Numbers that are nothing: their digits run on, or fail the checksum.
        number = r["number"] * len(KINDS) + KINDS.index(r["kind"])
        examples += [(Place(line, 0, len(line)), set()) for line in (f"id {number}7003921{number} ref", f"2024.{number % 12}.11 10.{number}.2025", f"v{number}.4.2.9.1.77 x")]
    return Field().fit(examples)


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """All spans of each document: doc_id, base spans and all spans as kind:start:end lists, counts of base spans."""
    weights = dict(field.weights)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches):
        model = Field(weights)
        for batch in batches:
            out = defaultdict(list)
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                added = [s for p in places(text, base) for s in model.best(p)]
                added = [s for s in added if not any(s[0] < e and b < s[2] for b, _, e in base)]
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(k == kind for _, k, _ in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))))
                out["n_added"].append(len(added))
            yield {"doc_id": batch.column("doc_id"), **{k: pa.array(v) for k, v in out.items()}}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), run, schema)


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for b, kind, e in spans)


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """The same rows and columns, with every span in ``text`` replaced by its kind in angle brackets; null stays null."""
    weights = dict(field.weights)
    kept = docs.schema

    def run(batches):
        model = Field(weights)
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    spans = sorted(base + [s for p in places(text, base) for s in model.best(p)])
                    parts, at = [], 0
                    for b, kind, e in spans:
                        if b >= at:
                            parts += [text[at:b], f"<{kind}>"]
                        at = max(at, e)
                    text = "".join([*parts, text[at:]]) if spans else text
                texts.append(text)
            yield {name: batch.column(name) if name != "text" else pa.array(texts, pa.string()) for name in kept.names}

    return map_batches(docs, run, kept)


def find(docs: DataFrame) -> DataFrame:
    return detect(docs, train(docs))
