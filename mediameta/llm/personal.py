"""Personal data in texts: fixed patterns, and further spans by weak supervision.

The fixed patterns always count. What they miss, as numbers that run together, spelled-out addresses or numbers without a
country code, are candidates. Labelers of three sorts vote on every candidate and on every fixed match: patterns, a
gazetteer, and the words and characters around it. Expectation-maximisation over all votes of the corpus estimates how
reliable each labeler is for each kind, and the probabilities it gives train a logistic classifier on the look of a span
and its surroundings, which decides on the candidates. Votes and looks are counted by Spark over all documents; only the
tables of counts, whose size is fixed by the number of labelers and features, reach the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.llm.common import written

# Fixed values of the contract: kinds in order, characters of an address, patterns.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# Our choice: what further spans may look like. Every pattern is bounded, so a text is gone through once.
_NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])*+")
_CARD_LOOK = re.compile(r"(?<![0-9A-Za-z])(?:(?:[0-9]{4}[\x20-]?){3}[0-9]{2,7}|[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{4,5}|[0-9]{14,19})(?![0-9A-Za-z])")
_PHONE_LOOK = re.compile(
    r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])"
)
_SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_AT = re.compile(r"(?i)[\x20]?[\[(][\x20]?at[\x20]?[\])][\x20]?|[\x20]at[\x20]")
_SPELLED = re.compile(r"(?i)([A-Za-z0-9-]{1,63}(?:[\x20]?[\[(][\x20]?dot[\x20]?[\])][\x20]?|[\x20]dot[\x20]|\.))+[A-Za-z]{2,24}(?![A-Za-z0-9])")
_BEFORE_AT = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\Z")

# Our choice: the gazetteer.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io dev app eu uk de fr es it nl be ch at pl se no dk fi ru cn jp kr in br mx ca au nz us".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420".split())
CUES = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|adresse|login|from)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|paid|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|telefon|telefono|call|mobile|fax|cell|ring|sms)\b"),
}
#: Words before a number that is something else.
OTHERWISE = re.compile(r"(?i)\b(?:version|v|isbn|issn|page|pages|chapter|section|order|invoice|figure|table|serial|part|id|no|nr|item|price|total|eur|usd)[.:#]?[\x20]*\Z")
AROUND = 40

LABELERS, FEATURES, VOTES = 6, 13, 3
_ROUNDS = 60


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's patterns, sorted. Linear in the text, whatever it holds."""
    out = []
    last, at = 0, text.find("@")
    while at != -1:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, domain.end()))
                last = domain.end()
        at = text.find("@", at + 1)
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i : i + 4])) + 3
            if all(len(p) < 4 and int(p) < 256 or len(q := p.lstrip("0")) < 4 and int(q or "0") < 256 for p in parts[i : i + 4]):
                out.append((at, 1, end))
            at = end + 1
    for m in _CARD.finditer(text):
        if CARD_DIGITS[0] <= m.end() - m.start():
            digits = _digits(m.group())
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what else may be personal data; may overlap fixed spans and each other."""
    out = []
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() < 8:
            continue
        out.extend((c.start(), 2, c.end()) for c in _CARD_LOOK.finditer(text, m.start(), m.end()))
        out.extend((c.start(), 3, c.end()) for c in _PHONE_LOOK.finditer(text, m.start(), m.end()))
    if text.count(":") > 6:
        out.extend((m.start(), 1, m.end()) for m in _SIX.finditer(text))
    if re.search(r"(?i)[\[(\x20]dot[\])\x20]|[\[(][\x20]?at[\x20]?[\])]", text):
        for m in _AT.finditer(text):
            name = _BEFORE_AT.search(text, max(0, m.start() - 64), m.start())
            host = _SPELLED.match(text[m.end() : m.end() + 256])
            # A bare "at" needs a spelled dot, or every sentence end would do.
            if name and host and (m.group().strip().lower() != "at" or re.search(r"(?i)dot", host.group())):
                out.append((name.start(), 0, m.end() + host.end()))

    def apart(i: int, step: int) -> bool:
        # Not a piece of a longer name or number: "16-148410" in "978-3-16-148410-0".
        at = lambda j: text[j] if 0 <= j < len(text) else " "
        return not at(i).isalnum() and not (at(i) in "-./:,_" and at(i + step).isdigit())

    return sorted((s, k, e) for s, k, e in out if apart(s - 1, -1) and apart(e, 1))


def judge(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """The labelers' votes (base 3: 0 no, 1 none, 2 yes) and the features of a span (bits)."""
    span, name = text[start:end], KINDS[kind]
    before, behind = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits = _digits(span)
    words = re.split(r"[^A-Za-z0-9]+", span.lower())
    if kind == 0:
        strict, known = bool(re.search(r"[A-Za-z]{2,24}\Z", span)), words[-1] in TOP_DOMAINS
    elif kind == 1:
        parts = span.split(".")
        strict = len(parts) == 4 and all(p == str(int(p)) for p in parts if len(p) < 4) or bool(_SIX.fullmatch(span))
        known = not (len(parts) == 4 and (int(parts[0][-3:]) in (0, 255) or 224 <= int(parts[0][-3:]) < 256))
    elif kind == 2:
        strict = luhn(digits)
        known = len(digits) in (15, 16) and bool(re.match(r"4|5[1-5]|2[2-7]|3[47]|6011|65", digits))
    else:
        strict = (span[0] == "+" or "(" in span) and PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]
        code = re.match(r"\+([0-9]{1,3})", span)
        known = (any(code[1][:n] in CALLING_CODES for n in (1, 2, 3)) if code else len(digits) == 10 and digits[0] not in "01")
    left, right = before[-1:], behind[:1]
    apart = not (left.isalnum() or left in ("/", "=", "_", "#")), not (right.isalnum() or right in ("/", "=", "_"))
    cue, other = bool(CUES[name].search(before)), bool(OTHERWISE.search(before))
    dull = len(set(digits)) < 3 and kind > 1 or digits in "01234567890123456789" and len(digits) > 6
    said = [
        2 if strict else 0,
        2 if known else 0,
        2 if cue else 0 if other else 1,
        2 if all(apart) else 0,
        0 if dull else 1 if kind < 2 else 2,
        0 if other else 2 if re.match(r"[\x20]*(?:[.,;)\n]|\Z)|[\x20]", behind) else 1,
    ]
    votes = sum(v * VOTES**i for i, v in enumerate(said))
    size = len(digits) if kind > 1 else len(span)
    bits = [
        "+" in span, "(" in span, " " in span, "-" in span, "." in span, apart[0], apart[1], cue, other,
        size > (12 if kind else 20), size > (15 if kind else 40), strict, known,
    ]
    return votes, sum(b << i for i, b in enumerate(bits))


_FOUND = "array<struct<start:int,kind:int,end:int,fixed:boolean,votes:int,look:int>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("fixed", pa.bool_()), ("votes", pa.int32()), ("look", pa.int32())])
    for batch in batches:
        found = []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            text = text or ""
            fixed = fixed_spans(text)
            taken = _overlaps(fixed)
            spans = [(*s, True) for s in fixed] + [(*s, False) for s in candidates(text) if not taken(s)]
            found.append([dict(zip(("start", "kind", "end", "fixed", "votes", "look"), (*s, *judge(text, *s[:3])), strict=True)) for s in spans])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(item))], [*batch.schema.names[:-1], "found"])


def _overlaps(fixed: list[tuple[int, int, int]]) -> Callable[[tuple[int, int, int]], bool]:
    """Whether a span overlaps a fixed one. Those of one kind do not overlap, so only the last that starts before its end can."""
    starts, ends = ([[s[at] for s in fixed if s[1] == kind] for kind in range(len(KINDS))] for at in (0, 2))

    def test(span: tuple[int, int, int]) -> bool:
        last = [bisect_left(own, span[2]) - 1 for own in starts]
        return any(i >= 0 and ends[kind][i] > span[0] for kind, i in enumerate(last))

    return test


def reliabilities(counts: dict[int, int]) -> tuple[float, np.ndarray]:
    """Of vote patterns and their numbers: the share of true spans, and P(vote | false or true) of each labeler.

    Expectation-maximisation from labelers that are right more often than not; a few made-up votes keep all rates inside
    (0, 1) and their meaning in place where a kind is rare.
    """
    start = np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]])
    rates, prior = np.repeat(start[None], LABELERS, axis=0), 0.5
    if not counts:
        return prior, rates
    patterns = np.array(list(counts))[:, None] // VOTES ** np.arange(LABELERS) % VOTES
    number = np.array(list(counts.values()), float)
    for _ in range(_ROUNDS):
        true = truth(prior, rates, patterns)
        prior = (number @ true + 1) / (number.sum() + 2)
        for j in range(LABELERS):
            for y, weight in enumerate((number * (1 - true), number * true)):
                seen = np.bincount(patterns[:, j], weight, VOTES) + 5 * start[y]
                rates[j, y] = seen / seen.sum()
    return prior, rates


def truth(prior: float, rates: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """P(true | votes) of rows of votes."""
    said = np.log(rates[np.arange(LABELERS)[None], :, patterns]).sum(axis=1) + np.log([1 - prior, prior])
    return 1 / (1 + np.exp(np.clip(said[:, 0] - said[:, 1], -50, 50)))


def fit(looks: np.ndarray, number: np.ndarray, true: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on the bits of ``looks``, by Newton's steps with a ridge."""
    x = np.hstack([(looks[:, None] >> np.arange(FEATURES) & 1) * 2.0 - 1, np.ones((len(looks), 1))])
    w = np.zeros(FEATURES + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (number * (true - p)) - w
        curve = (x * (number * p * (1 - p))[:, None]).T @ x + np.eye(FEATURES + 1)
        w = w + np.linalg.solve(curve, slope)
    return w


def train(found: DataFrame) -> dict[int, np.ndarray]:
    """The span classifier of each kind, from the spans of all documents in ``found``.

    At most len(KINDS) * VOTES ** LABELERS rows of votes and len(KINDS) * 2 ** FEATURES rows of looks are collected.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.votes", "s.look")
    counts = written(spans.groupBy("kind", "votes", "look").count(), "personal-votes")
    told = counts.groupBy("kind", "votes").agg(F.sum("count").alias("n")).collect()
    chances = []
    for kind in range(len(KINDS)):
        votes = {r["votes"]: r["n"] for r in told if r["kind"] == kind}
        if votes:
            patterns = np.array(list(votes))[:, None] // VOTES ** np.arange(LABELERS) % VOTES
            chances += [(kind, v, float(p)) for v, p in zip(votes, truth(*reliabilities(votes), patterns), strict=True)]
    true = found.sparkSession.createDataFrame(chances, "kind int, votes int, true double")
    soft = counts.join(F.broadcast(true), ["kind", "votes"]).groupBy("kind", "look")
    rows = soft.agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("true")).alias("true")).collect()
    models = {}
    for kind in range(len(KINDS)):
        mine = sorted((r["look"], r["n"], r["true"]) for r in rows if r["kind"] == kind)
        if mine:
            look, number, right = (np.array(c, float) for c in zip(*mine, strict=True))
            models[kind] = fit(look.astype(np.int64), number, right / number)
    return models


def _decide(models: dict[int, np.ndarray]):
    def likely(span: dict) -> float:
        x = np.append((span["look"] >> np.arange(FEATURES) & 1) * 2.0 - 1, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ models[span["kind"]], -30, 30))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("fixed", pa.bool_()), ("chance", pa.float64())])
        for batch in batches:
            out = []
            for spans in batch.column(batch.num_columns - 1).to_pylist():
                kept = [s for s in spans if s["fixed"]]
                taken = -1
                for s in sorted((s for s in spans if not s["fixed"]), key=lambda s: (s["start"], -s["end"], s["kind"])):
                    if s["start"] >= taken and likely(s) >= 0.5:
                        kept.append(s)
                        taken = s["end"]
                kept.sort(key=lambda s: (s["start"], s["kind"]))
                out.append([{"start": s["start"], "kind": KINDS[s["kind"]], "end": s["end"], "fixed": s["fixed"], "chance": likely(s)} for s in kept])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(item))], [*batch.schema.names[:-1], "spans"])

    return run


def find_personal(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, spans) of each row; a span has start, kind, end (code points, end exclusive), fixed and chance.

    ``fixed`` spans are the patterns' matches, which stay whatever the classifier's ``chance``. The others do not overlap
    a fixed span or each other; of two that do, the first and then the longer is taken. Null text is empty; a text
    without spans has an empty list. Rows are judged one by one, so null and repeated ids stay apart, and a row that is
    there twice counts twice in training. Other columns are not read. An empty table gives no rows.
    """
    plain = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    found = written(plain.mapInArrow(_find, f"id {kind}, found {_FOUND}"), "personal-found")
    spans = "array<struct<start:int,kind:string,end:int,fixed:boolean,chance:double>>"
    return found.mapInArrow(_decide(train(found)), f"id {kind}, spans {spans}").withColumnRenamed("id", id)


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span, given as (start, kind, end) in order, as ``<kind>``; overlapping spans are one."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts and digests of ``find_personal``: ``n_*`` and ``base_sha256`` of the fixed spans, ``spans`` of all."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    fixed = F.filter("spans", lambda s: s["fixed"])
    number = lambda k: F.size(F.filter(fixed, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        id, *[number(k) for k in KINDS], F.sha2(shown(fixed), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(fixed)).cast("long").alias("n_added"),
    )
