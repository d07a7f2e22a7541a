"""JSON objects inside free text.

Braces are balanced without regard to strings, then the balanced text is
parsed. One regular expression finds the first opening brace's object, nested
up to ``_NESTED`` deep, inside code generation. Only texts where it does not
decide the outcome get all their braces matched, by array expressions over the
braces alone: a running depth, and by depth the next brace that closes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.functions.render import ASSISTANT_TAG, END_OF_TEXT, SYSTEM_TAG, USER_TAG

# Tags which end a completion, and the stop texts of serving.
CHAT_TAGS = [SYSTEM_TAG, USER_TAG, ASSISTANT_TAG]
STOP_STRINGS = [END_OF_TEXT, USER_TAG, ASSISTANT_TAG]

# Error texts when retrying at later braces, and of the single try.
RETRY_ERRORS = {"none": "no '{'", "open": "unbalanced braces", "parse": "json parse"}
SINGLE_ERRORS = {
    "none": "No '{' found.",
    "open": "No matching '}' found (unbalanced braces).",
    "parse": "JSON parse failed",
}

# How deep the one expression looks; deeper texts take the general way.
_NESTED = 8


def _object(depth: int) -> str:
    inner = f"(?:{_object(depth - 1)}[^{{}}]*+)*+" if depth > 1 else ""
    return rf"\{{[^{{}}]*+{inner}\}}"


# The text up to and with the first object; without a step back, so linear and with a flat stack.
_FIRST = rf"\A[^{{]*+({_object(_NESTED)})"
# Braces that are looked through in one go: the running values of a block are copied per brace.
_BLOCK = 256

# Outcomes of the scan over brace starts.
_SEEKING, _FOUND, _UNBALANCED = 0, 1, 2


def parses(text: Column) -> Column:
    """True for one strictly valid JSON value."""
    return F.try_parse_json(text).isNotNull()


def after_assistant_tag(text: Column) -> Column:
    """The text behind the first assistant tag, or all of it without a tag."""
    return F.element_at(F.split(text, re.escape(ASSISTANT_TAG), 2), -1)


def cut_at_stop_strings(text: Column, stops: list[str] | None = None) -> Column:
    """The text before the earliest stop text."""
    pattern = "|".join(re.escape(s) for s in (stops or STOP_STRINGS))
    return F.element_at(F.split(text, pattern, 2), 1)


def _spans(text: Column) -> Column:
    """(start, end), 1-based, per opening brace in text order; end is null if it stays open.

    Every brace gets its place and the depth it stands at, in blocks, so the work is linear in the text. Sorted by
    depth, then place, what follows an opening brace of the same depth is the one that closes it. A closing brace
    without an open one stands at depth 0 and counts for nothing.
    """
    braced = F.regexp_extract(text, r"(?s)\A.*[{}]", 0)
    pieces = F.regexp_extract_all(braced, F.lit("[^{}]*+[{}]"), F.lit(0))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int")), lambda i: F.slice(pieces, i * _BLOCK + 1, F.lit(_BLOCK))
    )
    whole, empty = F.lit(0), F.array().cast("array<struct<depth:int,at:int,opens:boolean>>")

    def step(acc: Column, piece: Column) -> Column:
        opens, at = F.endswith(piece, F.lit("{")), acc["at"] + F.length(piece)
        mark = F.struct(F.when(opens, acc["depth"] + 1).otherwise(acc["depth"]).alias("depth"), at.alias("at"), opens.alias("opens"))
        depth = F.when(opens, acc["depth"] + 1).otherwise(F.greatest(acc["depth"] - 1, whole))
        return F.struct(at.alias("at"), depth.alias("depth"), F.concat(acc["marks"], F.array(mark)).alias("marks"))

    def block(acc: Column, some: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), acc["depth"].alias("depth"), empty.alias("marks"))
        return _bind(
            F.aggregate(some, start, step),
            lambda x: F.struct(x["at"].alias("at"), x["depth"].alias("depth"), F.concat(acc["blocks"], F.array(x["marks"])).alias("blocks")),
        )

    none = F.array().cast("array<array<struct<depth:int,at:int,opens:boolean>>>")
    marks = F.aggregate(blocks, F.struct(whole.alias("at"), whole.alias("depth"), none.alias("blocks")), block, lambda acc: F.array_sort(F.flatten(acc["blocks"])))

    def pair(sorted_: Column) -> Column:
        def end(mark: Column, i: Column) -> Column:
            after = F.get(sorted_, i + 1)
            return F.struct(mark["at"].alias("start"), F.when((after["depth"] == mark["depth"]) & ~after["opens"], after["at"]).alias("end"), mark["opens"].alias("opens"))

        return F.array_sort(F.filter(F.transform(sorted_, end), lambda x: x["opens"]))

    return F.when(F.size(pieces) > 0, _bind(marks, pair))


def _inside(text: Column, span: Column) -> Column:
    """The text of a span; null for an open one."""
    return F.substr(text, span["start"], span["end"] - span["start"] + 1)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(text: Column, spans: Column) -> Column:
    """First parseable candidate in order of start, ended by the first open one."""

    def state(code: int, obj: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), obj.cast("string").alias("obj"))

    def attempt(span: Column) -> Column:
        return _bind(
            _inside(text, span),
            lambda c: F.when(c.isNull(), state(_UNBALANCED, F.lit(None)))
            .when(parses(c), state(_FOUND, c))
            .otherwise(state(_SEEKING, F.lit(None))),
        )

    return F.aggregate(
        spans,
        state(_SEEKING, F.lit(None)),
        lambda acc, span: F.when(acc["code"] == _SEEKING, attempt(span)).otherwise(acc),
    )


def extract_json(
    df: DataFrame,
    text: str,
    out: str = "obj",
    *,
    retry: bool = True,
    after_tag: bool | None = None,
    mode: str = "native",
) -> DataFrame:
    """Add ``out`` (JSON text or null) and ``out_error`` (empty on success).

    ``retry`` goes on at the next opening brace after a parse failure and stops
    at the first unbalanced one; without it only the first brace counts.
    ``after_tag`` (default: as ``retry``) skips what precedes the assistant tag.
    ``mode="python"`` parses with Python's rules: NaN, repeated keys.
    """
    after_tag = retry if after_tag is None else after_tag
    errors = RETRY_ERRORS if retry else SINGLE_ERRORS
    if mode == "python":
        run = python_extractor(retry, after_tag)
        p = f"_{out}_py"
        return (
            df.withColumn(p, run(F.col(text)))
            .withColumns({out: F.col(f"{p}.obj"), f"{out}_error": F.col(f"{p}.error")})
            .drop(p)
        )
    if mode != "native":
        raise ValueError(f"unknown mode: {mode}")

    u, first, ok, spans, found = (f"_{out}_{s}" for s in ("u", "first", "ok", "spans", "found"))
    U = F.col(u)
    work = df.withColumn(u, after_assistant_tag(F.col(text)) if after_tag else F.col(text))
    work = work.withColumn(first, F.nullif(F.regexp_extract(U, _FIRST, 1), F.lit("")))
    work = work.withColumn(ok, parses(F.col(first)))
    # With a single try the first object decides the outcome either way.
    decided = F.col(ok) if retry else F.col(first).isNotNull()
    general = ~F.coalesce(decided, F.lit(False)) & U.contains("{")
    work = work.withColumn(spans, _spans(F.when(general, U)))
    P = F.col(spans)
    if retry:
        scan = _scan(U, P)
    else:
        work = work.withColumn(found, _inside(U, F.get(P, F.lit(0))))
        only = F.col(found)
        scan = F.struct(
            F.when(only.isNull(), _UNBALANCED).when(parses(only), _FOUND).otherwise(_SEEKING).alias("code"),
            only.alias("obj"),
        )
    work = work.withColumn(found, F.when(P.isNotNull(), scan))
    code = F.coalesce(F.col(f"{found}.code"), F.when(F.col(ok), _FOUND), F.when(F.col(first).isNotNull(), _SEEKING))
    obj = F.when(P.isNotNull(), F.when(F.col(f"{found}.code") == _FOUND, F.col(f"{found}.obj"))).when(F.col(ok), F.col(first))
    error = (
        F.when(code == _FOUND, "")
        .when(code == _UNBALANCED, errors["open"])
        .when(code == _SEEKING, errors["parse"])
        .otherwise(errors["none"])
    )
    return work.withColumns({out: obj, f"{out}_error": error}).drop(u, first, ok, spans, found)


def balanced_prefix_length(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the length of the shortest prefix in which the first opened brace closes, else null."""
    spans, first = f"_{out}_spans", f"_{out}_first"
    U = F.col(text)
    work = df.withColumn(first, F.nullif(F.length(F.regexp_extract(U, _FIRST, 0)), F.lit(0)))
    work = work.withColumn(spans, _spans(F.when(F.col(first).isNull() & U.contains("{"), U)))
    end = F.get(F.col(spans), F.lit(0))["end"]
    return work.withColumn(out, F.coalesce(F.col(first), end)).drop(spans, first)


def truncate_completion(df: DataFrame, text: str, out: str = "truncated", *, stop_on_tags: bool = True) -> DataFrame:
    """Add ``out``, the shortest prefix at which generation stops, and ``stopped``.

    It stops when a chat tag is complete or when the first object closes.
    """
    cut, tag = f"_{out}_cut", f"_{out}_tag"
    work = balanced_prefix_length(df, text, cut)
    ends = [
        F.when(F.contains(F.col(text), F.lit(t)), F.instr(F.col(text), t) + len(t) - 1) for t in CHAT_TAGS
    ]
    work = work.withColumn(tag, F.least(*ends) if stop_on_tags else F.lit(None).cast("int"))
    end = F.least(F.col(cut), F.col(tag))
    return (
        work.withColumn(cut, end)
        .withColumns(
            {
                out: F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.left(F.col(text), F.col(cut))),
                "stopped": F.col(cut).isNotNull(),
            }
        )
        .drop(cut, tag)
    )


# --- the same rules by Python's parser, for one text ---


def _closings(text: str) -> dict[int, int]:
    """Opening position -> position of its closing brace."""
    stack: list[int] = []
    pairs = {}
    for m in re.finditer(r"[{}]", text):
        if m.group() == "{":
            stack.append(m.start())
        elif stack:
            pairs[stack.pop()] = m.start()
    return pairs


def python_truncate(text: str) -> str:
    """The shortest prefix that ends with a chat tag or closes the first object; else the whole text."""
    ends = [text.find(t) + len(t) for t in CHAT_TAGS if t in text]
    closing = _closings(text).get(text.find("{"))
    if closing is not None:
        ends.append(closing + 1)
    return text[: min(ends)] if ends else text


def python_stops(text: str, stop_on_tags: bool = False) -> bool:
    """True when the first object is closed, or a chat tag is complete."""
    if stop_on_tags and any(t in text for t in CHAT_TAGS):
        return True
    depth, start = 0, text.find("{")
    for m in re.finditer(r"[{}]", text[start:] if start >= 0 else ""):
        depth += 1 if m.group() == "{" else -1
        if not depth:
            return True
    return False


def python_extract(text: str, retry: bool = True, after_tag: bool = True) -> tuple[str | None, str]:
    """(compact JSON, "") or (None, error). NaN and infinities become their names."""
    if after_tag:
        text = text.split(ASSISTANT_TAG, 1)[-1]
    errors = RETRY_ERRORS if retry else SINGLE_ERRORS
    pairs = _closings(text)
    decoder = json.JSONDecoder(parse_constant=str)
    error = errors["none"]
    at = text.find("{")
    while at != -1:
        if at not in pairs:
            return None, errors["open"]
        try:
            value, end = decoder.raw_decode(text, at)
            # The object must end exactly at the balancing brace.
            if end == pairs[at] + 1:
                return json.dumps(value, ensure_ascii=False, separators=(",", ":")), ""
            error = f"{errors['parse']}: object and braces end at different places"
        except (ValueError, RecursionError) as e:
            error = f"{errors['parse']}: {e}"
        if not retry:
            break
        at = text.find("{", at + 1)
    return None, error


def python_extractor(retry: bool, after_tag: bool):
    """Arrow-batched UDF over ``python_extract``; a null text gives null."""

    @F.pandas_udf("obj string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            pairs = [(None, None) if t is None else python_extract(t, retry, after_tag) for t in texts]
            yield pd.DataFrame(pairs, columns=["obj", "error"])

    return run
