"""Target objects, prompts and chat texts."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chat markers.
SYSTEM_TAG = "<|system|>"
USER_TAG = "<|user|>"
ASSISTANT_TAG = "<|assistant|>"
END_OF_TEXT = "<|endoftext|>"

# Fixed value: the user template.
USER_TEMPLATE = 'Filename: "{filename}"\nExtract metadata.'


def template_parts(template: str) -> list[str | None]:
    """Literal parts of a user template; ``None`` stands for the filename.

    ``{{`` and ``}}`` are escapes. ``ValueError`` when the placeholder is absent
    or another field occurs.
    """
    parts: list[str | None] = []
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(literal)
        if field is not None:
            if field != "filename" or spec or conversion:
                raise ValueError(f"unknown template field: {field!r}")
            parts.append(None)
    if None not in parts:
        raise ValueError("the user template must contain '{filename}'")
    return parts


def user_prompt(name: Column, template: str = USER_TEMPLATE) -> Column:
    """The template around the name; a null name counts as empty."""
    value = F.coalesce(name, F.lit(""))
    return F.concat(*[value if p is None else F.lit(p) for p in template_parts(template)])


def confidence_text(c: Column) -> Column:
    """A confidence in [0, 1] written as its shortest decimal form (``5e-05``, ``0.0005``, ``0.9``)."""
    t = c.cast("string")
    scientific = r"\A(\d)\.(\d+)E-(\d+)\z"
    head = F.regexp_extract(t, scientific, 1)
    tail = F.regexp_replace(F.regexp_extract(t, scientific, 2), r"\A0\z", "")
    power = F.regexp_extract(t, scientific, 3)
    return (
        F.when(c.isNull(), "0.0")
        .when((c >= 1e-3) | (c == 0), t)
        .when(c >= 1e-4, F.concat(F.lit("0.000"), head, tail))
        .otherwise(
            F.concat(
                head,
                F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)),
                F.lit("e-"),
                F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power),
            )
        )
    )


def target_json(
    show_name: Column, season: Column, episode: Column, crc_hash: Column, confidence: Column, reasoning: Column
) -> Column:
    """The six members as compact JSON in fixed order, nulls kept."""
    keep_nulls = {"ignoreNullFields": "false"}
    front = F.to_json(
        F.struct(
            F.coalesce(show_name, F.lit("")).alias("show_name"),
            season.alias("season"),
            episode.alias("episode"),
            crc_hash.alias("crc_hash"),
        ),
        keep_nulls,
    )
    back = F.to_json(F.struct(F.coalesce(reasoning, F.lit("")).alias("reasoning")), keep_nulls)
    return F.concat(
        # The last member is null or a quoted text, so only the closing brace goes.
        F.rtrim(front, F.lit("}")),
        F.lit(',"confidence":'),
        confidence_text(confidence),
        F.lit(","),
        F.ltrim(back, F.lit("{")),
    )


def row_target_json() -> Column:
    """``target_json`` over the canonical columns."""
    return target_json(
        *[F.col(c) for c in ("show_name", "season", "episode", "crc_hash", "confidence", "reasoning")]
    )


def training_text(system: Column, user: Column, target: Column) -> Column:
    """Three blocks joined by newlines, closed by the end-of-text marker."""
    return F.concat(
        F.lit(SYSTEM_TAG + "\n"), system,
        F.lit("\n" + USER_TAG + "\n"), user,
        F.lit("\n" + ASSISTANT_TAG + "\n"), target,
        F.lit(END_OF_TEXT),
    )


def inference_prompt(system: Column, user: Column) -> Column:
    """The layout of the training text with an open assistant block."""
    return F.concat(
        F.lit(SYSTEM_TAG + "\n"), system,
        F.lit("\n" + USER_TAG + "\n"), user,
        F.lit("\n" + ASSISTANT_TAG + "\n"),
    )


def serving_prompt(system: Column, user: Column) -> Column:
    """The serving layout: as ``inference_prompt`` with blank lines between blocks."""
    return F.concat(
        F.lit(SYSTEM_TAG + "\n"), system,
        F.lit("\n\n" + USER_TAG + "\n"), user,
        F.lit("\n\n" + ASSISTANT_TAG + "\n"),
    )


def chat_messages(system: Column, user: Column) -> Column:
    """System and user messages as an array of (role, content)."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )
