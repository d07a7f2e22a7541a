"""Operations on arrays of token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker of positions which the loss ignores.
IGNORE_ID = -100


def attention_mask(ids: Column, pad_id: int | None) -> Column:
    """1 where the id differs from the pad id; all 1 without a pad id."""
    if pad_id is None:
        return F.transform(ids, lambda _: F.lit(1))
    return F.transform(ids, lambda x: (x != F.lit(pad_id)).cast("int"))


def replace_ignored(ids: Column, pad_id: int | None = None, eos_id: int | None = None) -> Column:
    """Ignore marker replaced by the pad id, else the end id, else 0."""
    fill = next((i for i in (pad_id, eos_id) if i is not None), 0)
    return F.transform(ids, lambda x: F.when(x == IGNORE_ID, F.lit(fill).cast("bigint")).otherwise(x))


def truncate_ids(ids: Column, limit: int) -> Column:
    """The first ``limit`` ids."""
    return F.slice(ids, 1, limit)


def generated_suffix(ids: Column, prompt_len: Column) -> Column:
    """The ids that follow the prompt."""
    return F.slice(ids, prompt_len + 1, F.greatest(F.size(ids) - prompt_len, F.lit(0)))


def generated_count(ids: Column, prompt_len: Column) -> Column:
    """How many ids follow the prompt."""
    return F.greatest(F.size(ids) - prompt_len, F.lit(0))
