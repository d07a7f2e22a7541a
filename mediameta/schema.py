"""Column sets, schemas and parameters shared by all modules."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The required input columns, in canonical order.
RAW_COLUMNS = ["name", "show_name", "season", "episode", "reasoning", "confidence", "crc_hash"]

# The members of the target object; their order is significant.
TARGET_KEYS = ["show_name", "season", "episode", "crc_hash", "confidence", "reasoning"]

# The issue names, in report order.
ISSUES = ["long_filenames", "duplicates", "bad_crc_format", "missing_episode"]

# The six score names, in report order.
METRICS = [
    "json_validity",
    "key_order_match",
    "field_type_valid",
    "episode_present",
    "crc_format",
    "exact_json_match",
]

RAW_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType(), False)]
    + [T.StructField(c, T.StringType()) for c in RAW_COLUMNS]
)

GENERATION_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType(), False),
        T.StructField("attempt", T.IntegerType(), False),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("top_p", T.DoubleType()),
        T.StructField("gen_tokens", T.IntegerType(), False),
        T.StructField("decoded", T.StringType()),
        T.StructField("obj", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)

# Temperature and top_p per generation attempt.
ATTEMPT_SCHEDULE = [(0.0, 1.0), (0.1, 0.95), (0.2, 0.9), (0.3, 0.85)]


@dataclass(frozen=True)
class Params:
    """Data parameters of a preparation run. The defaults are fixed values."""

    seed: int = 14789
    eval_fraction: float = 0.1
    eval_max_samples: int | None = None
    require_episode: bool = True
    max_name_len: int = 200
    max_seq_length: int = 2048
    packing: bool = True

    def as_dict(self) -> dict:
        return asdict(self)


def normalize_header(columns: Sequence[str]) -> list[str]:
    """Header names trimmed and lower-cased."""
    return [c.strip().lower() for c in columns]


def column_difference(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) of normalized column names against the required set."""
    missing = [c for c in RAW_COLUMNS if c not in columns]
    extra = [c for c in columns if c not in RAW_COLUMNS]
    return missing, extra


def require_columns(columns: Sequence[str]) -> list[str]:
    """Raise ``ValueError`` naming the absent columns; return the extra ones."""
    missing, extra = column_difference(columns)
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return extra


def canonical(df: DataFrame, row_id: str | None = "row_id") -> DataFrame:
    """Normalize the header, check it, and project to ``row_id`` plus the seven columns.

    Extra columns are dropped by the projection, so the scan never reads them.
    """
    renamed = df.toDF(*normalize_header(df.columns))
    extra = [c for c in require_columns(renamed.columns) if c != row_id]
    if extra:
        warnings.warn(f"ignoring extra columns: {extra}", stacklevel=2)
    keys = [row_id] if row_id and row_id in renamed.columns else []
    return renamed.select(*keys, *RAW_COLUMNS)
