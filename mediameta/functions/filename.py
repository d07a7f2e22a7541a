"""Season, episode, checksum, title and confidence from filenames.

All patterns avoid look-around and consume their context, and run as native
expressions. A match is found once and its parts are read from the short match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.functions.render import target_json

# --- fixed values: tokens named by the extraction rules ---
ASSET_TOKENS = ["NCED", "NCOP", "OP", "ED", "PV", "CM", "SP", "OVA", "OAD"]
HONORIFICS = ["san", "kun", "chan", "sama", "dono", "sensei"]
# --- our choice: particles that stay lower-case, tokens that end a title ---
PARTICLES = ["no", "to", "wa", "o", "ga", "ni", "de", "wo"]
TITLE_END_ASSETS = ["NCED", "NCOP", "OVA", "OAD"]
QUALITY = (
    r"(?:\d{3,4}[pi]|[48]k|UHD|HDR|HD|BDRip|BD|DVD|WEB-DL|WEBRip|WEB|HDTV|AV1|HEVC|HVEC|AVC"
    r"|[xh]\.?26[45]|FLAC|AAC|AC3|10bit|8bit)"
)
# --- fixed values: confidence deductions ---
START, VERSION_COST, NO_SEASON_COST, NO_EPISODE_COST, NO_EPISODE_MAX = "1.00", "0.10", "0.10", "0.80", "0.20"
# Our choice inside the allowed range of 0.15 to 0.25.
INFERRED_COST = "0.15"

_B = r"(?i)(?:^|[^\p{L}\p{N}])"
_E = r"(?:\z|[^\p{L}\p{N}])"

EXTENSION = r"[.][A-Za-z0-9]{2,4}\z"
CRC = r"\[([0-9A-Fa-f]{8})\]\z"
SEASON = [
    _B + r"S(\d{1,2})(?:E\d|\z|[^\p{L}\p{N}])",
    _B + r"Season[ ._]*(\d{1,2})",
    _B + r"(\d{1,2})(?:st|nd|rd|th)[ ._]Season",
]
EXPLICIT_EPISODE = [
    _B + r"S\d{1,2}[ ._-]*E\d{1,4}(?:v\d+)?" + _E,
    _B + r"(?:Episode|Eps|Ep|E)[ ._]*\d{1,4}(?:v\d+)?" + _E,
    r"(?i)Season[ ._]*\d+[ ._-]*(?:Episode|Eps|Ep|E)[ ._]*\d{1,4}(?:v\d+)?" + _E,
]
# What ends a bare number. A hyphen does only if no letter or digit follows: else it belongs to a word of the title.
_AFTER_NUMBER = r"(?:[ ._\[(]|\z|-(?:\z|[^\p{L}\p{N}]))"
SPACED_EPISODE = r"[ ._]-[ ._]?\d{1,3}(?:v\d+)?" + _AFTER_NUMBER
# At the end a number may follow one between dashes: the title's own.
DASHED_EPISODE = [r"(?:[^0-9]|-\d{1,3})-\d{1,3}(?:v\d+)?\z", r"[^0-9]-\d{1,3}(?:v\d+)?-"]
# Number and version at the end of an episode match.
MATCH_NUMBER = r"(?i)(\d{1,4})(?:v\d+)?[^\p{L}\p{N}]*\z"
MATCH_VERSION = r"(?i)\dv\d+[^\p{L}\p{N}]*\z"
# A checksum may begin like a token (ED123456), so hex groups are taken out first, and a token's number is short.
HEX_GROUP = r"\[[0-9A-Fa-f]{8}\]"
ASSET = r"(?:^|[^\p{L}\p{N}])(?:" + "|".join(ASSET_TOKENS) + r")\d{0,2}" + _E

GROUP_TAG = r"\A\[[^\]]*\][ ._]*"
_META = r"(?:" + QUALITY + r"|S\d{1,2}[ ._-]*E\d{1,4}(?:v\d+)?)"
TITLE = (
    r"(?i)\A(.*?)[ ._]+(?:-[ ._]+)?(?:"
    r"\["
    r"|\(" + _META + r"(?:[ ._,-]+" + _META + r")*\)"
    r"|" + QUALITY + r"(?:[ ._\[(]|\z)"
    r"|S\d{1,2}(?:[ ._-]*E\d{1,4}(?:v\d+)?)?" + _E +
    r"|\d{1,2}(?:st|nd|rd|th)[ ._]Season"
    r"|Season[ ._]*\d"
    r"|(?:Episode|Eps|Ep|E)[ ._]*\d{1,4}(?:v\d+)?" + _E +
    r"|(?:" + "|".join(TITLE_END_ASSETS) + r")\d*" + _E +
    r"|-[ ._]?\d{1,3}(?:v\d+)?" + _AFTER_NUMBER +
    r")"
)
# The title ends where the episode begins: at the last number of the stem, else at the first between dashes.
DASHED_TITLE = [r"\A(.*(?:[^0-9]|-\d{1,3}))-\d{1,3}(?:v\d+)?\z", r"\A(.*?[^0-9])-\d{1,3}(?:v\d+)?-"]
SLUG = r"\A[^ _.-][^ _.]*-[^ _.]*-[^ _.]*[^ _.-]\z"
SLUG_NUMBER = r"-\d{1,3}\z"


def _match(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def stem(name: Column) -> Column:
    """The name without its file extension."""
    return F.regexp_replace(name, EXTENSION, "")


def crc_hash(stem_: Column) -> Column:
    """Eight hex digits in brackets at the end of the stem, in upper case."""
    return F.upper(_match(stem_, CRC, 1))


def season(stem_: Column) -> Column:
    """The explicit season number; never inferred."""
    return F.coalesce(*[_match(stem_, p, 1) for p in SEASON]).cast("bigint")


def asset(stem_: Column) -> Column:
    """True when the stem holds a token of a non-episode asset."""
    return F.regexp_replace(stem_, HEX_GROUP, "[]").rlike(ASSET)


def _slug_title(c: Column) -> Column:
    words = F.split(F.replace(c, F.lit("---"), F.lit("-\u0002-")), "-")

    def word(w: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        attached = w.isin(HONORIFICS) | F.coalesce(before.rlike(r"\d\z"), F.lit(False))
        cased = F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
        return (
            F.when(w == "\u0002", F.lit(" -"))
            .when((i > 0) & attached, F.concat(F.lit("-"), w))
            .otherwise(
                F.concat(
                    F.when(i == 0, "").otherwise(" "),
                    F.when(w.isin(PARTICLES), w).otherwise(cased),
                )
            )
        )

    return F.array_join(F.transform(words, word), "")


def parse_filename(df: DataFrame, name: str = "name", prefix: str = "fn_") -> DataFrame:
    """Add ``<prefix>stem, crc, season, asset, explicit, spaced, dashed, episode, version, title, confidence``.

    The steps are separate projections, so each match is computed once.
    """
    p = lambda s: f"{prefix}{s}"
    c = lambda s: F.col(p(s))

    out = df.withColumn(p("stem"), stem(F.col(name)))
    out = out.withColumns(
        {
            p("crc"): crc_hash(c("stem")),
            p("season"): season(c("stem")),
            p("asset"): asset(c("stem")),
            p("explicit"): F.coalesce(*[_match(c("stem"), x) for x in EXPLICIT_EPISODE]),
        }
    )
    # A bare number counts only without an explicit marker and outside assets.
    bare = c("explicit").isNull() & ~c("asset")
    out = out.withColumn(p("spaced"), F.when(bare, _match(c("stem"), SPACED_EPISODE)))
    out = out.withColumn(
        p("dashed"),
        F.when(bare & c("spaced").isNull(), F.coalesce(*[_match(c("stem"), x) for x in DASHED_EPISODE])),
    )
    marker = F.coalesce(c("explicit"), c("spaced"), c("dashed"))
    out = out.withColumns(
        {
            p("episode"): _match(marker, MATCH_NUMBER, 1).cast("bigint"),
            p("version"): F.coalesce(marker.rlike(MATCH_VERSION), F.lit(False)),
        }
    )
    # A slug ends with its number, unless the title was cut there already.
    slug = F.when(c("dashed").isNull(), F.regexp_replace(c("_cut"), SLUG_NUMBER, "")).otherwise(c("_cut"))
    return (
        out.withColumn(p("_body"), F.regexp_replace(c("stem"), GROUP_TAG, ""))
        .withColumn(p("_cut"), F.coalesce(_match(c("_body"), TITLE, 1), c("_body")))
        .withColumn(
            p("_cut"),
            F.coalesce(F.when(c("dashed").isNotNull(), F.coalesce(*[_match(c("_cut"), x, 1) for x in DASHED_TITLE])), c("_cut")),
        )
        .withColumns(
            {
                p("title"): F.when(c("_cut").rlike(SLUG), _slug_title(slug)).otherwise(
                    F.trim(F.regexp_replace(c("_cut"), r"[ ._]+", " "))
                ),
                p("confidence"): confidence(
                    c("season"), c("episode"), c("version"), c("explicit").isNull()
                ),
            }
        )
        .drop(p("_body"), p("_cut"))
    )


def confidence(season_: Column, episode_: Column, version: Column, inferred: Column) -> Column:
    """Start at 1 and subtract; exact in decimals, then DOUBLE."""

    def cost(when: Column, value: str) -> Column:
        return F.when(when, F.lit(value).cast("decimal(3,2)")).otherwise(F.lit("0").cast("decimal(3,2)"))

    found = episode_.isNotNull()
    value = (
        F.lit(START).cast("decimal(3,2)")
        - cost(found & version, VERSION_COST)
        - cost(season_.isNull(), NO_SEASON_COST)
        - cost(found & inferred, INFERRED_COST)
        - cost(~found, NO_EPISODE_COST)
    ).cast("double")
    limit = F.when(found, F.lit(1.0)).otherwise(F.lit(float(NO_EPISODE_MAX)))
    return F.greatest(F.lit(0.0), F.least(value, limit))


def reasoning(
    season_: Column, episode_: Column, version: Column, inferred: Column, is_asset: Column
) -> Column:
    """One sentence on the season and one on the episode."""
    return F.concat(
        F.when(season_.isNull(), "No season marker is present. ").otherwise(
            F.concat(F.lit("Season "), season_.cast("string"), F.lit(" has an explicit marker. "))
        ),
        F.when(
            episode_.isNull() & is_asset, "The name marks a non-episode asset, so no episode is set."
        )
        .when(episode_.isNull(), "No episode marker or separated number was found.")
        .otherwise(
            F.concat(
                F.lit("Episode "),
                episode_.cast("string"),
                F.when(inferred, " is inferred from a number after a separator").otherwise(
                    " has an explicit marker"
                ),
                F.when(version, " with a version suffix.").otherwise("."),
            )
        ),
    )


def extract_metadata(df: DataFrame, name: str = "name") -> DataFrame:
    """Replace the target columns by values read from the name and add ``target``, the JSON object."""
    x = parse_filename(df, name, prefix="_x_")
    c = lambda s: F.col(f"_x_{s}")
    keep = [col for col in df.columns if col not in _TARGETS and col != "target"]
    typed = x.select(
        *keep,
        c("title").alias("show_name"),
        c("season").alias("season"),
        c("episode").alias("episode"),
        c("crc").alias("crc_hash"),
        c("confidence").alias("confidence"),
        reasoning(
            c("season"), c("episode"), c("version"), c("explicit").isNull(), c("asset")
        ).alias("reasoning"),
    )
    return typed.withColumn("target", target_json(*[F.col(k) for k in _TARGETS]))


_TARGETS = ["show_name", "season", "episode", "crc_hash", "confidence", "reasoning"]
