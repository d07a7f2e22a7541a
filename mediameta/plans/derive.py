"""Inputs derived from the given tables.

No given table holds filenames or completions, so these texts build them from
whole tables. Each text runs unchanged on Spark and in the checking engine,
except the array views, which need one spelling per engine. A third of the
labelled names are one and the same hot name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediameta.sources.storage import scratch_path

NBSP, IDEOGRAPHIC_SPACE = "\u00a0", "\u3000"

# k: the key; j: k without the hot residue; e, s: episode and season numbers.
_BASE = """
SELECT o_orderkey AS k,
       CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT) AS j,
       o_orderkey % 26 + 1 AS e,
       o_orderkey % 4 + 1 AS s,
       upper(substr(md5(CAST(o_orderkey AS VARCHAR(20))), 1, 8)) AS crc,
       o_orderpriority AS pri
FROM orders"""

# The slash stands for a backslash, whose escaping differs between engines.
_TITLES = (
    'Harbor Lights|Kaze no Uta|7-seven-|Zero 3-4|Matte yo neko-chan|Tōi sora no mukō|'
    'Blue Door - Second Key|Say "Hi" / Bye|Garden (Niwa no Hana)'
)

_TITLED = f"""
SELECT b.*, lpad(CAST(e AS VARCHAR(20)), 2, '0') AS ee, CAST(e AS VARCHAR(20)) AS et, CAST(s AS VARCHAR(20)) AS st,
       replace(split_part('{_TITLES}', '|', CAST(j % 9 + 1 AS INT)), '/', chr(92)) AS title
FROM ({_BASE}) b"""

_NAMED = f"""
SELECT t.*,
       CASE
         WHEN k % 3 = 0 THEN 'Evening Sampler - 01.mkv'
         WHEN j % 17 = 0 THEN concat('[Grp] ', title, ' - ', ee, ' (1080p) [', crc, '].mkv')
         WHEN j % 17 = 1 THEN concat(title, ' - S0', st, 'E', ee, ' - Part 720p [', lower(crc), '].mkv')
         WHEN j % 17 = 2 THEN concat(replace(title, ' ', '_'), '_S0', st, '_-_E', ee, '_(4k).mkv')
         WHEN j % 17 = 3 THEN concat(replace(title, ' ', '.'), '.Season', st, '_Eps', ee, '(720p).FLAC.[', crc, '].mkv')
         WHEN j % 17 = 4 THEN concat(title, ' NCOP - 01.mkv')
         WHEN j % 17 = 5 THEN concat(title, ' - ', ee, 'v2 [', crc, '].mkv')
         WHEN j % 17 = 6 THEN concat(title, ' 2nd Season - ', ee, ' (BD).mkv')
         WHEN j % 17 = 7 THEN concat(title, ' (1080p).WEB-DL.[', crc, '].mkv')
         WHEN j % 17 = 8 THEN concat(title, ' S0', st, ' -', ee, '- (AV1) (x265).mkv')
         WHEN j % 17 = 9 THEN concat(title, ' S01E', ee, 'v3 OVA.mkv')
         WHEN j % 17 = 10 THEN concat('Episode ', et, ' ', title, '.mp4')
         WHEN j % 17 = 11 THEN concat(title, ' (Other Name) - ', ee, ' [1080p][', pri, '].mkv')
         WHEN j % 17 = 12 THEN concat('hoshi-no-', lower(replace(title, ' ', '-')), '-', ee, '.mkv')
         WHEN j % 17 = 13 THEN concat(title, ' - 3-Ri no baka - ', ee, '.mkv')
         WHEN j % 17 = 14 THEN concat(title, ' - 12-sai no haru - ', ee, ' [', crc, '].mkv')
         WHEN j % 17 = 15 THEN concat(title, ' - 9-nine- - ', ee, ' [1080p].mkv')
         ELSE concat('umi---aki-no-sora-sama-to-6-gou-', ee, ' (S0', st, 'E', ee, ').mkv')
       END AS base_name
FROM ({_TITLED}) t"""

_ODD_EPISODES = "None|2.00001|2.0001|100000.5|x|1_000|1e3|9007199254740993|99999999999999999999|+5|1d|-inf"
_CONFIDENCES = "1.7|-1|bad|||inf|0.0005|5e-05|1e-1|.25||0.9|0.95|0.85|0.75|1.0|0.1|0.9|0.9"

RAW_METADATA = f"""
SELECT k AS row_id,
       CASE
         WHEN j % 47 = 0 THEN 'NULL'
         WHEN j % 47 = 1 THEN NULL
         WHEN k % 17 = 0 THEN concat('"', base_name, '"')
         WHEN k % 17 = 1 THEN concat('  '' ', base_name, ' '' ')
         WHEN k % 17 = 2 THEN concat('{NBSP}', base_name, '{IDEOGRAPHIC_SPACE} ')
         WHEN j % 29 = 0 THEN concat(repeat('long title ', 19), base_name)
         ELSE base_name
       END AS name,
       CASE k % 13 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN concat('"', title, '"') WHEN 3 THEN 'null'
                   ELSE title END AS show_name,
       CASE WHEN j % 9 = 4 THEN NULL ELSE concat(split_part('nan|0|4.5| "||+|', '|', CAST(j % 9 + 1 AS INT)),
            CASE WHEN j % 9 IN (0, 2) THEN '' ELSE st END, CASE j % 9 WHEN 1 THEN '.0' WHEN 3 THEN '" ' ELSE '' END) END AS season,
       CASE WHEN j % 15 < 12 THEN split_part('{_ODD_EPISODES}', '|', CAST(j % 15 + 1 AS INT)) ELSE et END AS episode,
       CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN concat('''', title, ' read from the name''')
                  ELSE concat('order ', pri, ': "', et, '" found') END AS reasoning,
       CASE k % 19 WHEN 4 THEN NULL
                   WHEN 10 THEN concat('0.', lpad(CAST(k % 1000 AS VARCHAR(20)), 3, '0'), '1')
                   ELSE split_part('{_CONFIDENCES}', '|', CAST(k % 19 + 1 AS INT)) END AS confidence,
       CASE j % 11 WHEN 0 THEN concat('[', lower(crc), ']') WHEN 1 THEN 'ZZZZZZZZ' WHEN 2 THEN NULL
                   WHEN 3 THEN lower(crc) WHEN 4 THEN '[abc]' WHEN 5 THEN concat(' "', crc, '" ')
                   WHEN 6 THEN 'nan' ELSE crc END AS crc_hash
FROM ({_NAMED}) n"""

# The titles as slugs, and as titles once more: hyphens become spaces, but for those next to digits and before honorifics.
_SLUG_WANTED = (
    'Hoshi no Harbor Lights|Hoshi no Kaze no Uta|hoshi-no-7-seven-|Hoshi no Zero 3-4|Hoshi no Matte Yo Neko-chan|'
    'Hoshi no Tōi Sora no Mukō|Hoshi no Blue Door - Second Key|Hoshi no Say "hi" / Bye|Hoshi no Garden (niwa no Hana)'
)

# What is to be read from each name, by how the name was made and not by how it is read.
EXPECTED = f"""
SELECT row_id, name, want_title, want_season, want_episode, want_explicit AND want_episode IS NOT NULL AS want_explicit,
       want_version, want_asset, want_crc, regexp_replace(name, '[.](mkv|mp4)$', '') AS want_stem
FROM (SELECT k AS row_id, base_name AS name, k % 3 = 0 AS hot, j % 17 AS form,
       CASE WHEN k % 3 = 0 THEN 'Evening Sampler'
            WHEN j % 17 = 10 THEN concat('Episode ', et, ' ', title)
            WHEN j % 17 = 11 THEN concat(title, ' (Other Name)')
            WHEN j % 17 = 12 THEN replace(split_part('{_SLUG_WANTED}', '|', CAST(j % 9 + 1 AS INT)), '/', chr(92))
            WHEN j % 17 = 13 THEN concat(title, ' - 3-Ri no baka')
            WHEN j % 17 = 14 THEN concat(title, ' - 12-sai no haru')
            WHEN j % 17 = 15 THEN concat(title, ' - 9-nine-')
            WHEN j % 17 = 16 THEN 'Umi - Aki no Sora-sama to 6-gou'
            ELSE title END AS want_title,
       CASE WHEN k % 3 = 0 THEN NULL WHEN j % 17 IN (1, 2, 3, 8, 16) THEN s WHEN j % 17 = 6 THEN 2 WHEN j % 17 = 9 THEN 1 END AS want_season,
       CASE WHEN k % 3 = 0 THEN 1 WHEN j % 17 IN (4, 7) THEN NULL ELSE e END AS want_episode,
       k % 3 <> 0 AND j % 17 IN (1, 2, 3, 9, 10, 16) AS want_explicit,
       k % 3 <> 0 AND j % 17 IN (5, 9) AS want_version,
       k % 3 <> 0 AND j % 17 IN (4, 9) AS want_asset,
       CASE WHEN k % 3 <> 0 AND j % 17 IN (0, 1, 3, 5, 7, 14) THEN crc END AS want_crc
  FROM ({_NAMED}) n) m"""

# Bare filenames, as a model or the extraction rules get them.
FILENAMES = f"SELECT k AS row_id, base_name AS name FROM ({_NAMED}) n"


def _object(show="title", season="st", episode="et", crc="concat('\"', crc, '\"')", conf="'0.9'", reason="'\"seen\"'"):
    return (
        f"concat('{{\"show_name\":\"', replace({show}, '\"', ''''), '\",\"season\":', {season}, ',\"episode\":', {episode}, "
        f"',\"crc_hash\":', {crc}, ',\"confidence\":', {conf}, ',\"reasoning\":', {reason}, '}}')"
    )


# The backslash title would need escapes inside JSON texts; slashes stand for it.
_SAFE = f"SELECT k, j, et, st, crc, pri, replace(title, chr(92), '/') AS title FROM ({_TITLED}) t"

COMPLETIONS = f"""
SELECT k AS id,
       CASE k % 31
         WHEN 0 THEN {_object()}
         WHEN 1 THEN concat('Sure, here it is: ', {_object()}, ' Done {{now}}.')
         WHEN 2 THEN substr({_object()}, 1, length({_object()}) - 1)
         WHEN 3 THEN concat('{{not json}} ', {_object()})
         WHEN 4 THEN concat('<|system|> schema {{x}} <|assistant|>', {_object()}, '<|endoftext|>')
         WHEN 5 THEN concat({_object()}, '<|user|> again <|assistant|> ', {_object()})
         WHEN 6 THEN '{{}}'
         WHEN 7 THEN 'no object here'
         WHEN 8 THEN concat('{{"outer":', {_object()}, ',}} tail')
         WHEN 9 THEN concat('{{"outer":{{"deep":[1,2,{{"x":', et, '}}]}},"n":', st, '}}')
         WHEN 10 THEN concat('{{ {{"a":', et, '}}')
         WHEN 11 THEN concat('{{bad}} {{worse {{"a":', et, '}} ok}} rest')
         WHEN 12 THEN concat('}} }} {{"episode":', et, ',"season":', st, '}}')
         WHEN 13 THEN '{{"s":"}}"}}'
         WHEN 14 THEN {_object(season="'null'", episode="'null'", crc="'null'")}
         WHEN 15 THEN {_object(season="concat('\"', st, '\"')")}
         WHEN 16 THEN {_object(episode="concat(et, '.0')")}
         WHEN 17 THEN {_object(crc="'\"ZZZZZZZZ\"'")}
         WHEN 18 THEN {_object(crc="'12345678'")}
         WHEN 19 THEN {_object(conf="'1.2'")}
         WHEN 20 THEN {_object(conf="'\"high\"'")}
         WHEN 21 THEN {_object(reason="'12'")}
         WHEN 22 THEN {_object(show="''")}
         WHEN 23 THEN concat('{{"season":', st, ',"show_name":"', replace(title, '"', ''''), '","episode":', et,
                             ',"crc_hash":"', crc, '","confidence":0.9,"reasoning":"seen"}}')
         WHEN 24 THEN concat('{{"show_name":"', replace(title, '"', ''''), '","episode":', et, '}}')
         WHEN 25 THEN {_object(conf="'true'", season="'true'")}
         WHEN 26 THEN {_object(conf="'0.90'")}
         WHEN 27 THEN concat(repeat('{{', 3), repeat('}}', 2), ' ', {_object()})
         WHEN 28 THEN concat(pri, ' <|user|> ', {_object()})
         WHEN 29 THEN NULL
         ELSE {_object()}
       END AS pred,
       CASE WHEN k % 37 = 0 THEN NULL WHEN k % 37 = 1 THEN 'unlabelled' ELSE {_object()} END AS label
FROM ({_SAFE}) s""".replace("{{", "{").replace("}}", "}")

# Whole documents around one object, for long texts.
LONG_COMPLETIONS = """
SELECT doc_id AS id,
       CASE doc_id % 4
         WHEN 0 THEN concat(text, ' {"doc":', CAST(doc_id AS VARCHAR(20)), ',"source":"', source, '"} ', text)
         WHEN 1 THEN concat(text, ' {"doc":{"id":', CAST(doc_id AS VARCHAR(20)), '},"lang":"', lang, '"}', text)
         WHEN 2 THEN concat(text, ' {"doc":{"id":', CAST(doc_id AS VARCHAR(20)), '} ', text)
         ELSE text
       END AS pred
FROM documents"""

# An object with a member per word of a document; what may not stand in a JSON text is a space.
_PLAIN = "translate(text, concat(chr(34), chr(92), chr(10), chr(9), chr(13)), '     ')"
DEEP_OBJECT = f"concat('{{\"w\":[{{\"x\":{{\"y\":\"', replace({_PLAIN}, ' ', '\"}}}},{{\"x\":{{\"y\":\"'), '\"}}}}]}}')"
DEEP_COMPLETIONS = f"SELECT doc_id AS id, concat('Here: ', {DEEP_OBJECT}, ' and }} {{ more') AS pred FROM documents"

# Lines of a labelled CSV with any number of fields, and what is to be read from them.
RAGGED_HEADER = "name,show_name,season,episode,reasoning,confidence,crc_hash"
_RAGGED_LINE = """CASE k % 8
         WHEN 0 THEN concat('n', k, ',show,1,2,why,0.5,', crc)
         WHEN 1 THEN concat('n', k, ',show,1,2,why,0.5,', crc, ',,lost')
         WHEN 2 THEN concat('n', k, ',show,1,2,why,0.5,', crc, ',extra,')
         WHEN 3 THEN concat('n', k, ',show,1,2,why,0.5,', crc, ',')
         WHEN 4 THEN concat('n', k, ',show,1')
         WHEN 5 THEN concat('"n', k, ', with ""comma"", and more",show,1,2,"why, then",0.5,', crc)
         WHEN 6 THEN concat('"n', k, ', x",show,,,,,')
         ELSE concat('"n', k, ',",show,1,2,"a,b",0.5,', crc, ',"x,y"') END"""
RAGGED_LINES = f"SELECT k, {_RAGGED_LINE} AS line FROM ({_BASE}) b"
RAGGED = """SELECT k,
       CASE k % 8 WHEN 5 THEN concat('n', k, ', with "comma", and more') WHEN 6 THEN concat('n', k, ', x') WHEN 7 THEN concat('n', k, ',') ELSE concat('n', k) END AS name,
       'show' AS show_name, CASE WHEN k % 8 <> 6 THEN '1' END AS season, CASE WHEN k % 8 NOT IN (4, 6) THEN '2' END AS episode,
       CASE k % 8 WHEN 4 THEN NULL WHEN 6 THEN NULL WHEN 5 THEN 'why, then' WHEN 7 THEN 'a,b' ELSE 'why' END AS reasoning,
       CASE WHEN k % 8 NOT IN (4, 6) THEN '0.5' END AS confidence, CASE WHEN k % 8 NOT IN (4, 6) THEN crc END AS crc_hash,
       k % 8 IN (1, 2, 3, 7) AS overflow
FROM (""" + _BASE + ") b"


def attempts(engine: str = "spark") -> str:
    """Attempts 1..4 per id; valid at attempt k % 6, and for every fifth id also later on."""
    rows = {"spark": "explode(array(1, 2, 3, 4))", "duckdb": "unnest([1, 2, 3, 4])"}[engine]
    sql = f"""
SELECT k AS id, attempt,
       CASE WHEN attempt = k % 6 OR (k % 5 = 0 AND attempt > k % 6 AND k % 6 > 0) THEN {_object()}
            WHEN attempt = 1 THEN concat('thinking about ', pri)
            WHEN attempt = 2 THEN {_object(episode="'null'")}
            WHEN attempt = 3 THEN '{{}}'
            ELSE concat('{{"show_name":"', pri) END AS decoded,
       CAST(k % 50 + attempt AS INT) AS gen_tokens
FROM (SELECT x.*, {rows} AS attempt FROM ({_SAFE}) x) s"""
    return sql.replace("{{", "{").replace("}}", "}")


_IDS = """{array}(event_id, CASE WHEN event_id % 3 = 0 THEN -100 ELSE user_id END, CAST(0 AS BIGINT), user_id % 90 + 33,
    CASE WHEN event_id % 5 = 0 THEN -100 ELSE event_id % 64 + 48 END, CASE WHEN user_id % 2 = 0 THEN 0 ELSE 65 END)"""


def token_ids(engine: str = "spark") -> str:
    """Six ids per event, with ignore markers and pads; one spelling of arrays per engine."""
    array = {"spark": "array", "duckdb": "list_value"}[engine]
    return f"SELECT event_id AS id, {_IDS.format(array=array)} AS ids, CAST(event_id % 7 AS INT) AS prompt_len FROM events"


SOURCES = {
    "raw_metadata": "orders",
    "filenames": "orders",
    "completions": "orders",
    "long_completions": "documents",
    "deep_completions": "documents",
    "ragged_lines": "orders",
    "attempts": "orders",
    "token_ids": "events",
}


KEYS = {"orders": "o_orderkey", "documents": "doc_id", "events": "event_id"}


def sql_of(name: str, engine: str = "spark") -> str:
    """The text of a derived input for one engine."""
    if name == "attempts":
        return attempts(engine)
    if name == "token_ids":
        return token_ids(engine)
    return {
        "raw_metadata": RAW_METADATA,
        "filenames": FILENAMES,
        "completions": COMPLETIONS,
        "long_completions": LONG_COMPLETIONS,
        "deep_completions": DEEP_COMPLETIONS,
        "ragged_lines": RAGGED_LINES,
    }[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *key: str) -> DataFrame:
    """The frame, dealt out by key, at every size: a small file of one row group would be one task."""
    return df.repartition(*key)


#: Paths of the inputs written by this process, by Spark application, tables and name.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input, written to the shared folder by its first user and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        source = SOURCES[name]
        view = f"mediameta_{source}"
        spread(table(spark, sf_dir, source), KEYS[source]).createOrReplaceTempView(view)
        path = scratch_path(spark, f"input-{name}")
        spark.sql(sql_of(name).replace(f"FROM {source}", f"FROM {view}")).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
