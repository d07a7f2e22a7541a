"""The registered queries again, as SQL for an independent engine.

Written from the rules, in another way than the Spark expressions where the
engines differ: quotes by position instead of by pattern, braces by lists of
positions, ranks by plain window functions.
"""

from __future__ import annotations

import json

from mediameta.functions.render import ASSISTANT_TAG, END_OF_TEXT, SYSTEM_TAG, USER_TAG, USER_TEMPLATE
from mediameta.functions.text import WHITESPACE
from mediameta.plans import catalog
from mediameta.plans.catalog import MANIFEST_TIME, SEED, SYSTEM_TEXT
from mediameta.plans.derive import DEEP_OBJECT, EXPECTED, RAGGED, sql_of
from mediameta.schema import ISSUES, METRICS, RAW_COLUMNS, TARGET_KEYS, Params


def _q(s: str) -> str:
    """A text as an SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def _input(name: str) -> str:
    return f"({sql_of(name, 'duckdb')})"


# --- cleaning ---

_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
_RAW = _input("raw_metadata")
_NUM = r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"


def _strip(x: str) -> str:
    return (
        f"CASE WHEN length({x}) >= 2 AND left({x}, 1) = right({x}, 1) AND left({x}, 1) IN ('\"', '''') "
        f"THEN trim(substr({x}, 2, length({x}) - 2), {_WS}) ELSE {x} END"
    )


_TRIMMED = f"(SELECT row_id, {', '.join(f'trim({c}, {_WS}) AS {c}' for c in RAW_COLUMNS)} FROM {_RAW} r)"
_STRIPPED = f"(SELECT row_id, {', '.join(f'{_strip(c)} AS {c}' for c in RAW_COLUMNS)} FROM {_TRIMMED} r)"
_TEXTS = (
    "(SELECT row_id, "
    + ", ".join(f"CASE WHEN {c} IN ('', 'nan', 'NaN', 'None', 'NULL') THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS)
    + f" FROM {_STRIPPED} r)"
)


def _double(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '{_NUM}') THEN TRY_CAST({x} AS DOUBLE) "
        f"WHEN lower({x}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('infinity' AS DOUBLE) "
        f"WHEN lower({x}) IN ('-inf', '-infinity') THEN CAST('-infinity' AS DOUBLE) END"
    )


def _int(x: str) -> str:
    return (
        f"coalesce(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST(ltrim({x}, '+') AS BIGINT) END, "
        f"CASE WHEN abs({x}_d) < 9223372036854775808.0::DOUBLE AND "
        f"abs({x}_d - round_even({x}_d, 0)) <= 1e-9::DOUBLE + 1e-5::DOUBLE * abs(round_even({x}_d, 0)) "
        f"THEN CAST(round_even({x}_d, 0) AS BIGINT) END)"
    )


_NUMBERS = f"(SELECT *, {_double('season')} AS season_d, {_double('episode')} AS episode_d, {_double('confidence')} AS confidence_d FROM {_TEXTS} r)"
_CLEAN = f"""(SELECT row_id, name, show_name, {_int('season')} AS season, {_int('episode')} AS episode, reasoning,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(confidence_d, 0.0::DOUBLE))) AS confidence,
  upper(CASE WHEN regexp_full_match(crc_hash, '\\[[0-9A-Fa-f]{{8}}\\]') THEN substr(crc_hash, 2, 8) ELSE crc_hash END) AS crc_hash
  FROM {_NUMBERS} r)"""


# --- rendering ---


def _target(prefix: str = "") -> str:
    p = prefix
    return (
        f"concat('{{\"show_name\":', CAST(to_json(coalesce({p}show_name, '')) AS VARCHAR), ',\"season\":', "
        f"coalesce(CAST({p}season AS VARCHAR), 'null'), ',\"episode\":', coalesce(CAST({p}episode AS VARCHAR), 'null'), "
        f"',\"crc_hash\":', coalesce(CAST(to_json({p}crc_hash) AS VARCHAR), 'null'), ',\"confidence\":', "
        f"CAST({p}confidence AS VARCHAR), ',\"reasoning\":', CAST(to_json(coalesce({p}reasoning, '')) AS VARCHAR), '}}')"
    )


def _prompt(name: str) -> str:
    return f"replace({_q(USER_TEMPLATE)}, '{{filename}}', coalesce({name}, ''))"


_NL = "chr(10)"
_SYS = _q(SYSTEM_TEXT)


def _chat(user: str, gap: str = "chr(10)") -> str:
    return f"concat('{SYSTEM_TAG}', {_NL}, {_SYS}, {gap}, '{USER_TAG}', {_NL}, {user}, {gap}, '{ASSISTANT_TAG}', {_NL})"


_BLANK = "chr(10) || chr(10)"


# --- profile ---


def _describe(column: str, source: str) -> str:
    def quantile(p):
        return f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), 6)"

    return f"""SELECT count({column}) AS count, format('{{:.6e}}', avg({column})) AS mean, format('{{:.6e}}', stddev_samp({column})) AS std,
      round(CAST(min({column}) AS DOUBLE), 6) AS min, {quantile(0.25)} AS q25, {quantile(0.5)} AS q50,
      {quantile(0.75)} AS q75, round(CAST(max({column}) AS DOUBLE), 6) AS max FROM {source} c"""


_BAD_CRC = "crc_hash IS NOT NULL AND NOT regexp_full_match(crc_hash, '[A-F0-9]{8}')"
_NAME_COUNTS = f"(SELECT c.*, count(*) OVER (PARTITION BY name) AS name_count FROM {_CLEAN} c)"
_ISSUE_ROWS = " UNION ALL ".join(
    f"SELECT '{issue}' AS issue, row_id FROM counted WHERE {condition}"
    for issue, condition in zip(
        ISSUES, ["length(name) > 200", "name_count > 1", _BAD_CRC, "episode IS NULL"], strict=True
    )
)


# --- JSON text ---

_VALID = r"(json_valid(c) AND NOT regexp_matches(c, ',\s*[}\]]'))"


def _extracted(source: str, column: str, key: str = "id", retry: bool = True) -> str:
    """(key, u, obj, code): positions of braces, then depths, then candidates."""
    u = (
        f"CASE WHEN contains({column}, '{ASSISTANT_TAG}') THEN substr({column}, strpos({column}, '{ASSISTANT_TAG}') + "
        f"{len(ASSISTANT_TAG)}) ELSE {column} END"
        if retry
        else column
    )
    picked = (
        "list_filter(cands, lambda x: x.c IS NULL OR x.ok)[1]" if retry else "cands[1]"
    )
    return f"""(SELECT {key}, u,
      CASE WHEN hit.c IS NOT NULL AND hit.ok THEN hit.c END AS obj,
      CASE WHEN u IS NULL OR len(cands) = 0 THEN 'none' WHEN hit.ok THEN 'found'
           WHEN hit IS NOT NULL AND hit.c IS NULL THEN 'open' ELSE 'parse' END AS code
    FROM (SELECT {key}, u, cands, {picked} AS hit
    FROM (SELECT {key}, u, list_transform(texts, lambda c: {{'c': c, 'ok': {_VALID}}}) AS cands
    FROM (SELECT {key}, u, list_transform(starts, lambda i: substr(u, bp[i], bp[list_filter(range(i + 1, len(bp) + 1),
                lambda j: depth[j] = depth[i] - 1)[1]] - bp[i] + 1)) AS texts
    FROM (SELECT *, list_filter(range(1, len(bp) + 1), lambda i: delta[i] = 1) AS starts,
                 list_transform(range(1, len(bp) + 1), lambda i: list_sum(delta[1:i])) AS depth
    FROM (SELECT *, list_transform(bp, lambda p: CASE WHEN ch[p] = '{{' THEN 1 ELSE -1 END) AS delta
    FROM (SELECT *, list_filter(range(1, len(ch) + 1), lambda p: ch[p] IN ('{{', '}}')) AS bp
    FROM (SELECT {key}, {u} AS u, string_split({u}, '') AS ch FROM {source} s0) s1) s2) s3) s4) s5) s6) s7)"""


_RETRY_ERROR = "CASE code WHEN 'found' THEN '' WHEN 'open' THEN 'unbalanced braces' WHEN 'parse' THEN 'json parse' ELSE 'no ''{''' END"
_ONCE_ERROR = (
    "CASE code WHEN 'found' THEN '' WHEN 'open' THEN 'No matching ''}'' found (unbalanced braces).' "
    "WHEN 'parse' THEN 'JSON parse failed' ELSE 'No ''{'' found.' END"
)
_COMPLETIONS = _input("completions")
_NUMBER_TYPES = "('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN', 'HUGEINT', 'UHUGEINT')"
_INT_TYPES = "('UBIGINT', 'BIGINT', 'BOOLEAN', 'NULL')"


def _type(o: str, m: str) -> str:
    return f"coalesce(json_type({o}, '$.{m}'), 'NULL')"


def _str(o: str, m: str) -> str:
    return f"json_extract_string({o}, '$.{m}')"


def _conf_in_range(o: str) -> str:
    return (
        f"(CASE WHEN {_type(o, 'confidence')} = 'BOOLEAN' THEN TRUE "
        f"ELSE TRY_CAST({_str(o, 'confidence')} AS DOUBLE) BETWEEN 0 AND 1 END)"
    )


def _errors(o: str) -> str:
    expected = "['" + "', '".join(TARGET_KEYS) + "']"
    keys = "[" + ", ".join(_q(k) for k in TARGET_KEYS) + "]"
    return f"""concat_ws(' | ',
      CASE WHEN json_keys({o}) <> {keys} THEN concat({_q('Keys/order mismatch. Expected ' + expected + ', got ')},
        '[''', array_to_string(json_keys({o}), ''', '''), ''']') END,
      CASE WHEN {_type(o, 'show_name')} <> 'VARCHAR' OR {_str(o, 'show_name')} = '' THEN 'show_name must be a non-empty string.' END,
      CASE WHEN {_type(o, 'season')} NOT IN {_INT_TYPES} THEN 'season must be int or null.' END,
      CASE WHEN {_type(o, 'episode')} NOT IN {_INT_TYPES} THEN 'episode must be int or null.' END,
      CASE WHEN {_type(o, 'episode')} = 'NULL' THEN 'episode is required but was null.' END,
      CASE WHEN {_type(o, 'crc_hash')} NOT IN ('VARCHAR', 'NULL') THEN 'crc_hash must be string or null.'
           WHEN {_type(o, 'crc_hash')} = 'VARCHAR' AND NOT regexp_full_match({_str(o, 'crc_hash')}, '[A-F0-9]{{8}}')
           THEN 'crc_hash must match ^[A-F0-9]{{8}}$ when present.' END,
      CASE WHEN {_type(o, 'confidence')} NOT IN {_NUMBER_TYPES} THEN 'confidence must be a number.'
           WHEN NOT {_conf_in_range(o)} THEN 'confidence must be in [0, 1].' END,
      CASE WHEN {_type(o, 'reasoning')} <> 'VARCHAR' THEN 'reasoning must be a string.' END)"""


def _checked(source: str, column: str, key: str) -> str:
    """(key, obj, errors) by the single-try rule."""
    return f"""(SELECT {key}, obj, CASE WHEN obj IS NULL THEN {_ONCE_ERROR} WHEN len(json_keys(obj)) = 0 THEN 'empty object'
       ELSE {_errors('obj')} END AS errors FROM {_extracted(source, column, key, retry=False)} e)"""


def _same(a: str, b: str) -> str:
    members = " AND ".join(
        f"(CASE WHEN {_type(a, m)} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND {_type(b, m)} IN ('UBIGINT', 'BIGINT', 'DOUBLE') "
        f"THEN CAST({_str(a, m)} AS DOUBLE) = CAST({_str(b, m)} AS DOUBLE) "
        f"ELSE {_type(a, m)} = {_type(b, m)} AND {_str(a, m)} IS NOT DISTINCT FROM {_str(b, m)} END)"
        for m in TARGET_KEYS
    )
    return f"(list_sort(json_keys({a})) = list_sort(json_keys({b})) AND {members})"


_KEYS = "[" + ", ".join(_q(k) for k in TARGET_KEYS) + "]"
_CRC_OK = f"({_type('p', 'crc_hash')} = 'NULL' OR ({_type('p', 'crc_hash')} = 'VARCHAR' AND regexp_full_match({_str('p', 'crc_hash')}, '[A-F0-9]{{8}}')))"
_TYPED = (
    f"({_type('p', 'show_name')} = 'VARCHAR' AND {_str('p', 'show_name')} <> '' AND {_type('p', 'season')} IN {_INT_TYPES} "
    f"AND {_type('p', 'episode')} IN {_INT_TYPES} AND {_CRC_OK} AND {_type('p', 'confidence')} IN {_NUMBER_TYPES} "
    f"AND {_conf_in_range('p')} AND {_type('p', 'reasoning')} = 'VARCHAR')"
)
_SCORED = f"""(SELECT id, v AS json_validity, coalesce(v AND json_keys(p) = {_KEYS}, FALSE) AS key_order_match,
    coalesce(v AND {_TYPED}, FALSE) AS field_type_valid, coalesce(v AND {_type('p', 'episode')} <> 'NULL', FALSE) AS episode_present,
    coalesce(v AND {_CRC_OK}, FALSE) AS crc_format,
    coalesce(v AND len(json_keys(l)) > 0 AND {_same('p', 'l')}, FALSE) AS exact_json_match
  FROM (SELECT a.id, a.obj AS p, b.obj AS l, coalesce(len(json_keys(a.obj)) > 0, FALSE) AS v
        FROM {_extracted(_COMPLETIONS, 'pred')} a JOIN {_extracted(_COMPLETIONS, 'label')} b ON a.id = b.id) x)"""


def _first_close(source: str) -> str:
    """(id, pred, close): where the first opened brace closes."""
    return f"""(SELECT id, u AS pred, bp[list_filter(range(f + 1, len(bp) + 1), lambda j: depth[j] = depth[f] - 1)[1]] AS close
    FROM (SELECT *, list_position(delta, 1) AS f,
                 list_transform(range(1, len(bp) + 1), lambda i: list_sum(delta[1:i])) AS depth
    FROM (SELECT *, list_transform(bp, lambda p: CASE WHEN ch[p] = '{{' THEN 1 ELSE -1 END) AS delta
    FROM (SELECT *, list_filter(range(1, len(ch) + 1), lambda p: ch[p] IN ('{{', '}}')) AS bp
    FROM (SELECT id, pred AS u, string_split(pred, '') AS ch FROM {source} s0) s1) s2) s3) s4)"""


def _tag_end(tag: str) -> str:
    return f"CASE WHEN contains(pred, '{tag}') THEN strpos(pred, '{tag}') + {len(tag) - 1} END"


def _before(stop: str) -> str:
    return f"CASE WHEN contains(pred, '{stop}') THEN strpos(pred, '{stop}') - 1 END"


# --- attempts and generation ---

_ATTEMPTS = _input("attempts")


def _chosen(max_retries: int) -> str:
    tried = f"(SELECT * FROM {_ATTEMPTS} t WHERE attempt <= {max_retries})"
    keyed = f"(SELECT id * 10 + attempt AS ka, decoded FROM {tried} t)"
    return f"""(SELECT id, CASE WHEN ok THEN 'ok' ELSE 'fail' END AS status, attempt, [0.0::DOUBLE, 0.1, 0.2, 0.3][attempt] AS temperature,
      [1.0::DOUBLE, 0.95, 0.9, 0.85][attempt] AS top_p, gen_tokens, decoded, obj, errors
    FROM (SELECT t.*, c.obj, c.errors, c.errors = '' AS ok,
             row_number() OVER (PARTITION BY t.id ORDER BY CASE WHEN c.errors = '' THEN 0 ELSE 1 END,
                                CASE WHEN c.errors = '' THEN attempt ELSE -attempt END) AS r
          FROM {tried} t JOIN {_checked(keyed, 'decoded', 'ka')} c ON c.ka = t.id * 10 + t.attempt) x WHERE r = 1)"""


# --- filename extraction ---


# Expected values come from how each name was made; no pattern of the extraction is used.
_FN = f"""(SELECT row_id, name, want_stem AS fn_stem, want_crc AS fn_crc, want_season AS fn_season, want_asset AS fn_asset,
    CASE WHEN want_explicit THEN 'marked' END AS explicit, want_episode AS fn_episode, want_version AS fn_version, want_title AS fn_title,
    round(greatest(0, least(1.0 - (CASE WHEN want_version AND want_episode IS NOT NULL THEN 0.1 ELSE 0 END)
      - (CASE WHEN want_season IS NULL THEN 0.1 ELSE 0 END)
      - (CASE WHEN want_episode IS NOT NULL AND NOT want_explicit THEN 0.15 ELSE 0 END)
      - (CASE WHEN want_episode IS NULL THEN 0.8 ELSE 0 END), CASE WHEN want_episode IS NULL THEN 0.2 ELSE 1.0 END)), 2)::DOUBLE AS fn_confidence
  FROM ({EXPECTED}) w)"""

_REASON = """concat(CASE WHEN fn_season IS NULL THEN 'No season marker is present. '
      ELSE concat('Season ', fn_season, ' has an explicit marker. ') END,
    CASE WHEN fn_episode IS NULL AND fn_asset THEN 'The name marks a non-episode asset, so no episode is set.'
         WHEN fn_episode IS NULL THEN 'No episode marker or separated number was found.'
         ELSE concat('Episode ', fn_episode, CASE WHEN explicit IS NULL THEN ' is inferred from a number after a separator'
                     ELSE ' has an explicit marker' END, CASE WHEN fn_version THEN ' with a version suffix.' ELSE '.' END) END)"""
_EXTRACTED = f"""(SELECT row_id, name, fn_title AS show_name, fn_season AS season, fn_episode AS episode, fn_crc AS crc_hash,
    fn_confidence AS confidence, {_REASON} AS reasoning FROM {_FN} x)"""


def _ids(expression: str) -> str:
    return f"array_to_string({expression}, ',')"


def _fill(value: int) -> str:
    return f"list_transform(ids, lambda x: CASE WHEN x = -100 THEN {value} ELSE x END)"


_TOKENS = _input("token_ids")
_KEPT = f"(SELECT * FROM {_CLEAN} c WHERE episode IS NOT NULL)"
_RANKED = (
    f"(SELECT c.*, row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(row_id AS VARCHAR))), row_id) AS r, "
    f"count(*) OVER () AS total FROM {_CLEAN} c)"
)
_EVAL = f"ceil(CAST(total AS DOUBLE) * {catalog.SPLIT_FRACTION}::DOUBLE)"
_STUB = "concat('{\"show_name\":\"Length ', n, '\",\"season\":null,\"episode\":', n, ',\"crc_hash\":null,\"confidence\":0.9,\"reasoning\":\"stub\"}')"
_NO_OBJECT = "'no object here'"



def _packed(source: str, key: str, size: str) -> str:
    """Examples end to end in ranges of ids; a range of over 4,096 rows is divided, three times at most here."""
    ranged = f"SELECT {key} AS k, {size} AS n_tokens, 0 AS bucket FROM {source} s"
    for level in range(3):
        ranged = f"""SELECT k, n_tokens, CASE WHEN n > 4096 THEN lo + (k - lo) - (k - lo) % least(((hi - lo + 1) * 4096 + n - 1) // n, (hi - lo + 2) // 2) ELSE {'bucket' if level else 'lo'} END AS bucket
          FROM (SELECT *, min(k) OVER w AS lo, max(k) OVER w AS hi, count(*) OVER w AS n FROM ({ranged}) r WINDOW w AS (PARTITION BY bucket)) q"""
    # A range keeps its start; only one that was never divided is named by its least id.
    return f"""SELECT k AS {key}, n_tokens, bucket, CAST(floor(pos / {catalog.PACK_LIMIT}) AS BIGINT) AS sequence, pos % {catalog.PACK_LIMIT} AS start
      FROM (SELECT *, CAST(sum(n_tokens) OVER (PARTITION BY bucket ORDER BY k) - n_tokens AS BIGINT) AS pos FROM ({ranged}) d) e"""


def _moments(column: str, kind: str) -> str:
    shown = [f"format('{{:.6e}}', {f}({column})) AS {column}_{name}" for name, f in (("mean", "avg"), ("std", "stddev_samp"))]
    ends = [f"CAST({f}({column}) AS {kind}) AS {column}_{f}" for f in ("min", "max")]
    return ", ".join([f"count({column}) AS {column}_count", *shown, *ends])


ORACLE: dict[str, str] = {
    "schema_canonical": f"SELECT row_id, {', '.join(RAW_COLUMNS)} FROM {_RAW} r",
    "csv_roundtrip": f"SELECT * FROM {_CLEAN} c",
    "row_ids": "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey FROM orders",
    "run_manifest": f"SELECT 'test' AS code_version, '{MANIFEST_TIME}' AS timestamp, "
    f"{_q(json.dumps(Params().as_dict(), sort_keys=True))} AS config, count(*) AS row_count FROM {_KEPT} k",
    "manifest_clock": f"""SELECT 'v2' AS code_version, '{{"a": "x", "b": 1}}' AS config, count(*) AS row_count, true AS recent,
      CAST(20 AS INTEGER) AS width FROM {_KEPT} k""",
    "template_prompts": f"SELECT row_id, {_chat(_prompt('name'))} AS prompt FROM {_input('filenames')} f",
    "strip_quotes": f"SELECT row_id, name, reasoning FROM {_STRIPPED} s",
    "clean_text": f"SELECT row_id, name, show_name, reasoning FROM {_TEXTS} s",
    "to_nullable_int": f"SELECT row_id, season, episode FROM {_CLEAN} c",
    "to_confidence": f"SELECT row_id, confidence FROM {_CLEAN} c",
    "normalize_crc": f"SELECT row_id, crc_hash FROM {_CLEAN} c",
    "clean_metadata": f"SELECT * FROM {_CLEAN} c",
    "require_episode": f"SELECT row_id, name, episode FROM {_KEPT} c",
    "target_json": f"SELECT row_id, {_target()} AS target FROM {_CLEAN} c",
    "render_prompt": f"SELECT row_id, {_prompt('name')} AS prompt FROM {_CLEAN} c",
    "sft_examples": f"SELECT row_id, concat({_chat(_prompt('name'))}, {_target()}, '{END_OF_TEXT}') AS text FROM {_KEPT} c",
    "render_inference_prompt": f"SELECT conv_id, turn, {_chat('text')} AS prompt FROM conversations",
    "render_serving_prompt": f"SELECT conv_id, turn, {_chat('text', _BLANK)} AS prompt FROM conversations",
    "chat_messages": f"SELECT conv_id, turn, concat('[{{\"role\":\"system\",\"content\":', CAST(to_json({_SYS}) AS VARCHAR), "
    "'},{\"role\":\"user\",\"content\":', CAST(to_json(text) AS VARCHAR), '}]') AS messages FROM conversations",
    "attention_mask": f"SELECT id, {_ids('list_transform(ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)')} AS mask, "
    f"{_ids('list_transform(ids, lambda x: 1)')} AS mask_without_pad FROM {_TOKENS} t",
    "mask_labels": f"SELECT id, {_ids(_fill(0))} AS by_pad, {_ids(_fill(1))} AS by_end FROM {_TOKENS} t",
    "truncate_tokens": f"SELECT id, {_ids('ids[1:4]')} AS ids FROM {_TOKENS} t",
    "generated_suffix": f"SELECT id, coalesce({_ids('ids[prompt_len + 1:]')}, '') AS suffix, "
    f"CAST(greatest(len(ids) - prompt_len, 0) AS INTEGER) AS n FROM {_TOKENS} t",
    "decode_tokens": "SELECT id, array_to_string(list_transform(list_filter("
    f"{_fill(0)}, lambda x: x <> 0), lambda x: chr(CAST(33 + x % 90 AS INTEGER))), '') AS text FROM {_TOKENS} t",
    "profile_nulls": "SELECT count(*) AS row_count, "
    + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in RAW_COLUMNS)
    + f" FROM {_CLEAN} c",
    "profile_episode": _describe("episode", _CLEAN),
    "profile_confidence": _describe("confidence", _CLEAN),
    "episode_top20": f"SELECT episode AS value, count(*) AS n FROM {_KEPT} c GROUP BY episode ORDER BY n DESC, value LIMIT 20",
    "season_coverage": f"SELECT round(100.0::DOUBLE * count(season) / count(*), 6) AS percent FROM {_CLEAN} c",
    "sample_rows": f"SELECT * EXCLUDE (r, total) FROM {_RANKED} x WHERE r <= 5",
    "duplicate_names": f"SELECT row_id, name, name_count FROM {_NAME_COUNTS} c WHERE name_count > 1",
    "issue_rows": f"WITH counted AS {_NAME_COUNTS} {_ISSUE_ROWS}",
    "issue_counts": f"WITH counted AS {_NAME_COUNTS}, found AS ({_ISSUE_ROWS}) "
    f"SELECT i.issue, count(f.row_id) AS n FROM (SELECT unnest([{', '.join(_q(i) for i in ISSUES)}]) AS issue) i "
    "LEFT JOIN found f ON f.issue = i.issue GROUP BY i.issue",
    "split_assignment": f"SELECT row_id, CASE WHEN r <= {_EVAL} THEN 'eval' ELSE 'train' END AS split FROM {_RANKED} x",
    "eval_cap": f"SELECT row_id, name FROM {_RANKED} x WHERE r <= least({_EVAL}, {catalog.EVAL_CAP})",
    "pack_sequences": _packed("documents", "doc_id", "n_chars"),
    "pack_sparse": _packed("orders", "o_orderkey", "o_orderkey % 700"),
    "pack_clustered": _packed(
        "(SELECT o_orderkey, CASE WHEN o_orderkey = 1 THEN 1000000000000000 WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS row_id FROM orders)",
        "row_id", "o_orderkey % 700",
    ),
    "split_and_cap": f"""SELECT row_id, CASE WHEN r <= least({_EVAL}, {catalog.EVAL_CAP}) THEN 'eval' WHEN r <= {_EVAL} THEN 'unused' ELSE 'train' END AS split
      FROM {_RANKED} x""",
    "short_run": f"SELECT row_id, name FROM {_CLEAN} c ORDER BY row_id LIMIT 25",
    "profile_report": "SELECT count(*) AS row_count, "
    + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in RAW_COLUMNS)
    + f", round(100.0::DOUBLE * count(season) / count(*), 6) AS season_coverage, {_moments('episode', 'BIGINT')}, {_moments('confidence', 'DOUBLE')}, "
    + ", ".join(
        f"count(*) FILTER ({condition}) AS {issue}"
        for issue, condition in zip(ISSUES, ["length(name) > 200", "name_count > 1", _BAD_CRC, "episode IS NULL"], strict=True)
    )
    + f" FROM {_NAME_COUNTS} c",
    "csv_multiline_split": "SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, "
    + ", ".join(
        "concat_ws(chr(10), reasoning, concat('a \"quoted, line\"', chr(10), chr(10), CAST(row_id AS VARCHAR))) AS reasoning" if c == "reasoning" else f"nullif({c}, '') AS {c}"
        for c in RAW_COLUMNS
    )
    + f" FROM {_RAW} r",
    "truncate_token_stop": f"""SELECT id, CASE WHEN stopped THEN left(pred, greatest(cut, 2)) ELSE pred END AS cut_text,
        CAST(CASE WHEN stopped THEN greatest(cut, 2) ELSE length(pred) END AS INTEGER) AS n_ids, stopped
      FROM (SELECT id, pred, cut, cut IS NOT NULL AND length(pred) > 1 AS stopped
            FROM (SELECT *, least(close, {_tag_end(SYSTEM_TAG)}, {_tag_end(USER_TAG)}, {_tag_end(ASSISTANT_TAG)}) AS cut
                  FROM {_first_close(_COMPLETIONS)} c) x) y""",
    "pair_positions": f"""SELECT p.n AS position, pred_id, pred, label_id, label
      FROM (SELECT row_number() OVER (ORDER BY id) - 1 AS n, id AS pred_id, pred FROM {_COMPLETIONS} c) p
      JOIN (SELECT row_number() OVER (ORDER BY id) - 1 AS n, id AS label_id, label FROM {_COMPLETIONS} c WHERE id % 11 <> 0) l ON l.n = p.n""",
    "csv_ragged": f"SELECT row_number() OVER (ORDER BY k) - 1 AS row_id, name, show_name, season, episode, reasoning, confidence, crc_hash, overflow FROM ({RAGGED}) r",
    "extract_json_deep": f"SELECT doc_id AS id, {DEEP_OBJECT} AS obj, '' AS obj_error FROM documents",
    "extract_json": f"SELECT id, obj, {_RETRY_ERROR} AS obj_error FROM {_extracted(_COMPLETIONS, 'pred')} e",
    "extract_json_once": f"SELECT id, obj, {_ONCE_ERROR} AS obj_error FROM {_extracted(_COMPLETIONS, 'pred', retry=False)} e",
    "extract_json_long": f"SELECT id, obj, {_RETRY_ERROR} AS obj_error FROM {_extracted(_input('long_completions'), 'pred')} e",
    "extract_json_python": f"SELECT id, obj IS NOT NULL AS found FROM {_extracted(_COMPLETIONS, 'pred')} e",
    "event_properties": "SELECT event_id, props AS obj, array_to_string(json_keys(props), ',') AS keys FROM events",
    "truncate_completion": f"""SELECT id, CASE WHEN cut IS NULL THEN pred ELSE left(pred, cut) END AS truncated, cut IS NOT NULL AS stopped
      FROM (SELECT *, least(close, {_tag_end(SYSTEM_TAG)}, {_tag_end(USER_TAG)}, {_tag_end(ASSISTANT_TAG)}) AS cut
            FROM {_first_close(_COMPLETIONS)} c) x""",
    "truncate_stop_strings": f"""SELECT id, CASE WHEN cut IS NULL THEN pred ELSE left(pred, cut) END AS cut
      FROM (SELECT id, pred, least({_before(END_OF_TEXT)}, {_before(USER_TAG)}, {_before(ASSISTANT_TAG)}) AS cut FROM {_COMPLETIONS} c) x""",
    "validate_objects": f"SELECT id, errors FROM {_checked(_COMPLETIONS, 'pred', 'id')} c",
    "score_completions": "SELECT "
    + ", ".join(f"round(avg(CASE WHEN {m} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS {m}" for m in METRICS)
    + f" FROM {_SCORED} s",
    "score_empty": "SELECT " + ", ".join(f"0.0::DOUBLE AS {m}" for m in METRICS),
    "score_rows": f"SELECT * FROM {_SCORED} s",
    "pair_labels": "SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    "first_valid_attempt": f"SELECT * FROM {_chosen(3)} c",
    "retry_summary": f"""SELECT status, count(*) AS n, CAST(sum(gen_tokens) AS BIGINT) AS gen_tokens, CAST(sum(attempt) AS BIGINT) AS attempts,
      max(attempt) AS max_attempt FROM {_chosen(4)} c GROUP BY status""",
    "batch_generate": f"""SELECT row_id, CASE WHEN n % 5 < 3 THEN 'ok' ELSE 'fail' END AS status, attempt,
        [0.0::DOUBLE, 0.1, 0.2][attempt] AS temperature, [1.0::DOUBLE, 0.95, 0.9][attempt] AS top_p,
        CAST(length(CASE WHEN n % 5 < 3 THEN {_STUB} ELSE {_NO_OBJECT} END) AS INTEGER) AS gen_tokens,
        CASE WHEN n % 5 < 3 THEN {_STUB} ELSE {_NO_OBJECT} END AS decoded, CASE WHEN n % 5 < 3 THEN {_STUB} END AS obj,
        CASE WHEN n % 5 < 3 THEN '' ELSE 'No ''{{'' found.' END AS errors
      FROM (SELECT row_id, n, CAST(least(n % 5 + 1, 3) AS INTEGER) AS attempt
            FROM (SELECT row_id, length({_chat(_prompt('name'))}) AS n FROM {_input('filenames')} f) a) b""",
    "infer_chain": f"""SELECT row_id, CASE WHEN n % 5 < 3 THEN 'ok' ELSE 'fail' END AS status, CAST(least(n % 5 + 1, 3) AS INTEGER) AS attempt,
        CASE WHEN n % 5 < 3 THEN {_STUB} END AS obj, CASE WHEN n % 5 < 3 THEN '' ELSE 'No ''{{'' found.' END AS errors
      FROM (SELECT row_id, length({_chat(_prompt('name'))}) AS n FROM {_input('filenames')} f) a""",
    "read_filenames": f"SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, name FROM {_input('filenames')} f",
    "prepare_examples": f"""SELECT concat({_chat(_prompt('name'))}, {_target()}, '{END_OF_TEXT}') AS text,
        CASE WHEN r <= {_EVAL} THEN 'evaluation' ELSE 'train' END AS side
      FROM (SELECT c.*, row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(row_id AS VARCHAR))), row_id) AS r, count(*) OVER () AS total
            FROM {_KEPT} c) x
      WHERE r > {_EVAL} OR r <= {catalog.EVAL_CAP}""",
    "fn_stem": f"SELECT row_id, fn_stem FROM {_FN} x",
    "fn_crc": f"SELECT row_id, fn_crc FROM {_FN} x",
    "fn_season": f"SELECT row_id, fn_season FROM {_FN} x",
    "fn_episode": f"SELECT row_id, fn_episode, fn_version FROM {_FN} x",
    "fn_asset": f"SELECT row_id, fn_asset FROM {_FN} x",
    "fn_title": f"SELECT row_id, fn_title FROM {_FN} x",
    "fn_confidence": f"SELECT row_id, fn_confidence FROM {_FN} x",
    "extract_metadata": f"SELECT *, {_target()} AS target FROM {_EXTRACTED} x",
}
ORACLE["score_token_ids"] = ORACLE["score_completions"]
ORACLE["generate_resumed"] = ORACLE["batch_generate"]
