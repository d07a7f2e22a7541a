"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediameta.functions import filename as fn
from mediameta.functions import jsontext, render, text, tokens
from mediameta.functions.checks import validate_objects
from mediameta.operators import attempts, clean, examples, generate, profile, quality, score, split
from mediameta.plans.derive import RAGGED_HEADER, derived, spread, table
from mediameta.schema import RAW_COLUMNS, Params, canonical
from mediameta.sources import tables
from mediameta.sources.rowid import with_row_id
from mediameta.sources.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SYSTEM_TEXT = "You read media filenames.\nAnswer with one JSON object {...} and nothing else."
SEED = Params.seed
PACK_LIMIT = 2048
SPLIT_FRACTION = 0.1
EVAL_CAP = 50
MANIFEST_TIME = "2024-01-01T00:00:00Z"
#: Rows in a CSV file with newlines in its values, some 500 MB: no task writes more, and readers take it in pieces.
FILE_ROWS = 4_000_000

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "raw_metadata")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_metadata(_raw(spark, sf_dir))


def _rounded(c: str, places: int = 6) -> Column:
    return F.round(c, places).alias(c)


# --- sources ---


@query
def schema_canonical(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    messy = raw.select("row_id", F.lit(1).alias("Extra"), *[F.col(c).alias(f" {c.title()} ") for c in RAW_COLUMNS[::-1]])
    return canonical(messy)


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_labelled_csv(_raw(spark, sf_dir), path)
    return clean.clean_metadata(tables.read_labelled_csv(spark, path, key="row_id"))


@query
def csv_multiline_split(spark, sf_dir):
    """Large files whose values hold newlines, commas and quotes, read in pieces without a key column."""
    path = scratch_path(spark, "multiline")
    parts = [F.col(c) for c in RAW_COLUMNS]
    parts[4] = F.concat_ws("\n", "reasoning", F.concat(F.lit('a "quoted, line"\n\n'), F.col("row_id").cast("string")))
    rows = _raw(spark, sf_dir).select("row_id", *[p.alias(c) for p, c in zip(parts, RAW_COLUMNS, strict=True)])
    # Files in order of the key, as another program might write them; one, if it has all rows.
    files = rows.count() // FILE_ROWS + 1
    tables.write_labelled_csv(rows.repartitionByRange(files, "row_id").sortWithinPartitions("row_id").select(*RAW_COLUMNS), path)
    return tables.read_labelled_csv(spark, path)


@query
def read_filenames(spark, sf_dir):
    path = scratch_path(spark, "names")
    names = derived(spark, sf_dir, "filenames").repartitionByRange(8, "row_id").sortWithinPartitions("row_id")
    names.select("name").write.text(path)
    return tables.read_filenames(spark, path)


@query
def csv_ragged(spark, sf_dir):
    """Many files without a key column, read in the order of the lines, with rows of any length."""
    path = scratch_path(spark, "ragged")
    lines = derived(spark, sf_dir, "ragged_lines").repartitionByRange(8, "k").sortWithinPartitions("k")
    # One column without quotes: the lines and the header go out as they are.
    lines.select(F.col("line").alias(RAGGED_HEADER)).write.options(header=True, sep="\u0001", quote="").csv(path)
    return tables.read_labelled_csv(spark, path, long_rows="mark", multi_line=False)


@query
def row_ids(spark, sf_dir):
    return with_row_id(table(spark, sf_dir, "orders").select("o_orderkey"))


@query
def run_manifest(spark, sf_dir):
    kept = clean.require_episode(_clean(spark, sf_dir))
    return tables.run_manifest(kept, Params().as_dict(), version="test", timestamp=MANIFEST_TIME)


@query
def manifest_clock(spark, sf_dir):
    """The real clock, by whether it is of today; the rest of the manifest as in ``run_manifest``."""
    manifest = tables.run_manifest(clean.require_episode(_clean(spark, sf_dir)), {"b": 1, "a": "x"}, version="v2")
    age = F.abs(F.unix_timestamp() - F.unix_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ssX"))
    return manifest.select("code_version", "config", "row_count", (age < 3600).alias("recent"), F.length("timestamp").alias("width"))


@query
def template_prompts(spark, sf_dir):
    """Prompts by templates that were read from files."""
    folder = scratch_path(spark, "templates")
    for name, words in (("system", SYSTEM_TEXT), ("user", render.USER_TEMPLATE)):
        spark.range(1).select(F.lit(f"  {words}\n\n")).write.text(f"{folder}/{name}.txt")
    system, user = tables.load_templates(spark, folder)
    prompt = render.inference_prompt(F.lit(system), render.user_prompt(F.col("name"), user))
    return derived(spark, sf_dir, "filenames").select("row_id", prompt.alias("prompt"))


# --- cleaning ---


@query
def strip_quotes(spark, sf_dir):
    return _raw(spark, sf_dir).select("row_id", *[text.strip_quotes(F.col(c)).alias(c) for c in ("name", "reasoning")])


@query
def clean_text(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "row_id", *[text.clean_text(F.col(c)).alias(c) for c in ("name", "show_name", "reasoning")]
    )


@query
def to_nullable_int(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "row_id", *[text.to_nullable_int(F.col(c)).alias(c) for c in ("season", "episode")]
    )


@query
def to_confidence(spark, sf_dir):
    return _raw(spark, sf_dir).select("row_id", text.to_confidence(F.col("confidence")).alias("confidence"))


@query
def normalize_crc(spark, sf_dir):
    return _raw(spark, sf_dir).select("row_id", text.normalize_crc(F.col("crc_hash")).alias("crc_hash"))


@query
def clean_metadata(spark, sf_dir):
    return _clean(spark, sf_dir)


@query
def require_episode(spark, sf_dir):
    return clean.require_episode(_clean(spark, sf_dir)).select("row_id", "name", "episode")


# --- rendering ---


@query
def target_json(spark, sf_dir):
    return _clean(spark, sf_dir).select("row_id", render.row_target_json().alias("target"))


@query
def render_prompt(spark, sf_dir):
    return _clean(spark, sf_dir).select("row_id", render.user_prompt(F.col("name")).alias("prompt"))


@query
def sft_examples(spark, sf_dir):
    kept = clean.require_episode(_clean(spark, sf_dir))
    return examples.training_examples(kept, SYSTEM_TEXT)


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query
def render_inference_prompt(spark, sf_dir):
    return _turns(spark, sf_dir).select(
        "conv_id", "turn", render.inference_prompt(F.lit(SYSTEM_TEXT), F.col("text")).alias("prompt")
    )


@query
def render_serving_prompt(spark, sf_dir):
    return _turns(spark, sf_dir).select(
        "conv_id", "turn", render.serving_prompt(F.lit(SYSTEM_TEXT), F.col("text")).alias("prompt")
    )


@query
def chat_messages(spark, sf_dir):
    return _turns(spark, sf_dir).select(
        "conv_id", "turn", F.to_json(render.chat_messages(F.lit(SYSTEM_TEXT), F.col("text"))).alias("messages")
    )


# --- token ids ---


def _joined(c: Column, name: str) -> Column:
    return F.array_join(c.cast("array<string>"), ",").alias(name)


@query
def attention_mask(spark, sf_dir):
    ids = derived(spark, sf_dir, "token_ids")
    return ids.select(
        "id",
        _joined(tokens.attention_mask(F.col("ids"), 0), "mask"),
        _joined(tokens.attention_mask(F.col("ids"), None), "mask_without_pad"),
    )


@query
def mask_labels(spark, sf_dir):
    ids = derived(spark, sf_dir, "token_ids")
    return ids.select(
        "id",
        _joined(tokens.replace_ignored(F.col("ids"), 0, 1), "by_pad"),
        _joined(tokens.replace_ignored(F.col("ids"), None, 1), "by_end"),
    )


@query
def truncate_tokens(spark, sf_dir):
    return derived(spark, sf_dir, "token_ids").select("id", _joined(tokens.truncate_ids(F.col("ids"), 4), "ids"))


@query
def generated_suffix(spark, sf_dir):
    return derived(spark, sf_dir, "token_ids").select(
        "id",
        _joined(tokens.generated_suffix(F.col("ids"), F.col("prompt_len")), "suffix"),
        tokens.generated_count(F.col("ids"), F.col("prompt_len")).alias("n"),
    )


def character_decoder():
    """A stand-in tokenizer: one printable character per id, zero is padding."""
    return lambda rows: ["".join(chr(33 + i % 90) for i in ids if i) for ids in rows]


@query
def decode_tokens(spark, sf_dir):
    ids = derived(spark, sf_dir, "token_ids").withColumn("ids", tokens.replace_ignored(F.col("ids"), 0))
    return generate.decode_tokens(ids, "ids", "text", character_decoder).select("id", "text")


# --- profile and quality ---


@query
def profile_nulls(spark, sf_dir):
    return profile.null_counts(_clean(spark, sf_dir))


def _described(df: DataFrame, column: str) -> DataFrame:
    return profile.describe_column(df, column).select(
        "count",
        *[F.format_string("%.6e", F.col(c)).alias(c) for c in ("mean", "std")],
        *[_rounded(c) for c in ("min", "q25", "q50", "q75", "max")],
    )


@query
def profile_episode(spark, sf_dir):
    return _described(_clean(spark, sf_dir), "episode")


@query
def profile_confidence(spark, sf_dir):
    return _described(_clean(spark, sf_dir), "confidence")


@query
def episode_top20(spark, sf_dir):
    return profile.value_counts(_clean(spark, sf_dir), "episode")


@query
def season_coverage(spark, sf_dir):
    return profile.coverage(_clean(spark, sf_dir), "season").select(_rounded("percent"))


@query
def sample_rows(spark, sf_dir):
    return split.sample_rows(_clean(spark, sf_dir), seed=SEED)


@query
def profile_report(spark, sf_dir):
    """All counts of the report, from the pass that writes the cleaned table."""
    report = profile.write_and_profile(_clean(spark, sf_dir), scratch_path(spark, "profiled"))
    shown = [F.format_string("%.6e", F.col(c)).alias(c) if c.endswith(("_mean", "_std")) else F.col(c) for c in report.columns]
    return report.select(*shown).withColumn("season_coverage", F.round("season_coverage", 6))


@query
def duplicate_names(spark, sf_dir):
    return quality.duplicate_names(_clean(spark, sf_dir).select("row_id", "name"))


@query
def issue_rows(spark, sf_dir):
    return quality.issue_rows(_clean(spark, sf_dir))


@query
def issue_counts(spark, sf_dir):
    return quality.issue_counts(_clean(spark, sf_dir))


# --- split and packing ---


@query
def split_assignment(spark, sf_dir):
    return split.assign_split(_clean(spark, sf_dir), SPLIT_FRACTION, seed=SEED).select("row_id", "split")


@query
def prepare_examples(spark, sf_dir):
    """The chain's written examples, with the side they are on."""
    out = scratch_path(spark, "prepared")
    examples.prepare_run(_raw(spark, sf_dir), out, SYSTEM_TEXT, params=Params(seed=SEED, eval_max_samples=EVAL_CAP))
    sides = [spark.read.parquet(f"{out}/{side}").withColumn("side", F.lit(side)) for side in ("train", "evaluation")]
    return sides[0].unionByName(sides[1])


@query
def eval_cap(spark, sf_dir):
    return split.capped_eval(_clean(spark, sf_dir), EVAL_CAP, SPLIT_FRACTION, seed=SEED).select("row_id", "name")


@query
def pack_sequences(spark, sf_dir):
    return split.pack_sequences(table(spark, sf_dir, "documents"), F.col("n_chars"), PACK_LIMIT, row_id="doc_id")


@query
def pack_sparse(spark, sf_dir):
    return split.pack_sequences(table(spark, sf_dir, "orders"), F.col("o_orderkey") % 700, PACK_LIMIT, row_id="o_orderkey")


@query
def pack_clustered(spark, sf_dir):
    """Ids in two dense clusters and one far outlier."""
    k = F.col("o_orderkey")
    far = F.when(k == 1, 10**15).when(k % 3 == 0, k + 10**9).otherwise(k)
    orders = table(spark, sf_dir, "orders").select(far.alias("row_id"), "o_orderkey")
    return split.pack_sequences(orders, F.col("o_orderkey") % 700, PACK_LIMIT)


@query
def split_and_cap(spark, sf_dir):
    """Split and cap from one chain of histograms."""
    return split.assign_split(_clean(spark, sf_dir), SPLIT_FRACTION, cap=EVAL_CAP, seed=SEED).select("row_id", "split")


@query
def short_run(spark, sf_dir):
    return split.short_run(_clean(spark, sf_dir), 25).select("row_id", "name")


# --- JSON text ---


@query
def extract_json(spark, sf_dir):
    return jsontext.extract_json(derived(spark, sf_dir, "completions"), "pred").select("id", "obj", "obj_error")


@query
def extract_json_once(spark, sf_dir):
    return jsontext.extract_json(derived(spark, sf_dir, "completions"), "pred", retry=False).select(
        "id", "obj", "obj_error"
    )


@query
def extract_json_long(spark, sf_dir):
    return jsontext.extract_json(derived(spark, sf_dir, "long_completions"), "pred").select("id", "obj", "obj_error")


@query
def extract_json_deep(spark, sf_dir):
    return jsontext.extract_json(derived(spark, sf_dir, "deep_completions"), "pred").select("id", "obj", "obj_error")


@query
def extract_json_python(spark, sf_dir):
    found = jsontext.extract_json(derived(spark, sf_dir, "completions"), "pred", mode="python")
    return found.select("id", F.col("obj").isNotNull().alias("found"))


@query
def event_properties(spark, sf_dir):
    found = jsontext.extract_json(spread(table(spark, sf_dir, "events"), "event_id"), "props", retry=False)
    return found.select("event_id", "obj", F.array_join(F.json_object_keys("obj"), ",").alias("keys"))


@query
def truncate_completion(spark, sf_dir):
    return jsontext.truncate_completion(derived(spark, sf_dir, "completions"), "pred").select(
        "id", "truncated", "stopped"
    )


@query
def truncate_token_stop(spark, sf_dir):
    """An id per character, so the stop on ids is that on text, but never before the second id."""
    codes = derived(spark, sf_dir, "completions").select("id", _codes("pred").alias("ids"))
    cut = generate.truncate_token_stop(codes, "ids", "cut", code_decoder, stop_on_tags=True)
    return cut.select("id", "cut_text", F.size("cut").alias("n_ids"), "stopped")


@query
def truncate_stop_strings(spark, sf_dir):
    return derived(spark, sf_dir, "completions").select(
        "id", jsontext.cut_at_stop_strings(F.col("pred")).alias("cut")
    )


@query
def validate_completions(spark, sf_dir):
    found = jsontext.extract_json(derived(spark, sf_dir, "completions"), "pred", retry=False)
    return validate_objects(found).select("id", F.array_join("errors", " | ").alias("errors"))


QUERIES["validate_objects"] = QUERIES.pop("validate_completions")


@query
def score_completions(spark, sf_dir):
    scores = score.score_completions(derived(spark, sf_dir, "completions"))
    return scores.select(*[_rounded(c) for c in scores.columns])


@query
def score_empty(spark, sf_dir):
    logits = table(spark, sf_dir, "events").select(F.array(F.array("value")).alias("pred"), F.lit("x").alias("label"))
    return score.score_completions(logits)


def _codes(c: str) -> Column:
    return F.transform(F.split(F.nullif(F.col(c), F.lit("")), ""), lambda x: F.ascii(x).cast("bigint"))


def code_decoder():
    """A stand-in tokenizer: a character per id, zero is padding."""
    return lambda rows: ["".join(chr(i) for i in ids if i) for ids in rows]


@query
def score_token_ids(spark, sf_dir):
    def ids(c: str) -> Column:
        return F.concat(_codes(c), F.array(F.lit(-100).cast("bigint"))).alias(f"{c}_ids")

    both = derived(spark, sf_dir, "completions").select(ids("pred"), ids("label"))
    scores = score.score_token_ids(both, code_decoder)
    return scores.select(*[_rounded(c) for c in scores.columns])


@query
def score_rows(spark, sf_dir):
    both = derived(spark, sf_dir, "completions")
    paired = score.pair_labels(both.select("id", "pred"), both.filter("label IS NOT NULL").select("id", "label"))
    flags = score.score_rows(paired)
    return flags.drop("pred", "label")


@query
def pair_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return score.pair_labels(documents, table(spark, sf_dir, "labels"), "doc_id")


@query
def pair_positions(spark, sf_dir):
    """Predictions and labels in files of different number, paired by position; there are fewer labels."""
    both = derived(spark, sf_dir, "completions")
    sides = []
    for column, rows, files in (("pred", both, 7), ("label", both.filter("id % 11 <> 0"), 3)):
        path = scratch_path(spark, f"positions-{column}")
        ordered = rows.select(F.col("id").alias(f"{column}_id"), column).repartitionByRange(files, f"{column}_id")
        ordered.sortWithinPartitions(f"{column}_id").write.parquet(path)
        sides.append(spark.read.parquet(path))
    return score.pair_positions(*sides)


# --- attempts and generation ---


@query
def first_valid_attempt(spark, sf_dir):
    records = attempts.first_valid_attempt(derived(spark, sf_dir, "attempts"))
    return records.withColumn("errors", F.array_join("errors", " | "))


@query
def retry_summary(spark, sf_dir):
    return attempts.run_summary(attempts.first_valid_attempt(derived(spark, sf_dir, "attempts"), max_retries=4))


def length_generator():
    """A stand-in model: the prompt's length decides from which temperature on it answers validly."""

    def generate_(prompts, temperature, top_p):
        out = []
        for p in prompts:
            if temperature * 10 + 1e-6 >= len(p) % 5:
                a = (
                    f'{{"show_name":"Length {len(p)}","season":null,"episode":{len(p)},'
                    '"crc_hash":null,"confidence":0.9,"reasoning":"stub"}'
                )
            else:
                a = "no object here"
            out.append((a, len(a)))
        return out

    return generate_


@query
def infer_chain(spark, sf_dir):
    records = generate.infer_metadata(derived(spark, sf_dir, "filenames"), length_generator, SYSTEM_TEXT)
    return records.select("row_id", "status", "attempt", "obj", F.array_join("errors", " | ").alias("errors"))


@query
def batch_generate(spark, sf_dir):
    prompts = derived(spark, sf_dir, "filenames").select(
        "row_id", render.inference_prompt(F.lit(SYSTEM_TEXT), render.user_prompt(F.col("name"))).alias("prompt")
    )
    records = generate.batch_generate(prompts, length_generator)
    return records.withColumn("errors", F.array_join("errors", " | ")).drop("seconds")


@query
def generate_resumed(spark, sf_dir):
    """A run over all names after one over half of them: the answers of one run."""
    prompts = derived(spark, sf_dir, "filenames").select(
        "row_id", render.inference_prompt(F.lit(SYSTEM_TEXT), render.user_prompt(F.col("name"))).alias("prompt")
    )
    store = scratch_path(spark, "answers")
    generate.generate_resumable(prompts.filter("row_id % 2 = 0"), length_generator, store, waves=2)
    records = generate.generate_resumable(prompts, length_generator, store, waves=2)
    return records.withColumn("errors", F.array_join("errors", " | ")).drop("seconds")


# --- filename extraction ---


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.parse_filename(derived(spark, sf_dir, "filenames"))


@query
def fn_stem(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_stem")


@query
def fn_crc(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_crc")


@query
def fn_season(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_season")


@query
def fn_episode(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_episode", "fn_version")


@query
def fn_asset(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_asset")


@query
def fn_title(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_title")


@query
def fn_confidence(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "fn_confidence")


@query
def extract_metadata(spark, sf_dir):
    return fn.extract_metadata(derived(spark, sf_dir, "filenames"))
