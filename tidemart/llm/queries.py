"""Queries of the pipeline operators over the tables of a folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import prepare, work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


import public_tokenizers  # noqa: E402

from tidemart.llm.copies import find_copies  # noqa: E402
from tidemart.llm.decontaminate import find_leaks  # noqa: E402
from tidemart.llm.fingerprints import fingerprint_edits  # noqa: E402
from tidemart.llm.jaccard import link_components  # noqa: E402
from tidemart.llm.language import fit_centroids, is_held_out, predict_language  # noqa: E402
from tidemart.llm.licenses import scan_licenses  # noqa: E402
from tidemart.llm.manifest import prove_rows  # noqa: E402
from tidemart.llm.pieces import encode_pieces  # noqa: E402
from tidemart.llm.quality import judge_quality  # noqa: E402
from tidemart.llm.spelling import group_spellings  # noqa: E402
from tidemart.llm.token_counts import count_tokens  # noqa: E402
from tidemart.llm.token_files import read_token_files, write_token_files  # noqa: E402
from tidemart.llm.url_rules import Rule, judge_urls  # noqa: E402

URL_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@query("op1_pieces")
def op1(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(table(spark, sf_dir, "documents"), path, keep_ids=False)


@query("op3_fingerprint")
def op3(spark, sf_dir):
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op6_token_files")
def op6(spark, sf_dir):
    parts = write_token_files(
        table(spark, sf_dir, "documents"),
        work_path(spark, "tokens"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=1,
    )
    return read_token_files(parts)


@query("op7_quality")
def op7(spark, sf_dir):
    judged = judge_quality(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels")
    )
    return judged.select("doc_id", "lang", "perplexity", "threshold", "kept")


@query("op8_language")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = fit_centroids(docs, ~is_held_out(F.col("doc_id")))
    found = predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query("op10_jaccard")
def op10(spark, sf_dir):
    return link_components(table(spark, sf_dir, "documents"))


@query("op2_decontamination")
def op2(spark, sf_dir):
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), consistent=False)
    return leaks.select("doc_id", "item_id", "share")


@query("op4_token_counts")
def op4(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_license_scan")
def op5(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


@query(
    "op9_url_filter",
    r"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?:.|\n)*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?:.|\n)*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), hit AS (
  SELECT u.page_id, u.host, u.path,
    CASE WHEN starts_with(u.path, '/en/') AND (u.host = 'example.net' OR u.host LIKE '%.example.net') THEN 'example.net/en/'
         WHEN starts_with(u.path, '/de/') AND (u.host = 'example.com' OR u.host LIKE '%.example.com') THEN 'example.com/de/'
         WHEN starts_with(u.path, '/fr/') AND (u.host = 'org' OR u.host LIKE '%.org') THEN 'org/fr/'
         WHEN starts_with(u.path, '/') AND (u.host = 'net' OR u.host LIKE '%.net') THEN 'net/' END AS rule
  FROM u
)
SELECT hit.page_id, hit.host, hit.path, hit.rule, coalesce(r.verdict, 'allow') AS verdict
FROM hit LEFT JOIN r ON hit.rule = r.host || r.path
""",
)
def op9(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query(
    "op12_copies",
    r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS c
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
  row_number() OVER g = 1 AS kept, sha256(c) AS text_sha256
FROM t WINDOW g AS (PARTITION BY c ORDER BY n DESC, doc_id)
""",
)
def op12(spark, sf_dir):
    return find_copies(table(spark, sf_dir, "documents"))


@query("op11_manifest")
def op11(spark, sf_dir):
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    copy = {"text": F.when(changed, lower).otherwise(F.col("text"))}
    return prove_rows(table(spark, sf_dir, "documents"), copy=copy)


@query("op13_spelling")
def op13(spark, sf_dir):
    return group_spellings(table(spark, sf_dir, "documents"), drop_every=97)
