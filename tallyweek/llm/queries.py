"""The registered queries of the llm operators, over whole tables, and their SQL where it exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm import crosspolytope, infill, licences, packing, periods, personal, pieces, quality, repeats, secrets, simhash, sketches, warc
from tallyweek.llm.shared import landed, shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_assembly(spark: SparkSession, folder: str) -> DataFrame:
    archive = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    pages = _table(spark, folder, "pages")
    warc.write_archive(pages, archive)
    captures = warc.assemble(warc.read_records(spark, archive))
    kind = pages.schema["page_id"].dataType
    rows = captures.select(
        "record_id", F.col("metadata")[0]["page_id"].cast(kind).alias("page_id"), "response.type", "response.refers_to",
        "response.payload_bytes", "response.payload_digest",
    )
    rows = landed(rows, "captures")
    responses = rows.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("of_page"))
    joined = rows.where("type = 'revisit'").join(responses, "refers_to", "left")
    out = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    return joined.select(*out, F.col("of_page").alias("refers_to")).union(
        rows.where("type = 'response'").select(*out, F.lit(None).cast(kind).alias("refers_to"))
    )


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return placed.withColumnRenamed("id", "doc_id")


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, folder, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select(F.col("id").alias("doc_id"), fingerprint.alias("fingerprint"), F.col("component").alias("component_id"))


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.remove_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, r: total + r["e"] - r["s"])
    return rows.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    scorer = quality.fit(docs, labels.where(fold != 2))
    rows = quality.score(docs, scorer).withColumnRenamed("id", "doc_id")
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return rows.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op6_paragraph_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.fingerprints(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op7_crosspolytope_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = crosspolytope.near_vectors(_table(spark, folder, "embeddings"))
    kept = F.col("id").eqNullSafe(F.col("component"))
    return rows.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = secrets.find_secrets(_table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != "named")
    return rows.select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op9_sentencepiece_codec(spark: SparkSession, folder: str) -> DataFrame:
    rows = pieces.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.withColumnRenamed("id", "doc_id")


def op10_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = licences.scan(_table(spark, folder, "documents"))
    named = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    return rows.select(
        F.col("id").alias("doc_id"), F.size("matches").cast("bigint").alias("n_units"), F.concat_ws(",", named).alias("licences"),
        F.array_max(F.transform("matches", lambda m: m["dice"])).alias("best_dice"),
    )


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = personal.find_personal(_table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(personal.BASE))
    return rows.select(
        F.col("id").alias("doc_id"), *(count(kind).alias(f"n_{kind}") for kind in personal.BASE),
        F.sha2(personal.spans_text(base), 256).alias("base_sha256"), personal.spans_text(F.col("spans")).alias("spans"),
    )


def _with_periods(docs: DataFrame) -> DataFrame:
    """The texts of op12: from place a on, every tenth document by its digest repeats p of its words.
    Lists are cut and joined whole, so the words are found once a document, not once a word."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.regexp_extract_all(F.when(h % 10 == 0, F.col("text")), F.lit(r"[^\x20\x09-\x0D]+"), 0).alias("w"))
    rows = rows.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    rows = rows.withColumn("p", (1 + F.expr("(n - a) div (3 + g % 8)")).cast("int"))
    unit = F.slice("w", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), F.col("n") - F.col("a"))
    repeated = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = periods.periodic_runs(_with_periods(_table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return rows.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = infill.fill_in_middle(_table(spark, folder, "documents"))
    restored = infill.restored(F.col("output"), F.col("form"))
    return rows.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def _licence_sql() -> str:
    """Dice coefficients in SQL: a row per unit and template, without size bounds."""
    lists = ", ".join(
        f"('{name}', [{', '.join(chr(39) + pair + chr(39) for pair in licences.template_bigrams(text))}])" for name, text in licences.TEMPLATES.items()
    )
    return f"""
WITH t(licence, pairs) AS (VALUES {lists}),
u AS (SELECT DISTINCT doc_id, trim(regexp_replace(translate(unit, '{licences.CAPITALS}', '{licences.SMALL}'), '[^a-z0-9]+', ' ', 'g')) AS unit
      FROM (SELECT doc_id, unnest(list_append(string_split(coalesce(text, ''), chr(10)), coalesce(text, ''))) AS unit FROM documents) x),
w AS (SELECT doc_id, unit, string_split(unit, ' ') AS words FROM u WHERE unit LIKE '% %'),
b AS (SELECT doc_id, unit, list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS own FROM w),
d AS (SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(own, pairs)) / (len(own) + len(pairs)) AS dice FROM b JOIN t ON len(own) BETWEEN len(pairs) * 0.66 AND len(pairs) * 1.51),
m AS (SELECT doc_id, unit, max(dice) AS dice, arg_max(licence, (dice, -ord(licence))) AS licence FROM d WHERE dice >= 0.8 GROUP BY doc_id, unit)
SELECT doc_id, count(m.unit) AS n_units, coalesce(string_agg(DISTINCT m.licence, ',' ORDER BY m.licence), '') AS licences, max(m.dice) AS best_dice
FROM documents LEFT JOIN m USING (doc_id) GROUP BY doc_id
"""


QUERIES: dict[str, Query] = {
    "op1_warc_assembly": op1_warc_assembly,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_paragraph_sketches": op6_paragraph_sketches,
    "op7_crosspolytope_near_dedup": op7_crosspolytope_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_sentencepiece_codec": op9_sentencepiece_codec,
    "op10_licence_scan": op10_licence_scan,
    "op11_personal_data": op11_personal_data,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_assembly": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS stored FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> stored THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> stored THEN stored END AS refers_to
FROM f
""",
    "op10_licence_scan": _licence_sql(),
    "op13_fill_in_middle": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS hex,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
h AS (SELECT *, CAST(len(units) AS BIGINT) AS n, [CAST('0x' || substr(hex, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM t),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
       WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
""",
}
