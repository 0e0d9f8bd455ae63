"""Queries over what the audits leave behind: summaries, marked records, lines of a diff, gains held back by a limiter."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwright.operators import loudness, manifests, reports, speakers
from loomwright.plans.catalogue import _DIFF, _SPEAKERS, _variants, query, rounded, table
from loomwright.plans.recordings import _OF_DOCUMENTS, heard, new_folder

_RANKED = _SPEAKERS[: _SPEAKERS.rindex("SELECT vec_id")].format(k=1)


@query(f"""{_RANKED}, p AS (SELECT *, similarity < thr AS under, similarity < thr AND rk <= greatest(1, floor(n * 0.1)) AS pruned FROM r)
  SELECT count(*) AS row_count, count(*) FILTER (NOT pruned) AS kept_count, count(*) FILTER (pruned) AS pruned_count, round(any_value(thr), 4) AS threshold, round(any_value(med), 4) AS median,
    round(any_value(mad), 4) AS mad, count(*) FILTER (under) AS threshold_prune_count, count(*) FILTER (under AND NOT pruned) AS capped_prune_count,
    greatest(1, floor(count(*) * 0.1))::BIGINT AS max_allowed_prune_count FROM p""")
def speaker_summary(spark, sf_dir):
    scored = speakers.cosine_scores(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")
    found = reports.speaker_summary(speakers.prune_outliers(scored, F.col("vec_id"), 1.0))
    numbers = rounded("threshold", "median", "mad")
    return found.select("row_count", "kept_count", "pruned_count", *numbers, "threshold_prune_count", "capped_prune_count", "max_allowed_prune_count")


@query("""WITH d AS (SELECT doc_id, list_filter([CASE WHEN max(toxic) = 1 THEN 'toxic' END, CASE WHEN min(quality) = 0 THEN 'low quality' END], lambda x: x IS NOT NULL) AS why FROM labels GROUP BY doc_id)
  SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":' || to_json(lang) || ',"source":' || to_json(source) || ', "normalization_pruned":true,"normalization_reasons":["' || array_to_string(why, '","') || '"]}' AS payload
  FROM documents JOIN d USING (doc_id) WHERE len(why) > 0""")
def marked_records(spark, sf_dir):
    """Records of pruned documents, their fields as they were and two more behind them."""
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("t"), F.min("quality").alias("q"))
    why = F.array_compact(F.array(F.when(F.col("t") == 1, F.lit("toxic")), F.when(F.col("q") == 0, F.lit("low quality"))))
    decided = marks.select(F.col("doc_id").alias("stem"), why.alias("reasons")).withColumn("pruned", F.size("reasons") > 0)
    records = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("stem"), F.to_json(F.struct("doc_id", "lang", "source")).alias("payload"))
    return loudness.pruned_records(records, decided).select(F.col("stem").alias("doc_id"), "payload")


@query("""SELECT '{"documents":' || count(*) || ',"characters":' || sum(n_chars) || ',"languages":' || count(DISTINCT lang) || ',"no_source":' || count(*) FILTER (source IS NULL) || '}' AS summary FROM documents""")
def summary_file(spark, sf_dir):
    """Counts of a run, written as one JSON object and read back."""
    path = new_folder(spark, "summary")
    docs = table(spark, sf_dir, "documents")
    row = docs.agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"), F.count_distinct("lang").alias("languages"), F.count_if(F.col("source").isNull()).alias("no_source"))
    reports.write_summary(row, path)
    return spark.read.text(path).select(F.col("value").alias("summary"))


@query(f"""WITH {_OF_DOCUMENTS},
  a AS (SELECT doc_id, max(abs(v)) / 32768.0::DOUBLE AS top, count(*) AS n FROM s GROUP BY doc_id UNION ALL SELECT doc_id, 0, 0 FROM documents WHERE coalesce(length(text), 0) = 0),
  g AS (SELECT *, (n % 30)::DOUBLE AS gain, pow(10, -1 / 20.0) AS most FROM a)
  SELECT doc_id, gain AS requested_gain_db, top * pow(10, gain / 20) > most AS peak_limited, 44 + 2 * n AS n_bytes,
    round(CASE WHEN top * pow(10, gain / 20) > most THEN 20 * log10(most / top) ELSE gain END, 4) AS applied_gain_db FROM g""")
def limited_recordings(spark, sf_dir):
    """Gains of 0 to 29 dB, held back where the peak would pass -1 dBFS."""
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stem"), (F.coalesce(F.length("text"), F.lit(0)) % 30).cast("double").alias("needed_gain_db"), F.lit(False).alias("pruned"))
    found = loudness.normalise_files(heard(spark, sf_dir), asked)
    return found.select(F.col("stem").cast("long").alias("doc_id"), "requested_gain_db", "peak_limited", F.length("content").cast("long").alias("n_bytes"), *rounded("applied_gain_db"))


@query(_DIFF + """, k AS (SELECT b.doc_id, CASE WHEN no_l THEN 'added' WHEN no_r THEN 'removed' ELSE 'changed' END AS status, NOT no_l AND NOT no_r AND t AS t, l.text AS a, r.text AS z
    FROM b LEFT JOIN l ON l.doc_id = b.doc_id LEFT JOIN r ON r.doc_id = b.doc_id WHERE no_l OR no_r OR t OR g OR z),
  m AS (SELECT doc_id, list_filter([status || ' ' || doc_id, CASE WHEN t THEN '  text: ' || a || ' -> ' || z END], lambda x: x IS NOT NULL) AS ls FROM k)
  SELECT doc_id, unnest(range(len(ls)))::INT AS line, unnest(ls) AS text FROM m""")
def diff_report(spark, sf_dir):
    """A diff as lines of text: a head for each key that differs, and a line for each field with both of its values."""
    left, right = _variants(spark, sf_dir)
    found = manifests.diff(left, right, "doc_id", ["text", "lang", "size"], {"size": 1e-6})
    sides = [rows.select("doc_id", F.col("text").alias(f"{side}_text"), F.col("lang").alias(f"{side}_lang")) for rows, side in ((left, "l"), (right, "r"))]
    shown = found.join(sides[0], "doc_id", "left").join(sides[1], "doc_id", "left")
    return reports.diff_lines(shown, "doc_id", {"text": ("l_text", "r_text"), "lang": ("l_lang", "r_lang")})
