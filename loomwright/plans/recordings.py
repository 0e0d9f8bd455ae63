"""Queries over recordings, files and manifests that Spark makes of the texts of the driver's tables.

A text sounds as one sample a character at 1000 Hz: letters and digits by
their code points, blanks and most punctuation as silence. Samples are whole
16-bit numbers, so that SQL knows them exactly. Where pauses matter, a line
feed is three seconds of silence, and so are both ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.tables import shared_dir, sorted_sides, spread, with_rank, written
from loomwright.operators import models, reports, signal
from loomwright.plans.catalogue import query, rounded, table
from loomwright.sources import audio, files, manifests

RATE = 1000
#: Bytes of files that a task hands on at once.
MOST_BYTES = 1 << 24
#: Silent samples of a line feed and of both ends in paused recordings.
PAUSE = 3000

_SAMPLES = """c AS (SELECT {ident}, unnest(string_split({text}, '')) AS ch, unnest(range(length({text}))) AS p, length({text}) AS n FROM {table} WHERE length({text}) > 0),
  s AS (SELECT {ident}, p, n, CASE WHEN unicode(ch) < 48 THEN 0 ELSE (unicode(ch)::BIGINT * 37 % 101 - 50) * 256 END AS v FROM c)"""
_OF_DOCUMENTS = _SAMPLES.format(ident="doc_id", text="text", table="documents")
_OF_PAGES = _SAMPLES.format(ident="page_id", text="html", table="pages")


def samples(text: str, paused: bool) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    value = np.where(code < 48, 0, (code * 37 % 101 - 50) * 256)
    if not paused:
        return value
    width = np.where(code == ord("\n"), PAUSE, 1)
    out = np.zeros(2 * PAUSE + int(width.sum()), np.int64)
    out[PAUSE + np.cumsum(width) - width] = value
    return out


def recorded(rows: DataFrame, ident: str, text: str, paused: bool = False) -> DataFrame:
    """``stem, content``: each text as a WAV file, named by its id. A null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stems, wavs, held = [], [], 0
            for stem, t in zip(batch.column("stem").to_pylist(), batch.column("t"), strict=True):
                stems.append(stem)
                wavs.append(wav(t.as_py(), paused))
                held += len(wavs[-1])
                if held >= MOST_BYTES:
                    yield pa.record_batch([pa.array(stems, pa.string()), pa.array(wavs, pa.binary())], ["stem", "content"])
                    stems, wavs, held = [], [], 0
            yield pa.record_batch([pa.array(stems, pa.string()), pa.array(wavs, pa.binary())], ["stem", "content"])

    return rows.select(F.col(ident).cast("string").alias("stem"), F.col(text).alias("t")).mapInArrow(run, "stem string, content binary")


def documents(spark: SparkSession, sf_dir: str, paused: bool = False) -> DataFrame:
    return recorded(table(spark, sf_dir, "documents"), "doc_id", "text", paused)


def wav(text: str | None, paused: bool = False) -> bytes:
    return audio.encode_wav(samples(text or "", paused) / 32767, RATE)


def heard(spark: SparkSession, sf_dir: str, paused: bool = False, name: str = "documents", ident: str = "doc_id", text: str = "text") -> audio.Made:
    """The recordings of :func:`recorded`, each made by the task that listens to it: only texts are read and moved."""
    rows = table(spark, sf_dir, name).select(F.col(ident).cast("string").alias("stem"), F.col(text).alias("of"))
    return audio.Made(rows, partial(wav, paused=paused))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _doc(c: str = "stem"):
    return F.col(c).cast("long").alias("doc_id")


# -- signals -------------------------------------------------------------


@query(f"""WITH {_OF_DOCUMENTS},
  f AS (SELECT doc_id, p, n, sqrt(sum(v * v) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) / 20.0) / 32768 AS rms FROM s)
  SELECT doc_id, count(*) AS n_frames, round(avg(rms), 4) AS mean_rms, round(max(rms), 4) AS top_rms, count(*) FILTER (rms < 0.15) AS n_low FROM f WHERE p % 5 = 0 AND p <= greatest(0, n - 20) GROUP BY doc_id
  UNION ALL SELECT doc_id, 1, 0, 0, 1 FROM documents WHERE coalesce(length(text), 0) = 0""")
def recording_levels(spark, sf_dir):
    """Frames of 20 ms every 5 ms."""
    return signal.frame_stats(heard(spark, sf_dir), 0.15, RATE).select(_doc(), "n_frames", *rounded("mean_rms", "top_rms"), "n_low")


@query()
def recording_chunks(spark, sf_dir):
    """Greedy chunks of 0.5 to 1.5 seconds at the quietest silent frames; sequential, so without SQL (the tests hold it to a fold)."""
    found = signal.chunk_files(heard(spark, sf_dir), RATE, 0.5, 1.5)
    return found.select(_doc(), *rounded("start_sec", "end_sec"), "method")


_EDGES = f"""{_OF_DOCUMENTS},
  e AS (SELECT doc_id, 'start' AS side, p AS q, v FROM s WHERE p < 250 UNION ALL SELECT doc_id, 'end', n - 1 - p, v FROM s WHERE n - 1 - p < 250),
  b AS (SELECT *, (v < 0) <> (lag(v) OVER (PARTITION BY doc_id, side ORDER BY q) < 0) AS crossed FROM e),
  r AS (SELECT doc_id, side, sqrt(avg(v * v) FILTER (q < 50)) / 32768 AS edge_rms, max(abs(v)) FILTER (q < 10) / 32768.0::DOUBLE AS edge_peak, max(abs(v)) FILTER (q = 0) / 32768.0::DOUBLE AS boundary,
    coalesce(sqrt(avg(v * v) FILTER (q >= 50)), 0) / 32768 AS inner_rms, coalesce(avg(crossed::INT) FILTER (q BETWEEN 1 AND 49), 0) AS crossings FROM b GROUP BY ALL),
  g AS (SELECT doc_id, side, edge_rms, edge_peak, boundary, edge_rms / (inner_rms + 1e-8) AS sustain, crossings FROM r
    UNION ALL SELECT doc_id, unnest(['start', 'end']), 0, 0, 0, 0, 0 FROM documents WHERE coalesce(length(text), 0) = 0)"""


@query(f"WITH {_EDGES} SELECT doc_id, side, round(edge_rms, 4) AS edge_rms, round(edge_peak, 4) AS edge_peak, round(boundary, 4) AS boundary, round(sustain, 4) AS sustain, round(crossings, 4) AS crossings FROM g")
def recording_edges(spark, sf_dir):
    found = signal.edges_of_files(heard(spark, sf_dir))
    return found.select(_doc(), "side", *rounded("edge_rms", "edge_peak", "boundary", "sustain", "crossings"))


@query(f"""WITH {_EDGES},
  l AS (SELECT doc_id, side, unnest([1, 2, 3, 4, 5]) AS f, unnest([log10(edge_rms + 1e-8), log10(edge_peak + 1e-8), log10(boundary + 1e-8), log10(sustain + 1e-8), crossings]) AS x FROM g),
  m AS (SELECT side, f, median(x) AS med, stddev_pop(x) AS sd FROM l GROUP BY ALL),
  d AS (SELECT side, f, median(abs(x - med)) AS mad FROM l JOIN m USING (side, f) GROUP BY ALL),
  z AS (SELECT doc_id, side, sum(greatest((x - med) / CASE WHEN mad >= 1e-9 THEN mad / 0.67448975 WHEN sd > 1e-9 THEN sd ELSE 1 END, 0) * [0.3, 0.2, 0.3, 0.15, 0.05][f]) AS score
    FROM l JOIN m USING (side, f) JOIN d USING (side, f) GROUP BY doc_id, side)
  SELECT doc_id, side, round(score, 4) AS score, round(1 / (1 + exp(-greatest(-60, least(60, score - 1.5)))), 4) AS likelihood FROM z""")
def abrupt_edges(spark, sf_dir):
    return signal.abrupt_edges(heard(spark, sf_dir)).select(_doc(), "side", *rounded("score", "likelihood"))


# Frames of 2048 samples about every 512th, their power, and speech regions from them.
_FRAMES = f"""{_OF_DOCUMENTS},
  a AS (SELECT doc_id, v, {PAUSE} + sum(CASE WHEN ch = chr(10) THEN {PAUSE} ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) - 1 AS pos FROM c JOIN s USING (doc_id, p) QUALIFY v <> 0),
  h AS (SELECT doc_id, coalesce(length(text) + {PAUSE - 1} * (length(text) - length(replace(text, chr(10), ''))), 0) + {2 * PAUSE} AS n FROM documents),
  e AS (SELECT doc_id, k, sum(v * v) AS e FROM (SELECT doc_id, v, unnest(range(((pos - 1024) // 512 + 1)::BIGINT, ((pos + 1024) // 512 + 1)::BIGINT)) AS k FROM a) GROUP BY ALL),
  f AS (SELECT doc_id, n, unnest(range(1 + n // 512)) AS k FROM h),
  x AS (SELECT doc_id, n, k, greatest(coalesce(e, 0) / 2048.0 / (32768.0::DOUBLE * 32768), 1e-10) AS power FROM f LEFT JOIN e USING (doc_id, k)),
  y AS (SELECT doc_id, n, k, 10 * log10(power / max(power) OVER (PARTITION BY doc_id)) AS db FROM x)"""
_SPEECH = f"""{_FRAMES},
  i AS (SELECT doc_id, n, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM y WHERE db > -30),
  j AS (SELECT doc_id, greatest(0, min(k) * 512 - 200) AS b, least(n, least((max(k) + 1) * 512, n) + 200) AS z FROM i GROUP BY doc_id, n, i),
  o AS (SELECT *, coalesce((b - lag(z) OVER (PARTITION BY doc_id ORDER BY b) >= 300)::INT, 1) AS new FROM j WHERE z - b >= 250),
  u AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY b) AS region FROM o),
  w AS (SELECT doc_id, min(b) AS b, max(z) AS z FROM u GROUP BY doc_id, region)"""


@query(f"WITH {_SPEECH} SELECT doc_id, b AS start, z AS end FROM w")
def recording_speech(spark, sf_dir):
    return signal.speech_files(heard(spark, sf_dir, True), RATE).select(_doc(), "start", "end")


@query(f"""WITH {_FRAMES},
  t AS (SELECT doc_id, n, min(k) FILTER (db > -60) * 512 AS b, least(n, (max(k) FILTER (db > -60) + 1) * 512) AS z, max(power) FROM x JOIN y USING (doc_id, n, k) GROUP BY doc_id, n HAVING max(power) > 1e-10)
  SELECT doc_id, round(greatest(0, b / 1000 - 0.2), 4) AS cut_start_sec, round(least(n / 1000, z / 1000 + 0.2), 4) AS cut_end_sec, NULL AS problem FROM t
  UNION ALL SELECT doc_id, 0, n / 1000, 'trim_empty' FROM h WHERE doc_id NOT IN (SELECT doc_id FROM t)""")
def recording_trims(spark, sf_dir):
    """Whole recordings as one rough segment each, without their silent ends."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    n = F.length("text") + (PAUSE - 1) * (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))) + 2 * PAUSE
    rough = docs.select(F.col("doc_id").cast("string").alias("stem"), F.lit(0).cast("long").alias("segment_index"), F.lit(0.0).alias("start_sec"), (n / RATE).alias("end_sec"))
    return signal.trim_segments(heard(spark, sf_dir, True), rough).select(_doc(), *rounded("cut_start_sec", "cut_end_sec"), "problem")


_LEVELS = f"""{_SPEECH},
  q AS (SELECT doc_id, sum(z - b) AS n FROM w GROUP BY doc_id),
  v AS (SELECT doc_id, sum(v * v) AS e FROM a JOIN w USING (doc_id) WHERE pos >= b AND pos < z GROUP BY doc_id),
  g AS (SELECT doc_id, n / 1000 AS speech_sec, 10 * log10(e / n / (32768.0::DOUBLE * 32768)) AS speech_dbfs, 20 * log10(top / 32768) AS peak_dbfs
    FROM q JOIN v USING (doc_id) JOIN (SELECT doc_id, max(abs(v)) AS top FROM a GROUP BY doc_id) USING (doc_id)),
  d AS (SELECT *, speech_dbfs - 1 - peak_dbfs AS safe_dbfs FROM g)"""


@query(f"WITH {_LEVELS} SELECT doc_id, round(speech_sec, 4) AS speech_sec, round(speech_dbfs, 4) AS speech_dbfs, round(peak_dbfs, 4) AS peak_dbfs, round(safe_dbfs, 4) AS safe_dbfs FROM d")
def speech_levels(spark, sf_dir):
    return signal.speech_levels(heard(spark, sf_dir, True), RATE).select(_doc(), *rounded("speech_sec", "speech_dbfs", "peak_dbfs", "safe_dbfs"))


@query(f"""WITH {_LEVELS},
  k AS (SELECT speech_dbfs, sum(sum(speech_sec)) OVER (ORDER BY speech_dbfs) AS upto, sum(sum(speech_sec)) OVER () AS total FROM d GROUP BY speech_dbfs)
  SELECT round(least((SELECT min(speech_dbfs) FROM k WHERE upto >= total / 2), (SELECT min(safe_dbfs) FROM d), -1), 4) AS target""")
def library_target(spark, sf_dir):
    """The level that all recordings can be brought to: the weighted median of their speech, under every one's safe level."""
    return signal.library_target(written(signal.speech_levels(heard(spark, sf_dir, True), RATE))).select(*rounded("target"))


@query(f"""WITH {_OF_DOCUMENTS},
  a AS (SELECT doc_id, sqrt(avg(v * v)) / 32768 AS rms FROM s GROUP BY doc_id),
  b AS (SELECT doc_id, pow(10, -25 / 20.0) / rms AS factor FROM a WHERE rms > 1e-8),
  k AS (SELECT doc_id, p // 100 AS k, sqrt(avg(v * v)) / 32768 AS r FROM s GROUP BY ALL),
  f AS (SELECT doc_id, factor, r * factor AS r, avg(r * factor) OVER (PARTITION BY doc_id) AS middle FROM k JOIN b USING (doc_id)),
  g AS (SELECT doc_id, any_value(factor) AS factor, sqrt(avg(r * r) FILTER (r > middle)) AS loud FROM f GROUP BY doc_id)
  SELECT doc_id, n_samples, round(coalesce(1 / (factor * coalesce(pow(10, -25 / 20.0) / loud, 1)), 1), 4) AS undo FROM (SELECT doc_id, coalesce(length(text), 0) AS n_samples FROM documents) LEFT JOIN g USING (doc_id)""")
def levelled_recordings(spark, sf_dir):
    """Recordings at the level of their loud pieces, and the factor that takes it back."""
    found = signal.level_files(heard(spark, sf_dir))
    return found.select(_doc(), (F.length("samples") / 4).cast("long").alias("n_samples"), *rounded("undo"))


def halved():
    """A stand-in for a separator: one voice, at half of the level."""
    return lambda x, rate: [x * np.float32(0.5)]


def above_and_below():
    """A stand-in for a separator: what lies above zero, and what lies below."""
    return lambda x, rate: [np.maximum(x, 0), np.minimum(x, 0)]


@query(f"""WITH {_OF_DOCUMENTS},
  a AS (SELECT doc_id, sqrt(avg(v * v)) / 65536 AS rms, max(abs(v)) / 65536.0::DOUBLE AS peak FROM s GROUP BY doc_id UNION ALL SELECT doc_id, 0, 0 FROM documents WHERE coalesce(length(text), 0) = 0),
  t AS (SELECT doc_id, peak <= 1e-8 AS silent, unnest(['target-rms', 'target-peak']) AS mode, unnest([0.1 / nullif(rms, 0), pow(10, -3 / 20.0) / nullif(peak, 0)]) AS wanted, pow(10, -1 / 20.0) / nullif(peak, 0) AS most FROM a)
  SELECT doc_id, 'none' AS mode, 1.0::DOUBLE AS gain, 'disabled' AS reason FROM a
  UNION ALL SELECT doc_id, 'rms-peak', CASE WHEN peak > 1e-8 THEN 2.0 ELSE 1.0 END, 'source rms-peak' FROM a
  UNION ALL SELECT doc_id, mode, CASE WHEN silent THEN 1 ELSE round(least(wanted, most), 4) END,
    CASE WHEN silent THEN 'silent output' WHEN wanted > most THEN 'limited by peak ceiling -1.0 dBFS' WHEN mode = 'target-rms' THEN 'target rms -20.0 dBFS' ELSE 'target peak -3.0 dBFS' END FROM t""")
def gain_modes(spark, sf_dir):
    """A model's outputs at the level of their sources, at a target, and as they are."""
    modes = [("none", None), ("rms-peak", None), ("target-rms", -20.0), ("target-peak", -3.0)]
    return signal.restored_voices(heard(spark, sf_dir), halved, RATE, modes).select(_doc(), "mode", *rounded("gain"), "reason")


@query("""WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS n, floor(coalesce(length(text), 0) / 1000 * 4)::BIGINT AS m FROM documents)
  SELECT doc_id, array_to_string(list_transform(range(m), lambda k: chr((97 + k % 26)::INT)), '') AS heard, m AS n_times, round(CASE WHEN m > 0 THEN n / 1000 * (m - 1) / m END, 10) AS last_sec FROM t""")
def transcribed_recordings(spark, sf_dir):
    """Recordings through a recogniser and an aligner (stand-ins), in batches of like length, four tasks at once. Ten decimals: times of 1/8 or 1/64 of a length lie between four."""
    levelled = signal.level_files(heard(spark, sf_dir)).withColumn("n", F.length("samples"))
    texts = models.apply_model(levelled.select("stem", "samples", "rate", "n"), ["samples", "rate"], "heard", "string", "transcriber", models.fixed_rate_transcriber, order="n", at_once=4, keep=["stem", "rate", "n"])
    timed = texts.select("stem", "heard", (F.col("n") / 4 / F.col("rate")).alias("sec"))
    times = models.apply_model(timed, ["heard", "sec"], "times", "array<double>", "aligner", models.even_aligner)
    return times.select(_doc(), "heard", F.size("times").cast("long").alias("n_times"), F.round(F.try_element_at("times", F.lit(-1)), 10).alias("last_sec"))


# -- files ---------------------------------------------------------------


def _heard(rows: DataFrame | audio.Made) -> DataFrame:
    """Samples, their sum and the loudest of each file, as whole numbers."""
    whole = lambda x: np.rint(x.astype(np.float64) * 32768).astype(np.int64)
    return signal.per_file(rows, "rate long, n_samples long, total long, loudest long", lambda x, r: [(r, len(x), int(whole(x).sum()), int(np.abs(whole(x)).max(initial=0)))])


@query(f"""WITH {_OF_PAGES},
  a AS (SELECT page_id, 's1' AS voice, greatest(v, 0) AS v FROM s UNION ALL SELECT page_id, 's2', least(v, 0) FROM s)
  SELECT page_id || '_' || voice AS stem, 1000 AS rate, 44 + 2 * count(*) AS n_bytes, count(*) AS n_samples, sum(v)::BIGINT AS total, max(abs(v)) AS loudest FROM a GROUP BY page_id, voice
  UNION ALL SELECT page_id || '_' || unnest(['s1', 's2']), 1000, 44, 0, 0, 0 FROM pages WHERE coalesce(length(html), 0) = 0""")
def voice_files(spark, sf_dir):
    """Two voices of each recorded page, written as files, found again by a scan of their folders and decoded.

    Tasks list the folders and open the files that they decode: the driver
    holds no list of files, and only paths are moved.
    """
    pages = heard(spark, sf_dir, False, "pages", "page_id", "html")
    folder = new_folder(spark, "voices")
    files.write_files(files.in_folders(files.enhanced_files(signal.separated_files(pages, above_and_below, RATE))), folder)
    found = audio.named(files.listed(spark, folder), ("WAV",))
    opened = audio.Made(spread(found.select("stem", F.col("path").alias("of")), "of"), partial(files.content_of, root=folder))
    lengths = found.select("stem", F.col("length").alias("n_bytes"))
    return _heard(opened).join(sorted_sides(lengths), "stem").select("stem", "rate", "n_bytes", "n_samples", "total", "loudest")


@query("""WITH g AS (SELECT doc_id, text, unnest(range(0, (length(text) + 999) // 1000)) AS k FROM documents),
  t AS (SELECT doc_id, doc_id || '_' || lpad(k::VARCHAR, 4, '0') AS stem, substr(text, k * 1000 + 1, 1000) AS t FROM g),
  f AS (SELECT *, length(t) >= 200 AS kept FROM t)
  SELECT doc_id || CASE WHEN kept THEN '/audios/' ELSE '/discarded_audios/' END || stem || '.wav' AS path, 44 + 2 * length(t) AS n_bytes, NULL AS text_sha256 FROM f
  UNION ALL SELECT doc_id || CASE WHEN kept THEN '/transcripts/' ELSE '/discarded_audios/' END || stem || '.txt', strlen(t), sha256(t) FROM f
  UNION ALL SELECT doc_id || '/discarded_audios/' || stem || '.json', 22, sha256('{"status":"too_short"}') FROM f WHERE NOT kept""")
def segment_layout(spark, sf_dir):
    """Every document in pieces of a second: sound and transcript of those that are kept, and sound, transcript and a note of those that are too short."""
    docs = table(spark, sf_dir, "documents").where(F.length("text") > 0)
    pieces = docs.select(F.col("doc_id").cast("string").alias("stem"), "text", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.length("text") - 1) / 1000))).alias("segment_index"))
    text = F.substring("text", F.col("segment_index") * 1000 + 1, F.lit(1000))
    pieces = pieces.select("stem", "segment_index", text.alias("transcript")).withColumn("status", F.when(F.length("transcript") >= 200, "kept").otherwise("too_short"))
    start = F.col("segment_index").cast("double")
    spans = pieces.select("stem", "segment_index", "status", start.alias("cut_start_sec"), (start + F.length("transcript") / RATE).alias("cut_end_sec"))
    sounds = signal.cut_segments(heard(spark, sf_dir), spans).select("stem", "segment_index", "wav")
    rows = pieces.join(sorted_sides(sounds), ["stem", "segment_index"]).withColumnRenamed("stem", "source_id").withColumn("meta", F.to_json(F.struct("status")))
    sha = F.when(~F.endswith("path", F.lit(".wav")), F.sha2("content", 256))
    return files.segment_files(rows).select("path", F.length("content").alias("n_bytes"), sha.alias("text_sha256"))


# -- manifests -----------------------------------------------------------


@query("""SELECT 'audios/' || doc_id || '.wav' AS audio, row_number() OVER (ORDER BY doc_id) AS jsonl_row, round(n_chars / 1000.0, 3) AS duration, sha256(text) AS text_sha256 FROM documents""")
def manifest_lines(spark, sf_dir):
    """A manifest of all documents, written as JSON lines in their order and read back strictly; line numbers go on from file to file."""
    path = new_folder(spark, "manifest")
    audio_path = F.concat(F.lit("audios/"), F.col("doc_id").cast("string"), F.lit(".wav"))
    rows = table(spark, sf_dir, "documents").select("doc_id", audio_path.alias("audio"), "text", (F.col("n_chars") / 1000).alias("duration"))
    manifests.write_jsonl(rows, path, ["audio", "text", "duration"], ["doc_id"])
    read = manifests.scan_strict(spark, path).select("path", "line", "audio", "duration", F.sha2("text", 256).alias("text_sha256"))
    return with_rank(read, [F.col("path"), F.col("line")], "jsonl_row").select("audio", "jsonl_row", "duration", "text_sha256")


@query("""SELECT 'audios/' || c_custkey || '.wav' AS audio_relpath, printf('%.3f', abs(c_acctbal) / 7) AS duration_sec, c_nationkey AS sample_rate, c_name || ' ' || c_mktsegment AS source_path FROM customer""")
def manifest_table(spark, sf_dir):
    """A tab-separated manifest, written with a header in the order of its keys and read back."""
    path = new_folder(spark, "manifest")
    name = F.concat(F.lit("audios/"), F.col("c_custkey").cast("string"), F.lit(".wav")).alias("audio_relpath")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", name, (F.abs("c_acctbal") / 7).alias("duration_sec"), F.col("c_nationkey").alias("sample_rate"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("source_path")
    )
    manifests.write_tsv(rows, path, ["audio_relpath", "duration_sec", "sample_rate", "source_path"], ["c_custkey"])
    return manifests.read_tsv(spark, path, "audio_relpath string, duration_sec string, sample_rate int, source_path string")


@query("""WITH d AS (SELECT doc_id, length(text) AS n, (length(text) + 999) // 1000 AS c FROM documents WHERE length(text) > 0),
  k AS (SELECT doc_id, n, c, unnest(range(c)) AS k FROM d)
  SELECT doc_id || '.wav' AS source_path, doc_id || CASE WHEN c = 1 THEN '' ELSE '_part' || lpad((k + 1)::VARCHAR, 3, '0') END || '.wav' AS output_path, k AS part_index, c AS part_count, printf('%.3f', k::DOUBLE) AS start_sec,
    printf('%.3f', least(k + 1, n / 1000)) AS end_sec, printf('%.3f', least(k + 1, n / 1000) - k) AS duration_sec, CASE WHEN k = c - 1 THEN 'final' ELSE 'fixed' END AS cut_method, '0.000' AS silence_sec FROM k""")
def part_mapping(spark, sf_dir):
    """Every document in parts of a second: the mapping of their files, written as CSV and read back."""
    docs = table(spark, sf_dir, "documents").where(F.length("text") > 0)
    n = F.length("text")
    count = F.ceil(n / 1000)
    k = F.col("part_index")
    each = docs.select(F.col("doc_id").cast("string").alias("stem"), n.alias("n"), count.alias("part_count"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("part_index"))
    last = k == F.col("part_count") - 1
    parts = each.withColumns({"start_sec": k.cast("double"), "end_sec": F.least((k + 1).cast("double"), F.col("n") / 1000), "cut_method": F.when(~last, F.lit("fixed")), "silence_sec": F.lit(0.0)})
    path = new_folder(spark, "mapping")
    reports.write_mapping(reports.part_mapping(parts.withColumns({"source_path": F.concat("stem", F.lit(".wav")), "output_path": files.part_name()})), path)
    text = "source_path string, output_path string, part_index long, part_count long, start_sec string, end_sec string, duration_sec string, cut_method string, silence_sec string"
    return spark.read.option("header", True).schema(text).csv(path)
