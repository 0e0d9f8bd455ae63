"""More queries of the catalogue: transcripts and their tokens, names and paths, levels, reports.

Conversation turns stand in for transcripts, their words for tokens (each
fourth one is missing, so that token and text places differ).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import levels
from loomwright.functions import text as T
from loomwright.operators import manifests, pauses, reports, transcripts, volume
from loomwright.plans.catalogue import _GAPS, gaps, query, rounded, seconds, table
from loomwright.sources import audio

# -- transcripts ---------------------------------------------------------

# RE2 has no intersection of classes: a silent character is white space, punctuation that is no spoken bracket, or a symbol;
# < and > are symbols, so they are tested before.
_SILENT = r"([\s\x1c-\x1f]|[^\PP<>()《》（）]|[^\PS<>])"

_TURNS = rf"""
t AS (SELECT conv_id * 1000 + turn AS source_id, text FROM conversations),
w0 AS (SELECT source_id, regexp_split_to_array(text, '\s+') AS w FROM t),
w1 AS (SELECT source_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS idx FROM w0),
tok AS (SELECT source_id, idx, regexp_replace(word, '\pP+$', '') AS "char" FROM w1 WHERE idx % 4 <> 3),
tc AS (SELECT source_id, unnest(string_split(text, '')) AS c, unnest(range(0, length(text))) AS pos FROM t),
tn AS (SELECT source_id, pos, row_number() OVER (PARTITION BY source_id ORDER BY pos) AS n FROM tc WHERE NOT regexp_full_match(c, '{_SILENT}')),
kc AS (SELECT source_id, idx, unnest(string_split("char", '')) AS c, unnest(range(0, length("char"))) AS k FROM tok WHERE "char" <> ''),
kn AS (SELECT source_id, idx, row_number() OVER (PARTITION BY source_id ORDER BY idx, k) AS n FROM kc WHERE NOT regexp_full_match(c, '{_SILENT}')),
al AS (SELECT source_id, idx, min(pos) AS a, max(pos) AS z, count(*) AS n_chars FROM kn JOIN tn USING (source_id, n) GROUP BY source_id, idx),
"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_id"), "text")


def words(texts: DataFrame) -> DataFrame:
    """Three of four words of each text as tokens, without the marks that end them."""
    found = texts.select("source_id", F.posexplode(F.split("text", r"\s+")).alias("idx", "word")).where("idx % 4 <> 3")
    return found.select("source_id", "idx", F.regexp_replace("word", r"\p{P}+$", "").alias("char"))


@query("WITH" + _TURNS + "x AS (SELECT 1) SELECT source_id, idx, a, z, n_chars FROM al")
def token_alignment(spark, sf_dir):
    texts = turns(spark, sf_dir)
    at = F.col("positions")
    found = transcripts.align(texts, words(texts))
    return found.select("source_id", F.col("idx").cast("long"), F.array_min(at).cast("long").alias("a"), F.array_max(at).cast("long").alias("z"), F.size(at).cast("long").alias("n_chars"))


@query("WITH" + _TURNS + rf"""r0 AS (SELECT source_id, idx, regexp_extract(substr(text, z + 2), '^{_SILENT}+') AS run, max(idx) OVER (PARTITION BY source_id) AS last FROM al JOIN t USING (source_id)),
  r AS (SELECT source_id, idx, last, CASE WHEN regexp_full_match(run, '\s*') THEN '' ELSE run END AS run FROM r0),
  m AS (SELECT *, regexp_extract(run, '[。？！.?!，；、,;:]') AS first FROM r)
  SELECT source_id, idx, md5(run) AS run, CASE WHEN first = '' THEN 'no_punc' WHEN first IN ('。','？','！','.','?','!') THEN 'strong' ELSE 'weak' END AS category,
    CASE WHEN idx = last THEN 'final' WHEN run = '' THEN NULL WHEN regexp_matches(run, '[。？！.?!]') THEN 'strong' ELSE 'weak' END AS kind FROM m""")
def token_boundaries(spark, sf_dir):
    texts = turns(spark, sf_dir)
    found = transcripts.boundaries(texts, transcripts.align(texts, words(texts)))
    return found.select("source_id", F.col("idx").cast("long"), F.md5(F.encode("run", "UTF-8")).alias("run"), "category", "kind")


@query("WITH" + _TURNS + rf"""g AS (SELECT source_id, idx // 10 * 10 AS first_token, max(idx) AS last_token, trim(string_agg("char", '' ORDER BY idx)) AS said FROM tok GROUP BY ALL),
  s AS (SELECT g.source_id, first_token, last_token, any_value(said) AS said, min(a) AS a, max(z) AS z FROM g LEFT JOIN al ON al.source_id = g.source_id AND idx BETWEEN first_token AND last_token GROUP BY ALL)
  SELECT source_id, first_token, last_token, md5(CASE WHEN a IS NULL THEN said
    ELSE trim(regexp_replace(substr(text, a + 1, z - a + 1) || regexp_extract(substr(text, z + 2), '^{_SILENT}*'), '\r\n|\n', ' ', 'g')) END) AS transcript FROM s JOIN t USING (source_id)""")
def segment_transcripts(spark, sf_dir):
    texts = turns(spark, sf_dir)
    tokens = words(texts)
    segments = tokens.groupBy("source_id", (F.floor(F.col("idx") / 10) * 10).alias("first_token")).agg(F.max("idx").cast("long").alias("last_token"))
    found = transcripts.segment_texts(segments, texts, transcripts.align(texts, tokens), tokens)
    return found.select("source_id", "first_token", "last_token", F.md5(F.encode("transcript", "UTF-8")).alias("transcript"))


@query("""SELECT conv_id AS source_id, md5(coalesce(string_agg(trim(text), ' ' ORDER BY turn, trim(text)) FILTER (turn % 5 <> 3 AND trim(text) <> ''), '')) AS text FROM conversations GROUP BY conv_id""")
def stitched_texts(spark, sf_dir):
    text = F.when(F.col("turn") % 5 == 3, "").otherwise(F.col("text"))
    chunks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), F.col("turn").alias("chunk"), (F.col("turn") * 100.0).alias("start_sec"), text.alias("text"))
    none = spark.createDataFrame([], "source_id long, chunk long, idx long, char string, start_sec double, end_sec double")
    return transcripts.stitch(chunks, none)[0].select("source_id", F.md5(F.encode("text", "UTF-8")).alias("text"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000000 AS t FROM events)
  SELECT user_id AS source_id, row_number() OVER (PARTITION BY user_id ORDER BY t // 86400, event_id) - 1 AS idx, event_type AS "char", t AS start_sec FROM e""")
def stitched_tokens(spark, sf_dir):
    e = seconds(spark, sf_dir).withColumn("chunk", F.floor(F.col("t") / 86_400).cast("long"))
    tokens = e.select(F.col("user_id").alias("source_id"), "chunk", F.col("event_id").alias("idx"), F.col("event_type").alias("char"), (F.col("t") - F.col("chunk") * 86_400).alias("start_sec"), (F.col("t") - F.col("chunk") * 86_400 + 1).alias("end_sec"))
    chunks = tokens.select("source_id", "chunk").distinct().withColumn("start_sec", F.col("chunk") * 86_400).withColumn("text", F.lit(""))
    found = transcripts.stitch(chunks, tokens)[1]
    return found.select("source_id", F.col("idx").cast("long"), "char", "start_sec")


@query("""WITH e AS (SELECT event_id, user_id, (epoch_us(ts) // 1000000)::DOUBLE AS s, (epoch_us(ts) // 1000000)::DOUBLE + value AS f FROM events),
  b AS (SELECT *, lag(f) OVER w AS before, lead(s) OVER w AS after FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id))
  SELECT event_id, round(coalesce(greatest((before + s) / 2, CASE WHEN before IS NOT NULL THEN s - 60 END), s), 4) AS opens_sec,
    round(coalesce(least((f + after) / 2, CASE WHEN after IS NOT NULL THEN f + 60 END), f), 4) AS closes_sec FROM b""")
def token_bounds(spark, sf_dir):
    e = seconds(spark, sf_dir)
    start = F.col("t").cast("double")
    tokens = e.select(F.col("user_id").alias("source_id"), F.struct("t", "event_id").alias("idx"), "event_id", start.alias("start_sec"), (start + F.col("value")).alias("end_sec"))
    return transcripts.padded_bounds(tokens, 60.0).select("event_id", *rounded("opens_sec", "closes_sec"))


_SENTENCES = """
e AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS t FROM events),
n AS (SELECT user_id AS source_id, event_id, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS sentence FROM e)
"""


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "strong").when(F.col("event_type") == "click", "weak")
    return transcripts.sentences(seconds(spark, sf_dir).select(F.col("user_id").alias("source_id"), F.struct("t", "event_id").alias("idx"), "event_id", kind.alias("kind")))


@query("WITH" + _SENTENCES + "SELECT source_id, event_id, sentence FROM n")
def sentence_numbers(spark, sf_dir):
    return _numbered(spark, sf_dir).select("source_id", "event_id", "sentence")


@query("WITH" + _SENTENCES + """, s AS (SELECT DISTINCT source_id, sentence, max(sentence // 5) OVER (PARTITION BY source_id) AS most FROM n),
  g AS (SELECT DISTINCT source_id, sentence, most, near // 5 AS group_id FROM (SELECT *, unnest(generate_series(greatest(0, sentence - 1), sentence + 1)) AS near FROM s))
  SELECT source_id, sentence, group_id, group_id = sentence // 5 AS core FROM g WHERE group_id <= most""")
def grouped_sentences(spark, sf_dir):
    return transcripts.sentence_groups(_numbered(spark, sf_dir))


@query("""WITH o AS (SELECT o_custkey AS source_id, o_orderkey // 50 AS "first", o_orderkey // 50 + o_orderkey % 40 AS "last" FROM orders),
  r AS (SELECT *, max("last") OVER (PARTITION BY source_id ORDER BY "first", "last" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
  g AS (SELECT *, sum(CASE WHEN reach IS NULL OR "first" > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY "first", "last" ROWS UNBOUNDED PRECEDING) AS g FROM r)
  SELECT source_id, min("first") AS "first", max("last") AS "last" FROM g GROUP BY source_id, g""")
def merged_index_ranges(spark, sf_dir):
    first = F.floor(F.col("o_orderkey") / 50).cast("long")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), first.alias("first"), (first + F.col("o_orderkey") % 40).alias("last"))
    return transcripts.merged_ranges(o)


@query("""WITH x AS (SELECT conv_id, turn, text AS a, CASE turn % 3 WHEN 0 THEN left(text, length(text) // 2) WHEN 1 THEN left(text, length(text) // 2) || '#' || substr(text, length(text) // 2 + 2) ELSE text END AS b FROM conversations)
  SELECT conv_id, turn, CASE WHEN a <> b THEN list_position(list_transform(generate_series(1, greatest(length(a), length(b))), lambda i: substr(a, i, 1) = substr(b, i, 1)), false) - 1 END::INTEGER AS place FROM x""")
def text_mismatch(spark, sf_dir):
    text, half = F.col("text"), F.floor(F.length("text") / 2).cast("int")
    start = F.left(text, half)
    edited = F.when(F.col("turn") % 3 == 0, start).when(F.col("turn") % 3 == 1, F.concat(start, F.lit("#"), F.substring(text, half + 2, F.length(text)))).otherwise(text)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.first_mismatch(text, edited).alias("place"))


@query(rf"""WITH x AS (SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN regexp_replace(text, '[,.]', ';', 'g') ELSE text || 'x' END AS revised FROM conversations)
  SELECT conv_id, turn, md5(CASE WHEN regexp_replace(text, '{_SILENT}', '', 'g') = regexp_replace(revised, '{_SILENT}', '', 'g') THEN revised ELSE text END) AS accepted FROM x""")
def guarded_revisions(spark, sf_dir):
    revised = F.when(F.col("turn") % 2 == 0, F.regexp_replace("text", "[,.]", ";")).otherwise(F.concat("text", F.lit("x")))
    accepted = transcripts.accepted_revision(F.col("text"), revised)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.encode(accepted, "UTF-8")).alias("accepted"))


# -- names, paths, arguments ---------------------------------------------


@query(r"""WITH x AS (SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS stem,
    replace(CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '//[^/]*(/.*)$', 1) WHEN 1 THEN 'a\..\b' || page_id WHEN 2 THEN 'C:\' || page_id ELSE 'a/' || page_id || '..b' END, '\', '/') AS p,
    lower(regexp_extract(url, '([a-z]*)$', 1)) AS tail FROM pages)
  SELECT page_id, CASE WHEN stem = '' THEN 'audio' ELSE stem END AS stem, p AS path, starts_with(p, '/') OR regexp_matches(p, '(^|/)\.\.(/|$)') OR regexp_matches(p, '^[A-Za-z]:/') AS unsafe, '.' || tail AS extension FROM x""")
def page_names(spark, sf_dir):
    number, kind = F.col("page_id").cast("string"), F.col("page_id") % 4
    path = F.when(kind == 0, F.regexp_extract("url", "//[^/]*(/.*)$", 1)).when(kind == 1, F.concat(F.lit("a\\..\\b"), number)).when(kind == 2, F.concat(F.lit("C:\\"), number)).otherwise(F.concat(F.lit("a/"), number, F.lit("..b")))
    ext = T.extension(F.regexp_extract("url", "([a-z]*)$", 1))
    return table(spark, sf_dir, "pages").select("page_id", T.safe_stem(F.col("url")).alias("stem"), T.manifest_path(path).alias("path"), T.unsafe_path(path).alias("unsafe"), ext.alias("extension"))


@query("""SELECT page_id, CASE WHEN n > 1 THEN host || '__dup' || n ELSE host END AS unique_name FROM
  (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM (SELECT page_id, regexp_extract(url, '//([^/]*)', 1) AS host FROM pages))""")
def unique_hosts(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "//([^/]*)", 1).alias("host"))
    return manifests.unique_names(hosts, "host", ["page_id"]).select("page_id", "unique_name")


_FILES = r"f AS (SELECT DISTINCT url AS path, regexp_extract(url, '([^/?]+)(\?.*)?$', 1) AS stem FROM pages)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.regexp_extract("url", r"([^/?]+)(\?.*)?$", 1).alias("stem")).distinct()


@query(f"WITH {_FILES} SELECT stem, count(*) AS n, array_to_string(list_sort(list(path)), ' ') AS paths FROM f GROUP BY stem HAVING count(*) > 1")
def duplicate_stems(spark, sf_dir):
    return audio.duplicate_stems(_files(spark, sf_dir)).select("stem", "n", F.concat_ws(" ", "paths").alias("paths"))


@query(f"WITH {_FILES} SELECT lpad(row_number() OVER (ORDER BY path)::VARCHAR, 6, '0') || '.wav' AS numbered_file, path AS source_file FROM f")
def numbered_files(spark, sf_dir):
    return audio.numbered(_files(spark, sf_dir))


@query("""SELECT event_id, CASE WHEN event_id % 7 < 5 THEN json_extract_string(props, '$.k') END AS k, CASE WHEN event_id % 7 < 5 THEN len(json_keys(props)) ELSE 0 END::INTEGER AS n FROM events""")
def json_arguments(spark, sf_dir):
    raw = F.when(F.col("event_id") % 7 == 5, F.concat(F.lit("["), "props", F.lit("]"))).when(F.col("event_id") % 7 == 6, F.left("props", F.length("props") - 1)).otherwise(F.concat(F.lit(" "), "props"))
    found = T.json_arguments(raw)
    return table(spark, sf_dir, "events").select("event_id", found["k"].alias("k"), F.size(found).alias("n"))


# -- levels and reports --------------------------------------------------


@query("""WITH x AS (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)) AS rms, list_max(list_transform(embedding, lambda x: abs(x)))::DOUBLE AS peak FROM embeddings)
  SELECT vec_id, round(rms, 4) AS rms, round(peak, 4) AS peak, round(20 * log10(greatest(rms, 1e-12)), 4) AS level, round(pow(10.0::DOUBLE, -3 * peak / 20), 4) AS gain FROM x""")
def vector_levels(spark, sf_dir):
    x = table(spark, sf_dir, "embeddings").select("vec_id", levels.rms(F.col("embedding")).alias("rms"), levels.peak(F.col("embedding")).cast("double").alias("peak"))
    return x.select("vec_id", *rounded("rms", "peak"), F.round(levels.dbfs(F.col("rms")), 4).alias("level"), F.round(levels.gain(-3 * F.col("peak")), 4).alias("gain"))


@query("""WITH x AS (SELECT -l_extendedprice / 3000 AS level, l_quantity AS w, l_discount * 10 - 20 AS safe FROM lineitem),
  s AS (SELECT level, sum(w) AS w FROM x WHERE w > 0 GROUP BY level), c AS (SELECT level, sum(w) OVER (ORDER BY level) AS upto, sum(w) OVER () AS total FROM s)
  SELECT round(least((SELECT min(level) FROM c WHERE upto >= total / 2), (SELECT min(safe) FROM x), -1.0), 4) AS target""")
def corpus_target(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select((-F.col("l_extendedprice") / 3000).alias("level"), F.col("l_quantity").alias("w"), (F.col("l_discount") * 10 - 20).alias("safe"))
    return volume.target_level(x, "level", "w", "safe").select(*rounded("target"))


@query("""SELECT l_orderkey, l_quantity, l_linestatus FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linestatus DESC) AS n FROM lineitem) WHERE n = 1""")
def worst_edges(spark, sf_dir):
    return manifests.worst_of_each(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linestatus", "l_quantity").select("l_orderkey", "l_quantity", "l_linestatus")


@query("WITH" + _GAPS + """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS segment_index,
    CASE WHEN category = 'strong' THEN 'dropped_llm' WHEN pause_ms < 5 - 1e-6 OR pause_ms > 600 + 1e-6 THEN 'dropped_length' ELSE 'kept' END AS status FROM g""")
def segment_status(spark, sf_dir):
    found = manifests.final_filter(gaps(spark, sf_dir), "user_id", "event_id", F.col("pause_ms"), F.col("category") == "strong", 5.0, 600.0)
    return found.select("user_id", "event_id", F.col("segment_index").cast("long"), "status")


@query("""SELECT l_returnflag, count(*) AS segments, round(avg(l_quantity), 4) AS mean_sec, round(median(l_quantity), 4) AS median_sec, min(l_quantity) AS least_sec, max(l_quantity) AS most_sec,
    round(100.0 * count(*) FILTER (l_discount > 0.05) / count(*), 4) AS hit_percent, round(median(l_tax * 1000), 4) AS silence_median_ms, round(quantile_cont(l_tax * 1000, 0.9), 4) AS silence_p90_ms,
    count(*) FILTER (l_linestatus = 'F') AS fallbacks FROM lineitem GROUP BY l_returnflag""")
def cut_summary(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").withColumn("silence", F.col("l_tax") * 1000)
    found = reports.cut_summary(x, ["l_returnflag"], "l_quantity", F.col("l_discount") > 0.05, "silence", F.col("l_linestatus") == "F")
    return found.select("l_returnflag", "segments", *rounded("mean_sec", "median_sec"), "least_sec", "most_sec", *rounded("hit_percent", "silence_median_ms", "silence_p90_ms"), "fallbacks")


@query("WITH" + _GAPS + "SELECT user_id, category, n AS count, round(q[2])::BIGINT AS p20_ms, round(q[4])::BIGINT AS p50_ms, round(q[6])::BIGINT AS p80_ms FROM s")
def compact_pauses(spark, sf_dir):
    return reports.compact_pauses(pauses.pause_quantiles(gaps(spark, sf_dir), "user_id"), ["user_id", "category"], "n", ["p20", "p50", "p80"])
