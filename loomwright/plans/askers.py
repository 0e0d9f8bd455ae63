"""Queries that ask a model in rounds: labels of pauses, cuts of groups and windows, revised punctuation.

Words of conversations stand in for tokens of 0.3 s, turns for texts. The
askers follow fixed rules: some answer at once, some after they were told
what was wrong, some never.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.operators import pauses, planners, rounds, transcripts
from loomwright.plans.catalogue import query, table


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each conversation in order, with boundaries at their marks and pauses that follow from their places."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\s+")).alias("k", "word")).where("word <> ''")
    words = turns.select(F.col("conv_id").alias("source_id"), (F.col("turn") * 100_000 + F.col("k")).alias("idx"), "word")
    by = pauses.Window.partitionBy("source_id")
    n = F.row_number().over(by.orderBy("idx")) - 1
    placed = words.withColumn("n", n).withColumn("last", F.max("idx").over(by))
    kind = F.when(F.col("idx") == F.col("last"), "final").otherwise(T.boundary_kind(F.regexp_extract("word", r"(\p{P}+)$", 1)))
    pause = ((F.col("n") * 7919 + F.col("source_id") * 104_729) % 600).cast("double")
    return placed.select("source_id", "idx", (F.col("n") * 0.3).alias("start_sec"), (F.col("n") * 0.3 + 0.25).alias("end_sec"), kind.alias("kind"), pause.alias("pause_ms"))


def rows_in_sentences(spark: SparkSession, sf_dir: str, size: int = 5) -> DataFrame:
    """Boundary rows with the number of their sentence and of its group."""
    found = planners.boundary_rows(conversation_tokens(spark, sf_dir))
    rows = transcripts.sentences(found.withColumn("idx", F.col("row"))).drop("idx")
    return rows.withColumn("group_id", F.floor(F.col("sentence") / size).cast("long"))


def labeller():
    """Labels by the number's remainder of three; every fourth group forgets one at first, another fourth always does."""

    def answer(rows: list[tuple]) -> list:
        out = []
        for wanted, said in rows:
            turn = int(sum(wanted)) % 4
            given = list(wanted)[:-1] if turn == 3 or (turn == 1 and not said) else list(wanted)
            out.append([(int(i), ("good", "ok", "bad")[int(i) % 3]) for i in given])
        return out

    return answer


def cutter(every: int):
    """Cuts at each so many markers and at the last; refused lists are mended, or not where the first marker's remainder of five is four."""

    def make():
        def answer(rows: list[tuple]) -> list:
            out = []
            for markers, said in rows:
                m = [int(x) for x in markers]
                cuts = sorted({*m[every - 1 :: every], m[-1]})
                if m[0] % 5 == 4 or (m[0] % 5 == 3 and not said):
                    cuts = cuts[::-1] if len(cuts) > 1 else [m[-1] + 1]
                out.append(cuts)
            return out

        return answer

    return make


def reviser():
    """Ends each text with a full stop; of every three lengths one is first changed in its words, another always."""

    def answer(rows: list[tuple]) -> list:
        return [t + "." if len(t) % 3 == 0 or (len(t) % 3 == 1 and said) else "x" + t for t, said in rows]

    return answer


@query(r"""WITH m AS (SELECT conv_id AS source_id, turn AS sentence, conv_id * 100 + turn AS token FROM conversations),
  g AS (SELECT *, (dense_rank() OVER (PARTITION BY source_id ORDER BY sentence) - 1) // 5 AS group_id FROM m),
  s AS (SELECT *, sum(token) OVER (PARTITION BY source_id, group_id) % 4 = 3 AS never FROM g)
  SELECT source_id, sentence, token, CASE WHEN never OR token % 3 = 1 THEN 'ok' WHEN token % 3 = 0 THEN 'good' ELSE 'bad' END AS label FROM s""")
def label_rounds(spark, sf_dir):
    marks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), F.col("turn").alias("sentence"), (F.col("conv_id") * 100 + F.col("turn")).alias("token"))
    return rounds.labelled_pauses(marks, "labels-by-three", labeller)


@query()
def slice_rounds(spark, sf_dir):
    return rounds.slices_by_asker(rows_in_sentences(spark, sf_dir), "group_id", "cuts-by-four", cutter(4), 5.0, 30.0)


@query()
def window_rounds(spark, sf_dir):
    rows = rows_in_sentences(spark, sf_dir)
    return rounds.windows_by_asker(rows, "cuts-by-nine", cutter(9), 5.0, 30.0, attempts=2, least_sec=60.0, sentences=12)


@query("""SELECT conv_id, turn, md5(CASE WHEN length(text) % 3 = 2 THEN text ELSE text || '.' END) AS revised,
    CASE WHEN length(text) % 3 = 2 THEN 'unanswered' ELSE 'accepted' END AS how, CASE length(text) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS attempt FROM conversations""")
def revision_rounds(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    found = rounds.revised_windows(turns, "full-stops", reviser)
    return found.select("conv_id", "turn", F.md5(F.encode("revised", "UTF-8")).alias("revised"), "how", "attempt")


@query("""WITH s AS (SELECT conv_id AS source_id, turn AS sentence, turn * 10 AS first_token, turn * 10 + 9 AS last_token FROM conversations),
  w AS (SELECT source_id, CASE WHEN (source_id + sentence) % 3 = 0 THEN last_token ELSE last_token - 3 END AS left_idx, CASE WHEN (source_id + sentence) % 3 = 0 THEN last_token + 1 ELSE last_token - 2 END AS right_idx
        FROM s WHERE (source_id * 7 + sentence * 5) % 4 = 0),
  e AS (SELECT s.source_id, sentence, bool_or(right_idx = first_token) AS opens, bool_or(left_idx = last_token) AS closes,
          bool_or(left_idx BETWEEN first_token AND last_token OR right_idx BETWEEN first_token AND last_token) AS warned FROM s LEFT JOIN w USING (source_id) GROUP BY ALL),
  f AS (SELECT *, coalesce(max(CASE WHEN NOT coalesce(opens, false) THEN sentence END) OVER (PARTITION BY source_id ORDER BY sentence), min(sentence) OVER (PARTITION BY source_id)) AS a,
          coalesce(min(CASE WHEN NOT coalesce(closes, false) THEN sentence END) OVER (PARTITION BY source_id ORDER BY sentence DESC), max(sentence) OVER (PARTITION BY source_id)) AS z FROM e),
  n AS (SELECT source_id, a, z, CASE WHEN a > 1 + max(z) OVER (PARTITION BY source_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM f WHERE warned),
  k AS (SELECT *, sum(new) OVER (PARTITION BY source_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS g FROM n)
  SELECT source_id, min(a) AS first_sentence, max(z) AS last_sentence FROM k GROUP BY source_id, g""")
def warning_windows(spark, sf_dir):
    turn = F.col("turn")
    spans = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), turn.alias("sentence"), (turn * 10).alias("first_token"), (turn * 10 + 9).alias("last_token"))
    edge = (F.col("source_id") + F.col("sentence")) % 3 == 0
    left = F.when(edge, F.col("last_token")).otherwise(F.col("last_token") - 3)
    warned = spans.where((F.col("source_id") * 7 + F.col("sentence") * 5) % 4 == 0)
    return rounds.warning_windows(spans, warned.select("source_id", left.alias("left_idx"), (left + 1).alias("right_idx")))
