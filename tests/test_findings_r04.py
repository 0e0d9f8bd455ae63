"""Small tests for the findings of round 4; each failed before its change."""

import random

import pytest
from pyspark.sql import functions as F

from loomwright.operators import pauses, planners
from loomwright.plans import catalogue, recordings
from loomwright.sources import audio, files
from tests import plain_planners as P
from tests.test_findings_r03 import plan, words_are_made_once
from tests.test_planners import rows_of

TEXTS = ["", None, "  ", " One, two. three\n\nfour", "bare words alone", "end. ", ". , ;", " x", "a) b.) c,\" d\" e…f 中文。 Ä é! z  q. ", *("A b, c d. " * k + " e\tf; g!" for k in range(1, 60, 7))]


def test_f1_words_are_made_once_and_windows_found_without_joins(spark, sf, monkeypatch):
    given = []
    real = planners.written
    monkeypatch.setattr(planners, "written", lambda df: given.append(df) or real(df))
    catalogue.QUERIES["plan_legacy"](spark, sf)
    assert len(given) == 1 and words_are_made_once(given[0])


def test_f1_boundaries_are_judged_as_among_all_words(spark, tmp_path):
    rows = [*enumerate(TEXTS), (900, "a b. c,"), (900, " d, e f; g h! i"), (-7, "k l. m n, o p")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["source_id", "idx", "kind", "pause_ms", "quality", "policy", *(f"{c}.{p}" for c in ("strong", "weak", "no_punc") for p in pauses.NAMES)]
    want, got = (sorted(map(str, f(spark, str(tmp_path)).where("kind is not null").select(columns).collect())) for f in (catalogue.tokens, catalogue.boundary_tokens))
    assert got == want and len(got) > 200


def test_f1_quantiles_of_arrays_are_those_of_percentile(spark):
    pick = random.Random(3)
    rows = [(k, float(pick.randrange(600))) for k in range(40) for _ in range(pick.randrange(1, 90))]
    df = spark.createDataFrame(rows, "k int, v double")
    got = df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, pauses.POINTS))).alias("q"), F.sort_array(F.collect_list("v")).alias("v")).select(F.size("v").alias("n"), "q", pauses.quantiles_of(F.col("v")).alias("got"))
    for n, q, found in got.collect():
        assert list(found) == (q if n >= pauses.FEWEST else list(pauses.FALLBACK))


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_f1_windows_hold_across_batches(spark, batch):
    pick, rows = random.Random(batch), []
    for name in range(8):
        at = 0.0
        for k in range(pick.choice([1, 40, 200])):
            kind = pick.choice([None, None, "weak", "strong", "final"] if name % 2 else [None, "weak", "weak", "strong"])
            rows.append((name, k, at, at + 0.3, kind, float(pick.choice([0, 150, 450, 700])) if kind else None, pick.choice(["perfect", "ok", "bad"]), pick.choice(["normal", "must_cut", "no_cut"])))
            at += 0.3 + pick.uniform(0.1, 1.5) + 40 * (pick.random() < 0.01)
    tokens = spark.createDataFrame(rows, "source_id int, idx int, start_sec double, end_sec double, kind string, pause_ms double, quality string, policy string")
    q = F.struct(*(F.lit(200.0).alias(p) for p in pauses.NAMES))
    want = rows_of(P.plan_segments(tokens.withColumn("label", F.lit("ok")).withColumn("strong", q).withColumn("weak", q), "legacy_dp", 5.0, 15.0))
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = planners.plan_segments(tokens, "legacy_dp", 5.0, 15.0)
        assert rows_of(found) == want and {r[-1] for r in want} >= {"None", "unable to choose planning anchor"}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_f2_the_driver_lists_no_files(spark, sf, monkeypatch):
    written = []
    real = recordings.files.write_files
    monkeypatch.setattr(recordings.files, "write_files", lambda rows, folder: written.append(folder) or real(rows, folder))
    found = recordings.voice_files(spark, sf)
    p = plan(found)
    assert "binaryFile" not in p and "content" not in p and "Broadcast" not in p
    assert not any(f.startswith(written[0]) for f in found.inputFiles())
    names = [r.path for r in files.listed(spark, written[0]).collect()]
    assert len(names) == found.count() > 0 and all(len(x.split("/")) == 2 for x in names)


def test_f2_listed_files_are_those_on_disk(spark, tmp_path):
    want = {}
    for name in ("a.wav", "b c/ä %20#.WAV", "b c/d/e/f.txt", "b c/d/e/.g.wav", "_SUCCESS", "_temporary-x/h.wav", "i.tar.wav"):
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(name.encode() * 3)
        if not any(part[0] in "_." for part in name.split("/")):
            want[name] = name.encode() * 3
    (tmp_path / "empty").mkdir()
    for root in (str(tmp_path), tmp_path.as_uri()):
        found = files.listed(spark, root)
        assert {r.path: r.length for r in found.collect()} == {k: len(v) for k, v in want.items()}
        assert all(files.content_of(k, root) == v for k, v in want.items())
    assert {r.stem for r in audio.named(found, ("wav",)).collect()} == {"a", "ä %20#", "i.tar"}
    assert files.listed(spark, str(tmp_path / "empty")).count() == 0


def test_f2_files_are_dealt_over_folders(spark):
    dealt = files.in_folders(spark.range(3000).select((F.col("id") % 2900).cast("string").alias("path"))).groupBy("path").count().collect()
    folders = {r.path.split("/")[0] for r in dealt}
    assert len(dealt) == 2900 and 1500 < len(folders) <= files.FOLDERS and {len(f) for f in folders} == {3}


def test_f1_documents_without_an_id_are_planned(spark, tmp_path):
    spark.createDataFrame([(1, "a b. c, d. " * 30), (None, "e f. g, h. " * 30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.QUERIES["plan_legacy"](spark, str(tmp_path)).collect()
    spans = sorted((r.first_token, r.last_token) for r in found if r.source_id is None)
    assert {r.problem for r in found} == {None} and spans[0][0] == 0 and spans[-1][1] == 119 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
