"""Streaming cursor segmentation, the longest-run experiment, the pre-split mapping and JSON arguments."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.operators import reports, signal
from loomwright.streaming.cursor import _cut, cursor_segments

ZERO = dt.datetime(2024, 1, 1)


def whole(at, level, short, long):
    """Segments of all frames at once."""
    out, cursor = [], None
    while len(at):
        cursor = int(at[0]) if cursor is None else cursor
        if at[-1] > cursor + long:
            end, method = _cut(cursor, at, level, short, long)
            keep = at >= end
        else:
            end, method, keep = int(at[-1]), "tail", np.zeros(len(at), bool)
        out.append((cursor, end, method))
        at, level, cursor = at[keep], level[keep], end
    return out


def test_cursor_segments_do_not_depend_on_batches(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows, want = [], set()
    for key in (1, 2):
        at = np.arange(0, 90_000_000, 250_000)
        level = rng.uniform(0.1, 1, len(at)) * np.where(rng.random(len(at)) < 0.1, 0.01, 1)
        rows += [(key, ZERO + dt.timedelta(microseconds=int(a)), float(x)) for a, x in zip(at, level, strict=True)]
        want |= {(key, ZERO + dt.timedelta(microseconds=s), ZERO + dt.timedelta(microseconds=e), m) for s, e, m in whole(at, level, 5_000_000, 15_000_000)}
    rows.append((9, ZERO + dt.timedelta(hours=1), 1.0))  # lets the watermark pass all of them
    rows += [(None, ZERO, 1.0), (1, None, 1.0), (2, ZERO + dt.timedelta(hours=2), None)]
    schema = "k long, ts timestamp, level double"
    got = []
    for name, size in (("a", 97), ("b", 1000)):
        ordered = sorted(rows, key=lambda r: (r[1] or ZERO, r[0] or 0))
        for i in range(0, len(ordered), size):
            part = ordered[i : i + size]
            rng.shuffle(part)  # late by no more than a file
            spark.createDataFrame([tuple(r) for r in part], schema).coalesce(1).write.parquet(str(tmp_path / name / f"p{i:05d}"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / name))
        q = cursor_segments(stream, "k", "ts", "level", 5, 15, "30 seconds").writeStream.format("memory").queryName(f"cursor_{name}").option("checkpointLocation", str(tmp_path / f"c{name}")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        got.append({tuple(r) for r in spark.table(f"cursor_{name}").where("k < 9").collect()})
    assert got[0] == want and got[1] == want


def test_longest_run_cuts():
    rate = 8000
    x = np.sin(np.arange(40 * rate)).astype(np.float32)
    x[: 5 * rate] *= 0.01  # with the next stretch over a quarter, outside every window
    x[int(24.4 * rate) : 29 * rate] *= 0.01
    x[7 * rate : 7 * rate + 1600] = 0  # 0.2 s
    x[9 * rate : 9 * rate + 4000] = 0  # 0.5 s, the longest ahead
    x[12 * rate : 12 * rate + 400] = 0  # too short
    got = signal.longest_run_cuts(x, rate)
    assert abs(got[0][1] - 9.25) < 0.02 and 450 < got[0][4] <= 500 and got[0][6] == ""
    assert got[1][6] == "no_silence_max" and abs(got[1][1] - got[1][0] - 15) < 1e-9
    assert [r[0] for r in got[1:]] == [r[1] for r in got[:-1]] and got[-1][6] == "tail" and got[-1][1] == 40
    assert abs(np.diff(signal.longest_run_cuts(x, rate, fallback="midpoint")[1][:2])[0] - 7.5) < 1e-9
    assert signal.longest_run_cuts(x[:0], rate) == []


def test_part_mapping(spark, tmp_path):
    parts = spark.createDataFrame([("b.wav", "b_1.wav", 1, 2, 1.5, 3.0, None, None), ("b.wav", "b_0.wav", 0, 2, 0.0, 1.5, "silence", 0.25)], "source_path string, output_path string, part_index int, part_count int, start_sec double, end_sec double, cut_method string, silence_sec double")
    reports.write_mapping(reports.part_mapping(parts), str(tmp_path / "m"))
    got = [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "m")).orderBy("part_index").collect()]
    assert got == [("b.wav", "b_0.wav", "0", "2", "0.000", "1.500", "1.500", "silence", "0.250"), ("b.wav", "b_1.wav", "1", "2", "1.500", "3.000", "1.500", "final", "0.000")]


def test_json_arguments_and_blank_runs(spark):
    raw = [None, " ", "[1]", '{"a": 1', '{"a": 1, "b": "x"}', '"s"']
    rows = spark.createDataFrame(list(enumerate(raw)), "i int, raw string").orderBy("i").select(T.json_arguments(F.col("raw")).alias("m")).collect()
    assert [r.m for r in rows] == [{}, {}, {}, {}, {"a": "1", "b": "x"}, {}]
    run = spark.createDataFrame([("a\n\tb",), ("a.\nb",)], "t string").select(T.run_after(F.col("t"), F.lit(0)).alias("r"), T.boundary_kind(F.lit("\n")).alias("k")).collect()
    assert [r.r for r in run] == ["", ".\n"] and run[0].k is None
