"""Segment planners: small token sequences with known outcomes for the plain planner, and the planner over regions held to it."""

import pytest
from pyspark.sql import functions as F

from loomwright.functions.pointers import followed
from loomwright.operators import planners
from tests import plain_planners as P
from tests.plain_planners import Boundary, Quantiles, Source, better_half, dp_score, labelled_step, plan

STRONG = Quantiles(10, 20, 40, 50, 60, 200, 95)
WEAK = Quantiles(10, 20, 40, 50, 100, 80, 95)


def source(n, boundaries, longest, strong=STRONG, weak=WEAK):
    return Source([0.5 * k for k in range(n)], [0.5 * k + 0.4 for k in range(n)], [Boundary(t, k, p, t) for t, k, p in boundaries], strong, weak, 0.5, longest)


def cut(strategy, *args, **kw):
    links, problem = plan(strategy, source(*args, **kw))
    assert problem is None
    return [(x.first, x.end.token, x.phase) for x in links]


S, W, E = "strong", "weak", "final"


@pytest.mark.parametrize(
    "strategy,n,boundaries,longest,want",
    [
        ("priority_silence_v1", 4, [(1, S, 130), (3, E, 0)], 1.1, [(0, 1, "good_cut"), (2, 3, "good_cut")]),
        ("priority_silence_v1", 4, [(1, W, 150), (3, E, 0)], 10, [(0, 1, "valid_cut"), (2, 3, "valid_cut")]),
        ("priority_silence_v1", 4, [(1, S, 130), (2, W, 500), (3, E, 0)], 10, [(0, 1, "good_cut"), (2, 3, "good_cut")]),
        ("priority_silence_v2", 4, [(1, S, 130), (2, W, 500), (3, E, 0)], 1.1, [(0, 1, "good_cut"), (2, 3, "good_cut")]),
        ("priority_silence_v2", 6, [(1, W, 110), (3, W, 300), (5, E, 0)], 1.1, [(0, 1, "remaining50_cut"), (2, 3, "remaining50_cut"), (4, 5, "remaining50_cut")]),
        ("priority_silence_v2", 4, [(3, E, 0)], 1.1, [(0, 3, "leftover")]),
        ("dp_strategy_2", 4, [(3, E, 0)], 1.1, [(0, 3, "leftover")]),
        ("priority_silence_v3", 4, [(3, E, 0)], 1.1, [(0, 3, "leftover")]),
    ],
)
def test_segments(strategy, n, boundaries, longest, want):
    assert cut(strategy, n, boundaries, longest) == want


def test_combined_quantiles():
    q = Quantiles.of([100, 200, 300, 400, 500])
    assert (q.p40, q.p60, q.p80) == pytest.approx((260, 340, 420))
    assert Quantiles.of([1, 2, 3, 4]).p80 == 900


@pytest.mark.parametrize("pause,kind,phase", [(700, S, "combined_p60_strong_cut"), (700, W, "combined_p60_cut"), (450, W, "combined_p40_cut")])
def test_v3_phases(pause, kind, phase):
    assert cut("priority_silence_v3", 4, [(1, kind, pause), (3, E, 0)], 1.1) == [(0, 1, phase), (2, 3, phase)]


def test_dp_scores():
    s = source(6, [], 2, Quantiles(60 * 0, 0, 0, 0, 120, 300, 0), Quantiles(0, 30, 0, 0, 100, 0, 0))
    score = lambda kind, pause: dp_score(s, Boundary(0, kind, pause))
    assert [score(W, 30), score(W, 50), score(W, 110), score(S, 130), score(E, 0)] == [None, -2, 0, 4, 0]


def test_dp_segments():
    strong, weak = Quantiles(0, 0, 0, 0, 120, 300, 0), Quantiles(0, 30, 0, 0, 100, 0, 0)
    assert cut("dp_strategy_2", 6, [(1, W, 500), (3, S, 130), (5, E, 0)], 2, strong=strong, weak=weak) == [(0, 1, "dp_strategy_2"), (2, 3, "dp_strategy_2"), (4, 5, "dp_strategy_2")]


def test_labels():
    s = source(4, [], 1.1, Quantiles(0, 0, 0, 0, 0, 300, 0), Quantiles(0, 40, 0, 100, 0, 0, 0))
    step = lambda kind, pause, label: labelled_step(s, Boundary(0, kind, pause, label=label))
    assert step(S, 300, "good") == "must_cut" and step(E, 0, "bad") == "must_cut"
    assert step(W, 100, "good") == "step2_good_median"
    assert step(W, 41, "good") == step(W, 100, "ok") == "step3_good_or_ok"
    assert step(W, 41, "ok") == "step4_not_bad" and step(S, 999, "bad") == "not_candidate"


def test_better_half():
    rows = [Boundary(1, S, 10, 1), Boundary(2, W, 500, 2), Boundary(3, S, 20, 3), Boundary(4, W, 30, 4)]
    assert [b.token for b in better_half(rows)] == [3, 1]
    assert [b.token for b in better_half(rows[1:])] == [3, 2]


def test_problems():
    assert plan("other", source(2, [], 1))[1] == "unknown rough cut strategy: other"
    assert plan("legacy_dp", source(2, [], 1))[1] == "no candidate punctuation boundaries found"
    assert plan("priority_silence_v3", source(2, [(0, W, 10)], 1))[1] == "priority_silence_v3 found no final must_cut boundary"


def test_plan_covers_every_token(spark, sf):
    from loomwright.plans.catalogue import QUERIES

    rows = QUERIES["plan_v3"](spark, sf).where("problem is null").collect()
    by = {}
    for r in rows:
        by.setdefault(r.source_id, []).append((r.first_token, r.last_token))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


def test_asker():
    from tests.plain_planners import sliced_by_asker

    s = source(6, [(1, W, 10), (3, S, 500), (5, E, 0)], 2)
    asked = []

    def good(markers, said):
        asked.append(said)
        return [1, 0] if not said else [1, 2]

    links, how = sliced_by_asker(s, good)
    assert how == "submitted" and [(x.first, x.end.token) for x in links] == [(0, 3), (4, 5)] and asked[1] == "cuts must be strictly increasing"
    assert sliced_by_asker(s, lambda m, said: [])[1] == "fallback"
    long = source(6, [(1, W, 10), (3, S, 500), (5, E, 0)], 1)
    assert sliced_by_asker(long, lambda m, said: [2])[1] == "submitted"  # sent again, so confirmed


def every_chain(source, start, points, last):
    """All chains of valid links from the start, brute force."""
    out = [[]]
    for b in [p for p in points if start <= p.token < last.token] + [last]:
        link = source.link(start, b, "x")
        if link.valid and link.trimmed > 0:
            out.append([link])
            if b.token < last.token:
                out += [[link, *rest] for rest in every_chain(source, b.token + 1, points, last) if rest]
    return out


def test_chain_is_the_best_of_all():
    import random

    pick = random.Random(12)
    for trial in range(150):
        n = pick.randint(2, 14)
        starts, at = [], 0.0
        for _ in range(n):
            starts.append(at)
            at += pick.uniform(0.3, 3.0)
        ends = [x + 0.25 for x in starts]
        cuts = sorted(pick.sample(range(n - 1), pick.randint(0, min(7, n - 1))))
        inner = [P.Boundary(k, "weak", float(pick.randint(1, 9)), j) for j, k in enumerate(cuts)]
        last = P.Boundary(n - 1, "final", 0.0)
        off = (lambda a, b: max(0.0, b - a - 0.4)) if trial % 3 == 0 else None
        source = P.Source(starts, ends, [*inner, last], P.Quantiles(), P.Quantiles(), 1.0, 4.0, off, 0.4 if trial % 2 else None)
        for add, to_end in ((P._more_segments, False), (P._more_silence, True)):
            got = P.chain(source, (0, last), inner, "x", (0.0, 0, 0), add, to_end)
            total = lambda links: __import__("functools").reduce(add, links, (0.0, 0, 0))  # noqa: E731, B023
            known = [c for c in every_chain(source, 0, inner, last) if not to_end or (c and c[-1].end.token == last.token)]
            best = max((total(c) for c in known), default=None)
            assert (total(got) if got or not to_end else None) == best


def test_long_regions_take_time_in_proportion():
    import time

    n = 20_000
    source = P.Source([k * 0.5 for k in range(n)], [k * 0.5 + 0.4 for k in range(n)], [*(P.Boundary(k, "weak", 200.0, k) for k in range(n - 1)), P.Boundary(n - 1, "final", 0.0, n)], P.Quantiles(), P.Quantiles(), 3.0, 10.0)
    began = time.time()
    for name in ("priority_silence_v3", "dp_strategy_2"):
        assert name not in P.PLANNERS or P.plan(name, source)[0]
    assert P.chain(source, (0, source.boundaries[-1]), source.boundaries[:-1], "x", (0.0, 0, 0), P._more_segments, False)
    assert time.time() - began < 20


def test_lengths_without_silent_ends(spark):
    import numpy as np

    from loomwright.operators.pauses import NAMES
    from loomwright.sources.audio import encode_wav

    rate = 8000
    x = np.sin(np.arange(8 * rate)).astype(np.float32) * 0.5
    x[2 * rate : 4 * rate] = 0
    left, most = P.trimmed_lengths(x, rate)
    rng = np.random.default_rng(1)
    for a, z in np.sort(rng.uniform(0, 8, (200, 2)), axis=1):
        assert z - a - left(a, z) <= most + 1e-3
    assert abs(left(0, 4) - 2) < 0.3 and left(5, 6) == pytest.approx(1, abs=0.1)
    rows = [(k, i, i * 1.0, i + 0.9, "final" if i == 7 else "strong" if i == 3 else None, 130.0) for k in (1, 2) for i in range(8)]
    q = "struct<" + ", ".join(f"{n}: double" for n in NAMES) + ">"
    stats = tuple(float(v) for v in range(1, len(NAMES) + 1))
    tokens = spark.createDataFrame([(*r, stats, stats) for r in rows], f"source_id long, idx int, start_sec double, end_sec double, kind string, pause_ms double, strong {q}, weak {q}")
    audio = spark.createDataFrame([(1, encode_wav(x, rate)), (3, encode_wav(x, rate))], "source_id long, content binary")
    got = {(r.source_id, r.first_token): r for r in planners.plan_segments(tokens, "priority_silence_v1", 1.0, 5.0, audio=audio).collect()}
    assert set(got) == {(1, 0), (1, 4), (2, 0), (2, 4)}
    assert got[1, 0].trimmed_sec < 2.5 < got[2, 0].trimmed_sec and got[1, 0].raw_sec == got[2, 0].raw_sec


# -- the planner over regions, held to the plain one ---------------------------

NAMES = dict(zip(P.STRATEGIES, ("plan_legacy", "plan_v1", "plan_v2", "plan_v3", "plan_dp2", "plan_labelled")))


def rows_of(df, source="source_id"):
    columns = [source, *(c.split()[0] for c in P.PLAN_SCHEMA.split(", "))]
    return sorted(tuple(map(str, r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("strategy", P.STRATEGIES)
def test_all_documents_are_planned_alike(spark, sf, strategy):
    from loomwright.plans import catalogue

    want = rows_of(P.plan_segments(catalogue.tokens(spark, sf), strategy, 5.0, 15.0))
    assert rows_of(catalogue.QUERIES[NAMES[strategy]](spark, sf)) == want
    if strategy == P.STRATEGIES[-1]:
        assert {"step2_good_median", "step3_good_or_ok", "step4_not_bad"} <= {r[7] for r in want}


@pytest.fixture(scope="module")
def odd_sources(spark):
    """Null and repeated names, sources without boundaries, without a final one, of one token, and long ones of uneven times."""
    import random

    pick = random.Random(8)
    rows = []
    for name, n in ((None, 40), ("a", 400), ("b", 1), ("no boundaries", 9), ("no final", 60), ("early final", 50), ("pause", 300)):
        at = 0.0
        for k in range(n):
            kind = pick.choice([None, None, "weak", "weak", "strong"])
            if k == n - 1 and name != "no final" or name == "early final" and k == n - 6:
                kind = "final"
            if name == "no boundaries" or name == "early final" and k > n - 6:
                kind = None
            ms = float(pick.choice([0, 100, 150, 250, 450, 450, 700, 950]))
            if name == "pause" and k in (100, 101):
                at += 80.0
            rows.append((name, k * 3, at, at + 0.3, kind, ms if kind else None, pick.choice(["perfect", "ok", "bad"]), "must_cut" if kind == "final" else pick.choice(["normal", "must_cut", "no_cut", "normal"]), pick.choice(["good", "ok", "bad"])))
            at += 0.3 + pick.uniform(0.1, 1.5)
    q = "struct<" + ", ".join(f"{n}: double" for n in ("p5", "p20", "p40", "p50", "p60", "p80", "p95")) + ">"
    stats = (50.0, 120.0, 200.0, 240.0, 300.0, 600.0, 900.0)
    schema = f"source_id string, idx int, start_sec double, end_sec double, kind string, pause_ms double, quality string, policy string, label string, strong {q}, weak {q}"
    return spark.createDataFrame([(*r, stats, stats) for r in rows], schema)


@pytest.mark.parametrize("strategy", P.STRATEGIES)
def test_odd_sources_are_planned_alike(odd_sources, strategy):
    named = odd_sources.where("source_id is not null")
    want = rows_of(P.plan_segments(named, strategy, 5.0, 15.0))
    assert rows_of(planners.plan_segments(named.repartition(5), strategy, 5.0, 15.0)) == want
    alone = odd_sources.where("source_id is null")
    plain = P.plan_segments(alone.fillna({"source_id": "x"}), strategy, 5.0, 15.0)
    assert [r[1:] for r in rows_of(planners.plan_segments(alone, strategy, 5.0, 15.0))] == [r[1:] for r in rows_of(plain)]
    assert planners.plan_segments(odd_sources.limit(0), strategy, 5.0, 15.0).count() == 0


def test_unknown_strategy(odd_sources):
    got = planners.plan_segments(odd_sources, "other", 5.0, 15.0)
    assert {r.problem for r in got.collect()} == {"unknown rough cut strategy: other"} and got.count() == 7


@pytest.mark.parametrize("strategy", ["priority_silence_v2", "dp_strategy_2", "legacy_dp"])
def test_lengths_by_audio_are_those_of_the_plain_planner(spark, odd_sources, strategy):
    import numpy as np

    from loomwright.sources.audio import encode_wav

    rate = 4000
    some = odd_sources.where("source_id in ('a', 'pause')")
    rng = np.random.default_rng(3)
    files = []
    for r in some.groupBy("source_id").agg({"end_sec": "max"}).collect():
        x = rng.normal(0, 0.1, int(r[1] * rate)).astype(np.float32)
        for a in rng.integers(0, len(x), 80):
            x[a : a + int(rng.integers(500, 6000))] = 0
        files.append((r[0], encode_wav(x, rate)))
    audio = spark.createDataFrame(files[:2], "source_id string, content binary")
    want = rows_of(P.plan_segments(some, strategy, 5.0, 15.0, audio=audio))
    assert rows_of(planners.plan_segments(some, strategy, 5.0, 15.0, audio=audio)) == want


def test_a_long_source_spreads_over_tasks(spark):
    """Regions of one source are solved in several tasks, and windows between anchors too."""
    n = 60_000
    tokens = spark.range(n).selectExpr(
        "concat('s', id div 1000000) as source_id", "cast(id as int) as idx", "id * 0.9 as start_sec", "id * 0.9 + 0.3 as end_sec", f"case when id = {n - 1} then 'final' when id % 60 = 7 then 'strong' when id % 3 = 0 then 'weak' end as kind",
        "cast((id * 7919) % 600 as double) + case when id % 60 = 7 then 600 else 0 end as pause_ms", "'ok' as quality", "'normal' as policy",
    )
    got = planners.plan_segments(tokens, "priority_silence_v3", 5.0, 15.0)
    spread = got.where("problem is null").groupBy(F.spark_partition_id()).count().count()
    assert spread > 1
    spans = sorted((r.first_token, r.last_token) for r in got.collect())
    assert spans[0][0] == 0 and spans[-1][1] == n - 1 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    spans = sorted((r.first_token, r.last_token) for r in planners.plan_segments(tokens, "legacy_dp", 5.0, 15.0).collect())
    assert spans[0][0] == 0 and spans[-1][1] == n - 1 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("block", [1, 4, 7, 4096])
def test_chains_of_pointers_equal_a_fold(spark, block):
    import random

    pick = random.Random(block)
    rows, want = [], set()
    for key in [None, *range(6)]:
        places = sorted(pick.sample(range(200), 60))
        to = {p: pick.choice([None, p + pick.randint(1, 9), pick.choice([q for q in places if q > p] or [None]), min([q for q in places if q > p], default=None)]) for p in places}
        rows += [(key, p, t) for p, t in to.items()]
        now = places[0]
        while now in to:
            want.add((key, now))
            now = to[now]
    df = spark.createDataFrame(rows, "k int, at long, to long").repartition(4)
    assert {(r.k, r.at) for r in followed(df, "k", "at", "to", block).collect()} == want
    assert followed(df.limit(0), "k", "at", "to", block).count() == 0
