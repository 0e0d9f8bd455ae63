"""Askers in rounds against plain loops over sources, with scripted answers."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomwright.operators import planners, rounds
from loomwright.plans import askers
from tests import plain_planners as P

Q = P.Quantiles()


@pytest.fixture(scope="module")
def rows(spark, sf):
    return askers.rows_in_sentences(spark, sf).cache()


def sources(rows, by):
    out = defaultdict(list)
    for r in rows.orderBy("source_id", "row").collect():
        out[tuple(r[c] for c in by)].append(r)
    return out


class Marks:
    """Lengths over boundary rows, as the plain planner wants them."""

    def __init__(self, marks, shortest, longest):
        self.marks, self.shortest, self.longest = marks, shortest, longest

    def length(self, a, z):
        return self.marks[z]["closes"] - self.marks[a]["from_opens"]


def plain_slices(marks, ask, shortest, longest, attempts, padding, to_end):
    """(cuts, how) by the rules of one group, one attempt after another."""
    m, said, last = Marks(marks, shortest, longest), "", None
    markers = [r["row"] for r in marks]
    for _ in range(attempts):
        cuts = ask([(markers, said)])[0]
        if not cuts:
            said = "no cuts"
        elif any(b <= a for a, b in zip(cuts, cuts[1:])):
            said = "rise"
        elif set(cuts) - set(markers):
            said = "unknown"
        elif to_end and cuts[-1] != markers[-1]:
            said = "end"
        else:
            at = [markers.index(c) for c in cuts]
            off = [1 for a, z in zip([0, *(k + 1 for k in at)], at) if not shortest <= m.length(a, z) + 2 * padding <= longest]
            if not off or cuts == last:
                return cuts, "accepted"
            said, last = "off", cuts
    return (last, "unconfirmed") if last else (None, "fallback")


def spans(marks, cuts):
    at = [[r["row"] for r in marks].index(c) for c in cuts]
    return [(marks[a]["from_token"], marks[z]["token"]) for a, z in zip([0, *(k + 1 for k in at)], at)]


@pytest.mark.parametrize("every,shortest,longest", [(4, 5.0, 30.0), (1, 1.0, 6.0)])
def test_slices_of_groups(rows, every, shortest, longest):
    got = defaultdict(list)
    for r in rounds.slices_by_asker(rows, "group_id", f"cut{every}", askers.cutter(every), shortest, longest).collect():
        got[r.source_id, r.group_id].append(r)
    hows = set()
    for key, marks in sources(rows, ["source_id", "group_id"]).items():
        cuts, how = plain_slices(marks, askers.cutter(every)(), shortest, longest, 3, 0.2, True)
        hows.add(how)
        found = sorted((r.first_token, r.last_token) for r in got[key])
        assert {r.how for r in got[key]} == {how}
        if cuts:
            assert found == spans(marks, cuts)
        else:
            assert found[0][0] == marks[0]["from_token"] and found[-1][1] == marks[-1]["token"] and all(a[1] + 1 == b[0] for a, b in zip(found, found[1:]))
    assert {"accepted", "fallback"} <= hows


def test_windows_from_cursor_to_cursor(spark, rows):
    some = rows.where("source_id < 12")
    shortest, longest = 5.0, 30.0
    got = defaultdict(list)
    for r in rounds.windows_by_asker(some, "cut6", askers.cutter(6), shortest, longest, attempts=2, least_sec=40.0, sentences=9).collect():
        got[r.source_id].append((r.window, r.first_token, r.last_token, r.how))
    hows = set()
    for (source,), marks in sources(some, ["source_id"]).items():
        boundaries = [P.Boundary(r["token"], r["kind"], r["pause_ms"], k) for k, r in enumerate(marks)]
        s = P.Source([0.3 * k for k in range(marks[-1]["n_tokens"])], [0.3 * k + 0.25 for k in range(marks[-1]["n_tokens"])], boundaries, Q, Q, shortest, longest)
        at, window, want = 0, 0, []
        while at < len(marks):
            shown = [marks[b.ident] for b in P.next_window(s, marks[at]["from_token"], 40.0, 9, 2)]
            cuts, how = plain_slices(shown, askers.cutter(6)(), shortest, longest, 2, 0.2, False)
            if cuts is None:
                m = Marks(shown, shortest, longest)
                fits = [k for k in range(len(shown)) if shortest <= m.length(0, k) <= longest]
                cuts = [shown[fits[-1] if fits else -1]["row"]]
            want += [(window, a, z, how) for a, z in spans(shown, cuts)]
            hows.add(how)
            at, window = [r["row"] for r in marks].index(cuts[-1]) + 1, window + 1
        assert sorted(got[source]) == sorted(want)
    assert len(hows) > 1
    assert rounds.windows_by_asker(some.limit(0), "cut6", askers.cutter(6), 1.0, 2.0).count() == 0


def never():
    def answer(batch):
        raise RuntimeError("no connection")

    return answer


def test_an_asker_that_fails_leaves_the_fallbacks(spark, rows):
    some = rows.where("source_id < 2")
    assert {r.how for r in rounds.slices_by_asker(some, "group_id", "never", never, 5.0, 30.0, attempts=2).select("how").distinct().collect()} == {"fallback"}
    marks = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (None, 0, 5)], "source_id int, sentence int, token long")
    assert [r.label for r in rounds.labelled_pauses(marks, "never", never).collect()] == ["ok"] * 3
    turns = spark.createDataFrame([(1, "a, b"), (2, None)], "k int, text string")
    assert {(r.k, r.revised, r.how) for r in rounds.revised_windows(turns, "never", never).collect()} == {(1, "a, b", "unanswered"), (2, None, "unanswered")}


def odd():
    return lambda batch: [None if w[0] == 1 else [(i, "fine") for i in w] if w[0] == 2 else [(i, "good") for i in [*w, w[0]]] if w[0] == 3 else [(i, "bad") for i in w[::-1]] for w, _ in batch]


def test_labels_that_are_refused(spark):
    marks = spark.createDataFrame([(s, 0, t) for s in (1, 2, 3, 4, None) for t in (s or 9, 50)], "source_id int, sentence int, token long")
    got = {(r.source_id, r.token): r.label for r in rounds.labelled_pauses(marks, "odd", odd).collect()}
    assert got == {(s, t): "bad" if s in (4, None) else "ok" for s in (1, 2, 3, 4, None) for t in (s or 9, 50)}


def plain_warning_windows(n, warnings):
    """Sentences of ten tokens, grown one by one from each warning."""
    span = lambda k: (k * 10, k * 10 + 9)
    out = []
    for a, z in warnings:
        for token in (a, z):
            k = token // 10
            if k >= n:
                continue
            i = j = k
            while i > 0 and any(w[1] == span(i)[0] for w in warnings):
                i -= 1
            while j + 1 < n and any(w[0] == span(j)[1] for w in warnings):
                j += 1
            out.append((i, j))
    merged = []
    for i, j in sorted(out):
        if merged and i <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], j))
        else:
            merged.append((i, j))
    return merged


def test_warning_windows_equal_a_plain_loop(spark):
    pick = random.Random(6)
    spans, warned, want = [], [], set()
    for source in [None, *range(12)]:
        n = pick.randint(1, 12)
        spans += [(source, k, k * 10, k * 10 + 9) for k in range(n)]
        warnings = [(t, t + 1) for t in (pick.choice([k * 10 + 9, k * 10 + 4]) for k in range(n) if pick.random() < 0.5) if t + 1 < n * 10]
        warned += [(source, *w) for w in warnings]
        want |= {(source, *w) for w in plain_warning_windows(n, warnings)}
    s = spark.createDataFrame(spans, "source_id int, sentence int, first_token int, last_token int")
    w = spark.createDataFrame(warned, "source_id int, left_idx int, right_idx int")
    assert {tuple(r) for r in rounds.warning_windows(s, w).select("source_id", "first_sentence", "last_sentence").collect()} == want
