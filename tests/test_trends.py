import math

import numpy as np
import pytest

from corpuslens.operators import ranking as rk
from corpuslens.operators import trends as t

SERIES = {
    "rising": [(2000 + i, i + 1) for i in range(10)],
    "falling": [(2000 + i, 20 - 2 * i) for i in range(8)],
    "ties": [(2000, 3), (2001, 3), (2002, 5), (2004, 3), (2005, 5), (2009, 1)],
    "gap": [(1990, 2), (1995, 4), (2010, 8), (2011, 16)],
    "constant": [(2001, 4), (2002, 4), (2003, 4)],
    "short": [(2001, 4), (2007, 9)],
    "one": [(2001, 4)],
}


@pytest.fixture(scope="module")
def series(spark):
    rows = [(0, k, y, n) for k, points in SERIES.items() for y, n in points]
    return spark.createDataFrame(rows, "topic int, keyword string, year int, n long").repartition(3)


def expected(points):
    x = np.array([n for _, n in points], dtype=float)
    n = len(x)
    if n < 3:
        return None
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    s = sum(np.sign(x[j] - x[i]) for i, j in pairs)
    ties = np.unique(x, return_counts=True)[1]
    var = (n * (n - 1) * (2 * n + 5) - (ties * (ties - 1) * (2 * ties + 5)).sum()) / 18
    z = 0.0 if s == 0 else (s - np.sign(s)) / math.sqrt(var)
    years = points[-1][0] - points[0][0]
    return {
        "mk_tau": s / (n * (n - 1) / 2),
        "mk_p": math.erfc(abs(z) / math.sqrt(2)),
        "sen_slope": float(np.median([(x[j] - x[i]) / (j - i) for i, j in pairs])),
        "cagr_pct": ((x[-1] / x[0]) ** (1 / years) - 1) * 100,
    }


def test_statistics_match_numpy(series):
    got = {r.keyword: r for r in t.series_statistics(series).collect()}
    assert set(got) == set(SERIES)
    for keyword, points in SERIES.items():
        row, want = got[keyword], expected(points)
        assert (row.total_count, row.year_min, row.year_max) == (sum(n for _, n in points), points[0][0], points[-1][0])
        if want is None:
            assert row.trend_label == "insufficient" and row.mk_p is None and row.sen_slope is None and row.cagr_pct is None
            continue
        for name, value in want.items():
            assert row[name] == pytest.approx(value, abs=2e-7), (keyword, name)
    labels = {k: r.trend_label for k, r in got.items()}
    assert labels["rising"] == "emerging" and labels["falling"] == "declining"
    assert labels["constant"] == labels["ties"] == labels["gap"] == "stable"


def test_pairs(series):
    got = {r.keyword: r for r in t.series_pairs(series).collect()}
    assert (got["rising"].pairs, got["rising"].up) == (45, 45)
    assert (got["constant"].pairs, got["constant"].ties) == (3, 3)
    assert (got["one"].points, got["one"].pairs) == (1, 0)
    assert got["ties"].up + got["ties"].down + got["ties"].ties == 15


def test_growth_uses_calendar_years(series):
    got = {r.keyword: r.cagr_pct for r in t.cagr(series).collect()}
    assert got["gap"] == pytest.approx((8 ** (1 / 21) - 1) * 100)
    assert got["one"] is None


@pytest.mark.parametrize("window, before, after", [(5, 2, 2), (4, 2, 1), (3, 1, 1)])
def test_moving_average(series, window, before, after):
    rows = t.centered_moving_average(series, window).where("keyword = 'rising'").orderBy("year").collect()
    values = [r.n for r in rows]
    for i, row in enumerate(rows):
        lo, hi = i - before, i + after
        want = np.mean(values[lo:hi + 1]) if lo >= 0 and hi < len(values) else None
        assert row.moving_avg == (pytest.approx(want) if want is not None else None)


def documents(spark):
    rows = [
        (0, 0, 2001, "A; a; b"), (1, 0, 2001, "b"), (2, 0, 2003, "a; c"), (3, 1, 2001, "z"), (4, 0, 2002, None), (5, -1, 2001, "a"),
    ]
    return spark.createDataFrame(rows, "row_idx long, topic int, year int, author_keywords string")


def test_occurrences_and_documents_differ(spark):
    rows = {(r.topic, r.keyword, r.year): r for r in t.keyword_years(documents(spark)).collect()}
    assert (rows[0, "a", 2001].occurrences, rows[0, "a", 2001].n) == (2, 1)
    assert (rows[0, "b", 2001].occurrences, rows[0, "b", 2001].n) == (2, 2)
    assert (-1, "a", 2001) in rows


def test_trend_table(spark):
    years = t.keyword_years(documents(spark))
    order = spark.createDataFrame([(1, 1), (2, 0), (3, 8)], "position int, topic int")
    targets = rk.target_topics(order, documents(spark), (1, 2, 3))
    chosen = t.trend_keywords(years, targets, 2)
    assert sorted((r.rank, r.topic, r.kw_rank, r.keyword) for r in chosen.collect()) == [(1, 1, 1, "z"), (2, 0, 1, "a"), (2, 0, 2, "b")]
    labels = spark.createDataFrame([(0, "zero")], "topic int, label_kr string")
    table = {(r.topic_id, r.keyword): r for r in t.trend_stats(years, chosen, labels).collect()}
    assert table[0, "a"].label_kr == "zero" and table[1, "z"].label_kr == "Topic 1"
    assert table[0, "a"].total_count == 2 and table[0, "a"].trend_label == "insufficient"
    assert len(table[0, "a"]) == 12


def test_share_and_pivot(spark):
    counts = t.year_topic_counts(documents(spark))
    shares = {(r.year, r.topic): r.share for r in t.year_topic_share(counts).collect()}
    assert shares[2001, 0] == pytest.approx(50.0) and shares[2001, -1] == pytest.approx(25.0)
    names = spark.createDataFrame([(0, "zero")], "topic int, label_kr string")
    wide = t.year_topic_pivot(counts, names)
    assert wide.columns == ["year", "T-1_-1", "T0_zero", "T1_1"]
    assert [tuple(r) for r in wide.orderBy("year").collect()] == [(2001, 1, 2, 1), (2002, 0, 1, 0), (2003, 0, 1, 0)]
