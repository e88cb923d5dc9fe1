import math

import numpy as np

from longtab.operators import spikein as SP


def test_t_pvalues_known(spark):
    # two-sided Student-t p-values: standard table values, then numerical integration of the density
    known = [(2.0, 10, 0.07338803), (0.0, 5, 1.0), (10.0, 3, 0.0021284), (1.0, 1, 0.5), (2.228138851, 10, 0.05), (-2.0, 10, 0.07338803)]
    rows = [(t, v) for t, v, _ in known] + [(t, v) for v in (1, 2, 3, 4, 7, 8, 29, 30, 101) for t in (0.01, 0.5, 1.0, 3.0, 12.0)]
    df = spark.createDataFrame(rows + [(float("inf"), 4), (1.0, 0)], "t double, v int")
    got = [r.p for r in df.select(SP.two_sided_p("t", "v").alias("p")).collect()]
    for (_, _, want), p in zip(known, got):
        assert abs(p - want) < 1e-7
    for (t, v), p in zip(rows[len(known):], got[len(known):-2]):
        # substitute u = 1 / x: the tail from t to infinity becomes a finite range
        u = (np.arange(200_000) + 0.5) / 200_000 / t
        c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
        want = 2 * float(np.mean(c * (1 + 1 / (u * u * v)) ** (-(v + 1) / 2) / (u * u))) / t
        assert abs(p - want) < 1e-6 * want + 1e-13, (t, v)
    assert got[-2:] == [0.0, None]


def test_fit_matches_least_squares(spark):
    counts = [("s1", f"i{k}", c, m) for k, (c, m) in enumerate([(10, 0.01), (40, 0.05), (90, 0.2),
                                                                 (400, 1.0), (1000, 3.0)])]
    counts.append(("s2", "i0", 0, 1.0))
    df = spark.createDataFrame(counts, "sample_id string, insert_id string, read_count long, mass_ng double")
    fits, skipped = SP.calibrate(df, min_sample_counts=1)
    r = {x.sample_id: x for x in fits.collect()}["s1"]
    c = np.array([10, 40, 90, 400, 1000.0])
    x = np.log10(c / c.sum() * 1e6)
    y = np.log10([0.01, 0.05, 0.2, 1.0, 3.0])
    slope, intercept = np.polyfit(x, y, 1)
    assert abs(r.slope - slope) < 1e-9 and abs(r.intercept - intercept) < 1e-9
    rv = np.corrcoef(x, y)[0, 1]
    assert abs(r.rvalue - rv) < 1e-9 and r.n == 5 and 0 <= r.pvalue < 0.01
    assert [x.sample_id for x in skipped.collect()] == ["s2"]
