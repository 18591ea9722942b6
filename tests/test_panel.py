"""Hand-computed values and NumPy oracles for the panel operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.functions import PanelError
from panelweave.operators import agreement, gates, genotype, integrity, kinship, linkage, mosaic, ordered, overlap, phenotype, sampling, spectra


def calls_of(spark, matrix):
    rows = [(i, j, None if d is None else int(d)) for i, row in enumerate(matrix) for j, d in enumerate(row)]
    return spark.createDataFrame(rows, "i int, j int, d int")


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(3)
    g = rng.integers(0, 3, (30, 12))
    g[:, 4] = 1
    return g


def test_marker_statistics_with_missing_calls(spark):
    df = calls_of(spark, [[0, None, 2], [1, None, 2], [2, 1, 2]])
    got = {r.j: r for r in genotype.marker_stats(df).collect()}
    assert (got[0].maf, got[0].heterozygosity, got[0].n_missing) == (0.5, 1 / 3, 0)
    assert (got[1].n_calls, got[1].n_missing, got[1].maf) == (1, 2, 0.5)
    assert (got[2].maf, got[2].levels) == (0.0, 1)
    assert genotype.panel_stats(df).first().missingness == 2 / 9
    with pytest.raises(PanelError):
        genotype.assert_hard_calls(df)
    genotype.assert_hard_calls(df, complete=False)


def test_fingerprints_count_null_as_a_level(spark):
    df = calls_of(spark, [[0, None], [0, None], [0, 1]])
    assert genotype.duplicated_rows(df).first().duplicated == 1
    assert genotype.identical_pairs(calls_of(spark, [[1, 1, 1, 0], [2, 2, 2, 0]])).first().pairs == 3


def test_king_by_hand_and_across_words(spark):
    rng = np.random.default_rng(1)
    g = rng.integers(0, 3, (7, 150))
    want = {}
    for a in range(7):
        for b in range(a + 1, 7):
            hh = ((g[a] == 1) & (g[b] == 1)).sum()
            ibs0 = (abs(g[a] - g[b]) == 2).sum()
            want[a, b] = (hh - 2 * ibs0) / ((g[a] == 1).sum() + (g[b] == 1).sum())
    for tile, form in ((512, "join"), (3, "join"), (3, "tiles"), (512, "tiles"), (4, "auto")):
        got = {(r.i1, r.i2): r.kinship for r in kinship.king_pairs(calls_of(spark, g), tile, form).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_king_without_heterozygotes_has_no_pair(spark):
    assert kinship.king_pairs(calls_of(spark, [[0, 2], [2, 0]])).count() == 0


def test_eigen_metrics_agree_with_marker_space(spark, small, monkeypatch):
    rank, top = spectra.eigen_metrics(calls_of(spark, small))
    x = small - small.mean(0)
    size = np.sqrt((x * x).sum(0))
    c = np.eye(12)
    v = size > 0
    c[np.ix_(v, v)] = (x[:, v] / size[v]).T @ (x[:, v] / size[v])
    assert abs(rank - 144 / (c * c).sum()) < 1e-10
    assert abs(top - np.linalg.eigvalsh(c).max()) < 1e-10
    df = calls_of(spark, small)
    # sample space, and panels whose matrices do not fit the driver
    wide = calls_of(spark, small[:9])
    y = small[:9] - small[:9].mean(0)
    y = np.divide(y, np.sqrt((y * y).sum(0)), out=np.zeros_like(y), where=(y * y).sum(0) > 0)
    e = y.T @ y + np.diag(((y * y).sum(0) == 0).astype(float))
    for bound in (2048, 3):
        monkeypatch.setattr(spectra, "MAX_SIDE", bound)
        assert np.allclose(spectra.eigen_metrics(df), (rank, top), rtol=1e-7)
        assert np.allclose(spectra.eigen_metrics(wide), (144 / (e * e).sum(), np.linalg.eigvalsh(e).max()), rtol=1e-7)
    m = spark.createDataFrame([(j, 1000 * j) for j in range(12)], "j int, bp long")
    assert abs(linkage.effective_rank(df, m).first()[0] - rank) < 1e-9


def test_pca_displacement_of_the_reference_itself_is_zero(spark, small):
    df = calls_of(spark, small)
    row = spectra.pca_displacement(df, df, 4).first()
    assert row.rms_z < 1e-9 and abs(row.median_variance_ratio - 1) < 1e-9
    x = (small - small.mean(0))[:, small.std(0) > 0]
    x = x / x.std(0, ddof=1)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    got = spectra.project(df, spectra.pca_reference(df, 3)).where("pc = 0").orderBy("i").collect()
    score = np.array([r.score for r in got])
    assert min(abs(score - u[:, 0] * s[0]).max(), abs(score + u[:, 0] * s[0]).max()) < 1e-9


def test_distance_bins_and_the_inclusive_window(spark):
    m = spark.createDataFrame([(0, 0), (1, 1_000_000), (2, 2_000_001), (3, 9_999)], "j int, bp long")
    pairs = {(r.j1, r.j2): r.dist for r in linkage.marker_pairs(m).collect()}
    assert pairs == {(0, 1): 1_000_000, (0, 3): 9_999, (1, 3): 990_001}
    r2 = linkage.pair_r2(calls_of(spark, [[0, 0, 1, 0], [1, 1, 1, 0], [2, 2, 0, 1]]), linkage.marker_pairs(m))
    bins = {r.bin: r for r in linkage.by_distance(r2).collect()}
    assert bins[">1Mb"].pairs == 1 and abs(bins[">1Mb"].mean_r2 - 1) < 1e-12
    assert bins["50-100kb"].pairs == 0 and bins["50-100kb"].mean_r2 is None
    scores = {r.j: r.ld_score for r in linkage.ld_scores(r2, m).collect()}
    assert scores[2] == 0 and scores[0] > 1


def test_tiles_agree_with_the_relational_form(spark):
    from panelweave.operators import tiles

    rng = np.random.default_rng(8)
    g = rng.integers(0, 3, (40, 25)).astype(object)
    g[rng.random(g.shape) < 0.1] = None
    g[:, 3] = 2
    df = calls_of(spark, g)
    rows = [(j, int(b), "1" if j < 14 else "2") for j, b in enumerate(np.concatenate([rng.permutation(14), rng.permutation(11)]) * 1000)]
    m = spark.createDataFrame(rows, "j int, bp long, chr string")
    for markers in (m, m.drop("chr")):
        want = {(r.j1, r.j2): (r.dist, round(r.r2, 9)) for r in linkage.pair_r2(df, linkage.marker_pairs(markers, 5000)).collect()}
        for tile in (4, 100):
            got = tiles.window_r2(genotype.wide_markers(df), markers, 5000, tile).collect()
            assert {(r.j1, r.j2): (r.dist, round(r.r2, 9)) for r in got} == want and len(got) == len(want)
    r = {(x.j1, x.j2): x.r for x in linkage.correlations(calls_of(spark, [[0, 2, 1], [1, 1, 1], [2, 0, 1]]), m.where("j < 3"), 10**9).collect()}
    assert {k: round(v, 9) for k, v in r.items()} == {(0, 1): -1.0, (0, 2): 0.0, (1, 2): 0.0}


def test_markers_out_of_order_still_pair(spark):
    m = spark.createDataFrame([(5, 10), (2, 1_500_000), (1, 700_000)], "j int, bp long")
    assert {(r.j1, r.j2) for r in linkage.marker_pairs(m).collect()} == {(1, 5), (1, 2)}


DONORS = [[0, 0, 1, 1, 0], [1, 1, 0, 0, 1], [0, 1, 0, 1, 0]]
MAP = [0, 0.001, 0.002, 0.004, 0.010]


def mosaic_inputs(spark, n, morgans):
    return spark.range(n).select(F.col("id").cast("int").alias("hap")), spark.createDataFrame([(j, float(x), 100 * (j + 1)) for j, x in enumerate(morgans)], "j int, morgan double, bp long")


def test_mosaic_shape_and_determinism(spark):
    haps, m = mosaic_inputs(spark, 25, MAP)
    donors = spark.createDataFrame([(d, j, a) for d, row in enumerate(DONORS) for j, a in enumerate(row)], "donor int, j int, allele int")
    one = mosaic.haplotype_alleles(mosaic.donor_paths(haps, m, 3, 100.0, 7), donors)
    two = mosaic.haplotype_alleles(mosaic.donor_paths(haps.repartition(3), m, 3, 100.0, 7), donors)
    assert one.count() == 125 and one.exceptAll(two).isEmpty()
    assert {r.allele for r in one.select("allele").distinct().collect()} <= {0, 1}
    other = mosaic.haplotype_alleles(mosaic.donor_paths(haps, m, 3, 100.0, 8), donors)
    assert not one.exceptAll(other).isEmpty()
    d = mosaic.diploid(one).agg(F.min("d"), F.max("d")).first()
    assert 0 <= d[0] <= d[1] <= 2


def test_rate_zero_never_switches(spark):
    haps, m = mosaic_inputs(spark, 25, MAP)
    p = mosaic.donor_paths(haps, m, 3, 0.0, 7)
    assert p.agg(F.sum("switched")).first()[0] == 0
    assert p.groupBy("hap").agg(F.count_distinct("donor").alias("n")).where("n <> 1").isEmpty()


def test_switch_rate_and_successive_donors(spark):
    haps, m = mosaic_inputs(spark, 5000, [0, 0.1])
    p = mosaic.donor_paths(haps, m, 3, 10.0, 11)
    assert abs(p.where("j = 1").agg(F.avg("switched")).first()[0] - (1 - np.exp(-1))) < 0.03
    assert ordered.successive_differ(p).first()[0] == 0
    counts = [r["count"] for r in p.where("j = 0").groupBy("donor").count().collect()]
    assert len(counts) == 3 and max(counts) - min(counts) < 300


def test_a_block_is_a_partition_of_the_same_function(spark):
    haps, m = mosaic_inputs(spark, 20, MAP)
    whole = mosaic.donor_paths(haps, m, 3, 25.0, 5)
    halves = mosaic.donor_paths(haps.where("hap < 9"), m, 3, 25.0, 5).union(mosaic.donor_paths(haps.where("hap >= 9"), m, 3, 25.0, 5))
    assert whole.exceptAll(halves).isEmpty()
    cut = m.withColumn("block", F.when(F.col("j") < 2, 1).otherwise(2))
    assert whole.exceptAll(mosaic.donor_paths(haps, cut, 3, 25.0, 5)).isEmpty()
    one = mosaic.block_paths(haps, mosaic.map_steps(cut).where("block = 2"), mosaic.block_offsets(haps, cut, 3, 25.0, 5), 3, 25.0, 5)
    assert one.exceptAll(whole.where("j >= 2")).isEmpty() and one.count() == 60


def test_a_chromosome_begins_a_new_tract(spark):
    haps, m = mosaic_inputs(spark, 50, [0, 0.1, 0, 0.1])
    m = m.withColumn("chr", F.when(F.col("j") < 2, "1").otherwise("2"))
    p = mosaic.donor_paths(haps, m, 5, 0.0, 5)
    assert {r.segment for r in p.where("j >= 2").collect()} == {1} and p.agg(F.sum("switched")).first()[0] == 0


def test_mosaic_inputs_are_checked(spark):
    _, m = mosaic_inputs(spark, 1, MAP)
    good = spark.createDataFrame([(0, 0, 1)], "hap int, j int, allele int")
    mosaic.check_inputs(good, m, 1, 1.0)
    with pytest.raises(PanelError, match="binary"):
        mosaic.check_inputs(good.withColumn("allele", F.lit(2)), m, 1, 1.0)
    with pytest.raises(PanelError, match="binary"):
        mosaic.check_inputs(good.withColumn("allele", F.lit(None).cast("int")), m, 1, 1.0)
    with pytest.raises(PanelError, match="monotone"):
        mosaic.check_inputs(good, m.withColumn("morgan", -F.col("morgan")), 1, 1.0)
    with pytest.raises(PanelError, match="rate"):
        mosaic.check_inputs(good, m, 1, -1.0)


def test_donor_overlap_by_hand(spark):
    # four haplotypes: markers 0-2, then 3-4; donors 1,2 / 1,3 / 1,4 / 2,4
    rows = [(h, s, d, a, b) for h, pair in enumerate([(1, 2), (1, 3), (1, 4), (2, 4)]) for s, (d, (a, b)) in enumerate(zip(pair, [(0, 2), (3, 4)]))]
    segs = spark.createDataFrame(rows, "hap int, segment int, donor int, start_j int, end_j int")
    m = spark.createDataFrame([(j, j / 100, 100 * (j + 1)) for j in range(5)], "j int, morgan double, bp long")
    for block in (64, 2):
        got = overlap.individual_overlap(segs, m, 2, block).collect()
        assert len(got) == 1
        assert abs(got[0].mean_overlap - 0.3) < 1e-12 and abs(got[0].max_overlap - 0.6) < 1e-12
        assert abs(got[0].longest_morgan - 0.02) < 1e-12 and got[0].longest_bp == 200
        pairs = spark.createDataFrame([(0, 1)], "i1 int, i2 int")
        row = overlap.sampled_longest(segs, m, pairs, block).first()
        assert (round(row.mean_overlap, 9), round(row.max_overlap, 9), round(row.longest_morgan, 9), row.longest_bp) == (0.3, 0.6, 0.02, 200)
    cells = mosaic.segments_to_donors(segs, 4, 5)
    assert cells.count() == 20
    with pytest.raises(PanelError, match="gaps"):
        mosaic.segments_to_donors(segs.where("not (hap = 0 and segment = 1)"), 4, 5)
    with pytest.raises(PanelError, match="overlap"):
        mosaic.segments_to_donors(segs.union(segs.limit(1)), 4, 5)
    with pytest.raises(PanelError, match="foreign"):
        mosaic.segments_to_donors(segs, 3, 5)


def test_single_marker_tract_has_no_length_unless_counted_to_the_next(spark):
    p = spark.createDataFrame([(0, 0, 0, 1, 0), (0, 1, 1, 2, 1), (0, 2, 1, 1, 2)], "hap int, j int, switched int, donor int, segment int")
    m = spark.createDataFrame([(0, 0.0, 1), (1, 0.1, 11), (2, 0.3, 31)], "j int, morgan double, bp long")
    closed = [r.morgan for r in mosaic.segments(p, m).orderBy("segment").collect()]
    to_next = [round(r.morgan, 9) for r in mosaic.segments(p, m, "to_next").orderBy("segment").collect()]
    assert closed == [0, 0, 0] and to_next == [0.1, 0.2, 0.0]


def test_copy_rate(spark):
    df = spark.createDataFrame([(5.0, True), (10.0, True), (25.0, False)], "rate double, ok boolean")
    assert mosaic.select_copy_rate(df, "ok").first()[0] == 10.0
    assert mosaic.select_copy_rate(df.where("not ok"), "ok").first()[0] is None


def test_interpolation_clamps_and_averages_repeated_knots(spark):
    knots = spark.createDataFrame([("a", 0.0, 1.0), ("a", 10.0, 3.0), ("a", 10.0, 5.0), ("b", 5.0, 7.0)], "chr string, x double, y double")
    asked = spark.createDataFrame([(1, "a", -5.0), (2, "a", 5.0), (3, "a", 10.0), (4, "a", 99.0), (5, "b", 1.0), (6, "c", 1.0), (7, "a", None)], "id int, chr string, x double")
    for buckets in (1024, 3):
        got = {r.id: r.y for r in ordered.interpolate(asked, knots, ["chr"], buckets=buckets).collect()}
        assert got == {1: 1.0, 2: 2.5, 3: 4.0, 4: 4.0, 5: 7.0, 6: None, 7: None}
    rng = np.random.default_rng(2)
    x, y, q = np.sort(rng.random(200)), rng.random(200), rng.random(500) * 1.2 - 0.1
    k = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    got = ordered.interpolate(spark.createDataFrame([(n, float(v)) for n, v in enumerate(q)], "n int, x double"), k, []).orderBy("n").collect()
    assert np.allclose([r.y for r in got], np.interp(q, x, y))


def test_half_even_places(spark):
    import math

    # 1, 3.5, 6: the middle one goes to the even neighbour
    assert {r.place for r in sampling.systematic_round(spark, 6, 3).collect()} == {1, 4, 6}
    assert {r.place for r in sampling.systematic_round(spark, 4, 3).collect()} == {1, 2, 4}
    assert {r.place for r in sampling.systematic_floor(spark, 10, 4).collect()} == {math.floor(1 + i * 3) for i in range(4)}
    assert [r.place for r in sampling.systematic_round(spark, 9, 1).collect()] == [1]


def test_subsets_do_not_depend_on_partitions(spark):
    ids = spark.range(100).withColumnRenamed("id", "k")
    a, b = sampling.seeded_subsets(ids, "k", 10, 3, 1), sampling.seeded_subsets(ids.repartition(7), "k", 10, 3, 1)
    assert a.exceptAll(b).isEmpty() and a.count() == 30
    assert sampling.sampled_pairs(spark, 10, 20, 3).distinct().count() == 20


def test_first_match_keeps_left_rows_and_takes_the_first(spark):
    left = spark.createDataFrame([(0, "a"), (1, "b"), (2, "z")], "i int, iid string")
    right = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, None)], "iid string, line int, trait string")
    got = {r.iid: (r.trait, r.line) for r in phenotype.first_match(left, right, "iid", "line").collect()}
    assert got == {"a": ("early", "1"), "b": ("NA", "1"), "z": ("NA", "NA")}


def test_trait_statistics_of_text(spark):
    wide = spark.createDataFrame([("x", "1", "NA"), ("y", " 3 ", "2"), ("z", "oops", None)], "id string, `HDL-C` string, `HDL-C/LDL-C` string")
    got = {r.trait: r for r in phenotype.trait_statistics(phenotype.traits_long(wide, ["id"]), "trait").collect()}
    assert (got["HDL-C"].total, got["HDL-C"].nonmissing, got["HDL-C"].mean) == (3, 2, 2.0)
    assert (got["HDL-C/LDL-C"].missing, got["HDL-C/LDL-C"].sd) == (2, None)


def test_gates_fail_on_null_and_on_one_bad_replicate(spark):
    good = dict(hard_calls=True, n_samples=5, expected_samples=5, n_markers=7, expected_markers=7, markers_in_order=True, maf_correlation=0.99, mean_maf_difference=0.001, heterozygosity_difference=0.002, ld_ratio_0_10kb=[1.0, 1.1], ld_ratio_10_50kb=[0.9], ld_ratio_50_100kb=[1.2], ld_score_ratio=[1.0], effective_rank_ratio=[1.0], largest_eigenvalue_ratio=[0.8], pca_rms_z=[0.1, 0.25], duplicated=0, first_degree_rate=0.0, first_degree_limit=0.0, mz_rate=0.0, mz_limit=0.0, round_trip=True)
    rows = [dict(good, ancestry="good"), dict(good, ancestry="bad", ld_ratio_0_10kb=[1.0, 1.3], maf_correlation=None, pca_rms_z=[0.1, 0.26])]
    out = gates.evaluate(spark.createDataFrame(rows))
    assert out.count() == 26
    v = {r.ancestry: (r.passed, r.worst) for r in gates.verdict(out, "ancestry").collect()}
    assert v == {"good": (True, ""), "bad": (False, "ld_below_100kb,maf_correlation,pca_displacement")}
    seen = []
    with pytest.raises(PanelError, match="maf_correlation"):
        gates.stop_unless_passed(out, seen.append)
    assert len(seen) == 1 and len(gates.judged_by_median()) == 6
    loose = spark.createDataFrame([dict(good, ancestry="a", ld_ratio_0_10kb=[1.0, 1.3, 1.1], pca_rms_z=[0.1, 0.3, 0.4, 0.2, 0.3])])
    got = {r.gate: r["pass"] for r in gates.evaluate(loose, gates.judged_by_median()).collect()}
    assert got == {"ld_below_100kb": True, "effective_rank": True, "largest_eigenvalue": True, "close_related_pairs": True, "pca_displacement": False, "replicate_consistency": True}
    assert loose.select(gates.pca_band()).first()[0] == "borderline"


def test_two_kinds_of_mean_difference(spark):
    a = spark.createDataFrame([(0, 0.1), (1, 0.3)], "j int, maf double")
    b = spark.createDataFrame([(0, 0.3), (1, 0.1)], "j int, maf double")
    row = agreement.maf_agreement(a, b).first()
    assert abs(row.mean_abs_difference - 0.2) < 1e-12 and row.abs_difference_of_means < 1e-12 and abs(row.correlation + 1) < 1e-9
    flat = a.withColumn("maf", F.lit(0.2))
    assert agreement.maf_agreement(a, flat).first().correlation is None


def test_swapped_alleles_are_equal(spark):
    a = spark.createDataFrame([(0, 1, 2), (1, 0, 0), (2, 1, 1)], "i int, a1 int, a2 int")
    b = spark.createDataFrame([(0, 2, 1), (1, 0, 0), (3, 1, 1)], "i int, a1 int, a2 int")
    row = integrity.pair_equivalence(a, b, "i").first()
    assert (row.differences, row.compared) == (2, 4)


def test_metric_vector_of_a_panel_against_itself(spark, small):
    from panelweave.operators import validation

    df = calls_of(spark, small)
    m = spark.createDataFrame([(j, 5_000 * j) for j in range(12)], "j int, bp long")
    maf = genotype.marker_stats(df).select("j", "maf")
    row = validation.dataset_metrics(df, m, maf, df).first()
    assert abs(row.maf_correlation_with_full_reference - 1) < 1e-9 and row.max_maf_absolute_difference == 0
    assert row.monomorphic_markers == 1 and row.genotype_missingness == 0 and row.pca_centroid_rms_z < 1e-9
    assert sum(row[f"pairs_{n}"] for n in validation.BIN_NAMES.values()) == 66
    assert row.kinship_pairs == 435
    v = validation.validate_panel("x", df, df, m, maf, 30, 12, 3, 2, 2, 30)
    got = {r.gate: r["pass"] for r in v.gates.collect()}
    assert len(got) == 13 and all(got.values()), got
    bad = validation.validate_panel("x", df.where("i > 0"), df, m, maf, 30, 12, 3, 1, 1, 25)
    assert not {r.gate: r["pass"] for r in bad.gates.collect()}["dimensions_hard_calls"]


def test_replicates_together_equal_each_alone(spark, small):
    from panelweave.operators import validation

    df = calls_of(spark, small)
    m = spark.createDataFrame([(j, 4000 * j) for j in range(12)], "j int, bp long")
    maf = genotype.marker_stats(df).select("j", "maf")
    some = spark.createDataFrame([(r, i) for r in range(2) for i in range(30) if (i + r) % 3], "replicate int, i int")
    together = {r.replicate: r.asDict() for r in validation.subset_metrics(df, some, m, maf, df).collect()}
    assert sorted(together) == [0, 1]
    for r, got in together.items():
        own = df.join(some.where(F.col("replicate") == r).select("i"), "i", "left_semi")
        alone = validation.dataset_metrics(own, m, maf, df).first().asDict()
        assert got.pop("replicate") == r and set(got) == set(alone)
        for name, value in alone.items():
            assert got[name] == (None if value is None else pytest.approx(value, rel=1e-9, abs=1e-12)), name


def test_statistics_of_populations_and_of_all_are_one_aggregate(spark):
    rows = [("t", "a", "1"), ("t", "a", "3"), ("t", None, "8"), ("u", "a", "x")]
    out = phenotype.statistics_by_population(spark.createDataFrame(rows, "trait string, population string, value string"), "population")
    got = {(r.trait, r.population): (r.total, r.nonmissing, r["mean"]) for r in out.collect()}
    # a population without a name is a group beside all
    assert got == {("t", "a"): (2, 2, 2.0), ("t", None): (1, 1, 8.0), ("t", "all"): (3, 3, 4.0), ("u", "a"): (1, 0, None), ("u", "all"): (1, 0, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Union" not in plan and plan.count("Aggregate") == 1


def test_additive_fingerprints_of_blocks_add_up(spark):
    rng = np.random.default_rng(8)
    calls = rng.integers(0, 3, (20, 30)).tolist()
    calls[7] = list(calls[3])
    df = calls_of(spark, calls)
    whole = genotype.fingerprint_parts(df, "i", "j")
    blocks = genotype.fingerprint_parts(df.where("j % 3 = 1"), "i", "j").unionByName(genotype.fingerprint_parts(df.where("j % 3 <> 1").orderBy(F.desc("j")), "i", "j"))
    key = lambda d: {tuple(r) for r in d.collect()}
    assert key(genotype.add_parts(blocks, "i")) == key(whole.select("i", "places", "f0", "f1", "f2", "f3"))
    first = {r.i: (r["first"], r.size) for r in genotype.first_of_identical(df, "i", "j").collect()}
    assert {i: v for i, v in first.items() if v[1] > 1} == {3: (3, 2), 7: (3, 2)}
    assert "collect_list" not in genotype.identical_pairs(df)._jdf.queryExecution().optimizedPlan().toString()


def test_equal_fingerprints_of_different_calls_are_an_error(spark, monkeypatch):
    df = calls_of(spark, [[0, 1, 2], [0, 1, 2], [2, 1, 0]])
    monkeypatch.setattr(genotype, "fingerprints", lambda calls, by, along, within=(): calls.select(by).distinct().withColumn("fingerprint", F.lit("same")))
    with pytest.raises(Exception, match="equal fingerprints of different calls"):
        genotype.duplicated_rows(df).collect()
