import pytest
from pyspark.sql import functions as F

from platelake.plans import packing
from tests.screens import site_frame, site_rows


def _files(plan):
    """{dest_path: ids in order}"""
    files = {}
    for row in sorted(plan.collect(), key=lambda r: (r.dest_path, r.pos)):
        files.setdefault(row.dest_path, []).append((row.pos, row.id_code, row.site))
    return files


def _ids(files):
    return {name: [m[1:] for m in members] for name, members in files.items()}


ROWS = site_rows(wells=10, sites=2)


def test_random_plan_is_deterministic(spark):
    sites = site_frame(spark, ROWS)
    one = _files(packing.plan_random(sites, 10))
    two = _files(packing.plan_random(sites.repartition(5).orderBy(F.rand()), 10))
    assert one == two
    assert len(one) == 4 and {len(v) for v in one.values()} == {10}


def test_random_plan_ignores_absent_splits(spark):
    both = _files(packing.plan_random(site_frame(spark, ROWS), 10))
    train = _files(packing.plan_random(
        site_frame(spark, [r for r in ROWS if r[1] == "train"]), 10))
    assert train == {k: v for k, v in both.items() if "train" in k}


def test_grouped_plan_is_deterministic(spark):
    sites = site_frame(spark, ROWS)
    one = _files(packing.plan_grouped(sites))
    assert one == _files(packing.plan_grouped(sites.repartition(7)))
    assert set(one) == {
        f"by_exp_plate_site-42/{e}_p1_s{s}" for e in ("RPE-01", "HUVEC-01") for s in (1, 2)}


def test_grouped_plan_ignores_other_groups(spark):
    both = _files(packing.plan_grouped(site_frame(spark, ROWS)))
    train = _files(packing.plan_grouped(
        site_frame(spark, [r for r in ROWS if r[1] == "train"])))
    assert train == {k: v for k, v in both.items() if "RPE" in k}


def test_plan_is_a_permutation_that_depends_on_the_seed(spark):
    rows = site_rows(datasets=("train",), wells=60, sites=2)
    files = {}
    for seed in (42, 7):
        plan = packing.plan_random(site_frame(spark, rows), 1000, seeds=(seed,))
        (members,) = _ids(_files(plan)).values()
        assert sorted(members) == sorted((r[0], r[8]) for r in rows)
        files[seed] = members
    assert files[42] != files[7]
    assert files[42] != sorted(files[42])


def test_last_file_is_short_and_numbers_widen(spark):
    rows = site_rows(datasets=("train",), wells=7)
    plan = packing.plan_random(site_frame(spark, rows), 3)
    assert [len(v) for _, v in sorted(_files(plan).items())] == [3, 3, 1]
    wells = [(str(i), "train", "RPE-01", "RPE", 1, "B02", "treatment", 1, 1) for i in range(1001)]
    names = {r.file for r in packing.plan_random(site_frame(spark, wells), 1)
             .select("file").collect()}
    assert {"001", "999", "1000", "1001"} <= names and len(names) == 1001


def test_plan_does_not_depend_on_shuffle_partitions(spark):
    sites = site_frame(spark, ROWS)
    one = _files(packing.plan_all(sites, per_file=7))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert one == _files(packing.plan_all(sites, per_file=7))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_copies_of_a_row_are_spread_and_all_kept(spark):
    rows = site_rows(datasets=("train",), wells=30)
    hot = rows[0]
    sites = site_frame(spark, rows).unionByName(
        spark.range(10_000).select(*[
            F.lit(v).cast(f.dataType).alias(f.name)
            for v, f in zip(hot, site_frame(spark, rows).schema)]))
    plan = packing.plan_random(sites, 100).cache()
    assert plan.count() == 10_030
    files = plan.groupBy("file").agg(F.count("*").alias("n"), F.min("pos").alias("a"),
                                     F.max("pos").alias("z"), F.countDistinct("pos").alias("d"))
    got = {r.file: (r.n, r.a, r.z, r.d) for r in files.collect()}
    assert got.pop("101") == (30, 1, 30, 30)
    assert set(got.values()) == {(100, 1, 100, 100)} and len(got) == 100
    # The 29 other sites are not next to each other: the copies are shuffled.
    others = plan.where(F.col("id_code") != hot[0]).select("file").distinct().count()
    assert others > 15


def test_controls_are_never_packed_and_names_are_checked(spark):
    rows = site_rows(wells=3)
    control = rows[0][:6] + ("negative_control",) + rows[0][7:]
    plan = packing.plan_all(site_frame(spark, rows[1:] + [control]))
    assert plan.where(F.col("id_code") == control[0]).count() == 0
    with pytest.raises(ValueError, match="by_plate"):
        packing.plan_all(site_frame(spark, rows), ["random", "by_plate"])
    with pytest.raises(ValueError, match="holdout"):
        packing.plan_all(site_frame(spark, rows), datasets=["holdout"])


def test_empty_input_gives_empty_plan(spark):
    assert packing.plan_all(site_frame(spark, [])).count() == 0


def test_manifest_and_mixed_files(spark):
    rows = site_rows(wells=6, sites=2)
    plan = packing.plan_all(site_frame(spark, rows), per_file=5, seeds=(42, 7))
    manifest = packing.manifest(plan).collect()
    assert sum(m.n_sites for m in manifest) == len(rows) * 4
    assert all(m.first_pos == 1 and m.last_pos == m.n_sites for m in manifest)
    assert packing.mixed_files(plan).count() == 0
    assert packing.plan_all(site_frame(spark, rows), ["random"], seeds=(7, 7)).count() == len(rows)
    twin = [r for r in rows if r[1] == "train"]
    twin += [(r[0], "test") + r[2:] for r in twin]
    mixed = packing.mixed_files(packing.plan_grouped(site_frame(spark, twin))).collect()
    assert [m.dest_path for m in mixed]


def test_no_window_runs_in_one_task(spark):
    plan = packing.plan_all(site_frame(spark, ROWS))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "SinglePartition" not in text
