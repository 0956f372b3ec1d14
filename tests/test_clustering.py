import random

from pyspark.sql import functions as F

from strataglean.operators import clustering


def _stats(spark, data):
    return spark.createDataFrame(data, clustering.STATS)


def test_stats_and_assignment(spark, rows):
    points = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [2.0, 4.0], 0)], "id int, features array<double>, cluster int")
    stats = clustering.cluster_stats(points)
    row = stats.first()
    assert (row["n"], row["sum"], [round(q, 9) for q in row["sumsq"]]) == (2, [2.0, 4.0], [4.0, 16.0])
    cs = _stats(spark, [(9, 2, [200.0, 200.0], [20002.0, 20002.0])])
    new = spark.createDataFrame([(3, [3.0, 2.0]), (4, [100.5, 100.0]), (5, [50.0, 50.0])], "id int, features array<double>")
    got = clustering.bfr_assign(new, stats, cs).withColumn("distance", F.round("distance", 6))
    assert [(r["id"], r["kind"], r["cluster"]) for r in got.orderBy("id").collect()] == [
        (3, "ds", 0), (4, "cs", 9), (5, "rs", -1)]
    assert got.filter("id = 3").first()["distance"] == 2.0


def test_merge_adds_near_summaries(spark, rows):
    cs = _stats(spark, [(1, 2, [0.0, 0.0], [2.0, 2.0]), (2, 2, [2.0, 2.0], [4.0, 4.0]), (3, 2, [200.0, 0.0], [20002.0, 2.0])])
    assert rows(clustering.bfr_merge(cs)) == [(1, 4, [2.0, 2.0], [6.0, 6.0]), (3, 2, [200.0, 0.0], [20002.0, 2.0])]
    ds = _stats(spark, [(0, 4, [0.0, 0.0], [4.0, 4.0])])
    assert rows(clustering.fold_into_ds(ds, cs)) == [(1, 0), (2, 0)]


def test_every_point_is_placed_once(spark):
    rng = random.Random(1)
    data = [(i, [rng.gauss(30.0 * (i % 3), 1), rng.gauss(0, 1)]) for i in range(300)]
    data += [(300 + i, [rng.uniform(-900, -500), rng.uniform(500, 900)]) for i in range(25)]
    points = spark.createDataFrame(data, "id bigint, features array<double>")
    rounds, labels = clustering.bfr(points, 3, chunks=2, seed=1)
    for r in rounds.collect():
        assert r["n_discard"] + r["n_cs_points"] + r["n_retained"] <= 325
    last = rounds.filter("round = 3").first()
    assert last["n_discard"] + last["n_cs_points"] + last["n_retained"] == 325
    got = labels.collect()
    assert sorted(r["id"] for r in got) == list(range(325))
    assert sum(r["cluster"] >= 0 for r in got) == last["n_discard"]


def test_summaries_in_blocks_give_the_same_assignment(spark, rows, monkeypatch):
    rng = random.Random(9)
    stats = _stats(spark, [(i, 2, [2 * x, 2 * y], [2 * x * x + 2, 2 * y * y + 2]) for i in range(30)
                           for x, y in [(rng.uniform(0, 40), rng.uniform(0, 40))]])
    points = spark.createDataFrame([(i, [rng.uniform(0, 40), rng.uniform(0, 40)]) for i in range(50)], "id int, features array<double>")
    want = rows(clustering.bfr_assign(points, stats.filter("cluster < 5"), stats.filter("cluster >= 5")), "id", "kind", "cluster", "distance")
    monkeypatch.setattr(clustering, "PACKED_NUMBERS", 12)
    assert rows(clustering.bfr_assign(points, stats.filter("cluster < 5"), stats.filter("cluster >= 5")), "id", "kind", "cluster", "distance") == want
