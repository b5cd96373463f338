import itertools
import random
import re

from pyspark.sql import functions as F

from ridgeway.operators import graph as G
from ridgeway.operators import reshape as R
from ridgeway.operators import segment as M
from ridgeway.operators import triangles as T
from ridgeway.operators.aggregates import flag_max, indicator, lookup_label
from ridgeway.operators.cohort import complete_with_cohort, restrict_to_cohort


# -- cohort -----------------------------------------------------------------
def test_duplicate_cohort_numbers_do_not_multiply_rows(spark, rows):
    cohort = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "phone string")
    events = spark.createDataFrame([("1", 10), ("1", 11), ("3", 12), (None, 13)], "msisdn string, v int")
    assert rows(restrict_to_cohort(events, cohort)) == [("1", 10), ("1", 11)]


def test_numeric_cohort_and_malformed_numbers_do_not_raise(spark, rows):
    cohort = spark.createDataFrame([(1,), (2,)], "phone long")
    events = spark.createDataFrame([("1", 10), ("x", 11)], "msisdn string, v int")
    assert rows(restrict_to_cohort(events, cohort)) == [("1", 10)]


def test_complete_keeps_members_without_activity(spark, rows):
    cohort = spark.createDataFrame([("1",), ("1",), ("2",)], "phone string")
    profile = spark.createDataFrame([("1", 10)], "msisdn string, v int")
    assert rows(complete_with_cohort(profile, cohort)) == [("1", 10), ("2", None)]


# -- reshape ----------------------------------------------------------------
def test_two_sided_swaps_the_parties(spark, rows):
    frame = spark.createDataFrame([("a", "b", 5.0)], "s string, r string, v double")
    sides = R.two_sided(
        frame,
        {"own": F.col("s"), "other": F.col("r"), "is_send": F.lit(1)},
        {"own": F.col("r"), "other": F.col("s"), "is_send": F.lit(0)},
        ["v"],
    )
    assert rows(sides) == [(5.0, "a", "b", 1), (5.0, "b", "a", 0)]


def test_transfer_sides_carry_zero_on_the_other_side(spark, rows):
    frame = spark.createDataFrame([("a", "b", 5.0)], "s string, r string, v double")
    assert rows(R.transfer_sides(frame, "s", "r", "v")) == [("a", 0.0, 5.0), ("b", 5.0, 0.0)]


def test_explode_contacts_skips_null_and_repeats(spark, rows):
    frame = spark.createDataFrame(
        [(1, "a", "b"), (2, "a", "a"), (3, None, "c"), (4, None, None)], "i int, x string, y string"
    )
    got = rows(R.explode_contacts(frame, [F.col("x"), F.col("y")]), "i", "msisdn")
    assert got == [(1, "a"), (1, "b"), (2, "a"), (3, "c")]


def test_union_all_matches_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(R.union_all(a, b, a)) == [(1, "x"), (1, "x"), (2, "y")]


# -- aggregates -------------------------------------------------------------
def test_flag_max_reads_null_as_zero(spark, rows):
    frame = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "k string, f int")
    assert rows(flag_max(frame, ["k"], ["f"])) == [("a", 1), ("b", 0)]
    assert [r[0] for r in frame.select(indicator(F.col("f") == 1)).collect()] == [0, 1, 0]


def test_lookup_label_keeps_unmatched_rows(spark, rows):
    frame = spark.createDataFrame([("1", 5), ("9", 6)], "c string, v int")
    codes = spark.createDataFrame(
        [("1", "LIST", "one"), ("1", "OTHER", "no")], "lv_code string, lv_name string, lv_label string"
    )
    assert rows(lookup_label(frame, codes, "c", "LIST", "label")) == [("1", 5, "one"), ("9", 6, None)]


# -- graph ------------------------------------------------------------------
EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "b"), ("c", "c"), ("c", "d"), ("e", "a")]


def edge_frame(spark, edges, schema="src string, dst string"):
    return spark.createDataFrame(edges, schema)


def triangles_by_hand(edges):
    ends = {tuple(sorted(e)) for e in edges if e[0] != e[1]}
    vertices = sorted({v for e in edges for v in e})
    counts = dict.fromkeys(vertices, 0)
    for trio in itertools.combinations(vertices, 3):
        if all(tuple(sorted(pair)) in ends for pair in itertools.combinations(trio, 2)):
            for v in trio:
                counts[v] += 1
    return counts


def test_triangles_ignore_direction_loops_and_parallel_edges(spark):
    frame = edge_frame(spark, EDGES)
    got = {r["id"]: r["n_triangles"] for r in T.with_triangles(G.vertices_of(frame), frame).collect()}
    assert got == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 0}


def test_triangles_with_busy_vertices_equal_brute_force(spark):
    chooser = random.Random(5)
    # vertex 0 is an end of a third of all edges
    edges = [(0, v) for v in range(1, 40)]
    edges += [(chooser.randrange(40), chooser.randrange(40)) for _ in range(90)]
    frame = edge_frame(spark, edges, "src int, dst int")
    expected = triangles_by_hand(edges)
    for rows_per_cell in (10, 40, 10**6):
        counted = T.with_triangles(G.vertices_of(frame), frame, edges_per_cell=rows_per_cell)
        assert {r["id"]: r["n_triangles"] for r in counted.collect()} == expected
    assert sum(expected.values()) % 3 == 0


def test_grid_side_grows_with_the_root_of_the_edges():
    assert [T.grid_side(n, 100) for n in (0, 1, 33, 133, 134, 10**4)] == [2, 2, 2, 2, 3, 18]


def test_no_neighbour_list_is_shuffled(spark):
    edges = [(0, v) for v in range(1, 40)] + [(a, b) for a in range(50, 60) for b in range(a)]
    counted = T.triangle_counts(edge_frame(spark, edges, "src int, dst int"), edges_per_cell=50)
    counted.collect()
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in text
    # what an exchange takes stands in the lines below it, up to the next exchange
    for part in re.split(r"Exchange hashpartitioning", text)[1:]:
        below = re.split(r"(?:Exchange|AQEShuffleRead|ShuffleQueryStage)", part.split("\n", 1)[1])[0]
        first = below.strip().split("\n")[0]
        assert "from_u" not in first and "from_v" not in first, first


def test_separate_graphs_stay_apart(spark, rows):
    frame = spark.createDataFrame(
        [(1, "a", "b"), (1, "b", "c"), (1, "c", "a"), (2, "a", "b"), (2, "b", "c"), (3, "c", "a")],
        "g int, src string, dst string",
    )
    assert rows(T.triangle_counts(frame, ["g"])) == [(1, "a", 1), (1, "b", 1), (1, "c", 1)]


def test_vertices_are_distinct_and_weights_balance(spark, rows):
    raw = spark.createDataFrame([(*e, float(i)) for i, e in enumerate(EDGES)], "src string, dst string, v double")
    assert rows(G.vertices_of(raw)) == [("a",), ("b",), ("c",), ("d",), ("e",)]
    edges = G.aggregate_edges(raw, F.col("src"), F.col("dst"), {"w": F.sum("v")})
    assert edges.count() == 6
    total = edges.agg(F.sum("w")).first()[0]
    assert G.inbound(edges, "w").agg(F.sum("sum_in")).first()[0] == total
    assert G.outbound(edges, "w").agg(F.sum("sum_out")).first()[0] == total


def test_in_out_profile_needs_both_directions(spark, rows):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 5.0), ("d", "b", 3.0)], "src string, dst string, w double")
    got = rows(G.in_out_profile(edges, "w"))
    assert got == [("b", 4.0, 3.0, 1.0, 2.0, 2, 2, 5.0, 5.0, 5.0, 5.0, 1, 1)]


def test_degrees_cover_one_sided_vertices(spark, rows):
    edges = edge_frame(spark, [("a", "b"), ("a", "c"), ("b", "b")])
    assert rows(G.degrees(edges)) == [("a", 0, 2), ("b", 2, 1), ("c", 1, 0)]


def test_received_statistics_come_from_received_edges(spark):
    # as written, the received side repeated the sent side
    edges = spark.createDataFrame(
        [("a", "b", 1), ("a", "c", 3), ("b", "a", 10)], "src string, dst string, w long"
    )
    row = {r["id"]: r for r in G.peer_statistics(edges, edges, "w", "x").collect()}["a"]
    assert (row["n_peers_x_out"], row["sum_x_out"]) == (2, 4)
    assert (row["n_peers_x_in"], row["sum_x_in"]) == (1, 10)


# -- segments ---------------------------------------------------------------
def test_nearest_centroid_lowest_label_wins_a_tie(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (4.9, 0.0), (5.0, 0.0), (10.0, 1.0)], "x double, y double")
    label = M.nearest_centroid(["x", "y"], {1: [10.0, 0.0], 0: [0.0, 0.0]})
    assert [r[0] for r in frame.select(label).collect()] == [0, 0, 0, 1]


def test_split_by_mean_sides_and_ties(spark):
    data = [(label, v) for label in range(7) for v in (1.0, 2.0, 3.0)]
    frame = M.split_by_mean(spark.createDataFrame(data, "label int, v double"), "v")
    got = {(r["label"], r["v"]): r["categorie"] for r in frame.collect()}
    expected = {
        0: ("S11", "S11", "S41"), 4: ("S21", "S21", "S32"), 5: ("S22", "S12", "S12"),
        3: ("S42", "S42", "S51"), 1: ("S61", "S31", "S31"), 6: ("S52", "S52", "S72"),
        2: ("S71", "S71", "S71"),
    }
    for label, categories in expected.items():
        assert tuple(got[label, v] for v in (1.0, 2.0, 3.0)) == categories
    clusters = frame.select(M.cluster_of(F.col("categorie")).alias("c"), "categorie").collect()
    assert all(r["c"] == r["categorie"][1] for r in clusters)


def test_split_by_mean_per_period(spark, rows):
    data = [(0, "m1", 1.0), (0, "m1", 3.0), (0, "m2", 30.0), (0, "m2", 10.0)]
    frame = M.split_by_mean(spark.createDataFrame(data, "label int, p string, v double"), "v", ["p"])
    assert rows(frame, "v", "categorie") == [(1.0, "S11"), (10.0, "S11"), (3.0, "S41"), (30.0, "S41")]


def test_fit_centroids_finds_separate_clumps(spark):
    data = [(float(100 * c + i % 3), None if i == 0 else 1.0) for c in range(3) for i in range(20)]
    frame = spark.createDataFrame(data, "x double, y double")
    centres = M.fit_centroids(frame, ["x", "y"], k=3, seed=2)
    assert sorted(round(c[0] / 100) for c in centres.values()) == [0, 1, 2]


def test_trained_model_scores_like_its_centroids(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    data = [(float(50 * (i % 3) + i % 7), float(i % 5)) for i in range(60)]
    frame = spark.createDataFrame(data, "x double, y double")
    assembled = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(frame)
    model = KMeans(k=3, seed=4).fit(assembled)
    centres = {i: list(c) for i, c in enumerate(model.clusterCenters())}
    scored = M.predict_with_model(frame, ["x", "y"], model)
    labelled = M.assign_labels(scored.withColumnRenamed("label", "model"), ["x", "y"], centres)
    assert labelled.where("model <> label").count() == 0


def test_standardise(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert [tuple(r) for r in M.standardise(frame, ["x", "y"]).orderBy("x").collect()] == [
        (-1.0, 0.0),
        (1.0, 0.0),
    ]
