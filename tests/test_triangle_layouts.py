"""What the triangle count sends between tasks, and that its layouts agree."""

import itertools
import random
import re

import pytest

from ridgeway.operators import triangles as T


def ring(spark, n):
    """Every vertex with the next two: it lies on three triangles."""
    edges = [(v, (v + step) % n) for v in range(n) for step in (1, 2)]
    return spark.createDataFrame(edges, "src int, dst int")


def shuffled_rows(node):
    """Rows written by the exchanges of a plan that has run."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return shuffled_rows(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return shuffled_rows(node.plan())
    metrics, children = node.metrics(), node.children()
    own = metrics.apply("shuffleRecordsWritten").value() if metrics.contains("shuffleRecordsWritten") else 0
    return own + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_small_cells_send_rows_in_proportion_to_the_edges(spark):
    sent = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (200, 1800):
            counted = T.triangle_counts(ring(spark, n), edges_per_cell=20)
            assert {r["n_triangles"] for r in counted.collect()} == {3}
            sent.append(shuffled_rows(counted._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert 0 < sent[1] < 12 * sent[0], sent


@pytest.mark.parametrize("pairs", [0.0, float("inf")])
def test_signatures_and_grid_count_the_same_triangles(spark, rows, monkeypatch, pairs):
    chooser = random.Random(11)
    edges = [(g, chooser.randrange(30), chooser.randrange(30)) for g in (1, 2) for _ in range(150)]
    edges += [(3, a, b) for a in range(12) for b in range(a)]
    ends = {(g, *sorted(e)) for g, *e in edges if e[0] != e[1]}
    expected = {}
    for g in (1, 2, 3):
        for trio in itertools.combinations(range(30), 3):
            if all((g, *pair) in ends for pair in itertools.combinations(trio, 2)):
                for v in trio:
                    expected[g, v] = expected.get((g, v), 0) + 1
    monkeypatch.setattr(T, "_size", lambda oriented, by: (len(ends), pairs))
    counted = T.triangle_counts(spark.createDataFrame(edges, "g int, src int, dst int"), ["g"], edges_per_cell=20)
    assert rows(counted) == sorted(((*k, n) for k, n in expected.items()), key=repr)


def test_the_layout_with_fewer_rows_is_chosen(spark, monkeypatch):
    used = []
    for name in ("_by_grid", "_by_signature"):
        plain = getattr(T, name)
        monkeypatch.setattr(T, name, lambda *a, name=name, plain=plain: (used.append(name), plain(*a))[1])
    T.triangle_counts(ring(spark, 50), edges_per_cell=20)
    clique = spark.createDataFrame([(a, b) for a in range(150) for b in range(a)], "src int, dst int")
    T.triangle_counts(clique)
    assert used == ["_by_signature", "_by_grid"]


def test_lists_stay_in_their_task_in_a_session_with_default_settings(spark):
    """Without ``requireAllClusterKeysForCoPartition=false``, which the grid needs."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(setting, "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = T.triangle_counts(ring(spark, 300))
        assert {r["n_triangles"] for r in counted.collect()} == {3}
        text = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(setting, "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert "collect_list" in text
    for part in re.split(r"Exchange hashpartitioning", text)[1:]:
        below = re.split(r"(?:Exchange|AQEShuffleRead|ShuffleQueryStage)", part.split("\n", 1)[1])[0]
        first = below.strip().split("\n")[0]
        assert "from_u" not in first and "from_v" not in first, first
