"""Group, ordered and sequence operators against brute force, hot groups included."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hilvan.operators import groups as G
from hilvan.operators import ordered as O
from hilvan.operators import sequence as S
from hilvan.operators.ports import consolidate, consolidated_lists
from hilvan.plans.history import responsible


def skewed(n=900, seed=3):
    """A third of all rows in one group."""
    r = random.Random(seed)
    return [("hot" if r.random() < 0.34 else f"k{r.randrange(40)}", r.choice("abcde"), i, r.randrange(60)) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, seq bigint, n bigint").repartition(5)


def test_majority_ties_go_to_the_first_seen(spark, df, rows):
    by_key = defaultdict(list)
    for k, v, *_ in rows:
        by_key[k].append(v)
    expected = {k: (*Counter(vs).most_common(1)[0], len(vs), len(set(vs))) for k, vs in by_key.items()}
    got = {r.k: (r.majority, r.votes, r.total, r.kinds) for r in G.majority(df, ["k"], "v", ["seq"]).collect()}
    assert got == expected
    tie = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "a", 3), ("g", "b", 4)], "k string, v string, seq int")
    assert G.majority(tie, ["k"], "v", ["seq"]).first().majority == "b"


def test_minority_rows(df, rows):
    best = {r.k: r.majority for r in G.majority(df, ["k"], "v", ["seq"]).collect()}
    expected = sorted(seq for k, v, seq, _ in rows if v != best[k])
    assert sorted(r.seq for r in G.minority_rows(df, ["k"], "v", ["seq"]).collect()) == expected


@pytest.mark.parametrize("part_bytes", [1, 7, 100, 1 << 20])
def test_ordered_text_is_whole_for_any_part_size(df, rows, part_bytes):
    out = G.ordered_text(df, ["k"], F.col("v"), [F.col("seq")], "-", part_bytes)
    got = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.k, r.part)):
        start = len("-".join(got[r.k]).encode()) + (len(got[r.k]) > 0)
        assert r.part == start // part_bytes
        assert len(r.text.encode()) < part_bytes + max(len(v) for _, v, *_ in rows) + 1
        got[r.k].append(r.text)
    expected = defaultdict(list)
    for k, v, *_ in rows:
        expected[k].append(v)
    assert {k: "-".join(parts) for k, parts in got.items()} == {k: "-".join(vs) for k, vs in expected.items()}


def test_ordered_text_cases(spark):
    """Nulls leave no trace, null keys and equal rows are kept, a long entry isn't divided."""
    rows = [(None, "a", 1), (None, "a", 1), ("k", None, 1), ("k", "é" * 30, 2), ("k", "", 3), ("k", "z", 4), ("n", None, 1)]
    df = spark.createDataFrame(rows, "k string, v string, seq int")
    got = G.ordered_text(df, ["k"], F.col("v"), [F.col("seq")], ", ", 10).collect()
    assert {(r.k, r.part, r.entries, r.text) for r in got} == {
        (None, 0, 2, "a, a"), ("k", 0, 1, "é" * 30), ("k", 6, 2, ", z"),
    }
    assert G.ordered_text(df.limit(0), ["k"], F.col("v"), [F.col("seq")], ", ").collect() == []


def test_running_bytes_splits_a_hot_group(spark):
    """One group of equal dates lies in several chunks, and the sums run through them."""
    df = spark.range(5000).selectExpr("'hot' AS k", "DATE '2024-01-01' AS day", "id", "id % 3 AS size")
    out = G.running_bytes(df.repartition(7), ["k"], ["day", "id"], "size", "at").collect()
    assert [r["at"] for r in sorted(out, key=lambda r: r.id)] == [sum(i % 3 for i in range(n % 3)) + n // 3 * 3 for n in range(5000)]


def test_position_within(df, rows):
    out = G.position_within(df, ["k"], [F.col("n"), F.col("seq")], F.floor(F.col("n") / 7), "p")
    got = {r.seq: r.p for r in out.collect()}
    for key in {k for k, *_ in rows}:
        ordered = sorted((n, seq) for k, _, seq, n in rows if k == key)
        assert [got[seq] for _, seq in ordered] == list(range(1, len(ordered) + 1))


def test_first_and_last_wins(df, rows):
    last = {k: v for k, v, *_ in rows}
    first = {}
    for k, v, *_ in rows:
        first.setdefault(k, v)
    assert {r.k: r.v for r in G.last_wins(df, ["k"], ["seq"], ["v"]).collect()} == last
    assert {r.k: r.v for r in G.first_wins(df, ["k"], ["seq"], ["v"]).collect()} == first


@pytest.mark.parametrize("size", [3, 1000])
def test_carry_previous_and_total(df, rows, size):
    chunked = df.withColumn("c", F.floor(F.col("seq") / size))
    carried = O.carry_forward(
        chunked, ["k"], ["c"], ["seq"], {"a": F.when(F.col("v") == "a", F.col("seq"))},
        {"b": F.when(F.col("v") == "b", F.col("seq"))},
    )
    total = O.running_total(carried, ["k"], ["c"], ["seq"], F.col("n"), "t")
    prev = O.previous_value(total, ["k"], ["c"], ["seq"], F.col("v"), "p")
    got = {r.seq: (r.a, r.b, r.t, r.p) for r in prev.collect()}
    state = defaultdict(lambda: [None, None, 0, None])
    for k, v, seq, n in rows:
        st = state[k]
        if v == "a":
            st[0] = seq
        st[2] += n
        assert got[seq] == (st[0], st[1], st[2], st[3])
        if v == "b":
            st[1] = seq
        st[3] = v


@pytest.mark.parametrize("size", [4, 1000])
def test_collapse_repeats(df, rows, size):
    chunked = df.withColumn("c", F.floor(F.col("seq") / size))
    got = sorted(r.seq for r in O.collapse_repeats(chunked, ["k"], ["c"], ["seq"], ["v"]).collect())
    before, expected = {}, []
    for k, v, seq, _ in rows:
        if before.get(k) != v:
            expected.append(seq)
        before[k] = v
    assert got == expected


def test_first_open_block(spark):
    rows = [(1, "x", "o"), (2, "e", None), (3, "e", "o"), (4, "e", ""), (5, "f", ""), (6, "e", "")]
    df = spark.createDataFrame([("s", *r) for r in rows], "sheet string, seq int, element string, owner string")
    is_open = F.coalesce(F.trim("owner"), F.lit("")) == ""
    got = O.first_open_block(df.withColumn("c", F.lit(0)), ["sheet"], ["c"], ["seq"], "element", is_open)
    assert sorted(r.seq for r in got.collect()) == [2, 4]


def test_as_of(spark):
    objects = spark.createDataFrame([("d", 5, "o1"), ("d", 0, "o2"), ("d", 9, "o3"), (None, 4, "o4")], "k string, at int, id string")
    versions = spark.createDataFrame([("d", 5, "b", 2), ("d", 5, "a", 1), ("d", 2, "c", 3), ("e", 1, "z", 4)], "k string, at int, v string, seq int")
    got = O.as_of(objects, versions, ["k"], "at", ["v"], ["seq"])
    assert {r.id: r.v for r in got.collect()} == {"o1": "a", "o2": None, "o3": "a", "o4": None}


def test_as_of_one_hot_version(spark):
    """Without keys, and with most objects on one version."""
    objects = spark.range(3000).selectExpr("id", "if(id < 2500, 40, id % 100) AS at")
    versions = spark.range(10).selectExpr("id * 10 + 5 AS at", "'v' || id AS v")
    got = O.as_of(objects.repartition(9), versions, [], "at", ["v"]).collect()
    assert len(got) == 3000
    assert all(r.v == (f"v{(r['at'] - 5) // 10}" if r["at"] >= 5 else None) for r in got)


def test_responsible(spark):
    objects = spark.createDataFrame([(1, 5), (2, 0), (3, 9), (4, 20), (5, 30), (6, None)], "id long, version long")
    alternatives = spark.createDataFrame(
        [("gis", 5, 10, "b", 2), ("gis", 5, 11, "a", 1), ("other", 6, 99, "x", 3), ("gis", 9, 12, "c", 4), ("gis", 20, 77, "d", 5),
         ("gis", 30, None, "e", 6), ("gis", -1, 10, "never", 0)],
        "dataset_name string, version long, scheme_id long, alternative_name string, seq int")
    schemes = spark.createDataFrame(
        [(11, "n11", "o", "m", "t", "s", 1), (11, "n99", "o", "m", "t", "s", 2), (12, "n12", None, "m", "t", "s", 5)],
        "scheme_id long, name string, owner string, modified_by string, modified_at string, status string, project_id long")
    projects = spark.createDataFrame(
        [(1, "p1", "j", "g", "m", "t"), (None, "p", "j", "g", "m", "t")],
        "project_id long, name string, job_title string, owning_group string, modified_by string, modified_at string")
    got = {r.id: r for r in responsible(objects, alternatives, schemes, projects).collect()}
    assert {i: (r.estado, r.alternative_name, r.diseno, r.proyecto) for i, r in got.items()} == {
        1: ("COMPLETO", "a", "n11", "p1"), 2: ("SIN ALTERNATIVA", None, None, None), 3: ("SIN PROYECTO", "c", "n12", None),
        4: ("SIN SCHEME", "d", None, None), 5: ("SIN SCHEME", "e", None, None), 6: ("SIN ALTERNATIVA", None, None, None),
    }
    assert got[2].mensaje == "No se encontro alternativa para ds!version: 0"
    assert got[4].mensaje == "Scheme no encontrado para id: 77" and got[1].mensaje is None


def test_sequence(spark):
    numbers = {"A": [1, 2, 4, 9, 20], "B": [1, 1, 1, 5], "C": [7]}
    rows = [(g, n, i, f"{g}{i}") for g, ns in numbers.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "g string, n bigint, seq int, id string")
    pairs = S.first_two(df, ["g"], "n", ["seq"], ["id"])
    repeats = [(r.g, r.n, r.first.id, r.second.id) for r in S.repeated_numbers(pairs).collect()]
    assert repeats == [("B", 1, "B0", "B1")]
    numbers = S.distinct_numbers(df, ["g"], "n", ["seq"], ["id"])
    for source, size in ((pairs, 3), (pairs, 1000), (numbers, 3)):
        gaps = {(r.g, r.n, r.following, r.missing) for r in S.sequence_gaps(source, ["g"], "n", size).collect()}
        # The repeat in B does not switch off the check of A.
        assert gaps == {("A", 2, 4, "_3"), ("A", 4, 9, "_5 al _8"), ("A", 9, 20, "_10 al _19")}


def test_state_sequence(spark):
    rows = [("a", 1, "x"), ("a", 2, "on"), ("a", 3, "x"), ("a", 4, "on"), ("a", 5, "x"), ("b", 3, "x"), ("b", 2, "x"), ("c", 1, "on")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "g string, n int, s string, seq int")
    got = S.state_sequence(df, ["g"], "n", ["seq"], F.col("s") == "on", ["s"])
    assert {(r.g, r.n, r.last_number) for r in got.collect()} == {("a", 1, 4), ("a", 3, 4), ("b", 2, None)}


def test_similar_names(spark):
    names = ["ACME SAS", "ACME SAS", "Acme S.A.S.", "acme s a s", "OTRA", "otra.", "x sede", "X SEDE", None, ""]
    df = spark.createDataFrame([(str(i), n, i) for i, n in enumerate(names)], "id string, name string, seq int")
    got = {r.name: (r.best, r.ids) for r in G.similar_names(df, "name", "id", ["seq"]).collect()}
    assert got == {"Acme S.A.S.": ("ACME SAS", "2"), "acme s a s": ("ACME SAS", "3"), "otra.": ("OTRA", "5")}


def test_consolidate_copies_and_hot_group(spark):
    rows = [("a", "x", "3", 1), ("a", "x", "3", 2), ("a", "y", "10", 3), ("a", "x", "z", 4), (None, "q", None, 5), (None, "r", "2", 6)]
    df = spark.createDataFrame(rows, "k string, v string, n string, seq bigint")
    one = consolidate(df, {"v": "°", "n": "+"}, ["seq"], numeric="n")
    assert {(r.k, r.v, r.n, r.parte) for r in one.collect()} == {("a", "x°y", "3+3+10", 0), (None, "q°r", "2", 0)}
    short = consolidate(df, {"v": "°", "n": "+"}, ["seq"], numeric="n", part_bytes=2)
    assert {(r.k, r.v, r.n, r.parte) for r in short.collect()} == {("a", "x", "3", 0), (None, "q", "2", 0)}
    whole, lists = consolidated_lists(df, {"v": "°", "n": "+"}, ["seq"], numeric="n", part_bytes=4)
    got = whole.join(lists, "_key").collect()
    assert {(r.k, r.lista, r.part, r.entries, r.texto) for r in got} == {
        ("a", "v", 0, 2, "x°y"), ("a", "n", 0, 2, "3+3"), ("a", "n", 1, 1, "10"), (None, "v", 0, 2, "q°r"), (None, "n", 0, 1, "2"),
    }


def test_responsible_joins_versions_not_objects(spark):
    """The objects' rows meet only the carried versions: one scheme may stand behind nearly all of them."""
    objects = spark.createDataFrame([(i, 100 + i) for i in range(50)], "id long, version long")
    alternatives = spark.createDataFrame(
        [("gis", 5, 10, "a", 1)], "dataset_name string, version long, scheme_id long, alternative_name string, seq int")
    schemes = spark.createDataFrame(
        [(10, "n", "o", "m", "t", "s", 1)],
        "scheme_id long, name string, owner string, modified_by string, modified_at string, status string, project_id long")
    projects = spark.createDataFrame(
        [(1, "p", "j", "g", "m", "t")],
        "project_id long, name string, job_title string, owning_group string, modified_by string, modified_at string")
    df = responsible(objects, alternatives, schemes, projects)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert {(r.estado, r.diseno, r.proyecto) for r in df.collect()} == {("COMPLETO", "n", "p")}


def test_lists_of_one_part_need_no_running_sum(spark):
    df = spark.createDataFrame(
        [("a", i, f"x{i}") for i in range(9)] + [("b", 1, None), (None, 2, "n"), ("c", 1, ""), ("c", 0, "y")],
        "k string, n int, t string")
    lists = lambda size: G.ordered_text(df, ["k"], F.col("t"), [F.col("n")], ",", size)
    whole, mixed = lists(1000), lists(12)
    assert "Window" not in whole._jdf.queryExecution().optimizedPlan().toString()
    want = {"a": ",".join(f"x{i}" for i in range(9)), None: "n", "c": "y,"}
    assert {r.k: (r.part, r.text) for r in whole.collect()} == {k: (0, t) for k, t in want.items()}
    parts = sorted(mixed.collect(), key=lambda r: (str(r.k), r.part))
    assert [(r.part, r.entries) for r in parts if r.k == "a"] == [(0, 4), (1, 4), (2, 1)]
    assert {k: ",".join(r.text for r in parts if r.k == k) for k in want} == want


def _histories(spark, part_bytes):
    from hilvan.operators.reconcile import EVENT_COLUMNS, event_histories

    events = spark.range(300).selectExpr(*[
        {"n_acceso": "CAST(id % 7 AS STRING)", "anillo": "IF(id % 50 = 0, NULL, 'r')", "fecha": "CAST(1000 + id AS STRING)",
         "observacion": "IF(id % 3 = 0, NULL, concat('o', id))", "cambio": "IF(id % 4 = 0, concat('c', id), '')"}.get(c, "'x'")
        + f" AS {c}" for c in EVENT_COLUMNS
    ])
    return event_histories(events, part_bytes)


def _whole_histories():
    want = defaultdict(list)
    for i in range(300):
        if i % 50:
            want[str(i % 7), "historial_actividades"].append("x" + (f" (c{i})" if i % 4 == 0 else ""))
            want[str(i % 7), "historial_observaciones"].append(f"o{i}" if i % 3 else "")
    between = {"historial_actividades": " → ", "historial_observaciones": " | "}
    return {k: between[k[1]].join(v) for k, v in want.items()}, between


def test_lists_in_parts_are_shuffled_once(spark):
    """Both lists of an event go with its one row; before, rows were cut into chunks and joined for any list of several parts."""
    df = _histories(spark, 40)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
    assert plan.index("Generate") < plan.index("RepartitionByExpression")
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("longest", [1, 300, 700, 1 << 20])
def test_lists_longer_than_a_task_takes(spark, monkeypatch, longest):
    monkeypatch.setattr(G, "PART_BYTES", longest)
    monkeypatch.setattr(G, "SUMS", 3)
    want, between = _whole_histories()
    got = defaultdict(list)
    for r in sorted(_histories(spark, 40).collect(), key=lambda r: r.part):
        k = (r.n_acceso, r.lista)
        start = len(between[r.lista].join([*got[k], ""]).encode()) if got[k] else 0
        assert r.part == start // 40 and r.anillo == "r"
        got[k].append(r.texto)
    assert {k: between[k[1]].join(v) for k, v in got.items()} == want
