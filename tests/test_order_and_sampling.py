"""Ordering, ranks, splits, balancing, synthetic rows, neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import neighbours, ordering, resample, splits, synthetic
from larkspur.operators.encode import label_encode
from larkspur.operators.ranking import rank_index


@pytest.fixture(scope="module")
def skewed(spark):
    """1,500 rows; one class holds most of them, one only a few."""
    kind = F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 4 == 0, "some").otherwise("most")
    return spark.range(1_500).withColumns({"kind": kind, "x": (F.xxhash64("id") % 1_000) / 10.0}).repartition(16)


def test_running_totals(spark, skewed):
    counted = skewed.groupBy("x").agg(F.count("*").alias("n"))
    got = {r["x"]: r["through"] for r in ordering.running_totals(counted, ["x"], {"through": "n"}).collect()}
    values = sorted((r["x"], r["n"]) for r in counted.collect())
    assert got == dict(zip([x for x, _ in values], np.cumsum([n for _, n in values]).tolist(), strict=True))


def test_positions(skewed):
    got = [r["position"] for r in ordering.with_position(skewed, ["id"]).orderBy("id").collect()]
    assert got == list(range(1_500))


def test_exact_quantiles(spark, skewed):
    holes = skewed.withColumns({"y": F.when(F.col("id") % 5 > 0, F.col("x")), "none": F.lit(None).cast("double")})
    shares = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = ordering.exact_quantiles(holes, ["x", "y", "none"], shares)
    for c in ("x", "y"):
        values = [r[c] for r in holes.select(c).collect() if r[c] is not None]
        assert got[c] == pytest.approx(np.quantile(values, shares).tolist())
    assert got["none"] == [None] * 5


def test_split_is_exact_disjoint_and_repeatable(spark, skewed):
    train, test = splits.random_split(skewed, ["id"], 0.2, 42)
    assert (train.count(), test.count()) == (1_200, 300)
    assert train.join(test, "id").count() == 0
    again = splits.random_split(skewed.coalesce(1), ["id"], 0.2, 42)[1]
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}
    other = splits.random_split(skewed, ["id"], 0.2, 7)[1]
    assert {r["id"] for r in other.collect()} != {r["id"] for r in test.collect()}


def test_stratified_split_keeps_shares(skewed):
    train, test = splits.stratified_split(skewed, "kind", ["id"], 0.2, 42)
    assert test.count() == 300
    parts = [{r["kind"]: r["count"] for r in d.groupBy("kind").count().collect()} for d in (train, test)]
    assert parts == [{"rare": 12, "some": 288, "most": 900}, {"rare": 3, "some": 72, "most": 225}]


def test_quotas_by_largest_remainder(spark):
    def quotas(sizes, wanted):
        classes = spark.createDataFrame(list(sizes.items()), "_class string, _total long")
        return {r["_class"]: r["_quota"] for r in splits.class_quotas(classes, wanted).collect()}

    assert quotas({"a": 50, "b": 30, "c": 21}, 10) == {"a": 5, "b": 3, "c": 2}
    assert quotas({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}


def test_any_number_of_classes(spark):
    rows = spark.range(60_000).select("id", (F.col("id") % 20_000).alias("kind"))
    train, test = splits.stratified_split(rows, "kind", ["id"], 0.34)
    assert test.count() == 20_400 and train.count() == 39_600
    assert test.select("kind").distinct().count() == 20_000
    assert resample.under_sample(rows.where("id < 59990"), "kind", ["id"]).count() == 40_000


def test_synthetic_keys_follow_one_rule_at_every_size(spark):
    rows = spark.range(500).select("id", (F.col("id") * 2).alias("x"))
    made = synthetic.synthetic_rows(rows, "k", ["x"], 70_000)
    few = synthetic.synthetic_rows(rows, "k", ["x"], 10)
    assert made.select("k").distinct().count() == 70_000
    assert few.select("k").subtract(made.select("k")).count() == 0


def test_too_small_class_raises(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, kind string")
    with pytest.raises(ValueError, match="fewer than 2"):
        splits.stratified_split(rows, "kind", ["id"])


def test_repeated_key_at_the_cut_raises(spark):
    rows = spark.range(90).select((F.col("id") % 3).alias("k"))
    with pytest.raises(ValueError, match="repeats"):
        splits.random_split(rows, ["k"], 0.5)


def test_folds_are_even(skewed):
    counts = splits.with_fold(skewed, "kind", ["id"], 5).groupBy("kind", "fold").count().collect()
    assert len(counts) == 15
    assert {(r["kind"], r["count"]) for r in counts} == {("rare", 3), ("some", 72), ("most", 225)}


def test_shares_are_nested(skewed):
    parts = splits.nested_shares(skewed, "kind", ["id"], [0.2, 0.6, 1.0])
    assert [parts.where(F.col("part") <= i).count() for i in range(3)] == [300, 900, 1_500]


def test_rows_at_ranks_are_the_sorted_rows(spark, skewed):
    index = rank_index(skewed, ["id"], 3)
    picks = spark.range(1_500).select(F.lit("all").alias("_class"), F.col("id").alias("_rank"))
    got = [r["id"] for r in index.at_ranks(picks).orderBy("_rank").collect()]
    hashed = skewed.withColumn("h", F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit("3"))))
    assert got == [r["id"] for r in hashed.orderBy("h").collect()]


def test_balancing(skewed):
    over = resample.over_sample(skewed, "kind", ["id"])
    assert {r["count"] for r in over.groupBy("kind").count().collect()} == {1_125}
    assert over.where("copy = 0").count() == 1_500
    assert over.select("id", "kind").distinct().count() == 1_500
    under = resample.under_sample(skewed, "kind", ["id"])
    assert {r["count"] for r in under.groupBy("kind").count().collect()} == {15}
    assert under.select("id").distinct().count() == 45


def test_synthetic_rows(skewed):
    got = synthetic.synthetic_rows(skewed, "key", ["kind", "x"], 500, 1)
    assert got.count() == got.select("key").distinct().count() == 500
    seen = {r["x"] for r in skewed.select("x").distinct().collect()}
    assert {r["x"] for r in got.collect()} <= seen
    share = got.where("kind = 'most'").count() / 500
    assert abs(share - 0.75) < 0.08


def test_label_encode_follows_the_text(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, v string")
    got = {r["id"]: r["v"] for r in label_encode(rows).collect()}
    assert got == {1: 2, 2: 1, 3: 0, 4: 2}


def _brute_force(points, k):
    ids, matrix = np.array([i for i, _ in points]), np.array([v for _, v in points])
    away = np.sqrt(((matrix[:, None, :] - matrix[None, :, :]) ** 2).sum(2))
    result = {}
    for i, own in enumerate(ids):
        order = sorted((round(float(away[i, j]), 9), ids[j]) for j in range(len(ids)) if j != i)
        result[int(own)] = [int(j) for _, j in order[:k]]
    return result


def test_nearest_with_many_cells_hot_cell_and_copies(spark, monkeypatch):
    """A third of the points are one dense clump, some are exact copies; cells and lists are cut small."""
    monkeypatch.setattr(neighbours, "_DATA_ROWS", 40)
    monkeypatch.setattr(neighbours, "_QUERY_ROWS", 70)
    monkeypatch.setattr(neighbours, "_PIVOTS", 6)
    monkeypatch.setattr(neighbours, "max", lambda a, b: 6 if (a, b) == (1, 0) else max(a, b), raising=False)
    rng = np.random.default_rng(5)
    clump = rng.normal(0, 0.01, (120, 3))
    spread = rng.normal(0, 5, (200, 3)).round(1)
    copies = np.repeat(spread[:1], 40, axis=0)
    points = [(i, v.tolist()) for i, v in enumerate(np.concatenate([clump, spread, copies]))]
    df = spark.createDataFrame(points, "id long, vector array<double>").repartition(8)
    text = df.withColumn("id", F.format_string("%03d", "id"))
    for table in (df, text):
        # Small Arrow batches, as with many rows.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        got: dict[int, list] = {}
        for r in neighbours.nearest(table, table, 4, same=True).orderBy("id", "rank").collect():
            got.setdefault(int(r["id"]), []).append(int(r["neighbour"]))
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == _brute_force(points, 4)


def test_nearest_between_tables_with_text_keys(spark):
    data = spark.createDataFrame([("a", [0.0]), ("b", [1.0]), ("c", [5.0])], "id string, vector array<double>")
    asked = spark.createDataFrame([(1, [0.9]), (2, [4.0])], "id int, vector array<double>")
    got = {(r["id"], r["rank"]): r["neighbour"] for r in neighbours.nearest(asked, data, 2).collect()}
    assert got == {(1, 1): "b", (1, 2): "a", (2, 1): "c", (2, 2): "b"}


def test_neighbours_visit_few_cells(spark, monkeypatch):
    """A data row travels for the lists of its own cell, and the answer is that of brute force."""
    rng = np.random.default_rng(5)
    points = np.hstack([rng.normal(size=(4000, 3)), 6 * np.eye(4)[rng.integers(0, 4, 4000)]])
    points[3900:] = points[:100]  # ties
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<double>")
    plain, offered = neighbours._top_k, spark.sparkContext.accumulator(0)

    def counted(queries, data, k):
        offered.add(len(data))
        return plain(queries, data, k)

    monkeypatch.setattr(neighbours, "_top_k", counted)
    monkeypatch.setattr(neighbours, "_QUERY_ROWS", 200)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in neighbours.nearest(rows, rows, 3, same=True).collect()}
    for i in range(0, 4000, 37):
        away = np.sqrt(((points - points[i]) ** 2).sum(1))
        away[i] = np.inf
        assert [got[i, r] for r in (1, 2, 3)] == np.lexsort((np.arange(4000), away))[:3].tolist()
    # Each row to every one of 20 lists would be 80,000.
    assert len(got) == 12_000 and 0 < offered.value < 60_000


def test_neighbours_move_each_row_once(spark, monkeypatch):
    """Vectors of many dimensions, of which no cell can be left out: rows are stored once, not once for each cell that is visited."""
    monkeypatch.setattr(neighbours, "_CELL_ROWS", 40)
    listed, blocks = [], neighbours._blocks
    monkeypatch.setattr(neighbours, "_blocks", lambda *a: listed.append(blocks(*a)) or listed[-1])
    points = np.random.default_rng(3).normal(size=(1200, 24))
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<double>")
    found = neighbours.nearest(rows, rows, 3, same=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan and "explode" not in plan
    assert len(listed) == 1 and listed[0].agg(F.sum("n")).first()[0] == 1200
    assert listed[0].select("cell").distinct().count() > 20
    got = {(r["id"], r["rank"]): r["neighbour"] for r in found.collect()}
    for i in range(0, 1200, 31):
        away = np.sqrt(((points - points[i]) ** 2).sum(1))
        away[i] = np.inf
        assert [got[i, r] for r in (1, 2, 3)] == np.argsort(away)[:3].tolist()


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e6, 1), (0, 1e-18), (0, 1e20)])
def test_neighbours_of_any_magnitude(spark, shift, scale):
    """Distances that short floats cannot tell apart, or not hold, are measured in double precision."""
    points = np.random.default_rng(4).normal(size=(150, 3)) * scale + shift
    points[100:] = points[:50]
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<double>")
    got = {(r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in neighbours.nearest(rows, rows, 4, same=True).collect()}
    for i in range(150):
        away = np.sqrt(((points - points[i]) ** 2).sum(1))
        away[i] = np.inf
        order = np.lexsort((np.arange(150), away))[:4]
        assert [got[i, r] for r in (1, 2, 3, 4)] == list(zip(order.tolist(), away[order].tolist(), strict=True))


def test_few_rows_are_sent_for_pivots(spark):
    """Those that may be the first in hash order, however many tasks there are; copies of an id change nothing."""
    rows = spark.range(0, 20_000, 1, 40).select("id", F.array(F.col("id").cast("double")).alias("vector"))
    first = [r["vector"] for r in rows.orderBy(neighbours.row_hash(["id"], 0)).limit(100).collect()]
    assert neighbours._likely(rows, 100, 20_000).count() < 600
    assert neighbours._pivots(rows, 100, 20_000).tolist() == first
    copies = rows.where("id < 1500").withColumn("id", F.lit(7))
    assert len(neighbours._pivots(copies, 100, 1500)) == 100


def test_smote_stores_rows_once_and_cells_follow_the_class(spark, monkeypatch):
    """Rows of small classes are stored once in blocks; many classes don't make many tiny cells."""
    listed, blocks = [], neighbours._blocks
    monkeypatch.setattr(neighbours, "_blocks", lambda *a: listed.append(blocks(*a)) or listed[-1])
    points = np.random.default_rng(6).normal(size=(6000, 12))
    label = [0 if i % 3 == 0 and i < 1000 else i % 8 for i in range(6000)]
    rows = spark.createDataFrame([(i, y, p.tolist()) for i, (y, p) in enumerate(zip(label, points, strict=True))], "id long, y int, v array<double>")
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    made = neighbours.smote(rows, "y", "id", "v", 3).toPandas()
    top = max(sizes.values())
    small = {y: n for y, n in sizes.items() if n < top}
    assert len(made) == sum(top - n for n in small.values())
    assert len(listed) == 1 and listed[0].agg(F.sum("n")).first()[0] == sum(small.values())
    # At least some hundred rows a cell on average: 500 for each.
    assert listed[0].select("group", "cell").distinct().count() <= 2 * len(small)
    for r in made.head(40).itertuples():
        own = [i for i in range(6000) if label[i] == r.y and i != r.id]
        near = sorted(own, key=lambda i: (((points[i] - points[r.id]) ** 2).sum(), i))[:3]
        assert r.neighbour in near


def test_smote_stays_inside_the_class(spark):
    rows = spark.range(120).select(
        "id", (F.col("id") % 6 == 0).cast("int").alias("y"), F.array(F.rand(1), F.rand(2) + 3).alias("v")
    )
    rows = spark.createDataFrame(rows.toPandas(), "id long, y int, v array<double>")
    made = neighbours.smote(rows, "y", "id", "v", 5)
    assert made.count() == 80
    assert {r["y"] for r in made.collect()} == {1}
    minority = np.array([r["v"] for r in rows.where("y = 1").collect()])
    new = np.array([r["v"] for r in made.collect()])
    assert (new >= minority.min(0) - 1e-12).all()
    assert (new <= minority.max(0) + 1e-12).all()
    with pytest.raises(ValueError, match="neighbours"):
        neighbours.smote(rows.where("y = 0 OR id < 10"), "y", "id", "v", 5)
