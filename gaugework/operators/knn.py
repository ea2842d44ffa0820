"""Exact k-nearest-neighbour classification over folds.

A row's neighbours are the k closest rows of the *other* folds by Euclidean distance, ties
broken by id. Comparing every row with every other row is avoided as follows.

1. Copies of one feature vector in one fold share an answer, so one row represents them;
   on the candidate side only the k smallest ids of such copies can ever be chosen.
2. The candidates are cut into cells of bounded size: each oversize cell is split at
   quantiles of its widest feature, all cells of a level in one aggregation.
3. The k-th distance inside a row's own cell bounds its search radius. Walking the cell tree
   from the root with bounding boxes keeps, per cell, only the cells within that radius.
4. Rows meet the candidates of those cells in an equi-join on the cell; anything beyond the
   radius is dropped inside the join.

The result is exact. With few features most cells are pruned; with many features (tens)
bounding boxes prune little, as for every exact method.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugework.functions.exprs import box_gap, box_reach, euclidean, ratio
from gaugework.session import broadcast_if_small, materialise

_INF = float("inf")


def neighbours(
    folds: DataFrame,
    features: Sequence[str],
    k: int,
    key: str = "id",
    label: str = "label",
    cell_rows: int = 128,
    fanout: int = 32,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """(key, fold_id, rank, neighbour_id, neighbour_label, distance), k lines per row.

    Rows with a feature that is NULL or not finite, or without a fold, have no distance to
    anything: they neither vote nor get neighbours.
    """
    base = _base(folds, features, key, label)
    near, owners = _search(base, features, k, cell_rows, fanout, hot_rows)
    return (
        owners.join(near, "rep")
        .select(
            F.col("id").alias(key), F.col("fold").alias("fold_id"), "rank",
            F.col("nid").alias("neighbour_id"), F.col("nlabel").alias("neighbour_label"), "distance",
        )
    )


def predict(
    folds: DataFrame,
    features: Sequence[str],
    k: int,
    key: str = "id",
    label: str = "label",
    cell_rows: int = 128,
    fanout: int = 32,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """(key, fold_id, actual, predicted, confidence) for every row of ``folds`` with a fold.

    The majority label of the k neighbours wins, ties to the smaller label. Confidence is
    votes / k, also where fewer than k neighbours exist. A row without neighbours gets NULL.
    """
    base = _base(folds, features, key, label)
    near, owners = _search(base, features, k, cell_rows, fanout, hot_rows)
    best = (
        near.groupBy("rep", "nlabel").agg(F.count(F.lit(1)).alias("votes"))
        .groupBy("rep").agg(F.min(F.struct(-F.col("votes"), F.col("nlabel"))).alias("best"))
        .select(
            "rep",
            F.col("best.nlabel").alias("predicted"),
            ratio(-F.col("best.col1"), F.lit(k)).alias("confidence"),
        )
    )
    answered = owners.join(best, "rep", "left").select(
        F.col("id").alias(key), F.col("fold").alias("fold_id"), F.col("label").alias("actual"),
        "predicted", "confidence",
    )
    unanswered = folds.filter(F.col("fold_id").isNotNull() & ~_usable(features)).select(
        key, "fold_id", F.col(label).alias("actual"),
        F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("double").alias("confidence"),
    )
    return answered.unionByName(unanswered)


def sql_function(spark: SparkSession, train: str, features: Sequence[str], name: str = "knn_predict", key: str = "id", label: str = "label") -> None:
    """Create the SQL table function ``name(<feature>..., k, exclude_fold) -> (label, confidence)`` over the view ``train``.

    It is called LATERAL on a small list of points: each compares with every row of the view. Whole tables go
    through ``predict``. Ties and confidence are those of ``predict``.
    """
    squares = " + ".join(f"pow(t.`{f}` - {name}.q{i}, 2D)" for i, f in enumerate(features))
    points = ", ".join(f"q{i} DOUBLE" for i in range(len(features)))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({points}, k INT, exclude_fold BIGINT)
        RETURNS TABLE (label STRING, confidence DOUBLE)
        RETURN SELECT best.l, CAST(-best.v AS DOUBLE) / {name}.k FROM (
          SELECT min(struct(-votes AS v, near AS l)) AS best FROM (
            SELECT near, count(*) AS votes FROM (
              SELECT near, row_number() OVER (ORDER BY distance, neighbour) AS place FROM (
                SELECT t.`{key}` AS neighbour, t.`{label}` AS near, sqrt({squares}) AS distance
                FROM {train} t WHERE t.fold_id <> {name}.exclude_fold))
            WHERE place <= {name}.k GROUP BY near))""")


def _base(folds: DataFrame, features: Sequence[str], key: str, label: str) -> DataFrame:
    names = _names(len(features))
    df = folds.select(
        F.col(key).alias("id"), F.col("fold_id").alias("fold"), F.col(label).alias("label"),
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)],
    )
    return df.filter(_usable(names) & F.col("fold").isNotNull())


def _usable(features: Sequence[str]) -> Column:
    """True where every feature is a finite number (NaN compares as the largest value)."""
    finite = [F.coalesce(F.abs(F.col(c).cast("double")) < _INF, F.lit(False)) for c in features]
    return reduce(lambda a, b: a & b, finite)


def _names(d: int, prefix: str = "x") -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _cols(d: int, prefix: str) -> list:
    return [F.col(n) for n in _names(d, prefix)]


def _search(base, features, k, cell_rows, fanout, hot_rows):
    """(near, owners): neighbours per representative, and each row's representative."""
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    d = len(features)
    copies = Window.partitionBy(*_names(d), "fold").orderBy("id")
    points = materialise(
        base.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k)
    )
    points, depth = _grow_cells(points, d, cell_rows, fanout)

    own = materialise(_own_radius(points, d, k))
    found = _within_radius(points, own, d, k, depth)
    closest = Window.partitionBy("rep").orderBy("distance", "nid")
    near = found.withColumn("rank", F.row_number().over(closest)).filter(F.col("rank") <= k)
    return near, _owners(base, points, d, k, hot_rows)


def _grow_cells(points, d, cell_rows, fanout):
    """Add ``cell``: a path in a tree whose leaves hold at most ``cell_rows`` candidates.

    A leaf may exceed that only where all its vectors are equal; then it holds at most k
    candidates per fold. Returns the frame and the number of levels.
    """
    points = points.withColumn("cell", F.lit("r")).withColumn("level", F.lit(0))
    level = 0
    while True:
        splits = _splits(points.filter(F.col("level") == level), d, cell_rows, fanout)
        if splits is None:
            return points.drop("level"), level
        points = (
            points.join(broadcast_if_small(splits), "cell", "left")
            .withColumn("value", F.get(F.array(*_names(d)), F.col("dim")))
            .withColumn("child", F.lit(0))
        )
        # Binary search for the number of cuts below the value, as plain expressions.
        step = 1 << fanout.bit_length()
        while step:
            below = F.get("cuts", F.col("child") + (step - 1)) < F.col("value")
            points = points.withColumn("child", F.col("child") + F.when(below, step).otherwise(0))
            step //= 2
        split = F.col("cuts").isNotNull()
        points = (
            points
            .withColumn("cell", F.when(split, F.concat_ws(".", "cell", F.col("child").cast("string")))
                        .otherwise(F.col("cell")))
            .withColumn("level", F.when(split, level + 1).otherwise(F.col("level")))
            .drop("dim", "cuts", "value", "child")
        )
        points = materialise(points)  # else every further level would repeat this one's join
        level += 1


def _splits(points, d, cell_rows, fanout):
    """(cell, dim, cuts) of the cells that are too large, or None if there are none.

    A cell is cut along its widest feature into children of about half the cap.
    """
    names = _names(d)
    widest = F.array_max(F.array(*[
        F.struct((F.max(c) - F.min(c)).alias("spread"), F.lit(i).alias("dim"),
                 F.min(c).alias("lo"), F.max(c).alias("hi"))
        for i, c in enumerate(names)
    ]))
    oversize = materialise(
        points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), widest.alias("s"))
        .filter((F.col("n") > cell_rows) & (F.col("s.hi") > F.col("s.lo")))
        .select("cell", "n", "s.dim", "s.lo", "s.hi")
    )
    if oversize.isEmpty():
        return None
    shares = [i / fanout for i in range(1, fanout)]
    value = F.get(F.array(*names), F.col("dim"))
    quantiles = (
        points.join(broadcast_if_small(oversize), "cell")
        .groupBy("cell", "n", "dim", "lo", "hi")
        .agg(F.percentile_approx(value, shares, 1000).alias("q"))
    )
    ways = F.least(F.lit(fanout), F.ceil(2 * F.col("n") / cell_rows).cast("int"))
    wanted = F.transform(
        F.sequence(F.lit(1), ways - 1),
        lambda i: F.element_at("q", F.greatest(F.floor(i * F.lit(fanout) / ways).cast("int"), F.lit(1))),
    )
    # A cut in [lo, hi) always separates something; the middle keeps frequent values from
    # stalling the split, and lo serves where lo and hi are neighbouring numbers.
    middle = F.array(F.col("lo") / 2 + F.col("hi") / 2)
    cuts = F.filter(F.concat(wanted, middle), lambda c: (c >= F.col("lo")) & (c < F.col("hi")))
    return materialise(quantiles.withColumn("cuts", cuts).select(
        "cell", "dim",
        F.array_sort(F.array_distinct(
            F.when(F.size("cuts") > 0, F.col("cuts")).otherwise(F.array("lo"))
        )).alias("cuts"),
    ))


def _own_radius(points, d, k):
    """Per representative: a radius that surely holds k candidates.

    It is the distance of the k-th neighbour inside the own cell, from squares and widened
    a little so that rounding cannot make it too small.
    """
    names = _names(d)
    members = points.groupBy("cell").agg(
        F.collect_list(F.struct("fold", *names)).alias("members")
    )
    rows = points.filter(F.col("copy") == 1).select(
        F.col("id").alias("rep"), "fold", "cell", *names
    )
    # One pass over the members; those of the own fold sort last.
    squares = F.sort_array(F.transform("members", lambda m: F.when(
        m["fold"] != F.col("fold"), sum((F.pow(F.col(n) - m[n], F.lit(2.0)) for n in names), F.lit(0.0))
    ).otherwise(F.lit(_INF))))
    radius = F.sqrt(F.coalesce(F.get(squares, F.lit(k - 1)), F.lit(_INF))) * (1 + 1e-9)
    return rows.join(members, "cell").withColumn("radius", radius).drop("members")


def _within_radius(points, own, d, k, depth):
    """(rep, distance, nid, nlabel): the candidates within each representative's radius."""
    names = _names(d)
    pairs = _cell_pairs(points, own, d, k, depth)
    asked = own.select("rep", "fold", "cell", *names, F.col("radius").alias("own_radius"))
    visits = (
        asked.join(pairs, asked["cell"] == pairs["home"])
        .withColumn("reach", F.least("own_radius", "radius"))
        .filter(
            box_gap(_cols(d, "x"), _cols(d, "x"), _cols(d, "lo"), _cols(d, "hi")) <= F.col("reach")
        )
        .select("rep", "fold", "node", "reach", *names)
    )
    candidates = points.select(
        F.col("cell").alias("ncell"), F.col("fold").alias("nfold"), F.col("id").alias("nid"),
        F.col("label").alias("nlabel"),
        *[F.col(a).alias(b) for a, b in zip(names, _names(d, "y"))],
    )
    distance = euclidean(_cols(d, "x"), _cols(d, "y"))
    return visits.join(
        candidates,
        (F.col("node") == F.col("ncell")) & (F.col("fold") != F.col("nfold"))
        & (distance <= F.col("reach")),
    ).select("rep", distance.alias("distance"), "nid", "nlabel")


def _cell_pairs(points, own, d, k, depth):
    """(home, node, box of node, radius): cells that may hold neighbours of a home cell.

    The home cell is one of them. ``radius`` holds for every row of the home cell.
    """
    names, los, his = _names(d), _names(d, "lo"), _names(d, "hi")
    per_fold = points.groupBy("cell", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(lo) for c, lo in zip(names, los)],
        *[F.max(c).alias(hi) for c, hi in zip(names, his)],
    )
    # ``safe``: candidates that remain whatever the fold of the asking row is.
    leaves = materialise(per_fold.groupBy("cell").agg(
        (F.sum("n") - F.max("n")).alias("safe"),
        *[F.min(c).alias(c) for c in los],
        *[F.max(c).alias(c) for c in his],
    ))
    parts = F.split("cell", "[.]")
    steps = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.struct(
            (i - 1).alias("level"),
            F.array_join(F.slice(parts, F.lit(1), i - 1), ".").alias("parent"),
            F.array_join(F.slice(parts, F.lit(1), i), ".").alias("node"),
        ),
    )
    # Edges of the tree, labelled by the level of the child; a leaf stays in place below.
    nodes = (
        leaves.select("*", F.inline(steps)).groupBy("level", "parent", "node").agg(
            F.sum("safe").alias("safe"),
            F.max(F.col("node") == F.col("cell")).alias("leaf"),
            *[F.min(c).alias(c) for c in los],
            *[F.max(c).alias(c) for c in his],
        )
    )
    stay = nodes.filter("leaf").select(
        F.explode(F.sequence(F.col("level") + 1, F.lit(depth + 1))).alias("level"),
        F.col("node").alias("parent"), "node", "safe", "leaf", *los, *his,
    )
    edges = materialise(nodes.unionByName(stay).drop("leaf"))

    homes = leaves.select(
        F.col("cell").alias("home"),
        *[F.col(c).alias(f"home_{c}") for c in los + his],
    )
    radii = own.groupBy("cell").agg(F.max("radius").alias("radius"))
    # Start at the root; its box only matters where it is the single cell.
    frontier = homes.join(radii, homes["home"] == radii["cell"]).drop("cell").select(
        "*", F.lit("r").alias("node"), *[F.col(f"home_{c}").alias(c) for c in los + his]
    )
    box = (_cols(d, "home_lo"), _cols(d, "home_hi"), _cols(d, "lo"), _cols(d, "hi"))
    by_reach = Window.partitionBy("home").orderBy("reach").rowsBetween(Window.unboundedPreceding, 0)
    all_of_home = Window.partitionBy("home")
    for level in range(1, depth + 1):
        down = edges.filter(F.col("level") == level).drop("level")
        frontier = (
            frontier.drop("safe", *los, *his)
            .withColumnRenamed("node", "parent")
            .join(broadcast_if_small(down), "parent").drop("parent")
            .withColumn("gap", box_gap(*box))
            .filter(F.col("gap") <= F.col("radius"))
            .withColumn("reach", box_reach(*box))
            .withColumn("enough", F.sum("safe").over(by_reach) >= k)
            .withColumn("bound", F.min(F.when(F.col("enough"), F.col("reach"))).over(all_of_home))
            .withColumn("radius", F.least("radius", "bound"))
            .filter(F.col("gap") <= F.col("radius"))
            .drop("gap", "reach", "enough", "bound")
        )
    return materialise(
        frontier.select("home", "node", "radius", *los, *his)
    )


def _owners(base, points, d, k, hot_rows):
    """(rep, id, fold, label) for every row: which representative's neighbours it takes.

    Vectors with very many copies are spread by salt. Only copies beyond ``hot_rows`` are
    salted, so at most (rows / hot_rows) keys are.
    """
    keys = [*_names(d), "fold"]
    reps = points.filter(F.col("copy") == 1).select(F.col("id").alias("rep"), *keys)
    # ``points`` holds at most k copies, so at k = 1 it cannot tell whether there were more
    if k > 1 and points.filter(F.col("copy") > 1).isEmpty():
        return points.select(F.col("id").alias("rep"), "id", "fold", "label")
    if points.filter(F.col("copy") == k).isEmpty():
        return base.join(reps, keys).select("rep", "id", "fold", "label")
    hot = materialise(
        base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
        .withColumn("salts", F.ceil(F.col("n") / hot_rows).cast("int")).drop("n")
    )
    hot = broadcast_if_small(hot)
    salts = F.coalesce("salts", F.lit(1))
    salted_rows = base.join(hot, keys, "left").withColumn(
        "salt", F.pmod(F.xxhash64("id"), salts).cast("int")
    )
    salted_reps = reps.join(hot, keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return salted_rows.drop("salts").join(salted_reps.drop("salts"), [*keys, "salt"]).select(
        "rep", "id", "fold", "label"
    )
