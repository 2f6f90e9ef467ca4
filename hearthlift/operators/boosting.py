"""Boosted regression trees for the outcome and the treatment, of all folds at once.

Features are binned once: the edges are exact quantiles of the whole table, which a mergeable sketch narrows and
counts between its values find, and a row keeps its bins as small integers. A tree level then needs one pass for all ensembles together, two a fold: the rows and sums of
residuals by (ensemble, node, feature, bin). From these the best split of every node is found, and with it the
leaves' values, so that a tree of depth five takes five passes whatever the number of folds.

Residuals are rounded to a binary fraction so fine that their sums are exact. The trees therefore do not depend
on how rows are laid out, and a table that is counted to be small, whose passes would be all overhead, is boosted
within ten tasks, an ensemble each, with the same result.

As usual: the first tree is fitted to the labels (-1 and 1 for the treatment), every further one, scaled by the
step, to the residuals of absolute or logistic loss; a label's bins are ordered by their mean within the node.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.functions.batches import map_batches, matrix, workers_can_import
from hearthlift.functions.hashing import sampled
from hearthlift.sources.staging import stage

OUTCOME, TREATMENT = "outcome", "treatment"
LABEL = "post_campaign_total_order_value"
# Rows up to which a table, after counting it, is boosted within one task an ensemble.
SMALL_TABLE = 100_000
# Trees after which the rows' scores are written, so that a pass adds up no more trees than that.
SCORED_TREES = 10
# Size of the sketches that the edges are found from, and parts that a strip around an edge is counted in.
SKETCH_ACCURACY, EDGE_PARTS = 10_000, 64
# A split must gain this share of the node's own sum of squares over its rows.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Boosting:
    """Settings of the ensembles, and what is known of the table."""

    iterations: int = 50
    depth: int = 5
    step: float = 0.1
    rows: float = 0.8
    bins: int = 32
    folds: int = 5
    features: int = 0
    nominal: tuple[int, ...] = ()
    # Largest absolute outcome and number of rows: they fix how finely residuals are rounded.
    largest: float = 1.0
    count: int = 1

    @property
    def ensembles(self) -> list[tuple[str, int]]:
        return [(target, fold) for fold in range(self.folds) for target in (OUTCOME, TREATMENT)]

    def scale(self, target: str, tree: int) -> float:
        """A power of two by which residuals are multiplied before rounding; sums stay below 2**52."""
        bound = 4.0 if target == TREATMENT else self.largest if tree == 0 else 1.0
        return float(2.0 ** (52 - np.ceil(np.log2(max(bound, 1e-9) * max(self.count, 1)))))

    def weight(self, tree: int) -> float:
        return 1.0 if tree == 0 else self.step


@dataclass
class Tree:
    """Nodes 1 to 2**(depth+1)-1, children of k are 2k and 2k+1; a node without a feature is a leaf."""

    depth: int
    bins: int
    feature: np.ndarray = field(init=False)
    left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 << self.depth
        self.feature, self.left = np.full(n, -1, np.int64), np.zeros((n, self.bins), bool)
        self.value, self.rows = np.zeros(n), np.zeros(n, np.int64)

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        node = np.ones(len(bins), np.int64)
        for _ in range(self.depth):
            on = np.flatnonzero(self.feature[node] >= 0)
            if not len(on):
                break
            at = node[on]
            node[on] = 2 * at + ~self.left[at, bins[on, self.feature[at]]]
        return node

    def split(self, level: int, rows: np.ndarray, sums: np.ndarray, nominal: tuple[int, ...], scale: float) -> None:
        """Best splits of the nodes of a level, from rows and sums by node, feature and bin."""
        first = 1 << level
        own_rows, own_sum = rows[:, 0].sum(axis=1), sums[:, 0].sum(axis=1)
        if level == 0:
            self.rows[1], self.value[1] = own_rows[0], own_sum[0] / scale / max(own_rows[0], 1)
        order = np.broadcast_to(np.arange(self.bins), rows.shape).copy()
        labels = list(nominal)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.where(rows[:, labels] > 0, sums[:, labels] / rows[:, labels], np.inf)
            order[:, labels] = np.argsort(mean, axis=2, kind="stable")
            left_rows = np.cumsum(np.take_along_axis(rows, order, 2), axis=2)
            left_sum = np.cumsum(np.take_along_axis(sums, order, 2), axis=2)
            right_rows, right_sum = own_rows[:, None, None] - left_rows, own_sum[:, None, None] - left_sum
            parts = left_sum * left_sum / left_rows + right_sum * right_sum / right_rows
            parts = np.where((left_rows > 0) & (right_rows > 0), parts, -np.inf).reshape(len(rows), -1)
            before = own_sum * own_sum / own_rows
        best = np.argmax(parts, axis=1)
        gains = parts[np.arange(len(best)), best] - before
        for k in np.flatnonzero(gains > LEAST_GAIN * np.where(own_rows > 0, before, 0.0)).tolist():
            j, position = divmod(int(best[k]), self.bins)
            node = first + k
            self.feature[node] = j
            self.left[node, order[k, j, : position + 1]] = True
            # Empty bins lie on the side of a number's neighbours; labels that no row of the node has go right.
            for child, n, total in (
                (2 * node, left_rows[k, j, position], left_sum[k, j, position]),
                (2 * node + 1, right_rows[k, j, position], right_sum[k, j, position]),
            ):
                self.rows[child], self.value[child] = n, total / scale / n


@dataclass
class Rows:
    """Rows of the binned table as arrays; `scores` has the sum of all finished trees by ensemble."""

    label: np.ndarray
    treatment: np.ndarray
    fold: np.ndarray
    drawn: np.ndarray
    bins: np.ndarray
    scores: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, settings: Boosting) -> Rows:
        def numbers(name):
            column = batch.column(name)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            return column

        n = batch.num_rows
        bins = np.frombuffer(b"".join(numbers("bins").to_pylist()), "<u2").reshape(n, settings.features)
        scores = np.zeros((n, len(settings.ensembles)))
        if "scores" in batch.schema.names:
            scores = np.frombuffer(b"".join(numbers("scores").to_pylist()), "<f8").reshape(scores.shape).copy()
        return cls(
            numbers(LABEL).to_numpy(zero_copy_only=False),
            numbers("treatment").to_numpy(zero_copy_only=False),
            numbers("fold").to_numpy(zero_copy_only=False),
            matrix(numbers("drawn"), settings.iterations),
            bins,
            scores,
        )

    def add(self, ensemble: int, trees: list[Tree], first: int, settings: Boosting) -> None:
        for number, tree in enumerate(trees, first):
            self.scores[:, ensemble] += settings.weight(number) * tree.value[tree.place(self.bins)]

    def residuals(self, ensemble: int, tree: int, settings: Boosting) -> np.ndarray:
        """What the next tree of an ensemble is fitted to, rounded as its sums need it."""
        target, _ = settings.ensembles[ensemble]
        label = self.label if target == OUTCOME else 2.0 * self.treatment - 1
        score = self.scores[:, ensemble]
        if tree == 0:
            found = label
        elif target == OUTCOME:
            found = np.where(label >= score, 1.0, -1.0)
        else:
            found = 4 * label / (1 + np.exp(np.clip(2 * label * score, -700, 700)))
        return np.floor(found * settings.scale(target, tree) + 0.5)

    def histogram(self, ensemble: int, number: int, growing: Tree, level: int, settings: Boosting):
        """Rows and sums of residuals by node, feature and bin, of the rows that the tree is fitted to."""
        _, fold = settings.ensembles[ensemble]
        node = growing.place(self.bins) - (1 << level)
        use = np.flatnonzero((self.fold != fold) & self.drawn[:, number] & (node >= 0))
        residuals = self.residuals(ensemble, number, settings)
        shape = (1 << level, settings.features, settings.bins)
        rows, sums = np.zeros(np.prod(shape), np.int64), np.zeros(np.prod(shape))
        features = np.arange(settings.features) * settings.bins
        for a in range(0, len(use), 4096):
            own = use[a : a + 4096]
            cells = (node[own, None] * (settings.features * settings.bins) + features + self.bins[own]).ravel()
            rows += np.bincount(cells, minlength=len(rows))
            sums += np.bincount(cells, np.repeat(residuals[own], settings.features), len(sums))
        return rows.reshape(shape), sums.reshape(shape)


Histograms = Callable[[int, int, list[list[Tree]]], list[tuple[np.ndarray, np.ndarray]]]


def grown(members: list[int], settings: Boosting, histograms: Histograms, finished: Callable) -> list[list[Tree]]:
    """Trees of the ensembles with these numbers. `histograms(tree, level, trees)` gives those of every one."""
    trees: list[list[Tree]] = [[] for _ in members]
    for number in range(settings.iterations):
        for own in trees:
            own.append(Tree(settings.depth, settings.bins))
        for level in range(settings.depth):
            for e, own, (rows, sums) in zip(members, trees, histograms(number, level, trees), strict=True):
                own[-1].split(level, rows, sums, settings.nominal, settings.scale(settings.ensembles[e][0], number))
        finished(number, trees)
    return trees


def grown_here(rows: Rows, members: list[int], settings: Boosting) -> list[list[Tree]]:
    """Trees of these ensembles from rows that are all at hand."""

    def histograms(number, level, trees):
        return [rows.histogram(e, number, own[-1], level, settings) for e, own in zip(members, trees, strict=True)]

    def finished(number, trees):
        for e, own in zip(members, trees, strict=True):
            rows.add(e, own[-1:], number, settings)

    return grown(members, settings, histograms, finished)


TREE_SCHEMA = "ensemble int, tree int, node int, feature int, left array<int>, value double, rows long"


def tree_rows(ensemble: int, trees: list[Tree]) -> list[tuple]:
    return [
        (ensemble, number, k, int(tree.feature[k]), np.flatnonzero(tree.left[k]).tolist(), float(tree.value[k]), int(tree.rows[k]))
        for number, tree in enumerate(trees)
        for k in np.flatnonzero((tree.rows > 0) | (np.arange(len(tree.rows)) == 1)).tolist()
    ]


def trees_of(found: list, settings: Boosting) -> list[list[Tree]]:
    trees = [[Tree(settings.depth, settings.bins) for _ in range(settings.iterations)] for _ in settings.ensembles]
    for r in found:
        tree = trees[r["ensemble"]][r["tree"]]
        tree.feature[r["node"]], tree.value[r["node"]], tree.rows[r["node"]] = r["feature"], r["value"], r["rows"]
        tree.left[r["node"], r["left"]] = True
    return trees


def _within_tasks(binned: DataFrame, settings: Boosting) -> list[list[Tree]]:
    """A task an ensemble, each of which reads the whole table: only for a table counted to be small."""
    workers_can_import(binned.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        member = table.column("ensemble")[0].as_py()
        (trees,) = grown_here(Rows.of(table, settings), [member], settings)
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.int64()]
        columns = zip(*tree_rows(member, trees), strict=True)
        names = [c.split()[0] for c in TREE_SCHEMA.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    numbers = F.explode(F.array(*[F.lit(e) for e in range(len(settings.ensembles))]))
    dealt = binned.withColumn("ensemble", numbers).groupBy("ensemble")
    return trees_of(dealt.applyInArrow(run, TREE_SCHEMA).collect(), settings)


def _in_passes(binned: DataFrame, settings: Boosting) -> list[list[Tree]]:
    """One aggregation a level for all ensembles. Sums by cell, a bounded number, are all that reach the driver."""
    members = list(range(len(settings.ensembles)))
    state = {"table": binned, "first": 0}

    def brought_up(rows: Rows, trees: list[list[Tree]], first: int, last: int) -> Rows:
        for e, own in zip(members, trees, strict=True):
            rows.add(e, own[first:last], first, settings)
        return rows

    def histograms(number, level, trees):
        first = state["first"]

        def run(batches):
            total = None
            for batch in batches:
                rows = brought_up(Rows.of(batch, settings), trees, first, number)
                found = [rows.histogram(e, number, own[-1], level, settings) for e, own in zip(members, trees, strict=True)]
                found = [np.stack([h[i] for h in found]).astype(float) for i in (0, 1)]
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
            if total is not None:
                cells = np.flatnonzero(total[0])
                e, node, feature, bin_ = np.unravel_index(cells, total[0].shape)
                columns = [pa.array(c.astype(np.int32)) for c in (e, node, feature, bin_)]
                columns += [pa.array(total[i].ravel()[cells]) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["ensemble", "node", "feature", "bin", "rows", "total"])

        schema = "ensemble int, node int, feature int, bin int, rows double, total double"
        cells = map_batches(state["table"], run, schema).groupBy("ensemble", "node", "feature", "bin")
        found = cells.agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")).toArrow()
        shape = (len(members), 1 << level, settings.features, settings.bins)
        at = tuple(found.column(c).to_numpy() for c in ("ensemble", "node", "feature", "bin"))
        rows, sums = np.zeros(shape, np.int64), np.zeros(shape)
        rows[at], sums[at] = found.column("rows").to_numpy(), found.column("total").to_numpy()
        return list(zip(rows, sums, strict=True))

    def finished(number, trees):
        first = state["first"]
        if number + 1 - first < SCORED_TREES or number + 1 == settings.iterations:
            return
        columns = [c for c in state["table"].columns if c != "scores"]

        def run(batches):
            for batch in batches:
                rows = brought_up(Rows.of(batch, settings), trees, first, number + 1)
                scores = pa.array([s.tobytes() for s in rows.scores.astype("<f8")], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], scores], [*columns, "scores"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in binned.schema) + ", scores binary"
        state["table"], state["first"] = stage(map_batches(state["table"], run, schema), "boosting-scores"), number + 1

    return grown(members, settings, histograms, finished)


def nominal_features(design: DataFrame) -> dict[int, int]:
    """Number and labels of every categorical feature, from what the indexer left in the schema."""
    attributes = design.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a.get("vals", ())) for a in attributes.get("nominal", ())}


def feature_names(design: DataFrame) -> list[str]:
    attributes = design.schema["features"].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])]


def _counted(arrays: DataFrame, width: int, cuts: dict[int, np.ndarray]) -> list:
    """Rows, least and largest value of every feature's cells: 2 i lies below cut i, 2 i + 1 is cut i itself."""

    def run(batches):
        total = {j: (np.zeros(2 * len(c) + 1, np.int64), np.full(2 * len(c) + 1, np.inf), np.full(2 * len(c) + 1, -np.inf)) for j, c in cuts.items()}
        for batch in batches:
            values = matrix(batch.column(0), width)
            for j, own in cuts.items():
                value = values[:, j]
                cell = np.searchsorted(own, value, "left") + np.searchsorted(own, value, "right")
                rows, low, high = total[j]
                rows += np.bincount(cell, minlength=len(rows))
                np.minimum.at(low, cell, value)
                np.maximum.at(high, cell, value)
        for j, (rows, low, high) in total.items():
            cell = np.flatnonzero(rows)
            columns = [np.full(len(cell), j, np.int32), cell.astype(np.int32), rows[cell], low[cell], high[cell]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "cell", "rows", "low", "high"])

    cells = map_batches(arrays.select("features"), run, "feature int, cell int, rows long, low double, high double")
    sums = cells.groupBy("feature", "cell").agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    return sums.orderBy("feature", "cell").collect()


def _parts(low: float, high: float) -> np.ndarray:
    """Cuts from low to high, both included; halves, since their distance may be beyond the largest number."""
    most = np.finfo(float).max
    a, b = max(low, -most) / 2, min(high, most) / 2
    return np.clip(2 * (a + (b - a) * np.linspace(0, 1, EDGE_PARTS + 1)), low, high)


def _edges(arrays: DataFrame, width: int, rows: int, sketched: dict[int, list[float]], bins: int) -> dict[int, np.ndarray]:
    """Distinct quantiles of every feature at 1/bins, 2/bins ... of its rows: the smallest values with at least that
    share of the rows up to them.

    `sketched` has three values for each, whose ranks lie around the wanted one. All rows are counted between
    and at them, and the cell with the rank is cut into parts until it holds one value. Only cells reach the driver."""
    ranks = [max(1, -(-k * rows // bins)) for k in range(1, bins)]
    cuts = {j: np.unique(values) for j, values in sketched.items()}
    edges: dict[int, np.ndarray] = {}
    while cuts:
        found = _counted(arrays, width, cuts)
        for j in list(cuts):
            own = [r for r in found if r["feature"] == j]
            upto = np.cumsum([r["rows"] for r in own])
            cells = [own[i] for i in np.unique(np.searchsorted(upto, ranks, "left"))]
            if all(r["low"] == r["high"] for r in cells):
                edges[j] = np.unique([r["low"] for r in cells])
                del cuts[j]
            else:
                # A cell of one value keeps it as a cut, so that it is a cell again.
                cuts[j] = np.unique(np.concatenate([[r["low"], r["high"], *_parts(r["low"], r["high"])] for r in cells]))
    return edges


def binned_rows(design: DataFrame, learner, config) -> tuple[DataFrame, Boosting]:
    """The design with its features as bins, written once, and the settings that go with it.

    A number's bin is how many edges lie below it; the edges are the distinct exact quantiles at 1/bins, 2/bins ...
    of all rows, whatever the layout. A label's bin is its number. `drawn` says for which trees the household is in the sample."""
    from pyspark.ml.functions import vector_to_array

    nominal = nominal_features(design)
    names = feature_names(design)
    bins = max([learner.tree_bins, *nominal.values()])
    arrays = design.withColumn("features", vector_to_array("features"))
    numeric = [j for j in range(len(names)) if j not in nominal]
    margin = 2 / SKETCH_ACCURACY
    shares = [k / learner.tree_bins + d for k in range(1, learner.tree_bins) for d in (-margin, 0, margin)]
    shares = [min(max(share, 0.0), 1.0) for share in shares]
    known = arrays.agg(
        F.count("*").alias("count"),
        F.max(F.abs(LABEL)).alias("largest"),
        *[F.percentile_approx(F.col("features")[j], shares, SKETCH_ACCURACY).alias(f"edges_{j}") for j in numeric],
    ).first()
    settings = Boosting(
        learner.tree_iterations, learner.tree_depth, learner.tree_step, learner.tree_rows, bins, config.folds,
        len(names), tuple(sorted(nominal)), known["largest"] or 1.0, known["count"],
    )
    if known["count"] * margin < 1:  # the sketch has every rank
        exact = {j: np.unique((known[f"edges_{j}"] or [])[1::3]) for j in numeric}
    else:
        exact = _edges(arrays, len(names), known["count"], {j: known[f"edges_{j}"] for j in numeric}, learner.tree_bins)
    edges = [exact.get(j) for j in range(len(names))]

    def run(batches):
        for batch in batches:
            values = matrix(batch.column(batch.num_columns - 1), len(names))
            found = [
                values[:, j] if e is None else np.searchsorted(e, values[:, j], "left") for j, e in enumerate(edges)
            ]
            rows = np.stack(found, axis=1).astype("<u2")
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([r.tobytes() for r in rows], pa.binary())], columns)

    household = F.col(S.HOUSEHOLD).cast("string")
    draw = F.transform(
        F.sequence(F.lit(0), F.lit(settings.iterations - 1)),
        lambda t: sampled(F.concat_ws(":", household, t), settings.rows, config.seed, config.order_hash),
    )
    source = arrays.withColumn("drawn", draw)
    source = source.select(*[c for c in design.columns if c != "features"], "drawn", "features")
    columns = [*source.columns[:-1], "bins"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1]) + ", bins binary"
    return stage(map_batches(source, run, schema), "binned"), settings


def boosted_trees(binned: DataFrame, settings: Boosting) -> list[list[Tree]]:
    """Trees of every ensemble; the rows of its fold have no part in them."""
    return (_within_tasks if settings.count <= SMALL_TABLE else _in_passes)(binned, settings)


def tree_table(binned: DataFrame, trees: list[list[Tree]]) -> DataFrame:
    """The nodes of all trees as a table; their number is bounded by ensembles, trees and depth."""
    rows = [row for e, own in enumerate(trees) for row in tree_rows(e, own)]
    return binned.sparkSession.createDataFrame(rows, TREE_SCHEMA)


def out_of_fold(binned: DataFrame, trees: list[list[Tree]], settings: Boosting) -> DataFrame:
    """Every row with `y_hat` and `t_score` by the ensembles of its own fold."""
    kept = [c for c in binned.columns if c not in ("bins", "drawn")]

    def run(batches):
        for batch in batches:
            rows = Rows.of(batch, settings)
            found = {OUTCOME: np.zeros(batch.num_rows), TREATMENT: np.zeros(batch.num_rows)}
            for (target, fold), own in zip(settings.ensembles, trees, strict=True):
                here = np.flatnonzero(rows.fold == fold)
                for number, tree in enumerate(own):
                    found[target][here] += settings.weight(number) * tree.value[tree.place(rows.bins[here])]
            scores = 1 / (1 + np.exp(np.clip(-2 * found[TREATMENT], -700, 700)))
            columns = [*[batch.column(c) for c in kept], pa.array(found[OUTCOME]), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "y_hat", "t_score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in binned.schema if f.name in kept)
    return map_batches(binned, run, f"{schema}, y_hat double, t_score double")
