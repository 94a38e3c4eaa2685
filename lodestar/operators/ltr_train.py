"""LambdaMART on Spark (LTR-03/04/05/08).

Per boosting round:
  1. lambda gradients and hessians per request (pairwise within a request, in
     numpy over blocks of whole requests; a request is a logged pool, bounded by
     the pool size, and its pairs never leave the task),
  2. one leaf-wise histogram tree (``hist_trees``) over features binned once by
     quantiles, grown best gain first to ``num_leaves`` leaves, each leaf worth
     the Newton step -sum(g)/sum(h),
  3. score += learning_rate * tree over the bins (a model scores raw features as
     a native CASE WHEN column, no model UDF),
with bagging of requests, a feature subset per tree, early stopping once one of
the validation NDCG@5, @10 and @20 has not improved for the given rounds, and a
reliable checkpoint every few rounds to cut lineage. A model is plain data: it is
saved as JSON lines, one per tree, and scores wherever it is loaded.
"""

from __future__ import annotations

import datetime as dt
import json
import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lodestar.functions.vocab import EVAL_AT, FEATURE_COLS, LAMBDARANK_PARAMS
from lodestar.operators import hist_trees, ltr


def _as_column(node: dict) -> Column:
    if "value" in node:
        return F.lit(float(node["value"]))
    return F.when(F.col(node["feature"]) <= F.lit(float(node["threshold"])), _as_column(node["left"])).otherwise(_as_column(node["right"]))


@dataclass
class Tree:
    root: dict              # {feature, threshold, left, right} or {value}
    importances: dict[str, float]

    @property
    def expr(self) -> Column:
        """The prediction as a native expression over feature columns."""
        return _as_column(self.root)

    def n_leaves(self) -> int:
        count = lambda n: 1 if "value" in n else count(n["left"]) + count(n["right"])
        return count(self.root)


def _sum(columns: list[Column]) -> Column:
    """A balanced sum, so that hundreds of trees make no deep expression."""
    while len(columns) > 1:
        columns = [columns[i] + columns[i + 1] if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0] if columns else F.lit(0.0)


@dataclass
class LambdaRankModel:
    learning_rate: float
    trees: list[Tree] = field(default_factory=list)
    best_iteration: int = 0
    history: list[tuple] = field(default_factory=list)  # (iteration, train ndcg@10, valid ndcg at each of EVAL_AT)

    def score_column(self, n_trees: int | None = None) -> Column:
        trees = self.trees[: (n_trees if n_trees is not None else (self.best_iteration or len(self.trees)))]
        return F.lit(self.learning_rate) * _sum([t.expr for t in trees])

    def save(self, spark, path: str) -> None:
        """JSON lines at ``path``: a head line, then one line per tree in order."""
        head = {"learning_rate": self.learning_rate, "best_iteration": self.best_iteration, "history": self.history}
        lines = [json.dumps({"i": -1} | head)] + [json.dumps({"i": i, "root": t.root, "importances": t.importances}) for i, t in enumerate(self.trees)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("errorifexists").text(path)

    @staticmethod
    def load(spark, path: str) -> LambdaRankModel:
        rows = sorted((json.loads(r["value"]) for r in spark.read.text(path).collect()), key=lambda x: x["i"])  # one line a tree
        head = rows[0]
        return LambdaRankModel(head["learning_rate"], [Tree(r["root"], r["importances"]) for r in rows[1:]], head["best_iteration"], [tuple(h) for h in head["history"]])


def check_columns(frame: DataFrame, feature_cols: list[str] = FEATURE_COLS) -> None:
    """Missing training columns raise, naming them."""
    need = ["request_id", "label", *feature_cols]
    missing = [c for c in need if c not in frame.columns]
    if missing:
        raise ValueError(f"training frame is missing columns: {missing}")


def _ranking(starts: np.ndarray, score: np.ndarray, pool_rank: np.ndarray):
    """Rows by request, falling score, pool rank; the request of each place; its position there.

    ``starts`` are the row numbers at which requests begin, and the number of rows.
    """
    req = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.lexsort((pool_rank, -score, req)), req, np.arange(len(req)) - starts[req]


def _gradients(starts, label, score, pool_rank, truncation: int, sigma: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Lambda gradient and hessian of every row, over the pairs within each request, all requests at once."""
    order, req, place = _ranking(starts, score, pool_rank)
    lab, s = label[order].astype(np.float64), score[order].astype(np.float64)
    n, m = len(lab), len(starts) - 1
    grad, hess = np.zeros(n), np.zeros(n)
    gains = np.power(2.0, lab) - 1.0
    disc = 1.0 / np.log2(place + 2.0)
    ideal = gains[np.lexsort((-lab, req))]
    max_dcg = np.bincount(req, np.where(place < truncation, ideal * disc, 0.0), minlength=m)
    pairs = np.where((place < truncation) & (max_dcg[req] > 0), starts[req + 1] - np.arange(n) - 1, 0)
    i = np.repeat(np.arange(n), pairs)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    keep = lab[i] != lab[j]
    i, j = i[keep], j[keep]
    hi = np.where(lab[i] > lab[j], i, j)
    lo = np.where(lab[i] > lab[j], j, i)
    delta = np.abs(gains[hi] - gains[lo]) * np.abs(disc[i] - disc[j]) / max_dcg[req[i]]
    rho = 1.0 / (1.0 + np.exp(sigma * (s[hi] - s[lo])))
    lam = -sigma * rho * delta
    h = sigma * sigma * rho * (1.0 - rho) * delta
    np.add.at(grad, hi, lam)
    np.add.at(grad, lo, -lam)
    np.add.at(hess, hi, h)
    np.add.at(hess, lo, h)
    total = np.bincount(req[i], -lam, minlength=m) * 2.0
    norm = np.ones(m)
    norm[total > 0] = np.log2(1.0 + total[total > 0]) / total[total > 0]
    back = np.empty((2, n))
    back[:, order] = grad * norm[req], hess * norm[req]
    return back[0], back[1]


def _ndcg_sums(starts, label, score, pool_rank, cutoffs: list[int]) -> list[float]:
    """Sum over the requests of NDCG at each cutoff (labels above 3 are worth 3 in the ideal order)."""
    order, req, place = _ranking(starts, score, pool_rank)
    lab, m = label[order].astype(np.float64), len(starts) - 1
    got = (np.power(2.0, lab) - 1.0) / np.log2(place + 2.0)
    best = (np.power(2.0, np.clip(lab[np.lexsort((-lab, req))], 0, 3)) - 1.0) / np.log2(place + 2.0)
    out = []
    for k in cutoffs:
        dcg, ideal = (np.bincount(req, np.where(place < k, x, 0.0), minlength=m) for x in (got, best))
        out.append(float(np.sum(dcg[ideal > 0] / ideal[ideal > 0])))
    return out


def _whole_requests(batches):
    """The rows of ``batches``, sorted by request, in frames that cut no request: a batch's last one waits for the next."""
    carry = None
    for pdf in batches:
        if carry is not None:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if pdf.empty:
            continue
        tail = pdf["request_id"] == pdf["request_id"].iloc[-1]
        carry = pdf[tail]
        if not tail.all():
            yield pdf[~tail]
    if carry is not None and len(carry):
        yield carry


def _starts(pdf: pd.DataFrame) -> np.ndarray:
    """Where the requests of a frame sorted by request begin, and its length."""
    ids = pdf["request_id"].to_numpy()
    return np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]])


def lambda_gradients(frame: DataFrame, feature_cols: list[str] = FEATURE_COLS,
                     truncation: int = 20, sigma: float = 1.0, clustered: bool = False) -> DataFrame:
    """Per-row lambda gradient and hessian of NDCG for the current ``score``.

    Requests must not straddle partitions: with ``clustered=True`` the frame is
    already partitioned and sorted by request_id (the training loop keeps it so);
    otherwise it is repartitioned and sorted here. One
    ``mapInPandas`` pass then walks each partition's requests in order (a
    request split across Arrow batches is carried to the next batch), instead
    of one Arrow round trip per request.
    """
    cols = ["request_id", "pool_rank", "label", "score", *feature_cols]
    schema = ", ".join([f"{c} {frame.schema[c].dataType.simpleString()}" for c in cols]
                       + ["grad double", "hess double"])

    def run(batches):
        for pdf in _whole_requests(batches):
            grad, hess = _gradients(_starts(pdf), *(pdf[c].to_numpy() for c in ("label", "score", "pool_rank")), truncation, sigma)
            yield pdf.assign(grad=grad, hess=hess)

    f = frame.select(*cols)
    if not clustered:
        f = f.repartition("request_id").sortWithinPartitions("request_id")
    return f.mapInPandas(run, schema)


def _feature_subset(round_no: int, fraction: float, cols: list[str], seed: int) -> list[str]:
    k = max(1, int(round(fraction * len(cols))))
    rng = np.random.default_rng(seed + round_no)
    idx = sorted(rng.choice(len(cols), size=k, replace=False).tolist())
    return [cols[i] for i in idx]


def _blocks(frame: DataFrame, cols: list[str], bags: int, fraction: float, seed: int):
    """An RDD of the frame's requests as numpy blocks, dealt out by request once: what every round works on.

    A block holds whole requests, about an Arrow batch of them: ``starts``, ``train``
    (a request of the training side), ``bag`` (its bags, where there is bagging), and
    per row label, pool rank, bins and score.
    """
    keep = F.transform(F.sequence(F.lit(0), F.lit(max(bags, 1) - 1)),
                       lambda k: F.pmod(F.xxhash64("request_id", F.lit(seed), k), F.lit(1000)) < int(fraction * 1000))

    def pack(batches):
        for pdf in _whole_requests(batches):
            starts = _starts(pdf)
            first = starts[:-1]
            block = {"starts": starts, "train": pdf["_train"].to_numpy(dtype=bool)[first],
                     "bag": np.packbits(np.stack(pdf["_bag"].to_numpy()[first]).astype(bool), axis=1) if bags else None,
                     "label": pdf["label"].to_numpy(dtype=np.float64), "pool_rank": pdf["pool_rank"].to_numpy(dtype=np.int64),
                     "bins": np.stack([pdf[c].to_numpy().astype(np.uint8) for c in cols]), "score": np.zeros(len(pdf))}
            yield pd.DataFrame({"block": [pickle.dumps(block)]})

    by_request = frame.repartition("request_id").sortWithinPartitions("request_id")
    return by_request.withColumn("_bag", keep).mapInPandas(pack, "block binary").rdd.map(lambda row: pickle.loads(row[0]))


def _rows_of(block: dict, requests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the marked requests, and where these begin among them."""
    sizes = np.diff(block["starts"])
    return np.flatnonzero(np.repeat(requests, sizes)), np.concatenate([[0], np.cumsum(sizes[requests])])


def _add_tree(node: dict, at: dict[str, int], bins: np.ndarray, rows: np.ndarray, score: np.ndarray, rate: float) -> None:
    if "value" in node:
        score[rows] += rate * node["value"]
        return
    low = bins[at[node["feature"]]][rows] <= node["threshold"]
    _add_tree(node["left"], at, bins, rows[low], score, rate)
    _add_tree(node["right"], at, bins, rows[~low], score, rate)


def _advance(blocks, tree: dict | None, cols: list[str], rate: float, truncation: int, bag: int | None):
    """The blocks with ``tree`` added to their scores and the gradients of the training rows in ``bag``."""
    at = {c: i for i, c in enumerate(cols)}

    def run(block):
        score = block["score"].copy()
        if tree is not None:
            _add_tree(tree, at, block["bins"], np.arange(len(score)), score, rate)
        rows, starts = _rows_of(block, block["train"])
        g, h = _gradients(starts, block["label"][rows], score[rows], block["pool_rank"][rows], truncation)
        if bag is not None:
            inside = np.repeat(np.unpackbits(block["bag"], axis=1)[block["train"], bag].astype(bool), np.diff(starts))
            rows, g, h = rows[inside], g[inside], h[inside]
        fixed = [np.floor(x * float(hist_trees.SCALE) + 0.5).astype(np.int64) for x in (g, h)]
        return block | {"score": score, "rows": rows, "g": fixed[0], "h": fixed[1]}

    return blocks.map(run)


def _summed(blocks, arrays) -> list[np.ndarray]:
    """The arrays that ``arrays`` makes of a block, added up over all blocks: in tasks, from many partitions in a tree."""
    def plus(a, b):
        return [x + y for x, y in zip(a, b)]

    def run(part):
        total = None
        for block in part:
            x = arrays(block)
            total = x if total is None else plus(total, x)
        return [] if total is None else [total]

    return blocks.mapPartitions(run).treeReduce(plus, depth=1 if blocks.getNumPartitions() <= 16 else 2)


def _cells(block: dict, subset: list[int], route, n_nodes: int) -> np.ndarray:
    """features x (nodes x bins) x 3 of the block's rows in the bag."""
    cells = np.zeros((len(subset), n_nodes * hist_trees.BIN_STEPS, 3), dtype=np.int64)
    hist_trees._count(cells, block["g"], block["h"], [block["bins"][f][block["rows"]] for f in subset], route, hist_trees.BIN_STEPS)
    return cells


def _by_node(cells: np.ndarray, n_nodes: int) -> np.ndarray:
    return cells.reshape(cells.shape[0], n_nodes, -1, 3).swapaxes(0, 1)


def _ndcg_of(block: dict, train: bool, cutoffs: list[int]) -> np.ndarray:
    """NDCG sums of the training or the validation requests, and their number."""
    rows, starts = _rows_of(block, block["train"] == train)
    return np.array([*_ndcg_sums(starts, block["label"][rows], block["score"][rows], block["pool_rank"][rows], cutoffs), len(starts) - 1])


def train_lambdarank(train: DataFrame, valid: DataFrame | None = None, params: dict | None = None,
                     feature_cols: list[str] = FEATURE_COLS, checkpoint_every: int = 5,
                     seed: int = 0) -> LambdaRankModel:
    """LTR-03: boosted LambdaRank trees.

    ``train``/``valid``: request_id, pool_rank, label and the feature columns
    (null-free doubles, e.g. from ``ranker_features``). An empty training frame
    raises. A tree splits its best leaf until it holds ``num_leaves`` leaves.

    The binned rows stay in numpy blocks of a persisted RDD. A round is one job that
    adds the last tree, measures both sides, and counts the next tree's root, then one
    job for each step of that tree: no planning and no shuffle, so a round of a small
    table costs little more than these jobs' start.
    """
    from lodestar.session import checkpoint_dir

    p = {**LAMBDARANK_PARAMS, **(params or {})}
    check_columns(train, feature_cols)
    spark = train.sparkSession
    checkpoint_dir(spark)
    model = LambdaRankModel(learning_rate=p["learning_rate"])
    if train.isEmpty():
        raise ValueError("the training frame has no rows")
    edges = hist_trees.quantile_edges(train, feature_cols)
    rounds, freq, bagging = int(p["num_iterations"]), max(1, int(p["bagging_freq"])), p["bagging_fraction"] < 1.0

    def side(f, is_train):
        return hist_trees.binned(f.select("request_id", "pool_rank", "label", *feature_cols), edges).withColumn("_train", F.lit(is_train))

    both = side(train, True) if valid is None else side(train, True).unionByName(side(valid, False))
    blocks = _blocks(both, feature_cols, -(-rounds // freq) if bagging else 0, p["bagging_fraction"], seed).persist(StorageLevel.MEMORY_AND_DISK)
    best, best_at, best_iter, tree = [-1.0] * len(EVAL_AT), [0] * len(EVAL_AT), 0, None
    for r in range(rounds + 1 if valid is not None else rounds):
        subset = [feature_cols.index(c) for c in _feature_subset(r, p["feature_fraction"], feature_cols, seed)]
        # training NDCG only at checkpoints (it is reporting, not control)
        report = r % checkpoint_every == 0
        before, blocks = blocks, _advance(blocks, tree, feature_cols, p["learning_rate"], int(p["lambdarank_truncation_level"]),
                                          min(r, rounds - 1) // freq if bagging else None).persist(StorageLevel.MEMORY_AND_DISK)
        if r and report:
            blocks.checkpoint()
        measured = valid is not None and r > 0
        root, *ndcgs = _summed(blocks, lambda b: [_cells(b, subset, 0, 1), *([_ndcg_of(b, False, EVAL_AT)] if measured else []),
                                                  *([_ndcg_of(b, True, [10])] if measured and report else [])])
        before.unpersist()
        if measured:
            means = [(x[:-1] / max(x[-1], 1.0)).tolist() for x in ndcgs]
            v, t = means[0], means[1][0] if report else None
            model.history.append((r, t, *v))
            for i, x in enumerate(v):
                if x > best[i] + 1e-12:
                    best[i], best_at[i] = x, r
            stalled = [at for at in best_at if r - at >= int(p["early_stopping_rounds"])]
            if stalled:  # the first metric without progress ends it, at its own best round
                best_iter = min(stalled)
                break
            best_iter = best_at[EVAL_AT.index(10)]
        if r == rounds:
            break

        def histograms(route, n_nodes):
            return _by_node(_summed(blocks, lambda b: [_cells(b, subset, route, n_nodes)])[0], n_nodes)

        grown = hist_trees.grow([feature_cols[f] for f in subset], histograms, int(p["num_leaves"]), int(p["min_data_in_leaf"]), _by_node(root, 1)[0])
        model.trees.append(Tree(grown.nodes(edges), grown.gains()))
        tree = grown.bin_nodes()
    blocks.unpersist()
    model.best_iteration = best_iter or len(model.trees)
    return model


def rerank_score(frame: DataFrame, model: LambdaRankModel, out: str = "score") -> DataFrame:
    """LTR-04: one score per candidate, the trees summed as one projection."""
    return frame.withColumn(out, model.score_column())


def feature_importance(spark, model: LambdaRankModel, feature_cols: list[str] = FEATURE_COLS) -> DataFrame:
    """LTR-05: gain of the splits on each feature, summed over the trees and normalised to 1, in vocabulary order."""
    tot = {c: 0.0 for c in feature_cols}
    for t in model.trees[: model.best_iteration or len(model.trees)]:
        for k, v in t.importances.items():
            tot[k] += v
    s = sum(tot.values()) or 1.0
    return spark.createDataFrame([(c, tot[c] / s) for c in feature_cols], "feature string, gain double")


def training_pipeline(frame: DataFrame, params: dict | None = None, run_id: str = "run",
                      gate_metric: str = "ndcg_at_10", gate_threshold: float = 0.6,
                      bucket: Column | None = None, model_dir: str | None = None,
                      git_sha: str | None = None):
    """LTR-08: frame -> split -> train -> evaluate on test -> gate -> run row.

    Returns (run row DataFrame, model). The run row follows the training_runs
    schema (flattened metrics and hyperparameters, instants, model path and
    ``git_sha``); the model is saved under ``model_dir`` where one is given. An
    empty frame raises.
    """
    from lodestar.session import checkpoint_dir
    checkpoint_dir(frame.sparkSession)
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    feats = ltr.ranker_features(frame)
    split = ltr.group_split(feats, bucket=bucket).repartition("request_id").checkpoint()
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    model = train_lambdarank(train, test, params)
    scored = rerank_score(test, model)
    m = ltr.evaluate_ranking(scored.select("request_id", "label", "pool_rank", "score"),
                             F.col("score"), F.col("pool_rank"))
    p = {**LAMBDARANK_PARAMS, **(params or {})}
    path = f"{model_dir.rstrip('/')}/{run_id}" if model_dir else None
    if path:
        model.save(frame.sparkSession, path)
    finished = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = m.select(
        F.lit(run_id).alias("run_id"),
        F.lit(started).cast("timestamp_ntz").alias("started_at"), F.lit(finished).cast("timestamp_ntz").alias("finished_at"),
        F.lit(path).cast("string").alias("model_path"), F.lit(git_sha).cast("string").alias("git_sha"),
        F.lit(model.best_iteration).cast("bigint").alias("best_iteration"),
        "ndcg_at_10", "map", "recall_at_20", "n_queries",
        (F.col(gate_metric) >= gate_threshold).alias("passed_gate"),
        *[F.lit(p[k]).alias(k) for k in ("num_leaves", "learning_rate", "feature_fraction", "bagging_fraction",
                                         "num_iterations", "early_stopping_rounds", "min_data_in_leaf",
                                         "lambdarank_truncation_level")])
    return row, model
