"""Document quality by co-training.

Two classifiers see different views of a document: its text, and what is recorded
about it. In rounds, each labels the unlabelled documents it is surest about for the
other to learn from. Their calibrated scores are then combined for every document.

Features of all documents are stored once. A round scores all unlabelled ones with both
views in tasks; a histogram of the scores tells from which on a view passes its labels
on, and gradients and Hessians over the documents passed on are summed in tasks. The
driver sees histograms, sums and a bounded sample of the labelled documents.
"""

from __future__ import annotations

import ast
import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.arrow import with_columns
from caseloom.operators.scaling import Staging, join_checked

BIGRAM_BUCKETS = 256
META_BUCKETS = 64

# Classes of bytes whose shares are features.
_CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" \t",
    b"\r\n",
    b".",
    b",;:",
    b"!",
    b"?",
    b"|",
    b"#*$%&",
    b"<>{}[]\\/=_@^~",
    b"\"'()-",
)


TEXT_FEATURES = len(_CLASSES) + 1 + BIGRAM_BUCKETS + 4
META_FEATURES = 3 * META_BUCKETS
# Histogram of log-odds: so many bins to either side of even odds, and their width
_BINS, _BIN = 2000, 0.02


@dataclass(frozen=True)
class CoTraining:
    """``max_labelled`` labelled documents, picked by a hash of their ids, and all unlabelled
    ones are learned from. In each of ``rounds`` a view passes on some ``share`` of the
    unlabelled documents, as far as it is ``sure``, and both take ``steps`` Newton steps.
    ``calibration`` of the labelled documents only set the scale of scores."""

    max_labelled: int = 8000
    rounds: int = 3
    steps: int = 2
    share: float = 0.05
    sure: float = 0.95
    calibration: float = 0.25
    ridge: float = 1.0


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(256, len(_CLASSES), np.int64)
    for k, own in enumerate(_CLASSES):
        kind[list(own)] = k
    pairs = (np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 8)
    return kind, pairs.astype(np.int64) % BIGRAM_BUCKETS


def text_features(texts: list[str | None]) -> np.ndarray:
    """Shares of byte classes and hashed byte pairs, and repetition, a row per text.

    How long a text is belongs to the other view. Values are those of 16-bit numbers,
    as which they are stored."""
    kind, bucket = _byte_tables()
    out = np.zeros((len(texts), TEXT_FEATURES), np.float32)
    for i, text in enumerate(texts):
        text = text or ""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        n = max(1, len(data))
        shares = np.bincount(kind[data], minlength=len(_CLASSES) + 1) / n
        pairs = np.zeros(BIGRAM_BUCKETS)
        for start in range(0, len(data) - 1, 1 << 20):
            part = data[start : start + (1 << 20) + 1].astype(np.int64)
            pairs += np.bincount(bucket[part[:-1] * 256 + part[1:]], minlength=BIGRAM_BUCKETS)
        words, lines = text.split(), text.split("\n")
        distinct = len(set(words))
        out[i, : len(_CLASSES) + 1] = shares
        out[i, len(_CLASSES) + 1 : -4] = np.sqrt(pairs / n)
        out[i, -4:] = (
            distinct / max(1, len(words)),
            len(set(lines)) / len(lines),
            len(text) / max(1, len(words)) if words else 0,
            sum(x[-1:] in ".!?" for x in lines) / len(lines),
        )
    return np.minimum(out, 60_000).astype(np.float16).astype(np.float32)


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Language, source and length class, hashed, a row per document; null is a value."""
    out = np.zeros((len(lang), 3 * META_BUCKETS), np.float32)
    for k, column in enumerate((lang, source, n_chars)):
        for i, value in enumerate(column):
            if k == 2:
                value = None if value is None else int(4 * np.log2(max(1, value)))
            out[i, k * META_BUCKETS + zlib.crc32(repr(value).encode("utf-8", "surrogatepass")) % META_BUCKETS] = 1
    return out


# ---------------------------------------------------------------------------
# Classifiers
# ---------------------------------------------------------------------------
@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, with a calibrated scale."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float) -> Logistic:
        """From few documents; ``weight`` ends with the bias."""
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-6] = 1.0
        model = cls(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(25):
            step = model.newton(*model.sums(x, y), ridge)
            if np.abs(step).max() < 1e-6:
                break
        return model

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.mean) / self.scale, np.ones(len(x))].astype(np.float64)

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the loss of some documents."""
        z = self.standard(x)
        p = _sigmoid(z @ self.weight)
        return z.T @ (p - y), (z * (p * (1 - p))[:, None]).T @ z

    def newton(self, gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> np.ndarray:
        penalty = np.r_[np.full(len(self.weight) - 1, ridge), 1e-6]
        step = np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * self.weight)
        self.weight = self.weight - step
        return step

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weight

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Scale and shift by a regression of held-back labels on the raw score."""
        if len(np.unique(y)) == 2:
            found = Logistic.fit(self.raw(x)[:, None], y, 1e-3)
            self.slope = float(found.weight[0] / found.scale[0])
            self.shift = float(found.weight[1]) - self.slope * float(found.mean[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    """Both views and the log-odds of the classes; views are None where labels had one class."""

    text: Logistic | None
    meta: Logistic | None
    prior: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by text, by metadata and by both, as views independent given the class."""
        if self.text is None or self.meta is None:
            flat = np.full(len(text), _sigmoid(np.array(self.prior)))
            return flat, flat, flat
        a, b = self.text.logit(text), self.meta.logit(meta)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


# ---------------------------------------------------------------------------
# Rounds
# ---------------------------------------------------------------------------
VIEWS = ("text", "meta")


@dataclass
class Round:
    """The views as they stood when a round's labels were passed on, and from which
    log-odds on: ``(bad, good)`` by view."""

    models: dict[str, Logistic]
    limits: dict[str, tuple[float, float]]

    def labels(self, views: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """What each view passes on: 1, 0 or, if it is not sure, -1."""
        out = {}
        for name in VIEWS:
            bins = _bin(self.models[name].logit(views[name]))
            bad, good = self.limits[name]
            out[name] = np.where(bins >= good, 1, np.where(bins <= bad, 0, -1))
        return out


def _bin(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(logit / _BIN), -_BINS, _BINS - 1).astype(np.int64)


def passed_on(rounds: list[Round], views: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Which documents are still in the pool, and the labels each view gave the others.

    A document leaves the pool with the round in which a view is sure of it. That is told
    by the rounds' models alone, so nothing has to be kept by document.
    """
    n = len(views["text"])
    pool, given = np.ones(n, bool), {name: np.full(n, -1) for name in VIEWS}
    for past in rounds:
        now = past.labels(views)
        sure = pool & ((now["text"] >= 0) | (now["meta"] >= 0))
        for name in VIEWS:
            given[name][sure] = now[name][sure]
        pool &= ~sure
    return pool, given


def limits_of(counts: np.ndarray, wanted: tuple[float, float], sure: float) -> tuple[float, float]:
    """``(bad, good)`` bins from a histogram of the pool's log-odds.

    The surest bins are passed on whole while they hold no more documents than wanted, the
    very surest of all in any case; never bins that are less sure than ``sure``.
    """
    edge = int(np.ceil(np.log(sure / (1 - sure)) / _BIN))
    limits = []
    for side, most in ((counts[::-1], wanted[1]), (counts, wanted[0])):
        ok = side[: _BINS - edge]
        total = np.cumsum(ok)
        fits = np.flatnonzero((total <= most) & (ok > 0))
        first = np.flatnonzero(ok)
        last = fits[-1] if len(fits) else first[0] if len(first) else -1
        limits.append(int(last))
    good, bad = limits
    return (bad - _BINS if bad >= 0 else -np.inf, _BINS - 1 - good if good >= 0 else np.inf)


def histograms(rounds: list[Round], models: dict[str, Logistic], views: dict[str, np.ndarray]) -> np.ndarray:
    """Log-odds of the pool by view, a histogram each."""
    pool, _ = passed_on(rounds, views)
    out = np.zeros((len(VIEWS), 2 * _BINS))
    for k, name in enumerate(VIEWS):
        bins = _bin(models[name].logit(views[name][pool])) + _BINS
        out[k] = np.bincount(bins, minlength=2 * _BINS)
    return out


def lesson_sums(rounds: list[Round], models: dict[str, Logistic], views: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Gradient and Hessian of each view over the labels the other one passed on."""
    _, given = passed_on(rounds, views)
    out: list[np.ndarray] = []
    for name, other in zip(VIEWS, VIEWS[::-1]):
        rows = given[other] >= 0
        out += models[name].sums(views[name][rows], given[other][rows])
    return out


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    y: np.ndarray,
    settings: CoTraining,
    unlabelled: int,
    total: Callable[[Callable[[dict[str, np.ndarray]], list[np.ndarray]]], list[np.ndarray]],
) -> Model:
    """From the features and labels of the labelled documents, and sums over the others.

    ``total`` applies a function to pieces of the unlabelled documents' views and returns
    the sum of the arrays it gives; there are ``unlabelled`` of them.
    """
    good = int((y == 1).sum())
    prior = float(np.log((good + 0.5) / (len(y) - good + 0.5)))
    if good in (0, len(y)):
        return Model(None, None, prior)
    held = np.arange(len(y))[:: max(2, round(1 / settings.calibration))]
    learn = np.setdiff1d(np.arange(len(y)), held)
    if len(np.unique(y[learn])) < 2:
        learn = np.arange(len(y))
    views = {"text": text, "meta": meta}
    models = {n: Logistic.fit(x[learn], y[learn].astype(np.float64), settings.ridge) for n, x in views.items()}
    share = good / len(y)
    most = settings.share * unlabelled
    wanted = (most * (1 - share), most * share)
    rounds: list[Round] = []

    def calibrate() -> None:
        for name, x in views.items():
            models[name].calibrate(x[held], y[held].astype(np.float64))

    calibrate()
    for _ in range(settings.rounds if unlabelled else 0):
        counts = total(lambda v: [histograms(rounds, models, v)])[0]
        limits = {n: limits_of(counts[k], wanted, settings.sure) for k, n in enumerate(VIEWS)}
        rounds.append(Round({n: replace(m) for n, m in models.items()}, limits))
        for _ in range(settings.steps):
            sums = total(lambda v: lesson_sums(rounds, models, v))
            for k, (name, x) in enumerate(views.items()):
                own = models[name].sums(x[learn], y[learn])
                models[name].newton(sums[2 * k] + own[0], sums[2 * k + 1] + own[1], settings.ridge)
        calibrate()
    return Model(models["text"], models["meta"], prior)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
_BESIDE = ("lang", "source", "n_chars")
_SLICE = 1 << 16


def features(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """``(doc_id, features, lang, source, n_chars, y)`` of every row, stored once.

    ``y`` is the label of the id, by majority where it has several, else null.
    """

    def start():
        return lambda texts: [pa.array([x.tobytes() for x in text_features(texts).astype(np.float16)], pa.binary())]

    known = staging.table(
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("y")),
        "labels",
    )
    made = with_columns(
        docs.select("doc_id", "text", *_BESIDE),
        "text",
        [("features", T.BinaryType())],
        start,
        keep=["doc_id", *_BESIDE],
    )
    return staging.table(join_checked(made, known, ["doc_id"], "left"), "features")


def _views(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    raw = b"".join(batch.column("features").to_pylist())
    text = np.frombuffer(raw, np.float16).astype(np.float32).reshape(-1, TEXT_FEATURES)
    return {"text": text, "meta": meta_features(*(batch.column(c).to_pylist() for c in _BESIDE))}


def _summed(df: DataFrame, work: Callable[[dict[str, np.ndarray]], list[np.ndarray]]) -> list[np.ndarray]:
    """Sum over all rows of the arrays ``work`` makes of pieces of them.

    A task adds up its own; sums are cut into slices and added up slice by slice in
    tasks again, so that the driver gets the arrays once, whatever the number of tasks.
    """

    def partial(batches):
        sums: list[np.ndarray] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                found = work(_views(batch.slice(start, 2048)))
                sums = [a + b for a, b in zip(sums, found)] if sums else found
        if sums:
            flat = np.concatenate([s.ravel() for s in sums])
            cuts = range(0, len(flat), _SLICE)
            shape = repr([s.shape for s in sums])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i // _SLICE for i in cuts], pa.int32()),
                    pa.array([flat[i : i + _SLICE].tobytes() for i in cuts], pa.binary()),
                    pa.array([shape] * len(cuts)),
                ],
                names=["slice", "sums", "shape"],
            )

    def added(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                now = np.frombuffer(r["sums"], np.float64)
                before = found.get(r["slice"])
                found[r["slice"]] = [now if before is None else before[0] + now, r["shape"]]
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.int32()),
                    pa.array([s.tobytes() for s, _ in found.values()], pa.binary()),
                    pa.array([shape for _, shape in found.values()]),
                ],
                names=["slice", "sums", "shape"],
            )

    schema = "slice int, sums binary, shape string"
    rows = df.mapInArrow(partial, schema).repartition("slice").mapInArrow(added, schema).collect()
    if not rows:
        return []
    flat = np.concatenate([np.frombuffer(r["sums"], np.float64) for r in sorted(rows, key=lambda r: r["slice"])])
    out, at = [], 0
    for shape in ast.literal_eval(rows[0]["shape"]):
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def learn(made: DataFrame, staging: Staging, settings: CoTraining = CoTraining()) -> Model:
    """The model from stored :func:`features`.

    Of several rows of a labelled id the one with the smallest features is learned from,
    and the others are not learned from. A document without id or label is unlabelled,
    and each row of it counts.
    """
    order = F.xxhash64("doc_id"), F.col("doc_id")
    ids = made.filter("y IS NOT NULL").select("doc_id").distinct().orderBy(*order)
    picked = staging.table(ids.limit(settings.max_labelled), "picked")
    one = F.min(F.struct("features", *_BESIDE)).alias("row")
    # at most max_labelled rows
    sample = (
        made.join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "y")
        .agg(one)
        .select("doc_id", "y", "row.*")
        .toArrow()
        .sort_by("doc_id")
    )
    if not sample.num_rows:
        return Model(None, None, 0.0)
    views = _views(sample.combine_chunks().to_batches()[0])
    pool = made.filter("y IS NULL").select("features", *_BESIDE)
    return co_train(
        views["text"],
        views["meta"],
        sample.column("y").to_numpy(),
        settings,
        pool.count(),
        lambda work: _summed(pool, work),
    )


def score(made: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, text_score, meta_score, score, kept)`` for every row of :func:`features`.

    Scores are probabilities of good quality; ``kept`` means one half or more. A null
    or empty text is scored as an empty one, null metadata is a value of its own, and
    repeated rows get equal scores. Without labels of both classes every document gets
    the share of the one there is, a half if there are none. An empty table gives an
    empty one.
    """
    added = [(n, T.DoubleType()) for n in ("text_score", "meta_score", "score")]
    schema = T.StructType([made.schema["doc_id"], *[T.StructField(n, t) for n, t in added]])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                views = _views(piece)
                found = model.score(views["text"], views["meta"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(np.asarray(x, np.float64)) for x in found)],
                    names=schema.names,
                )

    return made.mapInArrow(run, schema).withColumn("kept", F.col("score") >= 0.5)


def op2_cotrain(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    staging = Staging(spark)
    made = features(docs, labels, staging)
    return score(made, learn(made, staging))


QUERIES = {"op2_cotrain": op2_cotrain}
ORACLE: dict[str, str] = {}
