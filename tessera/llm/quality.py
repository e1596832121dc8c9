"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are labelled rows of quality 1; the unlabelled texts are a share of the whole table,
which grows with it up to a bound. The class prior is estimated from positives and unlabelled texts alone:
a first scorer tells the two apart, and where its scores are highest the unlabelled texts' share over the
positives' share is smallest and comes down to the prior (Blanchard et al., 2010; Scott, 2015). The network
then minimises  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))  with the sigmoid loss, and where the second
term is negative it is stepped back up (Kiryo et al., 2017). Labelled negatives of the training fold play no
part in it; they and the positives only turn its output into a probability, by a logistic fit. Features are
shares and repetitions measured on the whole text; no label, language, source or id is among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.learn import Adam, fit_logistic, held_out, labelled_sample, sample_ids, sigmoid, texts_of
from tessera.runtime import ship_package, spread

N_CLASSES = 11
N_FEATURES = 2 * N_CLASSES + 14
#: At most so many labelled rows, and so many unlabelled ones, are gathered for training.
SAMPLE_ROWS, UNLABELLED_ROWS = 8000, 16_000


def _byte_classes() -> np.ndarray:
    out = np.full(256, 10, np.uint8)
    for n, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?", "#$%&*", "|<>{}[]=_/\\~^@`")):
        for c in chars:
            out[ord(c)] = n
    out[128:] = 9
    return out


_CLASSES = _byte_classes()


def features(text: str) -> np.ndarray:
    """Shares of byte classes, length, repetition of words, word triples, sentences and lines, word shapes."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    share = np.bincount(_CLASSES[b], minlength=N_CLASSES) / max(len(b), 1)
    w = text.split()
    m = max(len(w), 1)
    counts: dict[str, int] = {}
    for x in w:
        counts[x] = counts.get(x, 0) + 1
    top = max(counts.values(), default=0) / m
    sizes = np.array([len(x) for x in w] or [0], np.float64)
    sentences, lines = text.split("."), text.split("\n")
    same = sum(map(str.__eq__, w, w[1:])) / m
    triples = 1 - len(set(zip(w, w[1:], w[2:]))) / (len(w) - 2) if len(w) > 3 else 0.0
    capital = sum(x[0].isupper() for x in w) / m
    shout = sum(map(str.isupper, w)) / m
    rest = [np.log1p(m), len(counts) / m, top, same, 1 - len(set(sentences)) / len(sentences), 1 - len(set(lines)) / len(lines), triples, sizes.mean() / 10, sizes.std() / 10, min(sizes.max(), 500) / 50, capital, shout, len(lines) / m, len(sentences) / m]
    return np.concatenate([share, np.sqrt(share), rest])


class Network:
    """Standardised features, one hidden layer, then the logistic map to a probability."""

    def __init__(self, x: np.ndarray, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-6
        n = x.shape[1]
        self.params = [rng.normal(0, n**-0.5, (n, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.map = np.array([1.0, 0.0])

    def scale(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.sd, -6, 6)

    def raw(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.tanh(z @ self.params[0] + self.params[1])
        return a, a @ self.params[2] + self.params[3][0]

    def grads(self, z: np.ndarray, a: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
        back = np.outer(d, self.params[2]) * (1 - a * a)
        return [z.T @ back, back.sum(axis=0), a.T @ d, np.array([d.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.map[0] * self.raw(self.scale(x))[1] + self.map[1])


def fit_pu(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 24, epochs: int = 60, batch: int = 512, rate: float = 3e-3, seed: int = 42) -> Network:
    """Non-negative PU risk with the sigmoid loss l(z) = 1 / (1 + exp(z))."""
    net = Network(np.concatenate([pos, unl]), hidden, seed)
    p_all, u_all = net.scale(pos), net.scale(unl)
    rng, opt = np.random.default_rng(seed + 1), Adam(net.params, rate)
    steps = max(1, -(-len(u_all) // batch))
    for _ in range(epochs):
        pi, ui = rng.permutation(len(p_all)), rng.permutation(len(u_all))
        for k in range(steps):
            p = p_all[np.take(pi, range(k * batch, k * batch + min(batch, len(p_all))), mode="wrap")]
            u = u_all[ui[k * batch : (k + 1) * batch]]
            ap, fp = net.raw(p)
            au, fu = net.raw(u)
            sp, su = sigmoid(fp), sigmoid(fu)
            slope_p, slope_u = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
            negative = su.mean() - prior * sp.mean()
            if negative >= 0:
                g = [a + b for a, b in zip(net.grads(p, ap, -2 * prior * slope_p), net.grads(u, au, slope_u))]
            else:
                g = [a + b for a, b in zip(net.grads(p, ap, prior * slope_p), net.grads(u, au, -slope_u))]
            for j in (0, 2):
                g[j] += 1e-4 * net.params[j]
            opt.step(g)
    return net


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 42) -> float:
    """Share of positives among the unlabelled rows.

    A logistic scorer is fitted on one half of each; on the other half, the least ratio of the unlabelled to
    the positive share above a score, with a margin of one standard error, over thresholds that leave a tenth
    of the positives at least.
    """
    rng = np.random.default_rng(seed)
    p, u = rng.permutation(len(pos)), rng.permutation(len(unl))
    both = np.concatenate([pos, unl])
    mean, sd = both.mean(axis=0), both.std(axis=0) + 1e-6
    scale = lambda x: np.clip((x - mean) / sd, -6, 6)
    pa_, pb, ua, ub = (scale(x) for x in (pos[p[::2]], pos[p[1::2]], unl[u[::2]], unl[u[1::2]]))
    if not len(pb) or not len(ub):
        return 0.5
    w = fit_logistic(np.concatenate([pa_, ua]), np.array([1] * len(pa_) + [0] * len(ua)), l2=1e-2)
    sp, su = pb @ w[:-1] + w[-1], ub @ w[:-1] + w[-1]
    cuts = np.unique(np.quantile(sp, np.linspace(0, 0.9, 46)))
    fp = np.array([(sp >= c).mean() for c in cuts])
    fu = np.array([(su >= c).mean() for c in cuts])
    high = (fu + np.sqrt(fu * (1 - fu) / len(su))) / np.maximum(fp - np.sqrt(fp * (1 - fp) / len(sp)), 1e-9)
    return float(np.clip(high.min(), 0.02, 0.98))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS, seed: int = 42, id_col: str = "doc_id", text: str = "text"
) -> Network | None:
    """The fitted network, or nothing if no positive is labelled. Gathers at most sample_rows + unlabelled_rows feature rows."""
    spark = docs.sparkSession
    ship_package(spark)
    known = labelled_sample(labels, label, sample_rows, seed, id_col)
    ids = sample_ids(docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("__id")), unlabelled_rows, seed + 1).distinct()
    marks = known.withColumn("__u", F.lit(0)).union(ids.select("__id", F.lit(-1).alias("__y"), F.lit(1).alias("__u")))
    picked = texts_of(docs, marks.groupBy("__id").agg(F.max("__y").alias("__y"), F.max("__u").alias("__u")), id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int64()), b.column(2).cast(pa.int32()), b.column(3).cast(pa.int32()), pa.array(f, pa.list_(pa.float64()))], names=["id", "y", "u", "f"])

    got = spread(picked.select("__text", "__id", "__y", "__u")).mapInArrow(run, "id long, y int, u int, f array<double>").toArrow().sort_by([("id", "ascending")])
    y, u = got["y"].to_numpy(), got["u"].to_numpy()
    x = np.array(got["f"].to_pylist(), np.float64).reshape(-1, N_FEATURES)
    if not (y == 1).any():
        return None
    pos, unl = x[y == 1], x[u == 1] if (u == 1).any() else x
    net = fit_pu(pos, unl, estimate_prior(pos, unl, seed), seed=seed)
    if (y == 0).any():
        net.map = fit_logistic(net.raw(net.scale(x[y >= 0]))[1][:, None], y[y >= 0])
        net.map[0] = max(net.map[0], 1e-3)
    return net


def score_documents(docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    ship_package(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            s = np.full(len(texts), 0.5) if net is None else net.score(np.array([features(t) for t in texts]).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(s, pa.float64())], names=[*keep, out])

    # within, columns go by their place
    placed = docs.select(*[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(keep)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return spread(placed).mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row per document row: id, held_out, score, predicted.

    Null texts are scored as empty ones. Ids may be null (held out as crc32 of the empty text says) or
    repeat. Without a labelled positive every score is 0.5; an empty table gives an empty result. Other
    columns, whatever their names, are not read. Texts of any length are read whole.
    """
    net = train(docs, labels, id_col=id_col, text=text, **params)
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text}`").alias("text" if id_col != "text" else "body"))
    out = score_documents(rows, net, rows.columns[1], [id_col])
    return out.select(id_col, held_out(F.col(f"`{id_col}`")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """The document rows scored at the threshold or above, all columns as they are, whatever their names.

    Rows are scored as in ``quality_scores``: null texts as empty ones, and every row 0.5 where no positive is
    labelled, which keeps all rows at a threshold of 0.5 or less and none above it.
    """
    net = train(docs, labels, id_col=id_col, text=text, **params)
    name = "__score"
    while name in docs.columns:
        name += "_"
    return score_documents(docs, net, text, docs.columns, name).where(F.col(f"`{name}`") >= threshold).drop(name)
