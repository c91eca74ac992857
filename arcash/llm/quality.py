"""Quality classifier by co-training (operator 1).

Two views of a document: what its text says (words, and the shapes of its tokens with their
shares) and the metadata of its page (source, language, length, layout). One classifier for
each view starts from the same labelled sample. In every round each scores all unlabelled
documents, and those that it is surest of, in the proportions of the labels, go with its verdict
into the other view's training. Every round draws anew, and a larger share: a wrong verdict of an
early round can be taken back. Each view is then calibrated on labelled rows that it never
trained on, and a logistic line over both calibrated views scores every document.

Work at scale: the views' coordinates of every document are written once; a round reads them
twice, without a shuffle: for a histogram of each view's scores, from which the driver takes the
thresholds (a few thousand rows), and for the documents beyond them. These train in groups of
about ``chunk`` rows, each from the labelled rows' model on; the groups' weights are averaged by
their rows, coordinate by coordinate. So what trains grows with the corpus, and no task does. Only
the labelled rows are a documented, bounded sample: ``max_rows`` documents, least by a hash of
doc_id. Rows whose crc32(doc_id) mod 5 is 0 never train.

Defined results: null and empty texts, and null metadata, are values of their own; a document
marked poor in any of several label rows counts as poor; null labels are left out, and documents
with a label beyond the sample count as unlabelled; without labels every score is 0.5, without
other documents the labelled rows' models stand; rows that repeat a doc_id train as one (the
poorest, then least) and are scored each; documents of equal score at a threshold are taken by a
hash of doc_id; an empty table gives an empty result; a very long text is read whole and counts as
one row; other columns play no part, and those named like a score are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import BoundedCache, Scratch, read, ship, word_hash, worker_state
from arcash.llm.toxicity import Ftrl, fold, platt

ship(__name__)

LETTERS, DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
META = ("source", "lang", "n_chars")


def shape(token: str) -> str:
    """A token with each run of letters as a and of digits as 0, at most 8 characters."""
    return DIGITS.sub("0", LETTERS.sub("a", token))[:8]


def _token(token: str) -> tuple[int, str]:
    word = token.lower().strip(".,;:!?\"'()")
    return word_hash(b"w" + word.encode("utf-8", "surrogatepass")), shape(token)


def _hashed(names: list[str], bits: int) -> list[int]:
    cache = worker_state("quality", "names", lambda: BoundedCache(lambda s: word_hash(s.encode("utf-8", "surrogatepass"))))
    return [cache[s] >> (64 - bits) for s in names]


def bucket(x: float) -> int:
    """Half-octaves."""
    return int(np.floor(2 * np.log2(x))) if x > 0 else -99


def content_view(text: str | None, bits: int) -> np.ndarray:
    """Coordinates of a text: its words, and each token shape with the bucket of its share."""
    cache = worker_state("quality", "tokens", lambda: BoundedCache(_token, 300_000))
    tokens = [cache[t] for t in (text or "").split()]
    n = len(tokens)
    shapes = Counter(s for _, s in tokens)
    words = {h >> (64 - bits) for h, _ in tokens}
    names = [f"shape {s} {bucket(c / n)}" for s, c in shapes.items()]
    names.append(f"distinct {bucket(len(words) / n) if n else 'none'}")
    return np.unique(np.array([*words, *_hashed(names, bits)], np.int64)).astype(np.int32)


def metadata_view(source, lang, n_chars, text: str | None, bits: int) -> np.ndarray:
    """Coordinates of a page's metadata: source, language, length and layout."""
    text = text or ""
    lines = text.count("\n") + 1
    marks = len(LETTERS.sub("", text))
    n = None if n_chars is None or n_chars != n_chars else bucket(float(n_chars))
    spaces = text.count(" ") + lines
    names = [f"source {source}", f"lang {lang}", f"length {n}", f"lines {bucket(lines)}",
             f"line {bucket(len(text) / lines)}", f"word {bucket(len(text) / spaces)}",
             f"marks {bucket(marks / max(1, len(text)))}", f"marks {lang} {bucket(marks / max(1, len(text)))}"]
    return np.unique(np.array(_hashed(names, bits), np.int64)).astype(np.int32)


MIN_ROWS = (4, 2)       # rows that a coordinate of each view must be in
NAMES = ("content", "metadata")
BINS = 64               # histogram bins for one unit of log odds


class Base(NamedTuple):
    """What the labelled rows alone teach a view: the learner's state, and rows by coordinate."""
    z: np.ndarray
    n: np.ndarray
    intercept: float
    n0: float
    seen: np.ndarray


def learn_base(rows: list[np.ndarray], labels: np.ndarray, bits: int, min_rows: int) -> Base:
    # label 0 (poor) is the rarer class, the one evidence is sought for
    m = Ftrl(bits, l1=1.0).fit(rows, 1.0 - labels, epochs=3, min_rows=min_rows, max_clean=1.0)
    return Base(m.z, m.n, m.intercept, m.n0, counts(rows, bits))


def counts(rows: list[np.ndarray], bits: int) -> np.ndarray:
    seen = np.zeros(1 << bits, np.int32)
    for at in rows:
        seen[at] += 1
    return seen


def learner(base: Base, bits: int) -> Ftrl:
    m = Ftrl(bits, l1=1.0)
    m.z, m.n, m.intercept, m.n0 = base.z.copy(), base.n.copy(), base.intercept, base.n0
    return m


def learn_more(base: Base, rows: list[np.ndarray], labels: np.ndarray, bits: int, min_rows: int) -> Ftrl:
    """The base's learner after one visit to each row of pseudo-labels, in a mixed order."""
    m = learner(base, bits)
    use = base.seen + counts(rows, bits) >= min_rows
    for i in np.random.default_rng(7).permutation(len(rows)):
        m.learn(rows[i][use[rows[i]]], 1.0 - labels[i])
    return m


class View:
    """One classifier's weights and its calibration."""

    def __init__(self, bits: int):
        self.slope, self.shift = 1.0, 0.0
        self.weight, self.intercept = np.zeros(1 << bits, np.float32), 0.0

    def take(self, m: Ftrl) -> None:
        self.weight, self.intercept = -m.weights(slice(None)).astype(np.float32), -m.intercept

    def raw(self, at: np.ndarray) -> float:
        return float(self.weight[at].sum(dtype=np.float64)) + self.intercept

    def logit(self, at: np.ndarray) -> float:
        return float(np.clip(self.slope * self.raw(at) + self.shift, -30, 30))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class CoTrained:
    """Both views and the line that combines their calibrated logits."""

    def __init__(self, bits: int):
        self.bits = bits
        self.views = (View(bits), View(bits))
        self.line = np.array([0.5, 0.5, 0.0])
        self.exchanged: list[tuple[int, int]] = []      # rows handed to each view, by round

    def calibrate(self, raw: np.ndarray, labels: np.ndarray) -> None:
        """raw: both views' scores of labelled rows, a column each."""
        for v, s in zip(self.views, raw.T):
            v.slope, v.shift = platt(s, labels)
        logits = [np.clip(v.slope * s + v.shift, -30, 30) for v, s in zip(self.views, raw.T)]
        self.line = combine(np.array(logits).T, labels)

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[float, float, float]:
        a, b = self.views[0].logit(content), self.views[1].logit(metadata)
        return sigmoid(a), sigmoid(b), sigmoid(self.line[0] * a + self.line[1] * b + self.line[2])


def combine(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights, none negative, and shift of a logistic line over calibrated logits, lightly
    held to their mean."""
    w = np.array([0.5, 0.5, 0.0])
    x = np.column_stack([x, np.ones(len(x))])
    scale = 4.0 / (np.square(x).sum(axis=1).mean() + 1e-9)
    for _ in range(steps):
        g = x.T @ (sigmoid(x @ w) - y) / len(y) + 0.001 * (w - np.array([0.5, 0.5, 0.0]))
        w = w - scale * g
        w[:2] = np.maximum(w[:2], 0.0)
    return w


def views(bits: int):
    """A function column: both views' coordinates of a document."""
    @F.pandas_udf("content array<int>, metadata array<int>")
    def both(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "content": [content_view(t, bits) for t in text],
            "metadata": [metadata_view(s, g, n, t, bits) for s, g, n, t in zip(source, lang, n_chars, text)]})
    return both("text", *META)


def featured(docs: DataFrame, bits: int = 18) -> DataFrame:
    """doc_id and both views' coordinates of every row."""
    return docs.select("doc_id", views(bits).alias("v")).select("doc_id", "v.*")


def labelled_sample(labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, label) of the labelled documents that train: bounded, out of the held fold."""
    return (labels.where(~fold() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
            .orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(max_rows))


def raw_scores(features: DataFrame, model: CoTrained) -> DataFrame:
    """``features`` with raw: both views' log odds, uncalibrated."""
    sent = features.sparkSession.sparkContext.broadcast([(v.weight, v.intercept) for v in model.views])

    @F.pandas_udf("array<double>")
    def both(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for columns in batches:
            got = [[w[at].sum(dtype=np.float64) + b for at in rows] for (w, b), rows in zip(sent.value, columns)]
            yield pd.Series(list(np.array(got, np.float64).T))
    return features.withColumn("raw", both(*NAMES))


class Cut(NamedTuple):
    """Bins taken whole lie beyond ``k``; of bin ``k`` itself a share, by a hash of doc_id."""
    k: int
    part: float


def outermost(bins: list[tuple[int, int]], wanted: float) -> Cut | None:
    """The cut that takes ``wanted`` rows of (bin, rows) in the given order."""
    for k, n in bins:
        if wanted <= n:
            return Cut(k, wanted / n)
        wanted -= n
    return Cut(bins[-1][0], 1.0) if bins else None


def thresholds(hist: dict[int, int], wanted: float, poor: float, sure: float) -> tuple[Cut | None, Cut | None]:
    """Where the surest poor and the surest good documents begin, in the labels' proportions."""
    edge = float(np.log(sure / (1 - sure))) * BINS
    low = sorted((k, n) for k, n in hist.items() if k + 1 <= -edge)
    high = sorted(((k, n) for k, n in hist.items() if k >= edge), reverse=True)
    return outermost(low, wanted * poor), outermost(high, wanted * (1 - poor))


def score_bin(view: int) -> F.Column:
    return F.floor(F.greatest(F.lit(-35.0), F.least(F.lit(35.0), F.col("raw")[view])) * BINS).cast("int")


def histograms(scored: DataFrame) -> list[dict[int, int]]:
    """Rows by score bin, of each view; 2 x 70 x BINS rows at most come to the driver."""
    got = (scored.select(F.posexplode(F.array(score_bin(0), score_bin(1))).alias("view", "k"))
           .groupBy("view", "k").count().collect())
    return [{r["k"]: r["count"] for r in got if r["view"] == v} for v in (0, 1)]


def verdict(view: int, low: Cut | None, high: Cut | None) -> F.Column:
    """0.0 or 1.0 for a document that the view is surest of, else null."""
    k = score_bin(view)
    u = F.pmod(F.xxhash64("doc_id", F.lit(view)), F.lit(1 << 20)) / float(1 << 20)
    none = F.lit(None).cast("double")
    poor = (k < low.k) | ((k == low.k) & (u < low.part)) if low else F.lit(False)
    good = (k > high.k) | ((k == high.k) & (u < high.part)) if high else F.lit(False)
    return F.when(poor, 0.0).when(good, 1.0).otherwise(none)


def handed_over(scored: DataFrame, cuts: list) -> DataFrame:
    """(view, doc_id, label, at): what each view learns from the other's verdicts, a row an id."""
    own = F.array(*[F.struct(F.lit(v).alias("view"), verdict(1 - v, *cuts[1 - v]).alias("label"),
                             F.col(NAMES[v]).alias("at")) for v in (0, 1)])
    return (scored.select("doc_id", F.inline(own)).where(F.col("label").isNotNull())
            .groupBy("view", "doc_id").agg(F.min(F.struct("label", "at")).alias("row"))
            .select("view", "doc_id", "row.*"))


def as_rows(column: pd.Series) -> list[np.ndarray]:
    return [np.asarray(a, np.int32) for a in column]


def fit_base(known: DataFrame, bits: int) -> list[Base]:
    """Each view's state after the labelled rows that are not for calibration, a task a view."""
    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        view = int(pdf["view"].iloc[0])
        b = learn_base(as_rows(pdf["at"]), pdf["label"].to_numpy(float), bits, MIN_ROWS[view])
        return pd.DataFrame({"view": [view], "z": [b.z], "n": [b.n], "intercept": [b.intercept],
                             "n0": [b.n0], "seen": [b.seen]})
    both = F.array(*[F.struct(F.lit(v).alias("view"), F.col(NAMES[v]).alias("at")) for v in (0, 1)])
    got = known.select("doc_id", "label", F.inline(both)).groupBy("view").applyInPandas(
        learn, "view int, z array<double>, n array<double>, intercept double, n0 double, seen array<int>").toPandas()
    return [Base(np.asarray(r["z"], float), np.asarray(r["n"], float), r["intercept"], r["n0"],
                 np.asarray(r["seen"], np.int32)) for _, r in got.sort_values("view").iterrows()]


def fit_more(rows: DataFrame, base: list[Base], bits: int, groups: int) -> list[tuple[np.ndarray, float, int]]:
    """Each view's weights, intercept and rows after the pseudo-labels: trained in groups from the
    base on, averaged by the groups' rows."""
    sent = rows.sparkSession.sparkContext.broadcast(base)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        view = int(pdf["view"].iloc[0])
        m = learn_more(sent.value[view], as_rows(pdf["at"]), pdf["label"].to_numpy(float), bits, MIN_ROWS[view])
        w = -m.weights(slice(None))
        at = np.flatnonzero(w)
        # the intercept goes along as coordinate -1
        return pd.DataFrame({"view": [view], "rows": [len(pdf)], "at": [np.append(at, -1)],
                             "weight": [np.append(w[at], -m.intercept)]})
    trained = (rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(groups))).groupBy("view", "part")
               .applyInPandas(learn, "view int, rows long, at array<int>, weight array<double>"))
    # one row a coordinate: 2 ** bits of a view at most
    got = (trained.select("view", "rows", F.inline(F.arrays_zip("at", "weight")))
           .groupBy("view", "at").agg(F.sum(F.col("weight") * F.col("rows")).alias("sum"),
                                      F.sum("rows").alias("rows")).toPandas())
    out = []
    for view in (0, 1):
        mine = got[got["view"] == view]
        if mine.empty:
            m = learner(base[view], bits)
            out.append((-m.weights(slice(None)), -m.intercept, 0))
            continue
        shift = mine[mine["at"] == -1].iloc[0]
        weight, own = np.zeros(1 << bits), mine[mine["at"] >= 0]
        weight[own["at"]] = own["sum"] / shift["rows"]
        out.append((weight, float(shift["sum"] / shift["rows"]), int(shift["rows"])))
    return out


def fit(features: DataFrame, labels: DataFrame, scratch: Scratch, bits: int = 18, max_rows: int = 6_000,
        rounds: int = 3, share: float = 0.1, sure: float = 0.9, chunk: int = 20_000) -> CoTrained:
    """Co-train over ``features`` (``featured``, written): see the module's text. Round r hands over
    ``r * share`` of the unlabelled documents, of those scored ``sure`` or more of a class."""
    model = CoTrained(bits)
    # bounded: max_rows rows of an id and a label
    marked = F.broadcast(scratch.cut(labelled_sample(labels, max_rows), "marked"))
    known = scratch.cut(
        features.join(marked, "doc_id").groupBy("doc_id")
        .agg(F.min(F.struct(*NAMES)).alias("row"), F.max("label").alias("label"))
        .select("doc_id", "label", "row.*", (F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(4)) == 0).alias("check")),
        "known")
    n = {(r["check"], r["label"]): r["count"] for r in known.groupBy("check", "label").count().collect()}
    if not n:
        return model
    if sum(n.values()) < 8 or len([k for k in n if not k[0]]) < 2 or not any(k[0] for k in n):
        train, check = known, known
        n = {(False, y): sum(c for k, c in n.items() if k[1] == y) for _, y in n}
    else:
        train, check = known.where("not check"), known.where("check")
    base = fit_base(train, bits)
    for v, b in zip(model.views, base):
        v.take(learner(b, bits))
    good = sum(c for k, c in n.items() if not k[0] and k[1] == 1.0)
    poor = float(np.clip(1 - good / sum(c for k, c in n.items() if not k[0]), 0.02, 0.98))
    pool = features.where(~fold() & F.col("doc_id").isNotNull()).join(marked.select("doc_id"), "doc_id", "left_anti")
    for r in range(1, rounds + 1):
        scored = raw_scores(pool, model)
        hists = histograms(scored)
        wanted = r * share * sum(hists[0].values())
        cuts = [thresholds(h, wanted, poor, sure) for h in hists]
        if not any(c for pair in cuts for c in pair):
            break
        new = fit_more(handed_over(scored, cuts), base, bits, max(1, -(-int(wanted) // chunk)))
        for v, (weight, intercept, _) in zip(model.views, new):
            v.weight, v.intercept = weight.astype(np.float32), intercept
        model.exchanged.append((new[0][2], new[1][2]))
    got = raw_scores(check, model).select("doc_id", "label", "raw").toPandas().sort_values("doc_id", kind="stable")
    model.calibrate(np.array(got["raw"].tolist(), np.float64).reshape(-1, 2), got["label"].to_numpy(float))
    return model


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with content_score, metadata_score and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("content_score double, metadata_score double, score double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for text, source, lang, n_chars in batches:
            yield pd.DataFrame(
                [m.scores(content_view(t, m.bits), metadata_view(s, g, n, t, m.bits))
                 for t, s, g, n in zip(text, source, lang, n_chars)],
                columns=["content_score", "metadata_score", "score"], dtype="float64")
    new = ("content_score", "metadata_score", "score")
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in new]).alias("_row"),
                       scored("text", *META).alias("_s"))
    return rows.select("_row.*", "_s.*")


def score_features(features: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, content_score, metadata_score and score of every row of ``featured``."""
    sent = features.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("content_score double, metadata_score double, score double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for content, metadata in batches:
            yield pd.DataFrame([m.scores(c, d) for c, d in zip(content, metadata)],
                               columns=["content_score", "metadata_score", "score"], dtype="float64")
    return features.select("doc_id", scored(*NAMES).alias("_s")).select("doc_id", "_s.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, content_score, metadata_score, score and keep for every document."""
    scratch = Scratch(spark, "quality")
    features = scratch.cut(featured(read(spark, sf_dir, "documents").select("doc_id", "text", *META)), "features")
    model = fit(features, read(spark, sf_dir, "labels").select("doc_id", "quality"), scratch)
    return score_features(features, model).select(
        "doc_id", fold().alias("held_out"), "content_score", "metadata_score", "score",
        (F.col("score") >= 0.5).alias("keep"))
