"""Toxicity by weak supervision.

Voters look for one term each: a word, or the first letters of words. Some are
given, the others are the terms that the labelled texts show to go with toxic
texts. A generative label model has a hidden label and voters that
fire with one rate if it is 1 and another if it is 0; the given label is one more
voter, which may err. The rates are solved from how often voters fire together
over all different training texts: the covariances of any three voters give the
reach of each. What covariance is left between two voters is their correlation,
and of voters that fire together each counts the less the more it repeats the
others. Posterior labels of a sample then train a linear classifier over voters
and further terms, and that scores every text.

The sample holds at most `SAMPLE` different labelled texts, those with the
smallest hashes, and only the classifier's steps are taken on it; counts, rates
and the prior cover all rows. A term that no text of the sample holds gets its
log likelihood ratio over all labelled texts as weight. Null and empty texts have no
terms and get the classifier's constant. Rows with a null id or without label
are not learned from; conflicting labels of an id count as toxic. Without labels
only the given terms vote, at the default rate.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import stored

SAMPLE = 20_000
VOTERS = 96  # size of the label model, which is quadratic in it; all telling terms are features
ROUND = 128  # candidates compared with the voters chosen before, at a time
CELLS = 1 << 22  # bits of a bitmap of ids
REDUCERS = 32  # rows a sum of matrices may send to the driver
PREFIXES = (4, 5, 6, 7)  # letters; a prefix is written with a hyphen after it
DEFAULT_PRIOR = 0.1
DEFAULT_REACH = 0.5

# fixed values: plain insults; how far each can be trusted is estimated
GIVEN = (
    "idiot", "moron", "stupid", "scum", "trash", "loser", "clown", "worthless",
    "pathetic", "disgusting", "imbecile", "dumb", "hate", "ugly", "shut", "kill",
)

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> set[str]:
    """Words of a text and their beginnings."""
    words = set(_WORD.findall((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        per_label = (Counter(), Counter())
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            per_label[toxic.as_py()].update(terms(text.as_py()))
        for label, counts in enumerate(per_label):
            yield pa.record_batch(
                [
                    pa.array(list(counts), pa.string()),
                    pa.array([label] * len(counts), pa.int64()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["term", "toxic", "n"],
            )


def _may_be_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id may be among `ids`: a bitmap of CELLS bits, broadcast as one row."""
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS))
    words = ids.groupBy((cell / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(cell, F.lit(64)).cast("int"))).alias("bits")
    )
    found = words.toArrow()  # at most CELLS / 64 rows
    bits = np.zeros(CELLS // 64, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    one = rows.sparkSession.createDataFrame([(bits.tolist(),)], "_fl_bits array<long>")
    word = F.get("_fl_bits", (cell / 64).cast("int"))
    there = F.call_function("getbit", word, F.pmod(cell, F.lit(64)).cast("int")) == 1
    return rows.join(F.broadcast(one), there).drop("_fl_bits")


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key, text and toxic of the different labelled texts of `docs`."""
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    )
    marked = stored(marked, "marked")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the same plan at every size: few texts without label are shuffled, none with one is lost
    texts = _may_be_in(texts, marked).hint("merge")
    # copies of a text are one observation
    each = texts.join(marked, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    return stored(each.select(F.xxhash64("text").alias("key"), "text", "toxic"), "labelled")


def sample_of(labelled: DataFrame) -> DataFrame:
    """text and toxic of at most SAMPLE of the labelled texts."""
    chosen = stored(labelled.select("key").orderBy("key").limit(SAMPLE), "label-sample")
    return labelled.join(F.broadcast(chosen), "key", "left_semi").select("text", "toxic")


def telling_terms(labelled: DataFrame) -> tuple[pd.DataFrame, dict[str, tuple[int, int]], int, int]:
    """Terms that go with toxic texts beyond chance, the given terms' counts, and the labels' sizes.

    Counts are a term's toxic (a) and clean (b) labelled texts. The test is the likelihood
    ratio, at a level that falls with the number of terms tried; it bounds what is
    fetched, since more texts make few more terms telling.
    """
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counted = (
        labelled.select("text", "toxic").mapInArrow(_count_terms, "term string, toxic long, n long")
        .groupBy("term")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
        )
    )
    counted = stored(counted, "terms")
    given = {r["term"]: (r["a"], r["b"]) for r in counted.where(F.col("term").isin(*GIVEN)).collect()}
    if not toxic or not clean:
        return pd.DataFrame({"term": [], "a": [], "b": [], "g": []}), given, toxic, clean
    tried = max(2, counted.count())
    total, a, b = toxic + clean, F.col("a"), F.col("b")

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(F.lit(0.0))

    g = F.lit(0.0)
    for seen, size in ((a, toxic), (b, clean)):
        share = F.lit(size / total)
        g = g + part(seen, (a + b) * share) + part(size - seen, (F.lit(total) - a - b) * share)
    best = counted.where(a * clean > 3 * b * toxic).withColumn("g", 2 * g)
    best = best.where(F.col("g") >= 2 * math.log(tried))
    return best.orderBy(F.desc("g"), "term").toPandas(), given, toxic, clean


def firing(docs: DataFrame, features: list[str], *keep: Column) -> DataFrame:
    """The columns asked for and `fired`, the places of the features in each text."""
    place = {t: i for i, t in enumerate(features)}
    slim = docs.select(*keep, F.col("text").alias("_fl_text"))

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted(place[t] for t in terms(x.as_py()) & place.keys())
                for x in batch.column("_fl_text")
            ]
            rest = batch.drop_columns(["_fl_text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(found, pa.list_(pa.int32()))],
                names=[*rest.schema.names, "fired"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "_fl_text"]
    return slim.mapInArrow(fire, ", ".join([*fields, "fired array<int>"]))


def together(rows: DataFrame, left: list[int], right: list[int]) -> tuple[np.ndarray, int]:
    """How often features `left` and `right` fire in one text, and the number of texts.

    A task sums into one matrix and sends one row; those are summed again in at most
    REDUCERS tasks, so the driver gets no more however many tasks there are.
    """
    shape = (len(left), len(right))

    def marks(fired: pa.Array, chosen: list[int]) -> np.ndarray:
        column = np.full(max([*chosen, 0]) + 2, -1)
        column[chosen] = np.arange(len(chosen))
        flat = np.asarray(fired.flatten())
        row = np.repeat(np.arange(len(fired)), np.diff(np.asarray(fired.offsets)))
        where = column[np.minimum(flat, len(column) - 1)]
        out = np.zeros((len(fired), len(chosen)), np.float32)
        out[row[where >= 0], where[where >= 0]] = 1
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, texts = np.zeros(shape, np.int64), 0
        for batch in batches:
            fired = batch.column("fired")
            # exact: a batch has fewer rows than a float holds whole numbers
            both += (marks(fired, left).T @ marks(fired, right)).astype(np.int64)
            texts += len(fired)
        yield pa.RecordBatch.from_pydict({"both": [both.tobytes()], "texts": [texts]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, texts = np.zeros(shape, np.int64), 0
        for batch in batches:
            for part, n in zip(batch.column("both"), batch.column("texts").to_pylist(), strict=True):
                both += np.frombuffer(part.as_buffer(), np.int64).reshape(shape)
                texts += n
        if texts:
            yield pa.RecordBatch.from_pydict({"both": [both.tobytes()], "texts": [texts]})

    kind = "both binary, texts long"
    sums = rows.select("fired").mapInArrow(count, kind).repartition(REDUCERS).mapInArrow(add, kind)
    both, texts = np.zeros(shape), 0
    for part, n in sums.collect():  # at most REDUCERS
        both += np.frombuffer(bytes(part), np.int64).reshape(shape)
        texts += n
    return both, texts


def choose_voters(found: pd.DataFrame, features: list[str], fired: DataFrame) -> list[str]:
    """The given terms and the best of those that go with toxic texts.

    A term that mostly occurs in the texts of one chosen before, and is no surer
    than that, says the same and is left out. Candidates are taken in rounds: each
    round counts how often they occur with those chosen so far and with each other.
    """
    place = {t: j for j, t in enumerate(features)}
    sure = {row.term: row.a / (row.a + row.b) for row in found.itertuples()}
    own = {row.term: row.a + row.b for row in found.itertuples()}
    voters = list(GIVEN)
    candidates = [t for t in found["term"] if t not in GIVEN]
    for start in range(0, len(candidates), ROUND):
        if len(voters) >= VOTERS:
            break
        new = candidates[start : start + ROUND]
        rivals = [*voters, *new]
        both, _ = together(fired, [place[t] for t in new], [place[t] for t in rivals])
        at = {t: j for j, t in enumerate(rivals)}
        for i, term in enumerate(new):
            covered = any(
                2 * both[i, at[v]] >= own[term] for v in voters if sure.get(v, 0) >= sure[term]
            )
            if not covered and len(voters) < VOTERS:
                voters.append(term)
    return voters


@dataclass
class LabelModel:
    """Prior, the voters' firing rates given the label, and their correlations."""

    prior: float
    rate: np.ndarray  # label, voter
    rho: np.ndarray

    def log_odds(self, fired: np.ndarray) -> float:
        yes = np.log(self.rate[1] / self.rate[0])
        no = np.log((1 - self.rate[1]) / (1 - self.rate[0]))
        weight = 1 / (1 + self.rho[np.ix_(fired, fired)].sum(1))
        prior = math.log(self.prior / (1 - self.prior))
        return float(prior + no.sum() + (weight * (yes - no)[fired]).sum())


def fit_label_model(
    both: np.ndarray, rows: int, prior: float, with_label: np.ndarray, toxic: int, clean: int
) -> LabelModel:
    """Solve the model from second moments.

    With independent voters cov(i, j) = v d_i d_j, where v is the label's
    variance and d the difference of a voter's two rates. Three voters give d_i
    as the root of cov(i, j) cov(i, k) / (cov(j, k) v); here k is the given label
    and the median is over j, which is robust against voters that depend on each
    other. `with_label` counts over all labelled texts how often a voter fires on texts
    given as clean and as toxic; the rate on clean texts stays within what chance
    makes of that count.
    """
    m, rows, sample = len(both), max(rows, 1), toxic + clean
    mean = np.diag(both) / rows
    cov = both / rows - np.outer(mean, mean)
    v = prior * (1 - prior)
    floor = 0.5 / rows
    low, high = np.zeros(m), np.ones(m)
    reach = np.minimum(mean / prior, 1) * DEFAULT_REACH
    if toxic and clean:
        seen = with_label.sum(0)
        label = with_label[1] / sample - seen / sample * prior
        for i in range(m):
            others = [j for j in range(m) if j != i and cov[i, j] > 0 and label[j] > 0]
            by_three = [math.sqrt(cov[i, j] * max(label[i], 0) / (label[j] * v)) for j in others]
            reach[i] = float(np.median([*by_three, max(label[i], 0) / v]))
        wide = 2 * np.sqrt(with_label[0])
        low = np.maximum(with_label[0] - wide, 0) / (clean + 1)
        high = (with_label[0] + 3 + wide) / (clean + 1)
    off = np.clip(np.clip(mean - prior * reach, low, high), floor, 1 - floor)
    on = np.clip((mean - (1 - prior) * off) / prior, off, 1 - floor)
    rest = cov - v * np.outer(on - off, on - off)
    spread = np.sqrt(np.outer(mean * (1 - mean), mean * (1 - mean))) + 1e-12
    rho = np.clip(rest / spread, 0, 1)
    np.fill_diagonal(rho, 0)
    return LabelModel(prior, np.stack([off, on]), rho)


@dataclass
class Classifier:
    """A linear model over the presence of terms."""

    weight: dict[str, float]
    constant: float

    def score(self, text: str | None) -> float:
        z = self.constant + sum(self.weight[t] for t in terms(text) & self.weight.keys())
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def present(sample: DataFrame, features: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Features of each text of the sample, and its label."""
    out = firing(sample, features, F.col("toxic")).toPandas()  # at most SAMPLE rows
    return [np.asarray(x, np.int64) for x in out["fired"]], out["toxic"].to_numpy(np.int64)


def fit_classifier(
    rows: list[np.ndarray], posterior: np.ndarray, features: list[str], steps: int = 300
) -> Classifier:
    """Logistic regression on soft labels by gradient steps with adaptive rates."""
    n, size = max(1, len(rows)), len(features)
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate([*rows, np.zeros(0, np.int64)])
    w = np.zeros(size + 1)
    w[size] = math.log(DEFAULT_PRIOR / (1 - DEFAULT_PRIOR))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1 if len(rows) else 1):
        z = w[size] + np.bincount(which, w[what], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - posterior
        grad = np.append(np.bincount(what, error[which], minlength=size) + 0.05 * w[:size], error.sum()) / n
        first += 0.1 * (grad - first)
        second += 0.001 * (grad**2 - second)
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Classifier(dict(zip(features, w[:size].tolist(), strict=True)), float(w[size]))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Voters, label model and classifier from the training rows `docs`."""
    labelled = labelled_texts(docs, labels)
    found, given, toxic, clean = telling_terms(labelled)
    features = [*GIVEN, *[t for t in found["term"] if t not in GIVEN]]
    voters = choose_voters(found, features, stored(firing(labelled, features), "labelled-features"))
    prior = toxic / (toxic + clean) if toxic and clean else DEFAULT_PRIOR
    counts = given | {row.term: (row.a, row.b) for row in found.itertuples()}
    with_label = np.array([counts.get(v, (0, 0))[::-1] for v in voters], float).T
    # voters first among the features
    features = list(dict.fromkeys([*voters, *features]))
    rows, _ = present(sample_of(labelled), features)
    votes = firing(docs, voters, F.xxhash64("text").alias("key")).dropDuplicates(["key"])
    every = list(range(len(voters)))
    both, texts = together(votes, every, every)
    model = fit_label_model(both, texts, prior, with_label, toxic, clean)
    odds = np.array([model.log_odds(r[r < len(voters)]) for r in rows])
    posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    classifier = fit_classifier(rows, posterior, features)
    sampled = set(np.concatenate([*rows, np.zeros(0, np.int64)]).tolist())
    unseen = set(features) - {features[i] for i in sampled}
    for row in found[found["term"].isin(unseen)].itertuples():
        ratio = (row.a + 0.5) / (toxic + 1) * (clean + 1) / (row.b + 0.5)
        classifier.weight[row.term] = math.log(ratio)
    return classifier


def scored(docs: DataFrame, classifier: Classifier, *keep: Column) -> DataFrame:
    """The columns asked for and the score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    slim = docs.select(*keep, F.col("text").alias("_fl_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = pa.array([own.score(t.as_py()) for t in batch.column("_fl_text")], pa.float64())
            rest = batch.drop_columns(["_fl_text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, found], names=[*rest.schema.names, "score"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "_fl_text"]
    return slim.mapInArrow(score, ", ".join([*fields, "score double"]))
