"""Toxicity by weak supervision.

1. Lexicons. Words and word beginnings that are much more frequent in toxic rows are learned from a
   bounded sample of labelled rows, separately on two halves. Whatever has enough evidence is an entry.
2. Voters. The lexicons are dealt into many small ones, which vote "toxic" or abstain; patterns of
   shouting, insulting address and density vote as well. They vote on every row of the table; rows outside the
   labelled sample take part without a label. For fitting, a row of one half is voted on with the other half's
   lexicons, so no voter has seen the row's label. Rows with equal votes and sums are counted as one.
3. Label model. A generative model of the hidden class and the votes, in which a vote depends on the class
   and on one other vote: expectation maximisation estimates each voter's accuracy and the pairwise
   correlations within both classes, and the strongest correlations (the tree of greatest conditional
   mutual information) enter the model. Labels count as evidence for accuracies and correlations alone;
   every row's posterior comes from its votes. Where rows without a label outnumber the sample, each weighs
   in proportion less, so that together they weigh as much as the sample, however large the table is. Every step is
   a sum over the counted votes, made by the tasks; only sums come to the driver.
4. Classifier. A logistic regression on the votes and hit counts is trained on the posteriors of all rows, with
   the same weights and by the same kind of sums, and scores the whole table.

Defined results: null and empty texts get the score of a text without hits; without labelled rows
of both classes no lexicon can be learned and every score is the prior (0 without rows); repeated
rows score alike and weigh once each; an empty table gives no rows; ties in the sample's order go by id; rows
with a null id have no label. A very
long text is scored whole, in time and memory in proportion to its length. Null labels count as none. Extra columns are carried along; an input column named ``score`` is replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.common import Scratch, make_room, table

#: Labelled rows that are learned from at most, chosen by a hash of their id.
SAMPLE = 12_000
#: The least evidence for a lexicon entry: rows, log odds, and log odds in standard errors. The sample bounds their number.
LEAST_ROWS, LEAST_ODDS, LEAST_Z = 3, 1.5, 3.0
#: Small lexicons that vote: each holds the entries of one band of log odds.
LEXICONS, BAND = 24, 0.25
PREFIXES = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")
# Words of address in the corpus languages.
ADDRESS = frozenset("you your du dein ihr tu toi vous vos usted eres".split())
N_PATTERNS = 4
N_FEATURES = LEXICONS + N_PATTERNS
ROUNDS, RIDGE = 60, 1e-3


def features_of(text: str | None) -> tuple[set[str], int]:
    """Distinct lower-case words and marked word beginnings, and the number of words."""
    words = WORD.findall((text or "").lower())
    distinct = set(words)
    return distinct | {f"{w[:k]}*" for k in PREFIXES for w in distinct if len(w) > k}, len(words)


def _count_features(batches):
    """(feature, half, rows with label 1, rows with label 0), summed within the task."""
    held: dict[tuple[str, int], list[int]] = {}

    def rows():
        keys = list(held)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
        columns += [pa.array([v[i] for v in held.values()], pa.int64()) for i in (0, 1)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, ["feature", "half", "pos", "neg"])

    for batch in batches:
        for text, half, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            for f in features_of(text)[0]:
                held.setdefault((f, half), [0, 0])[0 if toxic else 1] += 1
        if len(held) > 400_000:
            yield rows()
    yield rows()


class Lexicon:
    """Entries with their log odds, in small lexicons by bands of them."""

    def __init__(self, entries: list[tuple[str, float]]):
        ordered = sorted(entries, key=lambda e: (-e[1], e[0]))
        self.odds = dict(ordered)
        self.voter = {f: min(LEXICONS - 1, max(0, int((odds - LEAST_ODDS) / BAND))) for f, odds in ordered}
        self.known = frozenset(self.odds)
        lengths = {len(f) - 1 for f in self.known if f.endswith("*")}
        self.prefixes = {k: {f[:-1] for f in self.known if f.endswith("*") and len(f) == k + 1} for k in lengths}

    def hits(self, text: str | None) -> tuple[list[str], list[str]]:
        words = WORD.findall((text or "").lower())
        distinct = set(words)
        found = list(self.known & distinct)
        for k, known in self.prefixes.items():
            found += [f"{p}*" for p in known & {w[:k] for w in distinct if len(w) > k}]
        return found, words

    def vector(self, text: str | None) -> np.ndarray:
        """Votes (0 or 1) of the small lexicons and of the patterns, then the hits' summed and greatest log odds."""
        out = np.zeros(N_FEATURES + 2)
        found, words = self.hits(text)
        for f in found:
            out[self.voter[f]] = 1
        total = sum(self.odds[f] for f in found)
        exact = [f for f in found if not f.endswith("*")]
        raw = text or ""
        out[LEXICONS] = len(exact) >= 2
        out[LEXICONS + 1] = bool(exact) and not ADDRESS.isdisjoint(words)
        out[LEXICONS + 2] = bool(raw) and sum(map(raw.count, "!?")) > len(raw) / 20
        out[LEXICONS + 3] = total > 0 and total > len(words) / 20
        out[N_FEATURES] = math.log1p(max(0.0, total))
        out[N_FEATURES + 1] = max((self.odds[f] for f in found), default=0.0)
        return out


def masses(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of rows with these weights: their sum, each voter's votes, and how often every two voters vote together."""
    return np.concatenate([[weight.sum()], weight @ votes, ((votes * weight[:, None]).T @ votes).ravel()])


def smoothed(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rates of single voters and of pairs from their masses."""
    m = math.isqrt(len(total))  # 1 + m + m * m numbers
    n = total[0] + 2
    return (total[1 : m + 1] + 1) / n, (total[m + 1 :].reshape(m, m) + 0.5) / n


def rates(votes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with these weights: each voter's rate, and how often two voters vote together; both smoothed."""
    return smoothed(masses(votes, weight))


def information(single: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Mutual information of every two voters."""
    total = np.zeros_like(both)
    a, b = single[:, None], single[None, :]
    for joint, x, y in ((both, a, b), (a - both, a, 1 - b), (b - both, 1 - a, b), (1 - a - b + both, 1 - a, 1 - b)):
        joint = np.clip(joint, 1e-9, 1)
        total += joint * np.log(joint / np.clip(x * y, 1e-9, 1))
    np.fill_diagonal(total, 0)
    return total


def strongest_tree(weights: np.ndarray) -> np.ndarray:
    """Each node's parent in the spanning tree of greatest weight; -1 for the root."""
    m = len(weights)
    parent, best, done = np.full(m, -1), np.full(m, -np.inf), np.zeros(m, bool)
    best[0] = 0
    for _ in range(m):
        i = int(np.where(done, -np.inf, best).argmax())
        done[i] = True
        closer = ~done & (weights[i] > best)
        best[closer], parent[closer] = weights[i][closer], i
    return parent


def vote_odds(votes: np.ndarray, tree: np.ndarray, one: tuple, zero: tuple) -> np.ndarray:
    """Log odds of class 1 that each row's votes give, every vote judged given its parent's vote."""
    out = np.zeros(len(votes))
    for i, p in enumerate(tree):
        chance = []
        for single, both in (one, zero):
            if p < 0:
                on = np.full(len(votes), single[i])
            else:
                on = np.where(votes[:, p] > 0, both[i, p] / single[p], (single[i] - both[i, p]) / (1 - single[p]))
            on = np.clip(on, 1e-4, 1 - 1e-4)
            chance.append(np.where(votes[:, i] > 0, on, 1 - on))
        out += np.log(chance[0]) - np.log(chance[1])
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def posterior(votes: np.ndarray, prior: float, model: tuple | None) -> np.ndarray:
    """Probability of class 1 that each row's votes give; without a model, a guess by their number."""
    if model is None:
        return np.where(votes.sum(1) >= 2, 0.8, 0.1)
    return logistic(math.log(prior / (1 - prior)) + vote_odds(votes, *model))


def class_masses(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray, prior: float, model: tuple | None) -> np.ndarray:
    """Masses of class 1 and of class 0; a row without a label (nan) belongs to both by its posterior."""
    share = np.where(np.isnan(gold), posterior(votes, prior, model), np.nan_to_num(gold))
    return np.stack([masses(votes, weight * share), masses(votes, weight * (1 - share))])


def estimate(measure) -> tuple:
    """The label model (tree, rates of class 1, rates of class 0). ``measure`` gives the class masses under a model."""
    model = None
    for round_ in range(ROUNDS):
        totals = measure(model)
        one, zero = map(smoothed, totals)
        if round_ <= ROUNDS // 2:  # later rounds keep the tree, so that the steps settle
            share = totals[0][0] / max(totals[0][0] + totals[1][0], 1e-9)
            tree = strongest_tree(share * information(*one) + (1 - share) * information(*zero))
        settled = model is not None and (tree == model[0]).all() and all(np.abs(a[1] - b[1]).max() < 1e-6 for a, b in zip((one, zero), model[1:]))
        model = (tree, one, zero)
        if settled:
            break
    return model


def label_model(votes: np.ndarray, gold: np.ndarray, prior: float) -> np.ndarray:
    """Posterior of class 1 for every row of a small table. ``votes`` are 0/1; ``gold`` is 0, 1 or nan where there is no label."""
    weight = np.ones(len(votes))
    return posterior(votes, prior, estimate(lambda model: class_masses(votes, gold, weight, prior, model)))


def slopes(x: np.ndarray, target: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted gradient and curvature of the logistic loss at ``w`` (the last weight is the constant), and the rows' weight."""
    x = np.column_stack([x, np.ones(len(x))])
    p = logistic(x @ w)
    return np.concatenate([(weight * (p - target)) @ x, ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel(), [weight.sum()]])


def fit_logistic(measure, size: int) -> np.ndarray:
    """Weights by Newton steps on soft labels, with a ridge. ``measure`` gives the slopes at some weights."""
    w = np.zeros(size)
    for _ in range(30):
        total = measure(w)
        gradient = total[:size] / total[-1] + RIDGE * w
        step = np.linalg.solve(total[size:-1].reshape(size, size) / total[-1] + RIDGE * np.eye(size), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _lexicons(scratch: Scratch, counts: DataFrame, pos: list[int], neg: list[int]) -> list[Lexicon]:
    """Lexicons of half 0, of half 1 and of both. The entries come to the driver: the sample has a bounded number of rows, and an entry needs several."""
    sides = counts.groupBy("feature").agg(*[F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for h in (0, 1) for c in ("pos", "neg")])
    sides = scratch.settle(sides.where(F.col("pos0") + F.col("pos1") >= LEAST_ROWS), "features")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        p, n = sum(pos[h] for h in halves), sum(neg[h] for h in halves)
        if not p or not n:
            out.append(Lexicon([]))
            continue
        a, b = sum(F.col(f"pos{h}") for h in halves) + 0.5, sum(F.col(f"neg{h}") for h in halves) + 0.5
        odds = F.log(a / (p + 1.0)) - F.log(b / (n + 1.0))
        z = odds / F.sqrt(1 / a + 1 / b)
        best = sides.select("feature", odds.alias("odds"), z.alias("z"), a.alias("rows")).where((F.col("rows") > LEAST_ROWS) & (F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
        out.append(Lexicon([(r.feature, r.odds) for r in best.collect()]))
    return out


def _half(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(F.xxhash64(doc_id)), F.lit(2)).alias("half")


def _vote(batches, lexicons):
    """(votes, total, most, toxic, n): rows with equal votes (as bits) and sums, counted within the task."""
    held: dict[tuple, int] = {}

    def rows():
        columns = list(zip(*held)) or [()] * 4
        kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int64())
        out = [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(list(held.values()), pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["votes", "total", "most", "toxic", "n"])

    for batch in batches:
        for text, half, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            *votes, total, most = lexicons[1 - half].vector(text).tolist()
            key = (sum(1 << i for i, v in enumerate(votes) if v), total, most, toxic)
            held[key] = held.get(key, 0) + 1
        if len(held) > 100_000:
            yield rows()
    yield rows()


def _voted(batch: pa.RecordBatch, lighter: float, use_labels: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes, labels (nan where there is none) and weights of counted rows."""
    bits = batch.column("votes").to_numpy()
    label = batch.column("toxic").cast(pa.float64()).to_numpy(zero_copy_only=False)
    weight = batch.column("n").to_numpy() * np.where(np.isnan(label), lighter, 1.0)
    votes = (bits[:, None] >> np.arange(N_FEATURES) & 1).astype(float)
    return votes, label if use_labels else np.full(len(label), np.nan), weight


def _summed(df: DataFrame, work) -> np.ndarray:
    """The sum over all batches of ``df`` of the numbers that ``work`` makes of a batch; tasks add up their own first."""

    def add(batches):
        found = [work(b) for b in batches if b.num_rows]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(found, axis=0).tolist()], pa.list_(pa.float64()))], ["x"])

    numbers = df.mapInArrow(add, "x array<double>").select(F.posexplode("x").alias("i", "x"))
    return np.array([r.x for r in sorted(numbers.groupBy("i").agg(F.sum("x").alias("x")).collect())])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", use_labels: bool = True) -> tuple[Lexicon, np.ndarray]:
    """The final lexicon and the classifier's weights. ``docs`` has doc_id and text, ``labels`` doc_id and toxic.

    Without ``use_labels`` only the lexicons learn from labels, not the label model.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    sample = scratch.settle(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "sample")
    own = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    # at most SAMPLE rows of two numbers are broadcast, here and below
    rows = scratch.settle(own.join(F.broadcast(sample), "doc_id").select("text", _half(), "toxic"), "rows")
    sizes = {(r.half, r.toxic): r.n for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    pos = [sum(v for (h, t), v in sizes.items() if h == half and t) for half in (0, 1)]
    neg = [sum(v for (h, t), v in sizes.items() if h == half and not t) for half in (0, 1)]
    n = sum(pos) + sum(neg)
    if not sum(pos) or not sum(neg):
        scratch.drop()
        prior = sum(pos) / max(1, n)
        w = np.zeros(N_FEATURES + 3)
        w[-1] = math.log(max(prior, 1e-9) / max(1 - prior, 1e-9))
        return Lexicon([]), w
    counts = rows.mapInArrow(_count_features, "feature string, half long, pos long, neg long")
    lexicons = _lexicons(scratch, counts, pos, neg)
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)
    every = own.join(F.broadcast(sample), "doc_id", "left").select("text", _half(), "toxic")
    voted = every.mapInArrow(lambda batches: _vote(batches, shared.value), "votes long, total double, most double, toxic long, n long")
    voted = scratch.settle(voted.groupBy("votes", "total", "most", "toxic").agg(F.sum("n").alias("n")), "voted")
    patterns = scratch.settle(voted.groupBy("votes", "toxic").agg(F.sum("n").alias("n")), "patterns")
    others = voted.where("toxic IS NULL").agg(F.sum("n")).first()[0] or 0
    lighter, prior = min(1.0, n / max(1, others)), sum(pos) / n

    def measured(model):
        return _summed(patterns, lambda b: class_masses(*_voted(b, lighter, use_labels), prior, model).ravel()).reshape(2, -1)

    model = estimate(measured)

    def sloped(w):
        def work(batch):
            votes, _, weight = _voted(batch, lighter, use_labels)
            x = np.column_stack([votes, batch.column("total").to_numpy(), batch.column("most").to_numpy()])
            return slopes(x, posterior(votes, prior, model), weight, w)

        return _summed(voted, work)

    weights = fit_logistic(sloped, N_FEATURES + 3)
    scratch.drop()
    return lexicons[2], weights


def score_toxicity(docs: DataFrame, model: tuple[Lexicon, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1)."""
    docs = make_room(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def score(batches):
        lexicon, w = shared.value
        for batch in batches:
            x = np.array([lexicon.vector(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, -1)
            p = logistic(x @ w[:-1] + w[-1]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(score, docs.select("*", F.lit(0.0).alias("score")).schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted")
    )
