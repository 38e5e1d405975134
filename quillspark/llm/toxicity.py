"""Operator 2: toxicity by weak supervision.

Many voters (lexicons and patterns) look at every document. A generative model
estimates from all votes how often each fires on toxic and on clean texts and
which voters depend on one another; its posteriors are the labels that a
linear classifier is trained on, and the classifier scores every text. No
voter is made of others: terms with one beginning belong to one voter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import is_small, stash

#: Lexicons that hold for any corpus (English insults and threats).
LEXICONS = {
    "insult": "idiot idiots moron morons stupid dumb dumbass imbecile clown clowns loser losers fool fools jerk jerks",
    "contempt": "worthless pathetic disgusting scum trash garbage vermin filth filthy subhuman parasite parasites",
    "threat": "kill murder die hang shoot lynch exterminate",
}
#: Patterns, each a voter of its own: a share of the text or a number of hits from which it fires.
_SHOUT = re.compile(r"\b[^\W\d_]{3,}\b")
_MASKED = re.compile(r"\b[^\W\d_]+[*#@$]{2,}[^\W\d_]+\b")
_ADDRESS = re.compile(r"\byou(?:'re| are|)\s+(?:an?\s+|such\s+|all\s+|so\s+)*(\w+)", re.IGNORECASE)
_BANGS = re.compile(r"!{2,}")
_WORD = re.compile(r"[^\W\d_]+")

#: Voters whose lexicons are induced from labelled rows; families of terms are dealt among them in turn.
INDUCED = 8
PATTERNS = ("shouting", "bangs", "masked", "address")
VOTERS = [*LEXICONS, *PATTERNS, *(f"induced_{k}" for k in range(INDUCED))]
#: Beginnings of words that count as terms, in letters.
PREFIXES = range(3, 8)
#: A term marks a text of the sample, and an induced voter fires, if one of so many words at least is a hit. Chance
#: hits grow with a text's length, shares do not.
TERM_EACH, VOTE_EACH = 300, 200
#: Features of a text besides terms and votes: one hit at least in so many words, and so many hits.
SHARES, HITS = (1000, 300, 100, 50), (1, 2, 4)


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def _terms(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


class Reader:
    """Votes and features of one text after another, for a given induced lexicon."""

    def __init__(self, terms: list[str], remembered: int = 200_000):
        self.number = {term: k for k, term in enumerate(terms)}
        families: dict[str, int] = {}
        self.voter = [families.setdefault(term[: PREFIXES[0]], len(families)) % INDUCED for term in terms]
        self.fixed = {w: k for k, words in enumerate(LEXICONS.values()) for w in words.split()}
        self.cache: dict[str, tuple[tuple[int, ...], frozenset[int]]] = {}
        self.remembered = remembered

    def _hits(self, word: str) -> tuple[tuple[int, ...], frozenset[int]]:
        """Numbers of the terms that a word holds, and of their voters."""
        if (hits := self.cache.get(word)) is None:
            if len(self.cache) >= self.remembered:
                self.cache.clear()
            terms = tuple(self.number[t] for t in _terms(word) if t in self.number)
            hits = self.cache[word] = terms, frozenset(self.voter[t] for t in terms)
        return hits

    def read(self, text: str | None) -> tuple[int, list[int]]:
        """(votes as bits, numbers of the features that hold); an empty text has neither."""
        if not text:
            return 0, []
        lower = text.lower()
        words = Counter(_WORD.findall(lower))
        length, many, heard = words.total(), 0, [0] * INDUCED
        votes, features = 0, set()
        for word, count in words.items():
            terms, voters = self._hits(word)
            if terms:
                features.update(terms)
                many += count
                for k in voters:
                    heard[k] += count
        start, total = len(LEXICONS), len(self.number)
        for k, count in enumerate(heard):
            if count and count * VOTE_EACH >= length:
                votes |= 1 << start + len(PATTERNS) + k
        for word in words.keys() & self.fixed.keys():
            votes |= 1 << self.fixed[word]
        if "!!" in text and len(_BANGS.findall(text)) * 4 > len(words):
            votes |= 1 << start + 1
        if text != lower and 2 * sum(map(str.isupper, text)) > sum(map(str.isalpha, text)):
            votes |= 1 << start
        if _MASKED.search(text):
            votes |= 1 << start + 2
        if "you" in lower and any(w in self.fixed for w in _ADDRESS.findall(lower)):
            votes |= 1 << start + 3
        out = sorted(features)
        out += [total + k for k in range(len(VOTERS)) if votes >> k & 1]
        total += len(VOTERS)
        out += [total + k for k, each in enumerate(SHARES) if many and many * each >= length]
        out += [total + len(SHARES) + k for k, least in enumerate(HITS) if many >= least]
        return votes, out

    @property
    def size(self) -> int:
        return len(self.number) + len(VOTERS) + len(SHARES) + len(HITS)


@dataclass
class LabelModel:
    """A latent label, voters that depend on it, and for each at most one voter that it also depends on.

    A voter that never fires, or fires about as often on given clean as on given
    toxic labels, says nothing: its chances stay at one half. Rows without a
    given label weigh ``unlabelled`` of a row each while the model is fitted, so
    that the many do not turn the latent label into some other division of the
    texts (such as by language).
    """

    prior: float = 0.1
    parent: list[int] = field(default_factory=list)
    #: chance[j, y, s]: that voter j fires on label y while its parent is in state s.
    chance: np.ndarray | None = None
    #: Chance that a given label says toxic on clean and on toxic texts.
    given: np.ndarray = field(default_factory=lambda: np.array([0.02, 0.95]))
    unlabelled: float = 0.1
    #: Voters that say something.
    used: list[int] = field(default_factory=list)

    def log_likelihood(self, votes: np.ndarray) -> np.ndarray:
        """For each row of votes (0 or 1) and label, without the prior."""
        state = np.where(np.array(self.parent) >= 0, votes[:, np.maximum(self.parent, 0)], 0)
        out = np.zeros((len(votes), 2))
        for y in (0, 1):
            p = self.chance[np.arange(votes.shape[1]), y, state]
            out[:, y] = np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1)
        return out

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Chance of toxic; ``label`` is -1 where none is given."""
        logs = self.log_likelihood(votes) + np.log([1 - self.prior, self.prior])
        said = np.where(label[:, None] == 1, self.given, 1 - self.given)
        logs += np.where(label[:, None] < 0, 0.0, np.log(said))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))

    def fit(self, votes: np.ndarray, label: np.ndarray, count: np.ndarray, rounds: int = 50) -> LabelModel:
        """Expectation maximisation on counted vote patterns; then again with the strongest dependencies.

        It starts from the given labels and, elsewhere, from how many of the used voters fire.
        """
        self.parent, self.used = [-1] * votes.shape[1], self._speaking(votes, label, count)
        fired = votes[:, self.used].sum(axis=1)
        start = np.where(label == 1, 0.95, np.where(label == 0, 0.02, np.array([0.03, 0.3, 0.8])[np.minimum(fired, 2)]))
        weight = np.where(label >= 0, 1.0, self.unlabelled) * count
        for stage in range(2):
            q = start if stage == 0 else self.posterior(votes, label)
            if stage:
                for j, parent in zip(self.used, self._tree(votes[:, self.used], q, weight), strict=True):
                    self.parent[j] = self.used[parent] if parent >= 0 else -1
            for _ in range(rounds):
                self._maximise(votes, label, weight, q)
                now = self.posterior(votes, label)
                if np.abs(now - q).max() < 1e-6:
                    break
                q = now
        return self

    @staticmethod
    def _speaking(votes: np.ndarray, label: np.ndarray, count: np.ndarray, least: float = 1.5) -> list[int]:
        """Voters that fire, and ``least`` times as often on given toxic as on given clean labels (if there are both)."""
        fires = count @ votes
        clean, toxic = (count * (label == y) for y in (0, 1))
        if not clean.sum() or not toxic.sum():
            return np.nonzero(fires)[0].tolist()
        rates = [(w @ votes + 0.5) / (w.sum() + 1) for w in (clean, toxic)]
        return np.nonzero((fires > 0) & (rates[1] > least * rates[0]))[0].tolist()

    def _maximise(self, votes: np.ndarray, label: np.ndarray, count: np.ndarray, q: np.ndarray) -> None:
        weight = np.stack([count * (1 - q), count * q])
        self.prior = float(np.clip(weight[1].sum() / max(count.sum(), 1), 1e-4, 1 - 1e-4))
        self.chance = np.full((votes.shape[1], 2, 2), 0.5)
        for j in self.used:
            parent = self.parent[j]
            state = votes[:, parent] if parent >= 0 else np.zeros(len(votes), dtype=int)
            for y in (0, 1):
                for s in (0, 1):
                    here = weight[y] * (state == s)
                    base = (weight[y] @ votes[:, j] + 0.5) / (weight[y].sum() + 1)
                    self.chance[j, y, s] = (here @ votes[:, j] + 2 * base) / (here.sum() + 2)
        self.chance = np.clip(self.chance, 0.003, 0.997)
        known = label >= 0
        for y in (0, 1):
            share = (weight[y][known] @ label[known] + (0.95 if y else 0.02) * 20) / (weight[y][known].sum() + 20)
            self.given[y] = np.clip(share, 1e-3, 1 - 1e-3)

    @staticmethod
    def _tree(votes: np.ndarray, q: np.ndarray, count: np.ndarray, least: float = 1e-3) -> list[int]:
        """Maximum spanning tree of the voters' dependence within labels (weak edges are left out)."""
        voters, total = votes.shape[1], count.sum()
        if not voters:
            return []
        gain = np.zeros((voters, voters))
        for weight in (count * q, count * (1 - q)):
            both = (votes * weight[:, None]).T @ votes
            one, mass = votes.T @ weight, weight.sum()
            for s, t, joint in (
                (1, 1, both), (1, 0, one[:, None] - both), (0, 1, one[None, :] - both),
                (0, 0, mass - one[:, None] - one[None, :] + both),
            ):
                a, b = (one if s else mass - one), (one if t else mass - one)
                alone = np.outer(a, b) / max(mass, 1e-9)
                gain += np.where((joint > 1e-9) & (alone > 1e-9), joint * np.log(np.maximum(joint, 1e-9) / np.maximum(alone, 1e-9)), 0)
        gain /= max(total, 1)
        parent, inside = [-1] * voters, {0}
        while len(inside) < voters:
            value, j, k = max((gain[i, k], i, k) for i in inside for k in range(voters) if k not in inside)
            parent[k] = j if value >= least else -1
            inside.add(k)
        return parent


def induce_terms(sample: DataFrame, limit: int, least: int = 3) -> list[str]:
    """Terms that mark toxic rows of the sample: words and beginnings of words, strongest first.

    A term counts for a row where one of ``TERM_EACH`` words holds it at least.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label"), strict=True):
                held: Counter = Counter()
                words = Counter(_WORD.findall((text.as_py() or "").lower()))
                for word, count in words.items():
                    for term in _terms(word):
                        held[term] += count
                length = words.total()
                counts[label.as_py()].update(t for t, count in held.items() if count * TERM_EACH >= length)
        terms = list(counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)],
            ["term", "clean", "toxic"],
        )
        rest = [t for t in counts[0] if t not in counts[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rest, pa.string()), pa.array([counts[0][t] for t in rest], pa.int64()), pa.array([0] * len(rest), pa.int64())],
            ["term", "clean", "toxic"],
        )

    terms = sample.mapInArrow(each, "term string, clean long, toxic long")
    terms = terms.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least)
    sums = sample.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    lift = F.log(((F.col("toxic") + 0.5) / (sums[1] + 1)) / ((F.col("clean") + 0.5) / (sums[0] + 1)))
    pure = F.col("toxic") >= 2 * F.col("clean")
    strong = terms.where(pure & (lift > 2)).orderBy(F.desc(F.col("toxic") * lift), "term").limit(limit)
    return [row.term for row in strong.select("term").collect()]  # at most ``limit`` strings


def fit_classifier(rows: list[tuple[list[int], float]], size: int, ridge: float = 3e-4, rounds: int = 400) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression on soft labels, by accelerated gradient steps."""
    weights = np.zeros(size + 1)
    if not rows:
        return weights
    lengths = np.array([len(x) for x, _ in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    columns = np.concatenate([np.asarray(x, dtype=np.int64) for x, _ in rows]) if lengths.sum() else np.zeros(0, dtype=np.int64)
    scale = 1 / np.sqrt(np.maximum(lengths, 1))
    value, target = scale[owner], np.array([y for _, y in rows])
    ahead, momentum, rate = weights.copy(), 1.0, 4.0
    for _ in range(rounds):
        score = np.bincount(owner, value * ahead[columns], len(rows)) + ahead[-1]
        error = 1 / (1 + np.exp(-np.clip(score, -40, 40))) - target
        slope = np.append(np.bincount(columns, value * error[owner], size), error.sum()) / len(rows)
        slope[:-1] += ridge * ahead[:-1]
        following = ahead - rate * slope
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = following + (momentum - 1) / after * (following - weights)
        weights, momentum = following, after
    return weights


def score_of(features: list[int] | np.ndarray, weights: np.ndarray) -> float:
    columns = np.asarray(features, dtype=np.int64)
    raw = weights[columns].sum() / np.sqrt(max(len(columns), 1)) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(raw, -40, 40))))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = 12_000,
    lexicon_terms: int = 1_024,
    threshold: float = 0.7,
) -> DataFrame:
    """Toxicity of every whole text: the id column, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Labels count only where ``held_out`` is false; a score depends on the text
    alone. From at most ``fit_rows`` labelled rows (those first by MD5 of their
    id) at most ``lexicon_terms`` terms are induced and dealt among lexicon
    voters. All documents are read once: their vote patterns, counted over the
    whole table (never more than two to the number of voters, times three),
    fit the label model, whose posteriors of the ``fit_rows`` rows train the
    classifier.

    Defined cases: null and empty texts have no votes and get the score of a
    text without any feature; an id with several labels takes the largest;
    labels that are null or not 0 or 1, or belong to no document, are left
    out; a row with a null id is scored, never trained on, and not held out.
    Repeated rows give repeated results; of several texts under one id of the
    sample one is trained on. Without usable labels only the fixed
    lexicons and patterns vote. Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    first = known.orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(fit_rows)
    first = F.broadcast(stash(first, "chosen"))  # at most fit_rows ids
    sample = stash(texts.join(first, "id"), "sample")
    terms = spark.sparkContext.broadcast(induce_terms(sample, lexicon_terms))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms.value)
        for batch in batches:
            found = [reader.read(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([v for v, _ in found], pa.int32()),
                    pa.array([f for _, f in found], pa.list_(pa.int32())),
                ],
                ["id", "votes", "features"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    seen = stash(texts.mapInArrow(votes, f"id {kind}, votes int, features array<int>"), "votes")
    narrow = F.broadcast(known) if is_small(known) else known
    labelled = seen.join(narrow, "id", "left").withColumn("label", F.coalesce("label", F.lit(-1)))
    patterns = np.array(labelled.groupBy("votes", "label").count().collect(), dtype=np.int64).reshape(-1, 3)
    model = LabelModel()
    bits = (patterns[:, :1] >> np.arange(len(VOTERS))) & 1
    if len(patterns):
        model.fit(bits, patterns[:, 1], patterns[:, 2].astype(float))
    taught = labelled.join(first.select("id"), "id", "left_semi").groupBy("id").agg(F.min(F.struct("votes", "label", "features")).alias("row"))
    taught = taught.select("row.*").collect()  # one row for each id of the sample
    rows = []
    if taught:
        marks = np.array([[r.votes, r.label] for r in taught], dtype=np.int64)
        chance = model.posterior((marks[:, :1] >> np.arange(len(VOTERS))) & 1, marks[:, 1])
        rows = [(r.features, y) for r, y in zip(taught, chance.tolist(), strict=True)]
    weights = fit_classifier(rows, Reader(terms.value).size)
    if not rows:  # without labels any fixed lexicon or pattern that fires marks a text
        weights[-1] = -2.0
        weights[len(terms.value) : len(terms.value) + len(VOTERS)] = 4.0
    held = spark.sparkContext.broadcast(weights)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch.id, "score": [score_of(x, held.value) for x in batch.features]})

    scored = seen.select("id", "features").mapInPandas(scores, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that ``score_toxicity`` does not reject, with all their columns.

    Where rows share an id, one toxic text rejects them all; rows with a null
    id stay.
    """
    scored = score_toxicity(docs, labels, id_col=id_col, text_col=text_col, **options)
    bad = stash(scored.where("predicted = 1").select(F.col(id_col).alias("_bad")).distinct(), "toxic")
    bad = F.broadcast(bad) if is_small(bad) else bad
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
