"""Toxicity by weak supervision.

Many voters look at a text: terms of general lexicons, terms mined from labelled rows (whole words and
word beginnings, once or often, so that inflected and compound forms count), and patterns over them. A generative
label model estimates by EM how often each voter votes what under either class, and how far voters go
together given the class; voters that say the same count as fewer votes. A logistic regression is
then trained on the model's posterior labels and scores every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import query, stored, table

#: labelled rows that terms, label model and classifier are fitted on at most, taken by hash of doc_id
FIT_ROWS = 20_000
#: mined terms that go to the driver as candidates
CANDIDATES = 4096
#: texts a mined term must mark, share of toxic ones among them, and terms that explain a toxic text
LEAST_TEXTS, LEAST_PRECISION, EXPLAINED = 5, 0.9, 2
#: lengths of word beginnings that are tried as terms
BEGINNINGS = (4, 5, 6, 7, 8)
#: a beginning that innocent words have now and then marks a text where so many different words have it, and at
#: least one in so many words of the text: neither repeated lines nor long texts count by themselves
OFTEN, ONCE_IN = 2, 400
#: odds that a label is right, by which fitting rows' labels hold the label model in place
LABEL_ODDS = 9.0
#: general lexicons of abuse; a mark * stands for any ending, also none
LEXICONS = {
    "en": "idiot* moron* scum* stupid* loser* pathetic worthless disgusting trash clown* imbecile* dumbass* retard* bastard* bitch* asshole* fuck* cunt* whore* slut*",
    "de": "idioten* dummkopf* trottel* abschaum* arschloch* wichser* hurensohn* schlampe* missgeburt* vollidiot*",
    "fr": "connard* connasse* salaud* salope* imbécile* crétin* ordure* enculé* débile* abruti*",
    "es": "imbécil* estúpid* gilipollas cabrón* pendej* escoria* basura* idiota* mierda* puta*",
}
WORD = re.compile(r"[^\W\d_]+")
PATTERNS = ("none", "several", "repeated", "dense", "shouted")
TOXIC, CLEAN = 1, -1


# ---- voters --------------------------------------------------------------------------------


def terms_of(word: str) -> list[str]:
    """A word as a term and its beginnings, marked with + for at least one letter more: a stem may be an
    innocent word by itself. The mark # stands for the same, where several words have it."""
    return [word, *(word[:n] + mark for n in BEGINNINGS if len(word) > n for mark in "+#")]


def is_often(different: int, n: int, total: int) -> bool:
    return different >= OFTEN and n * ONCE_IN >= total


def terms_in(text: str) -> set[str]:
    """All terms of a text."""
    words = Counter(WORD.findall(text.lower()))
    counts, different = Counter(), Counter()
    for word, n in words.items():
        for term in terms_of(word):
            counts[term] += n
            different[term] += 1
    total = words.total()
    return {t for t, n in counts.items() if not t.endswith("#") or is_often(different[t], n, total)}


@dataclass
class Voters:
    """Terms (mined and from lexicons) and the patterns over them."""

    terms: list[str]

    def __post_init__(self):
        self.whole: dict[str, int] = {}
        self.begin: dict[int, dict[str, list[int]]] = {}  # by length of the stem
        self.often: set[int] = set()
        for i, t in enumerate(self.terms):
            if t.endswith(("*", "+", "#")):
                self.begin.setdefault(len(t) - 1, {}).setdefault(t[:-1], []).append(i)
            if t.endswith("#"):
                self.often.add(i)
            elif not t.endswith("+"):
                self.whole[t.rstrip("*")] = i

    def hits(self, text: str | None) -> tuple[Counter, int, int]:
        """(occurrences by term number, marked words, all words)."""
        words = Counter(WORD.findall((text or "").lower()))
        total = words.total()
        found, different = Counter(), Counter()
        having = []
        for word, n in words.items():
            of = {i for k, b in self.begin.items() if len(word) > k for i in b.get(word[:k], ())}
            if word in self.whole:
                of.add(self.whole[word])
            if of:
                having.append((of, n))
                for i in of:
                    found[i] += n
                    different[i] += 1
        for i in self.often & found.keys():
            if not is_often(different[i], found[i], total):
                del found[i]
        return found, sum(n for of, n in having if not of.isdisjoint(found)), total

    def row(self, text: str | None) -> tuple[list[int], int, int, int, bool]:
        """What votes and features are made of: terms found, words they begin (nested terms once), all words."""
        found, marked, total = self.hits(text)
        roots = {self.terms[i].rstrip("*+#")[: BEGINNINGS[0]] for i in found}
        loud = bool(text) and sum(c.isupper() for c in text) > 0.5 * sum(c.isalpha() for c in text) and text.count("!") >= 3
        return sorted(found), len(roots), marked, total, loud

    def votes(self, rows: list[tuple]) -> np.ndarray:
        """Votes of every term and pattern: toxic, clean or none."""
        out = np.zeros((len(rows), len(self.terms) + len(PATTERNS)), dtype=np.int8)
        for k, (found, roots, marked, total, loud) in enumerate(rows):
            out[k, found] = TOXIC
            patterns = (
                CLEAN if not marked else 0,
                TOXIC if roots >= 2 else 0,
                TOXIC if marked >= 2 else 0,
                TOXIC if marked and marked * 100 >= total else 0,
                TOXIC if loud and marked else 0,
            )
            out[k, len(self.terms) :] = patterns
        return out


# ---- label model ---------------------------------------------------------------------------


@dataclass
class LabelModel:
    """Class prior, log odds of each voter's three votes, and the weight left to it by correlations."""

    prior: float
    odds: np.ndarray  # voters x (clean, none, toxic)
    weights: np.ndarray

    def posterior(self, votes: np.ndarray, label: np.ndarray | float = 0.0) -> np.ndarray:
        each = np.take_along_axis(self.odds.T, votes.astype(int) + 1, axis=0)
        return _sigmoid(self.prior + each @ self.weights + label)


def fit_label_model(votes: np.ndarray, toxic: np.ndarray, rounds: int = 25) -> tuple[LabelModel, np.ndarray]:
    """EM from the majority of votes; gives the model and the posterior labels of the rows.

    Within a round, class-conditional vote rates are estimated, then the correlations of what voters say
    beyond the class; a voter that goes with k others counts 1/(1+k). The rows' labels take part as one
    voter of fixed accuracy, which holds the two classes in place. A voter never counts against its vote.
    """
    n, voters = votes.shape
    y = np.where((votes == TOXIC).any(1), 0.9, 0.1)
    label = np.where(toxic > 0, 1, -1) * math.log(LABEL_ODDS)
    model = LabelModel(0.0, np.zeros((voters, 3)), np.ones(voters))
    for _ in range(rounds):
        rates = np.empty((2, voters, 3))
        for c, weight in enumerate((1 - y, y)):
            for k, vote in enumerate((CLEAN, 0, TOXIC)):
                rates[c, :, k] = (weight @ (votes == vote) + 0.5) / (weight.sum() + 1.5)
        share = float(np.clip(y.mean(), 0.005, 0.5))
        # What a vote says beyond its expectation under the posterior.
        expected = np.outer(1 - y, rates[0, :, 2] - rates[0, :, 0]) + np.outer(y, rates[1, :, 2] - rates[1, :, 0])
        rest = votes - expected
        spread = np.sqrt((rest**2).mean(0)) + 1e-6
        together = np.clip((rest.T @ rest) / n / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(together, 0)
        weights = 1 / (1 + together.sum(1))
        odds = np.log(rates[1] / rates[0])
        odds[:, 0], odds[:, 2] = np.minimum(odds[:, 0], 0), np.maximum(odds[:, 2], 0)
        model = LabelModel(math.log(share / (1 - share)), odds, weights)
        new = model.posterior(votes, label)
        if np.abs(new - y).max() < 1e-4:
            break
        y = new
    return model, y


# ---- classifier ----------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def features(voters: Voters, rows: list[tuple]) -> np.ndarray:
    """Terms, patterns, number of roots, marked words and their share, and a constant."""
    out = np.zeros((len(rows), len(voters.terms) + 4))
    for k, (found, roots, marked, total, _loud) in enumerate(rows):
        out[k, found] = 1
        out[k, -4:] = (min(roots, 5) / 5, math.log1p(marked), min(1.0, 20 * marked / max(total, 1)), 1)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    label_model: LabelModel

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return _sigmoid(features(self.voters, [self.voters.row(t) for t in texts]) @ self.weights)


# ---- fitting on labelled rows --------------------------------------------------------------


def in_held_out(doc_id: Column | str) -> Column:
    """The fifth of documents whose labels are never learned from."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(-1)).cast("long").cast("string")
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


def fitting_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Distinct texts of at most `fit_rows` labelled rows outside the held-out fifth, with toxic 0 or 1.
    A document with several labels counts as toxic if one says so."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~in_held_out("doc_id"))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id")
    return rows.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def mined_terms(rows: DataFrame, candidates: int = CANDIDATES) -> list[str]:
    """Terms that mark toxic texts, at most `candidates`; counts over all fitting rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(terms_in(text))
            # Terms seen in no toxic text of this batch matter only if another batch has one: all are sent.
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
                names=["term", "toxic", "clean"],
            )

    counts = rows.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    good = counts.where((F.col("toxic") >= LEAST_TEXTS) & (F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean") + 0.5)))
    return [r["term"] for r in good.orderBy(F.desc("toxic"), F.length("term"), "term").limit(candidates).collect()]


def _collected(rows: DataFrame, voters: Voters) -> tuple[list[tuple], np.ndarray]:
    """What the voters see in each fitting row: numbers only, no texts, go to the driver."""

    @F.arrow_udf("struct<found:array<int>,roots:int,marked:int,total:int,loud:boolean>")
    def see(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("found", pa.list_(pa.int32())), ("roots", pa.int32()), ("marked", pa.int32()), ("total", pa.int32()), ("loud", pa.bool_())])
        names = [f.name for f in kind]
        return pa.array([dict(zip(names, voters.row(t.as_py()))) for t in texts], type=kind)

    found = rows.select(see("text").alias("s"), "toxic", F.xxhash64("text").alias("h")).orderBy("h").collect()
    return [tuple(r["s"]) for r in found], np.array([r["toxic"] for r in found], dtype=int)


def chosen_terms(candidates: list[str], rows: list[tuple], toxic: np.ndarray) -> list[str]:
    """Cover the toxic texts: again and again the term that marks most texts not yet explained. Words that
    only come along in copies of one text explain nothing new and are not taken."""
    marks = np.zeros((int(toxic.sum()), len(candidates)), dtype=bool)
    for k, row in enumerate(r for r, t in zip(rows, toxic) if t):
        marks[k, row[0]] = True
    explained, taken = np.zeros(len(marks), dtype=int), []
    for _ in range(len(candidates)):
        gain = marks[explained < EXPLAINED].sum(0)
        if not len(gain) or gain.max() < LEAST_TEXTS:
            break
        best = int(gain.argmax())
        taken.append(candidates[best])
        explained += marks[:, best]
        marks[:, best] = False
    return taken


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Mine terms, fit the label model on the votes and the classifier on its posterior labels.

    Labels choose the mined terms and are one voter among many; the classifier sees posterior labels only. Without labelled rows the
    lexicons alone vote, each term with the same weight.
    """
    rows = stored(fitting_rows(docs, labels, fit_rows), "toxicity-fit")
    lexicon = [t for words in LEXICONS.values() for t in words.split()]
    candidates = mined_terms(rows)
    seen, toxic = _collected(rows, Voters(candidates))
    terms = list(dict.fromkeys([*chosen_terms(candidates, seen, toxic), *lexicon]))
    voters = Voters(terms)
    seen, toxic = _collected(rows, voters)
    if not len(seen) or not any(r[0] for r in seen):
        weights = np.concatenate([np.full(len(terms), 6.0), [0, 0, 0, -4.0]])
        return Model(voters, weights, LabelModel(-4.0, np.zeros((len(terms) + len(PATTERNS), 3)), np.ones(len(terms) + len(PATTERNS))))
    votes = voters.votes(seen)
    label_model, posterior = fit_label_model(votes, toxic)
    x = features(voters, seen)
    weights = fit_logistic(x, posterior)
    # A term that no fitting row has keeps the median weight of those seen, so that the lexicons still count.
    unseen = np.append(x[:, : len(terms)].sum(0) == 0, [False] * 4)
    if (~unseen[: len(terms)]).any():
        weights[unseen] = np.median(weights[: len(terms)][~unseen[: len(terms)]])
    return Model(voters, weights, label_model)


# ---- scoring -------------------------------------------------------------------------------


def score_of(text: Column | str, model: Model) -> Column:
    """The score (0 to 1) of a text column. A null or empty text scores as one without any marked word."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()), type=pa.float64())

    return score(text)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Adds `score` and `predicted` (1 if score >= 0.5) to every row; columns of these names are replaced."""
    return docs.withColumn("score", score_of("text", model)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select("doc_id", in_held_out("doc_id").alias("held_out"), "score", "predicted")
