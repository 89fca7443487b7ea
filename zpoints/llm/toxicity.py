"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the classes of a clause's tokens: insult, threat,
target, negation and reported speech. Each passes the token on and gives every
arc a factor and a constant; their composition is one table over product
states. A clause is worth what its path collects: an insult counts by its
learned weight, more beside a target, less when negated or reported; "will
... verb ... target" is a threat. A document's score is a logistic function of
its clauses' worth, with coefficients fitted on the labelled rows.

The insult terms and weights are learned from a bounded sample of labelled
rows (``max_labelled``): whole words and word stems (prefixes) that toxic
texts hold far more often than clean ones. A term must occur in several
different contexts, so that words of one copied text do not become insults.
The other classes are short fixed lists.

Defined cases: a null or empty text has no clauses and gets the score of no
match (below 0.5); rows are scored one by one, so repeated rows and null ids are
scored like any other; without labels the seed terms and default coefficients
apply; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOUBLE, LONG, STRING, discard, held_out, labelled_sample, save, schema

# Token classes of the grammar, in English, German, French and Spanish.
TARGETS = set("you your yours yourself he him his she her they them their this that these those people everyone "
              "du dich dir ihr euch sie er ihm ihnen dieser tu toi vous il elle ils elles lui leur ce cette "
              "tú ti usted ustedes él ella ellos ellas este esta".split())
NEGATIONS = set("not no never nobody none cannot don doesn didn isn aren wasn weren won nicht kein keine keinen nie "
                "niemals ne pas jamais aucun nunca jamás ningún tampoco".split())
REPORTS = set("said says say called calls wrote writes claimed claims quoted quote alleged reportedly sagte sagt "
              "nannte schrieb behauptet zitiert dit disait écrit appelé affirme cite dijo dice llamó escribió "
              "afirma cita".split())
MODALS = set("will shall gonna going must should ll werde wirst werden vais vas va voy vamos".split())
VIOLENCE = set("kill hurt destroy shoot stab murder strangle töten umbringen erschießen schlagen tuer frapper "
               "massacrer matar golpear destruir".split())
SEED_INSULTS = ("idiot moron stupid scum pathetic worthless loser trash disgusting dumb imbecile dummkopf abschaum "
                "connard imbécile idiota estúpido").split()

OTHER, INSULT, VIOLENT, TARGET, NEGATION, REPORT, MODAL = range(7)
PREFIXES = range(4, 9)
TOKEN = re.compile(r"\w+")
CLAUSE_END = re.compile(r"[.!?;:\n]")


# ------------------------------------------------------------------ transducers

class Transducer:
    """next[state][class], factor[state][class] for an insult's weight, constant[state][class] of its own."""

    def __init__(self, step: np.ndarray, factor: np.ndarray, constant: np.ndarray):
        self.step, self.factor, self.constant = step, factor, constant

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same tokens: product states, factors multiplied, constants added."""
        n, m = len(self.step), len(other.step)
        step = (self.step[:, None, :] * m + other.step[None, :, :]).reshape(n * m, -1)
        factor = (self.factor[:, None, :] * other.factor[None, :, :]).reshape(n * m, -1)
        constant = (self.constant[:, None, :] + other.constant[None, :, :]).reshape(n * m, -1)
        return Transducer(step, factor, constant)


def _blank(states: int) -> Transducer:
    same = np.repeat(np.arange(states)[:, None], 7, axis=1)
    return Transducer(same, np.ones((states, 7)), np.zeros((states, 7)))


def insult_transducer() -> Transducer:
    """Emits an insult's weight; a second insult of the clause counts half more. State: one was seen."""
    t = _blank(2)
    t.step[:, INSULT] = 1
    t.factor[1, INSULT] = 1.5
    return t


def target_transducer(bonus: float = 1.25) -> Transducer:
    """An insult after a target of the same clause is directed at it."""
    t = _blank(2)
    t.step[:, TARGET] = 1
    t.factor[1, INSULT] = bonus
    return t


def negation_transducer(reach: int = 3, factor: float = 0.4) -> Transducer:
    """An insult within ``reach`` tokens after a negation is played down. State: tokens left."""
    t = _blank(reach + 1)
    for left in range(reach + 1):
        t.step[left, :] = max(left - 1, 0)
        t.step[left, NEGATION] = reach
        if left:
            t.factor[left, INSULT] = factor
    return t


def report_transducer(factor: float = 0.6) -> Transducer:
    """After a verb of saying, an insult is somebody else's."""
    t = _blank(2)
    t.step[:, REPORT] = 1
    t.factor[1, INSULT] = factor
    return t


def threat_transducer(worth: float = 4.0) -> Transducer:
    """modal ... violent verb ... target. State: how much of it was read."""
    t = _blank(3)
    t.step[0, MODAL] = 1
    t.step[1, VIOLENT] = 2
    t.step[2, TARGET] = 0
    t.constant[2, TARGET] = worth
    return t


def grammar() -> Transducer:
    out = insult_transducer()
    for part in (target_transducer(), negation_transducer(), report_transducer(), threat_transducer()):
        out = out.compose(part)
    return out


CLASS_OF = {**dict.fromkeys(MODALS, MODAL), **dict.fromkeys(VIOLENCE, VIOLENT), **dict.fromkeys(TARGETS, TARGET),
            **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(NEGATIONS, NEGATION)}


class Scorer:
    """Finds the clauses that hold an insult or a violent verb and runs the grammar over them."""

    def __init__(self, terms: dict[str, float]):
        import ahocorasick

        g = grammar()
        self.step, self.factor, self.constant = g.step.tolist(), g.factor.tolist(), g.constant.tolist()
        self.words = {t: w for t, w in terms.items() if not t.endswith("*")}
        self.stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.lengths = sorted({len(t) for t in self.stems})
        self.find = ahocorasick.Automaton()
        for t in {*self.words, *self.stems, *VIOLENCE}:
            self.find.add_word(t, len(t))
        self.find.make_automaton()

    def weight(self, token: str) -> float | None:
        w = self.words.get(token)
        if w is None:
            for n in self.lengths:
                w = self.stems.get(token[:n])
                if w is not None:
                    break
        return w

    def clause(self, text: str) -> float:
        state = total = 0
        for token in TOKEN.findall(text):
            w = self.weight(token)
            kind = INSULT if w is not None else CLASS_OF.get(token, OTHER)
            total += self.constant[state][kind]
            if w is not None:
                total += w * self.factor[state][kind]
            state = self.step[state][kind]
        return total

    def features(self, text: str) -> tuple[float, float, float, float]:
        """log(1 + worth of all clauses), best clause, log(1 + matched clauses), worth per 100 words (log)."""
        low = text.lower()
        total = best = 0.0
        n = done = 0
        for end, length in self.find.iter(low):
            start = end - length + 1
            if start < done or (start and (low[start - 1].isalnum() or low[start - 1] == "_")):
                continue
            left = max(map(low.rfind, ".!?;:\n", [0] * 6, [start] * 6)) + 1
            found = CLAUSE_END.search(low, end + 1)
            done = found.end() if found else len(low)
            worth = self.clause(low[left:done])
            if worth > 0:
                total, best, n = total + worth, max(best, worth), n + 1
        rate = math.log1p(600.0 * total / (len(low) + 600.0)) if n else 0.0
        return math.log1p(total), best, math.log1p(n), rate


# ------------------------------------------------------------------ learning

def _terms_of(token: str) -> list[str]:
    return [token, *[token[:n] + "*" for n in PREFIXES if n < len(token) or n == len(token)]]


def _count_terms(batches):
    """Per batch: in how many toxic and clean texts each term occurs."""
    for pdf in batches:
        toxic, clean = Counter(), Counter()
        for text, y in zip(pdf["text"], pdf["y"]):
            terms = set()
            for token in set(TOKEN.findall((text or "").lower())):
                terms.update(_terms_of(token))
            (toxic if y > 0.5 else clean).update(terms)
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"term": names, "toxic": [toxic[t] for t in names], "clean": [clean[t] for t in names]})


def _contexts(terms: set[str]):
    """(term, hash of the neighbouring tokens) for the candidate terms, once per batch."""
    def run(batches):
        for pdf in batches:
            seen = set()
            for text in pdf["text"]:
                tokens = ["", *TOKEN.findall((text or "").lower()), ""]
                for i in range(1, len(tokens) - 1):
                    for t in _terms_of(tokens[i]):
                        if t in terms:
                            seen.add((t, f"{tokens[i - 1]} {tokens[i + 1]}"))
            yield pd.DataFrame(list(seen), columns=["term", "context"])
    return run


def learn_terms(sample: DataFrame, *, min_texts: int = 4, min_ratio: float = 25.0, min_contexts: int = 4,
                max_terms: int = 5000) -> dict[str, float]:
    """term -> weight (log odds ratio); stems end in '*'. The sample is bounded, so is the number of terms."""
    n = {bool(r["t"]): r["n"] for r in sample.groupBy((F.col("y") > 0.5).alias("t")).agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        return {t: 4.0 for t in SEED_INSULTS}
    counted = (sample.select("text", "y").mapInPandas(_count_terms, schema(term=STRING, toxic=LONG, clean=LONG))
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    ratio = ((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("clean") + 0.5) / (good + 1))
    found = (counted.where((F.col("toxic") >= min_texts) & (ratio >= min_ratio))
             .select("term", "toxic", F.log(ratio).alias("weight"))
             .orderBy(F.desc("toxic"), F.length("term"), "term").limit(max_terms).collect())
    weights, texts = {r["term"]: r["weight"] for r in found}, {r["term"]: r["toxic"] for r in found}
    if not weights:
        return {t: 4.0 for t in SEED_INSULTS}
    contexts = (sample.where("y > 0.5").select("text")
                .mapInPandas(_contexts(set(weights)), schema(term=STRING, context=STRING))
                .groupBy("term").agg(F.count_distinct("context").alias("n")).collect())
    free = {r["term"] for r in contexts if r["n"] >= max(min_contexts, 0.5 * texts[r["term"]])}
    kept: dict[str, float] = {}
    for t in sorted(free, key=lambda t: (not t.endswith("*"), len(t), t)):  # short stems first; they stand for longer ones
        bare = t.rstrip("*")
        if not any(bare[:k] + "*" in kept for k in PREFIXES if k <= len(bare)):
            kept[t] = float(weights[t])
    return kept or {t: 4.0 for t in SEED_INSULTS}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    pen = np.full(a.shape[1], ridge)
    pen[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + pen * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pen)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


DEFAULT_COEFFICIENTS = [1.0, 0.5, 0.5, 0.5, -3.0]


def learn(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000) -> tuple[dict[str, float], list[float]]:
    """Terms with weights, and the coefficients of the score, from at most ``max_labelled`` labelled rows."""
    sample = save(labelled_sample(docs, labels, "toxic", max_labelled), "toxicity-sample")
    terms = learn_terms(sample)

    def rows(batches):
        scorer = Scorer(terms)
        for pdf in batches:
            f = np.array([scorer.features(t or "") for t in pdf["text"]], float).reshape(-1, 4)
            yield pd.DataFrame({"a": f[:, 0], "b": f[:, 1], "c": f[:, 2], "d": f[:, 3], "y": pdf["y"].to_numpy()})

    fitted = (sample.select("text", "y").mapInPandas(rows, schema(a=DOUBLE, b=DOUBLE, c=DOUBLE, d=DOUBLE, y=DOUBLE))
              .groupBy("a", "b", "c", "d", "y").agg(F.count("*").alias("n")).toPandas()
              .sort_values(["a", "b", "c", "d", "y"]))
    discard(sample)
    if fitted["y"].nunique() < 2:
        return terms, DEFAULT_COEFFICIENTS
    x, y, n = fitted[["a", "b", "c", "d"]].to_numpy(), (fitted["y"] > 0.5).to_numpy(float), fitted["n"].to_numpy()
    return terms, fit_logistic(np.repeat(x, n, axis=0), np.repeat(y, n)).tolist()


def score(docs: DataFrame, terms: dict[str, float], coefficients: list[float]) -> DataFrame:
    """(doc_id, score, worth, clauses) of every row. No shuffle; the grammar goes to each task with the function."""
    def run(batches):
        scorer, w = Scorer(terms), np.array(coefficients)
        for batch in batches:
            f = np.array([scorer.features(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, 4)
            p = 1 / (1 + np.exp(-np.clip(f @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array(np.expm1(f[:, 0])),
                 pa.array(np.rint(np.expm1(f[:, 2])).astype(np.int64))], ["doc_id", "score", "worth", "clauses"])

    return docs.select("doc_id", "text").mapInArrow(run, schema(doc_id=LONG, score=DOUBLE, worth=DOUBLE, clauses=LONG))


def score_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5,
                    max_labelled: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold), worth, clauses of every row of ``docs``."""
    out = score(docs, *learn(docs, labels, max_labelled=max_labelled))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "worth", "clauses")


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, max_labelled: int = 20_000) -> DataFrame:
    """The rows of ``docs`` whose own text scores below the threshold, all columns kept. No shuffle of texts."""
    terms, coefficients = learn(docs, labels, max_labelled=max_labelled)
    w = np.array(coefficients)

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        scorer = Scorer(terms)
        f = np.array([scorer.features(t or "") for t in texts], float).reshape(-1, 4)
        return pd.Series(1 / (1 + np.exp(-np.clip(f @ w[:-1] + w[-1], -30, 30))) >= threshold)

    return docs.where(~toxic(F.col("text")))
