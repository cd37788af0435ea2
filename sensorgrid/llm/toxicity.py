"""Toxicity by a weighted finite-state pattern grammar (operator 11).

1. The lexicon gives words roles: insult, act (of violence), intent, target, negation, report.  The
   few listed words are a start; insults are also learnt from labels: words and beginnings of words
   (by bytes) that toxic documents of the sample hold far more often than others, each with the
   logarithm of how much more often as its weight.  A word takes the longest entry it matches.
2. A clause ends at . ! ? ; : or a line end.  Five transducers read its words: *target* marks what
   comes within four words after someone is addressed, *negation* what comes within three words
   after a negation, *report* all that follows a verb of saying, *insult* weighs insults by these marks
   and by an insult or target near by, *threat* accepts an intention and an act, and more if the
   act has a target.  They are composed into one machine (``compose``), whose arcs carry weights.
3. A document is described by its clauses: the sum and the largest of their weights, how many of
   them match, and the sum by words.  A logistic regression on these gives the score.

Scoring runs in the tasks that read the texts and looks at every word.  Fitting takes a bounded
sample: the ``toxic`` and ``clean`` labelled documents of each kind whose ids hash lowest, and at
most ``ENTRIES`` learnt entries.

Defined cases: null and empty texts have no clauses and get the score of a text without a match;
without labels of both kinds the listed words and fixed coefficients are used; a document with two
labels counts under both; of several texts of a labelled doc_id all count for the lexicon and one
for the regression; a null doc_id is scored and is never held out.  A column named like the result
is replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sensorgrid.llm.common import map_batches, quoted
from sensorgrid.llm.quality import held_out
from sensorgrid.llm.words import LOWER, SYMBOLS, U64, Words, chunks, mix, numbers, utf8

OTHER, INSULT, ACT, INTENT, TARGET, NEGATION, REPORT = range(7)

#: Words listed by role; weights of insults and acts are those of a rare, plain case.
LISTED = {
    INSULT: "idiot idiots moron stupid loser scum trash worthless pathetic disgusting clown fool bastard imbecile "
            "dumbass freak vermin subhuman coward pig idiota imbécil estúpido basura idiote imbécile ordure crétin "
            "dummkopf abschaum trottel versager".split(),
    ACT: "kill hurt destroy shoot stab beat murder burn crush strangle matar golpear tuer frapper töten schlagen".split(),
    INTENT: "will shall gonna going must should ll voy vas vais vamos werde wird wirst".split(),
    TARGET: "you your youre he she him her they them their everyone people tú usted ellos ellas vous toi ils elles du dich ihr sie euch".split(),
    NEGATION: "not no never nobody isn aren wasn don doesn didn nunca jamás pas jamais nicht kein keine niemals".split(),
    REPORT: "said says say called calls wrote writes claimed claims told quoted dijo llamó dit appelle sagte nannte".split(),
}
LISTED_WEIGHT = 3.0

#: Bytes of learnt beginnings, toxic documents that must hold an entry, entries at most.
BEGINNINGS = range(4, 13)
SUPPORT, ENTRIES = 6, 50_000
#: The lower bound (1.64 standard errors) of an entry's log ratio must reach this.
LEAST_RATIO = 2.0
#: Documents in the sample.
TOXIC, CLEAN = 2000, 6000

#: How marks change an insult or threat, and what a target after an insult adds.
AIMED, NEGATED, REPORTED, REPEATED, THREAT, THREAT_AIMED, POINTED = 1.5, 0.4, 0.6, 1.25, 1.5, 3.0, 0.5
#: Words that a mark reaches.
REACH = {"target": 4, "negation": 3, "insult": 3, "intent": 4, "act": 4}

_PLACES = numbers(max(BEGINNINGS), 41)
_LETTERS = numbers(256, 42)
_SALTS = numbers(max(BEGINNINGS) + 1, 43)
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?;:\n"])


@dataclass(frozen=True)
class Transducer:
    """A machine that counts down: a symbol sets the counter, every word read lowers it."""

    sets: int
    reach: int
    lasts: bool = False

    def step(self, state: int, symbol: int) -> int:
        return self.reach if symbol == self.sets else state if self.lasts else max(state - 1, 0)


MACHINES = {
    "target": Transducer(TARGET, REACH["target"]),
    "negation": Transducer(NEGATION, REACH["negation"]),
    "report": Transducer(REPORT, 1, lasts=True),
    "insult": Transducer(INSULT, REACH["insult"]),
    "intent": Transducer(INTENT, REACH["intent"]),
    "act": Transducer(ACT, REACH["act"]),
}


def arc(state: dict[str, int], symbol: int) -> tuple[float, float]:
    """Weights of an arc from a state with these marks: times the symbol's own weight, and added."""
    factor = (NEGATED if state["negation"] else 1.0) * (REPORTED if state["report"] else 1.0)
    if symbol == INSULT:
        return factor * (AIMED if state["target"] else 1.0) * (REPEATED if state["insult"] else 1.0), 0.0
    if symbol == ACT and state["intent"]:
        return factor * (THREAT_AIMED if state["target"] else THREAT), 0.0
    if symbol == TARGET and state["insult"]:
        return 0.0, factor * POINTED
    if symbol == TARGET and state["act"]:
        return 0.0, factor * (THREAT_AIMED - THREAT) * LISTED_WEIGHT * (state["intent"] > 0)
    return 0.0, 0.0


def compose() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product of the machines: next state, factor and addition of each state and symbol.  State 0
    is the start; the states are those that can be reached."""
    names = list(MACHINES)
    order, at = [(0,) * len(names)], {(0,) * len(names): 0}
    rows = []
    for state in order:
        marks = dict(zip(names, state, strict=True))
        row = []
        for symbol in range(7):
            after = tuple(MACHINES[n].step(marks[n], symbol) for n in names)
            if after not in at:
                at[after] = len(order)
                order.append(after)
            row.append((at[after], *arc(marks, symbol)))
        rows.append(row)
    table = np.array(rows)
    return table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2]


@dataclass
class Grammar:
    """Lexicon entries by hash (sorted) with roles and weights, and the regression."""

    keys: np.ndarray
    roles: np.ndarray
    weights: np.ndarray
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.5, 1.0, 0.5, 0.5]))


def _hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), SYMBOLS).hashes[0]


def listed() -> Grammar:
    """The listed words alone."""
    found = {_hash(w): role for role, words in LISTED.items() for w in words}
    keys = np.array(sorted(found), U64)
    roles = np.array([found[k] for k in keys], np.int8)
    return Grammar(keys, roles, np.where((roles == INSULT) | (roles == ACT), LISTED_WEIGHT, 0.0))


def _beginnings(data: np.ndarray, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the words longer than it, and hashes of their beginnings."""
    low, size = LOWER[data], words.ends - words.starts
    total, own = np.zeros(len(size), U64), np.arange(len(size))
    with np.errstate(over="ignore"):
        for k in range(1, max(BEGINNINGS) + 1):
            own = own[size[own] > k]
            total[own] += _LETTERS[low[words.starts[own] + k - 1]] * _PLACES[k - 1]
            if k in BEGINNINGS:
                yield k, own, mix(total[own] + _SALTS[k])


def read_words(data: np.ndarray, words: Words, grammar: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """Role and weight of each word: those of its longest entry, the whole word first of all."""
    roles, weights = np.zeros(len(words.starts), np.int8), np.zeros(len(words.starts))

    def look(own: np.ndarray, keys: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(grammar.keys, keys), len(grammar.keys) - 1)
        hit = grammar.keys[at] == keys
        roles[own[hit]], weights[own[hit]] = grammar.roles[at[hit]], grammar.weights[at[hit]]

    if len(grammar.keys):
        for _, own, keys in _beginnings(data, words):
            look(own, keys)
        look(np.arange(len(roles)), words.hashes)
    return roles, weights


_NEXT, _FACTOR, _ADDED = compose()
_GAP = max(REACH.values())


def _others() -> list[list[int]]:
    """The state after 0, 1, ... words without a role; after _GAP of them it stays."""
    out = [np.arange(len(_NEXT))]
    for _ in range(_GAP):
        out.append(_NEXT[out[-1], OTHER])
    return [x.tolist() for x in out]


_AFTER, _STEP = _others(), [list(zip(n.tolist(), f.tolist(), a.tolist(), strict=True)) for n, f, a in zip(_NEXT, _FACTOR, _ADDED, strict=True)]


def clause_weights(data: np.ndarray, words: Words, grammar: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """Row and weight of each clause with an insult or act that the composed machine has read."""
    roles, weights = read_words(data, words, grammar)
    row = np.repeat(np.arange(len(words.first) - 1), words.counts())
    ends = np.cumsum(_ENDS[data])[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (ends[1:] != ends[:-1])
    clause = np.cumsum(fresh) - 1
    hot = np.zeros(int(clause[-1]) + 1 if len(clause) else 0, bool)
    hot[clause[(roles == INSULT) | (roles == ACT)]] = True
    at = np.flatnonzero((roles > 0) & hot[clause]) if len(clause) else np.zeros(0, np.int64)
    gaps = np.diff(at, prepend=0) - 1
    out: dict[int, float] = {}
    last, state = -1, 0
    for c, r, w, g in zip(clause[at].tolist(), roles[at].tolist(), weights[at].tolist(), gaps.tolist(), strict=True):
        if c != last:
            last, state = c, 0
            out[c] = 0.0
        else:
            state = _AFTER[min(g, _GAP)][state]
        state, factor, added = _STEP[state][r]
        out[c] += factor * w + added
    found = np.array(list(out), np.int64)
    starts = np.flatnonzero(fresh)
    return row[starts[found]] if len(found) else found, np.array(list(out.values()))


def features(data: np.ndarray, offsets: np.ndarray, grammar: Grammar) -> np.ndarray:
    """A one, and what the clauses of each row come to."""
    words = Words(data, offsets, SYMBOLS)
    row, weight = clause_weights(data, words, grammar)
    rows = len(offsets) - 1
    total = np.bincount(row, weights=weight, minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, row, weight)
    many = np.bincount(row[weight >= 1], minlength=rows)
    return np.column_stack([np.ones(rows), np.log1p(total), np.log1p(top), np.log1p(many), np.log1p(100 * total / np.maximum(words.counts(), 20))])


def _scores(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ coefficients, -40, 40)))


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression in which no feature counts against toxicity: one that would is left out."""
    used = np.arange(x.shape[1])
    while True:
        w = np.zeros(x.shape[1])
        w[used] = _newton(x[:, used], y)
        worst = 1 + int(np.argmin(w[1:]))
        if w[worst] >= 0:
            return w
        used = used[used != worst]


def _newton(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """The ridge keeps separable samples finite."""
    w = np.zeros(x.shape[1])
    hold = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = _scores(x, w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    return w


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, text): how many toxic and other texts hold each word and beginning."""
    for batch in batches:
        data, off = utf8(batch.column(1))
        labels = batch.column(0).to_numpy()
        for a, b in chunks(off):
            own, start = data[off[a] : off[b]], off[a : b + 1] - off[a]
            words = Words(own, start, SYMBOLS)
            row = np.repeat(np.arange(b - a), words.counts())
            pieces = [(row, words.hashes)] + [(row[w], keys) for _, w, keys in _beginnings(own, words)]
            keys, sums = np.zeros(0, U64), np.zeros((0, 2), np.int64)
            for r, k in pieces:
                order = np.lexsort((r, k))
                k, r = k[order], r[order]
                once = np.ones(len(k), bool)
                once[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
                k, toxic = k[once], labels[a:b][r[once]]
                first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
                if len(first):
                    hits = np.add.reduceat(toxic, first)
                    keys = np.concatenate([keys, k[first]])
                    sums = np.concatenate([sums, np.column_stack([hits, np.diff(np.append(first, len(k))) - hits])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1].astype(np.int64))],
                names=["entry", "toxic", "clean"],
            )


def _featured(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(2))
            for a, b in chunks(off):
                x = features(data[off[a] : off[b]], off[a : b + 1] - off[a], grammar)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(x))], names=["id", "toxic", "x"])

    return run


def learnt(entries: np.ndarray, toxic: np.ndarray, clean: np.ndarray, many: tuple[int, int]) -> Grammar:
    """The listed words, and entries that ``toxic`` of many[0] toxic and ``clean`` of many[1] other texts hold."""
    ratio = np.log((toxic + 0.5) / (many[0] + 1)) - np.log((clean + 0.5) / (many[1] + 1))
    sure = ratio - 1.64 * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)) >= LEAST_RATIO
    good = sure & (toxic >= SUPPORT)
    start = listed()
    found = dict(zip(start.keys.tolist(), zip(start.roles.tolist(), start.weights.tolist(), strict=True), strict=True))
    for k, is_good, w, seen in zip(entries.tolist(), good.tolist(), ratio.tolist(), (toxic + clean).tolist(), strict=True):
        if is_good:
            found[k] = (INSULT, w)
        elif k in found and found[k][0] in (INSULT, ACT) and seen >= 3:
            # A listed word that the sample holds weighs what the sample says.
            found[k] = (found[k][0], max(min(w, LISTED_WEIGHT), 0.0))
    keys = np.array(sorted(found), U64)
    return Grammar(keys, np.array([found[k][0] for k in keys.tolist()], np.int8), np.array([found[k][1] for k in keys.tolist()]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """A grammar of ``labels (doc_id, toxic)``, from rows that are not held out."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    parts = [usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("label_id"), "label_id").limit(n) for kind, n in ((1, toxic), (0, clean))]
    chosen = parts[0].unionAll(parts[1])
    # At most toxic + clean ids and labels.
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "toxic", "text")
    many = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(many) < 2:
        return listed()
    counted = map_batches(rows.select("toxic", "text"), _counted, "entry long, toxic long, clean long")
    known = listed().keys.view(np.int64).tolist()
    entries = (
        counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= SUPPORT) & (F.col("toxic") * many[0] > 4 * F.col("clean") * many[1]) | F.col("entry").isin(known))
        .orderBy(F.desc("toxic"), "entry").limit(ENTRIES).toArrow()
    )
    grammar = learnt(entries["entry"].to_numpy().view(U64), entries["toxic"].to_numpy(), entries["clean"].to_numpy(), (many[1], many[0]))
    seen = map_batches(rows, _featured(grammar), "id long, toxic int, x array<double>").groupBy("id", "toxic").agg(F.min("x").alias("x")).collect()
    seen.sort(key=lambda r: (r.id, r.toxic))
    grammar.coefficients = regression(np.array([r.x for r in seen]), np.array([r.toxic for r in seen], float))
    return grammar


def _score(grammar: Grammar, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(text_at))
            for a, b in chunks(off):
                scores = _scores(features(data[off[a] : off[b]], off[a : b + 1] - off[a], grammar), grammar.coefficients)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*part.schema.names, "toxicity"])

    return run


def score_toxicity(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` and their ``toxicity`` from 0 to 1."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "toxicity"])
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])
    return map_batches(docs, _score(grammar, docs.columns.index(text_col)), schema)
