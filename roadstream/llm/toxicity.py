"""Toxicity by a weighted finite-state grammar over clauses.

Words fall into classes (insult, threat, target, negation, reported speech, intent, any other).  Insults are a short list
and stems that a bounded sample of labelled texts teaches: first letters of words that many toxic texts hold (or hold
twice) and few others do, picked one after the other by the toxic texts they add.  Near copies count once there.  One transducer reads the
classes of a clause and marks each with its scope: plain, negated (within three words after a negation) or reported
(after a verb of saying).  A second one reads marked classes and writes the patterns that a clause matches: an insult
alone, one beside a target, a further insult, an insult that turns to a target, a threat against a target, an intended threat.
Their composition runs over each clause that holds an insult or a threat.  A clause's patterns have weights,
learned by logistic regression from a bounded sample of labelled rows that are not held out; only the text is an
input.  Null counts as empty; texts without a matching clause all have the same score.  Without usable labels every
score is that of no knowledge, 0.5.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadstream.llm.quality import held_out, labelled_sample, numbers
from roadstream.llm.texts import Words, split_rows, word_hash
from roadstream.shared import freeze

SAMPLE = 20_000
STEM_TOXIC, STEM_CLEAN = 1000, 2000
STEMS = (4, 5, 6)
ALERT = 0.7

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, END = range(8)
#: Words by class.
LEXICON = {
    INSULT: """idiot idiots moron morons stupid loser losers pathetic worthless disgusting trash scum clown clowns fool fools
        dumb imbecile imbeciles garbage filth vermin coward cowards jerk jerks brainless useless freak freaks
        maggot maggots parasite parasites cretin pig pigs rat rats swine idiotic moronic""",
    THREAT: """kill hurt destroy beat shoot stab burn crush attack punch smash strangle hang murder ruin slap bomb""",
    TARGET: """you your yours yourself u he him his she her hers they them their we us people everyone all this that these those
        who person man woman men women guy guys""",
    NEGATION: "not no never none nobody nor neither without hardly isn aren wasn weren don doesn didn won wouldn cannot",
    REPORT: """said says say saying called calls calling wrote writes claimed claims reported reports quoted quote quotes
        stated states told tells according alleged""",
    INTENT: "will shall going gonna want must should ll would let",
}
PLAIN, DENIED, QUOTED = "plain", "denied", "quoted"
NEAR = 3
PATTERNS = ("insult", "directed", "further", "turned", "threat", "intended")
_EVENTS = [(pattern, scope) for pattern in PATTERNS for scope in (PLAIN, DENIED, QUOTED)]


@dataclass
class Transducer:
    """arcs: (state, input) to (state, output or None)."""
    start: object
    arcs: dict

    def then(self, second: "Transducer") -> "Transducer":
        """The composition: what this one writes, ``second`` reads."""
        arcs, open_, known = {}, [(self.start, second.start)], set()
        inputs = {x for _, x in self.arcs}
        while open_:
            pair = open_.pop()
            if pair in known:
                continue
            known.add(pair)
            for symbol in inputs:
                if (pair[0], symbol) in self.arcs:
                    state, written = self.arcs[pair[0], symbol]
                    other, out = second.arcs[pair[1], written]
                    arcs[pair, symbol] = (state, other), out
                    open_.append((state, other))
        return Transducer((self.start, second.start), arcs)


def scopes() -> Transducer:
    """Marks each class with its scope; the state is (reported, words that a negation still reaches)."""
    arcs = {}
    for reported, left, symbol in product((False, True), range(NEAR + 1), range(END + 1)):
        scope = DENIED if left else QUOTED if reported else PLAIN
        after = (reported or symbol == REPORT, NEAR if symbol == NEGATION else max(0, left - 1))
        arcs[(reported, left), symbol] = ((False, 0) if symbol == END else after), (symbol, scope)
    return Transducer((False, 0), arcs)


def clauses() -> Transducer:
    """Writes (pattern, scope); the state is what the clause has shown: target, insult, intent, open threat."""
    arcs = {}
    for target, insult, intent, threat in product((False, True), repeat=4):
        state = target, insult, intent, threat
        for symbol, scope in product(range(END + 1), (PLAIN, DENIED, QUOTED)):
            after, pattern = state, None
            if symbol == END:
                after = (False,) * 4
            elif symbol == INSULT:
                pattern = "further" if insult else "directed" if target else "insult"
                after = target, True, intent, threat
            elif symbol == TARGET:
                pattern = ("intended" if intent else "threat") if threat else "turned" if insult and not target else None
                after = True, insult, intent, False
            elif symbol == THREAT:
                after = target, insult, intent, True
            elif symbol == INTENT:
                after = target, insult, True, threat
            arcs[state, (symbol, scope)] = after, (pattern, scope) if pattern else None
    return Transducer((False,) * 4, arcs)


def _tables() -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """The composition with numbered states: (next state, event or -1) by state and class."""
    machine = scopes().then(clauses())
    number = {machine.start: 0}
    for state, _ in machine.arcs:
        number.setdefault(state, len(number))
    rows = [[(0, -1)] * (END + 1) for _ in number]
    event = {x: k for k, x in enumerate(_EVENTS)}
    for (state, symbol), (after, out) in machine.arcs.items():
        rows[number[state]][symbol] = number[after], -1 if out is None else event[out]
    return rows


_MACHINE = _tables()
_CLASS_OF = {word_hash(word): kind for kind, words in LEXICON.items() for word in words.split()}
_HASHES = np.array(sorted(_CLASS_OF), dtype=np.uint64)
_CLASSES = np.array([_CLASS_OF[int(x)] for x in _HASHES], dtype=np.int8)
_ENDS = np.zeros(128, dtype=bool)
_ENDS[[ord(x) for x in "\0\n.!?;:"]] = True


def matches(texts: list[str], stems: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: counts of each event (pattern and scope), matched clauses, words, words with a learned stem.

    stems: hashes of learned stems, sorted.
    """
    words = Words(texts)
    n = len(texts)
    count, matched = np.zeros((n, len(_EVENTS))), np.zeros(n)
    total = np.bincount(words.doc, minlength=n)
    taught = np.zeros(n)
    if not len(words.hash):
        return count, matched, total, taught
    at = np.minimum(np.searchsorted(_HASHES, words.hash), len(_HASHES) - 1)
    kind = np.where(_HASHES[at] == words.hash, _CLASSES[at], OTHER)
    if len(stems):
        learned = np.zeros(len(kind), dtype=bool)
        for letters in STEMS:
            found = words.stems(letters) & ~np.uint64(1)
            learned |= stems[np.minimum(np.searchsorted(stems, found), len(stems) - 1)] == found
        taught = np.bincount(words.doc, learned, n)
        kind[learned & (kind == OTHER)] = INSULT
    ends = np.flatnonzero((words.codes < 128) & _ENDS[np.minimum(words.codes, 127)])
    clause = np.searchsorted(ends, words.start)
    for number in np.unique(clause[(kind == INSULT) | (kind == THREAT)]):
        low, high = np.searchsorted(clause, [number, number + 1])
        state, found = 0, False
        for symbol in kind[low:high].tolist():
            state, event = _MACHINE[state][symbol]
            if event >= 0:
                count[words.doc[low], event] += 1
                found = True
        matched[words.doc[low]] += found
    return count, matched, total, taught


def statistics(texts: list[str], stems: np.ndarray) -> np.ndarray:
    """What the regression weighs: patterns by scope, and how many clauses and patterns there are."""
    count, matched, total, taught = matches(texts, stems)
    events = count.sum(axis=1)
    listed = events - np.minimum(events, taught)
    steps = [x >= k for x in (listed, taught, matched) for k in (1, 2, 3, 4)]
    rate = events / np.maximum(total, 1)
    return np.column_stack([np.log1p(count), np.log1p(events), np.log1p(matched), np.sqrt(rate), *steps]).astype(np.float64)


@dataclass
class Regression:
    weight: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weight + self.base, -30, 30)))


def regress(rows: np.ndarray, labels: np.ndarray, l2: float = 1.0, steps: int = 50) -> Regression:
    """Logistic regression by Newton steps."""
    if not len(rows):
        return Regression(np.zeros(rows.shape[1]), 0.0)
    table = np.column_stack([rows, np.ones(len(rows))])
    penalty = np.full(table.shape[1], l2)
    penalty[-1] = 1e-3
    weight = np.zeros(table.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(table @ weight, -30, 30)))
        slope = table.T @ (labels - chance) - penalty * weight
        curve = (table * (chance * (1 - chance))[:, None]).T @ table + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weight += step
        if np.abs(step).max() < 1e-9:
            break
    return Regression(weight[:-1], float(weight[-1]))


def _held(stems: np.ndarray) -> np.ndarray:
    """Different stems of a text; once more, with the last bit set, those that occur at least twice."""
    found, times = np.unique(stems & ~np.uint64(1), return_counts=True)
    return np.concatenate([found, found[times > 1] | np.uint64(1)])


def learn_stems(rows: DataFrame, toxic: int = STEM_TOXIC, clean: int = STEM_CLEAN) -> np.ndarray:
    """Hashes (sorted) of stems that tell toxic texts, from at most ``toxic`` and ``clean`` different texts of (text, label).

    Texts that share their least shingle count as copies of one another; one of them is left before the limit.
    """
    def stamp(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                doc, shingle = Words(texts).shingles(5)
                least = np.full(len(texts), np.iinfo(np.uint64).max, dtype=np.uint64)
                np.minimum.at(least, doc, shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.int32()), pa.array(least.view(np.int64))],
                                                 ["text", "label", "origin"])

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                words = Words(texts)
                table = np.stack([words.stems(n) for n in STEMS])
                edge = np.searchsorted(words.doc, np.arange(len(texts) + 1))
                held = [_held(table[:, a:b]).tobytes() for a, b in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(held, pa.binary())], ["label", "held"])

    order = F.struct(F.xxhash64("text"), "text")
    stamped = rows.select("text", "label").mapInArrow(stamp, "text string, label int, origin long")
    different = freeze(stamped.groupBy("label", "origin").agg(F.min_by("text", order).alias("text")).select("text", "label"), "different")
    one = different.filter("label = 1").orderBy(order).limit(toxic)
    found = one.unionByName(different.filter("label = 0").orderBy(order).limit(clean)).mapInArrow(
        run, "label int, held binary").toPandas()
    sides = []
    for label in (1, 0):
        part = found[found["label"] == label]
        held = [np.frombuffer(x, dtype=np.uint64) for x in part["held"]]
        sides.append((np.concatenate([*held, np.empty(0, np.uint64)]), np.repeat(np.arange(len(held)), [len(x) for x in held]), len(held)))
    (stems, owner, texts), (others, _, clean_texts) = sides
    least = max(3, int(0.015 * texts))
    known, place, count = np.unique(stems, return_inverse=True, return_counts=True)
    frequent = (count >= least) & (known > 1)
    other, seen = np.unique(others, return_counts=True)
    rate = np.zeros(len(known))
    at = np.minimum(np.searchsorted(other, known), max(len(other) - 1, 0))
    if len(other):
        rate = np.where(other[at] == known, seen[at], 0) / max(clean_texts, 1)
    frequent &= rate < 0.1 * count / max(texts, 1)
    keep = frequent[place]
    stem, owner = place[keep], owner[keep]
    chosen, open_ = [], np.ones(texts, dtype=bool)
    while len(stem):
        gain = np.bincount(stem[open_[owner]], minlength=len(known))
        value = gain - 3 * rate * texts
        value[gain < least] = -1
        best = int(np.argmax(value))
        if value[best] <= 0:
            break
        chosen.append(best)
        open_[owner[stem == best]] = False
    return np.unique(known[chosen] & ~np.uint64(1))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic", usable: Column | None = None,
          key: str = "doc_id", text: str = "text") -> tuple[Regression, Callable]:
    """The regression and the statistics that it weighs."""
    usable = ~held_out(labels[key], 3, 1) if usable is None else usable
    rows = freeze(labelled_sample(docs, labels, label, usable, sample, key, text), "labelled")
    statistic = partial(statistics, stems=learn_stems(rows))
    return regress(*numbers(rows, statistic)), statistic
