"""Toxicity scores by a support vector machine over a subsequence string kernel.

Two strings are alike as far as they share subsequences of three characters;
each occurrence counts less the wider it is spread (gap-weighted, up to
``SPAN`` characters), so letters put in between cost similarity but do not
hide a word. The kernel is normalised by the strings' own sizes.

The machine is fitted in the primal on Nyström features: kernel values against
landmark words, whitened by the landmarks' own kernel matrix. A sentence is as
toxic as its worst string, a text as its worst sentence. Labels are known of
texts only; a toxic sentence is put down to its word with the run of letters
that is most surprisingly common in toxic texts, and words of clean texts that
a first machine takes for toxic go into the next fit.

Because the kernel is a product of sparse vectors, the fitted machine is one
weight for each three characters. That gives all strings of a batch at once an
upper bound of their score, and the exact kernel is computed for those that
the bound does not rule out.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.llm.shared import held_out, text_of

MOST_TOXIC = 1_500  # labelled toxic texts to fit on
MOST_CLEAN = 2_500  # labelled clean texts to fit on
LANDMARKS = 300
ROUNDS = 4  # of fitting, each with the clean words that the last took for toxic
BENT = 0.5  # weight of a toxic word with a letter put in
DECAY = 0.75  # for each character that a subsequence is spread beyond three
SPAN = 6
SHORTEST = 5  # of a string, its two marks included
WINDOW = 32  # longer strings are looked at in overlapping windows of this size
LEAST_TEXTS = 4  # toxic ones that a telling run of letters must be in
COMMONER = 12  # times, that it must be commoner in toxic texts
NOTHING = -0.6  # margin below which strings are all the same
LEAST_SCORE = 0.5
CHARACTERS_AT_ONCE = 4_000_000

_APART = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]{1,3}[^\W_](?![^\W_])){2,}")
_SENTENCE = re.compile(r"[.!?\n]+")


def strings_of(token: str) -> list[str]:
    """What of a token (a lower-case run without white space) is compared.

    Its parts between punctuation, and all of it without punctuation, where
    that is not too long to be one word; long strings as overlapping windows.
    Each with a mark at its start and its end.
    """
    bare = token.strip(".,;:!?\"'()")
    if bare.isalnum():
        found = [bare]
    else:
        parts = [part for part in _APART.split(bare) if part]
        joined = "".join(parts)
        found = [part for part in parts if len(part) > 2]
        if len(parts) > 1 and len(joined) <= WINDOW:
            found.append(joined)
        elif len(parts) == 1:
            found = parts
    out = []
    for string in found:
        if len(string) <= WINDOW:
            out.append(string)
        else:
            step = WINDOW // 2
            out += [string[i : i + WINDOW] for i in range(0, len(string) - step, step)]
    return [f"^{string}$" for string in out]


def spelled_out(text: str) -> list[str]:
    """Words written letter by letter, with spaces or marks between."""
    return [_APART.sub("", match) for match in _SPELLED.findall(text)]


def phi(string: str) -> dict[str, float]:
    """The gap-weighted subsequences of three characters of a string."""
    found: dict[str, float] = defaultdict(float)
    n = len(string)
    for i in range(n):
        for k in range(i + 2, min(n, i + SPAN)):
            weight = DECAY ** (k - i - 2)
            for j in range(i + 1, k):
                found[string[i] + string[j] + string[k]] += weight
    return found


def norm(features: dict[str, float]) -> float:
    return sum(x * x for x in features.values()) ** 0.5


def kernel(one: str, other: str) -> float:
    """The normalised kernel of two strings; 0 where one has fewer than three characters."""
    a, b = phi(one), phi(other)
    size = norm(a) * norm(b)
    return sum(x * b[u] for u, x in a.items() if u in b) / size if size else 0.0


def _unit(string: str) -> dict[str, float]:
    features = phi(string)
    size = norm(features)
    return {u: x / size for u, x in features.items()} if size else {}


@dataclass(frozen=True)
class Machine:
    """The fitted machine: a weight for each three characters, and what a margin means."""

    weights: dict[str, float]
    bias: float
    slope: float = 4.0
    offset: float = 0.0

    def margin(self, string: str) -> float:
        return self.bias + sum(x * self.weights.get(u, 0.0) for u, x in _unit(string).items())

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * margin + self.offset))))


class Scorer:
    """The margins of many strings."""

    def __init__(self, machine: Machine) -> None:
        self.machine = machine
        letters = sorted(set("".join(machine.weights)))
        self.n = len(letters) + 1
        self.of_point = np.zeros(0x110000, np.int32)
        for i, letter in enumerate(letters):
            self.of_point[ord(letter)] = i + 1
        self.table = np.zeros(self.n**3, np.float32)
        for (a, b, c), weight in machine.weights.items():
            place = self.of_point[[ord(a), ord(b), ord(c)]]
            self.table[(place[0] * self.n + place[1]) * self.n + place[2]] = weight

    def margins(self, strings: list[str]) -> dict[str, float]:
        """Of the strings whose margin is above ``NOTHING``, the margins."""
        by_length = defaultdict(list)
        for string in strings:
            if len(string) >= SHORTEST:
                by_length[len(string)].append(string)
        found = {}
        for length, some in by_length.items():
            points = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
            places = self.of_point[points].reshape(len(some), length)
            sums, least = np.zeros(len(some), np.float32), 0.0
            for i in range(length):
                for k in range(i + 2, min(length, i + SPAN)):
                    weight = DECAY ** (k - i - 2)
                    for j in range(i + 1, k):
                        at = (places[:, i] * self.n + places[:, j]) * self.n + places[:, k]
                        sums += np.float32(weight) * self.table[at]
                        least += weight * weight
            # A string is at least as long as if all its subsequences differed.
            bound = np.maximum(sums, 0) / least**0.5 + self.machine.bias + 1e-4
            for i in np.flatnonzero(bound > NOTHING):
                if (margin := self.machine.margin(some[i])) > NOTHING:
                    found[some[i]] = margin
        return found

    def worst(self, texts: list[str]) -> list[float]:
        """The margin of the worst string of each text, at least ``NOTHING``."""
        lowered = [text.lower() for text in texts]
        cut = [text.split() for text in lowered]
        spelled = [spelled_out(text) for text in lowered]
        of_token = {token: strings_of(token) for token in set().union(*cut)}
        strings = {s for some in of_token.values() for s in some}
        strings.update(s for words in spelled for word in words for s in strings_of(word))
        margins = self.margins(list(strings))
        bad = {
            token: max(margins[s] for s in some if s in margins)
            for token, some in of_token.items()
            if any(s in margins for s in some)
        }
        out = []
        for tokens, words in zip(cut, spelled):
            margin = max((bad[token] for token in bad.keys() & set(tokens)), default=NOTHING)
            for word in words:
                margin = max([margin, *(margins.get(s, NOTHING) for s in strings_of(word))])
            out.append(margin)
        return out


def _separate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge, L2), by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], 1e-2)
    ridge[-1] = 1e-6
    for _ in range(30):
        gap = 1 - y * (x1 @ w)
        act = gap > 0
        pull = x1[act] * weight[act, None]
        gradient = ridge * w - pull.T @ (y[act] * gap[act])
        step = np.linalg.solve(np.diag(ridge) + pull.T @ x1[act], gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _machine(bad: list[str], bent: list[str], good: list[str], landmarks: list[str]) -> Machine:
    """Nyström features of the strings against the landmarks, and the machine on them."""
    units = [_unit(z) for z in landmarks]
    spots: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for j, unit in enumerate(units):
        for u, x in unit.items():
            spots[u].append((j, x))

    def against(strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(landmarks)))
        for i, string in enumerate(strings):
            for u, x in _unit(string).items():
                for j, z in spots.get(u, ()):
                    out[i, j] += x * z
        return out

    own, vectors = np.linalg.eigh(against(landmarks))
    kept = own > 1e-6
    white = vectors[:, kept] / np.sqrt(own[kept])
    y = np.array([1.0] * (len(bad) + len(bent)) + [-1.0] * len(good))
    weight = np.array([len(good) / len(bad)] * len(bad) + [BENT] * len(bent) + [1.0] * len(good))
    w, bias = _separate(against(bad + bent + good) @ white, y, weight)
    weights: dict[str, float] = defaultdict(float)
    for unit, share in zip(units, white @ w):
        for u, x in unit.items():
            weights[u] += share * x
    return Machine(dict(weights), bias)


def _runs(word: str) -> set[str]:
    """A word, and all four, six and eight letters in a row in it."""
    return {word[i : i + n] for n in (4, 6, 8) for i in range(len(word) - n + 1)} | {word}


def _support(texts: Iterable[list[list[str]]], among: Counter[str] | None = None) -> Counter[str]:
    """Texts that have a run of letters between neighbours that no text before had.

    So what copies of a text repeat counts once. Of the runs in ``among`` only.
    """
    met: set[tuple[str, str, str]] = set()
    found: Counter[str] = Counter()
    runs_of: dict[str, set[str]] = {}
    for sentences in texts:
        new = set()
        for words in sentences:
            for around in zip(["", *words], words, [*words[1:], ""]):
                if around not in met:
                    met.add(around)
                    new.add(around[1])
        runs = set()
        for word in new:
            if word not in runs_of:
                every = _runs(word)
                runs_of[word] = every if among is None else every & among.keys()
            runs |= runs_of[word]
        found.update(runs)
    return found


def _sentences(text: str) -> list[list[str]]:
    cut = ([s for token in part.split() for s in strings_of(token)] for part in _SENTENCE.split(text.lower()))
    return [words for words in cut if words]


def _telling(toxic: list[list[list[str]]], clean: list[list[list[str]]]) -> dict[str, float]:
    """The runs of letters that are far commoner in toxic texts, and how surprising that is.

    So surprising that of all runs not one would be expected to be by chance.
    """
    if not toxic or not clean:
        return {}
    counts = _support(toxic)
    often = Counter({run: n for run, n in counts.items() if n >= LEAST_TEXTS})
    others = _support(clean, often)
    share = len(toxic) / (len(toxic) + len(clean))
    out = {}
    for run, n in often.items():
        m = others[run]
        rate = n / (n + m)
        if n * len(clean) < COMMONER * (m + 0.5) * len(toxic) or rate >= 1 and m:
            continue
        # The log likelihood ratio against the share of toxic texts.
        surprise = n * np.log(rate / share) + (m * np.log((1 - rate) / (1 - share)) if m else 0)
        if surprise > np.log(100 * len(counts)):
            out[run] = float(surprise)
    return out


def fit(toxic: list[str], clean: list[str]) -> Machine:
    """A machine from labelled texts. Without words to tell them apart, all texts score 0."""
    chance = np.random.default_rng(3)
    per_text, per_clean = ([_sentences(text) for text in texts] for texts in (toxic, clean))
    telling = _telling(per_text, per_clean)
    in_toxic, in_clean = (
        Counter(word for sentences in texts for word in {w for s in sentences for w in s})
        for texts in (per_text, per_clean)
    )

    @lru_cache(None)
    def evidence(word: str) -> float:
        """That of its most telling run; none for a word that clean texts have about as often."""
        if len(word) < SHORTEST or in_toxic[word] * len(clean) < COMMONER * in_clean[word] * len(toxic):
            return 0.0
        return max((telling[run] for run in _runs(word) if run in telling), default=0.0)

    # Each toxic sentence is explained by its most telling word.
    told = Counter(
        max(known, key=lambda w: (evidence(w), w))
        for sentences in per_text
        for words in sentences
        if (known := [word for word in words if evidence(word)])
    )
    bad = sorted(told)
    others = sorted(word for word in in_clean if len(word) >= SHORTEST and word not in told)
    if not bad or not others:
        return Machine({}, NOTHING, 1.0, -30.0)
    good = sorted(chance.choice(others, min(2_500, len(others)), replace=False).tolist())
    common = sorted(bad, key=lambda w: (-told[w], w))[: LANDMARKS * 6 // 10]
    # The same words with a letter put in, as people do to get past a filter.
    letters = sorted(set("".join(others)) - {"^", "$"})
    bent = [
        word[:at] + letter + word[at:]
        for word in bad
        if len(word) > 6
        for at, letter in zip(chance.integers(2, len(word) - 1, 3), chance.choice(letters, 3))
    ]
    machine = None
    for _ in range(ROUNDS):
        hard = []
        if machine:  # words of clean texts that look most like the bad ones
            margins = Scorer(machine).margins(others)
            hard = sorted(margins, key=lambda w: (-margins[w], w))[:1_500]
            good = sorted({*good, *hard})
        landmarks = common + hard[: LANDMARKS - len(common)]
        machine = _machine(bad, bent, good, landmarks)
    scorer = Scorer(machine)
    x = np.array(scorer.worst(toxic) + scorer.worst(clean))
    y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    return Machine(machine.weights, machine.bias, *_calibrate(x, y))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by logistic regression with smoothed targets."""
    n, m = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n + 1) / (n + 2), 1 / (m + 2))
    weight = np.where(y > 0, m / n, 1.0)
    x1 = np.stack([x, np.ones(len(x))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (weight * (p - target)) + [1e-3 * w[0], 0]
        curve = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(curve, gradient)
        w = w - np.clip(step, -1, 1)
    return float(w[0]), float(w[1])


def fit_on(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Learns from at most ``MOST_TOXIC`` and ``MOST_CLEAN`` labelled rows that
    are not held out, in the order of a hash of the id: as good as random, and
    the same in every run. Ids that are labelled both ways count as toxic.
    """
    order = F.xxhash64(F.lit("sample"), "doc_id")
    known = (
        labels.filter(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = known.filter("toxic = 1").orderBy(order, "doc_id").limit(MOST_TOXIC).union(
        known.filter("toxic = 0").orderBy(order, "doc_id").limit(MOST_CLEAN)
    )
    # At most the two bounds together: small enough for every executor.
    texts = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = sorted((r.doc_id, r.toxic, r.text) for r in texts.distinct().collect())
    return fit([t for _, toxic, t in rows if toxic], [t for _, toxic, t in rows if not toxic])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with score (0 to 1, higher: toxic likelier), replacing a column of this name.

    The score hangs on the whole text alone; null counts as empty, and a text
    without words has the score of a clean one. Repeated rows stay.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for batch in batches:
            out, texts, size = [], [], 0
            for text in [*batch, None]:
                if texts and (text is None or size + len(text) > CHARACTERS_AT_ONCE):
                    out += [machine.probability(margin) for margin in scorer.worst(texts)]
                    texts, size = [], 0
                if text is not None:
                    texts.append(text)
                    size += len(text)
            yield pd.Series(out, dtype=float)

    return docs.withColumn("score", scored(text_of("text")))
