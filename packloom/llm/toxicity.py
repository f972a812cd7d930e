"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents. Words that look disguised (symbols or digits among letters,
letters repeated, single letters spaced out) open a lattice of what each character may stand for; the Viterbi path
under channel and language model restores them. Words that mark toxic documents are learned from restored labelled
rows, and a document is scored by the restored words that it holds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, cut, identified, small_batches, text_or_empty, without
from .labels import fit_rows, held_out
from .wordhash import parts, slices

#: The fit reads at most so many labelled rows.
MAX_FIT_ROWS = 20_000
FOLD = (4, 2)
THRESHOLD = 0.3
#: A learned word is in at least so many toxic rows, and its log odds are at least LEAST_ODDS with 95 % confidence.
LEAST_ROWS, LEAST_ODDS = 3, 1.3

#: What a sign in a word may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Signs put between letters; a star may also hide a letter.
_BETWEEN = set(".,-_*'`~ ​·/\\:;#%&^=")
_STRIP = ".,;:!?\"'()[]{}<>#%&*~^`-_=/\\|«»“”¿¡…"
#: Punctuation that stands for no letter.
_MUTE = "".join(c for c in _STRIP if c not in STANDS_FOR and c != "*")
#: A letter, or a sign other than a digit that stands for one.
_SUSPECT = re.compile(r"[^\W\d_]|[@$!|+(€£¡]")
_DOUBLED = re.compile(r"(.)\1")
_REPEATED = re.compile(r"(.)\1\1")
_LONG = re.compile(r"([^*\d])\1{3,}")
_EDGE = ".,;:?\"'()[]{}<>«»“”…"
#: One sign between white space: bare, or with punctuation at its edges.
_STRIPPED, _EDGED = (f"[{re.escape(x)}]*+" for x in (_STRIP, _EDGE))
_SINGLE = rf"(?:\S(?!\S)|{_STRIPPED}[^\s{re.escape(_STRIP)}]{_STRIPPED}(?!\S)|{_EDGED}[!|*¡]{_EDGED}(?!\S))"
_SPACED = re.compile(rf"(?<!\S)(?:{_SINGLE}\s++){{2,}}{_SINGLE}")
#: Where stars at an edge or in a spaced-out run hide letters, a learned word may score so much less than the free reading.
WORD_GAIN = 12.0
#: A disguised word has at least so many letters.
LEAST_LETTERS = 3

SYMBOLS = 28  # edge, a to z, any other letter
_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[192:] = 27
_KEPT = np.ones(256, bool)
_KEPT[128:192] = False  # the later bytes of a character


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


# ---------------------------------------------------------------- the character model


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in parts(batches, 4096):
        texts = batch.column(0).to_pylist()
        for a, b in slices(texts, 4096):
            raw = np.frombuffer("\n".join(["", "", *texts[a:b], "", ""]).lower().encode(), np.uint8)
            s = _CODE[raw[_KEPT[raw]]].astype(np.int32)
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["trigram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(third | first, second) of symbols over all texts; its size is fixed."""
    rows = docs.select(text_or_empty().alias("text")).mapInArrow(_trigrams, "trigram int, n long")
    counts = np.zeros(SYMBOLS**3)
    with small_batches(docs.sparkSession):
        found = rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    for r in found:
        counts[r[0]] = r[1]
    tri = counts.reshape((SYMBOLS,) * 3)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + SYMBOLS)
    p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
    return np.log((tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5))


# ---------------------------------------------------------------- the channel


def _options(c: str, before: str) -> list[tuple[str, float]]:
    """(what c stands for, log probability); "" where it stands for nothing."""
    if c.isalpha():
        return [(c, -0.7), ("", -0.7)] if c == before else [(c, 0.0)]
    out = [(x, -0.4 - math.log(len(STANDS_FOR[c]))) for x in STANDS_FOR.get(c, "")]
    if c in _BETWEEN:
        out.append(("", -0.3))
    if c == "*":
        out += [(x, -1.0 - math.log(26)) for x in _LETTERS]
    return out or [("", -3.0)]


def _shorter(run: re.Match) -> str:
    c = run[1]
    return run[0] if c in STANDS_FOR else c * 3 if c.isalpha() else c


def restore(token: str, model: list, most: int = 4) -> list[str]:
    """Likeliest restorations of a disguised word, best first: Viterbi over (last two symbols), `most` paths each."""
    paths: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    before = ""
    for c in token:
        new: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for out, cost in _options(c, before):
            for (a, b), held in paths.items():
                key, gain = ((a, b), cost) if not out else ((b, s := symbol(out)), cost + model[a][b][s])
                new.setdefault(key, []).extend((x + gain, text + out) for x, text in held)
        before = c
        paths = {k: sorted(v, reverse=True)[:most] for k, v in new.items()}
    ends = sorted(((x + model[a][b][0], text) for (a, b), held in paths.items() for x, text in held), reverse=True)
    return list(dict.fromkeys(text for _, text in ends))[: 2 * most]


def free(token: str, model: list) -> float:
    """Score of the likeliest restoration, of any letters."""
    paths, before = {(0, 0): 0.0}, ""
    for c in token:
        new: dict[tuple[int, int], float] = {}
        for out, cost in _options(c, before):
            for (a, b), x in paths.items():
                key, y = ((a, b), x + cost) if not out else ((b, s := symbol(out)), x + cost + model[a][b][s])
                if key not in new or new[key] < y:
                    new[key] = y
        paths, before = new, c
    return max(x + model[a][b][0] for (a, b), x in paths.items())


class Learned:
    """A trie of learned words, with what the character model gives each letter: the lattice restricted to them, exact."""

    def __init__(self, words: set[str], model: list):
        self.model = model
        self.next: list[dict[str, int]] = [{}]
        self.gain, self.word = [0.0], {}
        ends = [(0, 0)]
        for word in words:
            if len(word) < LEAST_LETTERS:
                continue
            node = 0
            for c in word:
                if c not in self.next[node]:
                    a, b = ends[node]
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.gain.append(model[a][b][s := symbol(c)])
                    ends.append((b, s))
                node = self.next[node][c]
            self.word[node] = word
        self.longest = 1 + max(map(len, self.word.values()), default=0)
        self.repeats = re.compile(rf"(.)\1{{{self.longest},}}")
        self.last = {node: model[ends[node][0]][ends[node][1]][0] for node in self.word}

    def find(self, signs: str, lead: int, tail: int) -> list[tuple[int, int, float, str]]:
        """(start, end, score, word) of learned words that begin at sign `lead` or before and leave at most `tail` signs."""
        live: dict[int, tuple[float, int]] = {}
        found, before = [], ""
        for k, c in enumerate(signs):
            if k <= lead:
                live[0] = (0.0, k)
            elif not live:
                break
            new: dict[int, tuple[float, int]] = {}
            for out, cost in _options(c, before):
                for node, (x, start) in live.items():
                    to = self.next[node].get(out) if out else node
                    if to is not None:
                        y = (x + cost + (self.gain[to] if out else 0.0), start)
                        if to not in new or new[to] < y:
                            new[to] = y
            live, before = new, c
            if k + 1 >= len(signs) - tail:
                found += [(start, k + 1, x + self.last[node], self.word[node]) for node, (x, start) in live.items() if node in self.word]
        return found

    def best(self, token: str) -> str | None:
        """The likeliest learned word that a token may stand for, with or without the punctuation at its edges."""
        if len(token) > self.longest:
            # More of one sign on end than the longest learned word has letters say nothing further.
            token = self.repeats.sub(lambda m: m[1] * self.longest, token)
        lead, tail = len(token) - len(token.lstrip(_STRIP)), len(token) - len(token.rstrip(_STRIP))
        found = self.find(token, lead, tail)
        if any("*" in (token[start], token[end - 1]) for start, end, _, _ in found):
            # A star at an edge is more often punctuation than a letter; within a word it hides one.
            least = max(free(token, self.model), free(token.strip(_STRIP), self.model)) - WORD_GAIN
            found = [x for x in found if x[2] >= least or "*" not in (token[x[0]], token[x[1] - 1])]
        return max(((x, word) for _, _, x, word in found), default=(0, None))[1]

    def within(self, signs: str) -> list[str]:
        """Learned words anywhere in a run of signs, without those inside a longer one."""
        out, reach, least = [], 0, {}
        for start, end, x, word in sorted(self.find(signs, len(signs), len(signs)), key=lambda x: (x[0], -x[1], -x[2])):
            part = signs[start:end]
            if "*" in part and part not in least:
                least[part] = free(part, self.model) - WORD_GAIN
            if end > reach and x >= least.get(part, x):
                out.append(word)
                reach = end
        return out


def _signs(run: str) -> str:
    """The signs of a spaced-out run, without the punctuation at their edges."""
    return "".join(t if len(t) == 1 else t.strip(_STRIP) or t.strip(_EDGE) for t in run.lower().split())


class Restorer(dict):
    """Token -> what is known of it, by restoring it once.

    The last `most` tokens met first are held, and those of the `most` before them until they are met again; the rest
    are forgotten. known: words of interest, or None while they are learned; then a token's value is the word itself,
    else the word of interest or None.
    """

    def __init__(self, model: np.ndarray, known: set[str] | None, most: int = 60_000):
        super().__init__()
        self.model, self.known, self.most = model.tolist(), known, most
        self.learned = Learned(known or set(), self.model)
        self.older: dict[str, str | None] = {}

    def __missing__(self, token: str) -> str | None:
        value = self.older[token] if token in self.older else self.word(token)
        if len(token) <= 48:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[token] = value
        return value

    def word(self, token: str) -> str | None:
        known, low = self.known, token.lower()
        plain = low.strip(_STRIP)
        if known is not None:
            if low in known or plain in known:
                return low if low in known else plain
            # Letters without a double stand for themselves alone.
            sure = low.strip(_MUTE)
            return None if sure.isalpha() and not _DOUBLED.search(sure) else self.learned.best(low)
        if plain.isalpha() and not _REPEATED.search(plain):
            return plain
        # Repeated letters and signs that stand for nothing are shortened; then too long for a disguised word, or a number.
        held = _LONG.sub(_shorter, low.strip(_EDGE))
        if not LEAST_LETTERS <= len(held) <= 32 or not _SUSPECT.search(held):
            return plain or None
        return (restore(held, self.model) + (restore(plain, self.model) if plain and plain != held else []) or [None])[0]

    def words(self, text: str) -> list[str | None]:
        tokens = text.split()
        runs = map(_signs, _SPACED.findall(text)) if len(tokens) >= LEAST_LETTERS else ()
        if self.known is None:
            return list(map(self.__getitem__, [*tokens, *(x for x in runs if len(x) > 3)]))
        return [*map(self.__getitem__, tokens), *(word for run in runs for word in self.learned.within(run))]


# ---------------------------------------------------------------- learning and scoring


@dataclass
class Model:
    characters: np.ndarray
    odds: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 0.0


def evidence(words: set[str], odds: dict[str, float]) -> float:
    """Log odds of all restored words that were learned, each once."""
    return sum(odds[w] for w in words)


_COUNTS = ("n0", "n1", "m0", "m1")


def _counted(shared):
    """Rows that hold each restored word: n of the first part, m of the second, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = Restorer(shared.value, None), [Counter() for _ in _COUNTS]

        def out():
            words = sorted(set().union(*counts) - {None})
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)], ["word", *_COUNTS])
            for c in counts:
                c.clear()

        for batch in batches:
            for text, y, part in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                counts[(y == 1) + 2 * part].update(set(restorer.words(text.as_py())))
            if sum(map(len, counts)) > 200_000:
                yield from out()
        yield from out()

    return run


def _odds(toxic, other, n1: int, n0: int):
    """Log odds of a word in toxic rows against others, less what chance allows."""
    a, b = toxic + 0.5, other + 0.5
    return F.when(toxic >= LEAST_ROWS, F.log(a / (n1 + 1)) - F.log(b / (n0 + 1)) - 1.64 * F.sqrt(1 / a + 1 / b))


def _evidence_of(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restorer = Restorer(model.characters, set(model.odds))
        for batch in batches:
            z = [evidence(set(restorer.words(text.as_py())) - {None}, model.odds) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.float64())], ["key", "z"])

    return run


def _logistic(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton's method with a little shrinkage."""
    x, beta = np.stack([np.ones_like(z), z], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (n * (y - p)) - 0.01 * beta
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), grad)
        beta += np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: tuple[int, int] = FOLD, most: int = MAX_FIT_ROWS) -> Model:
    """Character model over all docs; words and calibration from at most `most` labelled rows outside the fold.

    Learned words are few (each is in many toxic rows); they and counts by evidence alone come to the driver.
    """
    sc = docs.sparkSession.sparkContext
    model = Model(character_model(docs))
    # The calibration reads a third of the rows with words of the others, as it would else trust its own words too much.
    rows = cut(fit_rows(docs, labels, label, *fold, most).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(3)) == 0))
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy(F.col("part"), (F.col("y") == 1).alias("y")).count().collect()}
    n1, n0, m1, m0 = (sizes.get((part, y), 0) for part in (False, True) for y in (True, False))
    counted = rows.select("text", "y", "part").mapInArrow(_counted(sc.broadcast(model.characters)), "word string, " + ", ".join(f"{c} long" for c in _COUNTS))
    words = counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in _COUNTS)).where(F.col("n1") + F.col("m1") >= LEAST_ROWS)
    some, every = _odds(F.col("n1"), F.col("n0"), n1, n0), _odds(F.col("n1") + F.col("m1"), F.col("n0") + F.col("m0"), n1 + m1, n0 + m0)
    found = words.select("word", some.alias("some"), every.alias("every")).where((F.col("some") >= LEAST_ODDS) | (F.col("every") >= LEAST_ODDS)).collect()
    model.odds = {r[0]: r[1] for r in found if r[1] is not None and r[1] >= LEAST_ODDS}
    z = rows.where("part").select(F.col("y").alias("key"), "text").mapInArrow(_evidence_of(sc.broadcast(model)), "key int, z double")
    seen = z.groupBy(F.round("z", 1).alias("z"), (F.col("key") == 1).cast("int").alias("y")).count().collect()
    model.odds = {r[0]: r[2] for r in found if r[2] is not None and r[2] >= LEAST_ODDS}
    if seen:
        model.bias, model.slope = _logistic(*(np.array([r[i] for r in seen], float) for i in range(3)))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text; empty texts hold no words and have the least score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), text_or_empty().alias("text"))
    z = rows.mapInArrow(_evidence_of(docs.sparkSession.sparkContext.broadcast(model)), "key long, z double")
    return z.select(F.col("key").alias("doc_id"), (1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * F.col("z"))))).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, threshold: float = THRESHOLD, most: int = MAX_FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Null text: empty. A null doc_id is scored, not learned from. Repeated rows are scored each. Without labels every
    score is a half, without toxic ones near 0. No rows: none.
    """
    out = score(docs, train(docs, labels, "toxic", fold, most))
    return out.select("doc_id", held_out(*fold).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns, scored where they stand."""
    model = train(docs, labels)
    keyed, key = identified(docs)
    toxic = _toxic(docs.sparkSession.sparkContext.broadcast(model), math.log(threshold / (1 - threshold)))
    # Texts go to Python in small batches and don't come back: only the keys of toxic rows do.
    gone = keyed.select(F.col(key).alias("key"), text_or_empty().alias("text")).mapInArrow(toxic, f"key {KEY}").select("key.file", "key.at")
    return without(keyed, key, gone).select(*docs.columns)


def _toxic(shared, logit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restorer = Restorer(model.characters, set(model.odds))
        for batch in batches:
            z = (evidence(set(restorer.words(text.as_py())) - {None}, model.odds) for text in batch.column(1))
            toxic = pa.array([model.bias + model.slope * x >= logit for x in z], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(toxic)], ["key"])

    return run
