"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings is that of their common subsequences of three characters, each
weighted by ``DECAY`` to the power of the length it spans (normalised). Gaps and inserted
characters cost weight but leave subsequences in place, so that spaced or dotted insults stay near plain ones.

* Units: the words of a sentence, folded (lower case, accents kept, digits and signs that stand for letters
  read as these, outer punctuation dropped), and runs of single characters joined, spaces included.
* Training: labelled sentences (a document's sentences carry its label) are bags of units. A positive bag is
  represented by its most telling units, at first by document counts, then by the machine itself
  (multiple-instance rounds); negative units are those of negative bags, the hardest always among them.
  Positive units are also trained with characters put in.
* Nyström: ``LANDMARKS`` units, half of them positive, half near or random negatives, span the feature
  space; a linear SVM (hinge loss, dual coordinate descent) is trained there.
* Scoring: the machine is linear in the kernel, so its landmarks add up to one table of weights over
  triples of symbols; a unit's margin is a sum over its subsequences. A document's margin is
  that of its most toxic unit; a logistic curve, fitted on the training documents, gives the score.

The model is fitted on the driver from a bounded sample: at most ``TRAIN_DOCUMENTS`` labelled documents
(those of smallest hashed id) of at most ``TRAIN_LONGEST`` characters each, and no more than ``TRAIN_CHARACTERS`` characters of them. Of these, at most ``NEGATIVES`` distinct
negative units are chosen from (by hash), three units tell a positive bag, 800 hard negatives are added a round, and ``CALIBRATION`` documents give the curve. Every whole text is scored.

Defined cases: a null or empty text has no unit and the score of none; ids may be null or repeated (one result row per
input row); with no labels of both kinds every score is the share of positives, or 0; ties in training go by the unit's text; an empty table gives an
empty table; further columns are ignored. Words longer than ``LONGEST`` are read through overlapping windows of that length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from graniteloom.llm.common import documents, release, release_driver, small_batches

DECAY = 0.6
LANDMARKS = 400
LONGEST, STRIDE = 20, 5
TRAIN_DOCUMENTS = 5000
TRAIN_CHARACTERS = 16_000_000
#: A labelled text of more characters isn't learnt from (it is scored like any other).
TRAIN_LONGEST = 200_000
#: Documents of the sample that the curve from margin to score is fitted on.
CALIBRATION = 4000
ROUNDS = 4
#: Evidence (log-likelihood ratio) from which a unit tells of a label; negative units to choose hard ones from.
TELLING, NEGATIVES = 24.0, 120_000
THRESHOLD = 0.3

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»„“”‘’…–—"
#: Signs and digits that stand for letters. Fixed values.
_FOLD = str.maketrans("0134578@$", "oieastbas")
SYMBOLS = 64


def symbols(units: list[str], width: int) -> np.ndarray:
    """Rows of symbol numbers: 1 start, 2 end, 3 to 28 letters, 29 to 62 others (by code), 0 past the end."""
    out = np.zeros((len(units), width), dtype=np.int32)
    if not units:
        return out
    text = np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    n = np.fromiter((len(u) for u in units), dtype=np.int64, count=len(units))
    code = np.where((text >= 97) & (text <= 122), text - 94, 29 + text % 34)
    row = np.repeat(np.arange(len(units)), n)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + 1
    out[row, at] = code
    out[:, 0] = 1
    out[np.arange(len(units)), n + 1] = 2
    return out


_TRIPLES: dict[int, tuple[np.ndarray, ...]] = {}


def triples(n: int) -> tuple[np.ndarray, ...]:
    """Places (i, j, k) of all subsequences of three out of ``n``, and their weights."""
    if n not in _TRIPLES:
        at = np.array(list(combinations(range(n), 3)), dtype=np.int32).reshape(-1, 3)
        _TRIPLES[n] = (at[:, 0], at[:, 1], at[:, 2], (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32))
    return _TRIPLES[n]


def expand(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``units``, subsequence codes, weights, norms) of groups of units of one length."""
    by_len: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        by_len.setdefault(len(u), []).append(i)
    for n, places in by_len.items():
        i, j, k, w = triples(n + 2)
        step = max(1, min(8000, 2_000_000 // max(len(w), 1)))
        for a in range(0, len(places), step):
            part = places[a : a + step]
            s = symbols([units[p] for p in part], n + 2)
            codes = (s[:, i] * SYMBOLS + s[:, j]) * SYMBOLS + s[:, k]
            yield np.array(part), codes, w, norms(s)


def norms(s: np.ndarray) -> np.ndarray:
    """Norms in feature space of rows of symbols of one length: the kernel's recursion on a string and itself."""
    rows, n = s.shape
    same = [[(s[:, a] == s[:, b]).astype(np.float32) * np.float32(DECAY * DECAY) for b in range(n)] for a in range(n)]
    one, zero = np.ones(rows, dtype=np.float32), np.zeros(rows, dtype=np.float32)
    before = [[one] * (n + 1) for _ in range(n + 1)]
    decay = np.float32(DECAY)
    for _ in range(2):
        now = [[zero] * (n + 1) for _ in range(n + 1)]
        for a in range(1, n + 1):
            run = zero
            for b in range(1, n + 1):
                run = decay * run + same[a - 1][b - 1] * before[a - 1][b - 1]
                now[a][b] = decay * now[a - 1][b] + run
        before = now
    total = np.zeros(rows, dtype=np.float64)
    for a in range(n):
        for b in range(n):
            total += same[a][b] * before[a][b]
    return np.sqrt(np.maximum(total, 1e-12)).astype(np.float32)


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised subsequence kernel of units and landmarks, through one table of weights at a time."""
    out, table = np.zeros((len(units), len(landmarks))), np.zeros(SYMBOLS**3, dtype=np.float32)
    groups = list(expand(units))
    for marks, mark_codes, mark_weights, mark_size in expand(landmarks):
        for r, m in enumerate(marks):
            np.add.at(table, mark_codes[r], mark_weights / mark_size[r])
            for places, codes, w, size in groups:
                out[places, m] = (table[codes] @ w) / size
            table[mark_codes[r]] = 0.0
    return out


def fold(word: str) -> str:
    """A lower-case word as a unit: outer punctuation dropped, look-alikes read as letters."""
    bare = word.strip(_OUTER)
    return bare if bare.isalpha() else bare.translate(_FOLD)


def words_of(text: str) -> list[str]:
    """Lower-case words, and runs of three or more single characters joined by the spaces between them."""
    out = text.lower().split()
    single = [i for i, w in enumerate(out) if len(w) == 1]
    if len(single) > 2:
        a = 0
        for k in range(1, len(single) + 1):
            if k == len(single) or single[k] != single[k - 1] + 1:
                if k - a > 2:
                    out.append(" ".join(out[single[a] : single[k - 1] + 1]))
                a = k
    return out


def units_of(sentence: str) -> list[str]:
    """The units of a sentence: folded words of three characters at least."""
    return [p for u in map(fold, words_of(sentence)) if len(u) > 2 for p in windows(u)]


def windows(unit: str) -> list[str]:
    """Windows of a long unit, in which any run of ``LONGEST - STRIDE + 1`` characters lies whole, else the unit."""
    if len(unit) <= LONGEST:
        return [unit]
    last = len(unit) - LONGEST
    return [unit[a : a + LONGEST] for a in (*range(0, last, STRIDE), last)]


#: The margin of a text without units.
NONE = -2.0


@dataclass
class Model:
    """Weights over subsequences, the bias, and the curve from margin to score."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(SYMBOLS**3, dtype=np.float32))
    bias: float = -1.0
    slope: float = 0.0
    offset: float = -30.0

    def margins(self, units: list[str]) -> np.ndarray:
        out = np.full(len(units), NONE)
        for places, codes, w, size in expand(units):
            out[places] = (self.table[codes] @ w) / size + self.bias
        return out

    def score(self, margin: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * margin + self.offset))))


def _inserted(unit: str) -> list[str]:
    """Ways to write a unit with characters put in."""
    mid = len(unit) // 2
    return [*(c.join(unit) for c in (".", "-", " ", "*")), *(unit[:mid] + c + unit[mid:] for c in ("-", ".", "*", "_", "x")), unit[:1] + "." + unit[1:], unit[0] + unit]


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = 40, seed: int = 1) -> tuple[np.ndarray, float]:
    """A linear SVM (hinge loss) by dual coordinate descent; the bias is a constant feature."""
    x = np.hstack([x, np.ones((len(x), 1))])
    size, alpha, v = np.einsum("ij,ij->i", x, x), np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ v) - 1) / size[i], 0.0), cost[i])
            if new != alpha[i]:
                v += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return v[:-1], float(v[-1])


def _evidence(p: int, n: int, n_pos: int, n_neg: int) -> float:
    """Log-likelihood ratio of a unit's document counts, 0 if it isn't commoner in positives."""
    share = (p + n) / (n_pos + n_neg)
    if p / n_pos <= n / n_neg:
        return 0.0
    part = lambda k, m: (k * math.log(k / (m * share)) if k else 0.0) + ((m - k) * math.log((m - k) / (m * (1 - share))) if k < m else 0.0)
    return 2 * (part(p, n_pos) + part(n, n_neg))


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, seed: int = 1) -> Model:
    """The model of labelled texts."""
    model = Model()
    n_pos = sum(labels)
    if not texts or n_pos in (0, len(texts)):
        share = n_pos / len(texts) if texts else 0.0
        model.offset = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return model
    one: dict[str, str] = {}  # each unit is held once
    bags = [sorted({one.setdefault(u, u) for s in _SENTENCE.split(t) for u in units_of(s)}) for t in texts]
    pos, neg = Counter(), Counter()
    for y, units in zip(labels, bags, strict=True):
        (pos if y else neg).update(units)
    n_neg = len(texts) - n_pos
    evidence = {u: e for u in pos if (e := _evidence(pos[u], neg[u], n_pos, n_neg)) > 0}
    tell = {u for u, e in evidence.items() if e >= TELLING} or set(sorted(evidence, key=lambda u: (-evidence[u], u))[:5])
    pool = [u for u in neg if u not in tell and evidence.get(u, 0.0) < TELLING / 4]
    pool = sorted(sorted(pool, key=lambda u: (zlib.crc32(u.encode()), u))[:NEGATIVES])
    some, hard = pool[:: max(1, len(pool) // 2000)], []
    held = lambda us: sorted((u for u in us if u in tell), key=lambda u: (-evidence[u], u))[:3]
    witness = Counter(u for y, units in zip(labels, bags, strict=True) if y for u in held(units))
    for _ in range(ROUNDS):
        plus = sorted(witness, key=lambda u: (-witness[u], u))[:landmarks]
        chosen = list(dict.fromkeys([*plus[: landmarks // 2], *hard[: landmarks // 3], *some[:: max(1, len(some) // landmarks)]]))[:landmarks]
        values, vectors = np.linalg.eigh(kernel(chosen, chosen))
        root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
        extra = list(dict.fromkeys(w for u in plus for w in _inserted(u) if len(w) <= LONGEST + 2))
        minus = list(dict.fromkeys(hard + some))
        x = kernel(plus + extra + minus, chosen) @ root
        y = np.array([1.0] * (len(plus) + len(extra)) + [-1.0] * len(minus))
        cost = np.array([20.0] * len(plus) + [5.0] * len(extra) + [10.0] * len(minus))
        v, model.bias = _svm(x, y, cost)
        alpha = root @ v
        model.table = np.zeros(SYMBOLS**3, dtype=np.float32)
        for places, codes, w, size in expand(chosen):
            for r, p in enumerate(places):
                np.add.at(model.table, codes[r], (alpha[p] / size[r] * w).astype(np.float32))
        margins = model.margins(pool)
        hard = list(dict.fromkeys(hard + [pool[i] for i in np.argsort(-margins, kind="stable")[:800]]))
        told = sorted(u for u, e in evidence.items() if u in tell or e >= TELLING / 4)
        of = dict(zip(told, model.margins(told), strict=True))
        more = lambda us: sorted((u for u in us if u in tell or of.get(u, NONE) > 0.5), key=lambda u: (-of[u], u))[:3]
        witness = Counter(u for y, units in zip(labels, bags, strict=True) if y for u in more(units)) or witness
    every = sorted({u for units in bags[:CALIBRATION] for u in units})
    of = dict(zip(every, model.margins(every).tolist(), strict=True))
    top = np.array([max((of[u] for u in units), default=NONE) for units in bags[:CALIBRATION]])
    model.slope, model.offset = _logistic(top, np.array(labels[:CALIBRATION], dtype=float))
    del bags, one, pos, neg, evidence, of, every
    release()
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for a rising curve, with a little weight decay on its slope."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * x).sum() + 0.05 * a, (p - y).sum()])
        w = p * (1 - p) + 1e-6
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - max(-2, min(2, step[0])), b - max(-2, min(2, step[1]))
    return max(float(a), 0.0), float(b)


class Scorer:
    """Margins of texts, with a bounded table of the words met first."""

    def __init__(self, model: Model, most: int = 120_000):
        self.model, self.most, self.known = model, most, {}

    def _look_up(self, words: list[str]) -> dict[str, float]:
        """Margins of words: of the unit each folds to, or the most of its windows."""
        parts = [[p for p in windows(u)] if len(u) > 2 else [] for u in map(fold, words)]
        units = list({p for ps in parts for p in ps})
        of = dict(zip(units, self.model.margins(units).tolist(), strict=True))
        return {w: max((of[p] for p in ps), default=NONE) for w, ps in zip(words, parts, strict=True)}

    def __call__(self, texts: list[str | None]) -> list[float]:
        out: list[float] = []
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size < 1_000_000):
                size += len(texts[b] or "")
                b += 1
            known, bags = self.known, [{w for s in _SENTENCE.split(t) for w in words_of(s)} if t else set() for t in texts[a:b]]
            fresh = self._look_up(list(set().union(*bags) - known.keys()))
            out += [max((fresh[w] if w in fresh else known[w] for w in bag), default=NONE) for bag in bags]
            if len(known) < self.most:
                known.update(fresh)
            a = b
        return out


def training_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int = TRAIN_DOCUMENTS) -> tuple[list[str], list[int]]:
    """The bounded training sample; repeated ids count once by smallest text."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id").where(F.coalesce(F.length("_text"), F.lit(0)) <= TRAIN_LONGEST)
    rows = rows.groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
    got = rows.orderBy(F.xxhash64("_id"), "_id")
    size = F.sum(F.length(F.coalesce("_text", F.lit("")))).over(_first())
    got = got.withColumn("_sum", size).where(F.col("_sum") <= TRAIN_CHARACTERS).select("_text", "_y").collect()
    release_driver(df.sparkSession)  # the machine is fitted beside it
    return [r[0] or "" for r in got], [r[1] for r in got]


def _first():
    from pyspark.sql import Window as W

    return W.orderBy(F.xxhash64("_id"), "_id").rowsBetween(W.unboundedPreceding, 0)


def score(df: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a column ``into`` (in place of one of that name, if there is one); all other columns stay."""
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != into])
    fields = T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType())])
    held = df.sparkSession.sparkContext.broadcast(model)  # one table of a quarter of a million numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            got: list[float] = []
            for a in range(0, len(texts), 250):
                got += [held.value.score(m) for m in scorer(texts.slice(a, 250).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, type=pa.float64())], names=[*batch.schema.names, into])
        scorer.known.clear()
        release()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, fields)


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return fit(*training_rows(documents(spark, sf_dir), labels, "doc_id", "text", "toxic"))


def op1_toxicity_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document."""
    rows = documents(spark, sf_dir).select("doc_id", "text")
    out = score(rows, train(spark, sf_dir))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
