"""Language identification by hierarchical discrimination.

A text is turned into hashed letter n-grams (orders 1 to 3, with word edges). Languages are gathered into families of
similar profiles; a linear support vector machine per family, one against the rest, names the family first. Within the
family, one machine for each pair of languages votes for the language.

Machines are trained on a bounded sample of labelled rows: per language the ``sample_rows`` rows of lowest
hash. Each machine is trained in a task of its own; a family machine sees at most ``family_rows`` rows, dealt evenly over
the languages. What is collected is one weight vector per machine. Every document is then read whole, in one pass
without a shuffle.

Defined results: a null text and a text without letters are ``und`` with score 0, as is every text if nothing could be
learned. Rows with null language or null text teach nothing. Equal votes go to the larger sum of margins, then
to the lower language. Repeated rows are predicted one by one; null ids are not held out and teach nothing. Extra
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.stages import stage
from folioscope.llm.words import Texts, mixed
from folioscope.scale import first_rows

SAMPLE_ROWS = 1200
PART_ROWS = 1000  # rows per group that Spark cuts in the map tasks by default
FAMILY_ROWS = 4800
FEATURES = 2048
SLICE_BYTES = 2 << 20
SLICE_DOCS = 1024
ROUNDS = 12
PENALTY = 1.0
UNKNOWN = "und"
CODE_POINTS = 0x110000


def _letters(texts: Texts, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with 0 for each run of others, and the document of each; documents begin with 0."""
    parts = [np.frombuffer(texts.data[texts.bounds[d] : texts.bounds[d + 1]].tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"),
                           np.uint32) for d in range(first, last)]
    edge = np.zeros(1, np.uint32)
    chars = np.concatenate([x for p in parts for x in (edge, p)] + [edge])
    doc = np.repeat(np.arange(last - first + 1), [len(p) + 1 for p in parts] + [1])
    present = np.zeros(CODE_POINTS, bool)
    present[chars] = True
    lower = np.zeros(CODE_POINTS, np.uint32)
    for c in np.flatnonzero(present).tolist():
        if chr(c).isalpha():
            lower[c] = ord(chr(c).lower()[0])
    letters = lower[chars]
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (doc[1:] != doc[:-1])
    return letters[keep].astype(np.uint64), doc[keep]


def _profiles(texts: Texts, first: int, last: int, features: int) -> np.ndarray:
    """One row per document: square roots of n-gram shares, of length 1; zeros without letters."""
    n = last - first
    letters, doc = _letters(texts, first, last)
    out = np.zeros((n, features), np.float64)
    for order in (1, 2, 3):
        if len(letters) < order:
            break
        size = len(letters) - order + 1
        gram, solid = np.zeros(size, np.uint64), np.zeros(size, bool)
        for k in range(order):
            gram = (gram << np.uint64(21)) | letters[k : k + size]
            solid |= letters[k : k + size] != 0
        for k in range(1, order - 1):  # a word edge stands at an end of an n-gram, not inside
            solid &= letters[k : k + size] != 0
        solid &= (doc[:size] == doc[order - 1 :]) | ((letters[order - 1 :] == 0) & (doc[order - 1 :] - doc[:size] == 1))
        place = (mixed(gram + np.uint64(order << 62 if order < 4 else 0)) % np.uint64(features)).astype(np.int64)
        at = doc[:size][solid] * features + place[solid]
        out += np.bincount(at, minlength=(n + 1) * features)[: n * features].reshape(n, features)
    total = out.sum(axis=1, keepdims=True)
    return np.sqrt(out / np.where(total > 0, total, 1))


def _sliced(texts: Texts):
    for first, last in texts.slices(SLICE_BYTES):
        for low in range(first, last, SLICE_DOCS):
            yield low, min(low + SLICE_DOCS, last)


def _sampled(features: int):
    def run(batches):
        for batch in batches:
            texts = Texts(batch.column(1))
            for low, high in _sliced(texts):
                profile = _profiles(texts, low, high, features)
                for i in np.flatnonzero(profile.any(axis=1)).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[low + i : low + i + 1], batch.column(2)[low + i : low + i + 1],
                         pa.array([profile[i].astype(np.float32).tobytes()], pa.binary())], ["lang", "place", "profile"])

    return run


def families_of(centroids: dict[str, np.ndarray]) -> dict[str, int]:
    """Languages in about sqrt(n) families: the most similar groups of profiles are joined, by average similarity."""
    groups = [[x] for x in sorted(centroids)]
    unit = {x: v / max(np.linalg.norm(v), 1e-12) for x, v in centroids.items()}
    mean = np.mean([unit[x] for x in sorted(unit)], axis=0) if unit else 0
    unit = {x: v - mean for x, v in unit.items()}  # what all languages share says nothing
    while len(groups) > max(1, round(len(centroids) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: np.mean([unit[x] @ unit[y] for x in groups[p[0]] for y in groups[p[1]]]))
        groups[a] += groups.pop(b)
    return {x: k for k, g in enumerate(groups) for x in g}


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by dual coordinate descent (Hsieh et al., 2008).

    Both sides carry the same weight in the loss, however many rows they have.
    """
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    side = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) / max(len(y), 1)
    corner = 1 / (2 * penalty * np.maximum(side, 1e-6))
    square, alpha, w = (x * x).sum(axis=1) + corner, np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + corner[i] * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _train(features: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "place"])
        y = np.where(rows["positive"], 1.0, -1.0)
        x = np.stack([np.frombuffer(p, np.float32) for p in rows["profile"]]).astype(np.float64)
        return pd.DataFrame({"task": [key[0]], "weights": [train_svm(x, y).tobytes()]})

    return run


class Machines:
    """Family and pair machines as matrices."""

    def __init__(self, languages: list[str], family: dict[str, int], weights: dict[str, np.ndarray], features: int):
        self.languages, self.family, self.features = languages, family, features
        self.names = sorted(set(family.values()))
        self.between = [weights.get(f"family {k}") for k in self.names]
        self.pairs = {(a, b): weights[f"pair {a} {b}"] for a, b in _pairs(family)}

    def predict(self, profiles: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.concatenate([profiles, np.ones((len(profiles), 1))], axis=1)
        if len(self.names) > 1:
            margins = x @ np.stack(self.between).T
            order = np.argsort(-margins, axis=1, kind="stable")
            chosen = order[:, 0]
            rows = np.arange(len(x))
            trust = _squash(margins[rows, order[:, 0]] - margins[rows, order[:, 1]])
        else:
            chosen, trust = np.zeros(len(x), np.int64), np.ones(len(x))
        out = np.empty(len(x), object)
        for k, name in enumerate(self.names):
            mine = np.flatnonzero(chosen == k)
            members = [a for a in self.languages if self.family[a] == name]
            votes, sums = np.zeros((len(mine), len(members))), np.zeros((len(mine), len(members)))
            least = np.full((len(mine), len(members)), np.inf)
            for i, j in combinations(range(len(members)), 2):
                margin = x[mine] @ self.pairs[members[i], members[j]]
                for at, m in ((i, margin), (j, -margin)):
                    votes[:, at] += m >= 0 if at == i else m > 0
                    sums[:, at] += m
                    least[:, at] = np.minimum(least[:, at], m)
            best = np.lexsort((-np.arange(len(members)) + np.zeros_like(votes), sums, votes), axis=1)[:, -1] if len(mine) else []
            out[mine] = [members[i] for i in best]
            if len(members) > 1:
                trust[mine] *= _squash(2 * least[np.arange(len(mine)), best])
        return out.tolist(), trust


def _squash(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2 * margin, -50, 50)))


def _pairs(family: dict[str, int]) -> list[tuple[str, str]]:
    return [(a, b) for a, b in combinations(sorted(family), 2) if family[a] == family[b]]


def lowest_ids(named: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, lang): the ids of lowest hash of each language, at most ``sample_rows``.

    A language may hold most rows. Its ids are first cut inside parts, by another hash and below the size up to which
    Spark cuts in the map tasks, so only a few thousand of them meet to be ranked. A part holds more than its share of the
    lowest ids twice over with no chance worth naming.
    """
    order = [F.xxhash64("doc_id"), F.asc("doc_id")]
    parts = max(1, -(-sample_rows * 2 // PART_ROWS))
    ids = named.select("doc_id", "lang").distinct().withColumn("part", F.crc32(F.col("doc_id").cast("string")) % parts)
    if parts > 1:
        ids = first_rows(ids, ["lang", "part"], order, PART_ROWS)
    return first_rows(ids, ["lang"], order, sample_rows).select("doc_id", "lang")


def learn(teachers: DataFrame, *, sample_rows: int = SAMPLE_ROWS, family_rows: int = FAMILY_ROWS, features: int = FEATURES) -> Machines | None:
    """Machines from (doc_id, text, lang) rows; None if no text with letters has a language."""
    named = teachers.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    lowest = stage(lowest_ids(named, sample_rows), "language-sample")
    sample = named.join(lowest, ["doc_id", "lang"], "left_semi").select("lang", "text", F.xxhash64("doc_id").alias("place"))
    sample = stage(sample.mapInArrow(_sampled(features), "lang string, place long, profile binary"), "language-profiles")
    sums = sample.mapInPandas(_centroids, "lang string, n long, total binary").toPandas()  # one row per batch of the bounded sample and language
    if not len(sums):
        return None
    centroids = {}
    for lang, part in sums.groupby("lang"):
        centroids[lang] = sum(np.frombuffer(t, np.float64) for t in part["total"]) / part["n"].sum()
    family = families_of(centroids)
    per_language = max(1, family_rows // len(family))
    kinds = sorted(set(family.values()))
    tasks = [(f"family {k}", a, family[a] == k, per_language) for k in kinds for a in sorted(family)] if len(kinds) > 1 else []
    tasks += [(f"pair {a} {b}", x, x == a, sample_rows) for a, b in _pairs(family) for x in (a, b)]
    weights = {}
    if tasks:
        plan = sample.sparkSession.createDataFrame(tasks, "task string, lang string, positive boolean, most int")
        rows = first_rows(sample, ["lang"], [F.asc("place"), F.xxhash64("profile")], sample_rows).withColumn(
            "at", F.expr("row_number() OVER (PARTITION BY lang ORDER BY place, xxhash64(profile))"))
        rows = rows.join(plan, "lang").filter("at <= most")
        found = rows.groupBy("task").applyInPandas(_train(features), "task string, weights binary").collect()  # one row per machine
        weights = {r["task"]: np.frombuffer(bytes(r["weights"]), np.float64) for r in found}
    return Machines(sorted(family), family, weights, features)


def _centroids(frames):
    for frame in frames:
        for lang, part in frame.groupby("lang"):
            total = np.sum([np.frombuffer(p, np.float32) for p in part["profile"]], axis=0, dtype=np.float64)
            yield pd.DataFrame({"lang": [lang], "n": [len(part)], "total": [total.tobytes()]})


def _predict(machines: Machines | None):
    def run(batches):
        for batch in batches:
            texts = Texts(batch.column(2))
            langs, scores = [], []
            for low, high in _sliced(texts):
                if machines is None:
                    langs += [UNKNOWN] * (high - low)
                    scores.append(np.zeros(high - low))
                    continue
                profile = _profiles(texts, low, high, machines.features)
                some = profile.any(axis=1)
                lang, score = machines.predict(profile)
                langs += [x if s else UNKNOWN for x, s in zip(lang, some)]
                scores.append(np.where(some, score, 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; rows that are held out teach nothing."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    machines = learn(rows.filter(~F.col("held_out")), **options)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(machines), "doc_id long, held_out boolean, lang_pred string, score double")
