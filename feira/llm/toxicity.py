"""Toxic texts by a support vector machine on subsequences of words, learned from labelled sentences.

The kernel of two words counts the subsequences of three characters they share, less for each character that is
skipped, so an insult with inserted characters stays close to the plain one. Landmark words span the
features (Nyström). The evidence of a text is what its words are over the margin, by its length.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.tables import stored

# The model is fitted on so many labelled documents at most, those of least hash, ...
TRAIN_DOCS = 20_000
# ... of which one in so many is kept for choosing the threshold.
CALIBRATE = 4
# Words that the machine is fitted on: toxic ones, and clean ones of each kind.
MOST_TOXIC = 1500
MOST_CLEAN = 3000
LANDMARKS = 128
# Times the machine is fitted anew on the words its own margins pick.
ROUNDS = 2
# Sentences a word must outweigh before it counts as a sign.
DOUBT = 5
LEAST_SIGNS = 3
PENALTY = 1e-3

# A subsequence loses this for every character it skips.
DECAY = 0.5
LETTERS = 64
# Longer words are looked at in windows.
WINDOW = 24
# Words that are added to the length of a text.
SHORT = 20
# Words a task remembers the margins of, texts it holds the words of, subsequences it weighs at a time.
REMEMBERED = 300_000
TOGETHER = 200
ELEMENTS = 1 << 21

SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
NO_PUNCTUATION = str.maketrans("", "", string.punctuation)
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def held_out(doc_id: Column) -> Column:
    """A fifth of all documents, whose labels are not looked at. A document without id is in none."""
    rest = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def words(text: str) -> Counter:
    """Lower-case words without punctuation in or around them; single characters in a row also as one word."""
    lower = text.lower()
    found: Counter = Counter()
    for word, n in Counter(lower.split()).items():
        found[word if word.isalnum() else word.translate(NO_PUNCTUATION)] += n
    found.update(re.sub(r"\s", "", m.group()) for m in SPACED.finditer(lower))
    found.pop("", None)
    return found


def sentences(text: str) -> list[str]:
    return [s for s in map(str.strip, SENTENCE.split(text)) if s]


def _letters() -> np.ndarray:
    """Symbol of each code point below 256: 1 and 2 are the ends of a word."""
    codes = np.full(256, 62)
    codes[ord("a") : ord("z") + 1] = np.arange(3, 29)
    codes[ord("0") : ord("9") + 1] = 29
    codes[0xC0:] = 30 + np.arange(0x40) % 32
    return codes


SYMBOLS = _letters()


def encoded(same_length: list[str]) -> np.ndarray:
    """A row of symbols per word, with its ends."""
    points = np.frombuffer("".join(same_length).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(same_length), -1)
    symbols = np.ones((len(points), points.shape[1] + 2), np.int64)
    symbols[:, 1:-1] = np.where(points < 256, SYMBOLS[np.minimum(points, 255)], 30 + points % 32)
    symbols[:, -1] = 2
    return symbols


# Of each word length, kept by the worker.
_known_places: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All rising triples of places in a word, and their weights."""
    if length not in _known_places:
        triples = np.array(list(combinations(range(length), 3)))
        weights = (DECAY ** (triples[:, 2] - triples[:, 0] - 2.0)).astype(np.float32)
        _known_places[length] = triples, weights
    return _known_places[length]


def subsequences(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every subsequence of every row, and the weights by place."""
    triples, weights = _places(symbols.shape[1])
    a, b, c = (symbols[:, triples[:, i]] for i in range(3))
    return (a * LETTERS + b) * LETTERS + c, weights


def norms(symbols: np.ndarray) -> np.ndarray:
    """Square root of the kernel of each row with itself."""
    n = symbols.shape[1]
    gap = np.subtract.outer(np.arange(n), np.arange(n))
    # Step from one place to a later one.
    step = np.where(gap < 0, DECAY ** np.maximum(-gap - 1.0, 0.0), 0.0).astype(np.float32)
    same = (symbols[:, :, None] == symbols[:, None, :]).astype(np.float32)
    ways = same
    for _ in range(2):
        ways = same * (step.T @ (ways @ step))
    return np.sqrt(ways.sum(axis=(1, 2)))


def by_length(units: Iterable[str]) -> Iterator[list[str]]:
    """Words of one length, not too many together."""
    groups: dict[int, list[str]] = {}
    for unit in units:
        groups.setdefault(len(unit), []).append(unit)
    for length, same in groups.items():
        size = max(1, ELEMENTS // max(1, len(_places(length + 2)[1])))
        for i in range(0, len(same), size):
            yield same[i : i + size]


def windows(unit: str) -> list[str]:
    """A word, or overlapping parts of a long one that cover it."""
    if len(unit) <= WINDOW:
        return [unit]
    half = WINDOW // 2
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - half, half)]


class Landmarks:
    """Kernel values with a fixed list of words."""

    def __init__(self, units: list[str]):
        self.units = units
        rows, codes, values = [], [], []
        for i, unit in enumerate(units):
            symbols = encoded([unit])
            found, weights = subsequences(symbols)
            rows.append(np.full(found.shape[1], i))
            codes.append(found[0])
            values.append(weights / norms(symbols)[0])
        self.codes, at = np.unique(np.concatenate(codes), return_inverse=True)
        self.table = np.zeros((len(self.codes) + 1, len(units)), np.float32)
        np.add.at(self.table, (at, np.concatenate(rows)), np.concatenate(values))

    def kernel(self, units: list[str]) -> np.ndarray:
        result = np.zeros((len(units), len(self.units)))
        places = {unit: i for i, unit in enumerate(units)}
        for same in by_length(places):
            symbols = encoded(same)
            codes, weights = subsequences(symbols)
            at = np.searchsorted(self.codes, codes)
            at[self.codes[np.minimum(at, len(self.codes) - 1)] != codes] = len(self.codes)
            for i, (row, norm) in enumerate(zip(at, norms(symbols))):
                result[places[same[i]]] = weights @ self.table[row] / norm
        return result


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Squared-hinge machine by Newton steps; the last feature is the constant one and not penalised."""
    keep = np.full(x.shape[1], penalty)
    keep[-1] = 1e-9
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        return float(keep @ (v * v) + weight @ np.square(np.maximum(0, 1 - y * (x @ v))))

    best = loss(w)
    for _ in range(100):
        inside = y * (x @ w) < 1
        a, d = x[inside], weight[inside]
        step = np.linalg.solve(np.diag(keep) + (a.T * d) @ a, (a.T * d) @ y[inside]) - w
        size = 1.0
        while loss(w + size * step) > best and size > 1e-6:
            size /= 2
        w = w + size * step
        now = loss(w)
        if best - now <= 1e-9 * max(1.0, best):
            break
        best = now
    return w


@dataclass(frozen=True)
class Model:
    """Weights of subsequences, and the evidence from which a text is called toxic."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float
    toxic_from: float = 0.5

    def table(self) -> np.ndarray:
        dense = np.zeros(LETTERS**3, np.float32)
        dense[self.codes] = self.weights
        return dense

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """From 0 to 1, and 0.5 at the threshold."""
        return evidence / (evidence + self.toxic_from)


class Judge:
    """Margins of words and texts; one per task."""

    def __init__(self, model: Model):
        self.table, self.bias = model.table(), model.bias
        self.known: dict[str, float] = {}

    def learn(self, units: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [u for u in units if u not in self.known]
        parts = {part for unit in new for part in windows(unit)}
        margins: dict[str, float] = {}
        for same in by_length(parts):
            symbols = encoded(same)
            codes, weights = subsequences(symbols)
            found = self.table[codes] @ weights / norms(symbols) + self.bias
            margins.update(zip(same, found.tolist()))
        for unit in new:
            self.known[unit] = max(margins[part] for part in windows(unit))

    def look(self, texts: list[str | None]) -> Iterator[tuple[float, float, str]]:
        """Per text the evidence, and the largest margin of a word with that word, the least of equals."""
        for i in range(0, len(texts), TOGETHER):
            own = [words(text or "") for text in texts[i : i + TOGETHER]]
            self.learn(set().union(*own))
            known = self.known
            for counts in own:
                if not counts:
                    yield 0.0, 0.0, ""
                    continue
                margins = [known[u] for u in counts]
                top = max(margins)
                over = 0.0
                if top > 0:
                    over = sum(sorted(m * n for m, n in zip(margins, counts.values()) if m > 0))
                    over /= (counts.total() + SHORT) ** 0.5
                yield over, top, min(u for u, m in zip(counts, margins) if m == top)


def _sentence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic")):
            own = list(dict.fromkeys(sentences(text.as_py() or "")))
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([toxic.as_py()] * len(own), pa.int32())], ["sentence", "toxic"])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        units = sorted(counts[0].keys() | counts[1].keys())
        columns = [pa.array(units, pa.string()), *[pa.array([c[u] for u in units], pa.int64()) for c in counts]]
        return pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic"])

    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for sentence, toxic in zip(batch.column("sentence"), batch.column("toxic")):
            # Long words are known by their windows.
            counts[toxic.as_py()].update({part for unit in words(sentence.as_py()) for part in windows(unit)})
        if len(counts[0]) + len(counts[1]) > REMEMBERED:
            yield out(counts)
            counts = Counter(), Counter()
    yield out(counts)


# Columns of the next function.
WORST = "word margin evidence toxic"
WORST_SCHEMA = "word string, margin double, evidence double, toxic int"


def _worst_words(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            evidence, margins, found = zip(*judge.look(texts)) if texts else ((), (), ())
            columns = [pa.array(found, pa.string()), pa.array(margins, pa.float64()), pa.array(evidence, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], WORST.split(" "))

    return run


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic, fits) of at most `most` labelled document ids outside the held-out fifth.

    Of several labels of one id the larger counts.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATE)) != 0)
    )
    # `most` rows of three numbers.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "fits")


def fitted(signs: list[tuple[str, int]], clean: list[str], landmarks: int = LANDMARKS) -> Model:
    """A machine that tells words with their counts from clean words."""
    half = landmarks // 2
    chosen = Landmarks(list(dict.fromkeys([w for w, _ in signs[:half]] + clean[:half])))
    values, vectors = np.linalg.eigh(chosen.kernel(chosen.units))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    units = [w for w, _ in signs] + clean
    x = np.column_stack([chosen.kernel(units) @ root, np.ones(len(units))])
    y = np.where(np.arange(len(units)) < len(signs), 1.0, -1.0)
    # Both classes weigh the same; a frequent sign weighs more, though not in proportion.
    own = np.sqrt([float(n) for _, n in signs])
    weight = np.concatenate([own / own.sum(), np.full(len(clean), 1 / max(1, len(clean)))])
    w = support_vectors(x, y, weight, PENALTY)
    return Model(chosen.codes, (chosen.table[:-1] @ (root @ w[:-1])).astype(np.float32), float(w[-1]))


def threshold(evidence: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of all evidence from which labels agree best, or nearly so, with calling a text toxic.

    Nearly so is by no more labels than the square root of those gained.
    """
    order = np.argsort(-evidence, kind="stable")
    evidence, gain = evidence[order], np.cumsum(2 * toxic[order] - 1)
    below = np.append(evidence[1:], 0.0)
    apart = evidence > below
    if not apart.any() or gain[apart].max() <= 0:
        return 2 * float(evidence[0]) + 1.0
    best = gain[apart].max()
    near = apart & (gain >= best - np.sqrt(best)) & (gain > 0)
    return float(evidence[near].max() + below[near].min()) / 2


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model | float:
    """The model, or the share of toxic documents where the labels show no sign.

    Equal sentences count once, and as clean if they stand in a clean text too. The first fit takes
    words that toxic sentences hold much more often; later ones the worst words of the sentences, by
    the margins so far, the nearest clean ones among them.
    """
    rows = stored(training_rows(docs, labels, most), "toxic-rows")
    base = rows.agg(F.avg("toxic")).first()[0] or 0.0
    told = stored(
        rows.filter("fits")
        .select("text", "toxic")
        .mapInArrow(_sentence_rows, "sentence string, toxic int")
        .groupBy("sentence")
        .agg(F.min("toxic").alias("toxic")),
        "toxic-sentences",
    )
    counts = stored(
        told.mapInArrow(_word_rows, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "toxic-words",
    )
    sure = F.col("toxic") / (F.col("toxic") + F.col("clean") + DOUBT)
    signs = counts.filter((sure >= 0.5) & (F.col("toxic") >= LEAST_SIGNS))
    signs = [(r.word, r.toxic) for r in signs.orderBy(F.desc("toxic"), "word").limit(MOST_TOXIC).collect()]
    plain = counts.filter((F.col("clean") > 0) & (sure < 0.2))
    frequent = plain.orderBy(F.desc("clean"), "word").limit(MOST_CLEAN)
    spread = plain.orderBy(F.xxhash64("word"), "word").limit(MOST_CLEAN)
    usual = list(dict.fromkeys(r.word for part in (frequent, spread) for r in part.select("word").collect()))
    if not signs or not usual:
        return base
    model = fitted(signs, usual)
    texts = told.select(F.col("sentence").alias("text"), "toxic")
    for _ in range(ROUNDS):
        worst = stored(
            texts.mapInArrow(_worst_words(model), WORST_SCHEMA)
            .filter("word <> ''")
            .groupBy("word", "toxic")
            .agg(F.count("*").alias("n"), F.max("margin").alias("margin")),
            "toxic-worst",
        )
        near = worst.filter("toxic = 0").orderBy(F.desc("margin"), "word").limit(MOST_CLEAN).collect()
        known = {w for r in near for w in windows(r.word)}
        found = worst.filter("toxic = 1 AND margin > 0").orderBy(F.desc("n"), "word").limit(MOST_TOXIC).collect()
        signs = [(r.word, r.n) for r in found if len(r.word) <= WINDOW and r.word not in known]
        if not signs:
            break
        model = fitted(signs, list(dict.fromkeys([w for r in near for w in windows(r.word)] + usual)))
    kept = rows.filter("NOT fits").select("text", "toxic").mapInArrow(
        _worst_words(model), WORST_SCHEMA
    )
    # Equal evidence together: a few thousand steps, whatever the copies.
    step = F.least(F.round("evidence", 3), F.lit(10.0)).alias("evidence")
    steps = kept.groupBy(step, "toxic").agg(F.count("*").alias("n")).collect()
    evidence, toxic = (np.repeat([r[i] for r in steps], [r.n for r in steps]) for i in (0, 1))
    if len(set(toxic.tolist())) < 2:
        return model
    return replace(model, toxic_from=threshold(evidence, toxic))


def scored(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """`docs` with `score`, `predicted` and `toxic_sentence`, the first with the worst word if predicted.

    Result columns replace input columns of their names. NULL and empty texts score 0; without a model
    every text has the same score.
    """

    @F.pandas_udf("score double, toxic_sentence string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = None if isinstance(model, float) else Judge(model)
        for batch in batches:
            texts = batch.tolist()
            if judge is None:
                yield pd.DataFrame({"score": np.full(len(texts), model), "toxic_sentence": [None] * len(texts)})
                continue
            found = list(judge.look(texts))
            scores = model.score(np.array([evidence for evidence, _, _ in found]))
            said = [
                next((s for s in sentences(text) if word in words(s)), None) if score >= 0.5 else None
                for text, score, (_, _, word) in zip(texts, scores, found)
            ]
            yield pd.DataFrame({"score": scores, "toxic_sentence": said})

    # The scores come first, under a name that no input column can take by struct.
    both = docs.select(judged(F.col(f"`{text}`")).alias("verdict"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    results = {
        "score": F.col("verdict.score"),
        "predicted": (F.col("verdict.score") >= 0.5).cast("int"),
        "toxic_sentence": F.col("verdict.toxic_sentence"),
    }
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in results]
    return both.select(*kept, *[column.alias(name) for name, column in results.items()])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, toxic_sentence) of every document.

    Scores depend on the text alone. Repeated rows are scored each by itself; other columns are not
    read. A table without rows gives no rows; labels without toxic or without clean documents give
    every text their share.
    """
    model = learn(docs, labels)
    result = scored(docs.select("doc_id", "text"), model)
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "toxic_sentence")
