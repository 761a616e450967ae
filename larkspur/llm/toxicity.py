"""Toxicity: gradient-boosted trees over a few dense features of a text, with isotonic calibration.

The features are densities of a lexicon learned from the labels, how near its words stand to second-person words,
capitals, punctuation and obfuscation (letters written as digits or signs, signs inside words, letters standing alone). The
lexicon holds words and beginnings of words that toxic texts have clearly more often than others; it is counted over all
labelled rows that may be learned from and kept whole, as sorted arrays that workers map. So that the trees don't see features made from
their own labels, those rows are split in two halves, and each half's training features use the other half's lexicon;
all scores use the lexicon of both.

Trees are fitted on at most ``sample_rows`` labelled rows, chosen by hash; four fifths grow the trees, the rest calibrates
them. The calibrated score keeps a fiftieth of the trees' own probability, so that rows of one calibration step stay in order.
With fewer than a hundred rows to calibrate with, probabilities are drawn towards the share of toxic rows instead.

Scoring needs no shuffle. Defined results: null and empty texts have zero features and get a score like any other.
Without labels of both classes every score is their mean (0 without labels). Labels of a repeated id count once, the
larger one; rows are scored one by one, so repeated rows repeat; all columns of a row are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur import store
from larkspur.llm.kernels import BLANKS, LOWER, Texts, pieces, prefix_hashes, range_hashes, texts_of, words
from larkspur.workspace import materialize, new_path

#: Words that speak to someone, in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner deinen deinem ihr euch euer eure tu te toi ton ta tes "
    "vous votre vos tú ti tus usted ustedes vosotros vuestro"
).split()
#: Letters that digits and signs stand for.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Beginnings of words that may be lexicon entries, in bytes.
BEGINNINGS = (4, 5, 6)
#: Log likelihood ratio that makes an entry, and bits of a hash that name its file.
SURE, SHARD_BITS = 2.0, 4
#: Rows that the prior counts as in scores that are not calibrated.
PRIOR_ROWS = 40
NEAR = 5
FEATURES = (
    "words word_density word_best word_hits word_strong begin_density begin_best begin_hits begin_strong near_second_person "
    "second_person capitals capital_words punctuation exclamations questions obfuscated lone_letters digits non_ascii"
).split()

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_STANDS_FOR = LOWER.copy()
for _sign, _letter in LOOKALIKES.items():
    _STANDS_FOR[ord(_sign)] = ord(_letter)
_STANDIN = _STANDS_FOR != LOWER


class Reading:
    """Words of a piece in plain spelling: lower case, look-alikes between letters replaced, other signs left out."""

    def __init__(self, piece: Texts):
        data = piece.data
        letter = _LETTER[data]
        between = np.zeros(len(data), bool)
        between[1:-1] = letter[:-2] & letter[2:]
        self.replaced = _STANDIN[data] & between
        blank = BLANKS[data]
        keep = letter | _DIGIT[data] | blank | self.replaced
        self.dropped = ~keep & between
        plain = np.where(self.replaced, _STANDS_FOR[data], LOWER[data])[keep]
        kept = np.concatenate([[0], np.cumsum(keep)])
        self.texts = Texts(plain, kept[piece.starts])
        self.words = words(self.texts)
        sums = prefix_hashes(plain)
        begin, end = self.words.begin, self.words.end
        self.hashes = range_hashes(sums, begin, end)
        # Only words that go on after a beginning have it as one.
        self.begins = [range_hashes(sums, begin, np.minimum(begin + n, end)) for n in BEGINNINGS]
        self.long_enough = [end - begin > n for n in BEGINNINGS]


def _hash_of(word: str) -> np.uint64:
    return Reading(Texts(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))).hashes[0]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: each word and beginning with the rows and the toxic rows that have it, by half."""
    for batch in batches:
        half, toxic = batch.column("half").to_numpy(), batch.column("toxic").to_numpy()
        found = []
        for first, piece in pieces(texts_of(batch.column("text"))):
            reading = Reading(piece)
            text = reading.words.text
            term = [reading.hashes, *(h[m] for h, m in zip(reading.begins, reading.long_enough, strict=True))]
            owner = [text, *(text[m] for m in reading.long_enough)]
            kind = [np.full(len(t), k, np.int8) for k, t in enumerate(term)]
            term, owner, kind = np.concatenate(term), first + np.concatenate(owner), np.concatenate(kind)
            order = np.lexsort((owner, term, kind))
            term, owner, kind = term[order], owner[order], kind[order]
            fresh = np.ones(len(term), bool)
            fresh[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1])
            found.append((term[fresh], kind[fresh], half[owner[fresh]], toxic[owner[fresh]]))
        if not found:
            continue
        term, kind, half, toxic = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((half, kind, term))
        term, kind, half, toxic = term[order], kind[order], half[order], toxic[order]
        fresh = np.ones(len(term), bool)
        fresh[1:] = (term[1:] != term[:-1]) | (kind[1:] != kind[:-1]) | (half[1:] != half[:-1])
        at = np.flatnonzero(fresh)
        yield pa.RecordBatch.from_arrays(
            [pa.array(term[at].view(np.int64)), pa.array(kind[at].astype(np.int32)), pa.array(half[at].astype(np.int32)),
             pa.array(np.diff(np.concatenate([at, [len(term)]]))), pa.array(np.add.reduceat(toxic.astype(np.int64), at))],
            names=["term", "kind", "half", "rows", "toxic"],
        )


def _lexicon(counts: DataFrame, prior: float) -> DataFrame:
    """``term``, ``kind`` and ``weight`` of the entries: the log of how much likelier they make a toxic text, drawn towards none
    by four rows of the prior.

    An entry needs two toxic texts and a log likelihood ratio against the prior of two, which one text in some twenty
    reaches by chance. The bar does not rise with the number of terms, so a word that only two texts have, both toxic, is one.
    """
    t, n = F.col("toxic").cast("double"), F.col("rows").cast("double")
    clean = F.when(n > t, (n - t) * F.log((n - t) / (n * (1 - prior)))).otherwise(0.0)
    sure = t * F.log(t / (n * prior)) + clean >= SURE
    weight = F.log((t + 4 * prior) / (n + 4) / prior)
    chosen = counts.where("toxic >= 2").withColumn("weight", weight).where((F.col("weight") >= 0.7) & sure)
    return chosen.select("term", "kind", "weight")


def _stored(spark: SparkSession, parts: list[DataFrame]) -> str:
    """The lexica as sorted arrays in the shared folder, one file for each part, kind and range of hashes."""
    path = new_path(spark, "lexicon")
    tables = [part.withColumn("part", F.lit(k)) for k, part in enumerate(parts)]
    entries = reduce(DataFrame.unionByName, tables)
    entries = entries.withColumn("shard", F.shiftrightunsigned("term", 64 - SHARD_BITS).cast("int"))

    def write(table: pa.Table) -> pa.Table:
        part, kind, shard = (table[c][0].as_py() for c in ("part", "kind", "shard"))
        term, weight = table["term"].to_numpy().view(np.uint64), table["weight"].to_numpy()
        order = np.argsort(term)
        store.save(path, f"terms-{part}-{kind}-{shard}", term[order])
        store.save(path, f"weights-{part}-{kind}-{shard}", weight[order])
        return pa.table({"entries": [len(term)]})

    entries.groupBy("part", "kind", "shard").applyInArrow(write, "entries long").agg(F.sum("entries")).collect()
    return path


@lru_cache(maxsize=8)
def _entries(path: str, part: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Mapped arrays of a lexicon by kind (words, then beginnings) and range of hashes."""
    return [
        [
            (store.load(path, f"terms-{part}-{kind}-{shard}", np.uint64), store.load(path, f"weights-{part}-{kind}-{shard}", float))
            for shard in range(1 << SHARD_BITS)
        ]
        for kind in range(len(BEGINNINGS) + 1)
    ]


def _weights(hashes: np.ndarray, entries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    found = np.zeros(len(hashes))
    shard = (hashes >> np.uint64(64 - SHARD_BITS)).astype(np.uint8)
    for k, (term, weight) in enumerate(entries):
        mine = np.flatnonzero(shard == k)
        if len(term) and len(mine):
            at = np.searchsorted(term, hashes[mine])
            at[at == len(term)] = 0
            found[mine] = np.where(term[at] == hashes[mine], weight[at], 0.0)
    return found


def _by_text(values: np.ndarray, first: np.ndarray, largest: bool = False) -> np.ndarray:
    """Sum (or largest) of the values of each text's words; 0 for a text without words."""
    n = np.diff(first)
    out = np.zeros(len(n))
    some = np.flatnonzero(n)
    if len(some):
        out[some] = (np.maximum if largest else np.add).reduceat(values, first[some])
    return out


def features(piece: Texts, reading: Reading, lexicon) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, first = piece.data, reading.words.first
    n = np.diff(first).astype(float)
    per_word = np.maximum(n, 1)
    whole = _weights(reading.hashes, lexicon[0])
    begin = np.zeros(len(whole))
    for hashes, mask, entries in zip(reading.begins, reading.long_enough, lexicon[1:], strict=True):
        begin = np.maximum(begin, np.where(mask, _weights(hashes, entries), 0.0))
    you = np.isin(reading.hashes, _YOU)
    # Words within NEAR of a second-person word of the same text.
    text = reading.words.text
    at = np.flatnonzero(you)
    near = np.zeros(len(whole), bool)
    for shift in range(-NEAR, NEAR + 1):
        to = at + shift
        inside = (to >= 0) & (to < len(whole))
        to, origin = to[inside], at[inside]
        near[to[text[to] == text[origin]]] = True
    hit = np.maximum(whole, begin) > 0

    def bytes_of(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[piece.starts[1:]] - sums[piece.starts[:-1]]).astype(float)

    letters, size = np.maximum(bytes_of(_LETTER[data]), 1), np.maximum(np.diff(piece.starts), 1)
    original = words(piece)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (upper[original.end] - upper[original.begin]) * 2 > original.end - original.begin
    signs = ~(_LETTER[data] | _DIGIT[data] | BLANKS[data])
    odd = np.concatenate([[0], np.cumsum(reading.replaced | reading.dropped)])
    tampered = odd[original.end] > odd[original.begin]
    words_of_text = np.maximum(original.counts, 1)
    lone = (reading.words.end - reading.words.begin) == 1
    columns = [
        np.log1p(n),
        _by_text(whole, first) / per_word,
        _by_text(whole, first, True),
        np.log1p(_by_text(whole > 0, first)),
        np.log1p(_by_text(whole > 1.5, first)),
        _by_text(begin, first) / per_word,
        _by_text(begin, first, True),
        np.log1p(_by_text(begin > 0, first)),
        np.log1p(_by_text(begin > 1.5, first)),
        _by_text(hit & near, first) / np.maximum(_by_text(hit, first), 1),
        _by_text(you, first) / per_word,
        bytes_of(_UPPER[data]) / letters,
        _by_text(shouted, original.first) / words_of_text,
        bytes_of(signs) / size,
        bytes_of(data == ord("!")) / size,
        bytes_of(data == ord("?")) / size,
        _by_text(tampered, original.first) / words_of_text,
        _by_text(lone, first) / per_word,
        bytes_of(_DIGIT[data]) / size,
        bytes_of(data >= 0x80) / size,
    ]
    return np.stack(columns, axis=1)


_YOU = np.array([_hash_of(w) for w in SECOND_PERSON], np.uint64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    table = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
    offsets = np.arange(len(table) + 1, dtype=np.int32) * len(FEATURES)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.reshape(-1)))


def _crossed(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features of labelled rows under the lexicon of the half they are not in."""
        for batch in batches:
            half, rows, lexica = batch.column("half").to_numpy(), [], (_entries(path, 1), _entries(path, 2))
            for first, piece in pieces(texts_of(batch.column("text"))):
                reading = Reading(piece)
                one, two = (features(piece, reading, lexicon) for lexicon in lexica)
                rows.append(np.where(half[first : first + len(piece), None] == 0, two, one))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), _lists(rows)],
                                             names=["id", "toxic", "features"])

    return run


class Toxicity:
    """A fitted lexicon, trees and calibration."""

    def __init__(self, held: str | None, trees=None, steps=None, level: float = 0.0, rows: int = 0):
        self.held, self.trees, self.steps, self.level, self.rows = held, trees, steps, level, rows

    @classmethod
    def fit(
        cls,
        docs: DataFrame,
        labels: DataFrame,
        learn: Column,
        id_col: str = "doc_id",
        text_col: str = "text",
        label_col: str = "toxic",
        sample_rows: int = 50_000,
    ) -> Toxicity:
        """``learn`` says, on a column named ``id``, which rows may be learned from."""
        # Workers import this module for its functions and have no use for pyspark.ml, which would stay in their memory.
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.functions import array_to_vector, vector_to_array
        from pyspark.ml.regression import IsotonicRegression

        spark = docs.sparkSession
        half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).cast("int")
        source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        marked = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("toxic"))
        marked = marked.where(F.col("toxic").isNotNull() & F.col("id").isNotNull() & learn)
        marked = materialize(marked.groupBy("id").agg(F.max("toxic").alias("toxic")), "labels")
        # The filter on the labels lets Spark sieve the documents by them before it shuffles texts.
        labelled = source.join(marked.where("toxic >= 0"), "id").select("id", half.alias("half"), "toxic", "text")
        labelled = materialize(labelled, "labelled")
        n, toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if not 0 < toxic < n:
            return cls(None, level=toxic / n if n else 0.0)
        prior = toxic / n
        counts = labelled.mapInArrow(_terms, "term long, kind int, half int, rows long, toxic long")
        sums = [F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic")]
        counts = materialize(counts.groupBy("term", "kind", "half").agg(*sums), "terms")
        whole = counts.groupBy("term", "kind").agg(*sums)
        parts = (whole, counts.where("half = 0"), counts.where("half = 1"))
        held = _stored(spark, [_lexicon(part, prior) for part in parts])

        kind = source.schema["id"].dataType.simpleString()
        rows = labelled.mapInArrow(_crossed(held), f"id {kind}, toxic int, features array<double>")
        rows = rows.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(sample_rows)
        train = rows.select(
            array_to_vector("features").alias("features"),
            F.col("toxic").cast("double").alias("label"),
            (F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(5)) == 0).alias("calibrate"),
        )
        train = materialize(train.repartition(8), "train")
        grow, rest = train.where("NOT calibrate"), train.where("calibrate")
        if grow.select("label").distinct().count() < 2:
            return cls(held, level=prior)
        trees = GBTClassifier(maxIter=30, maxDepth=4, stepSize=0.2, maxBins=64, minInstancesPerNode=3, seed=1).fit(grow)
        steps = trees.transform(rest).select("label", vector_to_array("probability")[1].alias("features"))
        classes = {r.label: r["count"] for r in steps.groupBy("label").count().collect()}
        if len(classes) < 2 or sum(classes.values()) < 100:
            return cls(held, trees, level=prior, rows=n)
        fitted = IsotonicRegression().fit(steps)
        return cls(held, trees, (list(fitted.boundaries), list(fitted.predictions)))

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Columns ``row`` (each row as it came) and ``score``; no shuffle."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
        source = docs.select(whole, F.col(text_col).cast("string").alias("text"))
        if self.trees is None:
            return source.select("row", F.lit(self.level).alias("score"))
        held = self.held

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon = _entries(held, 0)
            for batch in batches:
                rows = [features(p, Reading(p), lexicon) for _, p in pieces(texts_of(batch.column("text")))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(rows)], names=["row", "features"])

        kind = source.schema["row"].dataType.simpleString()
        rows = source.mapInArrow(run, f"row {kind}, features array<double>")
        scored = self.trees.transform(rows.select("row", array_to_vector("features").alias("features")))
        own = vector_to_array("probability")[1]
        if self.steps is None:
            # Too few rows to calibrate with: the prior counts as some rows of its own.
            own = (self.rows * own + PRIOR_ROWS * self.level) / (self.rows + PRIOR_ROWS)
            return scored.select("row", own.alias("score"))
        score = 0.98 * _interpolated(F.col("own"), *self.steps) + 0.02 * F.col("own")
        scored = scored.select("row", own.alias("own"))
        return scored.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))


def _interpolated(x: Column, at: list[float], value: list[float]) -> Column:
    """The calibration: linear between its steps, level outside."""
    steps = list(zip(at, value, strict=True))
    pairs = F.array(*(F.struct(F.lit(float(a)).alias("a"), F.lit(float(v)).alias("v")) for a, v in steps))
    low, high = F.filter(pairs, lambda p: p.a <= x), F.filter(pairs, lambda p: p.a > x)
    left, right = F.try_element_at(low, F.lit(-1)), F.try_element_at(high, F.lit(1))
    between = left.v + (right.v - left.v) * (x - left.a) / (right.a - left.a)
    return F.when(F.size(low) == 0, right.v).when(F.size(high) == 0, left.v).otherwise(between)


def reject_toxic(
    docs: DataFrame, labels: DataFrame, learn: Column, limit: float = 0.5, text_col: str = "text", **settings
) -> DataFrame:
    """The documents with a score below the limit, all columns as they are."""
    model = Toxicity.fit(docs, labels, learn, text_col=text_col, **settings)
    return model.score(docs, text_col).where(F.col("score") < limit).select("row.*")
